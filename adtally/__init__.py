"""adtally: daily ad-log reporting expressed as Spark DataFrame / SQL plans.

The library never creates or stops a SparkSession; every entry point takes the
caller's session (or a DataFrame) and an explicit report date.

Layout
------
- ``sources``    reading the raw JSON log and one day of the enriched table
- ``functions``  column expressions: IP parsing, dictionary strings, dates, rates
- ``operators``  IP range lookup, KPI measures, distributions, top-n, map feed
- ``sinks``      rerun-safe partitioned writes, table upsert, JDBC writes
- ``plans``      the ETL and report jobs, and the SQL forms of the KPI report
- ``streaming``  the ETL as an incremental file-stream job
- ``fixtures``   test inputs derived from the driver's tables
"""

from adtally.errors import EmptyDayError, OverlappingRangesError

__all__ = ["EmptyDayError", "OverlappingRangesError"]
