"""Rerun-safe writes: partitioned files and tables, table upsert, JDBC."""

from adtally.sinks.jdbc import jdbc_append, jdbc_upsert
from adtally.sinks.partitioned import write_partitions, write_table_partitions
from adtally.sinks.upsert import upsert_partitions

__all__ = [
    "jdbc_append",
    "jdbc_upsert",
    "upsert_partitions",
    "write_partitions",
    "write_table_partitions",
]
