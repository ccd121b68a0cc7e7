"""The ETL job as an incremental Structured Streaming query.

The reference is batch-only; this is the same ETL (JSON log -> IP
enrichment -> date-partitioned table) run over a growing log folder, so new
files are enriched as they land instead of once a day. No stateful operator
is needed: the IP lookup is a stream-static join against the dictionary.
"""

from adtally.streaming.batches import DictionaryVersions, read_stream_output, start_batched_etl_stream
from adtally.streaming.etl_stream import start_etl_stream

__all__ = ["DictionaryVersions", "read_stream_output", "start_batched_etl_stream", "start_etl_stream"]
