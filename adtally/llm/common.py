"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adtally.session import scratch_path

#: Bytes of text that one vectorised step holds at a time; a longer single
#: text forms a step of its own.
STEP_BYTES = 2 << 20
#: Rows of a side that may be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 300_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage, survives lost executors, and gives the planner true
    sizes, so that it broadcasts only what it has measured as small.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Intermediate tables in one folder of the shared scratch area, each of which
    can be dropped when its last reader is done."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, scratch_path(spark, f"llm-{name}")

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """As ``materialize``."""
        df.write.parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        """Delete tables; DataFrames over them can no longer be read."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        for name in names:
            path = hadoop.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def batch_bytes(spark: SparkSession, limit: int = STEP_BYTES) -> Iterator[None]:
    """Jobs run in here hand rows to Python in Arrow batches of about ``limit``
    bytes (Spark's own limit is 64 MB, which an executor and a worker hold for each task)."""
    old = spark.conf.get(_BATCH_BYTES, None)
    spark.conf.set(_BATCH_BYTES, str(limit))
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(_BATCH_BYTES)
        else:
            spark.conf.set(_BATCH_BYTES, old)


def own_names(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with names that clash with no other, and the new name of each old one."""
    names = {c: f"_in_{i}" for i, c in enumerate(df.columns)}
    return df.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), names


def old_names(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(n).alias(c) for c, n in names.items()])


def sized_broadcast(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` (written before, few narrow columns) with a broadcast hint if its
    counted rows are within ``BROADCAST_ROWS``; else unchanged, to be shuffled."""
    n = df.count() if rows is None else rows
    return df.hint("broadcast") if n <= BROADCAST_ROWS else df


def steps(batch: pa.RecordBatch, column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of ``batch`` that hold about ``limit`` bytes of ``column`` each."""
    if not batch.num_rows:
        return
    sizes = batch.column(column)
    offsets = np.frombuffer(sizes.buffers()[1], np.int32, batch.num_rows + 1 + sizes.offset)[sizes.offset:]
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[begin] + limit, "right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts one after the other, and where each begins
    (with the end of the last); nulls count as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1 + texts.offset)[texts.offset:].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenation of arange(s, s + n) over all (s, n)."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def code_points(raw: bytes, positions: list[int]) -> list[int]:
    """Code point offsets of ascending byte positions."""
    out, at, n = [], 0, 0
    for p in positions:
        n += len(raw[at:p].decode("utf-8", "ignore"))
        at = p
        out.append(n)
    return out


def importable(spark: SparkSession) -> None:
    """Let the Python workers import this package from where the driver has it
    (a no-op for an installed package or one shipped with ``--py-files``)."""
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])
