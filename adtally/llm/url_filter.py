"""URL filters over a sorted digest array.

The list (rules and blocked prefixes, each a host and the beginning of a path)
is turned into 64-bit xxhash keys, sorted, and written as one file per key range
to the shared folder: the keys, then the offsets and bytes of the full strings.
Tasks map the files into memory (where the shared folder is a mounted path; a
remote one is read once per worker), probe all candidate strings of a batch of
URLs by one vectorised binary search, and confirm every hit on the full string,
so that a collision of digests never decides.

A URL's candidates are its host and all parent domains, each with the beginnings
of its path that have the length of some listed path. The longest listed string
wins. Up to ``LOCAL_BYTES`` of list every task probes it whole; a larger list
stays in its key ranges, and the candidates' digests go to the task that holds
their range.

Defined results: a null url, or one without ``://``, has an empty host and path
and is allowed; of equal list entries an allowing one wins; null ids stay;
repeated rows give repeated rows; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm.common import materialize
from adtally.session import scratch_path

#: Bytes of list files that every task may map whole.
LOCAL_BYTES = 64 << 20
#: Key ranges of a list that is larger.
RANGES = 256


def digest(text: str) -> int:
    return xxhash.xxh64_intdigest(text.encode())


def with_host_and_path(df: DataFrame, url_col: str = "url") -> DataFrame:
    """``df`` with host (A-Z lower-cased) and path of ``url_col``."""
    url = F.col(url_col).cast("string")
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(F.expr(f"substring(cast(`{url_col}` as string), instr(cast(`{url_col}` as string), '://') + 3)"), "#", 1))
    df = df.withColumn("_rest", F.substring_index(rest, "?", 1))
    host = F.translate(F.substring_index("_rest", "/", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.when(F.instr("_rest", "/") > 0, F.expr("substring(_rest, instr(_rest, '/'))")).otherwise("")
    return df.select("*", F.coalesce(host, F.lit("")).alias("host"), F.when(F.col("_rest").isNull(), "").otherwise(path).alias("path")).drop("_rest")


def _open(path: str):
    if "://" not in path and not path.startswith("file:"):
        return pa.memory_map(path)
    fs, place = pafs.FileSystem.from_uri(path)
    return pa.memory_map(place) if isinstance(fs, pafs.LocalFileSystem) else fs.open_input_file(place)


class DigestArray:
    """One list file: u64 count, sorted u64 keys, u64 offsets (count + 1), string bytes."""

    def __init__(self, path: str):
        source = _open(path)
        self.buffer = source.read_buffer(source.size())  # a view of the map, not a copy, where mapped
        count = int(np.frombuffer(self.buffer, "<u8", 1)[0])
        self.keys = np.frombuffer(self.buffer, "<u8", count, 8)
        self.offsets = np.frombuffer(self.buffer, "<u8", count + 1, 8 + 8 * count)
        self.bytes = memoryview(self.buffer)[8 + 8 * count + 8 * (count + 1):]

    def probe(self, keys: np.ndarray, texts: list[str]) -> np.ndarray:
        """Whether each text is listed; ``keys`` are the texts' digests."""
        first, last = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        found = np.zeros(len(keys), bool)
        for i in np.flatnonzero(last > first).tolist():
            want = texts[i].encode()
            found[i] = any(bytes(self.bytes[int(self.offsets[j]):int(self.offsets[j + 1])]) == want for j in range(first[i], last[i]))
        return found


_MAPPED: dict[str, DigestArray] = {}


def _mapped(path: str) -> DigestArray:
    if path not in _MAPPED:
        if len(_MAPPED) >= 2 * RANGES:
            _MAPPED.clear()
        _MAPPED[path] = DigestArray(path)
    return _MAPPED[path]


def build_list(entries: DataFrame, ranges: int = 1, column: str = "entry") -> DataFrame:
    """Write the strings of ``entries`` (nulls are left out) as sorted digest
    arrays to a new shared folder; returns a row per file: part, path, size."""
    folder = scratch_path(entries.sparkSession, "url-list")

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("entry").to_pylist()
            keys = np.array([digest(t) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array((keys >> np.uint64(32)).astype(np.int64) * ranges >> 32), batch.column("entry"),
                                              pa.array([k.to_bytes(8, "big") for k in keys.tolist()], pa.binary())], names=["part", "entry", "key"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        part = None

        def close() -> pa.RecordBatch:
            keys = np.frombuffer(b"".join(k for k, _ in held), ">u8").astype("<u8")
            raw = [t.encode() for _, t in held]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype("<u8")
            content = b"".join([np.uint64(len(held)).astype("<u8").tobytes(), keys.tobytes(), offsets.tobytes(), *raw])
            path = f"{folder}/{part:06d}.digests"
            fs, base = pafs.FileSystem.from_uri(folder if folder.startswith("file:") or "://" in folder else f"file://{folder}")
            fs.create_dir(base, recursive=True)
            temporary = f"{base}/.{uuid.uuid4().hex}.{TaskContext.get().taskAttemptId()}"
            with fs.open_output_stream(temporary) as out:
                out.write(content)
            fs.move(temporary, f"{base}/{part:06d}.digests")
            held.clear()
            return pa.RecordBatch.from_pydict({"part": [part], "path": [path], "size": [len(content)]})

        for batch in batches:
            for p, entry, key in zip(*(batch.column(c).to_pylist() for c in ("part", "entry", "key"))):
                if p != part and held:
                    yield close()
                part = p
                held.append((key, entry))
        if held:
            yield close()

    rows = entries.select(F.col(column).cast("string").alias("entry")).where("entry is not null").distinct()
    dealt = rows.mapInArrow(keyed, "part long, entry string, key binary").repartition("part").sortWithinPartitions("part", "key")
    return materialize(dealt.mapInArrow(write, "part long, path string, size long"), "url-list-files")


def _candidates(host: str, path: str, lengths: list[int]) -> list[str]:
    out = []
    while host:
        out += [host + path[:n] for n in lengths if n <= len(path)]
        _, dot, host = host.partition(".")
        if not dot:
            break
    return out


def matches(rows: DataFrame, entries: DataFrame, column: str = "entry") -> DataFrame:
    """``rows`` (with host and path) with ``entry``: the longest listed string that fits, or null.

    ``entries``: strings of a host and the beginning of a path, such as
    ``example.net/en/``."""
    # measured before it is built: one file holds LOCAL_BYTES at most, or a range of the keys
    listed = entries.where(F.col(column).isNotNull()).agg(F.sum(F.octet_length(column) + 16)).first()[0] or 0
    local = listed <= LOCAL_BYTES
    files = build_list(entries, 1 if local else RANGES, column)
    # distinct lengths of listed paths: bounded by the longest path, not by the list
    lengths = sorted(r[0] for r in entries.where(F.col(column).isNotNull()).select(
        (F.char_length(column) - F.char_length(F.substring_index(column, "/", 1))).alias("n")).distinct().collect())
    if local:
        paths = [r["path"] for r in files.select("path").collect()]
        return rows.mapInArrow(_probe_whole(paths, lengths), f"{_ddl(rows)}, entry string")
    where = {r["part"]: r["path"] for r in files.select("part", "path").collect()}
    asked = rows.select("host", "path").distinct()
    spread = asked.mapInArrow(_spread(lengths, RANGES), "host string, path string, part long, candidate string, key long")
    hits = spread.repartition("part", F.pmod("key", F.lit(16))).mapInArrow(_probe_part(where), "host string, path string, candidate string")
    best = hits.groupBy("host", "path").agg(F.max(F.struct(F.char_length("candidate"), "candidate")).alias("best"))
    return rows.join(best, ["host", "path"], "left").select(*rows.columns, F.col("best.candidate").alias("entry"))


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in df.dtypes)


def _probe_whole(paths: list[str], lengths: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = [_mapped(p) for p in paths]
        for batch in batches:
            owner, texts = [], []
            for i, (host, path) in enumerate(zip(batch.column("host").to_pylist(), batch.column("path").to_pylist())):
                got = _candidates(host, path, lengths)
                texts += got
                owner += [i] * len(got)
            keys = np.array([digest(t) for t in texts], np.uint64)
            found = np.zeros(len(texts), bool)
            for array in arrays:
                found |= array.probe(keys, texts)
            best: list[str | None] = [None] * batch.num_rows
            for j in np.flatnonzero(found).tolist():
                if best[owner[j]] is None or len(texts[j]) > len(best[owner[j]]):
                    best[owner[j]] = texts[j]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best, pa.string())], names=[*batch.schema.names, "entry"])
    return run


def _spread(lengths: list[int], ranges: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(h, p, c) for h, p in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist()) for c in _candidates(h, p, lengths)]
            keys = np.array([digest(c) for _, _, c in rows], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()), pa.array((keys >> np.uint64(32)).astype(np.int64) * ranges >> 32),
                 pa.array([r[2] for r in rows], pa.string()), pa.array(keys.view(np.int64))], names=["host", "path", "part", "candidate", "key"])
    return run


def _probe_part(where: dict[int, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, texts = batch.column("part").to_numpy(), batch.column("candidate").to_pylist()
            keys = batch.column("key").to_numpy().view(np.uint64)
            found = np.zeros(batch.num_rows, bool)
            for p in np.unique(part).tolist():
                if p in where:
                    at = np.flatnonzero(part == p)
                    found[at] = _mapped(where[p]).probe(keys[at], [texts[i] for i in at])
            yield batch.select(["host", "path", "candidate"]).filter(pa.array(found))
    return run


def judge(pages: DataFrame, rules: list[tuple[str, str]], blocked: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, listed of every row.

    ``rules``: (string, allow or block), which come before ``blocked``, a
    DataFrame of strings (column ``entry``) that block."""
    spark = pages.sparkSession
    given = spark.createDataFrame([(t,) for t, _ in rules], "entry string")
    rows = with_host_and_path(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))).drop("url")
    by_rule = matches(rows, given).withColumnRenamed("entry", "rule")
    both = matches(by_rule, blocked).withColumnRenamed("entry", "listed")
    verdict = F.lit(None).cast("string")
    for text, said in sorted(rules, key=lambda r: r[1] == "allow"):
        verdict = F.when(F.col("rule") == text, said).otherwise(verdict)
    return both.select("page_id", "host", "path", "rule",
                       F.coalesce(verdict, F.when(F.col("listed").isNotNull(), "block").otherwise("allow")).alias("verdict"), "listed")
