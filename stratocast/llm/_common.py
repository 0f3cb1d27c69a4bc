"""Helpers that the corpus operators share: scratch tables, salted joins, a vectorised word tokeniser."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but these six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32

_P = 0x9E3779B97F4A7C15 | 1
_P_INV = pow(_P, -1, 1 << 64)


# --- scratch tables -------------------------------------------------------------------------------


_LOCAL: dict[str, str] = {}
#: While a table is written, shuffle files go when the job that made them ends, not when the driver collects its garbage; and texts travel to Python in
#: small batches, since they may be long.
_WHILE_WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}
#: Bytes up to which Spark may broadcast on its own while a table is written. It takes the size of compressed files for that of rows, and rows after an explode for those
#: before, so that what it sends through the driver is up to some hundred times as large.
OWN_BROADCAST = 256 << 10
#: Ids, as counted, up to which a table of them is broadcast.
FEW_IDS = 1_000_000


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; where it is unset a temporary one in local mode (tests), an error on a cluster."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _LOCAL.setdefault(spark.sparkContext.applicationId, "file://" + tempfile.mkdtemp(prefix="spark-"))


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table below the shared scratch folder and read it back.

    This cuts the lineage: what is lost with an executor is read again from shared storage. ``discard`` removes the table.
    """
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/stratocast-{uuid.uuid4().hex}/{name}"
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    own = min(OWN_BROADCAST, spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    meanwhile = _WHILE_WRITING | {"spark.sql.autoBroadcastJoinThreshold": str(own)}
    before = {k: spark.conf.get(k, None) for k in meanwhile}
    for k, v in meanwhile.items():
        spark.conf.set(k, v)
    try:
        writer.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``materialize`` wrote and nothing reads any more."""
    for table in tables:
        path = table.sparkSession._jvm.org.apache.hadoop.fs.Path(table.scratch_path).getParent()
        path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


# --- joins ----------------------------------------------------------------------------------------


def join_lookup(big: DataFrame, small: DataFrame, key: str, rows: int, how: str = "left", salts: int = 32, limit: int = 200_000) -> DataFrame:
    """Join a per-key table to rows whose keys may be hot.

    ``rows`` is the counted size of ``small`` (one row per key). Up to ``limit`` rows it is broadcast;
    beyond, each of its rows is replicated ``salts`` times and the big side is salted, so that a key
    with a third of all rows is spread over that many tasks; Spark, which would size it by its rows before that, may not broadcast it. Null keys match null keys.
    """
    if rows <= limit:
        left, right = big.withColumn("__k", F.col(key)), small.withColumnRenamed(key, "__k2")
        return left.join(F.broadcast(right), left["__k"].eqNullSafe(right["__k2"]), how).drop("__k", "__k2")
    left = big.withColumn("__s", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    right = small.withColumnRenamed(key, "__k2").withColumn("__s2", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right.hint("merge"), (left["__s"] == right["__s2"]) & left[key].eqNullSafe(right["__k2"]), how).drop("__s", "__s2", "__k2")


def bucket_of(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(mod))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def word_counts(texts: DataFrame, keys: str) -> DataFrame:
    """The columns ``keys`` (as a schema) of ``texts`` with the number ``n`` of words of each row's text, counted over bytes of many texts at once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, found in slices(batches):
            offsets = np.cumsum([0, *(len(t) + 1 for t in found)])
            space = _SPACE[np.frombuffer(b" ".join(found) + b" ", dtype=np.uint8)]
            ends = np.concatenate([[0, 0], np.cumsum(space[1:] & ~space[:-1])])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(np.diff(ends[offsets]).astype(np.int64))], names=[*batch.schema.names[:-1], "n"])

    names = [x.split()[0] for x in keys.split(", ")]
    return texts.select(*names, "text").mapInArrow(count, f"{keys}, n long")


# --- vectorised words -----------------------------------------------------------------------------


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element by element."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Words:
    """Word hashes of many texts at once; words are runs of bytes that ``apart`` (white space) doesn't mark.

    ``hash`` has a 64-bit hash per word, in order; ``doc`` the text's index per word; ``first`` the
    index of each text's first word (one more at the end). With ``spans``, ``start``/``end`` hold byte offsets
    in the text.
    """

    def __init__(self, texts: list[bytes], spans: bool = False, apart: np.ndarray = _SPACE):
        n = len(texts)
        lengths = np.fromiter((len(t) for t in texts), dtype=np.int64, count=n)
        offsets = np.zeros(n + 1, dtype=np.int64)
        np.cumsum(lengths + 1, out=offsets[1:])
        raw = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
        hashes, starts, ends = [], [], []
        step = 1 << 18
        at = 0
        while at < len(raw):
            to = min(len(raw), at + step)
            while to < len(raw) and not apart[raw[to - 1]]:  # a piece ends with white space
                more = np.flatnonzero(apart[raw[to : to + step]])
                to = to + int(more[0]) + 1 if len(more) else min(len(raw), to + step)
            h, s, e = _hash_piece(raw[at:to], apart)
            hashes.append(h)
            starts.append(s + at)
            ends.append(e + at)
            at = to
        self.hash = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        self.first = np.searchsorted(start, offsets)
        self.doc = np.repeat(np.arange(n), np.diff(self.first))
        if spans:
            end = np.concatenate(ends) if ends else np.zeros(0, np.int64)
            base = offsets[self.doc]
            self.start, self.end = start - base, end - base


def _hash_piece(raw: np.ndarray, apart: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Polynomial hashes of the words in a piece that ends with white space."""
    space = apart[raw]
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    if len(raw) and not space[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[0::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64), start, end
    power, inverse = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((_FOLD[raw].astype(np.uint64) + np.uint64(1)) * power[: len(raw)], out=sums[1:])
    h = (sums[end] - sums[start]) * inverse[start]
    return mix64(h + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), start, end


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(12, int(n - 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        out = []
        for base in (_P, _P_INV):
            x = np.full(size, base, dtype=np.uint64)
            x[0] = 1
            np.multiply.accumulate(x, out=x)
            out.append(x)
        _POWERS[size] = (out[0], out[1])
    return _POWERS[size]


def text_bytes(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    """UTF-8 of each text; null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x or b"" for x in column.cast(pa.large_string()).cast(pa.large_binary()).to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = 2 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of the batches with about ``most`` bytes of text at a time (one longer text makes a part alone)."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        total = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(total):
            to = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + most, "right")))
            yield batch.slice(at, to - at), text_bytes(column.slice(at, to - at))
            at = to


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` words."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = words[:n].copy()
    for i in range(1, k):
        h = mix64(h * np.uint64(0x9FB21C651E98DF25) + words[i : i + n])
    return h
