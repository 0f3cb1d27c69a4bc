"""Exact top-k search over binary codes by incremental multi-index hashing.

The distinct codes are dealt to shards; in each, codes are cut into segments of about log2(shard size) bits, and every segment has a table
from its value to the codes that have it. A query probes the values within radius a of its own in segment after segment. Once segments 0..j are
probed to radius a, and the others to a - 1, every code within distance segments * a + j has been met (otherwise the segments'
distances would add up to more). The radii grow, step by step, until the query's kth verified distance is within what is covered; only
queries that still lack it go on. Where a step would probe more values than the shard has codes, the codes themselves are verified.

Scale: equal codes are one index row with their k + 1 smallest ids, which is all that an exact answer can need of them; equal query codes are
one query. The stated query set goes to the shards in blocks of ``BLOCK`` codes (8 bytes each, so the broadcast is bounded); a task holds one shard of
``SHARD`` codes and the best of a block at a time, and sends k + 1 codes per query, which are ranked with limits before the shuffle.

Codes: the signs of projections on 64 random directions after centring (medians from a bounded sample of ``sample`` rows, directions from a fixed
seed); or any ``code`` column of the caller.

Defined cases: rows with a null id, or with a null, empty or odd-sized vector, or one with nulls, take no part; a query isn't its own neighbour; ties in
distance go to the smaller id; rows that repeat an id count once per code; with fewer than k others, all are returned; other
columns are not carried.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratocast.llm._common import materialize

BITS = 64
#: Distinct codes in one set of tables, and query codes in one broadcast.
SHARD, BLOCK = 1 << 17, 1 << 17


def sign_codes(vectors: DataFrame, sample: int = 2000, seed: int = 3) -> DataFrame:
    """(id, code) of (id, vector): a 64-bit code per row, by signs along fixed random directions."""
    rows = vectors.where(F.col("id").isNotNull() & (F.size("vector") > 0) & ~F.exists("vector", lambda x: x.isNull() | F.isnan(x)))
    usual = rows.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), "width").first()  # the width that most vectors have
    if usual is None:
        return vectors.sparkSession.createDataFrame([], "id long, code long")
    width = usual["width"]
    rows = rows.where(F.size("vector") == width)
    drawn = np.array([r["vector"] for r in rows.orderBy(F.xxhash64(F.lit(seed), F.col("id")), "id").limit(sample).select("vector").collect()], dtype=np.float64)
    directions = np.linalg.qr(np.random.default_rng(seed).standard_normal((max(width, BITS), max(width, BITS))))[0][:width, :BITS]
    middle = np.median(drawn @ directions, axis=0)

    def encode(frames):
        powers = np.uint64(1) << np.arange(BITS, dtype=np.uint64)
        for frame in frames:
            table = np.stack(frame["vector"].to_numpy()) if len(frame) else np.zeros((0, width))
            bits = (table.astype(np.float64) @ directions) > middle
            yield pd.DataFrame({"id": frame["id"].to_numpy(np.int64), "code": (bits * powers).sum(axis=1, dtype=np.uint64).view(np.int64)})

    return rows.select(F.col("id").cast("long").alias("id"), "vector").mapInPandas(encode, "id long, code long")


class Shard:
    """Segment tables over some codes."""

    def __init__(self, codes: np.ndarray, first: np.ndarray):
        self.codes, self.first = codes, first
        n = max(1, round(BITS / max(4.0, np.log2(max(2, len(codes))))))
        edges = [BITS * i // n for i in range(n + 1)]
        self.segments = []
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            value = self._value(codes, low, high - low)
            order = np.argsort(value, kind="stable")
            starts = np.concatenate([[0], np.cumsum(np.bincount(value, minlength=1 << (high - low)))])
            self.segments.append((low, high - low, order, starts))

    @staticmethod
    def _value(codes: np.ndarray, low: int, width: int) -> np.ndarray:
        return ((codes >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64)

    def nearest(self, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query index, code index, distance) of the k codes nearest to each query, by distance and first id."""
        best = [np.zeros(0, np.int64)] * 3
        kth = np.full(len(queries), BITS + 1)
        active = np.arange(len(queries))
        m = len(self.segments)
        for a in range(BITS):
            for j, (low, width, order, starts) in enumerate(self.segments):
                if not len(active):
                    return tuple(best)
                flips = _masks(width, a) if a <= width else np.zeros(0, np.int64)
                whole = len(flips) >= len(self.codes)
                step = max(1, (1 << 21) // max(1, len(self.codes) if whole else len(flips)))
                new = []
                for at in range(0, len(active), step):
                    some = active[at : at + step]
                    if whole:
                        q, c = np.repeat(some, len(self.codes)), np.tile(np.arange(len(self.codes)), len(some))
                    else:
                        values = (self._value(queries[some], low, width)[:, None] ^ flips[None, :]).reshape(-1)
                        count = starts[values + 1] - starts[values]
                        q = np.repeat(np.repeat(some, len(flips)), count)
                        c = order[np.repeat(starts[values] - np.cumsum(count) + count, count) + np.arange(len(q))]
                    d = np.bitwise_count(queries[q] ^ self.codes[c]).astype(np.int64)
                    near = d <= kth[q]
                    new.append((q[near], c[near], d[near]))
                best, kth = self._merge(best, new, kth, k)
                if whole:
                    return tuple(best)  # every code has been met
                active = active[kth[active] > m * a + j]
        return tuple(best)

    def _merge(self, best: list[np.ndarray], new: list[tuple], kth: np.ndarray, k: int) -> tuple[list[np.ndarray], np.ndarray]:
        q, c, d = (np.concatenate([best[i], *[x[i] for x in new]]) for i in range(3))
        order = np.lexsort((c, self.first[c], d, q))
        q, c, d = q[order], c[order], d[order]
        once = np.ones(len(q), dtype=bool)
        once[1:] = (q[1:] != q[:-1]) | (c[1:] != c[:-1])
        q, c, d = q[once], c[once], d[once]
        begin = np.searchsorted(q, np.arange(len(kth)))
        rank = np.arange(len(q)) - begin[q]
        keep = rank < k
        last = rank == k - 1
        kth = kth.copy()
        kth[q[last]] = d[last]
        return [q[keep], c[keep], d[keep]], kth


_MASKS: dict[tuple[int, int], np.ndarray] = {}


def _masks(width: int, weight: int) -> np.ndarray:
    """Values of ``width`` bits with ``weight`` of them set."""
    if (width, weight) not in _MASKS:
        out = np.zeros(1, np.int64)
        for _ in range(weight):
            out = np.unique((out[:, None] | (1 << np.arange(width))[None, :]).reshape(-1))
        _MASKS[width, weight] = out[np.bitwise_count(out.astype(np.uint64)) == weight]
    return _MASKS[width, weight]


def top_k(codes: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, neighbor_id, distance, rank) of every row of ``queries`` (id, code) among the rows of ``codes`` (id, code)."""
    # The k + 1 smallest ids of a code: rows are limited before the shuffle, so that a code with very many rows is no heavier than others.
    smallest = codes.distinct().withColumn("rank", F.row_number().over(W.partitionBy("code").orderBy("id"))).where(F.col("rank") <= k + 1)
    index = materialize(smallest.groupBy("code").agg(F.array_sort(F.collect_list("id")).alias("ids")), "index")
    asked = queries.select(F.col("code").alias("query")).distinct()
    n = asked.count()
    blocks = max(1, -(-2 * n // BLOCK)) if n > BLOCK else 1  # hashed blocks stay below BLOCK
    asked = materialize(asked.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int")), "queries")
    # Dealt once, however many blocks of queries come.
    dealt = materialize(index.repartition(max(codes.sparkSession.sparkContext.defaultParallelism, -(-index.count() // SHARD)), "code"), "dealt")
    done: DataFrame | None = None
    for b in range(blocks):
        wanted = np.array([r["query"] for r in asked.where(F.col("block") == b).select("query").collect()], dtype=np.int64)
        shared = codes.sparkSession.sparkContext.broadcast(wanted)
        found = dealt.mapInPandas(_searcher(shared, k + 1), "query long, d int, ids array<long>")
        order = W.partitionBy("query").orderBy("d", F.col("ids")[0])
        found = materialize(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k + 1).drop("rank"), "nearest")
        done = found if done is None else done.union(found)
    whose = queries.select(F.col("id").alias("query_id"), F.col("code").alias("query")).distinct()
    rows = whose.join(done.select("query", "d", F.explode("ids").alias("neighbor_id")), "query").where("neighbor_id != query_id")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("d", "neighbor_id"))
    return rows.select("query_id", "neighbor_id", F.col("d").alias("distance"), rank.alias("rank")).where(F.col("rank") <= k)


def _searcher(shared, k: int):
    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        queries = shared.value.view(np.uint64)
        held: list[pd.DataFrame] = []
        rows = 0
        for frame in itertools.chain(frames, [None]):
            if frame is not None and len(frame):
                held.append(frame)
                rows += len(frame)
            if rows and (frame is None or rows >= SHARD):
                part = pd.concat(held, ignore_index=True)
                held, rows = [], 0
                shard = Shard(part["code"].to_numpy(np.int64).view(np.uint64), np.array([x[0] for x in part["ids"]], dtype=np.int64))
                for at in range(0, len(queries), 4096):
                    q, c, d = shard.nearest(queries[at : at + 4096], k)
                    yield pd.DataFrame({"query": queries[at + q].view(np.int64), "d": d.astype(np.int32), "ids": part["ids"].iloc[c].to_list()})

    return search


def op10_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    codes = materialize(sign_codes(vectors), "codes")
    queries = codes.where(F.col("id") % 20 == 0)
    return top_k(codes, queries)
