"""Near-duplicate documents by SuperMinHash, banding, exact verification and union of links.

A document's set holds its distinct k-word shingles. SuperMinHash gives every element one value per permutation rank, so that the ranks
of an element are correlated and a signature varies less than independent min-hashes would; ranks are drawn one after another,
and a set is finished as soon as no later rank can lower any of its values. Signatures are cut into bands; documents that
share a band are candidates. Equal sets are collapsed first, so that copies count once. Candidates are verified on
their full sets; verified links are merged by ``link_buckets``.

With 36 bands of 7 rows a pair at similarity 0.85 shares no band with probability 9e-7. Buckets of 32 members or more are dealt anew by an exact
prefix filter on the rarest shingles.

Scale: one pass over the texts for signatures; a second reads those of candidates. No pair of copies is formed, and no bucket's pairs are
all emitted; leaders with many pairs are salted. Tables between the steps are written to shared storage.

Defined cases: null texts, and texts without words, have an empty set and link with nothing; a text of fewer than k words is one shingle;
rows that repeat an id are one document and share all their rows' links; rows without an id link with nothing, are kept and have no
component; an empty table gives an empty result; other columns pass unchanged in ``keep_one``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratocast.llm._common import FEW_IDS, Words, join_lookup, materialize, mix64, shingle_hashes, slices
from stratocast.llm.components import link_buckets

BANDS, ROWS = 36, 7
SIZE = BANDS * ROWS  # at most 256: ranks are bytes
#: Elements whose ranks are drawn at a time.
CHUNK = 20_000
#: Pairs of one leader in one task.
PAIRS = 64
#: Members from which a bucket is large.
LARGE = 32


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; of the whole sequence if it is shorter."""
    if 0 < len(words) < k:
        return mix64(shingle_hashes(words, len(words)) + np.uint64(len(words)))
    return np.unique(shingle_hashes(words, k))


def super_minhash(sets: list[np.ndarray], size: int = SIZE) -> np.ndarray:
    """Signatures (one row per set); values are rank * 2^32 + fraction."""
    out = np.full((len(sets), size), np.int64(size) << 32, dtype=np.int64)
    at = 0
    while at < len(sets):
        to, n = at, 0
        while to < len(sets) and (to == at or n + len(sets[to]) <= CHUNK):
            n += len(sets[to])
            to += 1
        # A longer set is finished in parts: minima of parts are minima of the whole.
        for part in range(0, max(n, 1), CHUNK):
            piece = sets[at:to] if to > at + 1 else [sets[at][part : part + CHUNK]]
            _lower(out[at:to], piece, size)
        at = to
    return out


def _lower(signatures: np.ndarray, sets: list[np.ndarray], size: int) -> None:
    element = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    ranks = np.empty((len(element), size), dtype=np.uint8)
    ranks[:] = np.arange(size, dtype=np.uint8)
    row = np.arange(len(element))
    flat = signatures.reshape(-1)
    for j in range(size):
        if not len(row):
            break
        x = mix64(element[row] + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        k = j + (((x & np.uint64(0xFFFFFFFF)) * np.uint64(size - j)) >> np.uint64(32)).astype(np.int64)
        chosen = ranks[row, k]
        ranks[row, k] = ranks[row, j]
        np.minimum.at(flat, owner[row] * size + chosen, (np.int64(j) << 32) + (x >> np.uint64(32)).astype(np.int64))
        if j < 2 or j % 2 == 0 or j > 8:
            open_sets = signatures.max(axis=1) >= (np.int64(j + 1) << 32)
            row = row[open_sets[owner[row]]]


def sketches(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n_shingles, k1, k2, bands): size, fingerprint and band hashes of every document's set."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mix64(np.arange(1, BANDS + 1, dtype=np.uint64))
        for batch, texts in slices(batches):
            w = Words(texts)
            sets = [shingle_set(w.hash[a:b], k) for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
            signatures = super_minhash(sets).view(np.uint64).reshape(len(sets), BANDS, ROWS)
            h = np.broadcast_to(salt, signatures.shape[:2]).copy()
            for r in range(ROWS):
                h = mix64(h * np.uint64(0x9FB21C651E98DF25) + signatures[:, :, r])
            mixed = [mix64(s) for s in sets]
            keys = [[int(x.sum(dtype=np.uint64).view(np.int64)) for x in mixed], [int(np.bitwise_xor.reduce(mix64(x + np.uint64(1))).view(np.int64)) if len(x) else 0 for x in mixed]]
            size = np.array([len(s) for s in sets], dtype=np.int64)
            bands = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.where(size > 0, BANDS, 0))]).astype(np.int32)), pa.array(h[size > 0].view(np.int64).reshape(-1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), *[pa.array(x, pa.int64()) for x in keys], bands], names=["doc_id", "n_shingles", "k1", "k2", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(sketch, "doc_id long, n_shingles long, k1 long, k2 long, bands array<long>")


def meet(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Rows of ``pairs`` (a, b, ...) with the text of b, each part of an a's rows after one row (b null) with the text of a.

    Texts meet by the pair's first document: its text comes once per ``PAIRS`` pairs, so that one with very many pairs is spread.
    """
    extra = [c for c in pairs.columns if c not in ("a", "b")]
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / PAIRS).cast("int").alias("parts"))
    empty = [F.lit(None).cast(dict(pairs.dtypes)[c]).alias(c) for c in extra]
    heads = many.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).join(texts, F.col("a") == texts["doc_id"]).select("a", "part", F.lit(None).cast("long").alias("b"), "text", *empty)
    tails = pairs.join(many, "a").withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int")).join(texts, F.col("b") == texts["doc_id"]).select("a", "part", "b", "text", *extra)
    return heads.union(tails).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())


def verified(met: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Those distinct pairs (a, b) of leaders and members whose full sets have 100 * intersection >= percent * union."""
    pairs = met.select(F.least("leader", "id").alias("a"), F.greatest("leader", "id").alias("b")).distinct()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads, led = [], None
        for batch, found in slices(batches):
            w = Words(found)
            a, part, b = (batch.column(i).to_pylist() for i in range(3))
            left, right = [], []
            for i, other in enumerate(b):
                own = shingle_set(w.hash[w.first[i] : w.first[i + 1]], k)
                if other is None:  # an id has as many heads as different texts
                    heads, led = heads if led == (a[i], part[i]) else [], (a[i], part[i])
                    if not any(np.array_equal(own, head) for head in heads):
                        heads.append(own)
                    continue
                for head in heads:
                    if 100 * min(len(own), len(head)) < percent * max(len(own), len(head)):
                        continue
                    both = len(np.intersect1d(head, own, assume_unique=True))
                    if 100 * both >= percent * (len(own) + len(head) - both) > 0:
                        left.append(a[i])
                        right.append(other)
                        break
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return meet(pairs, texts).mapInArrow(compare, "a long, b long")


def _rare_first(crowded: DataFrame, k: int, percent: int) -> DataFrame:
    """(bucket, id, n, place) by prefix filter: each set's rarest shingles, so many that two similar enough sets have one of them in common.

    At least percent of each set must be common, so all but as many, and one more, in the order of their frequency suffice. An edited copy's rare shingles are its
    edits: copies with too many of these meet nothing but what shares an edit, and those with few meet at the origin's shingles.
    """

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, set()
        for batch, found in slices(batches):
            w = Words(found)
            sets = [shingle_set(w.hash[a:b], k) for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
            which = np.array([s.sum(dtype=np.uint64) for s in sets], dtype=np.uint64).view(np.int64)
            for i, (x, own) in enumerate(zip(batch.column(0).to_pylist(), which.tolist(), strict=True)):
                if x != last:
                    last, seen = x, set()
                if own in seen:  # a repeated row's shingles count once
                    sets[i] = sets[i][:0]
                seen.add(own)
            size = np.array([len(s) for s in sets], dtype=np.int64)
            owner = np.repeat(np.arange(len(sets)), size)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner)), pa.array(which[owner]), pa.array(size[owner]), pa.array(np.concatenate(sets).view(np.int64))], names=["id", "which", "n", "h"])

    rows = crowded.select("doc_id", "text").repartition("doc_id").sortWithinPartitions("doc_id").mapInArrow(shingles, "id long, which long, n long, h long")
    common = rows.groupBy("h").agg(F.count("*").alias("df"), F.min("id").alias("low"), F.max("id").alias("high"))
    order = F.row_number().over(W.partitionBy("id", "which").orderBy("df", "h"))
    prefix = rows.join(common, "h").withColumn("r", order).where(f"r <= n - ceil({percent} * n / 100) + 1 AND low != high")
    return prefix.select(F.xxhash64("h").alias("bucket"), "id", "n", (F.col("r") - 1).cast("long").alias("place")).distinct()


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept."""
    sketch = materialize(sketches(docs, k), "sketches")
    full = sketch.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = materialize(full.groupBy("k1", "k2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "classes")
    # An id with several texts joins their classes.
    kind = F.xxhash64("k1", "k2", "n_shingles")
    several = full.groupBy("doc_id").agg(F.min(kind).alias("low"), F.max(kind).alias("high")).where("low != high").select("doc_id")
    reps = classes.select(F.col("rep").alias("doc_id")).union(several).distinct()
    banded = full.join(reps, "doc_id", "left_semi").select("doc_id", F.posexplode("bands").alias("band", "h")).select(F.col("h").alias("bucket"), F.col("doc_id").alias("id"))
    shared = banded.groupBy("bucket").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low != high").select("bucket")
    members = materialize(banded.join(shared, "bucket").distinct(), "members")
    size = members.groupBy("bucket").agg(F.count("*").alias("size"))
    members = materialize(members.join(size, "bucket"), "sized")
    wanted = materialize(members.select(F.col("id").alias("doc_id")).distinct(), "candidates")
    few = wanted.count() <= FEW_IDS
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(wanted) if few else wanted.hint("merge"), "doc_id", "left_semi")
    texts = materialize(texts, "texts")
    # Large buckets are dealt anew, by an exact filter over all their members.
    crowd = materialize(members.where(F.col("size") >= LARGE).select(F.col("id").alias("doc_id")).distinct(), "crowd")
    members = members.withColumns({"n": F.lit(0).cast("long"), "place": F.lit(-1).cast("long")})
    if crowd.take(1):
        prefix = _rare_first(texts.join(crowd, "doc_id", "left_semi"), k, percent)
        members = materialize(members.where(F.col("size") < LARGE).select("bucket", "id", "n", "place").union(prefix), "dealt")
        size = members.groupBy("bucket").agg(F.count("*").alias("size"))
        members = members.join(size.where("size > 1"), "bucket")
    # The origin of a group shares most buckets, so it leads, and gathers the group at once.
    central = members.groupBy("id").agg(F.sum(F.col("size") - 1).alias("central"))
    members = materialize(members.join(central, "id").select("bucket", "id", "central", "n", "place"), "central")
    # At the first shingle that two sets have in common, what follows in both bounds what they share.
    possible = f"place < 0 or {100 + percent} * least(n - place, leader_n - leader_place) >= {percent} * (n + leader_n)"
    labels, _ = link_buckets(members, lambda met: verified(met, texts, k, percent), possible=possible, first="-central", small=8)
    # Ids with several texts join their classes: every class is labelled through its smallest id, then ids through their classes.
    by_class = classes.join(labels, F.col("rep") == labels["id"], "left").select("k1", "k2", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    by_class = materialize(by_class.withColumn("key", F.xxhash64("k1", "k2", "n_shingles")).select("key", "component_id"), "class_components")
    rows = sketch.select("doc_id", "n_shingles", F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.xxhash64("k1", "k2", "n_shingles")).alias("key"))
    out = join_lookup(rows, by_class, "key", by_class.count())
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without those that are near-duplicates of one with a smaller id."""
    found = near_duplicates(docs, k, percent)
    dropped = materialize(found.where(~F.col("kept")).select("doc_id").distinct(), "dropped")
    few = dropped.count() <= FEW_IDS
    return docs.join(F.broadcast(dropped) if few else dropped.hint("merge"), docs["doc_id"].eqNullSafe(dropped["doc_id"]), "left_anti")


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs, k=3, percent=85)
