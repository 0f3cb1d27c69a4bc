"""Ranked lexical search for many queries at once: LEMP-style buckets of impact vectors by length.

A document is the vector of its impacts, a term's weight times its saturated frequency; an item is the vector of its terms' counts; a score is their
product. Terms that no item has add nothing, so a document's vector holds the items' terms alone. Vectors are ordered by length and cut into
buckets. For an item whose k-th best score so far is ``least``:

* a bucket is passed over if its longest vector times the item's is below ``least`` (Cauchy-Schwarz), and so is a vector within it;
* within a bucket the item's ``FOCUS`` most telling coordinates are multiplied out, and what the rest can add is bounded by the product of the rests' lengths;
* what may still reach ``least`` is scored over all coordinates in 64-bit integers. Bounds are doubles with room for rounding, so nothing is lost.

Scale: items go in blocks of about ``BLOCK`` terms (by a hash of their terms; items with the same terms are searched once), and only a block's terms, counts and current k-th
scores are sent to tasks. Documents are cut into words once per block, into a table of (row, terms, frequencies, size); from it come the numbers of documents per
term, pre-aggregated. The vectors are dealt by ranges of their length, longest first, and searched in ``ROUNDS``: each starts from the k-th scores of those
before, and rows that are too short for all items that are left are pruned at the scan. A task sends at most k rows an item (those with its k-th score or more), and the
k best of a round are found by a window over them. A third of all documents under one length, text or id changes nothing, since ranges of equal lengths are dealt by a
hash of the row too.

Words are compared by 64-bit hashes. Defined cases: null or wordless texts have no terms: such documents don't count and are never found, such items
have no rows; every row of ``documents`` is a document of its own, so repeated rows can fill several ranks (null ids come last among equal scores); every
row of the items is an item of its own; empty tables give an empty result; other columns aren't read; texts are never cut.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratocast.llm._common import Words, discard, materialize, mix64, slices

#: Terms (distinct ones of each distinct item) that a block holds, about.
BLOCK = 1 << 20
#: Vectors of a bucket.
BUCKET = 2048
FOCUS = 6
#: Shares of the vectors, longest first, after which the k-th scores are brought up to date.
ROUNDS = (0.02, 0.2, 1.0)

#: Bytes that are no part of a term: ASCII but digits and letters.
APART = np.zeros(256, dtype=bool)
APART[:128] = [not chr(i).isalnum() for i in range(128)]


def _bags(docs: DataFrame, schema: str, of: np.ndarray | None = None) -> DataFrame:
    """``docs`` (columns but ``text``) with ``terms`` (hashes; with ``of``, places in that sorted array, others left out), ``counts`` and ``size`` (all terms)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            words = Words(texts, apart=APART)
            hashes, doc = words.hash, words.doc
            if of is not None:
                at = np.minimum(np.searchsorted(of, hashes), len(of) - 1)
                held = of[at] == hashes
                hashes, doc = at[held].astype(np.uint64), doc[held]
            order = np.lexsort((hashes, doc))
            hashes, doc = hashes[order], doc[order]
            new = np.ones(len(doc), dtype=bool)
            new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
            first = np.flatnonzero(new)
            counts = np.diff(np.append(first, len(doc)))
            offsets = pa.array(np.searchsorted(doc[first], np.arange(len(texts) + 1)).astype(np.int32))
            terms = hashes[first].view(np.int64) if of is None else hashes[first].astype(np.int32)
            columns = [part.column(i) for i, n in enumerate(part.schema.names) if n != "text"]
            names = [n for n in part.schema.names if n != "text"]
            lists = [pa.ListArray.from_arrays(offsets, pa.array(terms)), pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.int32)))]
            yield pa.RecordBatch.from_arrays([*columns, *lists, pa.array(np.diff(words.first))], names=[*names, "terms", "counts", "size"])

    return docs.mapInArrow(cut, schema)


class Block:
    """Items as vectors over the sorted terms that they hold, with what the search knows of them."""

    def __init__(self, queries: list[tuple[int, np.ndarray, np.ndarray]]):
        self.query = np.array([q for q, _, _ in queries], dtype=np.int64)
        self.vocabulary = np.unique(np.concatenate([t for _, t, _ in queries]))
        self.first = np.concatenate([[0], np.cumsum([len(t) for _, t, _ in queries])])
        self.term = np.searchsorted(self.vocabulary, np.concatenate([t for _, t, _ in queries])).astype(np.int32)
        self.count = np.concatenate([c for _, _, c in queries]).astype(np.int64)
        self.norm = np.sqrt(np.add.reduceat((self.count**2).astype(np.float64), self.first[:-1]))

    def weigh(self, frequency: np.ndarray, documents: int, terms: int) -> None:
        """Weights of the terms, and each item's most telling terms."""
        self.weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(f) + 1))) for f in frequency], dtype=np.int64)
        self.documents, self.terms = documents, terms
        self.focus = np.full((len(self.query), FOCUS), -1, dtype=np.int32)
        self.focus_count = np.zeros((len(self.query), FOCUS), dtype=np.int64)
        for i in range(len(self.query)):
            t, c = self.term[self.first[i] : self.first[i + 1]], self.count[self.first[i] : self.first[i + 1]]
            best = np.argsort(-(self.weight[t] * c), kind="stable")[:FOCUS]
            self.focus[i, : len(best)], self.focus_count[i, : len(best)] = t[best], c[best]
        rest = self.norm**2 - (self.focus_count**2).sum(axis=1)
        self.rest = np.sqrt(np.maximum(rest, 0))

    def impacts(self, doc: np.ndarray, term: np.ndarray, count: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Integer impacts of documents' terms: weight times ((10^9 tf) div (1000 tf + 8 m))."""
        m = 100 - 75 + (75 * size * self.documents) // self.terms
        return self.weight[term] * ((1_000_000_000 * count) // (1000 * count + 8 * m[doc]))


def _flat(part: pa.RecordBatch | pa.Table, name: str, dtype: type) -> tuple[np.ndarray, np.ndarray]:
    column = part.column(name)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype), lengths


def _search_bucket(block: Block, least: np.ndarray, k: int, ids: np.ndarray, terms: np.ndarray, lengths: np.ndarray, impact: np.ndarray, norm: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(item, documents, scores) of a bucket that can be among the k best; raises ``least`` to the k-th best as it goes."""
    doc = np.repeat(np.arange(len(lengths)), lengths)
    room = 1 + 1e-9
    alive = np.flatnonzero(block.norm * norm.max(initial=0) * room >= least)
    used = np.unique(block.focus[alive])
    used = used[used >= 0]
    # Columns of the focus terms, dense within the bucket.
    column = np.full(len(block.vocabulary), -1, dtype=np.int32)
    column[used] = np.arange(len(used))
    order = np.argsort(terms, kind="stable")  # postings of the bucket
    by_term, by_doc, by_impact = terms[order], doc[order], impact[order]
    start, stop = np.searchsorted(by_term, used), np.searchsorted(by_term, used, "right")
    square = norm**2
    for i in alive:
        partial = np.zeros(len(lengths), dtype=np.float64)
        seen = np.zeros(len(lengths), dtype=np.float64)
        for t, c in zip(block.focus[i], block.focus_count[i], strict=True):
            if t >= 0:
                a, b = start[column[t]], stop[column[t]]
                partial[by_doc[a:b]] += c * by_impact[a:b]
                seen[by_doc[a:b]] += by_impact[a:b].astype(np.float64) ** 2
        bound = (partial + block.rest[i] * np.sqrt(np.maximum(square - seen, 0) + square * 1e-12)) * room
        found = np.flatnonzero((bound >= least[i]) & (norm * block.norm[i] * room >= least[i]) & (norm > 0))
        if not len(found):
            continue
        # Exact scores of the survivors, over all their coordinates.
        own_t, own_c = block.term[block.first[i] : block.first[i + 1]], block.count[block.first[i] : block.first[i + 1]]
        begin = np.concatenate([[0], np.cumsum(lengths)])
        at = np.repeat(begin[found] - np.concatenate([[0], np.cumsum(lengths[found])[:-1]]), lengths[found]) + np.arange(lengths[found].sum())
        place = np.minimum(np.searchsorted(own_t, terms[at]), len(own_t) - 1)
        value = np.where(own_t[place] == terms[at], own_c[place] * impact[at], 0)
        score = np.zeros(len(found), dtype=np.int64)
        np.add.at(score, np.repeat(np.arange(len(found)), lengths[found]), value)
        good = (score >= least[i]) & (score > 0)
        found, score = found[good], score[good]
        if len(score) > k:  # the k-th best of this bucket alone bounds the k-th best of all; equal scores stay
            kth = np.partition(score, len(score) - k)[len(score) - k]
            least[i] = max(least[i], kth)
            found, score = found[score >= kth], score[score >= kth]
            if len(score) > k:  # of equal scores the smallest ids
                top = np.lexsort((ids[found], -score))[:k]
                found, score = found[top], score[top]
        if len(score) == k:
            least[i] = max(least[i], score.min())
        yield int(i), found, score


_LAST = np.iinfo(np.int64).max


def _searched(vectors: DataFrame, shared, k: int) -> DataFrame:
    """(query, doc_id, score) of a part of the vectors: for each item the task's k best, none below its k-th score so far."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, known = shared.value
        least = known.copy()
        best: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, BUCKET):
                part = batch.slice(at, BUCKET)
                valid = part.column("doc_id").is_valid().to_numpy(zero_copy_only=False)
                ids = part.column("doc_id").fill_null(_LAST).to_numpy(zero_copy_only=False)
                terms, lengths = _flat(part, "terms", np.int64)
                counts, _ = _flat(part, "counts", np.int64)
                size = part.column("size").to_numpy(zero_copy_only=False).astype(np.int64)
                doc = np.repeat(np.arange(len(lengths)), lengths)
                impact = block.impacts(doc, terms, counts, size)
                norm = part.column("norm").to_numpy(zero_copy_only=False)
                for i, found, score in _search_bucket(block, least, k, ids, terms, lengths, impact, norm):
                    if i in best:
                        a, b, c = best[i]
                        have = np.concatenate([a, ids[found]]), np.concatenate([b, score]), np.concatenate([c, valid[found]])
                    else:
                        have = ids[found], score, valid[found]
                    top = np.lexsort((have[0], -have[1]))[:k]
                    best[i] = tuple(x[top] for x in have)
                    if len(top) == k:
                        least[i] = max(least[i], best[i][1][-1])
        for i, (ids, score, valid) in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), block.query[i])), pa.array(ids, mask=~valid), pa.array(score)], names=["query", "doc_id", "score"])

    return vectors.select("doc_id", "terms", "counts", "size", "norm").mapInArrow(search, "query long, doc_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _with_norm(bags: DataFrame, shared) -> DataFrame:
    """Bags with the length of their vector of impacts."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for batch in batches:
            terms, lengths = _flat(batch, "terms", np.int64)
            counts, _ = _flat(batch, "counts", np.int64)
            doc = np.repeat(np.arange(len(lengths)), lengths)
            impact = block.impacts(doc, terms, counts, batch.column("size").to_numpy(zero_copy_only=False).astype(np.int64))
            square = np.bincount(doc, weights=impact.astype(np.float64) ** 2, minlength=len(lengths))
            yield batch.append_column("norm", pa.array(np.sqrt(square)))

    return bags.mapInArrow(measure, "doc_id long, terms array<int>, counts array<int>, size long, norm double")


def search_block(docs: DataFrame, block: Block, k: int) -> DataFrame:
    """The k best documents (doc_id, text) for each query of a block: (query, doc_id, score, rank)."""
    spark = docs.sparkSession
    bags = materialize(_bags(docs, "doc_id long, terms array<int>, counts array<int>, size long", block.vocabulary), "bags")
    all_docs, all_terms = bags.where("size > 0").agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    frequency = np.zeros(len(block.vocabulary), dtype=np.int64)
    for term, n in bags.select(F.explode("terms").alias("term")).groupBy("term").count().toLocalIterator():  # one row a term of the block
        frequency[term] = n
    block.weigh(frequency, all_docs, max(all_terms, 1))
    shared = spark.sparkContext.broadcast(block)
    order = [F.desc("norm"), F.xxhash64("doc_id", "size", "terms")]
    vectors = _with_norm(bags.where(F.size("terms") > 0), shared).where("norm > 0")
    vectors = materialize(vectors.repartitionByRange(*order).sortWithinPartitions(F.desc("norm")), "vectors")
    cuts = [vectors.agg(F.percentile_approx("norm", 1 - r, 1000)).first()[0] or 0.0 for r in ROUNDS[:-1]]
    rounds, above = [], None
    least = np.ones(len(block.query), dtype=np.int64)
    for cut in [*cuts, 0.0]:
        some = vectors.where(F.col("norm") >= cut) if above is None else vectors.where((F.col("norm") >= cut) & (F.col("norm") < above))
        above = cut if above is None else min(above, cut)
        # Below this length no vector reaches any item's k-th score.
        some = some.where(F.col("norm") >= float((least / block.norm).min() * (1 - 1e-9)))
        known = spark.sparkContext.broadcast((block, least.copy()))
        rounds.append(materialize(_searched(some, known, k), "found"))
        so_far = rounds[0]
        for more in rounds[1:]:
            so_far = so_far.unionByName(more)
        place = {q: i for i, q in enumerate(block.query.tolist())}
        for r in _best(so_far, k).where(F.col("rank") == k).select("query", "score").toLocalIterator():  # one row a query of the block
            least[place[r["query"]]] = max(least[place[r["query"]]], r["score"])
    best = materialize(_best(so_far, k), "best")
    discard(bags, vectors, *rounds)
    return best


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The k highest-scoring documents (doc_id, text) with a score above 0 for each of ``items`` (item_id, text): item_id, rank, doc_id, score."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bags = _bags(items.select("item_id", "text"), f"item_id {items.schema['item_id'].dataType.simpleString()}, terms array<long>, counts array<int>, size long").where("size > 0")
    bags = materialize(bags.withColumn("query", F.xxhash64(F.array_sort(F.arrays_zip("terms", "counts")))), "items")
    queries = bags.groupBy("query").agg(F.first("terms").alias("terms"), F.first("counts").alias("counts"))
    queries = materialize(queries.withColumn("size", F.size("terms")), "queries")
    blocks = math.ceil((queries.agg(F.sum("size")).first()[0] or 0) / BLOCK)
    found: DataFrame | None = None
    for b in range(blocks):
        own = queries.where(F.pmod(F.xxhash64("query", F.lit(13)), F.lit(blocks)) == b).toLocalIterator()  # about BLOCK terms
        rows = [(r["query"], np.array(r["terms"], dtype=np.int64).view(np.uint64), np.array(r["counts"], dtype=np.int64)) for r in own]
        if rows:
            best = search_block(docs, Block(rows), k)
            found = best if found is None else found.unionByName(best)
    if found is None:
        return docs.sparkSession.createDataFrame([], f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long")
    return bags.select("item_id", "query").join(found, "query").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def op13_lemp(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return rank_documents(docs.select("doc_id", "text"), items.select("item_id", "text"))


ORACLE_SQL = r"""
    WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
    items AS (SELECT row_number() OVER () AS iid, item_id, text FROM benchmark),
    doc_terms AS (
      SELECT rid, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
    item_terms AS (
      SELECT iid, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM items),
    sizes AS (SELECT rid, count(*)::BIGINT AS n FROM doc_terms GROUP BY rid),
    totals AS (SELECT count(*)::BIGINT AS docs_n, sum(n)::BIGINT AS terms_n FROM sizes),
    tf AS (SELECT rid, doc_id, term, count(*)::BIGINT AS tf FROM doc_terms WHERE term IN (SELECT term FROM item_terms) GROUP BY ALL),
    weights AS (SELECT term, floor(1000 * ln((2 * docs_n + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tf, totals GROUP BY term, docs_n),
    impacts AS (
      SELECT rid, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * docs_n) // terms_n)))) AS impact
      FROM tf JOIN sizes USING (rid) JOIN weights USING (term), totals),
    scores AS (
      SELECT iid, item_id, rid, doc_id, sum(impact)::BIGINT AS score FROM item_terms JOIN impacts USING (term) GROUP BY ALL)
    SELECT item_id, rank, doc_id, score FROM (
      SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM scores WHERE score > 0)
    WHERE rank <= 10"""
