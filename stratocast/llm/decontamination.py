"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

An alignment scores 2 a matched word, -1 a word replaced, -1 a word put in or left out, all local; its score over that of a perfect copy is ``similarity``. A document at or above
``threshold`` with an item is contaminated.

Seeds are pairs of neighbouring words of an item, found in a document side by side or with one word between. An alignment that scores T with an item of m words is at most 3m - T words wide, and at
least (2T - m - 3) / 3 of its pairs of matches are such seeds: a pair that is none costs two points if its words are neighbours in the item, and else a point and a word of the item. So a place of a
document is aligned if that many seeds of an item lie within that many words, and has enough of the item's words; pieces twice as wide, each beginning one width after the last, hold every
alignment that can reach the threshold. What is found is what Smith-Waterman over whole texts finds at or above it, for thresholds from 0.5 on, however a copy is spread or edited.
All pairs of an item are seeds, rare or not, since with rare ones alone edited copies would be lost; it is their number in one place that keeps frequent phrases from being aligned.

Scale: the items are a stated query set. While their words number ``limit`` at most, their seeds travel to the documents, and nothing of the documents
is shuffled; beyond that, seeds and documents' pairs meet in a shuffle join. Documents' texts are read once. A batch of alignments holds ``CELLS`` words or one piece.

Defined cases: null and empty texts align with nothing; items of three words or fewer are found only whole; items without
words match nothing; items with equal texts are found separately; rows that repeat are found each; no items or no documents give an empty result; texts of any length are searched whole; other
columns pass unchanged in ``drop_contaminated``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratocast.llm._common import FEW_IDS, Words, materialize, mix64, shingle_hashes, slices

#: Items of as few words are found only whole.
SHORT = 3
MATCH, MISMATCH, GAP = 2.0, -1.0, -1.0
#: Items' words up to which their seeds are broadcast (16 bytes each).
LIMIT = 2_000_000
#: Words of the pieces that are aligned together.
CELLS = 1 << 19
#: ASCII characters other than letters and digits become spaces.
FOLD = bytes(c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256))


def _words(texts: list[bytes]) -> Words:
    """Words without case and ASCII punctuation, so that shouted or decorated copies align."""
    return Words([x.decode("utf-8", "replace").lower().encode().translate(FOLD) for x in texts])


_WHOLE = [np.uint64(0x51ED270B7A3C5F1D * (k + 1) & (1 << 64) - 1) for k in range(SHORT + 1)]


def _pairs(words: np.ndarray, apart: int) -> np.ndarray:
    """Hashes of each word with the one ``apart`` words on, as of neighbours."""
    if len(words) <= apart:
        return np.zeros(0, np.uint64)
    return mix64(mix64(words[:-apart]) * np.uint64(0x9FB21C651E98DF25) + words[apart:])


def _item_seeds(words: np.ndarray) -> np.ndarray:
    """Hashes of an item's pairs of neighbours, or of a short item as a whole."""
    if 0 < len(words) <= SHORT:
        return shingle_hashes(words, len(words)) ^ _WHOLE[len(words)]
    return _pairs(words, 1)


def bounds(size: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """For items of ``size`` words: how many seeds an alignment that reaches the threshold has, and how many words it covers at most."""
    score = MATCH * threshold * size
    need = np.maximum(1, np.ceil((2 * score - size - 3) / 3 - 1e-9)).astype(np.int64)
    span = np.floor(3 * size - score + 1e-9).astype(np.int64)
    return np.where(size <= SHORT, 1, need), np.where(size <= SHORT, size, np.maximum(span, size))


def item_words(items: DataFrame) -> DataFrame:
    """(item_id, words array of hashes, grams array of hashes)."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            w = _words(texts)
            words = [w.hash[a:b] for a, b in zip(w.first[:-1], w.first[1:], strict=True)]
            as_lists = [pa.array([x.view(np.int64).tolist() for x in y], pa.list_(pa.int64())) for y in (words, [_item_seeds(x) for x in words])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *as_lists], names=["item_id", "words", "grams"])

    return items.select(F.col("item_id").cast("long").alias("item_id"), "text").mapInArrow(hashed, "item_id long, words array<long>, grams array<long>")


class _Filter:
    """Sets aside, by low bits, nearly all hashes that are not among the wanted ones."""

    def __init__(self, wanted: np.ndarray):
        self.mask = np.uint64((1 << max(16, int(len(wanted)).bit_length() + 5)) - 1)
        self.bits = np.zeros(int(self.mask) + 1, dtype=bool)
        self.bits[wanted & self.mask] = True

    def maybe(self, hashes: np.ndarray) -> np.ndarray:
        return self.bits[hashes & self.mask]


def _doc_seeds(w: Words, short: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes that can be seeds and their places: words side by side, words with one between, and runs as long as the short items are."""
    hashes, places = [], []
    for apart in (1, 2):
        at = np.flatnonzero(w.doc[:-apart] == w.doc[apart:]) if len(w.doc) > apart else np.zeros(0, np.int64)
        hashes.append(_pairs(w.hash, apart)[at])
        places.append(at)
    for k in short:
        whole = shingle_hashes(w.hash, k) ^ _WHOLE[k]
        at = np.flatnonzero(w.doc[: len(whole)] == w.doc[k - 1 :]) if len(whole) else np.zeros(0, np.int64)
        hashes.append(whole[at])
        places.append(at)
    return np.concatenate(hashes), np.concatenate(places)


def seeds(items: DataFrame) -> DataFrame:
    """(item_id, place, gram): every seed of every item."""
    return items.select("item_id", F.posexplode("grams").alias("place", "gram"))


def align(passages: np.ndarray, widths: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Best local alignment score of an item with each passage (rows, padded after their widths)."""
    n, width = passages.shape
    steps = -GAP * np.arange(1, width + 1)
    live = np.arange(width)[None, :] < widths[:, None]
    row, best = np.zeros((n, width)), np.zeros(n)
    for word in item:
        diagonal = np.zeros((n, width))
        diagonal[:, 1:] = row[:, :-1]
        here = np.maximum(diagonal + np.where(passages == word, MATCH, MISMATCH), row + GAP)
        here = np.maximum(np.where(live, here, 0.0), 0.0)
        row = np.maximum.accumulate(here + steps, axis=1) - steps  # gaps along the passage
        best = np.maximum(best, np.where(live, row, 0.0).max(axis=1))
    return best


def candidate_passages(docs: DataFrame, found: pd.DataFrame, words: dict[int, np.ndarray], threshold: float) -> DataFrame:
    """(doc_id, item_id, passage): word hashes of the pieces that can reach the threshold with an item of ``words``, of which ``found`` are the seeds."""
    grams = found["gram"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(grams)
    grams, item = grams[order], found["item_id"].to_numpy(np.int64)[order]
    size = np.array([len(words[i]) for i in item], dtype=np.int64)
    short = tuple(sorted({len(x) for x in words.values()} & set(range(1, SHORT + 1))))
    least = {i: (np.unique(x), threshold * len(x)) for i, x in words.items()}
    shared = docs.sparkSession.sparkContext.broadcast((grams, item, size, least))

    def passages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, item, size, least = shared.value
        quick = _Filter(grams)
        for batch, texts in slices(batches):
            w = _words(texts)
            gram, place = _doc_seeds(w, short)
            maybe = quick.maybe(gram)
            gram, place = gram[maybe], place[maybe]
            low, high = np.searchsorted(grams, gram, "left"), np.searchsorted(grams, gram, "right")
            times = high - low
            at = np.repeat(place, times)
            seed = np.repeat(low - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(len(at)) if len(at) else at
            yield _cut(batch.column(0), w, at, item[seed], size[seed], threshold, least)

    return docs.select("doc_id", "text").mapInArrow(passages, "doc_id long, item_id long, passage array<long>")


def _common(passage: np.ndarray, distinct: np.ndarray) -> int:
    """How many words of a passage are among the sorted ones: no alignment matches more."""
    return int((distinct[np.minimum(np.searchsorted(distinct, passage), len(distinct) - 1)] == passage).sum())


def _cut(ids: pa.Array, w: Words, at: np.ndarray, item: np.ndarray, size: np.ndarray, threshold: float, least: dict | None = None) -> pa.RecordBatch:
    """Pieces of texts in which enough seeds of an item lie together; only with as many of the item's words as ``least`` (distinct words, number) asks for."""
    names = ["doc_id", "item_id", "passage"]
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64())]
    rows: list[tuple[int, int, np.ndarray]] = []
    doc = w.doc[at]
    order = np.lexsort((at, item, doc))
    doc, items, at, size = doc[order], item[order], at[order], size[order]
    need, span = bounds(size, threshold)
    # Where so many seeds of one text and item begin that lie within the width of an alignment.
    last = np.minimum(np.arange(len(at)) + need - 1, max(len(at) - 1, 0))
    close = (np.arange(len(at)) + need <= len(at)) & (doc[last] == doc) & (items[last] == items) & (at[last] - at < span) if len(at) else np.zeros(0, bool)
    begin = np.flatnonzero(close)
    low, high = np.maximum(at[last[begin]] + 2 - span[begin], w.first[doc[begin]]), np.minimum(at[begin] + span[begin], w.first[doc[begin] + 1])
    short = size[begin] <= SHORT
    low, high = np.where(short, at[begin], low), np.where(short, at[begin] + size[begin], high)
    k = 0
    while k < len(begin):  # places that overlap become one
        b, start, end = begin[k], low[k], high[k]
        k += 1
        while k < len(begin) and doc[begin[k]] == doc[b] and items[begin[k]] == items[b] and low[k] <= end:
            end = max(end, high[k])
            k += 1
        wide = int(span[b])
        for x in range(int(start), max(int(start) + 1, int(end) - wide), wide):
            piece = w.hash[x : min(x + 2 * wide, int(end))]
            if least is None or _common(piece.view(np.int64), least[int(items[b])][0]) >= least[int(items[b])][1] - 1e-9:
                rows.append((int(doc[b]), int(items[b]), piece.view(np.int64)))
    taken = pa.array([d for d, _, _ in rows], pa.int64())
    return pa.RecordBatch.from_arrays([ids.take(taken), pa.array([i for _, i, _ in rows], kinds[1]), pa.array([x.tolist() for *_, x in rows], kinds[2])], names=names)


def shuffled_passages(docs: DataFrame, found_seeds: DataFrame, lengths: DataFrame, threshold: float) -> DataFrame:
    """The same for any number of items: documents' pairs and seeds meet in a join."""
    short = tuple(r["size"] for r in lengths.where(F.col("size") <= SHORT).select("size").distinct().collect())  # SHORT rows at most

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            w = _words(texts)
            gram, place = _doc_seeds(w, short)
            doc = pa.array(w.doc[place])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(doc), batch.column(2).take(doc), pa.array(gram.view(np.int64)), pa.array(place - w.first[w.doc[place]])], names=["doc_id", "which", "gram", "at"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in slices(batches):
            w = _words(texts)
            hits = batch.column(batch.schema.get_field_index("hits")).to_pylist()
            flat = [(w.first[k] + h["at"], h["item_id"], h["size"]) for k, x in enumerate(hits) for h in x]
            at, item, size = (np.array(x, dtype=np.int64) for x in zip(*flat, strict=True))
            yield _cut(batch.column(0), w, at, item, size, threshold)

    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("which"))
    spots = rows.dropDuplicates(["doc_id", "which"]).mapInArrow(spread, "doc_id long, which long, gram long, at long").join(found_seeds, "gram").join(lengths, "item_id")
    # Only texts that have as many seeds of an item as an alignment needs; a text and an item at a time.
    need = F.greatest(F.lit(1), F.ceil((2 * MATCH * threshold * F.col("size") - F.col("size") - 3) / 3 - 1e-9))
    hits = spots.groupBy("doc_id", "which", "item_id", "size").agg(F.collect_list(F.struct("item_id", "size", "at")).alias("hits"))
    hits = hits.where((F.col("size") <= SHORT) | (F.size("hits") >= need)).select(F.col("doc_id").alias("__doc"), F.col("which").alias("__which"), "hits")
    met = rows.join(hits, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("which") == F.col("__which"))).select("doc_id", "text", "hits")
    return met.mapInArrow(cut, "doc_id long, item_id long, passage array<long>")


def find_contamination(docs: DataFrame, items: DataFrame, threshold: float = 0.5, limit: int = LIMIT) -> DataFrame:
    """(doc_id, item_id, similarity) of all documents and items whose alignment reaches ``threshold``.

    ``doc_id`` is an integer; ``items`` has ``item_id`` (an integer) and ``text``.
    """
    words = materialize(item_words(items), "items").where(F.size("words") > 0)
    total = words.agg(F.coalesce(F.sum(F.size("words")), F.lit(0)).alias("n")).first()["n"]
    if total <= limit:
        found = seeds(words).toPandas()
        if not len(found):
            return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, similarity double")
        of_item = {r["item_id"]: np.array(r["words"], dtype=np.int64) for r in words.select("item_id", "words").toLocalIterator()}
        passages = candidate_passages(docs, found, of_item, threshold)
    else:
        lengths = words.select("item_id", F.size("words").cast("long").alias("size"))
        passages = shuffled_passages(docs, materialize(seeds(words), "seeds"), lengths, threshold)

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for item_id, part in frame.groupby("item_id"):
                item = np.asarray(part["words"].iloc[0], dtype=np.int64)
                together = max(1, CELLS // int(part["passage"].map(len).max()))
                for at in range(0, len(part), together):
                    some = part.iloc[at : at + together]
                    widths = some["passage"].map(len).to_numpy()
                    table = np.zeros((len(some), max(1, widths.max())), dtype=np.int64)
                    for k, x in enumerate(some["passage"]):
                        table[k, : len(x)] = x
                    out.append(pd.DataFrame({"doc_id": some["doc_id"].to_numpy(), "item_id": item_id, "similarity": align(table, widths, item) / (MATCH * len(item))}))
            if out:
                yield pd.concat(out)

    aligned = passages.join(words.select("item_id", "words"), "item_id").select("doc_id", "item_id", "passage", "words").mapInPandas(score, "doc_id long, item_id long, similarity double")
    return aligned.groupBy("doc_id", "item_id").agg(F.max("similarity").alias("similarity")).where(F.col("similarity") >= threshold)


def drop_contaminated(docs: DataFrame, items: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the contaminated ones; rows without an id stay unless their text is contaminated too."""
    found = materialize(find_contamination(docs, items, threshold).select("doc_id").distinct(), "contaminated")
    few = found.count() <= FEW_IDS
    return docs.join(F.broadcast(found) if few else found.hint("merge"), docs["doc_id"].eqNullSafe(found["doc_id"]), "left_anti")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return find_contamination(docs, items).select("doc_id", "item_id", F.round("similarity", 6).alias("similarity"))
