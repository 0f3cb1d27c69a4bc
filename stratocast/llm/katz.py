"""Katz backoff language model.

Every word and every n-gram up to trigrams is counted and kept, from a count of 1 on and at every size of the corpus. Counts up to 5 are discounted by
Good-Turing; the mass that discounts leave goes to the next shorter n-gram, with a weight per context that makes its probabilities sum to one exactly.
Unknown words are one class.

    P(w | context) = discounted count(context w) / count(context)            if seen
                   = weight(context) * P(w | context without its first word)  otherwise

Texts are lower-cased (A-Z) words and one end per text, which also opens the next context.

Scale: the texts are read and cut into words once, into blocks of a few megabytes; what follows are tables on shared storage. Words get ids by falling
frequency (a range-partitioned sort; the blocks' vocabularies meet by partitions of the hash), so that a word's count follows from its id and the ids at which the count changes, of which there are at most
sqrt(2 * tokens). Trigrams (u, v, w) go to partitions by their middle word, once per block: there the trigram's context (u, v), its shorter n-gram (v, w), and the context v
of that all meet, so that probabilities and weights need no join; the answers go back to the blocks in the order in which they were asked. A word that is the middle
of more than ``hot`` tokens is dealt to several partitions by u; only its pairs (v, w) are then added up over the partitions by a shuffle. N-grams
travel sorted, as differences, compressed; nothing of them comes to the driver.

Defined cases: null and empty texts are a lone end; without training texts every word is unknown and has the whole mass; rows that repeat are scored each (and
trained each); rows whose ``train`` is null are not learned from; other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratocast.llm._common import Words, bucket_of, discard, materialize, mix64, slices

#: Ids of what isn't a word: the end of a text, a word that no training text has, and what stands before the end that opens a text.
END, UNKNOWN, START = 0, -1, -2
#: Counts up to this are discounted.
GOOD_TURING = 5
#: Tokens per partition of trigrams, and those from which a middle word is dealt to several.
PART, HOT = 1 << 19, 1 << 21


def discounts(n: list[int]) -> np.ndarray:
    """Factors for counts 0..5 (and 1 beyond) from ``n``: how many have count 1..6."""
    out = np.ones(GOOD_TURING + 1)
    many = (GOOD_TURING + 1) * n[GOOD_TURING] / n[0] if n[0] else 1.0
    for r in range(1, GOOD_TURING + 1):
        if many < 1 and n[r - 1] and n[r]:
            out[r] = ((r + 1) * n[r] / (r * n[r - 1]) - many) / (1 - many)
        else:
            out[r] = -1
    if ((out[1:] <= 0) | (out[1:] > 1)).any():  # too few counts of counts: take off what an absolute discount would
        less = n[0] / (n[0] + 2 * n[1]) if n[0] and n[1] else 0.5
        out[1:] = 1 - less / np.arange(1, GOOD_TURING + 1)
    return out


def factor(discount: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.where(counts <= GOOD_TURING, discount[np.minimum(counts, GOOD_TURING)], 1.0)


# --- packed columns -------------------------------------------------------------------------------


def pack(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers from 0 on, of one length: their bytes by significance, as many as the largest needs, compressed."""
    out = [np.array([len(columns[0])], dtype=np.int64).tobytes()]
    for c in columns:
        c = np.ascontiguousarray(c, dtype=np.uint64)
        width = -(-int(c.max()).bit_length() // 8) if len(c) else 0
        out += [bytes([width]), np.ascontiguousarray(c.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(out))


def unpack(blob: bytes, columns: int) -> list[np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    n, at, out = int(raw[:8].view(np.int64)[0]), 8, []
    for _ in range(columns):
        width = int(raw[at])
        table = np.zeros((n, 8), dtype=np.uint8)
        table[:, :width] = raw[at + 1 : at + 1 + width * n].reshape(width, n).T
        out.append(table.reshape(-1).view(np.int64))
        at += 1 + width * n
    return out


def _inner(new: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Differences within runs that begin where ``new``; the value itself there."""
    return np.where(new, x, np.diff(x, prepend=0))


def _outer(new: np.ndarray, d: np.ndarray) -> np.ndarray:
    total = np.cumsum(d)
    begin = np.flatnonzero(new)
    return total - np.repeat(total[begin] - d[begin], np.diff(np.append(begin, len(d))))


def pack_trigrams(v: np.ndarray, w: np.ndarray, u: np.ndarray, n: np.ndarray) -> bytes:
    """Trigrams in the order of (v, w, u), ids from START on, with counts."""
    first = np.zeros(len(v), dtype=bool)
    first[:1] = True
    new_v = np.append(True, v[1:] != v[:-1])[: len(v)]
    new_w = new_v | np.append(True, w[1:] != w[:-1])[: len(v)]
    return pack(_inner(first, v - START), _inner(new_v, w - START), _inner(new_w, u - START), n)


def unpack_trigrams(blob: bytes) -> tuple[np.ndarray, ...]:
    dv, dw, du, n = unpack(blob, 4)
    first = np.zeros(len(dv), dtype=bool)
    first[:1] = True
    v = _outer(first, dv)
    new_v = np.append(True, dv[1:] != 0)[: len(dv)]
    w = _outer(new_v, dw)
    new_w = new_v | np.append(True, w[1:] != w[:-1])[: len(dv)]
    return v + START, w + START, _outer(new_w, du) + START, n


def distinct(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of a row of each distinct tuple, the tuple's number for each row); tuples are numbered in their order."""
    if not len(columns[0]):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bits = lambda c: int(c.max()).bit_length()
    columns = [c - c.min() for c in columns]
    for i, c in enumerate(columns):
        if sum(map(bits, columns)) > 63:
            columns[i] = np.unique(c, return_inverse=True)[1]
    key = columns[0]
    for c in columns[1:]:
        if bits(key) + bits(c) > 63:
            key = np.unique(key, return_inverse=True)[1]
        key = (key << bits(c)) | c
    order = np.argsort(key)
    new = np.append(True, np.diff(key[order]) != 0)
    own = np.empty(len(key), dtype=np.int64)
    own[order] = np.cumsum(new) - 1
    return order[new], own


# --- words ----------------------------------------------------------------------------------------


def _whole(batches: Iterator[pa.RecordBatch], least: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Batches put together until they have ``least`` bytes, so that blocks aren't small where batches are."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= least:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def blocks(docs: DataFrame) -> DataFrame:
    """One row per few megabytes of texts: the documents, their words as places in the block's sorted vocabulary, and that with its counts in training texts."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        for batch, texts in slices(_whole(batches), most=4 << 20):
            w = Words(texts)
            vocabulary, place = np.unique(w.hash, return_inverse=True)
            train = np.array([bool(x) for x in batch.column(2).to_pylist()])
            counts = np.bincount(place[train[w.doc]], minlength=len(vocabulary))
            lists = [batch.column(0), pa.array(train), pa.array(np.diff(w.first))]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in lists]
            blobs = [pa.array([x], pa.binary()) for x in (pack(place), pack(np.diff(vocabulary, prepend=np.uint64(0)), counts))]
            yield pa.RecordBatch.from_arrays([pa.array([number]), *lists, *blobs, pa.array([len(vocabulary)])], names=[*NAMES, "vocabulary", "distinct"])
            number += 1

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "train")
    return rows.mapInArrow(cut, "block long, doc_id array<long>, train array<boolean>, size array<long>, places binary, vocabulary binary, distinct long")


def by_hash(cut: DataFrame, bits: int) -> DataFrame:
    """(part, block, words): the blocks' vocabularies by the first ``bits`` bits of the words' hashes."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, blob in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                delta, n = unpack(blob, 2)
                words = np.cumsum(delta.view(np.uint64))
                part = (words >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(words), np.int64)
                edge = np.flatnonzero(np.append(True, part[1:] != part[:-1])[: len(part)])
                end = np.append(edge[1:], len(part))
                blobs = [pack(np.diff(words[i:j], prepend=np.uint64(0)), n[i:j]) for i, j in zip(edge, end, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(part[edge]), pa.array([block] * len(edge), pa.int64()), pa.array(blobs, pa.binary())], names=["part", "block", "words"])

    return cut.select("block", "vocabulary").mapInArrow(deal, "part long, block long, words binary")


def word_counts(vocabularies: DataFrame) -> DataFrame:
    """(word, n) of all training words."""

    def count(group: pa.Table) -> pa.Table:
        parts = [unpack(x, 2) for x in group.column("words").to_pylist()]
        words, own = np.unique(np.concatenate([np.cumsum(d) for d, _ in parts]), return_inverse=True)
        n = np.bincount(own, weights=np.concatenate([n for _, n in parts]), minlength=len(words)).astype(np.int64)
        return pa.table([pa.array(words[n > 0]), pa.array(n[n > 0])], names=["word", "n"])

    return vocabularies.groupBy("part").applyInArrow(count, "word long, n long")


def identified(vocabularies: DataFrame, words: DataFrame, bits: int) -> DataFrame:
    """(block, part, ids): ids of the blocks' words, 0 for those that no training text has."""

    def find(asked: pa.Table, known: pa.Table) -> pa.Table:
        word, ids = (known.column(c).to_numpy() for c in ("word", "id"))
        order = np.argsort(word)
        word, ids = word[order], ids[order]
        out = []
        for blob in asked.column("words").to_pylist():
            w = np.cumsum(unpack(blob, 2)[0])
            at = np.minimum(np.searchsorted(word, w), max(len(word) - 1, 0))
            out.append(pack(np.where(word[at] == w, ids[at], 0) if len(word) else np.zeros(len(w))))
        return pa.table([asked.column("block"), asked.column("part"), pa.array(out, pa.binary())], names=["block", "part", "ids"])

    part = F.shiftrightunsigned("word", 64 - bits) if bits else F.lit(0).cast("long")
    return vocabularies.groupBy("part").cogroup(words.select(part.alias("part"), "word", "id").groupBy("part")).applyInArrow(find, "block long, part long, ids binary")


def ranked(words: DataFrame) -> DataFrame:
    """(word, n, id): ids from 1 on by falling count, without one task for all words."""
    order = [F.col("n").desc(), F.col("word")]
    placed = materialize(words.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("m", F.monotonically_increasing_id()), "sorted_words")
    part = F.shiftright("m", 33)
    before, rows = 1, []
    for r in placed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).orderBy("p").collect():  # a row per partition
        rows.append((r["p"], before))
        before += r["n"]
    offsets = words.sparkSession.createDataFrame(rows, "p long, before long")
    out = materialize(placed.withColumn("p", part).join(F.broadcast(offsets), "p").select("word", "n", (F.col("before") + F.col("m").bitwiseAND(F.lit((1 << 33) - 1))).alias("id")), "words")
    discard(placed)
    return out


@dataclass
class Unigrams:
    tokens: int
    distinct: int
    discount: np.ndarray
    unknown: float  # mass of the unknown class
    ends: int  # training texts
    first: np.ndarray  # ids at which the count changes
    n: np.ndarray  # and the count from there on

    def count(self, ids: np.ndarray) -> np.ndarray:
        step = np.searchsorted(self.first, ids, "right") - 1
        n = self.n[np.maximum(step, 0)] if len(self.n) else np.zeros(len(ids), np.int64)
        return np.where(ids == END, self.ends, np.where(ids > 0, n, 0))

    def p(self, ids: np.ndarray) -> np.ndarray:
        n = self.count(ids)
        return np.where(n > 0, factor(self.discount, n) * n / max(self.tokens, 1), self.unknown)


def unigrams(words: DataFrame, ends: int) -> Unigrams:
    """What is known of single words; ``words`` is (word, n, id)."""
    steps = words.groupBy("n").agg(F.min("id").alias("first"), F.count("*").alias("many")).orderBy("first").collect()  # distinct counts: sqrt(2 * tokens) at most
    first, n, many = (np.array([r[c] for r in steps], dtype=np.int64) for c in ("first", "n", "many"))
    tokens = int((n * many).sum()) + ends
    seen = [int(many[n == r].sum()) + int(ends == r) for r in range(1, GOOD_TURING + 2)]
    discount = discounts(seen)
    # What the discounts leave for the unknown: exactly one minus all that is given to known words.
    off = sum((1 - discount[r]) * r * seen[r - 1] for r in range(1, GOOD_TURING + 1))
    unknown = off / tokens if tokens and off > 0 else 1.0 / (tokens + 1)
    if tokens and not off > 0:
        discount = discount * (1 - unknown)
    return Unigrams(tokens, int(many.sum()) + int(ends > 0), discount, unknown, ends, first, n)


NAMES = ["block", "doc_id", "train", "size", "places"]


class Block:
    """The tokens of a block, and its distinct trigrams by partition."""

    def __init__(self, block: pa.Table, ids: pa.Table, parts: int, hot: int, known: Unigrams):
        row = {c: block.column(c)[0].as_py() for c in NAMES}
        self.doc_id, self.train = row["doc_id"], np.array(row["train"], dtype=bool)
        size = np.array(row["size"], dtype=np.int64)
        ids = np.concatenate([np.zeros(0, np.int64), *[unpack(x, 1)[0] for x in ids.sort_by("part").column("ids").to_pylist()]])
        words = np.where(ids > 0, ids, UNKNOWN)[unpack(row["places"], 1)[0]] if len(ids) else np.zeros(0, np.int64)
        self.size = size + 1
        last = np.cumsum(self.size) - 1
        self.w = np.full(size.sum() + len(size), END, dtype=np.int64)
        inside = np.ones(len(self.w), dtype=bool)
        inside[last] = False
        self.w[inside] = words
        self.doc = np.repeat(np.arange(len(size)), self.size)
        first = last - self.size + 1
        self.v = np.append(END, self.w[:-1])
        self.v[first] = END
        self.u = np.append(END, self.v[:-1])
        self.u[first] = START
        # After an unknown word nothing has been seen: such tokens need no partition.
        self.asked = np.flatnonzero(self.v != UNKNOWN)
        v, w, u = self.v[self.asked], self.w[self.asked], self.u[self.asked]
        at, own = distinct(v, w, u)
        n = np.bincount(own, weights=self.train[self.doc[self.asked]], minlength=len(at)).astype(np.int64)
        v, w, u = v[at], w[at], u[at]
        self.part = part_of(v, u, parts, hot, known)
        sort = np.argsort(self.part, kind="stable")
        self.part, self.trigrams = self.part[sort], [x[sort] for x in (v, w, u, n)]
        back = np.empty(len(sort), dtype=np.int64)
        back[sort] = np.arange(len(sort))
        self.own = back[own]  # the trigram of each asked token


def part_of(v: np.ndarray, u: np.ndarray, parts: int, hot: int, known: Unigrams) -> np.ndarray:
    """Partition of each trigram: by its middle word, and by its first word too where the middle one is hot."""
    salts = -(-known.count(v) // hot)
    salt = np.where(salts > 1, mix64(u.astype(np.uint64)) % np.maximum(salts, 1).astype(np.uint64), 0).astype(np.uint64)
    return (mix64(v.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + salt) % np.uint64(parts)).astype(np.int64)


# --- trigrams -------------------------------------------------------------------------------------


class Part:
    """All that is asked of one partition, grouped: distinct trigrams, pairs (v, w), contexts (u, v) and v."""

    def __init__(self, blobs: list[bytes]):
        parts = [unpack_trigrams(b) for b in blobs]
        self.lengths = [len(p[0]) for p in parts]
        v, w, u, n = (np.concatenate(c) for c in zip(*parts, strict=True))
        at, self.own = distinct(v, w, u)
        self.v, self.w, self.u = v[at], w[at], u[at]
        self.n = np.bincount(self.own, weights=n, minlength=len(at)).astype(np.int64)
        self.full = (self.u != START) & (self.n > 0)  # trigrams that were seen
        new = np.append(True, (np.diff(self.v) != 0) | (np.diff(self.w) != 0))[: len(at)]
        self.pair_at, self.pair = np.flatnonzero(new), np.cumsum(new) - 1
        self.n2 = np.bincount(self.pair, weights=self.n, minlength=len(self.pair_at)).astype(np.int64)
        self.v2, self.w2 = self.v[self.pair_at], self.w[self.pair_at]

    def probabilities(self, known: Unigrams, discount: list[np.ndarray], hot: dict[int, tuple[float, float]]) -> None:
        """log10 of P2 and P3 where seen, of the weights of both contexts, and of what a token of each trigram gets."""
        v_at, v_own = np.unique(self.v2, return_inverse=True)
        of = np.maximum(known.count(v_at), 1).astype(float)
        seen = self.n2 > 0
        given2 = factor(discount[0], self.n2) * self.n2
        p1 = known.p(self.w2)
        given, share = (np.bincount(v_own, weights=np.where(seen, x, 0.0), minlength=len(v_at)) for x in (given2, p1))
        for i, x in enumerate(v_at.tolist()):
            if x in hot:
                given[i], share[i] = hot[x]
        scale, self.weight2 = balance(of, given, share)
        p2 = np.where(seen, given2 / of[v_own] * scale[v_own], 0.0)
        self.log_p2 = np.log10(np.where(seen, p2, self.weight2[v_own] * p1))  # with backoff
        self.v1, self.seen2, self.v_own = v_at, seen, v_own
        c_at, c_own = distinct(self.u, self.v)
        full = self.full
        of3, given3, share3 = (np.bincount(c_own[full], weights=x[full], minlength=len(c_at)) for x in (self.n, factor(discount[1], self.n) * self.n, p2[self.pair]))
        scale3, weight3 = balance(np.maximum(of3, 1), given3, share3)
        self.c_at, self.seen3, self.weight3 = c_at, of3 > 0, np.where(of3 > 0, weight3, 1.0)
        with np.errstate(divide="ignore"):
            self.log_p3 = np.log10(factor(discount[1], self.n) * self.n / np.maximum(of3, 1)[c_own] * scale3[c_own])
        self.value = np.where(full, self.log_p3, np.log10(self.weight3)[c_own] + self.log_p2[self.pair])

    def answers(self) -> Iterator[tuple[bytes, bytes]]:
        """What each block asked for, in its order: places in a list of values, and the values."""
        at = 0
        for length in self.lengths:
            values, place = np.unique(self.value[self.own[at : at + length]], return_inverse=True)
            yield pack(place), values.tobytes()
            at += length


def balance(of: np.ndarray, given: np.ndarray, share: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scale of a context's discounted probabilities (something is always left for what was not seen), and its weight."""
    seen = given / of
    scale = np.minimum(1.0, (1 - 0.5 / of) / np.where(seen > 0, seen, 1.0))
    return scale, np.where(seen > 0, (1 - seen * scale) / np.maximum(1 - share, 1e-12), 1.0)


@dataclass
class Model:
    words: DataFrame  # (word, n, id): every training word; ``word`` is its hash
    known: Unigrams
    discount: list[np.ndarray]  # of pairs and of trigrams
    blocks: DataFrame
    ids: DataFrame
    asked: DataFrame  # (part, block, trigrams): distinct trigrams of every block with their counts in training texts
    pairs: DataFrame  # (part, v, w, n): total counts of the pairs of hot words, once per partition that has them
    hot: dict[int, tuple[float, float]]  # sums over the pairs of a hot word
    layout: tuple[int, int]

    def _each(self, of_part: Callable[[Part, pa.Table], pa.Table], schema: str) -> DataFrame:
        """``of_part`` of every partition with its probabilities."""
        known, discount, hot = self.known, self.discount, self.hot

        def run(asked: pa.Table, pairs: pa.Table) -> pa.Table:
            part = Part(asked.column("trigrams").to_pylist())
            if len(pairs):  # they are in the same order as the part's own
                v, w, n = (pairs.column(c).to_numpy() for c in ("v", "w", "n"))
                part.n2[np.isin(part.v2, list(hot))] = n[np.lexsort((w, v))]
            part.probabilities(known, discount, hot)
            return of_part(part, asked)

        return self.asked.groupBy("part").cogroup(self.pairs.groupBy("part")).applyInArrow(run, schema)

    def tables(self) -> tuple[DataFrame, DataFrame]:
        """(order, u, v, w, n, log_p) of every n-gram from order 2 on, and (order, u, v, log_weight) of every context; u is null for pairs."""

        def rows(part: Part, asked: pa.Table) -> pa.Table:
            names = ["kind", "order", "u", "v", "w", "n", "x"]
            kinds = [pa.string(), pa.int32(), *[pa.int64()] * 4, pa.float64()]
            made = []
            f, p, c = np.flatnonzero(part.full), np.flatnonzero(part.seen2), part.c_at[part.seen3]
            made.append(("ngram", 3, part.u[f], part.v[f], part.w[f], part.n[f], part.log_p3[f]))
            made.append(("ngram", 2, None, part.v2[p], part.w2[p], part.n2[p], part.log_p2[p]))
            made.append(("context", 3, part.u[c], part.v[c], None, None, np.log10(part.weight3[part.seen3])))
            made.append(("context", 2, None, part.v1, None, None, np.log10(part.weight2)))
            out = []
            for kind, order, *columns in made:
                size = len(columns[1])
                out.append(pa.table([pa.array([kind] * size), pa.array([order] * size, pa.int32()), *[pa.nulls(size, k) if x is None else pa.array(x, k) for x, k in zip(columns, kinds[2:], strict=True)]], names=names))
            return pa.concat_tables(out)

        every = self._each(rows, "kind string, order int, u long, v long, w long, n long, x double").distinct()  # a hot word's pairs and context are in several partitions
        return every.where("kind = 'ngram'").select("order", "u", "v", "w", "n", F.col("x").alias("log_p")), every.where("kind = 'context'").select("order", "u", "v", F.col("x").alias("log_weight"))

    def store(self, path: str) -> None:
        """Write the tables: ``words``, and ``ngrams`` and ``contexts`` by order."""
        self.words.write.mode("overwrite").parquet(f"{path}/words")
        for name, table in zip(("ngrams", "contexts"), self.tables(), strict=True):
            table.write.mode("overwrite").partitionBy("order").parquet(f"{path}/{name}")

    def scores(self) -> DataFrame:
        """(doc_id, train, n_tokens, n_known, base_score, score) of every row that the model was made with."""
        known, (parts, hot) = self.known, self.layout

        def answer(part: Part, asked: pa.Table) -> pa.Table:
            made = list(part.answers())
            return pa.table([asked.column("block"), asked.column("part"), pa.array([x[0] for x in made], pa.binary()), pa.array([x[1] for x in made], pa.binary())], names=["block", "part", "places", "given"])

        answers = materialize(self._each(answer, "block long, part long, places binary, given binary"), "answers")
        discard(self.asked)

        def per_doc(block: pa.Table, replies: pa.Table) -> pa.Table:
            own = replies.column("given").is_null()
            b = Block(block, replies.filter(own).select(["part", "ids"]), parts, hot, known)
            value = np.zeros(len(b.part))
            for part, places, given in zip(*(replies.filter(pc.invert(own)).column(c).to_pylist() for c in ("part", "ids", "given")), strict=True):
                low, high = np.searchsorted(b.part, [part, part + 1])
                value[low:high] = np.frombuffer(given, dtype=np.float64)[unpack(places, 1)[0]]
            score = np.log10(known.p(b.w))
            score[b.asked] = value[b.own]
            c = known.count(b.w)
            base = np.log10((c + 0.1) / (known.tokens + 0.1 * (known.distinct + 1)))
            sums = [np.bincount(b.doc, weights=x, minlength=len(b.size)) for x in (c > 0, base, score)]
            return pa.table([pa.array(b.doc_id, pa.int64()), pa.array(b.train), pa.array(b.size), pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2])], names=["doc_id", "train", "n_tokens", "n_known", "base_score", "score"])

        replies = self.ids.withColumn("given", F.lit(None).cast("binary")).unionByName(answers.withColumnRenamed("places", "ids"))
        both = self.blocks.select(*NAMES).groupBy("block").cogroup(replies.groupBy("block"))
        return both.applyInArrow(per_doc, "doc_id long, train boolean, n_tokens long, n_known long, base_score double, score double")


def learn(docs: DataFrame, part: int = PART, hot: int = HOT) -> Model:
    """Learn from the rows of ``docs`` (doc_id, text, train) with ``train``, and take up the n-grams of all of them."""
    spark = docs.sparkSession
    cut = materialize(blocks(docs), "blocks")
    ends = cut.agg(F.coalesce(F.sum(F.size(F.filter("train", lambda x: x))), F.lit(0)).alias("n")).first()["n"]
    entries = cut.agg(F.coalesce(F.sum("distinct"), F.lit(0)).alias("n")).first()["n"]
    bits = max(0, int(entries // part).bit_length())
    words = ranked(word_counts(by_hash(cut, bits)))
    known = unigrams(words, ends)
    ids = materialize(identified(by_hash(cut, bits), words, bits), "ids")
    parts = max(1, -(-known.tokens // part))

    def ask(block: pa.Table, ids: pa.Table) -> pa.Table:
        b = Block(block, ids, parts, hot, known)
        edge = np.flatnonzero(np.append(True, b.part[1:] != b.part[:-1])[: len(b.part)])
        end = np.append(edge[1:], len(b.part))
        blobs = [pack_trigrams(*(x[i:j] for x in b.trigrams)) for i, j in zip(edge, end, strict=True)]
        return pa.table([pa.array(b.part[edge]), pa.array([block.column("block")[0].as_py()] * len(edge), pa.int64()), pa.array(blobs, pa.binary())], names=["part", "block", "trigrams"])

    both = cut.select(*NAMES).groupBy("block").cogroup(ids.groupBy("block"))
    asked = materialize(both.applyInArrow(ask, "part long, block long, trigrams binary"), "trigrams")

    def count(group: pa.Table) -> pa.Table:
        """How many pairs (order 2) and trigrams (3) have each small count, as (null, order, count, how many); and the pairs of hot words as (part, v, w, n, P1 of w)."""
        p = Part(group.column("trigrams").to_pylist())
        cold = known.count(p.v2) <= hot
        rows = [(None, order, r, int((n == r).sum()), 0.0) for order, n in ((2, p.n2[cold]), (3, p.n[p.full])) for r in range(1, GOOD_TURING + 2)]
        h = np.flatnonzero(~cold)
        counts = pa.table([pa.array(list(x), k) for x, k in zip(zip(*rows, strict=True), [*[pa.int64()] * 4, pa.float64()], strict=True)], names=["part", "v", "w", "n", "p1"])
        part = group.column("part")[0].as_py()
        pairs = pa.table([pa.array([part] * len(h), pa.int64()), *[pa.array(x[h]) for x in (p.v2, p.w2, p.n2)], pa.array(known.p(p.w2[h]))], names=counts.column_names)
        return pa.concat_tables([counts, pairs])

    counted = materialize(asked.groupBy("part").applyInArrow(count, "part long, v long, w long, n long, p1 double"), "counts")
    total = counted.where("part is not null").groupBy("v", "w").agg(F.sum("n").alias("n"), F.first("p1").alias("p1"))
    total = materialize(total, "hot_pairs")
    few = {(r["v"], r["w"]): r["n"] for r in counted.where("part is null").groupBy("v", "w").agg(F.sum("n").alias("n")).collect()}  # 12 rows
    more = {r["n"]: r["many"] for r in total.where(F.col("n").between(1, GOOD_TURING + 1)).groupBy("n").agg(F.count("*").alias("many")).collect()}
    discount = [discounts([few.get((order, r), 0) + (more.get(r, 0) if order == 2 else 0) for r in range(1, GOOD_TURING + 2)]) for order in (2, 3)]
    small = F.least(F.col("n"), F.lit(GOOD_TURING)).cast("int") + 1
    given = F.when(F.col("n") <= GOOD_TURING, F.element_at(F.array(*[F.lit(float(x)) for x in discount[0]]), small)).otherwise(1.0) * F.col("n")
    sums = total.where("n > 0").groupBy("v").agg(F.sum(given).alias("given"), F.sum("p1").alias("share")).collect()  # hot words: tokens / hot at most
    pairs = counted.where("part is not null").select("part", "v", "w").join(total.select("v", "w", "n"), ["v", "w"]).select("part", "v", "w", "n")
    return Model(words, known, discount, cut, ids, asked, materialize(pairs, "pairs"), {r["v"]: (r["given"], r["share"]) for r in sums}, (parts, hot))


def katz_scores(docs: DataFrame, part: int = PART, hot: int = HOT) -> DataFrame:
    """(doc_id, train, train_tokens, n_tokens, n_known, base_score, score) of every row of ``docs`` (doc_id, text, train), learned from those with ``train``."""
    model = learn(docs, part, hot)
    return model.scores().withColumn("train_tokens", F.lit(model.known.tokens).cast("long"))


def op2_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = katz_scores(docs.withColumn("train", bucket_of(F.col("doc_id"), 10) != 0))
    return out.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
