"""Burst tries over conversations: which conversations begin with the same turns, and what sharing their beginnings would save.

A turn is known by a 128-bit hash of its role and text. A conversation is a word over turns; words that are equal are one class, with the number of its
conversations. Classes start in the container of the root. A container with more than ``LIMIT`` classes bursts: it becomes a trie head (one for
each turn that all its words share, so that a long common beginning takes one step for ``SKIP`` turns), and its words go to containers by their next turn. When
none is too large, each container's words are sorted and swept once: neighbours' common beginnings open and close nodes on a stack, and a node's
sums go to its parent when it closes.

Scale: texts are read once and never shuffled. Turns are dealt by ranges of (conversation, turn), so that a conversation with a third of all turns is
numbered in several tasks: its parts' sizes, one row a part, give where each begins. Words are kept in segments of ``SEGMENT`` turns. Longer words go on in
containers of their own, known by a hash of all turns before, and what lies beyond a segment is first swept by itself and its sums given to the classes that go on. The ids of a class
are joined and hashed in sorted pieces, one row a piece. Bursting counts classes by partial aggregation and touches the too large containers alone; a container in a task has
``LIMIT`` words at most, and the sweep's memory is its stack and the children of what is open.

Defined cases: null roles and texts are empty; null turns come first; equal turns are ordered by their hash; repeated rows are turns of their own; rows without a
conversation id belong to none and are left out; a conversation without any turn left is a member of the root alone; an empty table has no nodes; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratocast.llm._common import discard, join_lookup, materialize

#: Classes in a container that doesn't burst; turns that a burst goes down at once where all words share them; turns of a segment.
LIMIT, SKIP, SEGMENT = 512, 64, 1 << 18
BLOCK, MOST = 100, 6
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _short(x: Column) -> Column:
    return F.unhex(F.substring(F.sha2(x, 256), 1, 32))


# --- from turns to words ---------------------------------------------------------------------------


def numbered(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns as (conv_id, part, pos, id, chars), and parts of conversations as (conv_id, part, n, before): no conversation is gathered in one task."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    turn = F.col("turn")
    cut = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"), _short(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("id"), F.length(text).alias("chars")
    )
    cut = materialize(cut, "turns")
    order = [F.asc("conv_id"), F.asc_nulls_first("turn"), F.asc("id")]
    dealt = materialize(cut.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "dealt")
    discard(cut)
    local = F.row_number().over(Window.partitionBy("conv_id", "part").orderBy(F.asc_nulls_first("turn"), F.asc("id")))
    parts = dealt.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = materialize(parts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "parts")
    rows = dealt.withColumn("local", local).join(parts.select("conv_id", "part", "before"), ["conv_id", "part"])
    rows = materialize(rows.select("conv_id", "part", (F.col("before") + F.col("local")).alias("pos"), "id", "chars"), "numbered")
    discard(dealt)
    return rows, parts


def rebuilt(rows: DataFrame, parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Words as (conv_id, pos, id, chars), and conversations as (conv_id, n), those without turns too: the first h turns of the block's first conversation, then one's own after its first h."""
    own = parts.groupBy("conv_id").agg(F.sum("n").alias("own"))
    own = own.withColumns({"base": F.expr(f"conv_id - conv_id % {BLOCK}"), "h": F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(MOST)).cast("int")})
    sizes = own.select(F.col("conv_id").alias("base"), F.col("own").alias("base_n"))
    convs = own.join(sizes, "base", "left").withColumn("k", F.least("h", F.coalesce("base_n", F.lit(0))).cast("int"))
    convs = materialize(convs.select("conv_id", "base", "h", "k", (F.col("k") + F.greatest(F.lit(0), F.col("own") - F.col("h"))).alias("n")), "convs")
    # What is a conversation's comes to its turns with the part, of which no task has many rows of one conversation.
    facts = parts.select("conv_id", "part").join(convs.select("conv_id", "h", "k"), "conv_id")
    rest = rows.join(facts, ["conv_id", "part"]).where("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("k")).alias("pos"), "id", "chars")
    first = rows.where((F.col("pos") < MOST) & (F.expr(f"conv_id % {BLOCK}") == 0)).select(F.col("conv_id").alias("base"), "pos", "id", "chars")
    shared = convs.where("k > 0").select("conv_id", "base", "k").join(first, "base").where("pos <= k").select("conv_id", "pos", "id", "chars")
    return rest.unionByName(shared), convs.select("conv_id", "n")


def classes(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """One row a segment of a class of equal words: conv_id (smallest), n, w (conversations), ends (hash of their ids), segment, before (hash of earlier turns), ids, chars."""
    piece = F.struct("pos", "id", "chars")
    mark = lambda seed: F.bit_xor(F.xxhash64(F.lit(seed), "pos", "id"))
    segments = rows.groupBy("conv_id", F.floor((F.col("pos") - 1) / SEGMENT).cast("int").alias("segment")).agg(F.array_sort(F.collect_list(piece)).alias("turns"), mark(1).alias("a"), mark(2).alias("b"))
    segments = materialize(segments.select("conv_id", "segment", "a", "b", F.col("turns.id").alias("ids"), F.col("turns.chars").alias("chars")), "segments")
    marks = segments.groupBy("conv_id").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    word = convs.join(marks, "conv_id", "left").select("conv_id", "n", F.coalesce("a", F.lit(0)).alias("a"), F.coalesce("b", F.lit(0)).alias("b"))
    # Ids of a class in sorted pieces, then one hash over the pieces.
    pieces = word.repartitionByRange("n", "a", "b", "conv_id").withColumn("part", F.spark_partition_id())
    pieces = pieces.groupBy("part", "n", "a", "b").agg(F.array_sort(F.collect_list("conv_id")).alias("own"))
    pieces = pieces.select("n", "a", "b", F.col("own")[0].alias("conv_id"), F.size("own").cast("long").alias("w"), F.array_join("own", ",").alias("own"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, row, sha, done = None, None, None, []
        names = ["n", "a", "b", "conv_id", "w", "ends"]
        give = lambda rows: pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], names=names)
        for batch in batches:
            for n, a, b, conv, w, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (n, a, b) == key:
                    sha.update(f",{own}".encode())
                    row[4] += w
                    continue
                if row:
                    done.append([*row, sha.hexdigest()])
                key, row, sha = (n, a, b), [n, a, b, conv, w], hashlib.sha256(own.encode())
            if done:
                yield give(done)
                done = []
        if row:
            yield give([[*row, sha.hexdigest()]])

    known = pieces.repartition("n", "a", "b").sortWithinPartitions("n", "a", "b", "conv_id").mapInArrow(hashed, "n long, a long, b long, conv_id long, w long, ends string")
    known = materialize(known.select("conv_id", "n", "w", "ends"), "classes")
    before = Window.partitionBy("conv_id").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    kept = segments.join(known.select("conv_id"), "conv_id")
    kept = kept.withColumns({"a": F.bit_xor("a").over(before), "b": F.bit_xor("b").over(before)})
    kept = kept.select("conv_id", "segment", F.when(F.col("segment") > 0, _short(F.concat_ws(":", "segment", "a", "b"))).alias("before"), "ids", "chars")
    # A word that ends with a full segment goes on as an empty one, so that the node at its end has all its members in the container that it heads.
    none = known.where(F.pmod("n", F.lit(SEGMENT)) == 0)
    last = none.select("conv_id").join(marks, "conv_id", "left").join(none.select("conv_id", (F.col("n") / SEGMENT).cast("int").alias("segment")), "conv_id")
    last = last.select("conv_id", "segment", F.when(F.col("segment") > 0, _short(F.concat_ws(":", "segment", "a", "b"))).alias("before"), F.expr("cast(array() as array<binary>)").alias("ids"), F.expr("cast(array() as array<int>)").alias("chars"))
    out = materialize(known.join(kept.unionByName(last), "conv_id"), "words")
    discard(segments, known)
    return out


# --- from words to nodes ---------------------------------------------------------------------------


_NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string, up binary, top boolean"
NODE = [c.split()[0] for c in _NODE.split(", ")]


class _Node:
    __slots__ = ("chars", "children", "conv", "depth", "ends", "goes_on", "leaves", "n", "pending", "saved", "top")

    def __init__(self, depth: int, chars: int, top: bool = False):
        self.depth, self.chars, self.top = depth, chars, top
        self.conv, self.n, self.children, self.leaves, self.saved, self.ends, self.goes_on = None, 0, 0, 0, 0, EMPTY_SHA, False
        self.pending: list[tuple] = []

    def row(self, parent: int | None, up: bytes | None) -> tuple:
        return (self.conv, self.depth, parent, self.n, self.children, self.leaves, self.saved, self.ends, up, self.top)


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted words of containers to nodes; ``up`` is the head above a container's topmost node, whose conversation isn't known here."""
    stack: list[_Node] = []
    done: list[tuple] = []
    current, up, last = None, None, []

    def close(to: int) -> None:
        while len(stack) > to:
            node = stack.pop()
            if not node.children and not node.goes_on:
                node.leaves = 1
            node.saved += (node.n - 1) * node.chars
            done.extend((*row[:2], node.conv, *row[3:]) for row in node.pending)
            if not stack:
                done.append(node.row(None, up))
                continue
            above = stack[-1]
            above.pending.append(node.row(None, None))
            above.conv = node.conv if above.conv is None else min(above.conv, node.conv)
            above.n += node.n
            above.children += 1
            above.leaves += node.leaves
            above.saved += node.saved

    def given() -> pa.RecordBatch:
        columns = list(zip(*done, strict=True))
        done.clear()
        kinds = [pa.int64()] * 7 + [pa.string(), pa.binary(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=NODE)

    for batch in batches:
        for box, above, top, at, ids, chars, conv, w, ends, goes_on, children, leaves, saved in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns)), strict=True):
            if box != current:
                close(0)
                current, up, last = box, above, []
                stack.append(_Node(top + at, chars[at - 1] if at else 0, not at))
            own = ids[at:]
            same = 0
            for x, y in zip(own, last, strict=False):
                if x != y:
                    break
                same += 1
            close(same + 1)
            for i in range(same, len(own)):
                stack.append(_Node(top + at + i + 1, chars[at + i]))
            node = stack[-1]
            node.conv = conv if node.conv is None else min(node.conv, conv)
            node.n += w
            node.children += children
            node.leaves += leaves
            node.saved += saved
            node.goes_on |= goes_on
            if ends is not None:
                node.ends = ends
            last = own
            if len(done) >= 10_000:
                yield given()
    close(0)
    if done:
        yield given()


def _burst(words: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Words in containers of ``LIMIT`` at most, and the heads of each step: box, up, top, at, skip, turns' lengths, conversations, what ends there."""
    heads: list[DataFrame] = []
    while True:
        sizes = materialize(words.groupBy("box").count().where(F.col("count") > LIMIT).select("box", F.lit(True).alias("large")), "large")
        n_large = sizes.count()
        if not n_large:
            discard(sizes)
            return words, heads
        marked = join_lookup(words, sizes, "box", n_large)
        moving = marked.where("large").drop("large")
        piece = F.struct(F.expr(f"slice(ids, at + 1, {SKIP})").alias("ids"), F.expr(f"slice(chars, at + 1, {SKIP})").alias("chars"))
        found = moving.groupBy("box").agg(
            F.min(piece).alias("lo"), F.max(piece).alias("hi"), F.min("up").alias("up"), F.min("top").alias("top"), F.min("at").alias("at"), F.min(F.expr("CASE WHEN at > 0 THEN chars[at - 1] ELSE 0 END")).alias("own"),
            F.min("conv_id").alias("conv_id"), F.sum("w").alias("n_convs"),
        )
        differs = F.array_position(F.zip_with("lo.ids", "hi.ids", lambda x, y: F.coalesce(x == y, F.lit(False))), False)
        skip = F.when(differs > 0, differs - 1).otherwise(F.size("lo.ids")).cast("int")
        found = found.withColumn("skip", skip)
        found = materialize(found.select("box", "up", "top", "at", "skip", F.expr("concat(array(own), slice(lo.chars, 1, skip))").alias("chars"), "conv_id", "n_convs"), "heads")
        gone = join_lookup(moving, found.select("box", "skip"), "box", n_large).withColumn("at", F.col("at") + F.col("skip")).drop("skip")
        stopped = gone.where(F.size("ids") == F.col("at"))
        ended = stopped.groupBy("box").agg(F.max("ends").alias("ends"), F.sum("children").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        heads.append(materialize(found.join(ended, "box", "left"), "ended"))
        turn = F.expr("ids[at]")
        down = gone.where(F.size("ids") > F.col("at")).withColumns({"up": F.col("box"), "box": _short(F.concat("box", turn)), "at": F.col("at") + 1})
        stay = marked.where("large IS NULL").drop("large")
        words, before = materialize(stay.unionByName(down.select(stay.columns)), "words"), words
        discard(found, sizes)
        if len(heads) > 1:
            discard(before)


def _nodes(words: DataFrame) -> DataFrame:
    """Nodes of the words' segments; ``top`` marks those that head a segment's container, which the segment before has too."""
    start = words.select(
        F.coalesce("before", F.unhex(F.lit("00"))).alias("box"), F.lit(None).cast("binary").alias("up"), (F.col("segment").cast("long") * SEGMENT).alias("top"), F.lit(0).alias("at"), "ids", "chars", "conv_id", "w",
        F.when(F.col("n") <= (F.col("segment") + 1) * SEGMENT, F.col("ends")).alias("ends"), (F.col("n") > (F.col("segment") + 1) * SEGMENT).alias("goes_on"), "children", "leaves", "saved",
    )
    boxed, heads = _burst(start)
    swept = boxed.repartition("box").sortWithinPartitions("box", "ids").mapInArrow(_sweep, _NODE)
    nodes = materialize(swept, "nodes")
    if heads:
        discard(boxed)
    # Heads from the lowest up: their sums are those of the containers and heads below.
    sums = lambda df: df.groupBy("up").agg(F.count("*").alias("n"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    out, tops = [nodes], nodes.where("up IS NOT NULL")
    for head in reversed(heads):
        below = sums(tops).withColumnRenamed("up", "box").withColumnsRenamed({"n": "__n", "n_leaves": "__l", "saved_tokens": "__s"})
        zero = lambda c: F.coalesce(F.col(c), F.lit(0))
        full = head.join(below, "box", "left").withColumns({"__n": zero("__n") + zero("children"), "__l": zero("__l") + zero("leaves"), "__s": zero("__s") + zero("saved")})
        one = full.select("*", F.explode(F.sequence(F.lit(0), F.col("skip"))).alias("i"))
        under = F.expr("aggregate(slice(chars, i + 1, skip - i + 1), cast(0 as bigint), (x, y) -> x + y)")
        last = F.col("i") == F.col("skip")
        chain = one.select(
            "conv_id", (F.col("top") + F.col("at") + F.col("i")).alias("depth"), F.when(F.col("i") > 0, F.col("conv_id")).alias("parent_conv_id"), "n_convs",
            F.when(last, F.col("__n")).otherwise(F.lit(1)).cast("long").alias("n_children"), F.col("__l").cast("long").alias("n_leaves"), (F.col("__s") + (F.col("n_convs") - 1) * under).cast("long").alias("saved_tokens"),
            F.when(last, F.coalesce("ends", F.lit(EMPTY_SHA))).otherwise(F.lit(EMPTY_SHA)).alias("ends_sha256"), F.when(F.col("i") == 0, F.col("up")).alias("up"), (F.col("at") + F.col("i") == 0).alias("top"),
        )
        done = materialize(chain, "chain")
        out.append(done)
        tops = tops.unionByName(done.where("up IS NOT NULL"))
    every = out[0]
    for x in out[1:]:
        every = every.unionByName(x)
    if not heads:
        return every
    names = heads[0].select("box", "conv_id")
    for x in heads[1:]:
        names = names.unionByName(x.select("box", "conv_id"))
    names = names.select(F.col("box").alias("up"), F.col("conv_id").alias("__parent"))
    first = every.where("up IS NOT NULL").join(names, "up").withColumn("parent_conv_id", F.col("__parent")).select(*every.columns)
    return every.where("up IS NULL").unionByName(first)


def conversation_trie(turns: DataFrame) -> DataFrame:
    """One row a node of the trie over the rebuilt conversations of ``turns`` (conv_id, turn, role, text)."""
    rows, parts = numbered(turns)
    words = classes(*rebuilt(rows, parts))
    discard(rows, parts)
    sums = ("children", "leaves", "saved")
    words = words.withColumns({c: F.lit(0).cast("long") for c in sums})
    if (words.agg(F.max("segment")).first()[0] or 0) > 0:
        # Each class takes what lies beyond its segment from the containers that it is the smallest member of.
        beyond = _nodes(words.where("segment > 0")).where("top AND n_children > 0")
        own = beyond.select("conv_id", (F.col("depth") / SEGMENT).cast("int").alias("segment"), F.col("n_children").alias("__c"), F.col("n_leaves").alias("__l"), F.col("saved_tokens").alias("__s"))
        later = Window.partitionBy("conv_id").orderBy("segment")
        after = later.rowsBetween(1, Window.unboundedFollowing)
        taken = {"children": F.lead("__c").over(later), "leaves": F.sum("__l").over(after), "saved": F.sum("__s").over(after)}
        joined = words.join(own, ["conv_id", "segment"], "left").withColumns({k: F.coalesce(v, F.lit(0)).cast("long") for k, v in taken.items()})
        words = materialize(joined.select(words.columns), "words")
    return _nodes(words).where("NOT top OR depth = 0").drop("up", "top")


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


#: crc32 of the id's digits, bit by bit, since the SQL has no such function.
_CRC = """xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i::BIGINT, 1))::BIGINT)),
      lambda crc, c: list_reduce(list_prepend(xor(crc, c), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)))"""

ORACLE_SQL = f"""
    WITH turns AS (
      SELECT conv_id, turn, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS id, length(coalesce(text, ''))::BIGINT AS chars FROM conversations WHERE conv_id IS NOT NULL),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) AS pos FROM turns),
    heads AS (SELECT conv_id, conv_id - conv_id % {BLOCK} AS base, {_CRC} % {MOST} AS h FROM (SELECT DISTINCT conv_id FROM turns)),
    parts AS (
      SELECT h.conv_id, 0 AS part, p.pos, p.id, p.chars FROM heads h JOIN placed p ON p.conv_id = h.base AND p.pos <= h.h
      UNION ALL SELECT h.conv_id, 1, p.pos, p.id, p.chars FROM heads h JOIN placed p ON p.conv_id = h.conv_id AND p.pos > h.h),
    words AS (
      SELECT h.conv_id, coalesce(list(id ORDER BY part, pos) FILTER (id IS NOT NULL), []) AS ids, coalesce(list(chars ORDER BY part, pos) FILTER (id IS NOT NULL), []) AS chars
      FROM heads h LEFT JOIN parts USING (conv_id) GROUP BY h.conv_id),
    passed AS (
      SELECT conv_id, len(ids) AS n, d, sha256(array_to_string(ids[1:d], ',')) AS node, CASE WHEN d > 0 THEN sha256(array_to_string(ids[1:d - 1], ',')) END AS above, CASE WHEN d > 0 THEN chars[d] ELSE 0 END AS c
      FROM (SELECT *, unnest(range(0, len(ids) + 1)) AS d FROM words)),
    nodes AS (
      SELECT d, node, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(above) AS above, any_value(c) AS c, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d) AS ends
      FROM passed GROUP BY d, node),
    counted AS (
      SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN (SELECT d - 1 AS d, above AS node, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL) k USING (d, node)),
    below AS (
      SELECT p.d, p.node, sum(CASE WHEN u.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((u.n_convs - 1) * u.c) AS saved_tokens
      FROM counted u JOIN passed p ON p.conv_id = u.conv_id AND p.d <= u.d GROUP BY ALL)
    SELECT n.conv_id, n.d AS depth, a.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
    FROM counted n JOIN below b USING (d, node) LEFT JOIN nodes a ON a.d = n.d - 1 AND a.node = n.above"""
