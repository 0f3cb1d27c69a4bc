"""Mixing sources to target weights by capped water-filling.

Each source gets a share of the token budget in proportion to its weight. A source whose share would
exceed ``max_epochs`` times its size is clamped there, and the excess goes to the other sources in
proportion to their weights, again and again until no source is above its cap. Within a source, a
rate of e.g. 1.4 is sampled as one whole repetition of every document and 0.4 of another: documents are
taken in the order of a seeded hash until the fraction is used up, so that one document per source at most is
taken in part and the source's total meets its target to a word.

Scale: the corpus is aggregated to (source, hash bucket) sums with map-side combine; a source's sums are
bounded by ``BUCKETS`` rows, so that a hot source never meets in one task. Only the one bucket per source in which
the fraction ends is put in order. The water-filling loop runs on aggregates of the table of sources, which stays on the
executors; only scalars come to the driver.

Defined cases: null text has size 0; a null source is a source of its own and comes last; sources of size 0 get
target 0; rows that repeat are separate documents; an empty table gives an empty result; other columns
stay as they are (columns named like the results are replaced).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratocast.llm._common import join_lookup, materialize, word_count

BUCKETS = 1 << 14
RESULTS = ("size", "source_size", "target", "rate", "taken", "repeats")


def source_ranks(sources: DataFrame) -> DataFrame:
    """Add ``rank`` (0, 1, ...) by code point of ``source``, null last, without one task for all sources.

    The sources are range-partitioned; the number of rows in each partition (as many as shuffle
    partitions at most) gives every partition its offset.
    """
    placed = materialize(
        sources.repartitionByRange(F.col("source").asc_nulls_last())
        .sortWithinPartitions(F.col("source").asc_nulls_last())
        .withColumn("__m", F.monotonically_increasing_id())
        .withColumn("__p", F.shiftright("__m", 33)),
        "sources",
    )
    counts = sorted((r["__p"], r["n"]) for r in placed.groupBy("__p").agg(F.count("*").alias("n")).collect())  # a row per partition
    before, rows = 0, []
    for p, n in counts:
        rows.append((p, before))
        before += n
    spark = sources.sparkSession
    offsets = spark.createDataFrame(rows, "__p long, __before long")
    return placed.join(F.broadcast(offsets), "__p").withColumn("rank", F.col("__before") + F.col("__m").bitwiseAND(F.lit((1 << 33) - 1))).drop("__m", "__p", "__before")


def water_fill(sources: DataFrame, budget: Column | float, max_epochs: float) -> DataFrame:
    """``target`` per row of (``source_size``, ``weight``): min(cap, level * weight) with the level that spends the budget.

    Every round clamps all sources that the present level lifts above their caps and spreads the rest over the others by weight; the
    level never falls, so a clamped source stays clamped and a round needs the level alone.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    total = sources.agg(F.sum("source_size").alias("s"), F.sum(F.when(F.col("source_size") > 0, F.col("weight"))).alias("w")).first()
    if not total["s"] or not total["w"]:
        return sources.withColumn("target", F.lit(0.0))
    spend = min(float(budget) * total["s"], float(max_epochs) * total["s"])
    level, clamped = spend / total["w"], 0
    while True:
        over = (F.col("source_size") > 0) & (F.col("weight") * F.lit(level) > cap)
        now = sources.agg(
            F.count(F.when(over, 1)).alias("n"),
            F.coalesce(F.sum(F.when(over, cap)), F.lit(0.0)).alias("full"),
            F.coalesce(F.sum(F.when(~over & (F.col("source_size") > 0), F.col("weight"))), F.lit(0.0)).alias("w"),
        ).first()
        if now["n"] == clamped or not now["w"]:
            break
        clamped, level = now["n"], (spend - now["full"]) / now["w"]
    return sources.withColumn("target", F.least(cap, F.when(F.col("source_size") > 0, F.col("weight") * F.lit(level)).otherwise(0.0)))


def mix_sources(docs: DataFrame, weight: Column, budget: float = 1.5, max_epochs: float = 2.0, seed: int = 17, counted: bool = False) -> DataFrame:
    """Documents with ``size``, ``source_size``, ``target``, ``rate``, ``taken`` (words) and ``repeats`` (``taken / size``).

    ``docs`` has ``doc_id``, ``source`` and ``text``; with ``counted``, words in ``size`` (a column of that name is replaced otherwise). ``weight`` is an
    expression over ``source`` and its ``rank``; ``budget`` is the share of all words to take.
    """
    if not counted:
        docs = docs.withColumn("size", word_count(F.col("text")))
    docs = docs.drop(*RESULTS[1:])
    mixed = F.xxhash64(F.lit(seed), F.col("doc_id"))
    fine = docs.withColumn("__h", mixed).withColumn("__b", F.pmod(F.col("__h"), F.lit(BUCKETS)).cast("int"))
    sums = materialize(fine.groupBy("source", "__b").agg(F.sum("size").alias("s")), "bucket_sums")

    sources = source_ranks(sums.groupBy("source").agg(F.sum("s").alias("source_size")))
    sources = water_fill(sources.withColumn("weight", weight.cast("double")), budget, max_epochs)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # Whole words of the part that is left after the whole repetitions.
    sources = sources.withColumn("rate", rate).withColumn("__whole", F.floor("rate")).withColumn("__part", F.round(F.col("target") - F.floor("rate") * F.col("source_size")).cast("long"))
    sources = materialize(sources.drop("weight", "rank"), "targets")
    n = sources.count()

    # The bucket in which the part ends: the first whose running sum reaches it.
    run = F.sum("s").over(W.partitionBy("source").orderBy("__b").rowsBetween(W.unboundedPreceding, 0))
    ends = join_lookup(sums.withColumn("__run", run), sources.select("source", "__part"), "source", n)
    ends = ends.where((F.col("__run") >= F.col("__part")) & (F.col("__run") - F.col("s") < F.col("__part"))).select("source", F.col("__b").alias("__end"), (F.col("__run") - F.col("s")).alias("__before"))
    sources = materialize(join_lookup(sources, ends, "source", n), "ends")

    fine = join_lookup(fine, sources, "source", n)
    # Only rows of the ending bucket need an order among themselves; a window over a key per row that is free for all others.
    inside = F.col("__b") == F.col("__end")
    order = W.partitionBy("source", "__b").orderBy("__h", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    edge = fine.where(inside).withColumn("__at", F.col("__before") + F.coalesce(F.sum("size").over(order), F.lit(0)))
    rest = fine.where(~F.coalesce(inside, F.lit(False))).withColumn("__at", F.lit(None).cast("long"))
    part = (
        F.when(F.col("__at").isNotNull(), F.greatest(F.lit(0), F.least(F.col("size"), F.col("__part") - F.col("__at"))))
        .when(F.col("__b") < F.col("__end"), F.col("size"))
        .otherwise(0)
    )
    out = rest.unionByName(edge).withColumn("taken", (F.col("__whole") * F.col("size") + part).cast("long"))
    out = out.withColumn("repeats", F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0.0))
    return out.drop("__h", "__b", "__whole", "__part", "__end", "__before", "__at")


def cycle_weight(weights: tuple[float, ...] = (3.0, 1.0, 2.0)) -> Column:
    """Weights dealt to the sources in turn, by rank."""
    return F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("rank"), F.lit(len(weights))) + 1).cast("int"))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    thin = materialize(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")), "sizes")  # the texts are read once
    out = mix_sources(thin, cycle_weight(), counted=True)
    return out.select("doc_id", "size", "source_size", "target", "taken", "source", "repeats")
