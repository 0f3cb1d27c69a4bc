"""Connected components and linking within buckets, as Spark jobs.

``connected_components`` alternates large-star and small-star steps over tables of edges; only counts come to the driver.

``link_buckets`` finds the components that verified links make among items that share buckets, without ever emitting
all pairs of a bucket. In each round a few leaders per bucket meet the bucket's members that are not yet in the same component; verified
links contract components, and a leader that has met everyone leaves the bucket. A bucket is done when one component is left in it. The number of
leaders grows by rounds, so few rounds are needed even where nothing links, and no pair that could join two components is left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratocast.llm._common import discard, materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id in ``edges`` (a, b); ``component`` is the smallest id reachable."""
    edges = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "edges")
    while True:
        # Large star: every larger neighbour of a node is linked to the smallest of its neighbourhood.
        both = edges.union(edges.select("b", "a").toDF("a", "b"))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # Small star: a node's smaller neighbours, and itself, are linked to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        before = edges
        edges = materialize(small.union(low.select("a", F.col("m").alias("b"))).where("a != b").distinct(), "edges")
        discard(before)
        # Done when each node has one edge, to a root.
        ends = edges.select(F.col("a").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(edges.select("b", F.lit(0), F.lit(1)))
        ends = ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into"))
        if not ends.where("out > 1 or (out > 0 and into > 0)").take(1):
            break
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(roots).distinct()


def link_buckets(
    members: DataFrame, verify: Callable[[DataFrame], DataFrame], settle: Callable[[DataFrame, DataFrame], DataFrame] | None = None, possible: str = "true", first: str = "xxhash64(id)", small: int = 1, factor: int = 16, start: tuple[DataFrame, DataFrame] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Components of the items in ``members`` (bucket long, id long, other columns): (id, component) of all items that got linked, and the links.

    ``verify`` takes rows of a leader and a member that share a bucket (``leader``, ``id``, the columns of members, and those of the
    leader under names that begin with ``leader_``) and returns the links among them as (a, b, ...); a link with the same columns counts once.
    Members that are in one component need not meet, unless ``settle`` (members and links to members with a boolean ``settled``) says that one of them
    still wants a link of its own in this bucket. ``possible`` is a condition on the same columns that every link meets in one of its buckets. In buckets of up to ``small`` members all are leaders at once. Leaders are taken in the order of ``first``,
    which should not depend on the bucket, so that a group picks the same ones in all buckets that it shares. ``start`` has the components and links that are known where all
    members have met the first leader already; ``verify`` is then asked for each leader and member once a round, without other columns, and its tables are removed when others take their place.
    """
    extra = [c for c in members.columns if c not in ("bucket", "id")]
    labels, links = start or (None, None)
    own: DataFrame | None = None  # what this function wrote of the members
    leaders = factor if start else 1
    while True:
        known = members.withColumn("component", F.col("id")) if labels is None else members.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
        known = known.withColumn("settled", F.lit(settle is None)) if settle is None or links is None else settle(known, links)
        # Buckets of one component, all settled, are done; this pre-aggregates before the shuffle.
        open_buckets = known.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("id").alias("first"), F.max("id").alias("last"), F.min("settled").alias("all_settled"), F.count("*").alias("size"))
        open_buckets = open_buckets.where("low != high or (first != last and not all_settled)").select("bucket", "size")
        alive = materialize(known.join(open_buckets, "bucket"), "alive")
        if own is not None:
            discard(own)
        if links is not None and not alive.take(1):
            break
        # Leaders are limited before the shuffle, so that a large bucket is never put in order as a whole.
        ranked = alive.where(f"size > {small}").withColumn("rank", F.row_number().over(W.partitionBy("bucket").orderBy(F.expr(first), "id"))).where(F.col("rank") <= leaders).drop("rank")
        chosen = ranked.unionByName(alive.where(f"size <= {small}"))
        chosen = materialize(chosen.select("bucket", F.col("id").alias("leader"), F.col("component").alias("leader_component"), F.col("settled").alias("leader_settled"), *[F.col(c).alias(f"leader_{c}") for c in extra]), "leaders")
        met = alive.join(chosen, "bucket").where("id != leader and (component != leader_component or not (settled and leader_settled))")
        met = met.where(f"size > {small} or id > leader").where(possible)  # where all lead, a pair meets once
        if start:  # two that meet in very many buckets
            met = met.select("leader", "id").distinct()
        if links is not None:
            met = materialize(met, "met")
        found = materialize(verify(met), "links") if links is None or met.take(1) else links.limit(0)
        if links is not None:
            discard(met)
        some = bool(found.take(1))
        old = links, labels
        links = found if links is None else materialize(links.union(found).distinct(), "links") if some else links
        if some:
            labels = materialize(connected_components(links), "labels")
            discard(*[x for x in (*old, found if old[0] is not None else None) if x is not None])
        # A leader has met all others of its bucket.
        members = own = materialize(alive.select("bucket", "id", *extra).join(chosen.select("bucket", F.col("leader").alias("id")).distinct(), ["bucket", "id"], "left_anti"), "members")
        discard(alive, chosen)
        leaders *= factor
    if labels is None:
        labels = members.sparkSession.createDataFrame([], "id long, component long")
    return labels, links
