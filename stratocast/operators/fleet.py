"""Stored models of a whole fleet, and the run that keeps them: archive, refits of what changed, choice of tiers, forecasts from tables.

A model store is a folder with a table per kind of parameters, in folders by version: ``tier0``, ``tier1``, ``tier2`` (parameters), ``chosen`` (champions) and ``seen`` (what each group's rows
were when it was fitted). A run writes one version with the groups that it refitted; of every group the newest version counts. A group that can't be fitted is a row with its status, and falls
back on a lower tier; it doesn't stop the others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratocast import config as C
from stratocast.functions import scores as S
from stratocast.operators import bias, design, fits, pairing, publish, verification, walkforward
from stratocast.storage import stored

EMOS = fits.PARAMETERS
BIAS = "cells map<int,double>, lead double, band array<double>"


def save(frame: DataFrame, root: str, name: str, version: int) -> None:
    """Write a version of a table; one that is there already is replaced, so a run can be repeated."""
    frame.withColumn("version", F.lit(version)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("version").parquet(f"{root}/{name}")


def latest(spark: SparkSession, root: str, name: str, schema: str, by: tuple[str, ...] = ("station_id",)) -> DataFrame:
    """Rows of each group's newest version; no rows where nothing has been saved."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], f"{schema}, version int")
    rows = spark.read.schema(f"{schema}, version int").parquet(f"{root}/{name}")
    newest = rows.groupBy(*by).agg(F.max("version").alias("version"))
    return rows.join(newest, [*by, "version"])


def seen(wide: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """(by, n, newest): what tells whether a group's rows have changed."""
    return wide.groupBy(*by).agg(F.count("*").alias("n"), F.max("ingest_seq").alias("newest"))


def _emos(tier: int, wide: DataFrame, keys: list[str]) -> DataFrame:
    """Parameters of tier 1 or 2, as the walk-forward fits them."""
    if tier == 1:
        return fits.fit_emos(wide, keys, walkforward.members())
    waves = design.harmonics("valid_time")
    return fits.fit_emos(wide, keys, [*walkforward.members(), *waves[walkforward.YEARLY :]], least=C.SEASONAL_ROWS, taus=C.SEASONAL_TAUS, yearly=waves[: walkforward.YEARLY])


def train(wide: DataFrame, root: str, version: int, by: tuple[str, ...] = ("station_id",), tiers: tuple[int, ...] = (0, 1, 2)) -> DataFrame:
    """Refit the groups whose rows have changed since they were last fitted, choose their champions, and save both as ``version``; returns (by, n, champion, reason) of the refitted."""
    spark = wide.sparkSession
    types = ", ".join(f"{k} {t}" for k, t in wide.select(*by).dtypes)
    now = stored(seen(wide, by), "seen_now")
    before = latest(spark, root, "seen", f"{types}, n long, newest long", by).select(*by, F.col("n").alias("__n"), F.col("newest").alias("__newest"))
    due = stored(now.join(before, list(by), "left").where("NOT (n <=> __n AND newest <=> __newest)").select(*by, "n", "newest"), "due")
    rows = stored(pairing.with_bucket(wide.join(due.select(*by), list(by), "left_semi")), "due_rows")
    gates = walkforward.eligible(rows, by)
    allowed = F.filter("tiers", lambda t: F.array_contains(F.array(*[F.lit(t_) for t_ in tiers]), t))
    gates = stored(gates.withColumn("tiers", F.transform(allowed, lambda t: F.concat(F.lit("tier"), t.cast("string")))), "gates")
    # Champions: out-of-sample scores on the rows for selection, the last champion stays unless it is beaten by the margin.
    walked = walkforward.walk_forward(rows.drop("bucket"), tiers, by).withColumn("crps", S.crps_quantiles(F.col("obs"), [F.col(q) for q in C.QUANTILES]))
    split = verification.selection_split(stored(walked, "walked"), by)
    scores = verification.rank_tiers(split.where("part <> 'report'"), by)
    old = latest(spark, root, "chosen", f"{types}, champion string", by)
    incumbents = gates.select(*by).join(old.select(*by, F.col("champion").alias("incumbent")), list(by), "left")
    chosen = stored(walkforward.choose(scores, gates, incumbents, by), "chosen")
    for tier in tiers:
        # A tier is fitted where it is allowed, so that a champion always has those below it to fall back on.
        own = rows.join(gates.where(F.array_contains("tiers", f"tier{tier}")).select(*by), list(by), "left_semi")
        save(bias.parameters(own, by) if tier == 0 else _emos(tier, own, [*by, "bucket"]), root, f"tier{tier}", version)
    save(chosen.select(*by, "champion"), root, "chosen", version)
    save(due, root, "seen", version)  # last: a run that breaks off is made again
    return due.select(*by, "n").join(chosen.select(*by, "champion", "reason"), list(by), "left")


def forecast(live: DataFrame, root: str, by: tuple[str, ...] = ("station_id",), tiers: tuple[int, ...] = (0, 1, 2)) -> DataFrame:
    """Rows of ``live`` with quantiles of each group's champion, or of the highest tier below that is calibrated; from stored tables alone."""
    spark = live.sparkSession
    types = ", ".join(f"{k} {t}" for k, t in live.select(*by).dtypes)
    keys, rows = [*by, "bucket"], pairing.with_bucket(live)
    out: DataFrame | None = None
    for tier in tiers:
        if tier == 0:
            table = latest(spark, root, "tier0", f"{types}, bucket string, {BIAS}", by)
            part = bias.predict_from(rows, table, by)
        else:
            table = latest(spark, root, f"tier{tier}", f"{types}, bucket string, {EMOS}", by).drop("version")
            waves = design.harmonics("valid_time")
            x = walkforward.members() if tier == 1 else [*walkforward.members(), *waves[walkforward.YEARLY :], *waves[: walkforward.YEARLY]]
            part = fits.predict_emos(rows, table, keys, x)
        part = part.select(*dict.fromkeys((*by, *pairing.KEY)), "fc_mean", *C.QUANTILES, "calibrated", F.lit(f"tier{tier}").alias("tier"))
        out = part if out is None else out.unionByName(part)
    champions = latest(spark, root, "chosen", f"{types}, champion string", by)
    return walkforward.first_calibrated(stored(out, "tiers"), champions.select(*by, "champion"), by)


def run(archive: DataFrame, new: DataFrame, live: DataFrame, stations: DataFrame, fresh: DataFrame, root: str, version: int, by: tuple[str, ...] = ("station_id",), tiers: tuple[int, ...] = (0, 1, 2)) -> DataFrame:
    """(by, status, champion, tier, n_live, q50) of every station: new pairs are put over the archive, changed groups refitted, and the live rows forecast from the store.

    ``fresh`` are the stations that have reported lately. A backfill is a run whose archive is empty; a refresh has a trailing window of new pairs over it.
    """
    more = tuple(k for k in by if k not in pairing.KEY)
    history = stored(pairing.upsert(archive, new, more), "archive")
    train(pairing.wide(history, more=more), root, version, by, tiers)
    predicted = forecast(pairing.wide(live, more=more), root, by, tiers)
    sums = stored(predicted.where("calibrated AND q50 IS NOT NULL").groupBy(*by).agg(F.first("tier").alias("tier"), F.count("*").alias("n_live"), F.sum("q50").alias("q50")), "sums")
    types = ", ".join(f"{k} {t}" for k, t in sums.select(*by).dtypes)
    champions = latest(stations.sparkSession, root, "chosen", f"{types}, champion string", by).select(*by, "champion")
    named = lambda df: df.select(F.to_json(F.struct(*by)).alias("station_id"))
    status = publish.statuses(named(stations), named(live), named(fresh), named(history), named(sums))
    out = stations.select(*by, F.to_json(F.struct(*by)).alias("__id")).join(status.withColumnRenamed("station_id", "__id"), "__id").drop("__id")
    return out.join(champions, list(by), "left").join(sums, list(by), "left")
