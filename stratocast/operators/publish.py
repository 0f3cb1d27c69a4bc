"""What is published of stations, and the run that makes it for all of them at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratocast import config as C
from stratocast.fixtures import MODELS
from stratocast.functions import scores as S
from stratocast.operators import verification
from stratocast.storage import stored


def family(variable: Column) -> Column:
    """Distribution that a variable is fitted with."""
    floored = [v for v, (low, high) in C.BOUNDS.items() if low == 0.0 and high is None and v != "precip_1h_mm"]
    return F.when(variable == "precip_1h_mm", "bernoulli_quantile_map").when(variable.isin(*floored), "truncated_normal").otherwise("normal")


def rain_probabilities(rows: DataFrame, thresholds: tuple[float, ...]) -> DataFrame:
    """(station_id, threshold, basis, p, event): the chance of more than each threshold, from the occurrence model at its own threshold, else from the quantiles."""
    quantiles = [F.col(q) for q in C.QUANTILES]
    own = lambda x: abs(x - C.OCCURRENCE) < 1e-9
    each = [
        F.struct(F.lit(x).alias("threshold"), F.lit("occurrence model" if own(x) else "predictive quantiles").alias("basis"), (F.col("p_occ") if own(x) else S.exceedance(x, quantiles)).alias("p"), F.when(F.col("obs") > x, 1).otherwise(0).alias("event"))
        for x in thresholds
    ]
    return rows.select("station_id", F.explode(F.array(*each)).alias("e")).select("station_id", "e.*")


def blocks(cards: DataFrame) -> DataFrame:
    """``cards`` (tier, train_days, n_pairs, skill, low) with the structs ``method`` and ``skill_block`` of a forecast document. A gain counts as one only if its whole interval lies above zero."""
    label = F.element_at(F.create_map(*[F.lit(x) for kv in C.TIER_LABELS.items() for x in kv]), F.col("tier"))
    method = F.struct("tier", label.alias("label"), F.round("train_days", 1).alias("train_days"), "n_pairs")
    measured = F.col("skill").isNotNull()
    skill = F.struct(F.when(measured, "verified").otherwise("warming_up").alias("status"), "skill", F.when(measured, F.coalesce(F.col("low") > 0, F.lit(False))).alias("beats_raw"))
    return cards.withColumns({"method": method, "skill_block": skill})


def pit_shares(counts: DataFrame, bins: int = C.PIT_BINS) -> DataFrame:
    """Shares of the bins of a histogram (station_id, bin, n), and what each has over an even share."""
    known = counts.where("bin IS NOT NULL")
    share = F.col("n") / F.sum("n").over(W.partitionBy("station_id"))
    return known.withColumn("share", share).withColumn("excess", F.col("share") - 1.0 / bins)


def scorecard(walked: DataFrame, pairs: DataFrame, by: tuple[str, ...] = ("station_id",), thresholds: tuple[float, ...] = (), history: DataFrame | None = None, resamples: int = C.RESAMPLES) -> DataFrame:
    """A card per group of ``pairs`` (by, n_pairs): ``status``, and for those with rows enough the blocks of what was measured.

    ``walked`` are out-of-sample rows (tier, crps, quantiles, models). The tier with the lowest score on the first part of the times is the champion; the card measures it on the rest, or on
    all rows where either part has fewer than ``config.HELD_OUT_ROWS`` of a tier (``held_out`` says so). Blocks: ``scores`` of all tiers, ``raw`` per model, ``interval`` of the gain,
    ``coverage``, ``pit``, ``brier`` per threshold with what the chance was read from, ``by_lead``, ``daily`` (the newest ``config.DAILY_DAYS`` days), ``climate`` where there is a ``history``.
    All come from one stored table of the champion's rows; the gain counts as one only if its whole interval lies above zero.
    """
    group = list(by)
    split = verification.selection_split(walked, by)
    parts = split.groupBy(*by, "tier").agg(*[F.count(F.when(F.col("part") == p, 1)).alias(p) for p in ("select", "report", "shared")])
    held = parts.groupBy(*by).agg(F.min((F.col("select") >= C.HELD_OUT_ROWS) & (F.col("report") >= C.HELD_OUT_ROWS)).alias("held_out"))
    split = split.join(held, group)
    ranked = stored(verification.rank_tiers(split.where("NOT held_out OR part = 'select'"), by), "ranked")
    scores = ranked.groupBy(*by).agg(F.min_by("tier", F.struct("score", "tier")).alias("champion"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("tier", "score")))).alias("scores"), F.min("comparable").alias("comparable"))
    mine = split.where("NOT held_out OR part = 'report'").join(scores.select(*by, F.col("champion").alias("tier")), [*by, "tier"])
    mine = stored(verification.one_source(mine, by), "champions_rows")
    raws = stored(verification.raw_baselines(mine, by), "raws")
    best = verification.strongest(raws, by).select(*by, F.col("model").alias("best_raw"), F.col("crps_raw"), F.col("crps_fused"), F.col("coverage").alias("raw_coverage"))
    raw = raws.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("model", F.struct("crps_raw", "crps_fused", "coverage", "n"))))).alias("raw"))
    quantiles = [F.col(q) for q in C.QUANTILES]
    own = lambda x: abs(x - C.OCCURRENCE) < 1e-9
    has_p = "p_occ" in mine.columns
    chance = lambda x: F.coalesce("p_occ", S.exceedance(x, quantiles)) if own(x) and has_p else S.exceedance(x, quantiles)
    miss = lambda x: (chance(x) - F.when(F.col("obs") > x, 1.0).otherwise(0.0)) ** 2
    basis = lambda x: F.when(F.count("p_occ") > 0, "occurrence model").otherwise("predictive quantiles") if own(x) and has_p else F.lit("predictive quantiles")
    inside = lambda a, b: F.avg(F.when(F.col("obs").between(F.col(a), F.col(b)), 1.0).otherwise(0.0))
    width = lambda a, b: F.avg(F.col(b) - F.col(a))
    bins = verification.pit_bin(S.pit(F.col("obs"), quantiles))
    briers = [x for t in thresholds for x in (F.lit(str(t)), F.struct(F.avg(miss(t)).alias("brier"), basis(t).alias("probability_from")))]
    sums = mine.groupBy(*by).agg(
        F.count("*").alias("n_eval"), F.avg("crps").alias("crps"), F.avg(F.abs(F.col("obs") - F.col("q50"))).alias("mae"),
        F.struct(inside("q25", "q75").alias("inside50"), width("q25", "q75").alias("width50"), inside("q05", "q95").alias("inside90"), width("q05", "q95").alias("width90")).alias("coverage"),
        F.array(*[F.count(F.when(bins == b, 1)) for b in range(C.PIT_BINS)]).alias("pit"), (F.create_map(*briers) if briers else F.lit(None)).alias("brier"),
    )
    of_best = F.coalesce(*[F.when(F.col("best_raw") == m, F.abs(F.col("obs") - F.col(f"fc_{m}"))) for m in MODELS])
    met = mine.join(best.select(*by, "best_raw"), group, "left").withColumn("raw", of_best).withColumn("day", F.to_date("valid_time"))
    daily = met.groupBy(*by, "day").agg(F.avg("crps").alias("fused"), F.avg(F.when(F.col("raw").isNotNull(), F.col("crps"))).alias("a"), F.avg("raw").alias("b"), F.count("raw").alias("weight"))
    daily = stored(daily, "daily")
    newest = daily.withColumn("__r", F.row_number().over(W.partitionBy(*by).orderBy(F.desc("day")))).where(F.col("__r") <= C.DAILY_DAYS)
    series = newest.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("day", F.round("fused", 4).alias("fused"), F.round("b", 4).alias("raw")))).alias("daily"))
    interval = verification.bootstrap(daily.where("weight > 0"), by, resamples).select(*by, F.struct("low", "high").alias("interval"))
    # Within a bucket of leads the best model is the one that is best there.
    local = verification.raw_baselines(mine, [*by, "bucket"], least=C.LOCAL_ROWS)
    at = local.groupBy(*by, "bucket").agg(F.min_by(F.struct("model", "crps_raw", "crps_fused"), F.struct("crps_raw", "model")).alias("best"))
    leads = mine.groupBy(*by, "bucket").agg(F.count("*").alias("n"), F.avg("crps").alias("crps")).where(F.col("n") >= C.MIN_BASELINE_ROWS).join(at, [*by, "bucket"], "left")
    by_lead = leads.groupBy(*by).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("bucket", F.struct("n", "crps", "best"))))).alias("by_lead"))
    out = pairs.join(scores, group, "left").join(held, group, "left")
    for part in (sums, best, raw, interval, by_lead, series):
        out = out.join(part, group, "left")
    if history is not None:
        climate = verification.climatology(mine.select("station_id", F.col("valid_time").alias("target")).distinct(), history)
        scored = mine.join(climate.withColumnRenamed("target", "valid_time"), ["station_id", "valid_time"])
        out = out.join(scored.groupBy(*by).agg(F.avg(S.crps_quantiles(F.col("obs"), [F.col("q")[i] for i in range(len(C.LEVELS))])).alias("climate")), group, "left")
    enough = (F.col("n_pairs") >= C.CARD_ROWS) & F.col("champion").isNotNull()
    skill = F.when(F.col("crps_raw") > 0, 1 - F.col("crps_fused") / F.col("crps_raw"))
    blocks_ = [c for c in out.columns if c not in (*by, "n_pairs")]
    out = out.withColumns({"skill": skill, "beats_raw": F.coalesce(F.col("interval.low") > 0, F.lit(False))})
    return out.select(*by, "n_pairs", F.when(enough, "ok").otherwise("insufficient_data").alias("status"), *[F.when(enough, F.col(c)).alias(c) for c in (*blocks_, "skill", "beats_raw")])


def card_tables(cards: DataFrame, by: tuple[str, ...] = ("station_id",)) -> tuple[DataFrame, DataFrame]:
    """What a page shows of cards: tiers by score with the champion marked, and raw models by score with the baseline marked; null where a card has none."""
    tiers = cards.where("status = 'ok'").select(*by, "champion", F.explode("scores").alias("tier", "score")).select(*by, "tier", "score", (F.col("tier") == F.col("champion")).alias("is_champion"))
    order = lambda c, name: F.row_number().over(W.partitionBy(*by).orderBy(c, name)).alias("place")
    models = cards.where("status = 'ok'").select(*by, "best_raw", F.explode("raw").alias("model", "r")).select(*by, "model", "r.*", (F.col("model") == F.col("best_raw")).alias("is_baseline"))
    return tiers.select("*", order("score", "tier")), models.select("*", order("crps_raw", "model"))


def statuses(stations: DataFrame, live: DataFrame, fresh: DataFrame, history: DataFrame, calibrated: DataFrame) -> DataFrame:
    """(station_id, status) from who has a live forecast, fresh reports, a stored history and a calibrated forecast. Fresh reports are not needed where there is a history."""
    out = stations
    for name, part in (("live", live), ("fresh", fresh), ("history", history), ("calibrated", calibrated)):
        out = out.join(part.select("station_id").distinct().withColumn(name, F.lit(True)), "station_id", "left")
    nothing = F.when(F.col("fresh"), "no_data").otherwise("no_observations")
    status = F.when(F.col("live").isNull(), "no_forecast").when(F.col("history").isNull(), nothing).when(F.col("calibrated").isNull(), "warming_up").otherwise("ok")
    return out.select("station_id", status.alias("status"))
