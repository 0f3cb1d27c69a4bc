"""Walking the archive: every tier fitted per fold on what lies before it and applied to the fold; the choice among tiers, and the forecast that is published.

A fold is a key like the station; all folds of all stations are fitted in one pass per tier.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratocast import config as C
from stratocast.fixtures import MODELS
from stratocast.functions.scores import clamped
from stratocast.operators import bias, boosting, design, fits, pairing, verification
from stratocast.storage import stored

#: How far back the rows of a fold reach, by tier: those of fitted distributions as far as any fit looks, those of boosted quantiles over all of the past, as do those of tier 0.
REACH = {1: C.MAX_TRAIN_DAYS, 2: C.MAX_TRAIN_DAYS, 3: 36_500}
YEARLY = 4  # sines and cosines of the year, which lead those of the day


def members() -> list:
    return design.imputed([f"fc_{m}" for m in MODELS])


def distribution(train: DataFrame, test: DataFrame, by: list[str], truncated: bool = False) -> DataFrame:
    """Tier 1: a minimum-CRPS distribution per bucket."""
    return fits.predict_emos(test, fits.fit_emos(train, by, members(), truncated), by, members(), truncated)


def seasonal(train: DataFrame, test: DataFrame, by: list[str], truncated: bool = False) -> DataFrame:
    """Tier 2: the same with harmonics of the hour, and of the year where a bucket's rows span enough of it; it looks back twice as long."""
    waves = design.harmonics("valid_time")
    x = [*members(), *waves[YEARLY:]]
    table = fits.fit_emos(train, by, x, truncated, least=C.SEASONAL_ROWS, taus=C.SEASONAL_TAUS, yearly=waves[:YEARLY])
    return fits.predict_emos(test, table, by, [*x, *waves[:YEARLY]], truncated)


def boosted(train: DataFrame, test: DataFrame, by: list[str]) -> DataFrame:
    """Tier 3: boosted quantiles over all leads of a station."""
    x = [*members(), *design.harmonics("valid_time"), F.coalesce("fc_spread", F.lit(0.0)), F.col("lead_h").cast("double")]
    long = boosting.boosted_quantiles(train, test, by, x)
    key = [*by, "valid_time", "lead_h"]
    wide = long.groupBy(*key).pivot("level", list(C.LEVELS)).agg(F.avg("value"))
    ordered = F.array_sort(F.array(*[F.col(f"`{q}`") for q in C.LEVELS]))
    wide = wide.select(*key, ordered.alias("__q"))
    out = test.join(wide, key, "left").withColumn("calibrated", F.col("__q").isNotNull())
    return out.withColumns({q: F.col("__q")[i] for i, q in enumerate(C.QUANTILES)}).drop("__q")


class Kind(NamedTuple):
    """How a variable is fitted: its distribution, and the bounds of its quantiles."""

    family: str = "normal"
    low: float | None = None
    high: float | None = None


def kinds(variables: tuple[str, ...] = C.VARIABLES) -> dict[Kind, list[str]]:
    """Variables by how they are fitted."""
    out: dict[Kind, list[str]] = {}
    for v in variables:
        low, high = C.BOUNDS.get(v, (None, None))
        family = "rain" if v == "precip_1h_mm" else "truncated" if low == 0.0 and high is None else "normal"
        out.setdefault(Kind(family, low, high), []).append(v)
    return out


def rain(train: DataFrame, test: DataFrame, by: list[str]) -> DataFrame:
    """Tiers 1 and 2 of precipitation: chance of rain and mapped amounts per bucket, of the nearest bucket where one has none; ``p_occ`` beside the quantiles."""
    wet = F.aggregate(F.array(*members()), F.lit(0.0), lambda a, x: a + F.when(x > C.OCCURRENCE, 1.0).otherwise(0.0)) / len(MODELS)
    train, test = train.withColumn("wet_share", wet), test.withColumn("wet_share", wet)
    keys = [k for k in by if k != "bucket"]
    fitted = fits.fit_occurrence(train, by).drop("n_train", "base_rate").join(fits.amount_map(train, by), by).withColumnRenamed("bucket", "fitted_bucket")
    fitted = stored(fitted, "rain")
    near = design.nearest_bucket(fitted.select(*keys, "fitted_bucket"), keys).join(fitted, [*keys, "fitted_bucket"])
    out = test.join(near, by, "left")
    p = fits.chance([F.col("fc_mean"), F.col("wet_share")], [F.col("t0"), F.col("t1"), F.col("t2")])
    out = out.withColumn("p_occ", p).withColumn("calibrated", F.col("t0").isNotNull())
    values = fits.precip_quantiles(F.col("p_occ"), fits.mapped(F.col("fc_mean"), F.col("map_f"), F.col("map_o")))
    return out.withColumns({q: F.when(F.col("p_occ").isNotNull(), v) for q, v in zip(C.QUANTILES, values, strict=True)}).drop("t0", "t1", "t2", "map_f", "map_o", "fitted_bucket", "wet_share")


def _published(out: DataFrame, tier: int, keys: tuple[str, ...], kind: Kind) -> DataFrame:
    if tier and (kind.low is not None or kind.high is not None):
        out = out.withColumns(dict(zip(C.QUANTILES, clamped([F.col(q) for q in C.QUANTILES], kind.low, kind.high), strict=True)))
    chance = F.col("p_occ") if "p_occ" in out.columns else F.lit(None).cast("double").alias("p_occ")
    kept = [*keys, *[c for c in pairing.KEY if c not in keys], "bucket", "ingest_seq", "obs", "fc_mean", *[f"fc_{m}" for m in MODELS], *C.QUANTILES, chance, "calibrated"]
    return out.select(*kept, F.lit(f"tier{tier}").alias("tier"))


def predict_tier(tier: int, train: DataFrame, test: DataFrame, keys: tuple[str, ...], kind: Kind = Kind()) -> DataFrame:  # noqa: B008
    """``test`` (with its bucket) with the quantiles that a tier fitted on ``train`` gives, ``p_occ`` (of precipitation) and ``tier``."""
    train, test = pairing.with_bucket(train), pairing.with_bucket(test)
    by = [*keys, "bucket"]
    if tier == 0:
        out = bias.predict(test, train, keys, kind.low, kind.high, kind.family != "rain")
    elif tier == 3:
        out = boosted(train, test, list(keys))
    elif kind.family == "rain":
        out = rain(train, test, by)
    else:
        out = (distribution if tier == 1 else seasonal)(train, test, by, kind.family == "truncated")
    return _published(out, tier, keys, kind)


def walk_forward(wide: DataFrame, tiers: tuple[int, ...] = (0, 1, 2), by: tuple[str, ...] = ("station_id",), kind: Kind = Kind()) -> DataFrame:  # noqa: B008
    """Rows of all folds that each tier predicted before they were seen; only calibrated ones.

    ``by`` may hold the variable besides the station; the variables of a call are of one kind (``walk_variables`` calls it for each kind).
    """
    table = stored(verification.folds(wide, by), "folds")
    out: DataFrame | None = None
    for tier in tiers:
        if tier == 0:
            blocked = verification.with_block(wide, table, by)
            part = _published(bias.predict_folds(blocked, verification.enough(blocked, by), by, kind.low, kind.high, kind.family != "rain"), 0, (*by, "fold"), kind)
        else:
            train, test = verification.in_folds(wide, table, by, REACH[tier])
            part = predict_tier(tier, train, test, (*by, "fold"), kind)
        part = part.where("calibrated AND q50 IS NOT NULL")
        out = part if out is None else out.unionByName(part)
    return out


def walk_variables(wide: DataFrame, tiers: tuple[int, ...] = (0, 1, 2, 3), by: tuple[str, ...] = ("station_id", "variable"), variables: tuple[str, ...] = C.VARIABLES) -> DataFrame:
    """``walk_forward`` of all variables of all stations (``wide`` has ``variable``): one pass per kind of variable, of which there are four."""
    out: DataFrame | None = None
    for kind, names in kinds(variables).items():
        part = walk_forward(wide.where(F.col("variable").isin(names)), tiers, by, kind)
        out = part if out is None else out.unionByName(part)
    return out


def eligible(wide: DataFrame, by: tuple[str, ...] = ("station_id",)) -> DataFrame:
    """(by, days, n, tiers): those that a group's span of days and number of rows allow."""
    span = wide.where("obs IS NOT NULL").groupBy(*by).agg(((F.unix_timestamp(F.max("valid_time")) - F.unix_timestamp(F.min("valid_time"))) / 86400.0).alias("days"), F.count("*").alias("n"))
    return span.withColumn("tiers", F.array_compact(F.array(*[F.when((F.col("days") >= d) & (F.col("n") >= n), t) for t, d, n in C.TIER_GATES])))


def choose(scores: DataFrame, gates: DataFrame, incumbents: DataFrame, by: tuple[str, ...] = ("station_id",), margin: float = C.MARGIN) -> DataFrame:
    """(by, best, incumbent, champion, reason): the best-scored of the eligible tiers; the incumbent stays unless it is beaten by the margin; tier 0 where none has a score.

    ``scores`` has (by, tier, score), ``gates`` (by, tiers: names), ``incumbents`` (by, incumbent).
    """
    open_ = gates.select(*by, F.explode("tiers").alias("tier")).join(scores.select(*by, "tier", "score").where("score IS NOT NULL"), [*by, "tier"])
    best = open_.groupBy(*by).agg(F.min(F.struct("score", "tier")).alias("b"))
    kept = incumbents.select(*by, "incumbent").join(open_.select(*by, F.col("tier").alias("incumbent"), F.col("score").alias("own")), [*by, "incumbent"], "left")
    out = gates.select(*by).join(best, list(by), "left").join(kept, list(by), "left")
    lead = (F.col("own") - F.col("b.score")) / F.col("own")
    stays = (F.col("own") > 0) & (F.col("incumbent") != F.col("b.tier")) & (lead < margin)
    champion = F.when(F.col("b").isNull(), "tier0").when(F.coalesce(stays, F.lit(False)), F.col("incumbent")).otherwise(F.col("b.tier"))
    reason = F.when(F.col("b").isNull(), "no score").when(F.coalesce(stays, F.lit(False)), "within the margin").otherwise("lowest score")
    return out.select(*by, F.col("b.tier").alias("best"), "incumbent", champion.alias("champion"), reason.alias("reason"))


def training_plan(gates: DataFrame, decided: DataFrame, by: tuple[str, ...] = ("station_id",), least: int = C.TRAIN_ROWS) -> DataFrame:
    """(by, n, status, champion, to_fit): the champion with tiers 1 and 0 as fallbacks. Without a new decision the last champion stays if it is eligible, else the highest eligible tier."""
    out = gates.join(decided.select(*by, "champion", "previous"), list(by), "left")
    highest = F.element_at("tiers", -1)
    kept = F.when(F.array_contains("tiers", F.col("previous")), F.col("previous")).otherwise(highest)
    champion = F.when(F.col("n") >= least, F.coalesce("champion", kept))
    fallback = F.filter(F.array(F.lit("tier1"), F.lit("tier0")), lambda t: F.array_contains("tiers", t))
    status = F.when(F.col("n") >= least, "ok").otherwise("insufficient_data")
    return out.select(*by, "n", status.alias("status"), champion.alias("champion"), F.when(champion.isNotNull(), F.array_distinct(F.concat(F.array(champion), fallback))).alias("to_fit"))


def first_calibrated(predictions: DataFrame, champions: DataFrame, by: tuple[str, ...] = ("station_id",)) -> DataFrame:
    """One forecast per row: the champion's if it is calibrated, else the highest tier's that is; ``tier`` says whose.

    A tier counts for a station as a whole, so a station's forecast doesn't mix tiers.
    """
    have = predictions.where("calibrated").select(*by, "tier").distinct().join(champions.select(*by, "champion"), list(by), "left")
    order = W.partitionBy(*by).orderBy((F.coalesce("champion", F.lit("")) == F.col("tier")).desc(), F.desc("tier"))
    used = have.withColumn("__r", F.row_number().over(order)).where("__r = 1").select(*by, "tier")
    return predictions.join(used, [*by, "tier"])
