"""Walk-forward folds, baselines, common rows, climatology, daily and lead-wise scores, bootstrap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratocast import config as C
from stratocast.fixtures import MODELS
from stratocast.storage import stored


def folds(wide: DataFrame, by: tuple[str, ...] = ("station_id",), refit: int = C.REFIT_DAYS, least: int = C.MIN_TRAIN_DAYS, most: int = C.MAX_REFITS) -> DataFrame:
    """(by, fold, origin, end): refits from ``least`` days after the first row on, every ``refit`` days; whole days wider where there would be more than ``most``. None below ``least + refit`` days."""
    span = wide.groupBy(*by).agg(F.min("valid_time").alias("first"), F.max("valid_time").alias("last"))
    days = (F.unix_timestamp("last") - F.unix_timestamp("first")) / 86400.0 - least
    step = F.when(F.floor(days / refit) > most, F.ceil(days / most)).otherwise(F.lit(refit)).cast("int")
    out = span.where(days >= refit).withColumn("step", step).withColumn("fold", F.explode(F.sequence(F.lit(0), F.ceil(days / step).cast("int") - 1)))
    at = lambda n: F.timestamp_seconds(F.unix_timestamp("first") + (least + n * F.col("step")) * 86400)
    return out.select(*by, "fold", at(F.col("fold")).alias("origin"), at(F.col("fold") + 1).alias("end"))


def with_block(rows: DataFrame, table: DataFrame, by: tuple[str, ...] = ("station_id",)) -> DataFrame:
    """``rows`` with ``__block``: the fold that a row lies in, -1 before the first. Groups without folds drop out. A row is joined to its group's first fold, of which the others follow."""
    facts = table.groupBy(*by).agg(F.min(F.unix_timestamp("origin")).alias("__o"), F.first(F.unix_timestamp("end") - F.unix_timestamp("origin")).alias("__step"))
    block = F.greatest(F.lit(-1), F.floor((F.unix_timestamp("valid_time") - F.col("__o")) / F.col("__step"))).cast("int")
    return rows.join(facts, list(by)).withColumn("__block", block).drop("__o", "__step")


def enough(blocked: DataFrame, by: tuple[str, ...] = ("station_id",), least_rows: int = C.MIN_TRAIN_ROWS, least_test: int = C.TEST_ROWS) -> DataFrame:
    """(by, fold) with enough rows before and within it, from running counts of the blocks."""
    counts = blocked.groupBy(*by, F.col("__block").alias("fold")).agg(F.count("*").alias("now"))
    earlier = W.partitionBy(*by).orderBy("fold").rowsBetween(W.unboundedPreceding, -1)
    return counts.withColumn("early", F.sum("now").over(earlier)).where((F.col("fold") >= 0) & (F.col("early") >= least_rows) & (F.col("now") >= least_test)).select(*by, "fold")


def in_folds(wide: DataFrame, table: DataFrame, by: tuple[str, ...] = ("station_id",), cutoff_days: int = C.MAX_TRAIN_DAYS, least_rows: int = C.MIN_TRAIN_ROWS, least_test: int = C.TEST_ROWS) -> tuple[DataFrame, DataFrame]:
    """(train, test) rows keyed by fold; a row trains in folds that begin after it, at most ``cutoff_days`` after. Folds with few rows before or within them are left out.

    Rows and folds meet by blocks: a row's block says which folds follow it, and of these it asks for those that it can reach.
    """
    blocked = with_block(wide, table, by)
    kept = table.join(enough(blocked, by, least_rows, least_test), [*by, "fold"])
    facts = kept.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("fold", F.unix_timestamp("origin")))).alias("__origins"))  # as many as there are refits at most
    reached = F.filter(F.map_keys("__origins"), lambda k: (k > F.col("__block")) & (F.element_at("__origins", k) - F.unix_timestamp("valid_time") <= cutoff_days * 86400))
    train = blocked.join(facts, list(by)).withColumn("fold", F.explode(reached)).drop("__origins", "__block").join(kept.select(*by, "fold", "origin", "end"), [*by, "fold"])
    test = blocked.withColumnRenamed("__block", "fold").join(kept.select(*by, "fold", "origin", "end"), [*by, "fold"])
    columns = [*by, "fold", *[c for c in wide.columns if c not in by], "origin", "end"]
    return train.select(columns), test.select(columns)


def raw_baselines(scored: DataFrame, by: tuple[str, ...] = ("station_id",), models: tuple[str, ...] = MODELS, least: int = C.MIN_BASELINE_ROWS) -> DataFrame:
    """Per raw model its score as a point forecast, the calibrated score on the same rows, its coverage, and rows; models with few rows drop out."""
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("model"), F.abs(F.col("obs") - F.col(f"fc_{m}")).alias("raw")) for m in models]))
    long = scored.select(*by, "crps", each.alias("m")).select(*by, "crps", "m.model", "m.raw")
    out = long.groupBy(*by, "model").agg(F.avg("raw").alias("crps_raw"), F.avg(F.when(F.col("raw").isNotNull(), F.col("crps"))).alias("crps_fused"), (F.count("raw") / F.count("*")).alias("coverage"), F.count("raw").alias("n"))
    return out.where(F.col("n") >= least)


def strongest(baselines: DataFrame, by: tuple[str, ...] = ("station_id",), gate: float = C.COVERAGE_GATE) -> DataFrame:
    """The best model among those that cover enough rows, or among all if none does."""
    order = W.partitionBy(*by).orderBy(F.col("coverage") < gate, "crps_raw", "model")
    return baselines.withColumn("__r", F.row_number().over(order)).where("__r = 1").drop("__r")


def common_rows(scores: DataFrame, key: list[str], by: list[str], tier: str = "tier") -> DataFrame:
    """Rows that every tier of a group has scored."""
    tiers = scores.groupBy(*by).agg(F.count_distinct(tier).alias("__all"))
    have = scores.groupBy(*key).agg(F.count_distinct(tier).alias("__n"))
    full = have.join(tiers, by).where("__n = __all").select(*key)
    return scores.join(full, key, "left_semi")


def selection_split(wide: DataFrame, by: tuple[str, ...] = ("station_id",), share: float = C.SELECTION_SHARE) -> DataFrame:
    """``part``: select for the first share of distinct times, report for the rest."""
    times = wide.select(*by, "valid_time").distinct()
    ranked = times.withColumn("__r", F.row_number().over(W.partitionBy(*by).orderBy("valid_time"))).withColumn("__n", F.count("*").over(W.partitionBy(*by)))
    part = F.when(F.col("__n") <= 20, "shared").when(F.col("__r") <= F.floor(F.col("__n") * share), "select").otherwise("report")
    return wide.join(ranked.select(*by, "valid_time", part.alias("part")), [*by, "valid_time"])


def _around(past: DataFrame, asked: DataFrame, keys: list[str], days: int) -> DataFrame:
    """(keys, doy, near) for every asked day of the year: observations as (value, at) within ``days`` of it, sorted by value.

    Days are put together once per day of the year, not once per target: a day has few rows, and a window of days over them has ``2 * days + 1`` times as many.
    """
    rows = past.select(*keys, "doy", F.struct("value", "at").alias("x")).unionByName(asked.select(*keys, "doy").distinct().withColumn("x", F.lit(None).cast("struct<value:double,at:bigint>")))
    per_day = rows.groupBy(*keys, "doy").agg(F.collect_list("x").alias("own"))
    # The year is a ring: its first days follow its last.
    ring = per_day.withColumn("place", F.explode(F.array("doy", F.col("doy") - 365, F.col("doy") + 365))).where(F.col("place").between(1 - days, 365 + days))
    near = F.flatten(F.collect_list("own").over(W.partitionBy(*keys).orderBy("place").rangeBetween(-days, days)))
    return ring.withColumn("near", near).where("place = doy").select(*keys, "doy", F.array_sort("near").alias("near"))


def climatology(targets: DataFrame, obs: DataFrame, days: int = C.CLIMATE_DAYS, excluded: int = C.CLIMATE_EXCLUDED) -> DataFrame:
    """Quantiles of a station's observations at the same hour of day within ``days`` days of the year, the days around the target left out.

    Every (station, hour, day of year) has its observations sorted once; a target takes those that are far enough from it and reads its quantiles by rank. Where fewer
    than 10 are found, any hour counts.
    """
    day = lambda c: F.pmod(F.dayofyear(c) - 1, F.lit(365)) + 1
    asked = targets.withColumns({"hod": F.hour("target"), "doy": day("target"), "__at": F.unix_timestamp("target")})
    past = obs.where("obs IS NOT NULL").select("station_id", F.unix_timestamp("valid_time").alias("at"), F.col("obs").cast("double").alias("value"), day("valid_time").alias("doy"), F.hour("valid_time").alias("hod"))

    def banded(rows: DataFrame, keys: list[str], least: int) -> DataFrame:
        met = rows.join(_around(past, rows, keys, days), [*keys, "doy"])
        met = met.withColumn("near", F.filter("near", lambda x: F.abs(x["at"] - F.col("__at")) > excluded * 86400)).withColumn("n", F.size("near").cast("long")).where(F.col("n") >= least)

        def at(q: float) -> Column:
            h = (F.col("n") - 1) * F.lit(q)
            low = F.floor(h).cast("int")
            a, b = F.col("near")[low]["value"], F.col("near")[F.least(low + 1, (F.col("n") - 1).cast("int"))]["value"]
            return a + (b - a) * (h - low)

        return met.select("station_id", "target", F.array(*[at(q) for q in C.LEVELS]).alias("q"), "n")

    same = stored(banded(asked, ["station_id", "hod"], 10), "same_hour")
    left = asked.join(same.select("station_id", "target"), ["station_id", "target"], "left_anti")
    return same.unionByName(banded(left, ["station_id"], 5))


def bootstrap(daily: DataFrame, by: tuple[str, ...] = ("station_id",), resamples: int = C.RESAMPLES, block: int = C.BLOCK_DAYS, interval: float = C.INTERVAL) -> DataFrame:
    """Skill of ``a`` over ``b`` (daily scores with ``weight``) and its interval from resampled blocks of days.

    Block starts come from md5 of station, resample and block, so that reruns agree, and other engines too. Days are few; they are indexed per station and met by equi-join.
    """
    group = W.partitionBy(*by)
    days = daily.withColumn("i", F.row_number().over(group.orderBy("day")) - 1).withColumn("n", F.count("*").over(group)).where("n >= 3")
    size = F.least(F.lit(block), F.col("n"))
    draws = days.select(*by, "n").distinct().withColumn("size", size).withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(resamples - 1))))
    draws = draws.withColumn("block", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n") / F.col("size")).cast("int") - 1)))
    drawn_by = F.conv(F.substring(F.md5(F.concat_ws("|", *by, "r", "block")), 1, 8), 16, 10).cast("long")
    start = F.pmod(drawn_by, F.greatest(F.lit(1), F.col("n") - F.col("size") + 1))
    drawn = draws.withColumn("start", start).withColumn("o", F.explode(F.sequence(F.lit(0), F.col("size").cast("int") - 1)))
    drawn = drawn.where(F.col("block") * F.col("size") + F.col("o") < F.col("n")).select(*by, "r", (F.col("start") + F.col("o")).cast("int").alias("i"))
    sums = lambda d, keys: d.groupBy(*keys).agg(F.sum(F.col("a") * F.col("weight")).alias("sa"), F.sum(F.col("b") * F.col("weight")).alias("sb")).withColumn("skill", F.when(F.col("sb") > 0, 1 - F.col("sa") / F.col("sb")))
    tail = (1 - interval) / 2
    spread = sums(drawn.join(days.select(*by, "i", "a", "b", "weight"), [*by, "i"]), [*by, "r"]).groupBy(*by).agg(F.percentile("skill", F.lit(tail)).alias("low"), F.percentile("skill", F.lit(1 - tail)).alias("high"))
    return sums(days, by).select(*by, "skill").join(spread, list(by))


def one_source(scored: DataFrame, by: tuple[str, ...] = ("station_id",), models: tuple[str, ...] = MODELS) -> DataFrame:
    """Rows of two lead sources at one time and lead with the observation and raw models of the last source, so that each is compared with the same ones."""
    same = W.partitionBy(*by, "valid_time", "lead_h").orderBy("lead_source").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    return scored.withColumns({c: F.last(c).over(same) for c in ("obs", *[f"fc_{m}" for m in models])})


def pit_bin(p: Column, bins: int = C.PIT_BINS) -> Column:
    return F.least(F.floor(p * bins), F.lit(bins - 1)).cast("int")


def rank_tiers(scores: DataFrame, by: tuple[str, ...] = ("station_id",), key: tuple[str, ...] = ("valid_time", "lead_h"), least: int = C.COMMON_ROWS) -> DataFrame:
    """(by, tier, score, score_all, n, comparable): mean score of every tier on the rows that all tiers have, or on its own where these are too few."""
    known = scores.where("crps IS NOT NULL")
    own = known.groupBy(*by, "tier").agg(F.avg("crps").alias("score_all"))
    shared = common_rows(known, [*by, *key], list(by)).groupBy(*by, "tier").agg(F.avg("crps").alias("shared"), F.count("*").alias("n")).where(F.col("n") >= least)
    out = own.join(shared, [*by, "tier"], "left")
    all_shared = F.min(F.col("shared").isNotNull()).over(W.partitionBy(*by))
    return out.select(*by, "tier", F.coalesce("shared", "score_all").alias("score"), "score_all", F.coalesce("n", F.lit(0)).cast("long").alias("n"), all_shared.alias("comparable"))
