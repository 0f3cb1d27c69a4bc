"""Queries of designs, distributions and verification, with their SQL."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratocast import config as C
from stratocast import fixtures as X
from stratocast.functions import scores as S
from stratocast.operators import bias, design, pairing, verification
from stratocast.plans.training import _QS, STAMP, stamp, tier0_sql, wide_sql

Q, O = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            O[name] = sql
        return f

    return add


WIDE = f"WITH {X.PAIRS}, {wide_sql('pairs')}"
BUCKETED = f"{WIDE}, b AS (SELECT *, {C.BUCKET_SQL.format('lead_h')} AS bucket FROM wide)"
G = "PARTITION BY station_id, bucket"
WEIGHTED = f"""{BUCKETED}, w AS (SELECT *, exp(-greatest(age, 0) / tau) AS weight FROM (SELECT *, CASE WHEN median(lead_h) OVER ({G}) <= 48 THEN CAST(30 AS DOUBLE) ELSE CAST(60 AS DOUBLE) END AS tau,
 (epoch(max(valid_time) OVER (PARTITION BY station_id)) - epoch(valid_time)) / CAST(86400 AS DOUBLE) AS age FROM b))"""
_N = "valid_time DESC, lead_h DESC, lead_source DESC, ingest_seq DESC"
TRIMMED = f"""{WEIGHTED}, t1 AS (SELECT *, count(*) FILTER (WHERE age <= 5 * tau) OVER ({G}) AS young FROM w),
 t AS (SELECT * FROM (SELECT *, row_number() OVER ({G} ORDER BY {_N}) AS r FROM t1 WHERE age <= 5 * tau OR young < 40) WHERE r <= 6000)"""


def _wide(spark, sf, **kw):
    return pairing.wide(X.pairs(spark, sf, **kw))


def _weighted(spark, sf):
    return design.with_tau(pairing.with_bucket(_wide(spark, sf)), ["station_id", "bucket"])


@query("time_weights", f"{WEIGHTED} SELECT station_id, {STAMP}, lead_h, tau, round(weight, 8) AS weight FROM w")
def time_weights(spark: SparkSession, sf: str) -> DataFrame:
    return _weighted(spark, sf).select("station_id", stamp(), "lead_h", "tau", F.round("weight", 8).alias("weight"))


@query("trim_and_cap", f"{TRIMMED} SELECT station_id, bucket, {STAMP}, lead_h, round(weight, 8) AS weight FROM t")
def trim_and_cap(spark: SparkSession, sf: str) -> DataFrame:
    return design.trimmed(_weighted(spark, sf), ["station_id", "bucket"]).select("station_id", "bucket", stamp(), "lead_h", F.round("weight", 8).alias("weight"))


def _harmonics_sql() -> str:
    out = []
    for n in (1, 2):
        x = f"dayofyear(valid_time) * CAST({2 * math.pi * n / 365.25!r} AS DOUBLE)"
        out += [f"sin({x})", f"cos({x})"]
    for n in (1, 2):
        x = f"hour(valid_time) * CAST({2 * math.pi * n / 24.0!r} AS DOUBLE)"
        out += [f"sin({x})", f"cos({x})"]
    return ", ".join(f"round({e}, 8) + 0 AS h{i}" for i, e in enumerate(out))


@query("harmonics", f"{WIDE} SELECT station_id, {STAMP}, lead_h, {_harmonics_sql()} FROM wide")
def harmonics(spark: SparkSession, sf: str) -> DataFrame:
    return _wide(spark, sf).select("station_id", stamp(), "lead_h", *[(F.round(h, 8) + F.lit(0.0)).alias(f"h{i}") for i, h in enumerate(design.harmonics("valid_time"))])


@query("imputed_design", f"{WIDE} SELECT station_id, {STAMP}, lead_h, {', '.join(f'round(coalesce(fc_{m}, fc_mean), 6) AS x_{m}' for m in X.MODELS)}, round(fc_spread, 6) AS spread FROM wide")
def imputed_design(spark: SparkSession, sf: str) -> DataFrame:
    columns = [f"fc_{m}" for m in X.MODELS]
    return _wide(spark, sf).select("station_id", stamp(), "lead_h", *[F.round(c, 6).alias(f"x_{m}") for c, m in zip(design.imputed(columns), X.MODELS, strict=True)], F.round("fc_spread", 6).alias("spread"))


@query(
    "wls_one_regressor",
    f"{TRIMMED}, s AS (SELECT station_id, bucket, sum(weight) AS sw, sum(weight * fc_mean) AS sx, sum(weight * obs) AS sy, sum(weight * fc_mean * fc_mean) AS sxx, sum(weight * fc_mean * obs) AS sxy, count(*) AS n FROM t GROUP BY ALL), "
    "l AS (SELECT *, (sw * sxy - sx * sy) / (sw * sxx - sx * sx) AS slope FROM s) SELECT station_id, bucket, n, round(slope, 6) AS slope, round((sy - slope * sx) / sw, 6) AS intercept FROM l",
)
def wls_one_regressor(spark: SparkSession, sf: str) -> DataFrame:
    by = ["station_id", "bucket"]
    out = design.weighted_line(design.trimmed(_weighted(spark, sf), by), by, "fc_mean", "obs", "weight")
    return out.select(*by, "n", F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"))


_LOWS = ", ".join(f"('{a}-{b}', {a})" for a, b in C.LEAD_BUCKETS)


@query(
    "nearest_bucket",
    f"{BUCKETED}, f AS (SELECT station_id, bucket AS fitted_bucket FROM b GROUP BY ALL HAVING count(*) >= 40), l(bucket, low) AS (VALUES {_LOWS}), "
    "r AS (SELECT station_id, l.bucket, fitted_bucket, row_number() OVER (PARTITION BY station_id, l.bucket ORDER BY abs(l.low - k.low), k.low) AS r FROM f JOIN l k ON k.bucket = fitted_bucket CROSS JOIN l) SELECT station_id, bucket, fitted_bucket FROM r WHERE r = 1",
)
def nearest_bucket(spark: SparkSession, sf: str) -> DataFrame:
    fitted = pairing.with_bucket(_wide(spark, sf)).groupBy("station_id", F.col("bucket").alias("fitted_bucket")).count().where("count >= 40").drop("count")
    return design.nearest_bucket(fitted, ["station_id"])


# --- distributions --------------------------------------------------------------------------------

_MU, _SIGMA = "fc_mean", "(fc_spread + CAST(0.5 AS DOUBLE))"


def _scored(spark, sf, sql: str, name: str) -> DataFrame:
    return _wide(spark, sf).select("station_id", stamp(), "lead_h", F.round(F.expr(sql), 5).alias(name))


@query("crps_normal", f"{WIDE} SELECT station_id, {STAMP}, lead_h, round({S.crps_normal_sql('obs', _MU, _SIGMA)}, 5) AS crps FROM wide")
def crps_normal(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf, S.crps_normal_sql("obs", _MU, _SIGMA), "crps")


@query("crps_truncated", f"{WIDE} SELECT station_id, {STAMP}, lead_h, round({S.crps_truncated_sql('obs', _MU, _SIGMA)}, 5) AS crps FROM wide")
def crps_truncated(spark: SparkSession, sf: str) -> DataFrame:
    return _scored(spark, sf, S.crps_truncated_sql("obs", _MU, _SIGMA), "crps")


@query("normal_quantiles", f"{WIDE} SELECT station_id, {STAMP}, lead_h, {', '.join(f'round({S.quantile_normal_sql(_MU, _SIGMA, i)}, 6) AS {q}' for i, q in enumerate(C.QUANTILES))} FROM wide")
def normal_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    return _wide(spark, sf).select("station_id", stamp(), "lead_h", *[F.round(F.expr(S.quantile_normal_sql(_MU, _SIGMA, i)), 6).alias(q) for i, q in enumerate(C.QUANTILES)])


@query("truncated_quantiles", f"{WIDE} SELECT station_id, {STAMP}, lead_h, {', '.join(f'round({S.quantile_truncated_sql(_MU, _SIGMA, i)}, 5) AS {q}' for i, q in enumerate(C.QUANTILES))} FROM wide")
def truncated_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    out = S.with_truncated_quantiles(_wide(spark, sf), _MU, _SIGMA)
    return out.select("station_id", stamp(), "lead_h", *[F.round(q, 5).alias(q) for q in C.QUANTILES])


@query(
    "crps_sample",
    "WITH e AS (SELECT vec_id, list_sort(list_transform(embedding, lambda x: x::DOUBLE)) AS s, len(embedding) AS n, CAST(label AS DOUBLE) / 10 AS y FROM embeddings) "
    "SELECT vec_id, round(list_sum(list_transform(s, lambda x: abs(x - y))) / n - list_sum([s[i] * (2 * i - n - 1) for i in range(1, n + 1)]) / (n * n), 6) AS crps FROM e",
)
def crps_sample(spark: SparkSession, sf: str) -> DataFrame:
    e = spark.read.parquet(f"{sf}/embeddings.parquet")
    return e.select("vec_id", F.round(S.crps_sample(F.col("label").cast("double") / 10, F.transform("embedding", lambda x: x.cast("double"))), 6).alias("crps"))


TIER0 = f"{WIDE}, {tier0_sql('wide')}"


def _tier0(spark, sf):
    w = _wide(spark, sf)
    return bias.predict(w, w)


def _qs():
    return [F.col(q) for q in C.QUANTILES]


@query("crps_quantiles", f"{TIER0} SELECT station_id, {STAMP}, lead_h, round({S.crps_quantiles_sql('obs')}, 5) AS crps FROM tier0")
def crps_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    return _tier0(spark, sf).select("station_id", stamp(), "lead_h", F.round(S.crps_quantiles(F.col("obs"), _qs()), 5).alias("crps"))


@query("clamp_sort", f"{TIER0}, c AS (SELECT *, list_sort([" + ", ".join(f"least(greatest({q}, 2), 20)" for q in C.QUANTILES) + f"]) AS s FROM tier0) SELECT station_id, {STAMP}, lead_h, " + ", ".join(f"round(s[{i + 1}], 6)::DOUBLE AS {q}" for i, q in enumerate(C.QUANTILES)) + " FROM c")
def clamp_sort(spark: SparkSession, sf: str) -> DataFrame:
    return _tier0(spark, sf).select("station_id", stamp(), "lead_h", *[F.round(c, 6).alias(q) for c, q in zip(S.clamped(_qs(), 2.0, 20.0), C.QUANTILES, strict=True)])


# --- verification ---------------------------------------------------------------------------------

SCORED = f"{TIER0}, scored AS (SELECT *, {S.crps_quantiles_sql('obs')} AS crps FROM tier0)"
LONG = f"{SCORED}, long AS (SELECT station_id, bucket, CAST(valid_time AS DATE) AS day, crps, model, abs(obs - CASE model WHEN 'gfs' THEN fc_gfs WHEN 'ecmwf' THEN fc_ecmwf ELSE fc_icon END) AS raw FROM scored, (VALUES ('gfs'), ('ecmwf'), ('icon')) v(model))"
RAW = f"{LONG}, raw AS (SELECT station_id, model, avg(raw) AS crps_raw, avg(crps) FILTER (WHERE raw IS NOT NULL) AS crps_fused, count(raw) / count(*)::DOUBLE AS coverage, count(raw) AS n FROM long GROUP BY ALL HAVING count(raw) >= 20)"
PICK = f"{RAW}, pick AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY coverage < 0.9, crps_raw, model) AS r FROM raw) WHERE r = 1)"
_RAW_COLUMNS = "round(crps_raw, 5) AS crps_raw, round(crps_fused, 5) AS crps_fused, round(coverage, 6) AS coverage, n"


def _scored0(spark, sf):
    return _tier0(spark, sf).withColumn("crps", S.crps_quantiles(F.col("obs"), _qs()))


def _raw_columns():
    return [F.round("crps_raw", 5).alias("crps_raw"), F.round("crps_fused", 5).alias("crps_fused"), F.round("coverage", 6).alias("coverage"), "n"]


@query("raw_baselines", f"{RAW} SELECT station_id, model, {_RAW_COLUMNS} FROM raw")
def raw_baselines(spark: SparkSession, sf: str) -> DataFrame:
    return verification.raw_baselines(_scored0(spark, sf)).select("station_id", "model", *_raw_columns())


@query("pick_baseline", f"{PICK} SELECT station_id, model, {_RAW_COLUMNS}, round(1 - crps_fused / crps_raw, 5) AS skill FROM pick")
def pick_baseline(spark: SparkSession, sf: str) -> DataFrame:
    out = verification.strongest(verification.raw_baselines(_scored0(spark, sf)))
    return out.select("station_id", "model", *_raw_columns(), F.round(S.skill(F.col("crps_fused"), F.col("crps_raw")), 5).alias("skill"))


@query("daily_scores", f"{PICK} SELECT l.station_id, strftime(day, '%Y-%m-%d') AS day, round(avg(crps), 5) AS fused, round(avg(raw), 9) AS raw, count(*) AS n FROM long l JOIN pick p ON p.station_id = l.station_id AND p.model = l.model WHERE raw IS NOT NULL GROUP BY ALL")
def daily_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _daily(spark, sf).select("station_id", F.date_format("day", "yyyy-MM-dd").alias("day"), F.round("a", 5).alias("fused"), F.round("b", 9).alias("raw"), F.col("weight").alias("n"))


def _daily(spark, sf) -> DataFrame:
    """Daily mean scores of the calibrated forecast and of the strongest raw model."""
    scored = _scored0(spark, sf)
    best = verification.strongest(verification.raw_baselines(scored)).select("station_id", F.col("model").alias("best"))
    raw = F.coalesce(*[F.when(F.col("best") == m, F.abs(F.col("obs") - F.col(f"fc_{m}"))) for m in X.MODELS])
    rows = scored.join(F.broadcast(best), "station_id").withColumn("raw", raw).where("raw IS NOT NULL")
    return rows.groupBy("station_id", F.to_date("valid_time").alias("day")).agg(F.avg("crps").alias("a"), F.avg("raw").alias("b"), F.count("*").alias("weight"))


@query(
    "score_by_lead",
    f"{LONG}, g AS (SELECT station_id, bucket, model, avg(raw) AS raw, avg(crps) FILTER (WHERE raw IS NOT NULL) AS fused, count(raw) AS n FROM long GROUP BY ALL HAVING count(raw) >= 20), "
    "k AS (SELECT *, row_number() OVER (PARTITION BY station_id, bucket ORDER BY raw, model) AS r FROM g) SELECT station_id, bucket, model, n, round(fused, 5) AS fused, round(raw, 5) AS raw, round(1 - fused / raw, 5) AS skill FROM k WHERE r = 1",
)
def score_by_lead(spark: SparkSession, sf: str) -> DataFrame:
    by = ("station_id", "bucket")
    best = verification.raw_baselines(_scored0(spark, sf), by).withColumn("r", F.row_number().over(W.partitionBy(*by).orderBy("crps_raw", "model"))).where("r = 1")
    return best.select(*by, "model", "n", F.round("crps_fused", 5).alias("fused"), F.round("crps_raw", 5).alias("raw"), F.round(S.skill(F.col("crps_fused"), F.col("crps_raw")), 5).alias("skill"))


@query("pit", f"{TIER0} SELECT station_id, {STAMP}, lead_h, round({S.pit_sql('obs')}, 6) AS pit FROM tier0")
def pit(spark: SparkSession, sf: str) -> DataFrame:
    return _tier0(spark, sf).select("station_id", stamp(), "lead_h", F.round(S.pit(F.col("obs"), _qs()), 6).alias("pit"))


@query("pit_hist", f"{TIER0}, h AS (SELECT station_id, CAST(least(floor(({S.pit_sql('obs')}) * 10), 9) AS INT) AS bin, count(*) AS n FROM tier0 GROUP BY ALL) SELECT s.station_id, b.bin, coalesce(n, 0) AS n FROM (SELECT DISTINCT station_id FROM tier0) s CROSS JOIN (SELECT CAST(range AS INT) AS bin FROM range(10)) b LEFT JOIN h ON h.station_id = s.station_id AND h.bin = b.bin")
def pit_hist(spark: SparkSession, sf: str) -> DataFrame:
    p = _tier0(spark, sf).select("station_id", verification.pit_bin(S.pit(F.col("obs"), _qs())).alias("bin"))
    counts = p.groupBy("station_id").agg(*[F.count(F.when(F.col("bin") == b, 1)).alias(f"b{b}") for b in range(C.PIT_BINS)])
    return counts.select("station_id", F.posexplode(F.array(*[f"b{b}" for b in range(C.PIT_BINS)])).alias("bin", "n"))


@query("coverage_width", f"{TIER0} SELECT station_id, bucket, round(avg(CASE WHEN obs BETWEEN q05 AND q95 THEN 1 ELSE 0 END), 6) AS coverage90, round(avg(CASE WHEN obs BETWEEN q25 AND q75 THEN 1 ELSE 0 END), 6) AS coverage50, round(avg(q95 - q05), 5) AS width90 FROM tier0 GROUP BY ALL")
def coverage_width(spark: SparkSession, sf: str) -> DataFrame:
    inside = lambda a, b: F.round(F.avg(F.when(F.col("obs").between(F.col(a), F.col(b)), 1).otherwise(0)), 6)
    return _tier0(spark, sf).groupBy("station_id", "bucket").agg(inside("q05", "q95").alias("coverage90"), inside("q25", "q75").alias("coverage50"), F.round(F.avg(F.col("q95") - F.col("q05")), 5).alias("width90"))


def _events(threshold: float) -> str:
    return f"SELECT station_id, CAST({threshold} AS DOUBLE) AS threshold, {S.exceedance_sql(threshold)} AS p, CASE WHEN obs > {threshold} THEN 1 ELSE 0 END AS event FROM tier0"


EVENTS = f"{TIER0}, ev AS ({_events(10.0)} UNION ALL {_events(15.0)})"


def _exceeding(spark, sf) -> DataFrame:
    t = _tier0(spark, sf)
    each = F.explode(F.array(*[F.struct(F.lit(x).alias("threshold"), S.exceedance(x, _qs()).alias("p"), F.when(F.col("obs") > x, 1).otherwise(0).alias("event")) for x in (10.0, 15.0)]))
    return t.select("station_id", "valid_time", "lead_h", each.alias("e")).select("station_id", "valid_time", "lead_h", "e.*")


@query("exceedance", f"{TIER0} SELECT station_id, {STAMP}, lead_h, round({S.exceedance_sql(10.0)}, 6) AS p10, round({S.exceedance_sql(15.0)}, 6) AS p15 FROM tier0")
def exceedance(spark: SparkSession, sf: str) -> DataFrame:
    return _tier0(spark, sf).select("station_id", stamp(), "lead_h", *[F.round(S.exceedance(x, _qs()), 6).alias(f"p{int(x)}") for x in (10.0, 15.0)])


@query("brier", f"{EVENTS} SELECT station_id, threshold, round(avg((p - event) * (p - event)), 6) AS brier, count(*) AS n FROM ev GROUP BY ALL")
def brier(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("p") - F.col("event")
    return _exceeding(spark, sf).groupBy("station_id", "threshold").agg(F.round(F.avg(d * d), 6).alias("brier"), F.count("*").alias("n"))


@query("reliability", f"{EVENTS} SELECT station_id, threshold, CAST(least(floor(p * 10), 9) AS INT) AS bin, round(avg(p), 6) AS forecast_prob, round(avg(event), 6) AS observed_freq, count(*) AS n FROM ev GROUP BY ALL")
def reliability(spark: SparkSession, sf: str) -> DataFrame:
    bins = _exceeding(spark, sf).groupBy("station_id", "threshold", verification.pit_bin(F.col("p")).alias("bin"))
    return bins.agg(F.round(F.avg("p"), 6).alias("forecast_prob"), F.round(F.avg("event"), 6).alias("observed_freq"), F.count("*").alias("n"))


_U = "((ingest_seq * 48271) % 1000003) / CAST(1000003 AS DOUBLE)"


@query("randomised_pit", f"WITH {X.PRECIP}, {wide_sql('precip')}, {tier0_sql('wide', floor='0', additive=False)} SELECT station_id, {STAMP}, lead_h, round(CASE WHEN obs <= 0.1 THEN {_U} * (1 - ({S.exceedance_sql(0.1)})) ELSE {S.pit_sql('obs')} END, 6) AS pit FROM tier0")
def randomised_pit(spark: SparkSession, sf: str) -> DataFrame:
    w = _wide(spark, sf, precip=True)
    t = bias.predict(w, w, floor=0.0, additive=False)
    dry = F.expr(_U) * (1 - S.exceedance(0.1, _qs()))
    return t.select("station_id", stamp(), "lead_h", F.round(F.when(F.col("obs") <= 0.1, dry).otherwise(S.pit(F.col("obs"), _qs())), 6).alias("pit"))


SPAN = "SELECT station_id, min(valid_time) AS first, max(valid_time) AS last FROM wide GROUP BY ALL"
FOLDS = f"""f0 AS (SELECT *, (epoch(last) - epoch(first)) / CAST(86400 AS DOUBLE) - 21 AS days FROM ({SPAN})), f1 AS (SELECT *, CAST(CASE WHEN floor(days / 14) > 30 THEN ceil(days / 30) ELSE 14 END AS INT) AS step FROM f0 WHERE days >= 14),
 f2 AS (SELECT *, unnest(range(CAST(ceil(days / step) AS INT))) AS fold FROM f1),
 folds AS (SELECT station_id, CAST(fold AS INT) AS fold, first + to_days(CAST(21 + fold * step AS INT)) AS origin, first + to_days(CAST(21 + (fold + 1) * step AS INT)) AS "end" FROM f2)"""


@query("fold_table", f"{WIDE}, {FOLDS} SELECT station_id, fold, strftime(origin, '%Y-%m-%d %H:%M:%S') AS origin, strftime(\"end\", '%Y-%m-%d %H:%M:%S') AS \"end\" FROM folds")
def fold_table(spark: SparkSession, sf: str) -> DataFrame:
    return verification.folds(_wide(spark, sf)).select("station_id", "fold", stamp("origin"), stamp("end"))


@query("selection_split", f"{WIDE}, t AS (SELECT DISTINCT station_id, valid_time FROM wide), r AS (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY valid_time) AS r, count(*) OVER (PARTITION BY station_id) AS n FROM t), p AS (SELECT station_id, valid_time, CASE WHEN n <= 20 THEN 'shared' WHEN r <= floor(n * CAST(0.6 AS DOUBLE)) THEN 'select' ELSE 'report' END AS part FROM r) SELECT station_id, part, count(*) AS n, strftime(min(valid_time), '%Y-%m-%d %H:%M:%S') AS first FROM wide JOIN p USING (station_id, valid_time) GROUP BY ALL")
def selection_split(spark: SparkSession, sf: str) -> DataFrame:
    out = verification.selection_split(_wide(spark, sf))
    return out.groupBy("station_id", "part").agg(F.count("*").alias("n"), F.min("valid_time").alias("first")).select("station_id", "part", "n", stamp("first"))


@query(
    "common_rows",
    f"{WIDE}, s AS (SELECT station_id, valid_time, lead_h, model AS tier, abs(obs - CASE model WHEN 'gfs' THEN fc_gfs WHEN 'ecmwf' THEN fc_ecmwf ELSE fc_icon END) AS score FROM wide, (VALUES ('gfs'), ('ecmwf'), ('icon')) v(model)), k AS (SELECT * FROM s WHERE score IS NOT NULL), "
    "c AS (SELECT station_id, valid_time, lead_h FROM k GROUP BY ALL HAVING count(DISTINCT tier) = 3) SELECT station_id, tier, count(*) AS n, round(avg(score), 5) AS score FROM k JOIN c USING (station_id, valid_time, lead_h) GROUP BY ALL",
)
def common_rows(spark: SparkSession, sf: str) -> DataFrame:
    each = F.explode(F.array(*[F.struct(F.lit(m).alias("tier"), F.abs(F.col("obs") - F.col(f"fc_{m}")).alias("score")) for m in X.MODELS]))
    long = _wide(spark, sf).select("station_id", "valid_time", "lead_h", each.alias("m")).select("station_id", "valid_time", "lead_h", "m.*").where("score IS NOT NULL")
    out = verification.common_rows(long, ["station_id", "valid_time", "lead_h"], ["station_id"])
    return out.groupBy("station_id", "tier").agg(F.count("*").alias("n"), F.round(F.avg("score"), 5).alias("score"))


@query(
    "climatology",
    f"WITH {X.PAIRS}, o AS (SELECT station_id, valid_time, arg_max(obs, ingest_seq) AS obs FROM pairs GROUP BY ALL), h AS (SELECT station_id, valid_time AS seen, obs, (dayofyear(valid_time) - 1) % 365 + 1 AS doy, hour(valid_time) AS hod FROM o), "
    "t AS (SELECT DISTINCT station_id, valid_time AS target FROM o), n AS (SELECT *, ((dayofyear(target) - 1 + d + 365) % 365) + 1 AS doy, hour(target) AS hod FROM t, (SELECT unnest(range(-15, 16)) AS d)), "
    "same AS (SELECT n.station_id, target, quantile_cont(obs, [0.05, 0.25, 0.5, 0.75, 0.95]) AS q, count(*) AS n FROM n JOIN h ON h.station_id = n.station_id AND h.doy = n.doy AND h.hod = n.hod WHERE abs(epoch(seen) - epoch(target)) > 3 * 86400 GROUP BY ALL HAVING count(*) >= 10), "
    "ev AS (SELECT n.station_id, target, quantile_cont(obs, [0.05, 0.25, 0.5, 0.75, 0.95]) AS q, count(*) AS n FROM n JOIN h ON h.station_id = n.station_id AND h.doy = n.doy WHERE abs(epoch(seen) - epoch(target)) > 3 * 86400 AND NOT EXISTS (SELECT 1 FROM same s WHERE s.station_id = n.station_id AND s.target = n.target) GROUP BY ALL HAVING count(*) >= 5) "
    "SELECT station_id, strftime(target, '%Y-%m-%d %H:%M:%S') AS target, n, " + ", ".join(f"round(q[{i + 1}], 6) AS {q}" for i, q in enumerate(C.QUANTILES)) + " FROM (SELECT * FROM same UNION ALL SELECT * FROM ev)",
)
def climatology(spark: SparkSession, sf: str) -> DataFrame:
    obs = X.pairs(spark, sf).groupBy("station_id", "valid_time").agg(F.max_by("obs", "ingest_seq").alias("obs"))
    targets = obs.select("station_id", F.col("valid_time").alias("target"))
    out = verification.climatology(targets, obs)
    return out.select("station_id", stamp("target"), "n", *[F.round(F.col("q")[i], 6).alias(q) for i, q in enumerate(C.QUANTILES)])


@query("bootstrap_point", f"{PICK}, d AS (SELECT l.station_id, day, avg(crps) AS a, avg(raw) AS b, count(*) AS w FROM long l JOIN pick p ON p.station_id = l.station_id AND p.model = l.model WHERE raw IS NOT NULL GROUP BY ALL) SELECT station_id, round(1 - sum(a * w) / sum(b * w), 5) AS skill FROM d GROUP BY ALL")
def bootstrap_point(spark: SparkSession, sf: str) -> DataFrame:
    d = _daily(spark, sf).groupBy("station_id").agg((1 - F.sum(F.col("a") * F.col("weight")) / F.sum(F.col("b") * F.col("weight"))).alias("skill"))
    return d.select("station_id", F.round("skill", 5).alias("skill"))


@query(
    "bootstrap_interval",
    f"{PICK}, d0 AS (SELECT l.station_id, day, avg(crps) AS a, avg(raw) AS b, count(*) AS w FROM long l JOIN pick p ON p.station_id = l.station_id AND p.model = l.model WHERE raw IS NOT NULL GROUP BY ALL), d AS (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY day) - 1 AS i, count(*) OVER (PARTITION BY station_id) AS n FROM d0), "
    f"s AS (SELECT DISTINCT station_id, n, least({C.BLOCK_DAYS}, n) AS size FROM d WHERE n >= 3), r AS (SELECT *, unnest(range({C.RESAMPLES})) AS r FROM s), k AS (SELECT *, unnest(range(CAST(ceil(n / size) AS INT))) AS block FROM r), "
    "t AS (SELECT *, ('0x' || substr(md5(station_id || '|' || r || '|' || block), 1, 8))::BIGINT % greatest(1, n - size + 1) AS start FROM k), o AS (SELECT *, unnest(range(CAST(size AS INT))) AS o FROM t), x AS (SELECT station_id, r, start + o AS i FROM o WHERE block * size + o < n), "
    "y AS (SELECT station_id, r, 1 - sum(a * w) / sum(b * w) AS skill FROM x JOIN d USING (station_id, i) GROUP BY ALL), z AS (SELECT station_id, quantile_cont(skill, [0.05, 0.95]) AS q FROM y GROUP BY ALL), p0 AS (SELECT station_id, 1 - sum(a * w) / sum(b * w) AS skill FROM d GROUP BY ALL) "
    "SELECT station_id, round(skill, 5) AS skill, round(q[1], 5) AS low, round(q[2], 5) AS high FROM p0 JOIN z USING (station_id)",
)
def bootstrap_interval(spark: SparkSession, sf: str) -> DataFrame:
    out = verification.bootstrap(_daily(spark, sf))
    return out.select("station_id", *[F.round(c, 5).alias(c) for c in ("skill", "low", "high")])


_FOLDED = f"{WIDE}, {FOLDS}, train0 AS (SELECT w.*, fold, origin, w.station_id || '/' || fold AS sf FROM wide w JOIN folds f ON f.station_id = w.station_id AND valid_time < origin), tested AS (SELECT station_id, fold FROM wide JOIN folds USING (station_id) WHERE valid_time >= origin AND valid_time < \"end\" GROUP BY ALL HAVING count(*) >= 5), enough AS (SELECT station_id, fold FROM train0 SEMI JOIN tested USING (station_id, fold) GROUP BY ALL HAVING count(*) >= 100)"


@query(
    "walk_forward_bias",
    f"{_FOLDED}, t0 AS (SELECT station_id, fold, {C.BUCKET_SQL.format('lead_h')} AS bucket, valid_time, lead_h, lead_source, ingest_seq, fc_mean - obs AS error FROM train0 SEMI JOIN enough USING (station_id, fold) WHERE fc_mean IS NOT NULL AND obs IS NOT NULL), "
    f"r AS (SELECT *, row_number() OVER (PARTITION BY station_id, fold, bucket ORDER BY {_N}) AS r, count(*) OVER (PARTITION BY station_id, fold, bucket) AS n FROM t0), "
    "b AS (SELECT station_id, fold, bucket, sum(pow(CAST(0.92 AS DOUBLE), r - 1) * CASE WHEN r = n THEN 1 ELSE CAST(0.08 AS DOUBLE) END * error) AS bias, count(*) AS n FROM r GROUP BY ALL) SELECT station_id, fold, bucket, n, round(bias, 5) AS bias FROM b",
)
def walk_forward_bias(spark: SparkSession, sf: str) -> DataFrame:
    w = _wide(spark, sf)
    blocked = verification.with_block(w, verification.folds(w))
    state, _ = bias.fold_states(blocked, verification.enough(blocked))
    return state.select("station_id", "fold", "bucket", "n", F.round("lead", 5).alias("bias"))


@query("flagship_skill", f"{PICK} SELECT station_id, model AS best_raw, n, round(crps_fused, 5) AS crps_fused, round(crps_raw, 5) AS crps_raw, round(1 - crps_fused / crps_raw, 5) AS skill FROM pick")
def flagship_skill(spark: SparkSession, sf: str) -> DataFrame:
    out = verification.strongest(verification.raw_baselines(_scored0(spark, sf)))
    return out.select("station_id", F.col("model").alias("best_raw"), "n", F.round("crps_fused", 5).alias("crps_fused"), F.round("crps_raw", 5).alias("crps_raw"), F.round(S.skill(F.col("crps_fused"), F.col("crps_raw")), 5).alias("skill"))
