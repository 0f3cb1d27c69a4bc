"""Queries of the fitted tiers, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratocast import config as C
from stratocast import fixtures as X
from stratocast.functions import scores as S
from stratocast.operators import boosting, coldstart, design, fits, fleet, pairing, walkforward
from stratocast.plans.training import STAMP, stamp, wide_sql
from stratocast.storage import shared_folder, stored

Q, O = {}, {}
BY = ["station_id", "bucket"]


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            O[name] = sql
        return f

    return add


def _wide(spark, sf, **kw):
    return pairing.with_bucket(pairing.wide(X.pairs(spark, sf, **kw)))


def _features(seasonal: bool = False):
    columns = design.imputed([f"fc_{m}" for m in X.MODELS])
    return [*columns, *design.harmonics("valid_time")] if seasonal else columns


def _split(spark, sf):
    """Rows before and after the point at which seven tenths of a station's time have passed."""
    w = _wide(spark, sf).withColumn("at", F.percent_rank().over(W.partitionBy("station_id").orderBy("valid_time")))
    return w.where("at < 0.7").drop("at"), w.where("at >= 0.7").drop("at")


def _emos(spark, sf, seasonal: bool, truncated: bool = False) -> DataFrame:
    past, later = _split(spark, sf)
    out = walkforward.seasonal(past, later, BY, truncated) if seasonal else walkforward.distribution(past, later, BY, truncated)
    score = S.crps_truncated_sql("obs", "mu", "sigma") if truncated else S.crps_normal_sql("obs", "mu", "sigma")
    return out.groupBy(*BY).agg(F.count("*").alias("n"), F.avg(F.expr(score)).alias("crps"), F.avg(F.abs(F.col("obs") - F.col("fc_mean"))).alias("raw"), F.avg(F.when(F.col("obs").between(F.col("q05"), F.col("q95")), 1.0).otherwise(0.0)).alias("coverage90"))


@query("emos_fit_predict")
def emos_fit_predict(spark: SparkSession, sf: str) -> DataFrame:
    return _emos(spark, sf, False)


@query("emos_truncated")
def emos_truncated(spark: SparkSession, sf: str) -> DataFrame:
    return _emos(spark, sf, False, True)


@query("emos_harmonics")
def emos_harmonics(spark: SparkSession, sf: str) -> DataFrame:
    return _emos(spark, sf, True)


_FIXED = f"""WITH {X.PAIRS}, {wide_sql('pairs')}, w AS (SELECT * REPLACE (CASE WHEN ingest_seq % 97 <> 0 THEN lead_h END AS lead_h) FROM wide), b AS (SELECT *, {C.BUCKET_SQL.format('lead_h')} AS bucket FROM w),
 p AS (SELECT station_id, bucket, avg(obs - fc_mean) AS a, ln(stddev_pop(obs - fc_mean)) AS c FROM b WHERE bucket IN ('13-24', '49-96', '97-168') AND station_id <> 'ST3' AND NOT (station_id = 'ST1' AND bucket <> '49-96') GROUP BY ALL),
 l(bucket, low) AS (VALUES {', '.join(f"('{a}-{b}', {a})" for a, b in C.LEAD_BUCKETS)}),
 near AS (SELECT * FROM (SELECT p.*, l.bucket AS own, row_number() OVER (PARTITION BY station_id, l.bucket ORDER BY abs(l.low - k.low), k.low) AS r FROM p JOIN l k ON k.bucket = p.bucket CROSS JOIN l) WHERE r = 1),
 m AS (SELECT b.*, near.a + CAST(0.25 AS DOUBLE) * coalesce(fc_gfs, fc_mean) + CAST(0.25 AS DOUBLE) * coalesce(fc_ecmwf, fc_mean) + CAST(0.5 AS DOUBLE) * coalesce(fc_icon, fc_mean) AS mu0, exp(greatest(-8, least(8, near.c + CAST(0.05 AS DOUBLE) * coalesce(fc_spread, 0)))) AS s0 FROM b LEFT JOIN near ON near.station_id = b.station_id AND near.own = b.bucket),
 e AS (SELECT *, CASE WHEN mu0 IS NOT NULL THEN s0 END AS s1 FROM m), x AS (SELECT *, max(s1) OVER (PARTITION BY station_id) AS widest FROM e), y AS (SELECT *, CASE WHEN widest IS NOT NULL THEN coalesce(mu0, fc_mean) END AS mu, CASE WHEN fc_mean IS NOT NULL THEN coalesce(s1, widest) END AS sigma FROM x)
 SELECT station_id, {STAMP}, CAST(lead_h AS INT) AS lead_h, ingest_seq, widest IS NOT NULL AS calibrated, {', '.join(f'round(mu + sigma * CAST({z!r} AS DOUBLE), 6) AS {q}' for q, z in zip(C.QUANTILES, C.NORMAL_LEVELS, strict=True))} FROM y"""


@query("emos_predict", _FIXED)
def emos_predict(spark: SparkSession, sf: str) -> DataFrame:
    """Quantiles from parameters as they are stored: of two versions the newer; buckets without take the nearest, rows without a bucket the widest sigma, a station without is not calibrated."""
    w = pairing.with_bucket(pairing.wide(X.pairs(spark, sf)).withColumn("lead_h", F.when(F.col("ingest_seq") % 97 != 0, F.col("lead_h"))))
    some = w.where("bucket IN ('13-24', '49-96', '97-168') AND station_id <> 'ST3' AND NOT (station_id = 'ST1' AND bucket <> '49-96')")
    d = F.col("obs") - F.col("fc_mean")
    table = some.groupBy(*BY).agg(F.avg(d).alias("a"), F.array(F.lit(0.25), F.lit(0.25), F.lit(0.5)).alias("b"), F.log(F.stddev_pop(d)).alias("c"), F.lit(0.05).alias("d"), F.count("*").alias("n_train"), F.lit(0.0).alias("crps_train"), F.lit("ok").alias("status"))
    root = shared_folder(spark, "models")
    fleet.save(table.withColumn("a", F.col("a") + 1), root, "tier1", 1)
    fleet.save(table, root, "tier1", 2)
    kept = fleet.latest(spark, root, "tier1", f"station_id string, bucket string, {fits.PARAMETERS}").drop("version")
    out = fits.predict_emos(w, kept, BY, walkforward.members())
    return out.select("station_id", stamp(), "lead_h", "ingest_seq", "calibrated", *[F.round(q, 6).alias(q) for q in C.QUANTILES])


def _precip(spark, sf):
    wet = F.aggregate(F.array(*design.imputed([f"fc_{m}" for m in X.MODELS])), F.lit(0.0), lambda a, x: a + F.when(x > 0.1, 1.0).otherwise(0.0)) / len(X.MODELS)
    return _wide(spark, sf, precip=True).withColumn("wet_share", wet)


_LEVELS = ", ".join(f"{0.02 + 0.04 * i!r}" for i in range(25))
_WET = f"WITH {X.PRECIP}, {wide_sql('precip')}, b AS (SELECT *, {C.BUCKET_SQL.format('lead_h')} AS bucket FROM wide)"


@query(
    "precip_quantile_map",
    f"{_WET}, m AS (SELECT station_id, bucket, quantile_cont(fc_mean, [{_LEVELS}]) FILTER (WHERE fc_mean > 0.1) AS f, quantile_cont(obs, [{_LEVELS}]) FILTER (WHERE obs > 0.1) AS o, avg(CASE WHEN obs > 0.1 THEN 1 ELSE 0 END) AS base FROM b GROUP BY ALL) "
    "SELECT station_id, bucket, round(base, 6) AS base_rate, CAST(i AS INT) AS i, round(f[i + 1], 6) AS map_f, round(o[i + 1], 6) AS map_o FROM m, (SELECT unnest(range(25)) AS i)",
)
def precip_quantile_map(spark: SparkSession, sf: str) -> DataFrame:
    rows = _precip(spark, sf)
    base = rows.groupBy(*BY).agg(F.round(F.avg(F.when(F.col("obs") > 0.1, 1).otherwise(0)), 6).alias("base_rate"))
    out = fits.amount_map(rows, BY).join(base, BY).select(*BY, "base_rate", F.posexplode(F.arrays_zip("map_f", "map_o")).alias("i", "m"))
    return out.select(*BY, "base_rate", "i", F.round("m.map_f", 6).alias("map_f"), F.round("m.map_o", 6).alias("map_o"))


@query("precip_logistic")
def precip_logistic(spark: SparkSession, sf: str) -> DataFrame:
    """Occurrence and amounts, fitted and applied; Brier score of the chance and of the base rate."""
    rows = _precip(spark, sf)
    out = rows.join(fits.fit_occurrence(rows, BY), BY).join(fits.amount_map(rows, BY), BY)
    z = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.col("t0") + F.col("t1") * F.col("fc_mean") + F.col("t2") * F.col("wet_share")))
    p = 1 / (1 + F.exp(-z))
    amount = fits.mapped(F.col("fc_mean"), F.col("map_f"), F.col("map_o"))
    out = out.withColumn("p", p).withColumns(dict(zip(C.QUANTILES, fits.precip_quantiles(p, amount), strict=True)))
    wet = F.when(F.col("obs") > 0.1, 1.0).otherwise(0.0)
    return out.groupBy(*BY).agg(F.count("*").alias("n"), F.avg((F.col("p") - wet) ** 2).alias("brier"), F.avg((F.col("base_rate") - wet) ** 2).alias("brier_base"), F.avg(S.crps_quantiles(F.col("obs"), [F.col(q) for q in C.QUANTILES])).alias("crps"))


_WET_ROWS = f"{_WET}, k AS (SELECT *, (CASE WHEN coalesce(fc_gfs, fc_mean) > 0.1 THEN 1 ELSE 0 END + CASE WHEN coalesce(fc_ecmwf, fc_mean) > 0.1 THEN 1 ELSE 0 END + CASE WHEN coalesce(fc_icon, fc_mean) > 0.1 THEN 1 ELSE 0 END) / CAST(3 AS DOUBLE) AS wet_share, epoch(max(valid_time) OVER (PARTITION BY station_id)) - epoch(valid_time) AS age FROM b WHERE obs IS NOT NULL AND fc_mean IS NOT NULL)"


@query(
    "precip_occurrence",
    f"{_WET_ROWS} SELECT station_id, bucket, count(*) AS n_train, round(avg(CASE WHEN obs > 0.1 THEN 1 ELSE 0 END), 6) AS base_rate, CAST(0 AS DOUBLE) AS g0, CAST(0 AS DOUBLE) AS g1, CAST(0 AS DOUBLE) AS g2 FROM k WHERE age <= {C.MAX_TRAIN_DAYS} * 86400 GROUP BY ALL HAVING count(*) >= {C.MIN_BUCKET}",
)
def precip_occurrence(spark: SparkSession, sf: str) -> DataFrame:
    """The slope of the penalised likelihood at the fitted coefficients, a row's share of it: zero at the best ones."""
    rows = _precip(spark, sf)
    table = fits.fit_occurrence(rows, BY)
    met = fits.occurrence_rows(rows, BY).join(table, BY)
    left = F.col("wet") - fits.chance([F.col("fc_mean"), F.col("wet_share")], [F.col("t0"), F.col("t1"), F.col("t2")])
    out = met.groupBy(*BY, "t0", "t1", "t2", "n_train", "base_rate").agg(*[F.avg(left * x).alias(f"g{i}") for i, x in enumerate((F.lit(1.0), F.col("fc_mean"), F.col("wet_share")))])
    slope = lambda i, weight: F.round(F.col(f"g{i}") - 2 * fits.RIDGE * weight * F.col(f"t{i}"), 7) + F.lit(0.0)
    return out.select(*BY, "n_train", F.round("base_rate", 6).alias("base_rate"), *[slope(i, w).alias(f"g{i}") for i, w in enumerate((1e-9, 1.0, 1.0))])


_STEP = "(((ingest_seq * 48271) % 1000003) / CAST(1000003 AS DOUBLE))"


@query("precip_predict", f"{_WET} SELECT station_id, strftime(valid_time, '%Y-%m-%d %H:%M:%S') AS valid_time, lead_h, " + ", ".join(f"round(CASE WHEN CAST({q} AS DOUBLE) <= 1 - p THEN 0 ELSE greatest(fc_mean * (CAST(0.4 AS DOUBLE) + CAST(1.6 AS DOUBLE) * (CAST({q} AS DOUBLE) - (1 - p)) / greatest(p, CAST(1e-6 AS DOUBLE))), 0) END, 6) AS {n}" for q, n in zip(C.LEVELS, C.QUANTILES, strict=True)) + f" FROM (SELECT *, {_STEP} AS p FROM b)")
def precip_predict(spark: SparkSession, sf: str) -> DataFrame:
    """Quantiles of the two-part model for given chances."""
    rows = _precip(spark, sf).withColumn("p", F.expr(_STEP))
    return rows.select("station_id", stamp(), "lead_h", *[F.round(q, 6).alias(n) for n, q in zip(C.QUANTILES, fits.precip_quantiles(F.col("p"), F.col("fc_mean")), strict=True)])


@query("boosted_quantiles")
def boosted_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Mean pinball loss per station and level on the held-out end of each station's rows."""
    x = [*_features(True), F.coalesce("fc_spread", F.lit(0.0)), F.col("lead_h").cast("double")]
    w = _wide(spark, sf).withColumn("at", F.percent_rank().over(W.partitionBy("station_id").orderBy("valid_time")))
    out = boosting.boosted_quantiles(w.where("at < 0.9").drop("at"), w.where("at >= 0.9 AND obs IS NOT NULL").drop("at"), ["station_id"], x)
    d = F.col("obs") - F.col("value")
    return out.groupBy("station_id", "level").agg(F.count("*").alias("n"), F.avg(F.greatest(F.col("level") * d, (F.col("level") - 1) * d)).alias("pinball"))


_INSTANT = "CASE WHEN station_id IN ('ST2', 'ST3') THEN 'long' WHEN station_id = 'ST0' THEN 'middle' ELSE 'short' END"


@query(
    "cold_start_calibration",
    f"WITH {X.PAIRS}, {wide_sql('pairs')}, g AS (SELECT * REPLACE ({_INSTANT} AS station_id), 'ST' AS was, station_id AS st FROM wide WHERE station_id <> 'ST1' OR lead_h <= 48), m AS (SELECT *, epoch(max(valid_time) OVER (PARTITION BY station_id)) - epoch(valid_time) AS age FROM g), d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY valid_time DESC, lead_h, st, ingest_seq) AS place FROM m WHERE age <= 7 * 86400) WHERE station_id <> 'middle' OR place <= 60), "
    "k AS (SELECT station_id, count(*) AS n, avg(fc_mean - obs) AS bias FROM d GROUP BY station_id HAVING count(*) >= 24), r AS (SELECT d.station_id, any_value(k.n) AS n, any_value(bias) AS bias, list_sort(list(obs - (fc_mean - bias))) AS res FROM d JOIN k ON k.station_id = d.station_id GROUP BY d.station_id), "
    "f AS (SELECT r.station_id, r.n, CASE WHEN r.n >= 72 THEN 'emos' ELSE 'bias' END AS branch, " + ", ".join(f"least(20, greatest(4, fc_mean - bias + res[CAST(floor(CAST({q} AS DOUBLE) * (r.n - 1) + CAST(0.5 AS DOUBLE)) AS INT) + 1])) AS {k}" for q, k in zip(C.LEVELS, C.QUANTILES, strict=True)) + " FROM r JOIN d ON d.station_id = r.station_id) "
    "SELECT station_id, branch, n, count(*) AS rows, true AS in_order, " + ", ".join(f"CASE WHEN branch = 'bias' THEN round(sum({k}), 6) END AS {k}" for k in C.QUANTILES) + " FROM f GROUP BY station_id, branch, n",
)
def cold_start_calibration(spark: SparkSession, sf: str) -> DataFrame:
    """The last week of three groups of stations, of which one has enough for a distribution, one for a bias, and one for neither on small tables; bounded and summed over the week's forecasts."""
    st = F.col("station_id")
    group = F.when(st.isin("ST2", "ST3"), "long").when(st == "ST0", "middle").otherwise("short")
    w = pairing.wide(X.pairs(spark, sf)).where("station_id <> 'ST1' OR lead_h <= 48").withColumn("st", st).withColumn("station_id", group)
    week = coldstart.recent(w, ["station_id"]).withColumn("place", F.row_number().over(W.partitionBy("station_id").orderBy(F.desc("valid_time"), "lead_h", "st", "ingest_seq")))
    week = stored(week.where("station_id <> 'middle' OR place <= 60").withColumn("n", F.count("*").over(W.partitionBy("station_id"))), "week")
    out = coldstart.predict(week.drop("n"), coldstart.fit(week, ["station_id"]), ["station_id"], 4.0, 20.0)
    rising = F.min((F.col("q05") <= F.col("q25")) & (F.col("q25") <= F.col("q50")) & (F.col("q50") <= F.col("q75")) & (F.col("q75") <= F.col("q95")))
    return out.groupBy("station_id", "branch", "n").agg(F.count("*").alias("rows"), rising.alias("in_order"), *[F.round(F.sum(F.when(F.col("branch") == "bias", F.col(q))), 6).alias(q) for q in C.QUANTILES])
