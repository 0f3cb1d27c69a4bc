"""Views over the given tables in the shape of the engine's inputs, each as a DataFrame and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MODELS = ("gfs", "ecmwf", "icon")


def _noise(m) -> str:
    return f"((l_orderkey * 7919 + l_linenumber * 104729 + ({m} + 1) * 15485863) % 1000) / CAST(1000 AS DOUBLE)"


def _forecast(m, obs: str, offset: str, lead: str) -> str:
    return f"{obs} + {offset} + ({_noise(m)} - CAST(0.5 AS DOUBLE)) * (1 + {lead} / CAST(48 AS DOUBLE))"


def reports(spark: SparkSession, sf: str) -> DataFrame:
    """Sub-hourly surface reports."""
    e = spark.read.parquet(f"{sf}/events.parquet")
    when = lambda kind, sql: F.when(F.col("event_type") == kind, F.expr(sql))
    return e.select(
        F.concat(F.lit("ASOS:"), (F.col("user_id") % 5).cast("string")).alias("station_id"),
        F.col("ts").cast("timestamp").alias("valid"),
        "event_id",
        when("view", "value / 5 - 10").alias("tmpc"),
        when("click", "value").alias("relh"),
        when("signup", "value / 10").alias("sknt"),
        when("purchase", "value / 5").alias("gust"),
        when("error", "greatest(value - 60, 0D) / 10").alias("p01m"),
        when("view", "value / 6 - 12").alias("dwpc"),
        when("signup", "CAST(event_id * 37 % 360 AS DOUBLE)").alias("drct"),
    )


REPORTS = """reports AS (SELECT 'ASOS:' || CAST(user_id % 5 AS VARCHAR) AS station_id, ts AS valid, event_id,
 CASE WHEN event_type = 'view' THEN value / 5 - 10 END AS tmpc, CASE WHEN event_type = 'click' THEN value END AS relh,
 CASE WHEN event_type = 'signup' THEN value / 10 END AS sknt, CASE WHEN event_type = 'purchase' THEN value / 5 END AS gust,
 CASE WHEN event_type = 'error' THEN greatest(value - 60, 0) / 10 END AS p01m, CASE WHEN event_type = 'view' THEN value / 6 - 12 END AS dwpc,
 CASE WHEN event_type = 'signup' THEN CAST(event_id * 37 % 360 AS DOUBLE) END AS drct FROM events)"""


def pairs(spark: SparkSession, sf: str, precip: bool = False, lead: str = "24 * l_linenumber") -> DataFrame:
    """Long forecasts with observations; ``icon`` ends at 48 hours."""
    line = spark.read.parquet(f"{sf}/lineitem.parquet")
    obs = "greatest(l_quantity - 35, 0D) / 5" if precip else "l_quantity / 2"
    base = line.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", F.expr(obs).alias("obs"), F.expr(f"CAST({lead} AS INT)").alias("lead_h"))
    if precip:
        model = [F.expr(f"greatest({_forecast(m, 'obs', f'CAST(-0.5 AS DOUBLE) + CAST(0.1 AS DOUBLE) * {m}', 'lead_h')}, 0D)") for m in range(3)]
    else:
        model = [F.expr(_forecast(m, "obs", f"CAST(1.5 AS DOUBLE) + CAST(0.5 AS DOUBLE) * {m}", "lead_h")) for m in range(3)]
        model[2] = F.when(F.col("lead_h") <= 48, model[2])
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("model"), fc.alias("fc")) for name, fc in zip(MODELS, model, strict=True)]))
    return base.select(
        F.concat(F.lit("ST"), (F.col("l_suppkey") % 4).cast("string")).alias("station_id"),
        F.expr("CAST(l_shipdate AS TIMESTAMP) + make_dt_interval(0, CAST(l_orderkey % 24 AS INT))").alias("valid_time"),
        "lead_h",
        F.lit("prev_runs").alias("lead_source"),
        "obs",
        F.expr("(l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey").alias("ingest_seq"),
        each.alias("m"),
    ).select("station_id", "valid_time", "lead_h", "lead_source", F.col("m.model").alias("model"), F.col("m.fc").alias("fc"), "obs", "ingest_seq")


def _pairs_sql(name: str, precip: bool, lead: str = "24 * l_linenumber") -> str:
    obs = "greatest(l_quantity - 35, 0) / 5" if precip else "l_quantity / 2"
    if precip:
        fc = f"greatest({_forecast('m', 'obs', 'CAST(-0.5 AS DOUBLE) + CAST(0.1 AS DOUBLE) * m', 'lead_h')}, 0)"
    else:
        fc = f"CASE WHEN model = 'icon' AND lead_h > 48 THEN NULL ELSE {_forecast('m', 'obs', 'CAST(1.5 AS DOUBLE) + CAST(0.5 AS DOUBLE) * m', 'lead_h')} END"
    return f"""{name} AS (SELECT 'ST' || CAST(l_suppkey % 4 AS VARCHAR) AS station_id, l_shipdate + to_hours(CAST(l_orderkey % 24 AS INT)) AS valid_time, lead_h,
 'prev_runs' AS lead_source, model, {fc} AS fc, obs, (l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey AS ingest_seq
 FROM (SELECT *, {obs} AS obs, CAST({lead} AS INT) AS lead_h FROM lineitem) l, (VALUES (0, 'gfs'), (1, 'ecmwf'), (2, 'icon')) v(m, model))"""


PAIRS = _pairs_sql("pairs", False)
SHORT = _pairs_sql("short", False, "l_linenumber * 5")
PRECIP = _pairs_sql("precip", True)


def stations(spark: SparkSession, sf: str) -> DataFrame:
    """Catalogue rows of three networks, with many duplicate positions."""
    nation = spark.read.parquet(f"{sf}/nation.parquet").select(F.col("n_nationkey").alias("nk"), F.col("n_name").alias("country"))
    s = spark.read.parquet(f"{sf}/supplier.parquet").select(F.lit("MS:").alias("net"), F.col("s_suppkey").alias("k"), F.col("s_name").alias("name"), F.col("s_nationkey").alias("nk"), F.col("s_acctbal").alias("bal"))
    c = spark.read.parquet(f"{sf}/customer.parquet").select(F.when(F.col("c_custkey") % 2 == 0, "NWS:").otherwise("IEM:").alias("net"), F.col("c_custkey").alias("k"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nk"), F.col("c_acctbal").alias("bal"))
    out = s.union(c).join(F.broadcast(nation), "nk")
    key = F.col("k").cast("string")
    return out.select(
        F.concat("net", key).alias("id"),
        "name",
        (F.col("k") * 7 % 50).cast("double").alias("lat"),
        (-(F.col("k") * 11 % 60) - 66).cast("double").alias("lon"),
        F.when(F.col("k") % 9 != 0, F.col("bal") / 4).alias("elev_m"),
        "country",
        F.when(F.col("net") == "NWS:", F.concat(F.when(F.col("k") % 3 == 0, "K").otherwise("X"), F.lpad(key, 3, "A"))).alias("nws_id"),
        F.when(F.col("net") == "IEM:", F.concat(F.lit("N"), (F.col("k") % 7).cast("string"))).alias("iem_network"),
        F.when(F.col("net") == "MS:", F.concat(F.lit("G"), key)).alias("ghcnh_id"),
    )


STATIONS = """stations AS (SELECT net || CAST(k AS VARCHAR) AS id, name, CAST(k * 7 % 50 AS DOUBLE) AS lat, CAST(-(k * 11 % 60) - 66 AS DOUBLE) AS lon,
 CASE WHEN k % 9 <> 0 THEN bal / 4 END AS elev_m, n_name AS country,
 CASE WHEN net = 'NWS:' THEN CASE WHEN k % 3 = 0 THEN 'K' ELSE 'X' END || CASE WHEN length(CAST(k AS VARCHAR)) > 3 THEN left(CAST(k AS VARCHAR), 3) ELSE lpad(CAST(k AS VARCHAR), 3, 'A') END END AS nws_id,
 CASE WHEN net = 'IEM:' THEN 'N' || CAST(k % 7 AS VARCHAR) END AS iem_network, CASE WHEN net = 'MS:' THEN 'G' || CAST(k AS VARCHAR) END AS ghcnh_id
 FROM (SELECT 'MS:' AS net, s_suppkey AS k, s_name AS name, s_nationkey AS nk, s_acctbal AS bal FROM supplier
 UNION ALL SELECT CASE WHEN c_custkey % 2 = 0 THEN 'NWS:' ELSE 'IEM:' END, c_custkey, c_name, c_nationkey, c_acctbal FROM customer) JOIN nation ON nk = n_nationkey)"""
