"""Queries from reports to bias-corrected quantiles, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratocast import config as C
from stratocast import fixtures as X
from stratocast.operators import bias, pairing, quality

Q, O = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            O[name] = sql
        return f

    return add


def stamp(c: str = "valid_time"):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


STAMP = "strftime(valid_time, '%Y-%m-%d %H:%M:%S') AS valid_time"
_MEASURES = ", ".join(f"round({c}, 6) AS {c}" for c in quality.MEASURES)


def _obs(df: DataFrame) -> DataFrame:
    return df.select("station_id", stamp(), *[F.round(c, 6).alias(c) for c in quality.MEASURES])


HOURLY = """hourly AS (SELECT station_id, date_trunc('hour', valid) AS valid_time, avg(tmpc) AS air_temp_c, avg(dwpc) AS dewpoint_c, avg(relh) AS relative_humidity_pct,
 avg(sknt) * CAST(0.514444 AS DOUBLE) AS wind_speed_ms, max(gust) * CAST(0.514444 AS DOUBLE) AS wind_gust_ms, median(drct) AS wind_dir_deg, max(p01m) AS precip_1h_mm FROM reports GROUP BY ALL)"""
RANGED = "ranged AS (SELECT station_id, valid_time, " + ", ".join(f"CASE WHEN {c} BETWEEN {lo} AND {hi} THEN {c} END AS {c}" for c, (lo, hi) in C.RANGES.items()) + " FROM hourly)"
DEWED = "dewed AS (SELECT * REPLACE (CASE WHEN coalesce(dewpoint_c > air_temp_c + 1, false) THEN NULL ELSE dewpoint_c END AS dewpoint_c) FROM ranged)"


def _stepped(src: str) -> str:
    w = "OVER (PARTITION BY station_id ORDER BY valid_time)"
    return "stepped AS (SELECT * REPLACE (" + ", ".join(f"CASE WHEN coalesce(abs({c} - lag({c}) {w}) > {lim}, false) THEN NULL ELSE {c} END AS {c}" for c, lim in C.STEPS.items()) + f") FROM {src})"


def _flat(src: str, columns=("air_temp_c", "wind_speed_ms", "relative_humidity_pct"), rows: int = C.FLATLINE_ROWS) -> str:
    w = "OVER (PARTITION BY station_id ORDER BY valid_time)"
    runs = ", ".join(f"CASE WHEN {c} IS NULL OR lag({c}) {w} IS NULL OR {c} <> lag({c}) {w} THEN 1 ELSE 0 END AS n_{c}" for c in columns)
    sums = ", ".join(f"sum(n_{c}) OVER (PARTITION BY station_id ORDER BY valid_time ROWS UNBOUNDED PRECEDING) AS r_{c}" for c in columns)
    ats = ", ".join(f"row_number() OVER (PARTITION BY station_id, r_{c} ORDER BY valid_time) AS a_{c}" for c in columns)
    calm = {"wind_speed_ms": " AND wind_speed_ms > 0.05"}
    out = ", ".join(f"CASE WHEN coalesce(a_{c} >= {rows}{calm.get(c, '')}, false) THEN NULL ELSE {c} END AS {c}" for c in columns)
    drop = ", ".join(f"{p}_{c}" for c in columns for p in "nra")
    return f"flat1 AS (SELECT *, {runs} FROM {src}), flat2 AS (SELECT *, {sums} FROM flat1), flat3 AS (SELECT *, {ats} FROM flat2), flat AS (SELECT * EXCLUDE ({drop}) REPLACE ({out}) FROM flat3)"


@query("asos_hourly", f"WITH {X.REPORTS}, {HOURLY} SELECT station_id, {STAMP}, {_MEASURES} FROM hourly")
def asos_hourly(spark: SparkSession, sf: str) -> DataFrame:
    return _obs(quality.hourly(X.reports(spark, sf)))


@query(
    "first_report_per_hour",
    f"WITH {X.REPORTS}, r AS (SELECT *, date_trunc('hour', valid) AS valid_time, row_number() OVER (PARTITION BY station_id, date_trunc('hour', valid) ORDER BY valid, event_id) AS k FROM reports) "
    f"SELECT station_id, {STAMP}, event_id, round(tmpc, 6) AS air_temp_c, round(sknt * CAST(0.514444 AS DOUBLE), 6) AS wind_speed_ms, round(relh, 6) AS relative_humidity_pct FROM r WHERE k = 1",
)
def first_report_per_hour(spark: SparkSession, sf: str) -> DataFrame:
    out = quality.first_report(X.reports(spark, sf))
    return out.select("station_id", stamp(), "event_id", *[F.round(c, 6).alias(c) for c in ("air_temp_c", "wind_speed_ms", "relative_humidity_pct")])


@query("asos_station_list", f"WITH {X.REPORTS} SELECT station_id, count(*) AS n_reports, strftime(min(valid), '%Y-%m-%d %H:%M:%S') AS first_report FROM reports GROUP BY station_id HAVING count(*) >= 100")
def asos_station_list(spark: SparkSession, sf: str) -> DataFrame:
    found = X.reports(spark, sf).groupBy("station_id").agg(F.count("*").alias("n_reports"), F.min("valid").alias("first_report"))
    return found.where("n_reports >= 100").select("station_id", "n_reports", F.date_format("first_report", "yyyy-MM-dd HH:mm:ss").alias("first_report"))


@query("qc_range", f"WITH {X.REPORTS}, {HOURLY}, {RANGED} SELECT station_id, {STAMP}, {_MEASURES} FROM ranged")
def qc_range(spark: SparkSession, sf: str) -> DataFrame:
    return _obs(quality.range_screen(quality.hourly(X.reports(spark, sf))))


@query("qc_dewpoint", f"WITH {X.REPORTS}, {HOURLY}, {RANGED}, {DEWED} SELECT station_id, {STAMP}, {_MEASURES} FROM dewed")
def qc_dewpoint(spark: SparkSession, sf: str) -> DataFrame:
    return _obs(quality.dewpoint_screen(quality.range_screen(quality.hourly(X.reports(spark, sf)))))


@query("qc_step", f"WITH {X.REPORTS}, {HOURLY}, {_stepped('hourly')} SELECT station_id, {STAMP}, {_MEASURES} FROM stepped")
def qc_step(spark: SparkSession, sf: str) -> DataFrame:
    return _obs(quality.step_screen(quality.hourly(X.reports(spark, sf))))


_FLOORED = "floored AS (SELECT * REPLACE (floor(air_temp_c / 8) AS air_temp_c, floor(wind_speed_ms / 20) AS wind_speed_ms, floor(relative_humidity_pct / 60) AS relative_humidity_pct) FROM hourly WHERE air_temp_c IS NOT NULL AND relative_humidity_pct IS NOT NULL)"


@query("qc_flatline", f"WITH {X.REPORTS}, {HOURLY}, {_FLOORED}, {_flat('floored', rows=5)} SELECT station_id, {STAMP}, {_MEASURES} FROM flat")
def qc_flatline(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality.hourly(X.reports(spark, sf)).where("air_temp_c IS NOT NULL AND relative_humidity_pct IS NOT NULL")
    floored = rows.withColumns({c: F.floor(F.col(c) / d).cast("double") for c, d in (("air_temp_c", 8), ("wind_speed_ms", 20), ("relative_humidity_pct", 60))})
    return _obs(quality.flatline_screen(floored, rows=5))


@query("qc_all", f"WITH {X.REPORTS}, {HOURLY}, {RANGED}, {DEWED}, {_stepped('dewed')}, {_flat('stepped')} SELECT station_id, {STAMP}, {_MEASURES} FROM flat WHERE coalesce({', '.join(quality.MEASURES)}) IS NOT NULL")
def qc_all(spark: SparkSession, sf: str) -> DataFrame:
    return _obs(quality.all_screens(quality.hourly(X.reports(spark, sf))))


@query("hourly_dedupe", f"WITH {X.REPORTS}, k AS (SELECT station_id, date_trunc('hour', valid) AS valid_time, event_id, row_number() OVER (PARTITION BY station_id, date_trunc('hour', valid) ORDER BY event_id DESC) AS r FROM reports) SELECT station_id, {STAMP}, event_id FROM k WHERE r = 1")
def hourly_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    rows = X.reports(spark, sf).select("station_id", F.col("valid").alias("valid_time"), "event_id")
    return quality.newest_per_hour(rows, [F.col("event_id")]).select("station_id", stamp(), "event_id")


@query(
    "cumulative_increment",
    f"WITH {X.REPORTS}, {HOURLY} SELECT station_id, {STAMP}, round(CASE WHEN lag(relative_humidity_pct) OVER (PARTITION BY station_id ORDER BY valid_time) IS NOT NULL THEN greatest(relative_humidity_pct - lag(relative_humidity_pct) OVER (PARTITION BY station_id ORDER BY valid_time), 0) END * CAST(25.4 AS DOUBLE), 6) AS precip_1h_mm FROM hourly WHERE relative_humidity_pct IS NOT NULL",
)
def cumulative_increment(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality.hourly(X.reports(spark, sf)).where("relative_humidity_pct IS NOT NULL").withColumnRenamed("relative_humidity_pct", "total")
    out = quality.increments(rows, "total", "precip_1h_mm")
    return out.select("station_id", stamp(), F.round("precip_1h_mm", 6).alias("precip_1h_mm"))


# --- pairs ----------------------------------------------------------------------------------------

_W = "PARTITION BY station_id, valid_time, lead_h, lead_source"


def wide_sql(src: str, name: str = "wide") -> str:
    cells = ", ".join(f"arg_max(fc, ingest_seq) FILTER (WHERE model = '{m}') AS fc_{m}" for m in X.MODELS)
    a = "[x for x in [fc_gfs, fc_ecmwf, fc_icon] if x IS NOT NULL]"
    return f"""{name}_0 AS (SELECT station_id, valid_time, lead_h, lead_source, {cells}, arg_max(obs, ingest_seq) AS obs, max(ingest_seq) AS ingest_seq FROM {src} WHERE fc IS NOT NULL GROUP BY ALL),
 {name}_1 AS (SELECT *, list_sum({a}) / len({a}) AS fc_mean FROM {name}_0),
 {name} AS (SELECT *, sqrt(list_sum([(x - fc_mean) * (x - fc_mean) for x in {a}]) / len({a})) AS fc_spread FROM {name}_1)"""


@query(
    "build_pairs",
    f"WITH {X.PAIRS}, o AS (SELECT station_id, valid_time, arg_max(obs, ingest_seq) AS obs FROM pairs WHERE lead_h = 24 AND obs > 2 GROUP BY ALL) "
    f"SELECT p.station_id, strftime(p.valid_time, '%Y-%m-%d %H:%M:%S') AS valid_time, lead_h, model, count(*) AS n, round(avg(fc), 6) AS fc, round(avg(o.obs), 6) AS obs FROM pairs p JOIN o USING (station_id, valid_time) GROUP BY ALL",
)
def build_pairs(spark: SparkSession, sf: str) -> DataFrame:
    p = X.pairs(spark, sf)
    out = pairing.build_pairs(p.drop("obs"), p.where("lead_h = 24 AND obs > 2").select("station_id", "valid_time", "obs", "ingest_seq"))
    return out.groupBy("station_id", stamp(), "lead_h", "model").agg(F.count("*").alias("n"), F.round(F.avg("fc"), 6).alias("fc"), F.round(F.avg("obs"), 6).alias("obs"))


@query("pair_upsert", f"WITH {X.PAIRS}, r AS (SELECT *, row_number() OVER ({_W}, model ORDER BY ingest_seq DESC) AS k FROM pairs) SELECT station_id, {STAMP}, lead_h, model, round(fc, 6) AS fc, ingest_seq FROM r WHERE k = 1")
def pair_upsert(spark: SparkSession, sf: str) -> DataFrame:
    p = X.pairs(spark, sf)
    out = pairing.upsert(p.where("ingest_seq % 2 = 0"), p.where("ingest_seq % 2 = 1"))
    return out.select("station_id", stamp(), "lead_h", "model", F.round("fc", 6).alias("fc"), "ingest_seq")


_WIDE_COLUMNS = ("fc_gfs", "fc_ecmwf", "fc_icon", "obs", "fc_mean", "fc_spread")


@query("wide_matrix", f"WITH {X.PAIRS}, {wide_sql('pairs')} SELECT station_id, {STAMP}, lead_h, {', '.join(f'round({c}, 6) AS {c}' for c in _WIDE_COLUMNS)} FROM wide")
def wide_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return pairing.wide(X.pairs(spark, sf)).select("station_id", stamp(), "lead_h", *[F.round(c, 6).alias(c) for c in _WIDE_COLUMNS])


@query("mean_and_spread", f"WITH {X.PAIRS} SELECT station_id, {STAMP}, lead_h, count(fc) AS n_models, round(avg(fc), 6) AS fc_mean, round(stddev_pop(fc), 6) AS fc_spread FROM pairs WHERE fc IS NOT NULL GROUP BY ALL")
def mean_and_spread(spark: SparkSession, sf: str) -> DataFrame:
    p = X.pairs(spark, sf).where("fc IS NOT NULL").groupBy("station_id", stamp(), "lead_h")
    return p.agg(F.count("fc").alias("n_models"), F.round(F.avg("fc"), 6).alias("fc_mean"), F.round(F.stddev_pop("fc"), 6).alias("fc_spread"))


@query("live_wide", f"WITH {X.PAIRS} SELECT station_id, {STAMP}, {', '.join(f'''round(arg_max(fc, ingest_seq) FILTER (WHERE model = '{m}' AND fc IS NOT NULL), 6) AS fc_{m}''' for m in X.MODELS)} FROM pairs WHERE lead_h <= 48 GROUP BY station_id, pairs.valid_time")
def live_wide(spark: SparkSession, sf: str) -> DataFrame:
    live = X.pairs(spark, sf).where("lead_h <= 48 AND fc IS NOT NULL")
    return live.groupBy("station_id", stamp()).pivot("model", list(X.MODELS)).agg(F.round(F.max_by("fc", "ingest_seq"), 6)).select("station_id", "valid_time", *[F.col(m).alias(f"fc_{m}") for m in X.MODELS])


@query("lead_bucket_counts", f"WITH {X.SHORT} SELECT {C.BUCKET_SQL.format('lead_h')} AS bucket, model, count(*) AS n, count(fc) AS n_known FROM short GROUP BY ALL")
def lead_bucket_counts(spark: SparkSession, sf: str) -> DataFrame:
    return pairing.with_bucket(X.pairs(spark, sf, lead="l_linenumber * 5")).groupBy("bucket", "model").agg(F.count("*").alias("n"), F.count("fc").alias("n_known"))


@query("availability", f"WITH {X.PAIRS} SELECT station_id, model, count(fc) > 0 AS available, count(fc) AS n_values, max(CASE WHEN fc IS NOT NULL THEN lead_h END) AS longest_lead FROM pairs GROUP BY ALL")
def availability(spark: SparkSession, sf: str) -> DataFrame:
    return X.pairs(spark, sf).groupBy("station_id", "model").agg((F.count("fc") > 0).alias("available"), F.count("fc").alias("n_values"), F.max(F.when(F.col("fc").isNotNull(), F.col("lead_h"))).alias("longest_lead"))


# --- tier 0 ---------------------------------------------------------------------------------------

_NEW = "ORDER BY valid_time DESC, lead_h DESC, lead_source DESC, ingest_seq DESC"


def tier0_sql(wide: str, floor: str | None = None, additive: bool = True, key: str = "station_id") -> str:
    error = "fc_mean - obs" if additive else "CAST(0 AS DOUBLE)"
    decay = lambda by, name: f"{name} AS (SELECT {by}, sum(pow(CAST(0.92 AS DOUBLE), r - 1) * CASE WHEN r = n THEN 1 ELSE CAST(0.08 AS DOUBLE) END * error) AS b_{name}, count(*) AS n_{name} FROM (SELECT *, row_number() OVER (PARTITION BY {by} {_NEW}) AS r, count(*) OVER (PARTITION BY {by}) AS n FROM t0) GROUP BY {by})"
    bands = lambda by, window, name: f"{name} AS (SELECT {by}, quantile_cont(resid, [0.05, 0.25, 0.5, 0.75, 0.95]) AS {name}_q FROM (SELECT *, row_number() OVER (PARTITION BY {by} {_NEW}) AS r FROM resid) WHERE r <= {window} GROUP BY {by} HAVING count(*) >= 15)"
    med = "fc_mean - CASE WHEN coalesce(n_cell, 0) >= 5 THEN b_cell ELSE coalesce(b_lead, 0) END"
    q = ", ".join(f"{'greatest(' if floor is not None else '('}median + coalesce(band_q[{i}], pooled_q[{i}], 0){', ' + floor if floor is not None else ''})" for i in range(1, 6))
    return f"""t0 AS (SELECT *, {C.BUCKET_SQL.format('lead_h')} AS bucket, CAST(hour(valid_time) AS INT) AS hour, {error} AS error FROM {wide} WHERE fc_mean IS NOT NULL AND obs IS NOT NULL),
 {decay(f'{key}, bucket, hour', 'cell')}, {decay(f'{key}, bucket', 'lead')},
 med AS (SELECT t0.*, {med} AS median FROM t0 LEFT JOIN cell USING ({key}, bucket, hour) LEFT JOIN lead USING ({key}, bucket)),
 resid AS (SELECT *, obs - median AS resid FROM med), {bands(f'{key}, bucket', 60, 'band')}, {bands(key, 180, 'pooled')},
 tier0 AS (SELECT * EXCLUDE (qs), qs[1] AS q05, qs[2] AS q25, qs[3] AS q50, qs[4] AS q75, qs[5] AS q95 FROM (SELECT med.*, list_sort([{q}]) AS qs FROM med LEFT JOIN band USING ({key}, bucket) LEFT JOIN pooled USING ({key})))"""


@query("decayed_bias", f"WITH {X.PAIRS}, {wide_sql('pairs')}, {tier0_sql('wide')} SELECT station_id, bucket, hour, round(b_cell, 6) AS bias, n_cell AS n FROM cell UNION ALL SELECT station_id, bucket, -1, round(b_lead, 6), n_lead FROM lead")
def decayed_bias(spark: SparkSession, sf: str) -> DataFrame:
    cell, lead = bias.cell_bias(pairing.wide(X.pairs(spark, sf)))
    a = cell.select("station_id", "bucket", "hour", F.round("bias_cell", 6).alias("bias"), F.col("bias_cell_n").alias("n"))
    return a.union(lead.select("station_id", "bucket", F.lit(-1), F.round("bias_lead", 6), "bias_lead_n"))


@query("residual_quantiles", f"WITH {X.PAIRS}, {wide_sql('pairs')}, {tier0_sql('wide')} SELECT station_id, bucket, {', '.join(f'round(band_q[{i + 1}], 6) AS {q}' for i, q in enumerate(C.QUANTILES))} FROM band UNION ALL SELECT station_id, 'all', {', '.join(f'round(pooled_q[{i + 1}], 6)' for i in range(5))} FROM pooled")
def residual_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    band, pooled = bias.residual_bands(pairing.wide(X.pairs(spark, sf)))
    a = band.select("station_id", "bucket", *[F.round(F.col("band")[i], 6).alias(q) for i, q in enumerate(C.QUANTILES)])
    return a.union(pooled.select("station_id", F.lit("all"), *[F.round(F.col("pooled")[i], 6) for i in range(5)]))


_QS = ", ".join(f"round({q}, 8) AS {q}" for q in C.QUANTILES)


@query("tier0_predict", f"WITH {X.PAIRS}, {wide_sql('pairs')}, {tier0_sql('wide')} SELECT station_id, {STAMP}, lead_h, {_QS} FROM tier0")
def tier0_predict(spark: SparkSession, sf: str) -> DataFrame:
    w = pairing.wide(X.pairs(spark, sf))
    return bias.predict(w, w).select("station_id", stamp(), "lead_h", *[F.round(q, 8).alias(q) for q in C.QUANTILES])


@query("tier0_precip", f"WITH {X.PRECIP}, {wide_sql('precip')}, {tier0_sql('wide', floor='0', additive=False)} SELECT station_id, {STAMP}, lead_h, {_QS} FROM tier0")
def tier0_precip(spark: SparkSession, sf: str) -> DataFrame:
    w = pairing.wide(X.pairs(spark, sf, precip=True))
    return bias.predict(w, w, floor=0.0, additive=False).select("station_id", stamp(), "lead_h", *[F.round(q, 8).alias(q) for q in C.QUANTILES])
