"""Queries of archived forecasts, of all tiers out of sample, and of what is published, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratocast import config as C
from stratocast import fixtures as X
from stratocast.functions import scores as S
from stratocast.operators import bias, fleet, pairing, publish, stations, verification, walkforward
from stratocast.plans.training import STAMP, stamp, tier0_sql, wide_sql
from stratocast.plans.verification import _FOLDED, WIDE
from stratocast.sources import payloads
from stratocast.storage import shared_folder, stored

Q, O = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            O[name] = sql
        return f

    return add


# --- archived forecasts ---------------------------------------------------------------------------

_MODEL_ID = "CASE model WHEN 'gfs' THEN 'gfs_seamless' WHEN 'ecmwf' THEN 'ecmwf_ifs025' ELSE 'icon_seamless' END"
_FROM = {"gfs": "1993-06-15", "ecmwf": "1995-01-01", "icon": None}
_HIST = "h AS (SELECT station_id, valid_time, model, arg_max(fc, ingest_seq) AS fc FROM pairs WHERE lead_h = 24 AND fc IS NOT NULL GROUP BY ALL)"
_KEPT = " ".join(f"WHEN '{m}' THEN valid_time >= TIMESTAMP '{d}'" for m, d in _FROM.items() if d)
_PREV = "p AS (SELECT station_id, valid_time, lead_h, model, arg_max(fc, ingest_seq) AS fc FROM pairs WHERE fc IS NOT NULL AND day(valid_time) >= 10 GROUP BY ALL)"


def _payload(rows: DataFrame, series: dict[str, str], issued) -> DataFrame:
    """(station_id, issued_at, hourly) of rows (station_id, valid_time, one column per series): a document per station and issue."""
    lists = rows.groupBy("station_id", issued.alias("issued_at")).agg(F.array_sort(F.collect_list(F.struct("valid_time", *series))).alias("r"))
    entries = [F.lit("time"), F.transform("r", lambda x: F.date_format(x["valid_time"], "yyyy-MM-dd'T'HH:mm"))]
    for column, name in series.items():
        entries += [F.lit(name), F.col(f"r.{column}").cast("array<string>")]
    return lists.select("station_id", "issued_at", F.to_json(F.create_map(*entries)).alias("hourly"))


def _historical(spark, sf) -> DataFrame:
    rows = X.pairs(spark, sf).where("lead_h = 24 AND fc IS NOT NULL").groupBy("station_id", "valid_time").pivot("model", list(X.MODELS)).agg(F.max_by("fc", "ingest_seq"))
    documents = _payload(rows, {m: f"temperature_2m_{m}" for m in X.MODELS}, F.date_trunc("day", "valid_time"))
    catalogue = spark.createDataFrame(list(_FROM.items()), "id string, archive_from string").withColumn("archive_from", F.col("archive_from").cast("date"))
    return payloads.historical(documents, catalogue, X.MODELS, {"air_temp_c": "temperature_2m"})


@query("archive_window", f"WITH {X.PAIRS}, {_HIST} SELECT station_id, {STAMP}, model, 3 AS lead_h, 'hist' AS lead_source, round(fc, 6) AS fc_air_temp_c FROM h WHERE CASE model {_KEPT} ELSE true END")
def archive_window(spark: SparkSession, sf: str) -> DataFrame:
    return _historical(spark, sf).select("station_id", stamp(), "model", "lead_h", "lead_source", F.round("fc_air_temp_c", 6).alias("fc_air_temp_c"))


def _previous(spark, sf) -> DataFrame:
    """A document a month, issued on its tenth and read for the days from there on; the limit leaves out what lies before."""
    known = X.pairs(spark, sf).where("fc IS NOT NULL")
    names = {f"{m}_{d}": f"temperature_2m_previous_day{d}_{m}" for m in X.MODELS for d in range(1, 8)}
    of = lambda m, d: (F.col("model") == m) & (F.col("lead_h") == 24 * d)
    cells = [F.max_by(F.when(of(m, d), F.col("fc")), F.when(of(m, d), F.col("ingest_seq"))).alias(f"{m}_{d}") for m in X.MODELS for d in range(1, 8)]
    rows = known.groupBy("station_id", "valid_time").agg(*cells)
    issued = F.date_trunc("month", "valid_time") + F.expr("INTERVAL 9 DAYS")
    return payloads.previous_runs(_payload(rows, names, issued), X.MODELS, {"air_temp_c": "temperature_2m"}, past_days=0)


@query("previous_runs", f"WITH {X.PAIRS}, {_PREV} SELECT station_id, {STAMP}, lead_h, model, 'prev_runs' AS lead_source, round(fc, 6) AS fc_air_temp_c FROM p")
def previous_runs(spark: SparkSession, sf: str) -> DataFrame:
    return _previous(spark, sf).select("station_id", stamp(), "lead_h", "model", "lead_source", F.round("fc_air_temp_c", 6).alias("fc_air_temp_c"))


@query(
    "forecast_union",
    f"WITH {X.PAIRS}, {_HIST}, {_PREV}, u AS (SELECT station_id, valid_time, 3 AS lead_h, 'hist' AS lead_source, model, fc FROM h WHERE CASE model {_KEPT} ELSE true END UNION ALL SELECT station_id, valid_time, lead_h, 'prev_runs', model, fc FROM p) SELECT station_id, lead_source, lead_h, model, count(*) AS n, round(sum(fc), 6) AS total FROM u WHERE model <> 'icon' OR station_id IN ('ST0', 'ST1') GROUP BY ALL",
)
def forecast_union(spark: SparkSession, sf: str) -> DataFrame:
    """Both archives, of the models that each station uses."""
    used = X.pairs(spark, sf).select("station_id").distinct().select("station_id", F.explode(F.when(F.col("station_id").isin("ST0", "ST1"), F.array(*[F.lit(m) for m in X.MODELS])).otherwise(F.array(F.lit("gfs"), F.lit("ecmwf")))).alias("model"))
    out = _historical(spark, sf).unionByName(_previous(spark, sf)).join(used, ["station_id", "model"], "left_semi")
    return out.groupBy("station_id", "lead_source", "lead_h", "model").agg(F.count("*").alias("n"), F.round(F.sum("fc_air_temp_c"), 6).alias("total"))


@query("payload_alignment", f"WITH {X.PAIRS}, {_HIST}, d AS (SELECT station_id, date_trunc('day', valid_time) AS day, count(*) AS n FROM h GROUP BY ALL) SELECT station_id, strftime(day, '%Y-%m-%d') AS day, n FROM d")
def payload_alignment(spark: SparkSession, sf: str) -> DataFrame:
    """Batches of one document per station asked for, in the order of the request and without a name in them."""
    known = X.pairs(spark, sf).where("lead_h = 24 AND fc IS NOT NULL").groupBy("station_id", "valid_time", "model").agg(F.max_by("fc", "ingest_seq").alias("fc"))
    rows = known.groupBy("station_id", F.date_trunc("day", "valid_time").alias("day")).agg(F.count("*").alias("n"), F.collect_list(F.round("fc", 2)).alias("fc"))
    asked = rows.withColumn("pos", (F.row_number().over(W.partitionBy("day").orderBy(F.desc("station_id"))) - 1).cast("int")).withColumn("batch", F.date_format("day", "yyyy-MM-dd"))
    batches = asked.groupBy("batch").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "fc"))), lambda x: F.to_json(F.struct(x["fc"].alias("values")))).alias("r")).select("batch", F.to_json("r").alias("payload"))
    out = payloads.aligned(batches, asked.select("batch", "pos", "station_id"))
    return out.select("station_id", F.col("batch").alias("day"), F.size(F.from_json("hourly", "values array<double>")["values"]).cast("long").alias("n"))


@query("model_gate", f"WITH {X.PAIRS} SELECT station_id, {_MODEL_ID} AS model, count(CASE WHEN model <> 'ecmwf' THEN fc END) AS n, count(*) AS rows FROM pairs GROUP BY ALL")
def model_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Gusts of a model that carries none are null, not missing."""
    rows = X.pairs(spark, sf).withColumn("model", F.expr(_MODEL_ID))
    out = stations.gate_models(rows, stations.model_table(spark), "wind_gust_ms")
    return out.groupBy("station_id", "model").agg(F.count("fc").alias("n"), F.count("*").alias("rows"))


_LABELS = ", ".join(f"('{i}', '{label}', {km}, {str(bool(g)).lower()})" for i, label, _, km, _, _, _, g in C.FORECAST_MODELS)


@query("model_lookup", f"WITH {X.PAIRS}, m(id, label, km, everywhere) AS (VALUES {_LABELS}) SELECT id, label, CAST(km AS INT) AS resolution_km, everywhere AS \"global\", count(*) AS n, 'temperature_2m' AS payload_name FROM pairs JOIN m ON id = {_MODEL_ID} GROUP BY ALL")
def model_lookup(spark: SparkSession, sf: str) -> DataFrame:
    known = X.pairs(spark, sf).groupBy(F.expr(_MODEL_ID).alias("id")).agg(F.count("*").alias("n"))
    return known.join(stations.model_table(spark), "id").select("id", "label", "resolution_km", "global", "n", F.lit(C.PAYLOAD_NAMES["air_temp_c"]).alias("payload_name"))


# --- tiers out of sample --------------------------------------------------------------------------

_T0 = f"{_FOLDED}, t0w AS (SELECT train0.* FROM train0 SEMI JOIN enough USING (station_id, fold)), {tier0_sql('t0w', key='sf')}"
_OOS = f"""test AS (SELECT w.*, f.fold, w.station_id || '/' || f.fold AS sf, {C.BUCKET_SQL.format('lead_h')} AS bucket, CAST(hour(valid_time) AS INT) AS hour FROM wide w JOIN folds f ON f.station_id = w.station_id AND valid_time >= origin AND valid_time < "end" SEMI JOIN enough e ON e.station_id = f.station_id AND e.fold = f.fold),
 o1 AS (SELECT test.*, fc_mean - CASE WHEN coalesce(n_cell, 0) >= 5 THEN b_cell ELSE coalesce(b_lead, 0) END AS median FROM test LEFT JOIN cell USING (sf, bucket, hour) LEFT JOIN lead USING (sf, bucket)),
 oos AS (SELECT * EXCLUDE (qs), qs[1] AS q05, qs[2] AS q25, qs[3] AS q50, qs[4] AS q75, qs[5] AS q95 FROM (SELECT o1.*, list_sort([{", ".join(f"median + coalesce(band_q[{i}], pooled_q[{i}])" for i in range(1, 6))}]) AS qs FROM o1 LEFT JOIN band USING (sf, bucket) LEFT JOIN pooled USING (sf)) WHERE qs[1] IS NOT NULL),
 scored AS (SELECT *, {S.crps_quantiles_sql('obs')} AS crps FROM oos)"""


def _crps(frame: DataFrame) -> DataFrame:
    return frame.withColumn("crps", S.crps_quantiles(F.col("obs"), [F.col(q) for q in C.QUANTILES]))


def _walked(spark, sf, tiers=(0,)) -> DataFrame:
    return _crps(walkforward.walk_forward(pairing.wide(X.pairs(spark, sf)), tiers))


@query("tier0_walk_forward", f"{_T0}, {_OOS} SELECT station_id, fold, {STAMP}, lead_h, ingest_seq, {', '.join(f'round({q}, 8) AS {q}' for q in C.QUANTILES)} FROM oos")
def tier0_walk_forward(spark: SparkSession, sf: str) -> DataFrame:
    return _walked(spark, sf).select("station_id", "fold", stamp(), "lead_h", "ingest_seq", *[F.round(q, 8).alias(q) for q in C.QUANTILES])


_RAWS = " UNION ALL ".join(f"SELECT station_id, '{m}' AS model, crps, abs(obs - fc_{m}) AS raw FROM scored" for m in X.MODELS)


@query("walk_forward_scores", f"{_T0}, {_OOS}, long AS ({_RAWS}) SELECT station_id, model, round(avg(raw), 5) AS crps_raw, round(avg(crps) FILTER (WHERE raw IS NOT NULL), 5) AS crps_fused, round(count(raw) / count(*), 6) AS coverage, count(raw) AS n FROM long GROUP BY ALL HAVING count(raw) >= 20")
def walk_forward_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Tier 0 out of sample against each raw model on the same rows."""
    out = verification.raw_baselines(_walked(spark, sf))
    return out.select("station_id", "model", F.round("crps_raw", 5).alias("crps_raw"), F.round("crps_fused", 5).alias("crps_fused"), F.round("coverage", 6).alias("coverage"), "n")


_RANKED = (
    "s AS (SELECT station_id, valid_time, lead_h, 'tier' || i AS tier, abs(obs - CASE i WHEN 0 THEN fc_gfs WHEN 1 THEN fc_ecmwf ELSE fc_icon END) AS crps FROM wide, (VALUES (0), (1), (2)) v(i) WHERE station_id <> 'ST3' OR i < 2 OR lead_h > 1000), k AS (SELECT * FROM s WHERE crps IS NOT NULL), a AS (SELECT station_id, count(DISTINCT tier) AS m FROM k GROUP BY ALL), "
    "c AS (SELECT station_id, valid_time, lead_h FROM k JOIN a USING (station_id) GROUP BY ALL HAVING count(DISTINCT tier) = max(m)), o AS (SELECT station_id, tier, avg(crps) AS score_all FROM k GROUP BY ALL), h AS (SELECT station_id, tier, avg(crps) AS shared, count(*) AS n FROM k JOIN c USING (station_id, valid_time, lead_h) GROUP BY ALL HAVING count(*) >= 50)"
)


@query("tier_ranking", f"{WIDE}, {_RANKED} SELECT station_id, tier, round(coalesce(shared, score_all), 5) AS score, round(score_all, 5) AS score_all, coalesce(n, 0) AS n, bool_and(shared IS NOT NULL) OVER (PARTITION BY station_id) AS comparable FROM o LEFT JOIN h USING (station_id, tier)")
def tier_ranking(spark: SparkSession, sf: str) -> DataFrame:
    """Ranking on shared rows, with the raw models in the place of tiers."""
    each = F.explode(F.array(*[F.struct(F.lit(f"tier{i}").alias("tier"), F.abs(F.col("obs") - F.col(f"fc_{m}")).alias("crps")) for i, m in enumerate(X.MODELS)]))
    long = pairing.wide(X.pairs(spark, sf)).select("station_id", "valid_time", "lead_h", each.alias("e")).select("station_id", "valid_time", "lead_h", "e.*").where("station_id <> 'ST3' OR tier <> 'tier2'")
    out = verification.rank_tiers(long)
    return out.select("station_id", "tier", F.round("score", 5).alias("score"), F.round("score_all", 5).alias("score_all"), "n", "comparable")


_BOTH = f"""WITH {X.PAIRS}, {X.PRECIP}, {wide_sql('pairs', 'warm')}, {wide_sql('precip', 'wet')}, wide AS (SELECT * REPLACE (station_id || '|air_temp_c' AS station_id) FROM warm UNION ALL SELECT * REPLACE (station_id || '|precip_1h_mm' AS station_id) FROM wet)"""
_ERROR = "CASE WHEN station_id LIKE '%|precip_1h_mm' THEN CAST(0 AS DOUBLE) ELSE fc_mean - obs END AS error"
_FLOOR = "CASE WHEN station_id LIKE '%|precip_1h_mm' THEN 0 ELSE -1000 END"


def _both(spark, sf) -> DataFrame:
    pairs = X.pairs(spark, sf).withColumn("variable", F.lit("air_temp_c")).unionByName(X.pairs(spark, sf, precip=True).withColumn("variable", F.lit("precip_1h_mm")))
    return pairing.wide(pairs, more=("variable",))


@query(
    "variables_walk_forward",
    f"{_BOTH}, {_FOLDED.split(', ', 1)[1][_FOLDED.split(', ', 1)[1].index('f0 AS'):]}, t0w AS (SELECT train0.* FROM train0 SEMI JOIN enough USING (station_id, fold)), {tier0_sql('t0w', key='sf').replace('fc_mean - obs AS error', _ERROR)}, "
    + _OOS.replace(", ".join(f"median + coalesce(band_q[{i}], pooled_q[{i}])" for i in range(1, 6)), ", ".join(f"greatest(median + coalesce(band_q[{i}], pooled_q[{i}]), {_FLOOR})" for i in range(1, 6))).replace("fc_mean - CASE WHEN coalesce(n_cell", "fc_mean - CASE WHEN station_id LIKE '%|precip_1h_mm' THEN 0 WHEN coalesce(n_cell")
    + f" SELECT split_part(station_id, '|', 1) AS station_id, split_part(station_id, '|', 2) AS variable, fold, {STAMP}, lead_h, ingest_seq, {', '.join(f'round({q}, 8) AS {q}' for q in C.QUANTILES)} FROM oos",
)
def variables_walk_forward(spark: SparkSession, sf: str) -> DataFrame:
    """Temperature and precipitation of all stations in one call, the variable a key: what tier 0 knew at each fold."""
    out = walkforward.walk_variables(_both(spark, sf), (0,))
    return out.select("station_id", "variable", "fold", stamp(), "lead_h", "ingest_seq", *[F.round(q, 8).alias(q) for q in C.QUANTILES])


@query("precip_out_of_sample")
def precip_out_of_sample(spark: SparkSession, sf: str) -> DataFrame:
    """Precipitation with tiers 0 and 1: score, and Brier score of the chance of rain, from the occurrence model where a tier has one and else from the quantiles."""
    w = _both(spark, sf).where("variable = 'precip_1h_mm'")
    out = stored(_crps(walkforward.walk_variables(w, (0, 1), variables=("precip_1h_mm",))), "rain_walked")
    p = F.coalesce("p_occ", S.exceedance(C.OCCURRENCE, [F.col(q) for q in C.QUANTILES]))
    event = F.when(F.col("obs") > C.OCCURRENCE, 1.0).otherwise(0.0)
    return out.groupBy("station_id", "tier").agg(F.count("*").alias("n"), F.avg("crps").alias("crps"), F.avg((p - event) * (p - event)).alias("brier"), F.min("q05").alias("lowest"))


@query("tiers_out_of_sample")
def tiers_out_of_sample(spark: SparkSession, sf: str) -> DataFrame:
    """Every tier that SQL can't fit as well: mean score on shared rows, coverage, and rows, per station."""
    out = stored(_walked(spark, sf, (0, 1, 2)), "walked")  # the fits are made once
    inside = F.avg(F.when(F.col("obs").between(F.col("q05"), F.col("q95")), 1.0).otherwise(0.0)).alias("coverage90")
    return verification.rank_tiers(out).join(out.groupBy("station_id", "tier").agg(inside), ["station_id", "tier"])


def _pair_counts(w: DataFrame, by: tuple[str, ...] = ("station_id",)) -> DataFrame:
    return w.groupBy(*by).agg(F.count("*").alias("n_pairs"))


@query("scorecard")
def scorecard(spark: SparkSession, sf: str) -> DataFrame:
    """The card of every station: the tier chosen on the first part of the rows, measured on the rest against the best raw model."""
    w = stored(pairing.wide(X.pairs(spark, sf)), "wide")
    walked = stored(_crps(walkforward.walk_forward(w, (0, 1))), "walked")
    return publish.scorecard(walked, _pair_counts(w), thresholds=(10.0, 15.0), history=w.select("station_id", "valid_time", "obs").distinct())


_Z = [f"fc_mean + CAST({1.2 * z!r} AS DOUBLE)" for z in C.NORMAL_LEVELS]
_CARD = f"""{_T0}, {_OOS}, one AS (SELECT * REPLACE ({', '.join(f'{e} AS {q}' for e, q in zip(_Z, C.QUANTILES, strict=True))}) FROM oos WHERE lead_h <= 96), rowz AS (SELECT * EXCLUDE (crps), crps, 'tier0' AS tier FROM scored UNION ALL BY NAME SELECT *, {S.crps_quantiles_sql('obs')} AS crps, 'tier1' AS tier FROM one),
 times AS (SELECT station_id, valid_time, row_number() OVER (PARTITION BY station_id ORDER BY valid_time) AS r, count(*) OVER (PARTITION BY station_id) AS k FROM (SELECT DISTINCT station_id, valid_time FROM rowz)),
 parted AS (SELECT rowz.*, CASE WHEN k <= 20 THEN 'shared' WHEN r <= floor(k * CAST(0.6 AS DOUBLE)) THEN 'select' ELSE 'report' END AS part FROM rowz JOIN times USING (station_id, valid_time)),
 held AS (SELECT station_id, bool_and(a >= 100 AND b >= 100) AS held_out FROM (SELECT station_id, tier, count(*) FILTER (part = 'select') AS a, count(*) FILTER (part = 'report') AS b FROM parted GROUP BY ALL) GROUP BY ALL),
 chosen AS (SELECT p.* FROM parted p JOIN held USING (station_id) WHERE NOT held_out OR part = 'select'), shared AS (SELECT station_id, valid_time, lead_h FROM chosen GROUP BY ALL HAVING count(DISTINCT tier) = 2),
 score AS (SELECT c.station_id, tier, avg(crps) AS score FROM chosen c JOIN shared USING (station_id, valid_time, lead_h) GROUP BY ALL), champ AS (SELECT station_id, arg_min(tier, score) AS tier FROM score GROUP BY ALL),
 mine AS (SELECT p.* FROM parted p JOIN champ USING (station_id, tier) JOIN held USING (station_id) WHERE NOT held_out OR part = 'report'),
 rawm AS (SELECT station_id, bucket, CAST(valid_time AS DATE) AS day, crps, model, abs(obs - CASE model WHEN 'gfs' THEN fc_gfs WHEN 'ecmwf' THEN fc_ecmwf ELSE fc_icon END) AS raw FROM mine, (VALUES ('gfs'), ('ecmwf'), ('icon')) v(model)),
 raws AS (SELECT station_id, model, avg(raw) AS crps_raw, avg(crps) FILTER (raw IS NOT NULL) AS crps_fused, count(raw) / count(*)::DOUBLE AS coverage FROM rawm GROUP BY ALL HAVING count(raw) >= 20),
 best AS (SELECT * FROM raws QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY coverage < 0.9, crps_raw, model) = 1),
 days AS (SELECT * FROM (SELECT station_id, day, avg(crps) AS fused, avg(raw) AS raw FROM rawm JOIN best USING (station_id, model) GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY station_id ORDER BY day DESC) <= 90),
 leads AS (SELECT * FROM (SELECT station_id, bucket, model, avg(raw) AS raw FROM rawm GROUP BY ALL HAVING count(raw) > 10) QUALIFY row_number() OVER (PARTITION BY station_id, bucket ORDER BY raw, model) = 1)"""


@query(
    "scorecard_blocks",
    f"{_CARD} SELECT station_id, 'champion' AS block, tier AS key, CAST(1 AS DOUBLE) AS value FROM champ UNION ALL SELECT station_id, 'score', tier, round(score, 5) FROM score UNION ALL SELECT station_id, 'raw', model, round(crps_raw, 5) FROM raws UNION ALL SELECT station_id, 'skill', model, round(1 - crps_fused / crps_raw, 5) FROM best "
    "UNION ALL SELECT station_id, 'n_eval', '', count(*) FROM mine GROUP BY ALL UNION ALL SELECT station_id, 'crps', '', round(avg(crps), 5) FROM mine GROUP BY ALL UNION ALL SELECT station_id, 'width90', '', round(avg(q95 - q05), 5) FROM mine GROUP BY ALL UNION ALL SELECT station_id, 'inside50', '', round(avg(CASE WHEN obs BETWEEN q25 AND q75 THEN 1 ELSE 0 END), 5) FROM mine GROUP BY ALL "
    f"UNION ALL SELECT station_id, 'brier', '10.0', round(avg(pow({S.exceedance_sql(10.0)} - CASE WHEN obs > 10 THEN 1 ELSE 0 END, 2)), 5) FROM mine GROUP BY ALL UNION ALL SELECT station_id, 'by_lead', bucket, round(raw, 5) FROM leads UNION ALL SELECT station_id, 'daily', CAST(day AS VARCHAR), round(fused, 4) FROM days "
    f"UNION ALL SELECT s.station_id, 'pit', CAST(b.bin AS VARCHAR), coalesce(n, 0) FROM (SELECT DISTINCT station_id FROM mine) s CROSS JOIN (SELECT CAST(range AS INT) AS bin FROM range(10)) b LEFT JOIN (SELECT station_id, CAST(least(floor(({S.pit_sql('obs')}) * 10), 9) AS INT) AS bin, count(*) AS n FROM mine GROUP BY ALL) h ON h.station_id = s.station_id AND h.bin = b.bin",
)
def scorecard_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The blocks of cards as rows: of tier 0 out of sample, and of a plain band around the mean that ends at four days."""
    w = pairing.wide(X.pairs(spark, sf))
    zero = stored(_walked(spark, sf).drop("crps"), "walked0")
    one = zero.where("lead_h <= 96").withColumns({q: F.col("fc_mean") + 1.2 * z for q, z in zip(C.QUANTILES, C.NORMAL_LEVELS, strict=True)}).withColumn("tier", F.lit("tier1"))
    cards = stored(publish.scorecard(_crps(zero.unionByName(one)), _pair_counts(w), thresholds=(10.0, 15.0), resamples=20), "cards")
    row = lambda block, key, value: F.struct(F.lit(block).alias("block"), key.cast("string").alias("key"), value.cast("double").alias("value"))
    single = F.array(row("champion", F.col("champion"), F.lit(1.0)), row("skill", F.col("best_raw"), F.round("skill", 5)), row("n_eval", F.lit(""), F.col("n_eval")), row("crps", F.lit(""), F.round("crps", 5)), row("width90", F.lit(""), F.round("coverage.width90", 5)), row("inside50", F.lit(""), F.round("coverage.inside50", 5)), row("brier", F.lit("10.0"), F.round(F.col("brier")["10.0"]["brier"], 5)))
    tiers, models = publish.card_tables(cards)
    parts = [
        cards.select("station_id", F.explode(single).alias("x")).select("station_id", "x.*"),
        tiers.select("station_id", F.lit("score").alias("block"), F.col("tier").alias("key"), F.round("score", 5).alias("value")),
        models.select("station_id", F.lit("raw").alias("block"), F.col("model").alias("key"), F.round("crps_raw", 5).alias("value")),
        cards.select("station_id", F.posexplode("pit").alias("key", "value")).select("station_id", F.lit("pit").alias("block"), F.col("key").cast("string").alias("key"), F.col("value").cast("double").alias("value")),
        cards.select("station_id", F.explode("by_lead").alias("key", "v")).select("station_id", F.lit("by_lead").alias("block"), "key", F.round("v.best.crps_raw", 5).alias("value")),
        cards.select("station_id", F.explode("daily").alias("v")).select("station_id", F.lit("daily").alias("block"), F.col("v.day").cast("string").alias("key"), F.col("v.fused").alias("value")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("tier_fallback", f"{WIDE}, {tier0_sql('wide')}, t AS (SELECT *, CASE WHEN station_id IN ('ST0', 'ST1') THEN 'tier1' ELSE 'tier0' END AS used FROM tier0) SELECT station_id, {STAMP}, lead_h, ingest_seq, used AS tier, round(q50 + CASE WHEN used = 'tier1' THEN 1 ELSE 0 END, 6) AS q50 FROM t")
def tier_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Two tiers with a forecast: a champion that has none falls back to the highest that has."""
    w = pairing.wide(X.pairs(spark, sf))
    tier0 = bias.predict(w, w).withColumn("tier", F.lit("tier0"))
    tier1 = tier0.withColumns({"tier": F.lit("tier1"), "q50": F.col("q50") + 1, "calibrated": F.col("station_id").isin("ST0", "ST1")})
    champions = w.select("station_id").distinct().withColumn("champion", F.when(F.col("station_id") == "ST0", "tier2").when(F.col("station_id") == "ST1", "tier1").otherwise("tier3"))
    out = walkforward.first_calibrated(tier0.unionByName(tier1), champions)
    return out.select("station_id", stamp(), "lead_h", "ingest_seq", "tier", F.round("q50", 6).alias("q50"))


_OBS = "o AS (SELECT station_id, valid_time, arg_max(obs, ingest_seq) AS obs FROM pairs GROUP BY ALL)"
_CLIMATE = (
    f"{_OBS}, hh AS (SELECT station_id, valid_time AS seen, obs, (dayofyear(valid_time) - 1) % 365 + 1 AS doy, hour(valid_time) AS hod FROM o), t AS (SELECT DISTINCT station_id, valid_time AS target FROM o), nn AS (SELECT *, ((dayofyear(target) - 1 + d + 365) % 365) + 1 AS doy, hour(target) AS hod FROM t, (SELECT unnest(range(-15, 16)) AS d)), "
    "same AS (SELECT nn.station_id, target, quantile_cont(obs, [0.05, 0.25, 0.5, 0.75, 0.95]) AS q FROM nn JOIN hh ON hh.station_id = nn.station_id AND hh.doy = nn.doy AND hh.hod = nn.hod WHERE abs(epoch(seen) - epoch(target)) > 3 * 86400 GROUP BY ALL HAVING count(*) >= 10), "
    "ev AS (SELECT nn.station_id, target, quantile_cont(obs, [0.05, 0.25, 0.5, 0.75, 0.95]) AS q FROM nn JOIN hh ON hh.station_id = nn.station_id AND hh.doy = nn.doy WHERE abs(epoch(seen) - epoch(target)) > 3 * 86400 AND NOT EXISTS (SELECT 1 FROM same s WHERE s.station_id = nn.station_id AND s.target = nn.target) GROUP BY ALL HAVING count(*) >= 5), "
    "cl AS (SELECT o.station_id, obs, q[1] AS q05, q[2] AS q25, q[3] AS q50, q[4] AS q75, q[5] AS q95 FROM o JOIN (SELECT * FROM same UNION ALL SELECT * FROM ev) c ON c.station_id = o.station_id AND c.target = o.valid_time)"
)


@query("climatology_score", f"WITH {X.PAIRS}, {_CLIMATE} SELECT station_id, count(*) AS n, round(avg({S.crps_quantiles_sql('obs')}), 5) AS crps FROM cl GROUP BY ALL")
def climatology_score(spark: SparkSession, sf: str) -> DataFrame:
    """What the station's own past would have scored."""
    obs = X.pairs(spark, sf).groupBy("station_id", "valid_time").agg(F.max_by("obs", "ingest_seq").alias("obs"))
    out = verification.climatology(obs.select("station_id", F.col("valid_time").alias("target")), obs).withColumnRenamed("n", "past")
    met = out.join(obs.withColumnRenamed("valid_time", "target"), ["station_id", "target"])
    crps = S.crps_quantiles(F.col("obs"), [F.col("q")[i] for i in range(len(C.LEVELS))])
    return met.groupBy("station_id").agg(F.count("*").alias("n"), F.round(F.avg(crps), 5).alias("crps"))


# --- what is published ----------------------------------------------------------------------------


@query(
    "distribution_family",
    f"WITH {X.PAIRS} SELECT station_id, variable, CASE variable WHEN 'precip_1h_mm' THEN 'bernoulli_quantile_map' WHEN 'air_temp_c' THEN 'normal' WHEN 'rh_pct' THEN 'normal' ELSE 'truncated_normal' END AS family, n FROM (SELECT station_id, count(*) AS n FROM pairs GROUP BY ALL), (VALUES ('air_temp_c'), ('rh_pct'), ('wind_speed_ms'), ('wind_gust_ms'), ('precip_1h_mm')) v(variable)",
)
def distribution_family(spark: SparkSession, sf: str) -> DataFrame:
    n = X.pairs(spark, sf).groupBy("station_id").agg(F.count("*").alias("n"))
    return n.withColumn("variable", F.explode(F.array(*[F.lit(v) for v in C.VARIABLES]))).select("station_id", "variable", publish.family(F.col("variable")).alias("family"), "n")


_WET0 = f"WITH {X.PRECIP}, {wide_sql('precip')}, {tier0_sql('wide', floor='0', additive=False)}"
_STEP = "(((ingest_seq * 48271) % 1000003) / CAST(1000003 AS DOUBLE))"


@query(
    "precip_probability",
    f"{_WET0}, p AS (SELECT station_id, CAST(0.1 AS DOUBLE) AS threshold, 'occurrence model' AS basis, {_STEP} AS p, CASE WHEN obs > 0.1 THEN 1 ELSE 0 END AS event FROM tier0 UNION ALL SELECT station_id, 1, 'predictive quantiles', {S.exceedance_sql(1.0)}, CASE WHEN obs > 1 THEN 1 ELSE 0 END FROM tier0) SELECT station_id, threshold, basis, count(*) AS n, round(avg((p - event) * (p - event)), 6) AS brier FROM p GROUP BY ALL",
)
def precip_probability(spark: SparkSession, sf: str) -> DataFrame:
    """The occurrence model answers for its own threshold only; heavier rain is read off the quantiles."""
    w = pairing.wide(X.pairs(spark, sf, precip=True))
    t = bias.predict(w, w, floor=0.0, additive=False).withColumn("p_occ", F.expr(_STEP))
    each = publish.rain_probabilities(t, C.THRESHOLDS["precip_1h_mm"])
    return each.groupBy("station_id", "threshold", "basis").agg(F.count("*").alias("n"), F.round(F.avg((F.col("p") - F.col("event")) * (F.col("p") - F.col("event"))), 6).alias("brier"))


_CARDS = "cards AS (SELECT o_orderkey AS station_id, CASE WHEN o_orderkey % 5 <> 0 THEN (o_totalprice - 250000) / 1000000 END AS skill, CASE WHEN o_orderkey % 5 <> 0 THEN (o_totalprice - 250000) / 1000000 - 0.05 END AS low, o_orderkey % 4 AS t, o_totalprice / 1000 AS days, o_custkey AS n_pairs FROM orders)"


def _cards(spark, sf) -> DataFrame:
    o = spark.read.parquet(f"{sf}/orders.parquet")
    skill = F.when(F.col("o_orderkey") % 5 != 0, (F.col("o_totalprice") - 250000) / 1000000)
    return o.select(F.col("o_orderkey").alias("station_id"), skill.alias("skill"), (skill - 0.05).alias("low"), F.concat(F.lit("tier"), (F.col("o_orderkey") % 4).cast("string")).alias("tier"), (F.col("o_totalprice") / 1000).alias("train_days"), F.col("o_custkey").cast("long").alias("n_pairs"))


_BLOCK = "CASE WHEN skill IS NULL THEN 'warming_up' ELSE 'verified' END"
_LABEL = "CASE t " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(C.TIER_LABELS.values())) + " END"


@query("method_and_skill", f"WITH {_CARDS} SELECT station_id, {_LABEL} AS label, round(days, 1) AS train_days, CAST(n_pairs AS BIGINT) AS n_pairs, {_BLOCK} AS status, round(skill, 6) AS skill, CASE WHEN skill IS NOT NULL THEN low > 0 END AS beats_raw FROM cards")
def method_and_skill(spark: SparkSession, sf: str) -> DataFrame:
    out = publish.blocks(_cards(spark, sf))
    return out.select("station_id", F.col("method.label").alias("label"), F.col("method.train_days").alias("train_days"), F.col("method.n_pairs").alias("n_pairs"), F.col("skill_block.status").alias("status"), F.round("skill_block.skill", 6).alias("skill"), F.col("skill_block.beats_raw").alias("beats_raw"))


@query("enrollment_report", f"WITH {_CARDS} SELECT station_id, {_LABEL} AS method, CASE WHEN skill IS NULL THEN 'still warming up' WHEN low > 0 THEN 'beats it' WHEN skill > 0 THEN 'better, not conclusively' ELSE 'no measurable gain' END AS verdict, CASE WHEN skill IS NULL THEN 'mute' WHEN low > 0 THEN 'good' WHEN skill > 0 THEN 'warn' ELSE 'bad' END AS class FROM cards")
def enrollment_report(spark: SparkSession, sf: str) -> DataFrame:
    out = publish.blocks(_cards(spark, sf))
    s = [F.col(f"skill_block.{c}") for c in ("status", "beats_raw", "skill")]
    return out.select("station_id", F.col("method.label").alias("method"), stations.verdict(*s).alias("verdict"), stations.skill_class(*s).alias("class"))


_ENTRIES = "e AS (SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 'no_data' ELSE 'ok' END AS status, CASE WHEN o_orderkey % 7 <> 0 THEN (o_totalprice - 250000) / 1000000 END AS skill FROM orders)"


def _entries(spark, sf) -> DataFrame:
    o = spark.read.parquet(f"{sf}/orders.parquet")
    return o.select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "F", "no_data").otherwise("ok").alias("status"), F.when(F.col("o_orderkey") % 7 != 0, (F.col("o_totalprice") - 250000) / 1000000).alias("skill"))


@query("rank_by_skill", f"WITH {_ENTRIES} SELECT id, status, round(skill, 6) AS skill FROM e ORDER BY e.skill DESC NULLS LAST, id LIMIT 60")
def rank_by_skill(spark: SparkSession, sf: str) -> DataFrame:
    return stations.by_skill(_entries(spark, sf)).select("id", "status", F.round("skill", 6).alias("skill"))


@query("default_station", f"WITH {_ENTRIES} SELECT id, round(skill, 6) AS skill FROM e WHERE status = 'ok' ORDER BY e.skill DESC NULLS LAST, id LIMIT 1")
def default_station(spark: SparkSession, sf: str) -> DataFrame:
    return stations.opened_first(_entries(spark, sf)).select("id", F.round("skill", 6).alias("skill"))


@query("stored_scorecards", f"WITH {_CARDS} SELECT station_id, t AS tier, round(skill, 6) AS skill FROM cards WHERE skill IS NOT NULL AND station_id % 100 = 1")
def stored_scorecards(spark: SparkSession, sf: str) -> DataFrame:
    """Cards that were written, read back by station."""
    kept = stored(_cards(spark, sf), "cards")
    asked = kept.where("station_id % 100 = 1").select("station_id")
    out = kept.join(asked, "station_id", "left_semi").where("skill IS NOT NULL")
    return out.select("station_id", F.right("tier", F.lit(1)).cast("long").alias("tier"), F.round("skill", 6).alias("skill"))


@query("pit_shares", f"{WIDE}, {tier0_sql('wide')}, h AS (SELECT station_id, CAST(least(floor(({S.pit_sql('obs')}) * 10), 9) AS INT) AS bin, count(*) AS n FROM tier0 GROUP BY ALL) SELECT station_id, bin, round(n / sum(n) OVER (PARTITION BY station_id), 6) AS share, round(n / sum(n) OVER (PARTITION BY station_id) - CAST(0.1 AS DOUBLE), 6) AS excess FROM h WHERE bin IS NOT NULL")
def pit_shares(spark: SparkSession, sf: str) -> DataFrame:
    w = pairing.wide(X.pairs(spark, sf))
    p = S.pit(F.col("obs"), [F.col(q) for q in C.QUANTILES])
    counts = bias.predict(w, w).groupBy("station_id", verification.pit_bin(p).alias("bin")).agg(F.count("*").alias("n"))
    return publish.pit_shares(counts).select("station_id", "bin", F.round("share", 6).alias("share"), F.round("excess", 6).alias("excess"))


_STATUS = "CASE WHEN k % 7 = 0 THEN 'no_forecast' WHEN k % 5 = 0 AND k % 3 <> 0 THEN CASE WHEN k % 2 = 0 THEN 'no_observations' ELSE 'no_data' END WHEN k % 11 = 0 THEN 'warming_up' ELSE 'ok' END"


@query("fleet_status", f"SELECT 'S' || k AS station_id, {_STATUS} AS status FROM (SELECT c_custkey AS k FROM customer)")
def fleet_status(spark: SparkSession, sf: str) -> DataFrame:
    """A station without fresh reports is still published from its stored history."""
    k = spark.read.parquet(f"{sf}/customer.parquet").select(F.col("c_custkey").alias("k"), F.concat(F.lit("S"), F.col("c_custkey").cast("string")).alias("station_id"))
    fresh = k.where("NOT (k % 5 = 0 AND k % 2 = 0)").select("station_id")
    history = k.where("NOT (k % 5 = 0 AND k % 3 <> 0)").select("station_id")
    out = publish.statuses(k.select("station_id"), k.where("k % 7 <> 0").select("station_id"), fresh, history, k.where("k % 11 <> 0").select("station_id"))
    return out.select("station_id", "status")


# --- the fleet ------------------------------------------------------------------------------------

FLEET_BY = ("station_id", "variable")
#: Stations of the fleet, a lead each, by what they lack: forecasts, any observation, a history, enough of one; and two variables.
_LACKS = {24: "forecast", 48: "observations", 72: "history", 96: "rows"}


def _fleet_pairs(spark, sf) -> DataFrame:
    named = lambda df, times, v: df.withColumn("station_id", F.concat("station_id", F.lit("/"), (F.col("lead_h") / times * 24).cast("int").cast("string"))).withColumn("variable", F.lit(v))
    both = named(X.pairs(spark, sf), 24, "air_temp_c").unionByName(named(X.pairs(spark, sf, lead="l_linenumber * 5"), 5, "rh_pct"))
    lacks = F.element_at(F.create_map(*[F.lit(x) for kv in _LACKS.items() for x in kv]), F.element_at(F.split("station_id", "/"), 2).cast("int"))
    newest = F.max("valid_time").over(W.partitionBy(*FLEET_BY))
    return both.withColumns({"lacks": F.coalesce(lacks, F.lit("nothing")), "newest": newest, "place": F.dense_rank().over(W.partitionBy(*FLEET_BY).orderBy(F.desc("valid_time")))})


def _fleet(spark, sf, tiers: tuple[int, ...]) -> DataFrame:
    """A backfill up to ten days before the newest row, then a refresh with the last twenty days, into one model store."""
    pairs = stored(_fleet_pairs(spark, sf), "fleet_pairs")
    stations_ = pairs.select(*FLEET_BY).distinct()
    fresh = pairs.where("lacks <> 'observations'").select(*FLEET_BY).distinct()
    known = pairs.where("lacks NOT IN ('observations', 'history') AND (lacks <> 'rows' OR place <= 10)")
    live = pairs.where("lacks <> 'forecast' AND valid_time >= newest - INTERVAL 7 DAYS").drop("lacks", "newest", "place")
    cut = lambda df, when: df.where(when).drop("lacks", "newest", "place")
    root = shared_folder(spark, "models")
    first, second = cut(known, "valid_time < newest - INTERVAL 10 DAYS"), cut(known, "valid_time >= newest - INTERVAL 20 DAYS")
    fleet.run(first.limit(0), first, live, stations_, fresh, root, 1, FLEET_BY, tiers)
    return fleet.run(first, second, live, stations_, fresh, root, 2, FLEET_BY, tiers)


_FLEET = f"""WITH {X.PAIRS}, {X.SHORT}, long AS (SELECT * REPLACE (station_id || '/' || CAST(lead_h AS VARCHAR) AS station_id), 'air_temp_c' AS variable FROM pairs UNION ALL SELECT * REPLACE (station_id || '/' || CAST(CAST(lead_h / 5 * 24 AS INT) AS VARCHAR) AS station_id), 'rh_pct' FROM short),
 named AS (SELECT *, station_id || '|' || variable AS sv, CAST(split_part(station_id, '/', 2) AS INT) AS lack, max(valid_time) OVER (PARTITION BY station_id, variable) AS newest, dense_rank() OVER (PARTITION BY station_id, variable ORDER BY valid_time DESC) AS place FROM long),
 known AS (SELECT * FROM named WHERE lack NOT IN (48, 72) AND (lack <> 96 OR place <= 10)), {wide_sql('known').replace('station_id, valid_time', 'sv, station_id, variable, valid_time')}"""


@query(
    "fleet_run",
    f"{_FLEET}, {tier0_sql('wide', key='sv')}, live AS (SELECT sv, max(newest) AS t FROM named GROUP BY ALL), used AS (SELECT sv, count(*) AS n_live, sum(q50) AS q50 FROM tier0 JOIN live USING (sv) WHERE valid_time >= t - to_days(7) AND q50 IS NOT NULL AND sv NOT LIKE '%/24|%' AND sv NOT LIKE '%/96|%' GROUP BY ALL), "
    "s AS (SELECT DISTINCT sv, station_id, variable, lack FROM named) SELECT s.station_id, s.variable, CASE lack WHEN 24 THEN 'no_forecast' WHEN 48 THEN 'no_observations' WHEN 72 THEN 'no_data' WHEN 96 THEN 'warming_up' ELSE 'ok' END AS status, CASE WHEN lack NOT IN (48, 72) THEN 'tier0' END AS champion, CASE WHEN n_live IS NOT NULL THEN 'tier0' END AS tier, n_live, round(q50, 4) AS q50 FROM s LEFT JOIN used USING (sv)",
)
def fleet_run(spark: SparkSession, sf: str) -> DataFrame:
    """All stations and two variables from pairs to forecasts, with tier 0: archive in two parts, models stored in two versions, forecasts from the store, status of each."""
    out = _fleet(spark, sf, (0,))
    return out.select(*FLEET_BY, "status", "champion", "tier", "n_live", F.round("q50", 4).alias("q50"))


@query("fleet_tiers", f"{_FLEET}, s AS (SELECT DISTINCT station_id, variable, lack FROM named) SELECT station_id, variable, CASE lack WHEN 24 THEN 'no_forecast' WHEN 48 THEN 'no_observations' WHEN 72 THEN 'no_data' WHEN 96 THEN 'warming_up' ELSE 'ok' END AS status, CASE WHEN lack > 96 THEN true END AS allowed, CASE WHEN lack > 96 THEN true END AS in_order FROM s")
def fleet_tiers(spark: SparkSession, sf: str) -> DataFrame:
    """The same with distributions too: whether the tier that was used is one that the station's rows allow, and its quantiles rise."""
    out = _fleet(spark, sf, (0, 1))
    return out.select(*FLEET_BY, "status", F.when(F.col("tier").isNotNull(), F.col("tier").isin("tier0", "tier1") & F.col("champion").isin("tier0", "tier1")).alias("allowed"), F.when(F.col("q50").isNotNull(), F.col("n_live") > 0).alias("in_order"))
