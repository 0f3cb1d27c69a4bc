"""Queries of the station catalogue and of selection, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratocast import config as C
from stratocast import fixtures as X
from stratocast.operators import bias, pairing, stations, verification, walkforward
from stratocast.plans.training import STAMP, stamp, tier0_sql, wide_sql

Q, O = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            O[name] = sql
        return f

    return add


ST = f"WITH {X.STATIONS}"
_SUFFIXES = ", ".join(f"'{s}'" for s in C.SNOTEL_SUFFIXES)
NETWORK = f"CASE WHEN len(string_split(id, ':')) < 2 THEN 'SNOTEL' WHEN string_split(id, ':')[-1] IN ({_SUFFIXES}) THEN 'SNOTEL' ELSE string_split(id, ':')[1] END"


@query("network_of_id", f"{ST}, v AS (SELECT id FROM stations UNION ALL SELECT replace(id, 'MS:', '') || ':CO:SNTL' FROM stations WHERE id LIKE 'MS:%' UNION ALL SELECT replace(id, 'MS:', '') FROM stations WHERE id LIKE 'MS:%') SELECT id, {NETWORK} AS network, translate(id, ':/ ', '___') AS safe_id FROM v")
def network_of_id(spark: SparkSession, sf: str) -> DataFrame:
    ids = X.stations(spark, sf).select("id")
    bare = ids.where("id LIKE 'MS:%'").select(F.replace("id", F.lit("MS:"), F.lit("")).alias("id"))
    every = ids.union(bare.select(F.concat("id", F.lit(":CO:SNTL")))).union(bare)
    return every.select("id", stations.network_of(F.col("id")).alias("network"), stations.safe_id(F.col("id")).alias("safe_id"))


@query("stable_bucket", f"{ST} SELECT id, CAST(CAST('0x' || left(md5(id), 8) AS BIGINT) % 20 AS INT) AS bucket FROM stations")
def stable_bucket(spark: SparkSession, sf: str) -> DataFrame:
    return X.stations(spark, sf).select("id", stations.stable_bucket(F.col("id"), 20).alias("bucket"))


_RANK = "CASE string_split(id, ':')[1] WHEN 'NWS' THEN 0 WHEN 'IEM' THEN 1 WHEN 'MS' THEN 2 ELSE 9 END"
_DEDUPED = (
    f"d0 AS (SELECT *, round(lat, 3) AS rlat, round(lon, 3) AS rlon, {_RANK} AS k FROM stations), d1 AS (SELECT * REPLACE (first_value(nws_id IGNORE NULLS) OVER w AS nws_id, first_value(iem_network IGNORE NULLS) OVER w AS iem_network, "
    "first_value(ghcnh_id IGNORE NULLS) OVER w AS ghcnh_id), row_number() OVER (PARTITION BY rlat, rlon ORDER BY k, id) AS r FROM d0 WINDOW w AS (PARTITION BY rlat, rlon ORDER BY k, id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)), deduped AS (SELECT * FROM d1 WHERE r = 1)"
)
_STATION = ("id", "name", "lat", "lon", "elev_m", "country", "nws_id", "iem_network", "ghcnh_id")


@query("catalogue_dedupe", f"{ST}, {_DEDUPED} SELECT {', '.join(_STATION)} FROM deduped")
def catalogue_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    return stations.deduplicate(X.stations(spark, sf)).select(*_STATION)


@query("reporting_filter", f"{ST} SELECT id, nws_id FROM stations WHERE string_split(id, ':')[1] <> 'NWS' OR coalesce(regexp_full_match(nws_id, '[KPT][A-Z0-9]{{3}}'), false)")
def reporting_filter(spark: SparkSession, sf: str) -> DataFrame:
    return stations.reports(X.stations(spark, sf)).select("id", "nws_id")


@query("universe_filter", f"{ST} SELECT id, elev_m, country FROM stations WHERE coalesce(elev_m, -1) >= 500 AND NOT coalesce(country IN ('NATION_1', 'NATION_2'), false)")
def universe_filter(spark: SparkSession, sf: str) -> DataFrame:
    return stations.universe(X.stations(spark, sf), 500.0, ("NATION_1", "NATION_2")).select("id", "elev_m", "country")


@query("highest_first", f"{ST} SELECT id, elev_m, row_number() OVER (ORDER BY elev_m DESC NULLS LAST, id) AS rank FROM stations QUALIFY rank <= 50")
def highest_first(spark: SparkSession, sf: str) -> DataFrame:
    top = X.stations(spark, sf).orderBy(F.desc_nulls_last("elev_m"), "id").limit(50)  # the report has fifty
    return top.select("id", "elev_m", F.row_number().over(W.orderBy(F.desc_nulls_last("elev_m"), "id")).cast("long").alias("rank"))


_KNOWN = "known AS (SELECT id FROM stations WHERE CAST('0x' || left(md5(id), 8) AS BIGINT) % 3 = 0)"


def _known(spark, sf):
    return X.stations(spark, sf).where(stations.stable_bucket(F.col("id"), 3) == 0).select("id")


@query("new_enrollments", f"{ST}, {_KNOWN} SELECT id, name FROM stations ANTI JOIN known USING (id) WHERE coalesce(elev_m, -1) >= 0")
def new_enrollments(spark: SparkSession, sf: str) -> DataFrame:
    return stations.universe(X.stations(spark, sf), 0.0, ()).join(_known(spark, sf), "id", "left_anti").select("id", "name")


_INSIDE = "lat BETWEEN 24 AND 50 AND lon BETWEEN -125 AND -66"


@query("default_model_set", f"{ST}, m AS (SELECT id, unnest(CASE WHEN {_INSIDE} THEN ['gfs_seamless', 'ecmwf_ifs025', 'icon_seamless', 'ncep_hrrr_conus'] ELSE ['gfs_seamless', 'ecmwf_ifs025', 'icon_seamless'] END) AS model FROM stations) SELECT * FROM m")
def default_model_set(spark: SparkSession, sf: str) -> DataFrame:
    return stations.default_models(X.stations(spark, sf)).select("id", F.explode("models").alias("model"))


@query(
    "validate_candidates",
    f"{ST}, {_KNOWN}, c AS (SELECT s.*, k.id IS NOT NULL AS enrolled FROM stations s LEFT JOIN known k ON k.id = s.id) SELECT id, array_to_string(list_filter([CASE WHEN NOT regexp_full_match(id, '[A-Z]+:[A-Za-z0-9:]+') THEN 'id' END, CASE WHEN length(trim(name)) = 0 THEN 'name' END, "
    "CASE WHEN elev_m IS NOT NULL AND NOT elev_m - 400 BETWEEN -500 AND 9000 THEN 'elevation' END, CASE WHEN id LIKE 'IEM:%' AND nullif(iem_network, 'N3') IS NULL THEN 'network' END, "
    f"CASE WHEN elev_m IS NULL THEN 'unknown model' END, CASE WHEN id LIKE 'MS:%' THEN 'unknown variable' END, CASE WHEN NOT ({_INSIDE}) THEN 'regional model' END, CASE WHEN enrolled THEN 'enrolled' END], lambda x: x IS NOT NULL), ',') AS errors FROM c",
)
def validate_candidates(spark: SparkSession, sf: str) -> DataFrame:
    models = F.when(F.col("elev_m").isNull(), F.array(F.lit("ncep_hrrr_conus"), F.lit("nosuch"))).otherwise(F.array(F.lit("ncep_hrrr_conus")))
    variables = F.when(F.col("id").startswith("MS:"), F.array(F.lit("snow"))).otherwise(F.array(F.lit("air_temp_c")))
    given = X.stations(spark, sf).withColumn("models", models).withColumn("variables", variables).withColumn("elev_m", F.col("elev_m") - 400).withColumn("iem_network", F.when(F.col("iem_network") != "N3", F.col("iem_network")))
    return stations.problems(given, _known(spark, sf)).select("id", F.array_join("errors", ",").alias("errors"))


@query("token_search", f"{ST}, {_KNOWN} SELECT id, name FROM stations ANTI JOIN known USING (id) WHERE contains(lower(name || ' ' || id), 'customer') AND contains(lower(name || ' ' || id), 'nws') ORDER BY id LIMIT 40")
def token_search(spark: SparkSession, sf: str) -> DataFrame:
    return stations.search(X.stations(spark, sf).join(_known(spark, sf), "id", "left_anti"), "customer NWS", 40).select("id", "name")


@query("bbox_select", f"{ST}, {_KNOWN} SELECT id, lat, lon, count(*) OVER () AS total FROM stations ANTI JOIN known USING (id) WHERE lat BETWEEN 30 AND 45 AND lon BETWEEN -110 AND -80 ORDER BY id LIMIT 600")
def bbox_select(spark: SparkSession, sf: str) -> DataFrame:
    found = stations.in_box(X.stations(spark, sf).join(_known(spark, sf), "id", "left_anti"), 30.0, 45.0, -110.0, -80.0).select("id", "lat", "lon")
    return stations.shown(found)


@query("network_counts", f"{ST} SELECT {NETWORK} AS network, count(*) AS n, count(nws_id) AS n_nws, count(elev_m) AS n_elevation FROM stations GROUP BY ALL")
def network_counts(spark: SparkSession, sf: str) -> DataFrame:
    return X.stations(spark, sf).groupBy(stations.network_of(F.col("id")).alias("network")).agg(F.count("*").alias("n"), F.count("nws_id").alias("n_nws"), F.count("elev_m").alias("n_elevation"))


@query("instant_eligible", f"{ST} SELECT id, nws_id IS NOT NULL OR id LIKE 'NWS:%' OR (id LIKE 'IEM:%' AND iem_network IS NOT NULL) AS eligible FROM stations")
def instant_eligible(spark: SparkSession, sf: str) -> DataFrame:
    i = F.col("id")
    return X.stations(spark, sf).select("id", (F.col("nws_id").isNotNull() | i.startswith("NWS:") | (i.startswith("IEM:") & F.col("iem_network").isNotNull())).alias("eligible"))


_ENTRY = "SELECT o_custkey % 400 AS k, o_orderkey AS seq, o_orderstatus AS status, o_totalprice / 1000 AS skill FROM orders"


@query("index_overlay", f"WITH e AS ({_ENTRY}), f AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY seq) AS r FROM e WHERE seq % 2 = 0), b AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY seq) AS r FROM e WHERE seq % 2 = 1) SELECT k AS id, seq, status, skill FROM f WHERE r = 1 UNION ALL SELECT k, seq, status, skill FROM b WHERE r = 1 AND k NOT IN (SELECT k FROM f)")
def index_overlay(spark: SparkSession, sf: str) -> DataFrame:
    e = spark.read.parquet(f"{sf}/orders.parquet").select((F.col("o_custkey") % 400).alias("id"), F.col("o_orderkey").alias("seq"), F.col("o_orderstatus").alias("status"), (F.col("o_totalprice") / 1000).alias("skill"))
    base = e.where("seq % 2 = 1").withColumn("r", F.row_number().over(W.partitionBy("id").orderBy("seq"))).where("r = 1").drop("r")
    return stations.overlay(base, e.where("seq % 2 = 0")).select("id", "seq", "status", "skill")


@query("station_state", "WITH s AS (SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 'no_data' ELSE 'ok' END AS status, CASE WHEN o_orderkey % 7 <> 0 THEN (o_totalprice - 250000) / 1000000 END AS skill FROM orders) SELECT id, CASE WHEN status <> 'ok' THEN 'unavailable' WHEN skill IS NULL THEN 'warming' WHEN skill - 0.05 > 0 THEN 'beats' WHEN skill > 0 THEN 'inconclusive' ELSE 'worse' END AS state FROM s")
def station_state(spark: SparkSession, sf: str) -> DataFrame:
    o = spark.read.parquet(f"{sf}/orders.parquet").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderstatus") == "F", "no_data").otherwise("ok").alias("status"), F.when(F.col("o_orderkey") % 7 != 0, (F.col("o_totalprice") - 250000) / 1000000).alias("skill"))
    return o.select("id", stations.state(F.col("skill"), F.col("skill") - 0.05 > 0, F.col("status")).alias("state"))


# --- selection ------------------------------------------------------------------------------------

WIDE = f"WITH {X.PAIRS}, {wide_sql('pairs')}"
_GATES = "list_filter([0, 1, 2, 3], lambda t: days >= [0, 15, 90, 365][t + 1] AND n >= [0, 200, 1000, 4000][t + 1])"


_ELIGIBLE = f"e AS (SELECT station_id, lead_h, (epoch(max(valid_time)) - epoch(min(valid_time))) / CAST(86400 AS DOUBLE) AS days, count(*) AS n FROM wide GROUP BY ALL), g AS (SELECT *, {_GATES} AS tiers FROM e)"


@query("eligibility", f"{WIDE}, {_ELIGIBLE} SELECT station_id, lead_h, n, round(days, 6) AS days, array_to_string(list_transform(tiers, lambda x: CAST(x AS VARCHAR)), ',') AS tiers FROM g")
def eligibility(spark: SparkSession, sf: str) -> DataFrame:
    w = pairing.wide(X.pairs(spark, sf))
    return walkforward.eligible(w, ("station_id", "lead_h")).select("station_id", "lead_h", "n", F.round("days", 6).alias("days"), F.array_join(F.transform("tiers", lambda x: x.cast("string")), ",").alias("tiers"))


_TIERS = "s AS (SELECT station_id, lead_h, CASE model WHEN 'gfs' THEN 'tier1' WHEN 'ecmwf' THEN 'tier2' ELSE 'tier3' END AS tier, avg(abs(obs - fc)) AS score FROM pairs WHERE fc IS NOT NULL GROUP BY ALL)"
_CHOSEN = (
    f"{_ELIGIBLE}, {_TIERS}, open AS (SELECT s.* FROM s JOIN g USING (station_id, lead_h) WHERE list_contains(list_transform(tiers, lambda t: 'tier' || t), tier)), b AS (SELECT *, row_number() OVER (PARTITION BY station_id, lead_h ORDER BY score, tier) AS r FROM open), i AS (SELECT station_id, lead_h, CASE WHEN lead_h % 48 = 0 THEN 'tier2' ELSE 'tier3' END AS incumbent FROM e), "
    "c AS (SELECT e.station_id, e.lead_h, b.tier AS best, i.incumbent, CASE WHEN b.tier IS NULL THEN 'tier0' WHEN o.score > 0 AND i.incumbent <> b.tier AND (o.score - b.score) / o.score < CAST(0.02 AS DOUBLE) THEN i.incumbent ELSE b.tier END AS champion FROM e JOIN i USING (station_id, lead_h) LEFT JOIN b ON b.station_id = e.station_id AND b.lead_h = e.lead_h AND r = 1 LEFT JOIN open o ON o.station_id = e.station_id AND o.lead_h = e.lead_h AND o.tier = i.incumbent)"
)


def _gates(spark, sf) -> DataFrame:
    by = ("station_id", "lead_h")
    return walkforward.eligible(pairing.wide(X.pairs(spark, sf)), by).withColumn("tiers", F.transform("tiers", lambda t: F.concat(F.lit("tier"), t.cast("string"))))


def _chosen(spark, sf) -> DataFrame:
    """Decisions over scores that the raw models stand in for."""
    by = ("station_id", "lead_h")
    tier = F.when(F.col("model") == "gfs", "tier1").when(F.col("model") == "ecmwf", "tier2").otherwise("tier3")
    scores = X.pairs(spark, sf).where("fc IS NOT NULL").groupBy(*by, tier.alias("tier")).agg(F.avg(F.abs(F.col("obs") - F.col("fc"))).alias("score"))
    gates = _gates(spark, sf)
    held = gates.select(*by, F.when(F.col("lead_h") % 48 == 0, "tier2").otherwise("tier3").alias("incumbent"))
    return walkforward.choose(scores, gates, held, by)


@query("champion", f"{WIDE}, {_CHOSEN} SELECT * FROM c")
def champion(spark: SparkSession, sf: str) -> DataFrame:
    return _chosen(spark, sf).select("station_id", "lead_h", "best", "incumbent", "champion")


@query(
    "training_plan",
    f"{WIDE}, {_CHOSEN} SELECT g.station_id, g.lead_h, g.n, 'ok' AS status, x.champion, array_to_string(list_concat([x.champion], list_filter(['tier1', 'tier0'], lambda t: list_contains(list_transform(tiers, lambda k: 'tier' || k), t) AND t <> x.champion)), ',') AS to_fit FROM g JOIN (SELECT station_id, lead_h, CASE WHEN lead_h % 72 <> 0 THEN c.champion WHEN list_contains(list_transform(tiers, lambda k: 'tier' || k), incumbent) THEN incumbent ELSE 'tier' || tiers[-1] END AS champion FROM c JOIN g USING (station_id, lead_h)) x USING (station_id, lead_h)",
)
def training_plan(spark: SparkSession, sf: str) -> DataFrame:
    """What is to be fitted: by the new decision where there is one, else by the last."""
    decided = _chosen(spark, sf).withColumns({"previous": F.col("incumbent"), "champion": F.when(F.col("lead_h") % 72 != 0, F.col("champion"))})
    out = walkforward.training_plan(_gates(spark, sf), decided, ("station_id", "lead_h"))
    return out.select("station_id", "lead_h", "n", "status", "champion", F.array_join("to_fit", ",").alias("to_fit"))


@query("prediction_fallback", f"{WIDE}, v AS (SELECT station_id, valid_time, lead_h, unnest([{{'p': 0, 'tier': 'icon', 'q': fc_icon}}, {{'p': 1, 'tier': 'ecmwf', 'q': CASE WHEN ingest_seq % 3 <> 0 THEN fc_ecmwf END}}, {{'p': 2, 'tier': 'gfs', 'q': fc_gfs}}]) AS t FROM wide) SELECT station_id, {STAMP}, lead_h, t.tier AS tier, round(t.q, 6) AS q50 FROM v WHERE t.q IS NOT NULL QUALIFY row_number() OVER (PARTITION BY station_id, v.valid_time, lead_h ORDER BY t.p) = 1")
def prediction_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """The first tier that has a calibrated value, in order of priority."""
    tiers = (("icon", F.col("fc_icon")), ("ecmwf", F.when(F.col("ingest_seq") % 3 != 0, F.col("fc_ecmwf"))), ("gfs", F.col("fc_gfs")))
    chosen = F.coalesce(*[F.when(q.isNotNull(), F.struct(F.lit(t).alias("tier"), q.alias("q"))) for t, q in tiers])
    out = pairing.wide(X.pairs(spark, sf)).withColumn("t", chosen).where("t IS NOT NULL")
    return out.select("station_id", stamp(), "lead_h", F.col("t.tier").alias("tier"), F.round("t.q", 6).alias("q50"))


@query("decision_merge", "WITH o AS (SELECT c_custkey AS id, c_mktsegment AS champion, CASE WHEN c_custkey % 4 <> 0 THEN c_acctbal END AS card FROM customer WHERE c_custkey % 3 <> 0), n AS (SELECT c_custkey AS id, c_mktsegment || '2' AS champion, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal + 1 END AS card FROM customer WHERE c_custkey % 5 <> 0) SELECT coalesce(o.id, n.id) AS id, coalesce(n.champion, o.champion) AS champion, coalesce(n.card, o.card) AS card FROM o FULL JOIN n ON o.id = n.id")
def decision_merge(spark: SparkSession, sf: str) -> DataFrame:
    """New decisions over old ones; a score card stays where the new run has none."""
    c = spark.read.parquet(f"{sf}/customer.parquet")
    old = c.where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("champion"), F.when(F.col("c_custkey") % 4 != 0, F.col("c_acctbal")).alias("card"))
    new = c.where("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("id"), F.concat("c_mktsegment", F.lit("2")).alias("n_champion"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_acctbal") + 1).alias("n_card"))
    return old.join(new, "id", "full").select("id", F.coalesce("n_champion", "champion").alias("champion"), F.coalesce("n_card", "card").alias("card"))


@query("station_status", f"WITH {X.REPORTS}, r AS (SELECT station_id, CAST(TIMESTAMP '2024-02-05 00:00:00' - max(valid) AS INTERVAL) AS i, max(valid) AS newest, count(*) AS n FROM reports GROUP BY ALL) SELECT station_id, n, round((epoch(TIMESTAMP '2024-02-05 00:00:00') - epoch(date_trunc('second', newest))) / 86400.0, 1)::DOUBLE AS age_days, (epoch(TIMESTAMP '2024-02-05 00:00:00') - epoch(date_trunc('second', newest))) / 86400.0 > 7 AS stale FROM r")
def station_status(spark: SparkSession, sf: str) -> DataFrame:
    """Age of the newest observation against an issue time, and whether it is stale."""
    r = X.reports(spark, sf).groupBy("station_id").agg(F.count("*").alias("n"), F.max("valid").alias("newest"))
    age = (F.unix_timestamp(F.lit("2024-02-05 00:00:00").cast("timestamp")) - F.unix_timestamp("newest")) / 86400.0
    return r.select("station_id", "n", F.round(age, 1).alias("age_days"), (age > 7).alias("stale"))
