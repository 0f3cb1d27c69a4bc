"""Queries of station lists, the partitioned archive and landed payloads, with their SQL. Payloads are made from the given tables, landed, and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratocast import config as C
from stratocast import fixtures as X
from stratocast.operators import quality, stations
from stratocast.plans.stations import NETWORK
from stratocast.plans.training import HOURLY, STAMP, stamp
from stratocast.sources import archive, lists, payloads
from stratocast.storage import read_archive, shared_folder, write_archive

Q, O = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        Q[name] = f
        if sql:
            O[name] = sql
        return f

    return add


# --- station lists --------------------------------------------------------------------------------

_PLACES = "places AS (SELECT c_custkey AS k, c_name AS name, CAST(c_custkey * 7 % 50 AS DOUBLE) AS lat, CAST(-(c_custkey * 11 % 60) - 66 AS DOUBLE) AS lon, c_acctbal / 4 AS height, c_nationkey AS nk FROM customer)"


def _places(spark, sf) -> DataFrame:
    c = spark.read.parquet(f"{sf}/customer.parquet")
    k = F.col("c_custkey")
    return c.select(k.alias("k"), F.col("c_name").alias("name"), (k * 7 % 50).cast("double").alias("lat"), (-(k * 11 % 60) - 66).cast("double").alias("lon"), (F.col("c_acctbal") / 4).alias("height"), F.col("c_nationkey").alias("nk"))


def _landed(rows: DataFrame, page, entry, wrap: str | None, name: str = "network") -> DataFrame:
    """Documents of a bounded number of entries each."""
    pages = rows.groupBy(page.alias(name)).agg(F.collect_list(entry).alias("e"))
    return pages.select(F.col(name).cast("string").alias(name), F.to_json(F.struct(F.col("e").alias(wrap)) if wrap else F.col("e")).alias("payload"))


def _point():
    return F.struct(F.when(F.col("k") % 17 != 0, F.array("lon", "lat")).otherwise(F.array().cast("array<double>")).alias("coordinates")).alias("geometry")


def _weather_service(spark, sf) -> DataFrame:
    p = _places(spark, sf).where("k % 2 = 0")
    own = F.struct(F.when(F.col("k") % 13 != 0, F.concat(F.when(F.col("k") % 3 == 0, "K").otherwise("X"), F.lpad(F.col("k").cast("string"), 3, "A"))).alias("stationIdentifier"), F.when(F.col("k") % 5 != 0, F.col("name")).alias("name"), F.struct(F.when(F.col("k") % 9 != 0, F.col("height")).alias("value")).alias("elevation"))
    return lists.weather_service(_landed(p, F.floor(F.col("k") / 500), F.struct(own.alias("properties"), _point()), "features"))


_NWS_ID = "CASE WHEN k % 3 = 0 THEN 'K' ELSE 'X' END || CASE WHEN length(CAST(k AS VARCHAR)) > 3 THEN left(CAST(k AS VARCHAR), 3) ELSE lpad(CAST(k AS VARCHAR), 3, 'A') END"
_NONE = "CAST(NULL AS VARCHAR)"
_NWS = f"nws AS (SELECT 'NWS:' || s AS id, CASE WHEN k % 5 <> 0 THEN name ELSE s END AS name, lat, lon, CASE WHEN k % 9 <> 0 THEN height END AS elev_m, 'NWS' AS network, 'US' AS country, {_NONE} AS iem_network, s AS nws_id, {_NONE} AS ghcnh_id FROM (SELECT *, {_NWS_ID} AS s FROM places WHERE k % 2 = 0 AND k % 13 <> 0 AND k % 17 <> 0))"


@query("nws_station_list", f"WITH {_PLACES}, {_NWS} SELECT * FROM nws")
def nws_station_list(spark: SparkSession, sf: str) -> DataFrame:
    return _weather_service(spark, sf)


def _airports(spark, sf) -> DataFrame:
    p = _places(spark, sf).where("k % 2 = 1")
    sid = F.when(F.col("k") % 10 < 5, F.concat(F.lit("A"), F.lpad((F.col("k") % 100).cast("string"), 2, "0"))).otherwise(F.concat(F.lit("B"), F.col("k").cast("string")))
    properties = F.struct(F.when(F.col("k") % 19 != 0, sid).alias("sid"), F.col("name").alias("sname"), (F.col("k") % 23 != 0).alias("online"), F.when(F.col("k") % 29 == 0, "2020-01-01").alias("archive_end"), F.when(F.col("k") % 9 != 0, F.col("height")).alias("elevation"), F.when(F.col("k") % 4 == 1, "US").alias("country"), F.struct(F.when(F.col("k") % 6 == 1, F.concat(F.lit("G"), F.col("k").cast("string"))).otherwise("").alias("GHCNH_ID")).alias("attributes"))
    network = F.concat(F.when(F.col("nk") % 2 == 0, "_").otherwise(""), F.lpad(F.col("nk").cast("string"), 2, "0"), F.lit("__"), F.floor(F.col("k") / 500).cast("string"), F.lit("_ASOS"))
    return lists.airports(_landed(p, network, F.struct(F.concat(F.lit("F"), F.col("k").cast("string")).alias("id"), properties.alias("properties"), _point()), "features"))


_IEM = f"""iem AS (SELECT 'IEM:' || s AS id, name, lat, lon, CASE WHEN k % 9 <> 0 THEN height END AS elev_m, 'IEM' AS network, coalesce(us, CASE WHEN code NOT LIKE '\\_%' ESCAPE '\\' THEN left(code, 2) END) AS country, code AS iem_network,
 CASE WHEN length(s) = 3 AND us = 'US' THEN 'K' || s END AS nws_id, CASE WHEN k % 6 = 1 THEN 'G' || CAST(k AS VARCHAR) END AS ghcnh_id FROM (SELECT *, CASE WHEN k % 19 = 0 THEN 'F' || CAST(k AS VARCHAR) WHEN k % 10 < 5 THEN 'A' || lpad(CAST(k % 100 AS VARCHAR), 2, '0') ELSE 'B' || CAST(k AS VARCHAR) END AS s,
 CASE WHEN k % 4 = 1 THEN 'US' END AS us, CASE WHEN nk % 2 = 0 THEN '_' ELSE '' END || lpad(CAST(nk AS VARCHAR), 2, '0') || '__' || CAST(k // 500 AS VARCHAR) || '_ASOS' AS code FROM places WHERE k % 2 = 1 AND k % 17 <> 0 AND k % 23 <> 0 AND k % 29 <> 0))"""


@query("iem_station_list", f"WITH {_PLACES}, {_IEM} SELECT * FROM iem")
def iem_station_list(spark: SparkSession, sf: str) -> DataFrame:
    return _airports(spark, sf)


def _long_tail(spark, sf) -> DataFrame:
    k = F.col("s_suppkey")
    s = spark.read.parquet(f"{sf}/supplier.parquet").select(k.alias("k"), F.col("s_name").alias("name"), (k * 7 % 50).cast("double").alias("lat"), (-(k * 11 % 60) - 66).cast("double").alias("lon"), (F.col("s_acctbal") / 4).alias("height"), F.col("s_nationkey").alias("nk"))
    k = F.col("k")
    names = F.when(k % 3 == 0, F.create_map(F.lit("de"), F.concat("name", F.lit(" de")), F.lit("en"), F.col("name"))).when(k % 3 == 1, F.create_map(F.lit("de"), F.concat("name", F.lit(" de")))).otherwise(F.create_map().cast("map<string,string>"))
    place = F.struct(F.when(k % 17 != 0, F.col("lat")).alias("latitude"), F.col("lon").alias("longitude"), F.when(k % 9 != 0, F.col("height")).alias("elevation"))
    entry = F.struct(k.cast("string").alias("id"), names.alias("name"), F.col("nk").cast("string").alias("country"), place.alias("location"), F.struct(F.when(k % 2 == 0, F.concat(F.lit("G"), k.cast("string"))).alias("national")).alias("identifiers"))
    return lists.long_tail(_landed(s, F.floor(k / 500), entry, None))


_MS = f"""ms AS (SELECT 'MS:' || CAST(k AS VARCHAR) AS id, CASE WHEN k % 3 = 0 THEN name WHEN k % 3 = 1 THEN name || ' de' ELSE CAST(k AS VARCHAR) END AS name, CAST(k * 7 % 50 AS DOUBLE) AS lat, CAST(-(k * 11 % 60) - 66 AS DOUBLE) AS lon, CASE WHEN k % 9 <> 0 THEN height END AS elev_m, 'MS' AS network,
 CAST(nk AS VARCHAR) AS country, {_NONE} AS iem_network, {_NONE} AS nws_id, CASE WHEN k % 2 = 0 THEN 'G' || CAST(k AS VARCHAR) END AS ghcnh_id FROM (SELECT s_suppkey AS k, s_name AS name, s_acctbal / 4 AS height, s_nationkey AS nk FROM supplier) WHERE k % 17 <> 0)"""


@query("meteostat_station_list", f"WITH {_MS} SELECT * FROM ms")
def meteostat_station_list(spark: SparkSession, sf: str) -> DataFrame:
    return _long_tail(spark, sf)


@query(
    "snotel_station_list",
    f"WITH {_PLACES} SELECT t AS id, CASE WHEN k % 5 <> 0 THEN name ELSE t END AS name, lat, lon, height * CAST(0.3048 AS DOUBLE) AS elev_m, 'SNOTEL' AS network, 'US' AS country, {_NONE} AS iem_network, {_NONE} AS nws_id, {_NONE} AS ghcnh_id, CASE WHEN k % 4 = 1 THEN 'CO' ELSE 'UT' END AS state "
    "FROM (SELECT *, CAST(k AS VARCHAR) || CASE WHEN k % 4 = 1 THEN ':CO' ELSE ':UT' END || ':SNTL' AS t FROM places WHERE k % 3 <> 0 AND k % 17 <> 0)",
)
def snotel_station_list(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("k")
    triplet = F.concat(k.cast("string"), F.when(k % 4 == 1, ":CO").otherwise(":UT"), F.when(k % 3 == 0, ":MSNT").otherwise(":SNTL"))
    entry = F.struct(triplet.alias("stationTriplet"), F.when(k % 5 != 0, F.col("name")).alias("name"), F.when(k % 17 != 0, F.col("lat")).alias("latitude"), F.col("lon").alias("longitude"), F.col("height").alias("elevation"))
    return lists.snow_sites(_landed(_places(spark, sf), F.floor(k / 500), entry, None))


_BUILT = (
    f"WITH {_PLACES}, {_NWS}, {_IEM}, {_MS}, u AS (SELECT * FROM nws UNION ALL SELECT * FROM iem UNION ALL SELECT * FROM ms), r AS (SELECT *, CASE network WHEN 'NWS' THEN 0 WHEN 'IEM' THEN 1 ELSE 2 END AS k, round(lat, 3) AS rlat, round(lon, 3) AS rlon FROM u WHERE network <> 'NWS' OR regexp_full_match(nws_id, '[KPT][A-Z0-9]{{3}}')), "
    "d AS (SELECT * REPLACE (first_value(nws_id IGNORE NULLS) OVER w AS nws_id, first_value(iem_network IGNORE NULLS) OVER w AS iem_network, first_value(ghcnh_id IGNORE NULLS) OVER w AS ghcnh_id), row_number() OVER (PARTITION BY rlat, rlon ORDER BY k, id, name, elev_m) AS r FROM r WINDOW w AS (PARTITION BY rlat, rlon ORDER BY k, id, name, elev_m ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)), "
    "built AS (SELECT id, lat, lon, network, nws_id IS NOT NULL AS nws, iem_network IS NOT NULL AS iem, ghcnh_id IS NOT NULL AS ghcnh FROM d WHERE r = 1)"
)


@query("catalogue_build", f"{_BUILT} SELECT * FROM built")
def catalogue_build(spark: SparkSession, sf: str) -> DataFrame:
    """Ids may repeat in the landed lists; what is compared doesn't depend on which of equal ids stays."""
    out = lists.build([_weather_service(spark, sf), _airports(spark, sf), _long_tail(spark, sf)])
    return out.select("id", "lat", "lon", "network", *[F.col(c).isNotNull().alias(n) for c, n in (("nws_id", "nws"), ("iem_network", "iem"), ("ghcnh_id", "ghcnh"))])


@query(
    "catalogue_rows",
    f"WITH {X.STATIONS} SELECT id, '[' || concat_ws(',', to_json(id), to_json(name), to_json(round(lat, 4)), to_json(round(lon, 4)), coalesce(to_json(round(elev_m, 1)), 'null'), to_json(string_split(id, ':')[1]), to_json(country), coalesce(to_json(iem_network), 'null'), coalesce(to_json(nws_id), 'null'), coalesce(to_json(ghcnh_id), 'null')) || ']' AS row FROM stations",
)
def catalogue_rows(spark: SparkSession, sf: str) -> DataFrame:
    return lists.compact_rows(X.stations(spark, sf).withColumn("network", F.split("id", ":")[0]))


@query("public_metadata", f"WITH {X.STATIONS} SELECT id, name, round(lat / 7, 4) AS lat, round(lon / 7, 4) AS lon, elev_m, country, {NETWORK} AS network FROM stations")
def public_metadata(spark: SparkSession, sf: str) -> DataFrame:
    s = X.stations(spark, sf).withColumns({"lat": F.col("lat") / 7, "lon": F.col("lon") / 7})
    return stations.public(s)


@query("network_filter", f"WITH {X.STATIONS} SELECT id FROM stations WHERE {NETWORK} IN ('NWS', 'MS')")
def network_filter(spark: SparkSession, sf: str) -> DataFrame:
    return stations.of_networks(X.stations(spark, sf), " nws, MS ,").select("id")


@query("registry_listing", f"WITH {X.STATIONS} SELECT id, array_to_string(CASE WHEN id LIKE 'MS:%' THEN ['icon_seamless'] WHEN lat BETWEEN 24 AND 50 AND lon BETWEEN -125 AND -66 THEN ['gfs_seamless', 'ecmwf_ifs025', 'icon_seamless', 'ncep_hrrr_conus'] ELSE ['gfs_seamless', 'ecmwf_ifs025', 'icon_seamless'] END, ',') AS models FROM stations")
def registry_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Registered stations with the models that they resolve to; an explicit list wins."""
    s = X.stations(spark, sf).withColumn("models", F.when(F.col("id").startswith("MS:"), F.array(F.lit("icon_seamless"))))
    return stations.resolved_models(s).select("id", F.array_join("models", ",").alias("models"))


@query("registry_upsert", f"WITH {X.STATIONS}, o AS (SELECT id, name, elev_m FROM stations WHERE right(id, 1) <> '3'), n AS (SELECT id, name || ' new' AS name, elev_m FROM stations WHERE right(id, 1) IN ('3', '4')) SELECT id, name, elev_m FROM n UNION ALL SELECT * FROM o WHERE id NOT IN (SELECT id FROM n)")
def registry_upsert(spark: SparkSession, sf: str) -> DataFrame:
    s = X.stations(spark, sf).select("id", "name", "elev_m")
    fresh = s.where(F.right("id", F.lit(1)).isin("3", "4")).withColumn("name", F.concat("name", F.lit(" new")))
    return stations.upsert(s.where(F.right("id", F.lit(1)) != "3"), fresh)


# --- archive --------------------------------------------------------------------------------------

_RAW = "raw AS (SELECT 'S' || CAST(l_suppkey % 9 AS VARCHAR) AS station, l_shipdate + to_hours(CAST(l_orderkey % 24 AS INT)) + to_minutes(CAST(l_partkey % 60 AS INT)) AS valid, l_orderkey * 10 + l_linenumber AS event_id, l_quantity / 2 AS tmpc, l_quantity / 3 AS dwpc, l_discount * 100 AS relh, l_tax * 100 AS sknt, l_quantity AS gust, CAST(l_partkey % 360 AS DOUBLE) AS drct, l_tax AS p01m FROM lineitem)"
_ARCHIVE = "station string, valid timestamp, tmpc double, dwpc double, relh double, sknt double, gust double, drct double, p01m double, extra string, year int"


def _raw(spark, sf) -> DataFrame:
    r = spark.read.parquet(f"{sf}/lineitem.parquet")
    when = F.expr("CAST(l_shipdate AS TIMESTAMP) + make_dt_interval(0, CAST(l_orderkey % 24 AS INT), CAST(l_partkey % 60 AS INT))")
    values = (F.col("l_quantity") / 2, F.col("l_quantity") / 3, F.col("l_discount") * 100, F.col("l_tax") * 100, F.col("l_quantity").cast("double"), (F.col("l_partkey") % 360).cast("double"), F.col("l_tax").cast("double"))
    names = ("tmpc", "dwpc", "relh", "sknt", "gust", "drct", "p01m")
    return r.select(F.concat(F.lit("S"), (F.col("l_suppkey") % 9).cast("string")).alias("station"), when.alias("valid"), *[v.cast("double").alias(n) for v, n in zip(values, names, strict=True)], F.lit("x").alias("extra"), F.year(when).alias("year"))


def _archived(spark, sf) -> str:
    path = shared_folder(spark, "archive")
    _raw(spark, sf).write.partitionBy("year").parquet(path)
    return path


_WANTED = "station IN ('S1', 'S4', 'S7')"


def _wanted(spark, sf) -> DataFrame:
    s = spark.read.parquet(f"{sf}/supplier.parquet").select(F.concat(F.lit("ASOS:S"), (F.col("s_suppkey") % 9).cast("string")).alias("station_id")).distinct()
    return s.where(F.right("station_id", F.lit(1)).isin("1", "4", "7"))


@query("archive_scan", f"WITH {_RAW} SELECT station, strftime(valid, '%Y-%m-%d %H:%M:%S') AS valid, round(tmpc, 6) AS tmpc, round(gust, 6) AS gust FROM raw WHERE {_WANTED} AND valid >= TIMESTAMP '1994-03-01' AND valid < TIMESTAMP '1996-02-01'")
def archive_scan(spark: SparkSession, sf: str) -> DataFrame:
    out = archive.scan(spark, _archived(spark, sf), _wanted(spark, sf), "1994-03-01", "1996-02-01")
    return out.select("station", F.date_format("valid", "yyyy-MM-dd HH:mm:ss").alias("valid"), F.round("tmpc", 6).alias("tmpc"), F.round("gust", 6).alias("gust"))


@query(
    "archive_hourly",
    f"WITH {_RAW} SELECT 'ASOS:' || station AS station_id, strftime(date_trunc('hour', valid), '%Y-%m-%d %H:%M:%S') AS valid_time, round(avg(tmpc), 6) AS air_temp_c, round(avg(drct), 6) AS wind_dir_deg, round(max(gust) * CAST(0.514444 AS DOUBLE), 6) AS wind_gust_ms FROM raw WHERE {_WANTED} AND valid >= TIMESTAMP '1994-03-01' AND valid < TIMESTAMP '1996-02-01 23:59:59' GROUP BY ALL",
)
def archive_hourly(spark: SparkSession, sf: str) -> DataFrame:
    """The variant with the mean direction and the last day included, over year folders whose columns differ."""
    path = shared_folder(spark, "archive")
    raw = _raw(spark, sf)
    raw.where("year < 1995").write.partitionBy("year").parquet(path)
    raw.where("year >= 1995").drop("extra").write.mode("append").partitionBy("year").parquet(path)
    out = archive.scan(spark, path, _wanted(spark, sf), "1994-03-01", "1996-02-01", through=True, merge=True)
    hourly = archive.hourly_mean_direction(out)
    return hourly.select("station_id", stamp(), *[F.round(c, 6).alias(c) for c in ("air_temp_c", "wind_dir_deg", "wind_gust_ms")])


@query("archive_round_trip", f"WITH {X.PAIRS} SELECT station_id, model, lead_h, count(*) AS n, round(sum(CAST(CAST(fc AS FLOAT) AS DOUBLE)), 3) AS fc FROM pairs GROUP BY ALL")
def archive_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path, schema = shared_folder(spark, "pairs"), "valid_time timestamp, lead_h int, lead_source string, model string, fc double, obs double, ingest_seq long, station_id string"
    empty = read_archive(spark, path, schema)
    write_archive(X.pairs(spark, sf), path, ["station_id"])
    return empty.unionByName(read_archive(spark, path, schema)).groupBy("station_id", "model", "lead_h").agg(F.count("*").alias("n"), F.round(F.sum("fc"), 3).alias("fc"))


@query(
    "observation_history",
    f"WITH {X.REPORTS}, {HOURLY}, u AS (SELECT station_id, valid_time, air_temp_c, 1 AS seq FROM hourly WHERE day(valid_time) < 20 UNION ALL SELECT station_id, valid_time, air_temp_c + 1, 2 FROM hourly WHERE day(valid_time) >= 15) SELECT station_id, {STAMP}, round(air_temp_c, 6) AS air_temp_c FROM u QUALIFY row_number() OVER (PARTITION BY station_id, valid_time ORDER BY seq DESC) = 1",
)
def observation_history(spark: SparkSession, sf: str) -> DataFrame:
    """A stored history, a new window over its end, and what is stored then; only the months that the window touches are written again."""
    path, schema = shared_folder(spark, "history"), "station_id string, valid_time timestamp, air_temp_c double, seq int, month string"
    h = quality.hourly(X.reports(spark, sf)).select("station_id", "valid_time", "air_temp_c")
    for part in (h.where("day(valid_time) < 20").withColumn("seq", F.lit(1)), h.where("day(valid_time) >= 15").select("station_id", "valid_time", (F.col("air_temp_c") + 1).alias("air_temp_c"), F.lit(2).alias("seq"))):
        archive.merge_history(spark, path, part, schema)
    return spark.read.schema(schema).parquet(path).select("station_id", stamp(), F.round("air_temp_c", 6).alias("air_temp_c"))


_SOURCES = (
    f"WITH {X.REPORTS}, {HOURLY}, u AS (SELECT station_id, valid_time, air_temp_c, 0 AS k FROM hourly WHERE hour(valid_time) % 2 = 0 UNION ALL SELECT station_id, valid_time, air_temp_c + 1, 1 FROM hourly WHERE hour(valid_time) % 3 = 0 UNION ALL SELECT station_id, valid_time, air_temp_c * 3, 2 FROM hourly WHERE hour(valid_time) % 4 <> 0), "
    "m AS (SELECT * FROM u QUALIFY row_number() OVER (PARTITION BY station_id, valid_time ORDER BY CASE k WHEN 2 THEN 0 WHEN 0 THEN 1 ELSE 2 END) = 1)"
)


@query("observation_union", f"{_SOURCES} SELECT station_id, {STAMP}, round(CASE WHEN air_temp_c BETWEEN -70 AND 60 THEN air_temp_c END, 6) AS air_temp_c, CASE k WHEN 0 THEN 'nws' WHEN 1 THEN 'iem' ELSE 'ghcnh' END AS source FROM m")
def observation_union(spark: SparkSession, sf: str) -> DataFrame:
    """Three networks under ids of their own, relabelled to the station's, the best-ranked per hour, screened."""
    h = quality.hourly(X.reports(spark, sf))
    own = F.concat(F.lit("NWS:K"), F.right("station_id", F.lit(1)))
    table = h.select("station_id").distinct().select(F.col("station_id").alias("id"), F.concat(F.lit("K"), F.right("station_id", F.lit(1))).alias("nws_id"), F.concat(F.lit("G"), F.right("station_id", F.lit(1))).alias("ghcnh_id"))
    parts = {
        "iem": h.where("hour(valid_time) % 3 = 0").withColumn("air_temp_c", F.col("air_temp_c") + 1),
        "ghcnh": h.where("hour(valid_time) % 4 <> 0").withColumns({"station_id": F.concat(F.lit("GHCNH:G"), F.right("station_id", F.lit(1))), "air_temp_c": F.col("air_temp_c") * 3}),
        "nws": h.where("hour(valid_time) % 2 = 0").withColumn("station_id", own),
    }
    out = quality.range_screen(archive.gather(parts, table))
    return out.select("station_id", stamp(), F.round("air_temp_c", 6).alias("air_temp_c"), "source")


# --- landed observations --------------------------------------------------------------------------

_SOME = "station_id, valid, tmpc, relh, sknt, gust, drct, p01m"


def _read_back(out: DataFrame) -> DataFrame:
    return out.select("station_id", stamp(), *[F.round(c, 6).alias(c) for c in ("air_temp_c", "relative_humidity_pct", "wind_speed_ms", "wind_gust_ms", "wind_dir_deg", "precip_1h_mm")], "source")


def _expected(prefix: str, source: str, temp: str = "tmpc", speed: str = "1", rain: str = "1", direction: str = "median", gust: str = "max", where: str = "") -> str:
    return (
        f"WITH {X.REPORTS}, h AS (SELECT '{prefix}' || right(station_id, 1) AS station_id, date_trunc('hour', date_trunc('second', valid)) AS valid_time, avg({temp}) AS air_temp_c, avg(relh) AS relative_humidity_pct, avg(sknt * {speed}) AS wind_speed_ms, {gust}(gust * {speed}) AS wind_gust_ms, {direction}(drct) AS wind_dir_deg, {gust}(p01m * {rain}) AS precip_1h_mm FROM reports GROUP BY ALL) "
        f"SELECT station_id, {STAMP}, {', '.join(f'round({c}, 6) AS {c}' for c in ('air_temp_c', 'relative_humidity_pct', 'wind_speed_ms', 'wind_gust_ms', 'wind_dir_deg', 'precip_1h_mm'))}, '{source}' AS source FROM h WHERE coalesce(air_temp_c, relative_humidity_pct, wind_speed_ms, wind_gust_ms, wind_dir_deg, precip_1h_mm) IS NOT NULL{where}"
    )


def _stationed(spark, sf):
    return X.reports(spark, sf).withColumn("s", F.right("station_id", F.lit(1))).withColumn("valid", F.date_trunc("second", "valid"))


@query("nws_observations", _expected("NWS:K", "nws", speed="CAST(1 / 3.6 AS DOUBLE)"))
def nws_observations(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark, "landing")
    names = {"temperature": "tmpc", "relativeHumidity": "relh", "windSpeed": "sknt", "windGust": "gust", "windDirection": "drct", "precipitationLastHour": "p01m"}
    r = _stationed(spark, sf)
    properties = F.struct(F.concat(F.lit("K"), "s").alias("stationId"), F.date_format("valid", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("timestamp"), *[F.struct(F.col(v).alias("value")).alias(k) for k, v in names.items()])
    day = r.groupBy("s", F.to_date("valid").alias("day")).agg(F.collect_list(F.struct(properties.alias("properties"))).alias("features"))
    day.select(F.to_json(F.struct("features"))).write.text(path)  # a feature collection per station and day
    return _read_back(payloads.geojson_observations(spark, path, lines=True))


@query("ghcnh_observations", _expected("GHCNH:G", "ghcnh", direction="avg", gust="avg", where=" AND valid_time <= TIMESTAMP '2024-01-21'"))
def ghcnh_observations(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark, "landing")
    r = _stationed(spark, sf)
    columns = {"Temperature": "tmpc", "relative_humidity": "relh", "wind_speed": "sknt", "wind_gust": "gust", "wind_direction": "drct", "precipitation": "p01m"}
    r.select(F.concat(F.lit("G"), "s").alias("STATION"), F.date_format(F.date_trunc("hour", "valid"), "yyyy-MM-dd'T'HH:mm:ss").alias("DATE"), *[F.col(v).alias(k) for k, v in columns.items()]).write.option("sep", "|").option("header", True).csv(path)
    return _read_back(payloads.piped_observations(spark, path, "1970-01-01", "2024-01-20"))


@query("iem_observations", _expected("IEM:A", "iem", temp="(tmpc - 32) * 5 / 9", speed="CAST(0.514444 AS DOUBLE)", rain="CAST(25.4 AS DOUBLE)"))
def iem_observations(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark, "landing")
    missing = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("M"))
    r = _stationed(spark, sf)
    r.select(F.concat(F.lit("A"), "s").alias("station"), F.date_format("valid", "yyyy-MM-dd HH:mm").alias("valid"), *[missing(c).alias(n) for n, c in (("tmpf", "tmpc"), ("dwpf", "dwpc"), ("relh", "relh"), ("sknt", "sknt"), ("gust", "gust"), ("drct", "drct"), ("p01i", "p01m"))]).write.option("header", True).csv(path)
    return _read_back(payloads.csv_reports(spark, path))


@query("synoptic_observations", _expected("SYN:Y", "synoptic", direction="avg", gust="avg"))
def synoptic_observations(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark, "landing")
    r = _stationed(spark, sf)
    names = {"air_temp": "tmpc", "relative_humidity": "relh", "wind_speed": "sknt", "wind_gust": "gust", "wind_direction": "drct", "precip_accum_one_hour": "p01m"}
    day = r.groupBy("s", F.to_date("valid").alias("day")).agg(F.collect_list(F.struct("valid", *names.values())).alias("r"))
    entries = [F.lit("date_time"), F.transform("r", lambda x: F.date_format(x["valid"], "yyyy-MM-dd'T'HH:mm:ss"))]
    for k, v in names.items():
        entries += [F.lit(f"{k}_set_1"), F.col(f"r.{v}").cast("array<string>")]
    station = F.struct(F.concat(F.lit("Y"), "s").alias("STID"), F.create_map(*entries).alias("OBSERVATIONS"))
    day.select(F.to_json(F.struct(F.array(station).alias("STATION")))).write.text(path)
    return _read_back(payloads.array_observations(spark, path, lines=True))


@query("meteostat_observations", _expected("MS:Z", "meteostat", speed="CAST(1 / 3.6 AS DOUBLE)", where=" AND valid_time >= TIMESTAMP '2024-01-05' AND valid_time < TIMESTAMP '2024-01-25'"))
def meteostat_observations(spark: SparkSession, sf: str) -> DataFrame:
    """Yearly files of many stations by a glob; a line that can't be read gives nulls, not a failed job."""
    path = shared_folder(spark, "landing")
    hour = _stationed(spark, sf).groupBy("s", F.date_trunc("hour", "valid").alias("valid"))
    r = hour.agg(*[f(c).alias(c) for c, f in (("tmpc", F.avg), ("relh", F.avg), ("p01m", F.max), ("drct", F.median), ("sknt", F.avg), ("gust", F.max))])
    line = F.concat_ws(",", F.date_format("valid", "yyyy-MM-dd"), F.hour("valid").cast("string"), *[F.coalesce(c.cast("string"), F.lit("")) for c in (F.col("tmpc"), F.lit(None), F.col("relh"), F.col("p01m"), F.lit(None), F.col("drct"), F.col("sknt"), F.col("gust"), F.lit(None), F.lit(None), F.lit(None))])
    lines = r.select("s", line.alias("value")).union(r.select("s").distinct().withColumn("value", F.lit("not,a,line")))
    lines.repartition("s").write.partitionBy("s").text(path)
    return _read_back(payloads.yearly_csv(spark, f"{path}/*/*", "2024-01-05", "2024-01-25", station=r"/s=([^/]+)/", prefix="MS:Z"))




@query(
    "snow_telemetry",
    f"WITH {X.REPORTS}, k AS (SELECT station_id, date_trunc('hour', valid) AS valid_time, max(relh) AS total, max(round(tmpc * 9 / 5 + 32, 3)) AS f FROM reports WHERE relh IS NOT NULL OR tmpc IS NOT NULL GROUP BY ALL) "
    f"SELECT station_id, {STAMP}, round((f - 32) * 5 / 9, 6) AS air_temp_c, round(CASE WHEN total - lag(total) OVER (PARTITION BY station_id ORDER BY valid_time) IS NOT NULL THEN greatest(total - lag(total) OVER (PARTITION BY station_id ORDER BY valid_time), 0) END * CAST(25.4 AS DOUBLE), 6) AS precip_1h_mm FROM k",
)
def snow_telemetry(spark: SparkSession, sf: str) -> DataFrame:
    """Element series of many sites in many payloads, one a site and week, read to hours: the running total's increments cross the payloads, and its resets count as nothing."""
    r = X.reports(spark, sf).where("relh IS NOT NULL OR tmpc IS NOT NULL")
    series = [F.struct(F.lit("TOBS").alias("code"), F.round(F.col("tmpc") * 9 / 5 + 32, 3).alias("value")), F.struct(F.lit("PREC").alias("code"), F.col("relh").alias("value"))]
    long = r.select("station_id", "valid", F.date_trunc("week", "valid").alias("week"), F.explode(F.array(*series)).alias("e")).select("station_id", "valid", "week", "e.*").where("value IS NOT NULL")
    values = long.groupBy("station_id", "week", "code").agg(F.collect_list(F.struct(F.date_format("valid", "yyyy-MM-dd HH:mm").alias("date"), "value")).alias("values"))
    data = values.groupBy("station_id", "week").agg(F.collect_list(F.struct(F.struct(F.col("code").alias("elementCode")).alias("stationElement"), "values")).alias("data"))
    path = shared_folder(spark, "snow")
    data.select(F.to_json(F.struct(F.col("station_id").alias("stationTriplet"), "data"))).write.text(path)
    out = payloads.snow_telemetry(spark, path, lines=True)
    return out.select("station_id", stamp(), F.round("air_temp_c", 6).alias("air_temp_c"), F.round("precip_1h_mm", 6).alias("precip_1h_mm"))
