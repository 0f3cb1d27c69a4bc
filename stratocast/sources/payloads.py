"""Landed raw payloads to observations and forecasts; every reader has an explicit schema, and bad values become null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratocast import config as C
from stratocast.operators import quality

OBS = ("station_id", "valid_time", "air_temp_c", "dewpoint_c", "relative_humidity_pct", "wind_speed_ms", "wind_gust_ms", "wind_dir_deg", "precip_1h_mm", "source")


def number(c: Column | str) -> Column:
    """A double, or null where the text isn't one; NaN never enters."""
    v = F.expr(f"try_cast(`{c}` AS DOUBLE)") if isinstance(c, str) else c.try_cast("double")
    return F.when(~F.isnan(v), v)


def fahrenheit(c: Column) -> Column:
    return (c - 32) * 5 / 9


def finished(frame: DataFrame, source: str) -> DataFrame:
    """Padded and ordered to the fixed columns."""
    have = set(frame.columns)
    return frame.withColumn("source", F.lit(source)).select(*[F.col(c) if c in have or c == "source" else F.lit(None).cast("double").alias(c) for c in OBS])


def hourly_means(frame: DataFrame, largest: tuple[str, ...] = ("wind_gust_ms", "precip_1h_mm"), middle: tuple[str, ...] = ("wind_dir_deg",)) -> DataFrame:
    how = {c: F.max(c) if c in largest else F.median(c) if c in middle else F.avg(c) for c in frame.columns if c not in ("station_id", "valid_time")}
    return frame.groupBy("station_id", F.date_trunc("hour", "valid_time").alias("valid_time")).agg(*[v.alias(c) for c, v in how.items()]).dropna(how="all", subset=list(how))


def geojson_observations(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Weather-service feature collections, one a file or one a line; speeds in km/h."""
    value = "struct<value:double>"
    names = {"temperature": "air_temp_c", "dewpoint": "dewpoint_c", "relativeHumidity": "relative_humidity_pct", "windSpeed": "wind_speed_ms", "windGust": "wind_gust_ms", "windDirection": "wind_dir_deg", "precipitationLastHour": "precip_1h_mm"}
    schema = f"features array<struct<properties:struct<stationId:string,timestamp:string,{','.join(f'{k}:{value}' for k in names)}>>>"
    p = spark.read.schema(schema).json(path, multiLine=not lines).select(F.explode("features.properties").alias("p"))
    speed = {"windSpeed", "windGust"}
    rows = p.select(F.concat(F.lit("NWS:"), "p.stationId").alias("station_id"), F.to_timestamp("p.timestamp").alias("valid_time"), *[(F.col(f"p.{k}.value") * (C.KMH if k in speed else 1.0)).alias(v) for k, v in names.items()])
    return finished(hourly_means(rows), "nws")


def piped_observations(spark: SparkSession, path: str, start: str, end: str) -> DataFrame:
    """Pipe-separated global hourly files; columns by any of their names, in any case; means of everything; through the day after ``end``."""
    raw = spark.read.csv(path, sep="|", quote="", header=True)
    by_name = {c.lower(): c for c in raw.columns}
    pick = lambda *names: F.coalesce(*[number(by_name[n]) for n in names if n in by_name], F.lit(None).cast("double"))
    parts = all(k in by_name for k in ("year", "month", "day", "hour"))
    made = F.expr(f"make_timestamp({', '.join(f'try_cast(`{by_name[k]}` AS INT)' for k in ('year', 'month', 'day', 'hour'))}, 0, 0)") if parts else F.lit(None).cast("timestamp")
    when = F.coalesce(F.expr(f"try_cast(`{by_name['date']}` AS TIMESTAMP)"), made) if "date" in by_name else made
    rows = raw.select(
        F.concat(F.lit("GHCNH:"), F.col(by_name["station_id" if "station_id" in by_name else "station"])).alias("station_id"), when.alias("valid_time"), pick("temperature", "air_temperature").alias("air_temp_c"), pick("dew_point_temperature", "dewpoint").alias("dewpoint_c"),
        pick("relative_humidity").alias("relative_humidity_pct"), pick("wind_speed").alias("wind_speed_ms"), pick("wind_gust").alias("wind_gust_ms"), pick("wind_direction").alias("wind_dir_deg"), pick("precipitation").alias("precip_1h_mm"),
    )
    inside = rows.where((F.col("valid_time") >= F.lit(start).cast("timestamp")) & (F.col("valid_time") <= F.expr(f"TIMESTAMP '{end}' + INTERVAL 1 DAY")))
    return finished(hourly_means(inside, (), ()), "ghcnh")


def snow_telemetry(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Sites with element series: temperature in Fahrenheit, precipitation as a running total in inches."""
    schema = "stationTriplet string, data array<struct<stationElement:struct<elementCode:string>,values:array<struct<date:string,value:double>>>>"
    flat = spark.read.schema(schema).json(path, multiLine=not lines).select("stationTriplet", F.explode("data").alias("d")).select("stationTriplet", F.col("d.stationElement.elementCode").alias("code"), F.explode("d.values").alias("v"))
    known = flat.where("stationTriplet IS NOT NULL AND v.value IS NOT NULL").select(F.col("stationTriplet").alias("station_id"), F.date_trunc("hour", F.to_timestamp("v.date")).alias("valid_time"), "code", F.col("v.value").alias("value"))
    # A reading that several payloads have counts once, the largest: increments run across payloads, since they are taken of a site's whole series.
    wide = known.groupBy("station_id", "valid_time").agg(*[F.max(F.when(F.col("code") == c, F.col("value"))).alias(c) for c in ("TOBS", "PREC")])
    stepped = quality.increments(wide, "PREC", "precip_1h_mm")
    return finished(stepped.select("station_id", "valid_time", fahrenheit(F.col("TOBS")).alias("air_temp_c"), "precip_1h_mm"), "snotel")


def csv_reports(spark: SparkSession, path: str) -> DataFrame:
    """Airport reports in Fahrenheit, knots and inches; M marks a missing value."""
    raw = spark.read.csv(path, header=True, comment="#", schema="station string, valid string, tmpf string, dwpf string, relh string, sknt string, gust string, drct string, p01i string")
    rows = raw.select(
        F.concat(F.lit("IEM:"), "station").alias("station_id"), F.to_timestamp("valid").alias("valid_time"), fahrenheit(number("tmpf")).alias("air_temp_c"), fahrenheit(number("dwpf")).alias("dewpoint_c"), number("relh").alias("relative_humidity_pct"),
        (number("sknt") * C.KNOT).alias("wind_speed_ms"), (number("gust") * C.KNOT).alias("wind_gust_ms"), number("drct").alias("wind_dir_deg"), (number("p01i") * C.INCH).alias("precip_1h_mm"),
    )
    return finished(hourly_means(rows), "iem")


def array_observations(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Payloads with one array per column, one a file or one a line; the first column whose name begins with the stem; means of everything."""
    raw = spark.read.schema("STATION array<struct<STID:string,OBSERVATIONS:map<string,array<string>>>>").json(path, multiLine=not lines).select(F.explode("STATION").alias("s")).select("s.STID", F.col("s.OBSERVATIONS").alias("o"))
    stems = {"air_temp": "air_temp_c", "dew_point_temperature": "dewpoint_c", "relative_humidity": "relative_humidity_pct", "wind_speed": "wind_speed_ms", "wind_gust": "wind_gust_ms", "wind_direction": "wind_dir_deg", "precip_accum_one_hour": "precip_1h_mm"}
    first = lambda stem: F.element_at("o", F.get(F.array_sort(F.filter(F.map_keys("o"), lambda k: k.startswith(stem + "_set"))), F.lit(0)))
    zipped = F.arrays_zip(F.element_at("o", "date_time").alias("t"), *[F.coalesce(first(k), F.array()).alias(v) for k, v in stems.items()])
    rows = raw.select("STID", F.explode(zipped).alias("r")).select(F.concat(F.lit("SYN:"), "STID").alias("station_id"), F.to_timestamp("r.t").alias("valid_time"), *[number(F.col(f"r.{v}")).alias(v) for v in stems.values()])
    return finished(hourly_means(rows, (), ()), "synoptic")


def yearly_csv(spark: SparkSession, path: str, start: str, end: str, station: str = r"([^/]+?)\.csv", prefix: str = "MS:") -> DataFrame:
    """Headerless yearly files, thirteen columns by position, the station in the path (first group of ``station``); km/h; half-open window."""
    raw = spark.read.csv(path, schema="date string, hour int, temp string, dwpt string, rhum string, prcp string, snow string, wdir string, wspd string, wpgt string, pres string, tsun string, coco string").withColumn("file", F.col("_metadata.file_path"))
    when = F.try_to_timestamp(F.concat_ws(" ", "date", F.format_string("%02d:00:00", "hour")))
    rain = number("prcp")
    rows = raw.select(
        F.concat(F.lit(prefix), F.regexp_extract("file", station, 1)).alias("station_id"), when.alias("valid_time"), number("temp").alias("air_temp_c"), number("dwpt").alias("dewpoint_c"), number("rhum").alias("relative_humidity_pct"),
        (number("wspd") * C.KMH).alias("wind_speed_ms"), (number("wpgt") * C.KMH).alias("wind_gust_ms"), number("wdir").alias("wind_dir_deg"), F.when(rain.isNotNull(), F.greatest(rain, F.lit(0.0))).alias("precip_1h_mm"),
    )
    return finished(rows.where((F.col("valid_time") >= F.lit(start).cast("timestamp")) & (F.col("valid_time") < F.lit(end).cast("timestamp"))), "meteostat")


def unpivot_forecasts(payloads: DataFrame, models: tuple[str, ...], variables: dict[str, str], supported: dict[str, set[str]] | None = None, days: tuple[int, ...] = (), keep: tuple[str, ...] = ()) -> DataFrame:
    """(station_id, valid_time, lead_h, model, fc_<variable>...) of payloads (station_id, issued_at, hourly: JSON object of arrays).

    A series is found under ``<name>[_previous_day<n>]_<model>``, else without the model. With ``days`` the lead is 24 hours times the day; otherwise hours since issue. A
    model that has no series at all gives no rows; a variable that a model doesn't carry is null.
    """
    o = F.from_json("hourly", "map<string,array<string>>")
    parsed = payloads.withColumn("o", o)
    out: DataFrame | None = None
    for model in models:
        for day in days or (0,):
            suffix = f"_previous_day{day}" if day else ""
            series = {v: F.coalesce(F.element_at("o", f"{n}{suffix}_{model}"), F.element_at("o", f"{n}{suffix}")) for v, n in variables.items()}
            found = F.coalesce(*series.values()).isNotNull()
            zipped = F.arrays_zip(F.element_at("o", "time").alias("t"), *[F.coalesce(s, F.array()).alias(v) for v, s in series.items()])
            rows = parsed.where(found).select("station_id", "issued_at", F.explode(zipped).alias("r"))
            at = F.to_timestamp("r.t")
            lead = F.lit(24 * day) if day else ((F.unix_timestamp(at) - F.unix_timestamp(F.date_trunc("hour", "issued_at"))) / 3600).cast("int")
            carried = lambda v, model=model: supported is None or v in supported.get(model, set(variables))
            values = [(number(F.col(f"r.{v}")) if carried(v) else F.lit(None).cast("double")).alias(f"fc_{v}") for v in variables]
            part = rows.select("station_id", *keep, at.alias("valid_time"), lead.cast("int").alias("lead_h"), F.lit(model).alias("model"), *values)
            out = part if out is None else out.unionByName(part)
    return out.where("lead_h >= 0").dropna(how="all", subset=[f"fc_{v}" for v in variables])


def historical(payloads: DataFrame, catalogue: DataFrame, models: tuple[str, ...], variables: dict[str, str], lead: int = 3) -> DataFrame:
    """Archived forecasts as issued: a nominal short lead, source ``hist``, and nothing before the day from which a model's archive reaches (``archive_from`` by ``id``)."""
    rows = unpivot_forecasts(payloads, models, variables).withColumns({"lead_h": F.lit(lead), "lead_source": F.lit("hist")})
    return rows.join(catalogue.select(F.col("id").alias("model"), "archive_from"), "model").where("archive_from IS NULL OR to_date(valid_time) >= archive_from").drop("archive_from")


def previous_runs(payloads: DataFrame, models: tuple[str, ...], variables: dict[str, str], days: tuple[int, ...] = (1, 2, 3, 4, 5, 6, 7), past_days: int = 92) -> DataFrame:
    """Forecasts of earlier runs by their age in days, not older than ``past_days`` before the issue."""
    rows = unpivot_forecasts(payloads, models, variables, days=days, keep=("issued_at",))
    recent = F.datediff("issued_at", "valid_time") <= past_days
    return rows.where(recent).drop("issued_at").withColumn("lead_source", F.lit("prev_runs"))


def aligned(batches: DataFrame, manifest: DataFrame) -> DataFrame:
    """The results of batched requests (batch, payload: JSON array) with the station that was asked for at their place (batch, pos, station_id)."""
    each = batches.select("batch", F.posexplode(F.from_json("payload", "array<string>")).alias("pos", "hourly"))
    return each.join(manifest, ["batch", "pos"])
