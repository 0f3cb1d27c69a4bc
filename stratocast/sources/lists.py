"""Station lists of four networks, from landed JSON documents to rows of the catalogue.

Every reader takes documents as text in column ``payload`` (``spark.read.text(path, wholetext=True)`` gives such) and explodes them; none is held whole on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratocast import config as C
from stratocast.operators import stations

CATALOGUE = ("id", "name", "lat", "lon", "elev_m", "network", "country", "iem_network", "nws_id", "ghcnh_id")
_POINT = "geometry:struct<coordinates:array<double>>"


def _row(network: str, station: Column, name: Column, lat: Column, lon: Column, elevation: Column, country: Column, **ids: Column) -> list[Column]:
    none = F.lit(None).cast("string")
    own = [F.concat(F.lit(f"{network}:"), station) if network else station, F.coalesce(name, station), lat, lon, elevation, F.lit(network or "SNOTEL"), country]
    return [c.alias(n) for c, n in zip([*own, *[ids.get(k, none) for k in CATALOGUE[7:]]], CATALOGUE, strict=True)]


def weather_service(payloads: DataFrame) -> DataFrame:
    """Pages of features; those without a position or an identifier are left out."""
    schema = f"features array<struct<properties:struct<stationIdentifier:string,name:string,elevation:struct<value:double>>,{_POINT}>>"
    f = payloads.select(F.explode(F.from_json("payload", schema)["features"]).alias("f")).select("f.properties.*", F.col("f.geometry.coordinates").alias("at"))
    f = f.where((F.size("at") >= 2) & F.col("stationIdentifier").isNotNull())
    s = F.col("stationIdentifier")
    return f.select(*_row("NWS", s, F.col("name"), F.col("at")[1], F.col("at")[0], F.col("elevation.value"), F.lit("US"), nws_id=s))


def airports(payloads: DataFrame) -> DataFrame:
    """One document per network (columns ``network``, ``payload``); stations that are offline or whose archive has ended are left out."""
    properties = "sid:string,sname:string,online:boolean,archive_end:string,elevation:double,country:string,attributes:struct<GHCNH_ID:string>"
    schema = f"features array<struct<id:string,properties:struct<{properties}>,{_POINT}>>"
    f = payloads.select(F.col("network").alias("code"), F.explode(F.from_json("payload", schema)["features"]).alias("f"))
    f = f.select("code", F.coalesce("f.properties.sid", "f.id").alias("s"), "f.properties.*", F.col("f.geometry.coordinates").alias("at"))
    f = f.where((F.size("at") >= 2) & F.col("s").isNotNull() & F.coalesce("online", F.lit(True)) & (F.coalesce("archive_end", F.lit("")) == ""))
    service = F.when((F.length("s") == 3) & (F.col("country") == "US"), F.concat(F.lit("K"), "s"))
    country = F.coalesce("country", F.when(~F.col("code").startswith("_"), F.substring("code", 1, 2)))
    ghcnh = F.when(F.col("attributes.GHCNH_ID") != "", F.col("attributes.GHCNH_ID"))
    return f.select(*_row("IEM", F.col("s"), F.col("sname"), F.col("at")[1], F.col("at")[0], F.col("elevation"), country, iem_network=F.col("code"), nws_id=service, ghcnh_id=ghcnh))


def long_tail(payloads: DataFrame) -> DataFrame:
    """Arrays of stations whose names are by language: English first, else the first there is, else the id."""
    schema = "array<struct<id:string,name:map<string,string>,country:string,location:struct<latitude:double,longitude:double,elevation:double>,identifiers:struct<national:string>>>"
    s = payloads.select(F.explode(F.from_json("payload", schema)).alias("s")).select("s.*").where("id IS NOT NULL AND location.latitude IS NOT NULL")
    name = F.coalesce(F.element_at("name", "en"), F.get(F.map_values("name"), F.lit(0)))
    return s.select(*_row("MS", F.col("id"), name, F.col("location.latitude"), F.col("location.longitude"), F.col("location.elevation"), F.col("country"), ghcnh_id=F.when(F.col("identifiers.national") != "", F.col("identifiers.national"))))


def snow_sites(payloads: DataFrame) -> DataFrame:
    """Arrays of sites; only triplets of the network; heights in feet; with ``state``."""
    schema = "array<struct<stationTriplet:string,name:string,latitude:double,longitude:double,elevation:double>>"
    s = payloads.select(F.explode(F.from_json("payload", schema)).alias("s")).select("s.*").where("contains(stationTriplet, ':SNTL') AND latitude IS NOT NULL AND longitude IS NOT NULL")
    t = F.col("stationTriplet")
    return s.select(*_row("", t, F.col("name"), F.col("latitude"), F.col("longitude"), F.col("elevation") * C.FOOT, F.lit("US")), F.split(t, ":")[1].alias("state"))


def build(parts: list[DataFrame], reporting_only: bool = True) -> DataFrame:
    """The catalogue of several lists: their union, what reports, one row per position."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    out = out.where("lat IS NOT NULL AND lon IS NOT NULL")
    return stations.deduplicate(stations.reports(out) if reporting_only else out)


def _number(c: Column, digits: int) -> Column:
    """The JSON text of a rounded number: plain below 1e21, with the sign of what is rounded to zero."""
    r = F.round(c, digits)
    r = F.when(r == 0, F.signum(c) * 0.0).otherwise(r)
    plain = F.regexp_replace(r.cast(f"decimal(38,{digits})").cast("string"), r"(\.\d+?)0+$", "$1")
    return F.when((F.abs(r) >= 1e7) & (F.abs(r) < 1e21), plain).otherwise(F.regexp_replace(r.cast("string"), r"(\.0)?E", "e"))


def compact_rows(catalogue: DataFrame) -> DataFrame:
    """(id, row): each station as a JSON array in the order of ``CATALOGUE``, for a search box."""
    rounded = {"lat": 4, "lon": 4, "elev_m": 1}
    text = lambda c: F.regexp_replace(F.to_json(F.array(F.col(c))), r"^\[|\]$", "")
    one = lambda c: F.coalesce(_number(F.col(c), rounded[c]), F.lit("null")) if c in rounded else text(c)
    return catalogue.select("id", F.concat(F.lit("["), F.concat_ws(",", *[one(c) for c in CATALOGUE]), F.lit("]")).alias("row"))
