"""Station catalogue, registry and enrollment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratocast import config as C


def network_of(station: Column) -> Column:
    """Network from the trailing or the leading part of an id; a bare id is a snow-telemetry site."""
    parts = F.split(station, ":")
    last, head = F.element_at(parts, -1), parts[0]
    return F.when(F.size(parts) < 2, "SNOTEL").when(last.isin(*C.SNOTEL_SUFFIXES), "SNOTEL").otherwise(head)


def stable_bucket(station: Column, of: int) -> Column:
    """The first four bytes of the id's md5, big-endian, modulo ``of``."""
    return (F.conv(F.substring(F.md5(station), 1, 8), 16, 10).cast("long") % of).cast("int")


def safe_id(station: Column) -> Column:
    return F.translate(station, ":/ ", "___")


def rank_of_network(station: Column) -> Column:
    head = F.split(station, ":")[0]
    return F.when(head == "NWS", 0).when(head == "IEM", 1).when(head == "MS", 2).otherwise(9)


def deduplicate(catalogue: DataFrame, digits: int = 3) -> DataFrame:
    """One station per rounded position, of the best-ranked network; identifiers come from the best-ranked duplicate that has one."""
    place = ["__lat", "__lon"]
    order = W.partitionBy(*place).orderBy("__rank", "id")
    whole = order.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    out = catalogue.withColumn("__lat", F.round("lat", digits)).withColumn("__lon", F.round("lon", digits)).withColumn("__rank", rank_of_network(F.col("id")))
    carried = {c: F.first(c, ignorenulls=True).over(whole) for c in ("nws_id", "iem_network", "ghcnh_id")}
    return out.withColumns({**carried, "__r": F.row_number().over(order)}).where("__r = 1").drop("__r", "__rank", *place)


def reports(catalogue: DataFrame) -> DataFrame:
    """Stations whose id in the weather service's scheme is that of a reporting one; other networks always report."""
    of_service = F.split("id", ":")[0] == "NWS"
    return catalogue.where(~of_service | F.coalesce(F.col("nws_id").rlike("^[KPT][A-Z0-9]{3}$"), F.lit(False)))


def in_box(frame: DataFrame, south: float, north: float, west: float, east: float) -> DataFrame:
    return frame.where(F.col("lat").between(south, north) & F.col("lon").between(west, east))


def shown(found: DataFrame, most: int = 600) -> DataFrame:
    """The stations that a map shows of those in its box, the first ``most`` by id, and how many there are in all (``total``)."""
    return found.orderBy("id").limit(most).crossJoin(F.broadcast(found.agg(F.count("*").alias("total"))))  # one row


def universe(frame: DataFrame, least_elevation: float, excluded: tuple[str, ...]) -> DataFrame:
    return frame.where((F.coalesce("elev_m", F.lit(-1.0)) >= least_elevation) & ~F.coalesce(F.col("country").isin(*excluded), F.lit(False)))


def default_models(frame: DataFrame) -> DataFrame:
    """The regional model only within its box."""
    south, north, west, east = C.CONUS
    inside = F.col("lat").between(south, north) & F.col("lon").between(west, east)
    return frame.withColumn("models", F.when(inside, F.array(*[F.lit(m) for m in (*C.WORLD_MODELS, C.REGIONAL_MODEL)])).otherwise(F.array(*[F.lit(m) for m in C.WORLD_MODELS])))


def resolved_models(frame: DataFrame) -> DataFrame:
    """``models`` as given where there are any, else the default set of the place."""
    given = frame.withColumnRenamed("models", "__given")
    return default_models(given).withColumn("models", F.when(F.size("__given") > 0, F.col("__given")).otherwise(F.col("models"))).drop("__given")


def of_networks(frame: DataFrame, names: str) -> DataFrame:
    """Stations of the networks listed (comma-separated, any case); of all where none is."""
    wanted = [n.strip().upper() for n in names.split(",") if n.strip()]
    return frame.where(network_of(F.col("id")).isin(*wanted)) if wanted else frame


def public(frame: DataFrame) -> DataFrame:
    """What is published of a station: places to four digits."""
    return frame.select("id", "name", F.round("lat", 4).alias("lat"), F.round("lon", 4).alias("lon"), "elev_m", "country", network_of(F.col("id")).alias("network"))


def upsert(registry: DataFrame, fresh: DataFrame) -> DataFrame:
    """``fresh`` in place of the entries with the same ids; new ids are added."""
    return fresh.unionByName(registry.join(fresh.select("id"), "id", "left_anti"))


def model_table(spark) -> DataFrame:
    """(id, label, center, resolution_km, vars, archive_from, prev_runs_from, global) of the forecast models."""
    gusts = F.array(*[F.lit(v) for v in C.VARIABLES])
    rows = spark.createDataFrame(list(C.FORECAST_MODELS), "id string, label string, center string, resolution_km int, calm boolean, archive_from string, prev_runs_from string, global boolean")
    dates = {c: F.col(c).cast("date") for c in ("archive_from", "prev_runs_from")}
    return rows.withColumns({**dates, "vars": F.when(F.col("calm"), F.array_remove(gusts, "wind_gust_ms")).otherwise(gusts)}).drop("calm")


def gate_models(rows: DataFrame, models: DataFrame, variable: str, value: str = "fc") -> DataFrame:
    """``rows`` (model, ...) with ``value`` null where the model doesn't carry ``variable``; models that the table lacks carry all."""
    carried = models.select(F.col("id").alias("model"), F.array_contains("vars", variable).alias("__carried"))
    return rows.join(carried, "model", "left").withColumn(value, F.when(F.coalesce("__carried", F.lit(True)), F.col(value))).drop("__carried")


def search(frame: DataFrame, words: str, most: int) -> DataFrame:
    """Stations whose name and id contain every word; the first ``most`` by id."""
    hay = F.lower(F.concat_ws(" ", "name", "id"))
    wanted = [w for w in words.lower().split(" ") if w]
    found = frame
    for w in wanted:
        found = found.where(F.contains(hay, F.lit(w)))
    return found.orderBy("id").limit(most)


def problems(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """``candidates`` with the list of what is wrong with each."""
    south, north, west, east = C.CONUS
    head = F.split("id", ":")[0]
    outside = ~(F.col("lat").between(south, north) & F.col("lon").between(west, east))
    checks = [
        F.when(~F.coalesce(F.col("id").rlike("^[A-Z]+:[A-Za-z0-9:]+$"), F.lit(False)), "id"),
        F.when(F.coalesce(F.length(F.trim("name")), F.lit(0)) == 0, "name"),
        F.when(~F.coalesce(F.col("lat").between(-90, 90), F.lit(False)), "lat"),
        F.when(~F.coalesce(F.col("lon").between(-180, 180), F.lit(False)), "lon"),
        F.when(F.col("elev_m").isNotNull() & ~F.col("elev_m").between(-500, 9000), "elevation"),
        F.when((head == "IEM") & F.col("iem_network").isNull(), "network"),
        F.when(F.size(F.array_except("models", F.array(*[F.lit(m[0]) for m in C.FORECAST_MODELS]))) > 0, "unknown model"),
        F.when(F.size(F.array_except("variables", F.array(*[F.lit(v) for v in C.VARIABLES]))) > 0, "unknown variable"),
        F.when(F.exists("models", lambda m: m.isin(*[m[0] for m in C.FORECAST_MODELS if not m[-1]])) & outside, "regional model"),
        F.when(F.col("enrolled"), "enrolled"),
    ]
    marked = candidates.join(known.select("id", F.lit(True).alias("enrolled")), "id", "left")
    return marked.withColumn("errors", F.array_compact(F.array(*checks))).drop("enrolled")


def overlay(baseline: DataFrame, fresh: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """Fresh entries (the first per id) over those of the last index. An empty result is refused where ``registry`` has stations."""
    first = fresh.withColumn("__r", F.row_number().over(W.partitionBy("id").orderBy("seq"))).where("__r = 1").drop("__r")
    out = first.unionByName(baseline.join(first.select("id"), "id", "left_anti"))
    if registry is not None and registry.take(1) and not out.take(1):
        raise ValueError("the index would be empty although stations are registered")
    return out


def state(skill: Column, beats: Column, status: Column) -> Column:
    """No measurement yet and a measured loss are different things; a gain is one only where the whole interval lies above zero."""
    return F.when(F.coalesce(status, F.lit("")) != "ok", "unavailable").when(skill.isNull(), "warming").when(F.coalesce(beats, F.lit(False)), "beats").when(skill > 0, "inconclusive").otherwise("worse")


def skill_class(status: Column, beats: Column, skill: Column) -> Column:
    return F.when(F.coalesce(status, F.lit("")) != "verified", "mute").when(F.coalesce(beats, F.lit(False)), "good").when(skill > 0, "warn").otherwise("bad")


def verdict(status: Column, beats: Column, skill: Column) -> Column:
    """What the enrollment report says of a variable."""
    return F.when(F.coalesce(status, F.lit("")) != "verified", "still warming up").when(F.coalesce(beats, F.lit(False)), "beats it").when(F.coalesce(skill, F.lit(0.0)) > 0, "better, not conclusively").otherwise("no measurable gain")


def by_skill(entries: DataFrame, most: int = 60) -> DataFrame:
    """The ``most`` stations with the largest measured skill; those without a measure come last."""
    return entries.orderBy(F.desc_nulls_last("skill"), "id").limit(most)


def opened_first(entries: DataFrame) -> DataFrame:
    """The station to show first: of those in order the best measured, else the first."""
    return entries.where("status = 'ok'").orderBy(F.desc_nulls_last("skill"), "id").limit(1)
