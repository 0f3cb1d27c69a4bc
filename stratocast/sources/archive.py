"""The archive of observations: year-partitioned scans, stored history, and the union of several networks under one id."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratocast import config as C
from stratocast.operators import quality

COLUMNS = ("station", "valid", "tmpc", "dwpc", "relh", "sknt", "gust", "drct", "p01m")
#: Of two sources that report an hour, the first listed is believed: the global hourly files, then the weather service, then the station's own network.
SOURCES = ("ghcnh", "nws", "iem", "asos", "synoptic", "snotel", "meteostat")


def scan(spark: SparkSession, path: str, wanted: DataFrame, start: str, end: str, through: bool = False, merge: bool = False) -> DataFrame:
    """Nine columns of the stations in ``wanted`` (station_id with its network) from ``start`` up to ``end``, that day left out unless ``through``.

    Year folders outside the window aren't listed, the window is pushed to the files, and the stations are a semi-join, however many there are.
    """
    until = F.lit(f"{end} 23:59:59" if through else end).cast("timestamp")
    rows = spark.read.option("mergeSchema", merge).parquet(path)
    rows = rows.where(F.col("year").between(int(start[:4]), int(end[:4])) & (F.col("valid") >= F.lit(start).cast("timestamp")) & (F.col("valid") < until)).select(*COLUMNS)
    return rows.join(wanted.select(F.element_at(F.split("station_id", ":", 2), -1).alias("station")).distinct(), "station", "left_semi")


def hourly_mean_direction(rows: DataFrame) -> DataFrame:
    """Hours of archived reports with the mean of the direction instead of its median."""
    named = rows.withColumn("station_id", F.concat(F.lit("ASOS:"), "station"))
    mean = named.groupBy("station_id", F.date_trunc("hour", "valid").alias("valid_time")).agg(
        F.avg("tmpc").alias("air_temp_c"), F.avg("dwpc").alias("dewpoint_c"), F.avg("relh").alias("relative_humidity_pct"), (F.avg("sknt") * C.KNOT).alias("wind_speed_ms"),
        (F.max("gust") * C.KNOT).alias("wind_gust_ms"), F.avg("drct").alias("wind_dir_deg"), F.max("p01m").alias("precip_1h_mm"),
    )
    return mean.withColumn("source", F.lit("ASOS"))


def merge_history(spark: SparkSession, path: str, new: DataFrame, schema: str, order: str = "seq") -> None:
    """Put ``new`` over the stored history, the newest row per station and hour; months that it doesn't touch stay as they are."""
    new = new.withColumn("month", F.date_format("valid_time", "yyyy-MM"))
    months = new.select("month").distinct()
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    rows = new
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        rows = spark.read.schema(schema).parquet(path).join(F.broadcast(months), "month", "left_semi").select(new.columns).unionByName(new)  # a row per month
    kept = quality.newest_per_hour(rows, [F.col(order)])
    staged = f"{path}.staged"
    kept.write.mode("overwrite").partitionBy("month").parquet(staged)  # the months are read to the end before they are replaced
    spark.read.schema(schema).parquet(staged).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(path)


def gather(parts: dict[str, DataFrame], table: DataFrame) -> DataFrame:
    """Observations of several sources under the ids of ``table`` (id, nws_id, ghcnh_id): one row per station and hour, of the best-ranked source."""
    known = table.select(F.col("id").alias("own"), F.explode(F.array_compact(F.array("id", F.concat(F.lit("NWS:"), "nws_id"), F.concat(F.lit("GHCNH:"), "ghcnh_id")))).alias("alias")).distinct()
    out: DataFrame | None = None
    for source, frame in parts.items():
        part = frame.withColumn("source", F.lit(source))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    named = out.join(known, out["station_id"] == known["alias"]).withColumn("station_id", F.col("own")).drop("own", "alias")
    rank = F.array_position(F.array(*[F.lit(s) for s in SOURCES]), F.col("source"))
    hour = named.withColumn("valid_time", F.date_trunc("hour", "valid_time"))
    return hour.withColumn("__r", F.row_number().over(W.partitionBy("station_id", "valid_time").orderBy(rank))).where("__r = 1").drop("__r")
