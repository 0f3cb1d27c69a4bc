"""Late observations to pairs: each batch joins again the months and parts of the fleet that it touches, and no other.

Observations, forecasts and pairs lie in folders by month and by a hash of the station, so a batch of late, revised or withdrawn reports names the folders to be read and written. A withdrawn
report is one without a value; the hour then has no pair. Folders of pairs keep forecasts without an observation, so that a folder whose last pair has gone is written too; ``pairs`` leaves
them out. A batch that is run again gives the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Parts of the fleet.
PARTS = 8
PLACE = ["month", "part"]


def placed(rows: DataFrame) -> DataFrame:
    """Rows (station_id, valid_time, ...) with the folder that they belong to."""
    return rows.withColumn("month", F.date_format("valid_time", "yyyy-MM")).withColumn("part", F.pmod(F.xxhash64("station_id"), F.lit(PARTS)).cast("int"))


def write_placed(rows: DataFrame, path: str) -> None:
    """Replace the folders that ``rows`` (with their place) touch."""
    rows.repartition(*PLACE).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*PLACE).parquet(path)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


OBS = "station_id string, valid_time timestamp, obs double, seq long, month string, part int"


def repairing(base: str, forecasts: str, forecast_schema: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function: a batch of reports (station_id, valid_time, obs, seq) goes over ``base``/observations, the newest of an hour by ``seq``, and the touched folders of ``base``/pairs are joined again with ``forecasts``."""

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        new = placed(batch.select("station_id", F.date_trunc("hour", "valid_time").alias("valid_time"), F.col("obs").cast("double").alias("obs"), F.col("seq").cast("long").alias("seq")))
        staged = f"{base}/staged/{number}"
        new.write.mode("overwrite").parquet(f"{staged}/batch")
        new = spark.read.schema(OBS).parquet(f"{staged}/batch")
        if new.isEmpty():
            return
        touched = new.select(*PLACE).distinct()  # of one batch; the folders that match are the only ones that are read
        old = _read(spark, f"{base}/observations", OBS).join(F.broadcast(touched), PLACE, "left_semi")
        order = W.partitionBy("station_id", "valid_time").orderBy(F.desc("seq"), F.desc_nulls_last("obs"))
        merged = old.unionByName(new).withColumn("__r", F.row_number().over(order)).where("__r = 1").drop("__r")
        merged.write.mode("overwrite").parquet(f"{staged}/observations")  # folders are read to the end before they are replaced
        merged = spark.read.schema(OBS).parquet(f"{staged}/observations")
        write_placed(merged, f"{base}/observations")
        asked = _read(spark, forecasts, f"{forecast_schema}, month string, part int").join(F.broadcast(touched), PLACE, "left_semi")
        pairs_ = asked.join(merged.select("station_id", "valid_time", "obs", "seq", *PLACE), ["station_id", "valid_time", *PLACE], "left")
        write_placed(pairs_, f"{base}/pairs")

    return merge


def pairs(spark: SparkSession, base: str, forecast_schema: str) -> DataFrame:
    """Forecasts with the observation of their hour, as all batches so far have left them."""
    return _read(spark, f"{base}/pairs", f"{forecast_schema}, obs double, seq long, month string, part int").where("obs IS NOT NULL")


def landing(base: str, schema: str, rules: dict[str, str]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for landed lines of text (``value``): JSON objects of ``schema`` go to ``base``/archive; lines that break one of ``rules`` (reason to SQL condition, the first that holds) to ``base``/rejected with the reason.

    Each batch has a folder of its own in both tables and is written over it, so a batch that is run again isn't doubled.
    """

    def land(batch: DataFrame, number: int) -> None:
        parsed = batch.select("value", F.from_json("value", schema, {"mode": "PERMISSIVE"}).alias("r")).select("value", "r.*")
        reason = F.lit(None).cast("string")
        for name, rule in reversed(rules.items()):
            reason = F.when(F.expr(rule), name).otherwise(reason)
        judged = parsed.withColumn("reason", reason)
        judged.where("reason IS NULL").drop("value", "reason").write.mode("overwrite").parquet(f"{base}/archive/batch={number}")
        judged.where("reason IS NOT NULL").select("value", "reason").write.mode("overwrite").parquet(f"{base}/rejected/batch={number}")

    return land
