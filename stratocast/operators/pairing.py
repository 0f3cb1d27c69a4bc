"""Forecasts and observations: pairs, upsert, training matrix, lead buckets.

Keys are (station_id, valid_time, lead_h, lead_source[, model]); "last" is always by ``ingest_seq``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratocast.config import bucket_label
from stratocast.fixtures import MODELS

KEY = ("station_id", "valid_time", "lead_h", "lead_source")


def build_pairs(forecasts: DataFrame, obs: DataFrame) -> DataFrame:
    """Forecasts with the newest observation of their hour; hours without any observation drop out."""
    newest = obs.where(F.col("obs").isNotNull()).groupBy("station_id", "valid_time").agg(F.max_by("obs", "ingest_seq").alias("obs"))
    return forecasts.withColumn("valid_time", F.date_trunc("hour", "valid_time")).join(newest, ["station_id", "valid_time"])


def upsert(archive: DataFrame, new: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    """One version per key (with ``more``, such as the variable) and model, the newest."""
    both = archive.unionByName(new)
    return both.withColumn("__r", F.row_number().over(W.partitionBy(*KEY, *more, "model").orderBy(F.desc("ingest_seq")))).where("__r = 1").drop("__r")


def row_mean(columns: list[Column]) -> Column:
    present = F.filter(F.array(*columns), lambda x: x.isNotNull())
    return F.when(F.size(present) > 0, F.aggregate(present, F.lit(0.0), lambda a, x: a + x) / F.size(present))


def row_spread(columns: list[Column]) -> Column:
    """Population deviation over the models that are there; 0 for one."""
    present = F.filter(F.array(*columns), lambda x: x.isNotNull())
    mean = row_mean(columns)
    return F.when(F.size(present) > 0, F.sqrt(F.aggregate(F.transform(present, lambda x: (x - mean) * (x - mean)), F.lit(0.0), lambda a, x: a + x) / F.size(present)))


def wide(pairs: DataFrame, models: tuple[str, ...] = MODELS, more: tuple[str, ...] = ()) -> DataFrame:
    """One row per key (with ``more``, such as the variable): each model's newest forecast, the newest observation, mean and spread. One shuffle on the key does it all."""
    known = pairs.where(F.col("fc").isNotNull())
    cells = [F.max_by(F.when(F.col("model") == m, F.col("fc")), F.when(F.col("model") == m, F.col("ingest_seq"))).alias(f"fc_{m}") for m in models]
    out = known.groupBy(*KEY, *more).agg(*cells, F.max_by("obs", "ingest_seq").alias("obs"), F.max("ingest_seq").alias("ingest_seq"))
    columns = [F.col(f"fc_{m}") for m in models]
    return out.withColumns({"fc_mean": row_mean(columns), "fc_spread": row_spread(columns)})


def with_bucket(frame: DataFrame) -> DataFrame:
    return frame.withColumn("bucket", bucket_label(F.col("lead_h")))
