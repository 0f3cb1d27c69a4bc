"""What the fits of a bucket need: weights, trimmed rows, harmonics, imputed designs, normal equations, nearest buckets."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratocast import config as C
from stratocast.operators.bias import newest


def with_tau(rows: DataFrame, by: list[str]) -> DataFrame:
    """Decay time of each group, by its median lead, and the age in days before the newest row of all its buckets."""
    every = [k for k in by if k != "bucket"]
    tau = F.when(F.median("lead_h").over(W.partitionBy(*by)) <= C.TAU_LEAD, C.TAU_SHORT).otherwise(C.TAU_LONG)
    newest_of = F.max("valid_time").over(W.partitionBy(*every)) if every else F.max("valid_time").over(W.partitionBy(*by))
    age = (F.unix_timestamp(newest_of) - F.unix_timestamp("valid_time")) / 86400.0
    return rows.withColumn("tau", tau).withColumn("age", age).withColumn("weight", F.exp(-F.greatest("age", F.lit(0.0)) / F.col("tau")))


def trimmed(rows: DataFrame, by: list[str], taus: float = C.CUTOFF_TAUS, most: int = C.MAX_ROWS, least: int = C.MIN_BUCKET) -> DataFrame:
    """Rows young enough to carry weight, or all where fewer than ``least`` are; then the newest ``most``."""
    group = W.partitionBy(*by)
    young = F.col("age") <= taus * F.col("tau")
    kept = rows.withColumn("__young", F.count(F.when(young, 1)).over(group)).where(young | (F.col("__young") < least))
    return kept.withColumn("__r", F.row_number().over(group.orderBy(*newest()))).where(F.col("__r") <= most).drop("__r", "__young")


def harmonics(when: str, yearly: int = 2, daily: int = 2) -> list[Column]:
    """Sines and cosines of the day of the year, then of the hour."""
    out = []
    for n in range(1, yearly + 1):
        x = F.dayofyear(when) * (2 * math.pi * n / 365.25)
        out += [F.sin(x), F.cos(x)]
    for n in range(1, daily + 1):
        x = F.hour(when) * (2 * math.pi * n / 24.0)
        out += [F.sin(x), F.cos(x)]
    return out


def imputed(columns: list[str], mean: str = "fc_mean") -> list[Column]:
    return [F.coalesce(c, mean) for c in columns]


def weighted_line(rows: DataFrame, by: list[str], x: str, y: str, w: str) -> DataFrame:
    """Intercept and slope of a weighted regression, by sums alone."""
    s = rows.groupBy(*by).agg(*[F.sum(e).alias(n) for n, e in (("sw", F.col(w)), ("sx", F.col(w) * F.col(x)), ("sy", F.col(w) * F.col(y)), ("sxx", F.col(w) * F.col(x) * F.col(x)), ("sxy", F.col(w) * F.col(x) * F.col(y)))], F.count("*").alias("n"))
    slope = (F.col("sw") * F.col("sxy") - F.col("sx") * F.col("sy")) / (F.col("sw") * F.col("sxx") - F.col("sx") * F.col("sx"))
    return s.withColumn("slope", slope).withColumn("intercept", (F.col("sy") - F.col("slope") * F.col("sx")) / F.col("sw"))


def nearest_bucket(fitted: DataFrame, by: list[str]) -> DataFrame:
    """For each group and every bucket the fitted one that is nearest by lower bound; of equally near ones the lower."""
    spark = fitted.sparkSession
    buckets = spark.createDataFrame([(f"{a}-{b}", a) for a, b in C.LEAD_BUCKETS], "bucket string, low int")
    own = fitted.join(F.broadcast(buckets.withColumnsRenamed({"bucket": "fitted_bucket", "low": "fitted_low"})), "fitted_bucket")
    wanted = own.select(*by).distinct().withColumn("b", F.explode(F.array(*[F.struct(F.lit(f"{a}-{b}").alias("bucket"), F.lit(a).alias("low")) for a, b in C.LEAD_BUCKETS]))).select(*by, "b.*")
    near = W.partitionBy(*by, "bucket").orderBy(F.abs(F.col("low") - F.col("fitted_low")), "fitted_low")
    return wanted.join(own, by).withColumn("__r", F.row_number().over(near)).where("__r = 1").drop("__r", "low", "fitted_low")
