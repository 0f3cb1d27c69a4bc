"""Calibration of stations without an archive, from the last week alone: a distribution from 72 hours on, a bias from 24, else nothing."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratocast import config as C
from stratocast.functions.scores import clamped
from stratocast.operators import fits

# Fixed values of the cold start.
WEEK_DAYS, BIAS_ROWS, EMOS_ROWS = 7, 24, 72


def recent(wide: DataFrame, by: list[str]) -> DataFrame:
    """Rows with a forecast and an observation of the last week before a group's newest, with ``n``, how many there are."""
    known = wide.where("obs IS NOT NULL AND fc_mean IS NOT NULL")
    newest = F.max(F.unix_timestamp("valid_time")).over(W.partitionBy(*by))
    week = known.withColumn("__age", newest - F.unix_timestamp("valid_time")).where(F.col("__age") <= WEEK_DAYS * 86400).drop("__age")
    return week.withColumn("n", F.count("*").over(W.partitionBy(*by)))


def fit(week: DataFrame, by: list[str]) -> DataFrame:
    """(by, branch, n, a, b, c, d, bias, resid): a distribution over mean and spread where a group has rows enough and the fit is finite, else the mean error with its residuals by nearest rank.

    A group is one week of one station, which bounds what a task takes.
    """
    types = ", ".join(f"{k} {t}" for k, t in week.select(*by).dtypes)

    def emos(keys: tuple, group: pd.DataFrame) -> pd.DataFrame:
        x, y = group["fc_mean"].to_numpy()[:, None], group["obs"].to_numpy()
        try:
            theta, _ = fits.minimum_crps(x, group["fc_spread"].fillna(0).to_numpy(), y, np.ones(len(y)), False)
        except np.linalg.LinAlgError:
            theta = np.full(4, np.nan)
        good = bool(np.isfinite(theta).all())
        values = dict(zip("abcd", theta if good else [None] * 4, strict=True))
        return pd.DataFrame([dict(zip(by, keys, strict=True)) | values])

    large = week.where(F.col("n") >= EMOS_ROWS).select(*by, "fc_mean", "fc_spread", "obs")
    fitted = large.groupBy(*by).applyInPandas(emos, f"{types}, a double, b double, c double, d double")
    with_bias = week.where(F.col("n") >= BIAS_ROWS).withColumn("bias", F.avg(F.col("fc_mean") - F.col("obs")).over(W.partitionBy(*by)))
    sums = with_bias.groupBy(*by, "n").agg(F.first("bias").alias("bias"), F.array_sort(F.collect_list(F.col("obs") - (F.col("fc_mean") - F.col("bias")))).alias("sorted"))
    rank = lambda q: (F.floor(q * (F.col("n") - 1) + 0.5) + 1).cast("int")
    sums = sums.withColumn("resid", F.array(*[F.element_at("sorted", rank(q)) for q in C.LEVELS])).drop("sorted")
    out = sums.join(fitted, by, "left")
    return out.select(*by, F.when(F.col("a").isNotNull(), "emos").otherwise("bias").alias("branch"), "n", "a", "b", "c", "d", "bias", "resid")


def predict(live: DataFrame, table: DataFrame, by: list[str], low: float | None = None, high: float | None = None) -> DataFrame:
    """``live`` with q05..q95 within the bounds and in order, and ``branch``; rows of groups that couldn't be calibrated drop out."""
    out = live.where("fc_mean IS NOT NULL").join(table, by)
    mu = F.col("a") + F.col("b") * F.col("fc_mean")
    sigma = F.exp(F.greatest(F.lit(-8.0), F.least(F.lit(8.0), F.col("c") + F.col("d") * F.coalesce("fc_spread", F.lit(0.0)))))
    of_bias = lambda i: F.col("fc_mean") - F.col("bias") + F.col("resid")[i]
    values = [F.when(F.col("branch") == "emos", mu + sigma * z).otherwise(of_bias(i)) for i, z in enumerate(C.NORMAL_LEVELS)]
    return out.withColumns(dict(zip(C.QUANTILES, clamped(values, low, high), strict=True))).drop("a", "b", "c", "d", "bias", "resid")
