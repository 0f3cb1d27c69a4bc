"""Late reports: hours as sums that batches are merged into however late they come, and a running bias as keyed state."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratocast import config as C
from stratocast.streaming.pairs import _read

HOURS = "station_id string, valid_time timestamp, tmpc double, n_tmpc long, sknt double, n_sknt long, gust double, p01m double, n long, batch long, day string"
_KEYS = ["station_id", "valid_time", "day"]


def _summed(rows: DataFrame, batch) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("tmpc", "n_tmpc", "sknt", "n_sknt")]
    return rows.groupBy(*_KEYS).agg(*sums, F.max("gust").alias("gust"), F.max("p01m").alias("p01m"), F.sum("n").alias("n"), batch.alias("batch"))


def merge_hours(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that adds reports to the sums of their station hours in a table by day, rewriting only the days that a batch touches.

    Nothing is too late: an hour has no state but its rows in the table, one of the newest batch and one of all before it. A batch that is run again replaces its own
    row, so that it isn't counted twice; table and checkpoint belong together.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        counts = {f"n_{c}": F.col(c).isNotNull().cast("long") for c in ("tmpc", "sknt")}
        at = F.date_trunc("hour", "valid")
        reports = batch.withColumns({**counts, "n": F.lit(1).cast("long"), "valid_time": at, "day": F.coalesce(F.date_format(at, "yyyy-MM-dd"), F.lit("none"))})
        staged = f"{path}.staged/{number}"
        _summed(reports, F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{staged}/batch")
        new = _read(spark, f"{staged}/batch", HOURS)
        days = [r[0] for r in new.select("day").distinct().collect()]  # of one micro-batch
        if not days:
            return
        old = _read(spark, path, HOURS).where(F.col("day").isin(days) & (F.col("batch") < number))
        _summed(old, F.max("batch")).unionByName(new).write.mode("overwrite").partitionBy("day").parquet(f"{staged}/days")  # the days are read to the end before they are replaced
        _read(spark, f"{staged}/days", HOURS).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(path)

    return merge


def hours(spark: SparkSession, path: str) -> DataFrame:
    """Station hours as all batches so far have left them."""
    h = _summed(_read(spark, path, HOURS), F.max("batch"))
    mean = lambda c: F.when(F.col(f"n_{c}") > 0, F.col(c) / F.col(f"n_{c}"))
    return h.select("station_id", "valid_time", mean("tmpc").alias("air_temp_c"), (mean("sknt") * C.KNOT).alias("wind_speed_ms"), (F.col("gust") * C.KNOT).alias("wind_gust_ms"), F.col("p01m").alias("precip_1h_mm"), "n")


def running_bias(errors: DataFrame, w: float = C.DECAY) -> DataFrame:
    """A stream of (cell, at, error) to the decayed bias of each cell after every batch; rows of a batch count in the order of ``at``."""

    def update(key: tuple, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        value, n = state.get if state.exists else (None, 0)
        rows = pd.concat(list(frames)).sort_values("at", kind="stable")
        for e in rows["error"]:
            value = float(e) if n == 0 else (1 - w) * value + w * float(e)
            n += 1
        state.update((value, n))
        yield pd.DataFrame({"cell": [key[0]], "bias": [value], "n": [n]})

    return errors.groupBy("cell").applyInPandasWithState(update, "cell string, bias double, n long", "bias double, n long", "update", "NoTimeout")
