"""Hourly observations and their quality control.

All rules work on whole stations at once: a station's rows are one window partition, whose length is bounded by its hours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratocast import config as C

MEASURES = ("air_temp_c", "dewpoint_c", "relative_humidity_pct", "wind_speed_ms", "wind_gust_ms", "wind_dir_deg", "precip_1h_mm")


def in_time() -> W:
    return W.partitionBy("station_id").orderBy("valid_time")


def hourly(reports: DataFrame) -> DataFrame:
    """Sub-hourly reports in knots to one row per station and hour: means, largest gust and precipitation, median direction."""
    return (
        reports.groupBy("station_id", F.date_trunc("hour", "valid").alias("valid_time"))
        .agg(
            F.avg("tmpc").alias("air_temp_c"),
            F.avg("dwpc").alias("dewpoint_c"),
            F.avg("relh").alias("relative_humidity_pct"),
            (F.avg("sknt") * C.KNOT).alias("wind_speed_ms"),
            (F.max("gust") * C.KNOT).alias("wind_gust_ms"),
            F.median("drct").alias("wind_dir_deg"),
            F.max("p01m").alias("precip_1h_mm"),
        )
    )


def first_report(reports: DataFrame) -> DataFrame:
    """The first report of each hour instead of a mean."""
    row = F.struct("valid", "event_id", "tmpc", "sknt", "relh")
    first = reports.groupBy("station_id", F.date_trunc("hour", "valid").alias("valid_time")).agg(F.min(row).alias("r"))
    return first.select("station_id", "valid_time", F.col("r.event_id").alias("event_id"), F.col("r.tmpc").alias("air_temp_c"), (F.col("r.sknt") * C.KNOT).alias("wind_speed_ms"), F.col("r.relh").alias("relative_humidity_pct"))


def newest_per_hour(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Keep the last row per station and hour in the given order of arrival."""
    hour = rows.withColumn("valid_time", F.date_trunc("hour", "valid_time"))
    return hour.withColumn("__r", F.row_number().over(W.partitionBy("station_id", "valid_time").orderBy(*[o.desc() for o in order]))).where("__r = 1").drop("__r")


def range_screen(obs: DataFrame) -> DataFrame:
    return obs.withColumns({c: F.when(F.col(c).between(*C.RANGES[c]), F.col(c)) for c in MEASURES})


def dewpoint_screen(obs: DataFrame) -> DataFrame:
    over = F.coalesce(F.col("dewpoint_c") > F.col("air_temp_c") + C.DEWPOINT_MARGIN, F.lit(False))
    return obs.withColumn("dewpoint_c", F.when(~over, F.col("dewpoint_c")))


def step_screen(obs: DataFrame) -> DataFrame:
    """Null what jumps from the row before; both edges of a spike go. Compared are the values before this screen."""
    jump = lambda c, limit: F.coalesce(F.abs(F.col(c) - F.lag(c).over(in_time())) > limit, F.lit(False))
    return obs.withColumns({c: F.when(~jump(c, limit), F.col(c)) for c, limit in C.STEPS.items()})


def flatline_screen(obs: DataFrame, columns: tuple[str, ...] = ("air_temp_c", "wind_speed_ms", "relative_humidity_pct"), rows: int = C.FLATLINE_ROWS) -> DataFrame:
    """Null values from the ``rows``-th of a run of equal ones on; a null ends a run; calm wind is exempt."""
    out = obs
    for c in columns:
        changed = F.when(F.col(c).isNull() | F.lag(c).over(in_time()).isNull() | (F.col(c) != F.lag(c).over(in_time())), 1).otherwise(0)
        out = out.withColumn("__new", changed).withColumn("__run", F.sum("__new").over(in_time().rowsBetween(W.unboundedPreceding, 0)))
        out = out.withColumn("__at", F.row_number().over(W.partitionBy("station_id", "__run").orderBy("valid_time")))
        stuck = F.col("__at") >= rows
        if c == "wind_speed_ms":
            stuck = stuck & (F.col(c) > C.FLATLINE_WIND)
        out = out.withColumn(c, F.when(~F.coalesce(stuck, F.lit(False)), F.col(c)))
    return out.drop("__new", "__run", "__at")


def all_screens(obs: DataFrame) -> DataFrame:
    return flatline_screen(step_screen(dewpoint_screen(range_screen(obs)))).dropna(how="all", subset=list(MEASURES))


def increments(rows: DataFrame, total: str, out: str, scale: float = C.INCH) -> DataFrame:
    """Positive first differences of a running total, scaled; the first row of a station has none."""
    step = F.col(total) - F.lag(total).over(in_time())
    return rows.withColumn(out, F.when(step.isNotNull(), F.greatest(step, F.lit(0.0))) * scale)
