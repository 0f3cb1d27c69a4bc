"""Decaying bias with empirical bands.

The running mean b = e1, b = (1 - w) b + w e is a weighted sum over rows counted from the newest: w (1 - w)^(r - 1), the
oldest without the factor w. So it is one window and one aggregate, in any order of arrival.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratocast import config as C
from stratocast.operators.pairing import with_bucket
from stratocast.storage import stored


def newest() -> list[Column]:
    """Order of rows from the newest on, ties resolved."""
    return [F.desc("valid_time"), F.desc("lead_h"), F.desc("lead_source"), F.desc("ingest_seq")]


def _decayed(rows: DataFrame, keys: list[str], name: str, w: float = C.DECAY) -> DataFrame:
    order = W.partitionBy(*keys).orderBy(*newest())
    ranked = rows.withColumn("__r", F.row_number().over(order)).withColumn("__n", F.count("*").over(W.partitionBy(*keys)))
    weight = F.pow(F.lit(1 - w), F.col("__r") - 1) * F.when(F.col("__r") == F.col("__n"), 1.0).otherwise(w)
    return ranked.groupBy(*keys).agg(F.sum(weight * F.col("error")).alias(name), F.count("*").alias(f"{name}_n"))


def errors(wide: DataFrame, additive: bool = True) -> DataFrame:
    known = with_bucket(wide.where(F.col("fc_mean").isNotNull() & F.col("obs").isNotNull())).withColumn("hour", F.hour("valid_time"))
    return known.withColumn("error", F.col("fc_mean") - F.col("obs") if additive else F.lit(0.0))


def cell_bias(wide: DataFrame, keys: tuple[str, ...] = ("station_id",), additive: bool = True) -> tuple[DataFrame, DataFrame]:
    """Bias per (bucket, hour) and per bucket, with counts."""
    rows = errors(wide, additive)
    return _decayed(rows, [*keys, "bucket", "hour"], "bias_cell"), _decayed(rows, [*keys, "bucket"], "bias_lead")


def _fitted(fitted: DataFrame, keys: tuple[str, ...], additive: bool) -> DataFrame:
    """One row per (keys, bucket): biases of the cells by hour and of the bucket, residual quantiles of its last rows, and those rows. One shuffle makes it all."""
    group = [*keys, "bucket"]
    bucket, cell = W.partitionBy(*group), W.partitionBy(*group, "hour")
    rows = errors(fitted, additive).withColumns({"__r": F.row_number().over(bucket.orderBy(*newest())), "__n": F.count("*").over(bucket), "__rc": F.row_number().over(cell.orderBy(*newest())), "__nc": F.count("*").over(cell)})
    weight = lambda r, n: F.pow(F.lit(1 - C.DECAY), F.col(r) - 1) * F.when(F.col(r) == F.col(n), 1.0).otherwise(C.DECAY)
    rows = rows.withColumns({"__cell": F.sum(weight("__rc", "__nc") * F.col("error")).over(cell), "__lead": F.sum(weight("__r", "__n") * F.col("error")).over(bucket)})
    resid = F.col("obs") - (F.col("fc_mean") - F.when(F.col("__nc") >= C.MIN_CELL, F.col("__cell")).otherwise(F.col("__lead")))
    rows = rows.withColumn("resid", resid)
    last = F.when(F.col("__r") <= C.RESIDUAL_WINDOW, F.col("resid"))
    levels = F.array(*[F.lit(q) for q in C.LEVELS])
    return rows.groupBy(*group).agg(
        F.map_from_entries(F.collect_list(F.when((F.col("__rc") == 1) & (F.col("__nc") >= C.MIN_CELL), F.struct("hour", "__cell")))).alias("cells"),
        F.first("__lead").alias("lead"),
        F.when(F.count(last) >= C.MIN_RESIDUALS, F.percentile(last, levels)).alias("band"),
        F.collect_list(F.when(F.col("__r") <= C.POOLED_WINDOW, F.struct("valid_time", "lead_h", "lead_source", "ingest_seq", "resid"))).alias("newest"),
    )


def _pooled(table: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Residual quantiles of the newest rows of all buckets, which are among the newest of each."""
    each = table.select(*keys, F.explode("newest").alias("x")).select(*keys, "x.*")
    last = each.withColumn("__r", F.row_number().over(W.partitionBy(*keys).orderBy(*newest()))).where(F.col("__r") <= C.POOLED_WINDOW)
    return last.groupBy(*keys).agg(F.percentile("resid", F.array(*[F.lit(q) for q in C.LEVELS])).alias("pooled"), F.count("*").alias("__n")).where(F.col("__n") >= C.MIN_RESIDUALS).drop("__n")


def residual_bands(fitted: DataFrame, keys: tuple[str, ...] = ("station_id",), additive: bool = True) -> tuple[DataFrame, DataFrame]:
    """Residual quantiles per bucket (from the last 60) and pooled (from the last 180); none from fewer than 15."""
    table = _fitted(fitted, keys, additive)
    return table.where("band IS NOT NULL").select(*keys, "bucket", "band"), _pooled(table, keys)


def _laid_on(out: DataFrame, floor: float | None, ceiling: float | None) -> DataFrame:
    """Rows with (cells, lead, band, pooled) joined to them: ``median``, q05..q95 and ``calibrated`` in their place."""
    bias = F.coalesce(F.element_at("cells", F.hour("valid_time")), F.col("lead"), F.lit(0.0))
    out = out.withColumn("median", F.col("fc_mean") - bias).withColumn("__band", F.coalesce("band", "pooled"))
    values = [F.col("median") + F.coalesce(F.col("__band")[i], F.lit(0.0)) for i in range(len(C.LEVELS))]
    if floor is not None:
        values = [F.greatest(v, F.lit(floor)) for v in values]
    if ceiling is not None:
        values = [F.least(v, F.lit(ceiling)) for v in values]
    ordered = F.array_sort(F.array(*values))
    out = out.withColumn("__q", F.when(F.col("median").isNotNull(), ordered)).withColumn("calibrated", F.col("__band").isNotNull())
    return out.withColumns({q: F.col("__q")[i] for i, q in enumerate(C.QUANTILES)}).drop("__q", "__band", "band", "pooled", "cells", "lead")


def predict(wide: DataFrame, fitted: DataFrame, keys: tuple[str, ...] = ("station_id",), floor: float | None = None, ceiling: float | None = None, additive: bool = True) -> DataFrame:
    """``wide`` with ``median``, q05..q95 and ``calibrated`` (false: no band could be fitted, and all quantiles are the median).

    The median is the mean less the bias of its cell, or of its bucket where the cell has few rows, or nothing.
    """
    table = _fitted(fitted, keys, additive)
    out = with_bucket(wide).join(table.drop("newest"), [*keys, "bucket"], "left").join(_pooled(table, keys), list(keys), "left")
    return _laid_on(out, floor, ceiling)


def parameters(fitted: DataFrame, keys: tuple[str, ...] = ("station_id",), additive: bool = True) -> DataFrame:
    """What ``predict`` takes from rows, as a table to be stored: (keys, bucket, cells, lead, band), and a row for bucket ``all`` with the band over all buckets."""
    table = _fitted(fitted, keys, additive)
    pooled = _pooled(table, keys).select(*keys, F.lit("all").alias("bucket"), F.lit(None).cast("map<int,double>").alias("cells"), F.lit(None).cast("double").alias("lead"), F.col("pooled").alias("band"))
    return table.drop("newest").unionByName(pooled)


def predict_from(wide: DataFrame, table: DataFrame, keys: tuple[str, ...] = ("station_id",), floor: float | None = None, ceiling: float | None = None) -> DataFrame:
    """As ``predict``, from a table of ``parameters``."""
    out = with_bucket(wide).join(table.where("bucket <> 'all'").select(*keys, "bucket", "cells", "lead", "band"), [*keys, "bucket"], "left")
    return _laid_on(out.join(table.where("bucket = 'all'").select(*keys, F.col("band").alias("pooled")), list(keys), "left"), floor, ceiling)


# --- states of all folds --------------------------------------------------------------------------


def _block_sums(rows: DataFrame, group: list[str], rank: str, count: str) -> DataFrame:
    """(group, blocks): per block of a group the number of rows and their decayed sum, as it adds to what came before (``s``) and as a beginning (``s0``)."""
    weight = F.pow(F.lit(1 - C.DECAY), F.col(rank) - 1)
    oldest = F.col(rank) == F.col(count)
    sums = rows.groupBy(*group, "__block").agg(F.count("*").alias("n"), F.sum(weight * C.DECAY * F.col("error")).alias("s"), F.sum(weight * F.when(oldest, 1.0).otherwise(C.DECAY) * F.col("error")).alias("s0"))
    return sums.groupBy(*group).agg(F.array_sort(F.collect_list(F.struct("__block", "n", "s", "s0"))).alias("blocks"))  # as many as there are refits, and one


def _before(blocks: str, fold: Column) -> Column:
    """(n, b) of the blocks before a fold: a decayed sum of two parts in a row is the later one, and the earlier one decayed by the later one's rows."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("b"))

    def merge(acc: Column, x: Column) -> Column:
        return F.when(acc["n"] == 0, F.struct(x["n"].alias("n"), x["s0"].alias("b"))).otherwise(F.struct((acc["n"] + x["n"]).alias("n"), (acc["b"] * F.pow(F.lit(1 - C.DECAY), x["n"]) + x["s"]).alias("b")))

    return F.aggregate(F.filter(blocks, lambda x: x["__block"] < fold), start, merge)


def fold_states(blocked: DataFrame, folds: DataFrame, by: tuple[str, ...] = ("station_id",), additive: bool = True) -> tuple[DataFrame, DataFrame]:
    """What ``predict`` needs at the beginning of every fold, over all rows before it: (by, fold, bucket, cells, lead, n, band) and (by, fold, pooled).

    ``blocked`` are rows with their block (``verification.with_block``), ``folds`` the wanted (by, fold). Rows are aggregated once, within their blocks; folds merge blocks. Only the newest
    rows of each block, those that can be among the last ``config.POOLED_WINDOW`` of a fold, meet the folds themselves.
    """
    group = [*by, "bucket"]
    bucket, cell = W.partitionBy(*group, "__block"), W.partitionBy(*group, "hour", "__block")
    rows = errors(blocked, additive).withColumns({"__r": F.row_number().over(bucket.orderBy(*newest())), "__n": F.count("*").over(bucket), "__rc": F.row_number().over(cell.orderBy(*newest())), "__nc": F.count("*").over(cell)})
    rows = stored(rows.select(*group, "hour", "__block", "valid_time", "lead_h", "lead_source", "ingest_seq", "error", "obs", "fc_mean", "__r", "__n", "__rc", "__nc"), "blocks")
    leads = _block_sums(rows, group, "__r", "__n")
    wanted = folds.select(*by, "fold")
    lead = leads.join(wanted, list(by)).withColumn("l", _before("blocks", F.col("fold"))).where("l.n > 0").select(*group, "fold", F.col("l.b").alias("lead"), F.col("l.n").alias("n"))
    cells = _block_sums(rows, [*group, "hour"], "__rc", "__nc").join(wanted, list(by)).withColumn("c", _before("blocks", F.col("fold"))).where(F.col("c.n") >= C.MIN_CELL)
    cells = cells.groupBy(*group, "fold").agg(F.map_from_entries(F.collect_list(F.struct("hour", "c.b"))).alias("cells"))
    state = stored(lead.join(cells, [*group, "fold"], "left"), "fold_states")
    # The newest rows: a row's place before a fold is its place in its block, and the rows of the blocks between.
    between = F.aggregate(F.filter("blocks", lambda x: (x["__block"] > F.col("__block")) & (x["__block"] < F.col("fold"))), F.lit(0).cast("long"), lambda a, x: a + x["n"])
    own = wanted.groupBy(*by).agg(F.collect_list("fold").alias("__folds"))
    late = rows.where(F.col("__r") <= C.POOLED_WINDOW).join(leads, group).join(own, list(by))
    late = late.withColumn("fold", F.explode(F.filter("__folds", lambda k: k > F.col("__block")))).withColumn("__place", F.col("__r") + between).where(F.col("__place") <= C.POOLED_WINDOW).drop("blocks", "__folds")
    met = late.join(state.select(*group, "fold", "cells", "lead"), [*group, "fold"])
    met = met.withColumn("resid", F.col("obs") - (F.col("fc_mean") - F.coalesce(F.element_at("cells", F.col("hour")), F.col("lead")))).drop("cells", "lead")
    met = stored(met.select(*group, "fold", "valid_time", "lead_h", "lead_source", "ingest_seq", "resid", "__place"), "residuals")
    levels = F.array(*[F.lit(q) for q in C.LEVELS])
    bands = met.where(F.col("__place") <= C.RESIDUAL_WINDOW).groupBy(*group, "fold").agg(F.percentile("resid", levels).alias("band"), F.count("*").alias("__k")).where(F.col("__k") >= C.MIN_RESIDUALS).drop("__k")
    every = met.withColumn("__r", F.row_number().over(W.partitionBy(*by, "fold").orderBy(*newest()))).where(F.col("__r") <= C.POOLED_WINDOW)
    pooled = every.groupBy(*by, "fold").agg(F.percentile("resid", levels).alias("pooled"), F.count("*").alias("__k")).where(F.col("__k") >= C.MIN_RESIDUALS).drop("__k")
    return state.join(bands, [*group, "fold"], "left"), pooled


def predict_folds(blocked: DataFrame, folds: DataFrame, by: tuple[str, ...] = ("station_id",), floor: float | None = None, ceiling: float | None = None, additive: bool = True) -> DataFrame:
    """Rows of the wanted folds, each with what was known at its fold's beginning."""
    state, pooled = fold_states(blocked, folds, by, additive)
    test = with_bucket(blocked.withColumnRenamed("__block", "fold")).join(folds.select(*by, "fold"), [*by, "fold"], "left_semi")
    out = test.join(state.drop("n"), [*by, "fold", "bucket"], "left").join(pooled, [*by, "fold"], "left")
    return _laid_on(out, floor, ceiling)
