"""Distribution fits: one group per (station, ..., bucket), all groups in one pass.

Filtering, weights, trimming and designs are column work, and so are predictions. A group that reaches Python is bounded by ``config.MAX_ROWS``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratocast import config as C
from stratocast.functions.scores import HART_LOWER, HART_UPPER, clamped, with_truncated_quantiles
from stratocast.operators import design
from stratocast.storage import stored


def cdf(z: np.ndarray) -> np.ndarray:
    a = np.minimum(np.abs(z), 7.07)
    tail = np.exp(-a * a / 2) * np.polyval(HART_UPPER, a) / np.polyval(HART_LOWER, a)
    return np.where(z > 0, 1 - tail, tail)


def pdf(z: np.ndarray) -> np.ndarray:
    return np.exp(-z * z / 2) / np.sqrt(2 * np.pi)


def crps(y: np.ndarray, mu: np.ndarray, sigma: np.ndarray, truncated: bool) -> np.ndarray:
    z = (y - mu) / sigma
    if not truncated:
        return sigma * (z * (2 * cdf(z) - 1) + 2 * pdf(z) - 1 / np.sqrt(np.pi))
    above = np.maximum(cdf(mu / sigma), 1e-10)
    return (y - mu) * (2 * cdf(z) + above - 2) / above + 2 * sigma * pdf(z) / above - sigma * cdf(np.sqrt(2) * mu / sigma) / (above**2 * np.sqrt(np.pi))


def minimum_crps(x: np.ndarray, s: np.ndarray, y: np.ndarray, w: np.ndarray, truncated: bool, rounds: int = 60) -> tuple[np.ndarray, float]:
    """Location coefficients (constant first), log spread and its slope on ``s``, by quasi-Newton steps from a weighted regression."""
    w = w / w.sum()
    x1 = np.column_stack([np.ones(len(y)), x])
    root = np.sqrt(w)
    beta = np.linalg.lstsq(x1 * root[:, None], y * root, rcond=None)[0]
    spread = max(float(np.sqrt((w * (y - x1 @ beta) ** 2).sum())), 1e-3)
    theta = np.concatenate([beta, [np.log(spread), 0.0]])
    k = len(beta)

    def bounded(t: np.ndarray) -> np.ndarray:
        t = t.copy()
        t[k], t[k + 1] = np.clip(t[k], -8, 8), np.clip(t[k + 1], 0, 5)
        return t

    def value(t: np.ndarray) -> tuple[float, np.ndarray]:
        mu, log_sigma = x1 @ t[:k], np.clip(t[k] + t[k + 1] * s, -8, 8)
        sigma = np.exp(log_sigma)
        if truncated:
            h = 1e-5
            f = (w * crps(y, mu, sigma, True)).sum()
            d_mu = (crps(y, mu + h, sigma, True) - crps(y, mu - h, sigma, True)) / (2 * h)
            d_log = (crps(y, mu, sigma * np.exp(h), True) - crps(y, mu, sigma * np.exp(-h), True)) / (2 * h)
        else:
            z = (y - mu) / sigma
            f = (w * crps(y, mu, sigma, False)).sum()
            d_mu, d_log = 1 - 2 * cdf(z), sigma * (2 * pdf(z) - 1 / np.sqrt(np.pi))
        g = np.concatenate([x1.T @ (w * d_mu), [(w * d_log).sum(), (w * d_log * s).sum()]])
        return float(f), g

    # Metric of the start: curvature of the location part.
    scale = np.sqrt((w[:, None] * x1**2).sum(axis=0)) + 1e-9
    h = np.diag(np.concatenate([spread / scale**2, [1 / spread, 1 / spread]]))
    f, g = value(theta)
    for _ in range(rounds):
        step, t = -h @ g, 1.0
        if step @ g >= 0:
            step = -g
        while t > 1e-8:
            new = bounded(theta + t * step)
            f2, g2 = value(new)
            if f2 <= f + 1e-4 * (g @ (new - theta)):
                break
            t /= 2
        moved, turned = new - theta, g2 - g
        if t <= 1e-8 or f - f2 < 1e-10:
            break
        if moved @ turned > 1e-12:
            r = 1 / (moved @ turned)
            a = np.eye(len(theta)) - r * np.outer(moved, turned)
            h = a @ h @ a.T + r * np.outer(moved, moved)
        theta, f, g = new, f2, g2
    return theta, f


PARAMETERS = "a double, b array<double>, c double, d double, n_train long, crps_train double, status string"


def fit_emos(rows: DataFrame, by: list[str], features: list[Column], truncated: bool = False, least: int = C.MIN_BUCKET, taus: float = C.CUTOFF_TAUS, yearly: list[Column] | None = None, most: int = C.MAX_ROWS) -> DataFrame:
    """Parameters per group; a group that can't be fitted gives a row with its ``status``, not a failed job.

    ``yearly`` are further features that count only where a group's rows span ``config.SEASONAL_DAYS``; elsewhere they are zero, and so are their coefficients.
    """
    weighted = design.trimmed(design.with_tau(rows.where("obs IS NOT NULL AND fc_mean IS NOT NULL"), by), by, taus, most=most)
    weighted = weighted.where(F.col("age") <= C.MAX_TRAIN_DAYS)
    group = W.partitionBy(*by)
    long = (F.unix_timestamp(F.max("valid_time").over(group)) - F.unix_timestamp(F.min("valid_time").over(group))) / 86400.0 >= C.SEASONAL_DAYS
    if yearly:
        weighted = weighted.withColumn("__long", long)
    x = [*features, *[F.when(F.col("__long"), c).otherwise(0.0) for c in yearly or []]]
    ready = weighted.select(*by, F.array(*x).alias("x"), F.col("fc_spread").alias("s"), F.col("obs").alias("y"), F.col("weight").alias("w"))
    types = ", ".join(f"{k} {t}" for k, t in rows.select(*by).dtypes)

    def fit(keys: tuple, group: pd.DataFrame) -> pd.DataFrame:
        row = {"a": None, "b": None, "c": None, "d": None, "n_train": len(group), "crps_train": None, "status": "few rows"}
        if len(group) >= least:
            try:
                theta, f = minimum_crps(np.stack(group["x"].to_numpy()), group["s"].fillna(0).to_numpy(), group["y"].to_numpy(), group["w"].to_numpy(), truncated)
                row |= {"a": theta[0], "b": theta[1:-2].tolist(), "c": theta[-2], "d": theta[-1], "crps_train": f, "status": "ok" if np.isfinite(theta).all() else "error"}
            except np.linalg.LinAlgError:
                row["status"] = "error"
        return pd.DataFrame([dict(zip(by, keys, strict=True)) | row])

    return ready.groupBy(*by).applyInPandas(fit, f"{types}, {PARAMETERS}")


def predict_emos(rows: DataFrame, parameters: DataFrame, by: list[str], features: list[Column], truncated: bool = False, low: float | None = None, high: float | None = None) -> DataFrame:
    """``rows`` with mu, sigma and q05..q95 within ``low`` and ``high``.

    Rows of groups without parameters take those of the nearest bucket; rows that have none either take the raw mean with the widest sigma of their station; rows without a forecast are
    null; ``calibrated`` is false where nothing of a station was fitted.
    """
    keys = [k for k in by if k != "bucket"]
    fitted = parameters.where("status = 'ok'").withColumnRenamed("bucket", "fitted_bucket")
    near = design.nearest_bucket(fitted.select(*keys, "fitted_bucket"), keys)
    table = near.join(fitted, [*keys, "fitted_bucket"])
    out = rows.join(table, by, "left")
    mu = F.col("a") + F.aggregate(F.zip_with("b", F.array(*features), lambda b, x: b * x), F.lit(0.0), lambda t, v: t + v)
    log_sigma = F.greatest(F.lit(-8.0), F.least(F.lit(8.0), F.col("c") + F.col("d") * F.coalesce("fc_spread", F.lit(0.0))))
    out = out.withColumn("mu", mu).withColumn("sigma", F.when(F.col("mu").isNotNull(), F.exp(log_sigma)))
    widest = F.max("sigma").over(W.partitionBy(*keys))
    out = out.withColumn("__widest", widest).withColumn("calibrated", F.col("__widest").isNotNull())
    out = out.withColumns({"mu": F.when(F.col("calibrated"), F.coalesce("mu", "fc_mean")), "sigma": F.when(F.coalesce("mu", "fc_mean").isNotNull(), F.coalesce("sigma", "__widest"))})
    if truncated:
        out = with_truncated_quantiles(out, "mu", "sigma")
    else:
        out = out.withColumns({q: F.col("mu") + F.col("sigma") * z for q, z in zip(C.QUANTILES, C.NORMAL_LEVELS, strict=True)})
    if low is not None or high is not None:
        out = out.withColumns(dict(zip(C.QUANTILES, clamped([F.col(q) for q in C.QUANTILES], low, high), strict=True)))
    return out.drop("a", "b", "c", "d", "n_train", "crps_train", "status", "fitted_bucket", "__widest")


def _solved(matrix: list[list[Column]], right: list[Column]) -> list[Column]:
    """The solution of three symmetric equations, by determinants."""

    def det(m: list[list[Column]]) -> Column:
        return m[0][0] * (m[1][1] * m[2][2] - m[1][2] * m[2][1]) - m[0][1] * (m[1][0] * m[2][2] - m[1][2] * m[2][0]) + m[0][2] * (m[1][0] * m[2][1] - m[1][1] * m[2][0])

    whole = det(matrix)
    return [F.try_divide(d, whole) for d in [det([[right[i] if j == k else matrix[i][j] for j in range(3)] for i in range(3)]) for k in range(3)]]


RIDGE = 1e-3


def chance(x: list[Column], t: list[Column]) -> Column:
    """Logistic of the linear form, which is kept within 30 of zero."""
    z = t[0] + t[1] * x[0] + t[2] * x[1]
    return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z))))


def occurrence_rows(rows: DataFrame, by: list[str], threshold: float = C.OCCURRENCE, least: int = C.MIN_BUCKET, most_days: int = C.MAX_TRAIN_DAYS) -> DataFrame:
    """Rows that an occurrence model learns from: (by, fc_mean, wet_share, wet) of the last ``most_days``, in groups of ``least`` or more."""
    known = rows.where("obs IS NOT NULL AND fc_mean IS NOT NULL")
    newest = F.max("valid_time").over(W.partitionBy(*[k for k in by if k != "bucket"]))
    recent = known.withColumn("__age", F.unix_timestamp(newest) - F.unix_timestamp("valid_time")).where(F.col("__age") <= most_days * 86400)
    return recent.withColumn("__n", F.count("*").over(W.partitionBy(*by))).where(F.col("__n") >= least).select(*by, "fc_mean", "wet_share", (F.col("obs") > threshold).cast("double").alias("wet"))


def fit_occurrence(rows: DataFrame, by: list[str], threshold: float = C.OCCURRENCE, ridge: float = RIDGE, least: int = C.MIN_BUCKET, most_days: int = C.MAX_TRAIN_DAYS, steps: int = 30) -> DataFrame:
    """Logistic chance of more than ``threshold`` on (mean, share of wet models), per group; no row for groups of fewer than ``least``, the base rate where a step fails.

    Newton steps for all groups at once: a step is one partial aggregate of gradient and curvature (nine sums a group) over rows that are written once, so a group may be of any size. What
    comes to the driver is whether any group still moves. Groups whose step is below 1e-8 are left out of the next pass.
    """
    ready = stored(occurrence_rows(rows, by, threshold, least, most_days), "occurrence")
    rate = F.greatest(F.lit(1e-4), F.least(F.lit(1 - 1e-4), F.avg("wet")))
    start = ready.groupBy(*by).agg(rate.alias("__base"), F.count("*").alias("n_train"), F.avg("wet").alias("base_rate"))
    start = start.withColumn("__t0", F.log(F.col("__base") / (1 - F.col("__base"))))
    state = stored(start.select(*by, F.col("__t0").alias("t0"), F.lit(0.0).alias("t1"), F.lit(0.0).alias("t2"), F.col("__t0"), "n_train", "base_rate", F.lit(True).alias("__moves")), "occurrence_state")
    x = [F.lit(1.0), F.col("fc_mean"), F.col("wet_share")]
    for _ in range(steps):
        met = ready.join(state.where("__moves").select(*by, "t0", "t1", "t2"), by)
        p = chance(x[1:], [F.col("t0"), F.col("t1"), F.col("t2")])
        met = met.withColumn("__p", p).withColumn("__v", F.col("__p") * (1 - F.col("__p")))
        pairs_ = [(i, j) for i in range(3) for j in range(i, 3)]
        sums = met.groupBy(*by).agg(*[F.sum(F.col("__v") * x[i] * x[j]).alias(f"__h{i}{j}") for i, j in pairs_], *[F.sum((F.col("wet") - F.col("__p")) * x[i]).alias(f"__g{i}") for i in range(3)])
        out = state.join(sums, by, "left")
        penalty = [2 * ridge * F.col("n_train") * weight for weight in (1e-9, 1.0, 1.0)]
        matrix = [[F.col(f"__h{min(i, j)}{max(i, j)}") + ((penalty[i] + 1e-9) if i == j else 0.0) for j in range(3)] for i in range(3)]
        step = _solved(matrix, [F.col(f"__g{i}") - penalty[i] * F.col(f"t{i}") for i in range(3)])
        out = out.withColumns({f"__d{i}": F.when(F.col("__moves"), s) for i, s in enumerate(step)})
        size = F.greatest(*[F.abs(f"__d{i}") for i in range(3)])
        failed = F.col("__moves") & (F.isnull(size) | F.isnan(size) | (size == float("inf")))
        moved = {f"t{i}": F.when(failed, F.col("__t0") if i == 0 else F.lit(0.0)).when(F.col("__moves"), F.col(f"t{i}") + F.greatest(F.lit(-5.0), F.least(F.lit(5.0), F.col(f"__d{i}")))).otherwise(F.col(f"t{i}")) for i in range(3)}
        out = out.withColumns(moved | {"__moves": F.col("__moves") & ~failed & (size >= 1e-8)})
        state = stored(out.select(*by, "t0", "t1", "t2", "__t0", "n_train", "base_rate", "__moves"), "occurrence_state")
        if state.where("__moves").isEmpty():
            break
    return state.select(*by, "t0", "t1", "t2", "n_train", "base_rate")


MAP_LEVELS = tuple(0.02 + 0.04 * i for i in range(25))


def amount_map(rows: DataFrame, by: list[str], threshold: float = 0.1) -> DataFrame:
    """25 quantiles of positive forecast means and of positive observations per group; null from five or fewer."""
    levels = F.array(*[F.lit(q) for q in MAP_LEVELS])
    wet = lambda c: F.when(F.col(c) > threshold, F.col(c))
    some = lambda c, name: F.when(F.count(wet(c)) > 5, F.percentile(wet(c), levels)).alias(name)
    return rows.groupBy(*by).agg(some("fc_mean", "map_f"), some("obs", "map_o"))


def mapped(x: Column, xs: Column, ys: Column) -> Column:
    """Linear interpolation of ``x`` in sorted ``xs``, flat beyond the ends; ``x`` itself where there is no map."""
    i = F.size(F.filter(xs, lambda v: v <= x))
    x0, x1, y0, y1 = F.element_at(xs, F.greatest(i, F.lit(1))), F.element_at(xs, F.least(i + 1, F.size(xs))), F.element_at(ys, F.greatest(i, F.lit(1))), F.element_at(ys, F.least(i + 1, F.size(xs)))
    inside = F.when(x1 > x0, y0 + (y1 - y0) * (x - x0) / (x1 - x0)).otherwise(y0)
    return F.when(xs.isNull() | ys.isNull(), x).when(i == 0, ys[0]).when(i >= F.size(xs), F.element_at(ys, -1)).otherwise(inside)


def precip_quantiles(p: Column, amount: Column) -> list[Column]:
    """Zero up to the dry share; above, the mapped amount scaled by how far into the wet part a level lies."""
    return [F.when(F.lit(q) <= 1 - p, 0.0).otherwise(F.greatest(amount * (0.4 + 1.6 * (q - (1 - p)) / F.greatest(p, F.lit(1e-6))), F.lit(0.0))) for q in C.LEVELS]
