"""Scores and diagnostics of probabilistic forecasts, as column expressions, each beside its SQL text.

Quantile columns are q05, q25, q50, q75, q95; a null quantile or observation gives null.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratocast.config import DENSE, LEVELS, NORMAL_LEVELS, QUANTILES, dense_weights

SQRT_PI = math.sqrt(math.pi)

# Coefficients of the rational approximation of the normal tail (Hart's form, as published by West).
HART_UPPER = (3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376)
HART_LOWER = (8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752)


def _cdf_sql(x: str) -> str:
    def horner(c):
        out = f"CAST({c[0]!r} AS DOUBLE)"
        for v in c[1:]:
            out = f"({out} * abs({x}) + CAST({v!r} AS DOUBLE))"
        return out

    tail = "CAST(1 AS DOUBLE) / (abs({0}) + 1 / (abs({0}) + 2 / (abs({0}) + 3 / (abs({0}) + 4 / (abs({0}) + CAST(0.65 AS DOUBLE)))))) / CAST(2.506628274631 AS DOUBLE)".format(x)
    density = f"exp(-({x}) * ({x}) / 2)"
    upper = f"CASE WHEN abs({x}) > 37 THEN CAST(0 AS DOUBLE) WHEN abs({x}) < CAST(7.07106781186547 AS DOUBLE) THEN {density} * {horner(HART_UPPER)} / {horner(HART_LOWER)} ELSE {density} * {tail} END"
    return f"CASE WHEN ({x}) > 0 THEN 1 - ({upper}) ELSE {upper} END"


def _pdf_sql(x: str) -> str:
    return f"exp(-({x}) * ({x}) / 2) / CAST({math.sqrt(2 * math.pi)!r} AS DOUBLE)"


def normal_cdf(x: str) -> Column:
    """Distribution function of the standard normal at a SQL expression."""
    return F.expr(_cdf_sql(x))


def crps_normal_sql(y: str, mu: str, sigma: str) -> str:
    s = f"greatest({sigma}, CAST(1e-6 AS DOUBLE))"
    z = f"(({y} - {mu}) / {s})"
    return f"{s} * ({z} * (2 * ({_cdf_sql(z)}) - 1) + 2 * ({_pdf_sql(z)}) - CAST({1 / SQRT_PI!r} AS DOUBLE))"


def crps_truncated_sql(y: str, mu: str, sigma: str) -> str:
    """Of a normal cut off below zero."""
    s = f"greatest({sigma}, CAST(1e-6 AS DOUBLE))"
    v = f"greatest({y}, CAST(0 AS DOUBLE))"
    above = f"greatest({_cdf_sql(f'({mu} / {s})')}, CAST(1e-10 AS DOUBLE))"
    w = f"(({v} - {mu}) / {s})"
    far = _cdf_sql(f"(CAST({math.sqrt(2)!r} AS DOUBLE) * {mu} / {s})")
    return f"({v} - {mu}) * (2 * ({_cdf_sql(w)}) + {above} - 2) / {above} + 2 * {s} * ({_pdf_sql(w)}) / {above} - {s} * ({far}) / ({above} * {above} * CAST({SQRT_PI!r} AS DOUBLE))"


# Coefficients of Acklam's approximation of the inverse normal.
ACKLAM_A = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
ACKLAM_B = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01)
ACKLAM_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
ACKLAM_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00)


def _inverse_sql(p: str) -> str:
    def horner(c, x, last=None):
        out = f"CAST({c[0]!r} AS DOUBLE)"
        for v in [*c[1:], *([last] if last is not None else [])]:
            out = f"({out} * {x} + CAST({v!r} AS DOUBLE))"
        return out

    q, r = f"({p} - CAST(0.5 AS DOUBLE))", f"(({p} - CAST(0.5 AS DOUBLE)) * ({p} - CAST(0.5 AS DOUBLE)))"
    low, high = f"sqrt(-2 * ln({p}))", f"sqrt(-2 * ln(1 - {p}))"
    return (
        f"CASE WHEN {p} < CAST(0.02425 AS DOUBLE) THEN {horner(ACKLAM_C, low)} / {horner(ACKLAM_D, low, 1.0)} "
        f"WHEN {p} <= CAST(0.97575 AS DOUBLE) THEN {horner(ACKLAM_A, r)} * {q} / {horner(ACKLAM_B, r, 1.0)} "
        f"ELSE -({horner(ACKLAM_C, high)}) / {horner(ACKLAM_D, high, 1.0)} END"
    )


def quantile_normal_sql(mu: str, sigma: str, level: int) -> str:
    return f"{mu} + greatest({sigma}, CAST(1e-6 AS DOUBLE)) * CAST({NORMAL_LEVELS[level]!r} AS DOUBLE)"


def quantile_truncated_sql(mu: str, sigma: str, level: int) -> str:
    s = f"greatest({sigma}, CAST(1e-6 AS DOUBLE))"
    below = f"({_cdf_sql(f'(-({mu}) / {s})')})"
    p = f"least(greatest({below} + CAST({LEVELS[level]!r} AS DOUBLE) * (1 - {below}), CAST(1e-12 AS DOUBLE)), CAST({1 - 1e-12!r} AS DOUBLE))"
    return f"greatest({mu} + {s} * ({_inverse_sql('(' + p + ')')}), CAST(0 AS DOUBLE))"


def with_truncated_quantiles(frame: DataFrame, mu: str, sigma: str) -> DataFrame:
    """``frame`` with q05..q95 of a normal cut off below zero; the mass below zero and each level's share are columns of their own, so no text is repeated."""
    s = f"greatest({sigma}, CAST(1e-6 AS DOUBLE))"
    out = frame.withColumn("__below", F.expr(_cdf_sql(f"(-({mu}) / {s})")))
    levels = F.array(*[F.lit(q) for q in LEVELS])
    share = F.transform(levels, lambda q: F.least(F.greatest(F.col("__below") + q * (1 - F.col("__below")), F.lit(1e-12)), F.lit(1 - 1e-12)))
    out = out.withColumn("__p", share)
    for i, name in enumerate(QUANTILES):
        out = out.withColumn("__one", F.col("__p")[i]).withColumn(name, F.expr(f"greatest({mu} + {s} * ({_inverse_sql('__one')}), CAST(0 AS DOUBLE))"))
    return out.drop("__below", "__p", "__one")


def pinball(y: Column, q: Column, level: float) -> Column:
    d = y - q
    return F.greatest(level * d, (level - 1.0) * d)


def crps_quantiles(y: Column, quantiles: list[Column]) -> Column:
    """Twice the mean pinball loss over 99 levels between and beyond the five, whose order must rise.

    Between two published levels the quantile is a line in the level, so the loss over the levels there is a difference of sums of whole numbers: over all of them,
    less over those whose quantile lies above ``y``.
    """
    total = F.lit(0.0)
    percent = [round(100 * x) for x in LEVELS]
    for i, (low, high) in enumerate(zip(quantiles[:-1], quantiles[1:], strict=True)):
        begin = percent[i] if i else 1
        end = percent[i + 1] - 1 if i < len(LEVELS) - 2 else 99
        n, s1, s2 = end - begin + 1, sum(range(begin, end + 1)), sum(j * j for j in range(begin, end + 1))
        slope = (high - low) / (percent[i + 1] - percent[i])
        start = low - slope * percent[i]
        # The last level whose quantile doesn't lie above y.
        crossed = F.least(F.greatest((y - start) / F.nullif(slope, F.lit(0.0)), F.lit(begin - 1.0)), F.lit(float(end)))
        last = F.when(slope > 0, F.floor(crossed).cast("double")).when(low > y, begin - 1.0).otherwise(float(end))
        above = (start - y) * (end - last) + slope * (end * (end + 1) - last * (last + 1)) / 2
        total = total + ((y - start) * s1 - slope * s2) / 100 + above
    return 2.0 * total / len(DENSE)


def crps_quantiles_sql(y: str, quantiles: list[str] | tuple[str, ...] = QUANTILES) -> str:
    terms = []
    for d, row in zip(DENSE, dense_weights(), strict=True):
        q = " + ".join(f"CAST({w!r} AS DOUBLE) * {v}" for w, v in zip(row, quantiles, strict=True) if w)
        terms.append(f"greatest(CAST({d!r} AS DOUBLE) * ({y} - ({q})), (CAST({d!r} AS DOUBLE) - 1) * ({y} - ({q})))")
    return f"2 * ({' + '.join(terms)}) / {len(DENSE)}"


def crps_sample(y: Column, samples: Column) -> Column:
    """Of an array of samples: mean distance less half the mean difference of pairs."""
    s = F.array_sort(samples)
    n = F.size(samples)
    distance = F.aggregate(s, F.lit(0.0), lambda a, x: a + F.abs(x - y)) / n
    spread = F.aggregate(F.zip_with(s, F.sequence(F.lit(1), n), lambda x, i: x * (2 * i - n - 1)), F.lit(0.0), lambda a, x: a + x)
    return distance - spread / (n * n)


def skill(score: Column, reference: Column) -> Column:
    """One minus the ratio; null unless the reference is positive."""
    return F.when(reference > 0, 1.0 - score / reference)


def pit(y: Column, quantiles: list[Column]) -> Column:
    """Level at which the distribution that the quantiles describe crosses the observation."""
    out = F.lit((LEVELS[-1] + 1) / 2)
    for i in range(len(LEVELS) - 2, -1, -1):
        low, high = quantiles[i], quantiles[i + 1]
        share = F.when(high <= low, 0.5).otherwise(F.least(F.greatest((y - low) / (high - low), F.lit(0.0)), F.lit(1.0)))
        out = F.when(y < high, LEVELS[i] + share * (LEVELS[i + 1] - LEVELS[i])).otherwise(out)
    out = F.when(y < quantiles[0], LEVELS[0] * 0.5).otherwise(out)
    known = y.isNotNull()
    for q in quantiles:
        known = known & q.isNotNull()
    return F.when(known, out)


def pit_sql(y: str) -> str:
    out = f"CAST({(LEVELS[-1] + 1) / 2!r} AS DOUBLE)"
    for i in range(len(LEVELS) - 2, -1, -1):
        low, high = QUANTILES[i], QUANTILES[i + 1]
        share = f"CASE WHEN {high} <= {low} THEN 0.5 ELSE least(greatest(({y} - {low}) / ({high} - {low}), 0), 1) END"
        out = f"CASE WHEN {y} < {high} THEN CAST({LEVELS[i]!r} AS DOUBLE) + ({share}) * CAST({LEVELS[i + 1] - LEVELS[i]!r} AS DOUBLE) ELSE {out} END"
    return f"CASE WHEN {y} IS NULL THEN NULL WHEN {y} < q05 THEN CAST({LEVELS[0] * 0.5!r} AS DOUBLE) ELSE {out} END"


def exceedance(threshold: float, quantiles: list[Column]) -> Column:
    """Probability of more than the threshold, read off the quantiles; half the outer level beyond them."""
    t = F.lit(float(threshold))
    out = F.lit((1 - LEVELS[-1]) * 0.5)
    for i in range(len(LEVELS) - 2, -1, -1):
        low, high = quantiles[i], quantiles[i + 1]
        cdf = LEVELS[i] + F.when(high > low, (t - low) / (high - low)).otherwise(1.0) * (LEVELS[i + 1] - LEVELS[i])
        out = F.when(t < high, 1 - cdf).otherwise(out)
    out = F.when(t <= quantiles[0], 1 - LEVELS[0] * 0.5).otherwise(out)
    return F.when(quantiles[0].isNotNull(), F.least(F.greatest(out, F.lit(0.0)), F.lit(1.0)))


def exceedance_sql(threshold: float) -> str:
    t = f"CAST({float(threshold)!r} AS DOUBLE)"
    out = f"CAST({(1 - LEVELS[-1]) * 0.5!r} AS DOUBLE)"
    for i in range(len(LEVELS) - 2, -1, -1):
        low, high = QUANTILES[i], QUANTILES[i + 1]
        out = f"CASE WHEN {t} < {high} THEN 1 - (CAST({LEVELS[i]!r} AS DOUBLE) + CASE WHEN {high} > {low} THEN ({t} - {low}) / ({high} - {low}) ELSE 1 END * CAST({LEVELS[i + 1] - LEVELS[i]!r} AS DOUBLE)) ELSE {out} END"
    return f"CASE WHEN q05 IS NULL THEN NULL WHEN {t} <= q05 THEN CAST({1 - LEVELS[0] * 0.5!r} AS DOUBLE) ELSE least(greatest({out}, 0), 1) END"


def clamped(quantiles: list[Column], low: float | None, high: float | None) -> list[Column]:
    """Quantiles within physical bounds, in order; null stays null."""
    known = quantiles[0].isNotNull()
    for q in quantiles[1:]:
        known = known & q.isNotNull()
    bounded = quantiles
    if low is not None:
        bounded = [F.greatest(q, F.lit(low)) for q in bounded]
    if high is not None:
        bounded = [F.least(q, F.lit(high)) for q in bounded]
    ordered = F.array_sort(F.array(*bounded))
    return [F.when(known, ordered[i]) for i in range(len(quantiles))]
