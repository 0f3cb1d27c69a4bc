"""Boosted quantiles: packed groups and passes over rows against plain recursive trees; occurrence and climatology against plain versions."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratocast import config as C
from stratocast.operators import boosting, verification


def plain(x, y, m, n, q, rounds):
    """Trees grown node by node, each with its own sums."""
    edges = [np.unique(np.quantile(x[:m, j], np.linspace(0, 1, boosting.BINS + 1)[1:-1])) for j in range(x.shape[1])]
    bins = np.column_stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(edges)])
    value = np.full(len(y), np.quantile(y[:m], q))
    best, kept, since = np.inf, value.copy(), 0

    def grow(rows, g, left, every):
        top = (1e-9, None, None)
        for j in range(bins.shape[1]) if left else ():
            for cut in range(boosting.BINS):
                low = bins[rows, j] <= cut
                if low.sum() >= boosting.LEAST and (~low).sum() >= boosting.LEAST:
                    gain = g[rows][low].sum() ** 2 / low.sum() + g[rows][~low].sum() ** 2 / (~low).sum() - g[rows].sum() ** 2 / len(rows)
                    if gain > top[0] * (1 + 1e-9):
                        top = (gain, j, cut)
        if top[1] is None:
            yield rows, every
            return
        for side in (True, False):
            yield from grow(rows[(bins[rows, top[1]] <= top[2]) == side], g, left - 1, every & ((bins[:, top[1]] <= top[2]) == side))

    for _ in range(rounds):
        loss = boosting.pinball(y[m:n] - value[m:n], q).mean()
        best, kept, since = (loss, value.copy(), 0) if loss < best else (best, kept, since + 1)
        if since >= boosting.PATIENCE:
            break
        g = np.where(y[:m] > value[:m], q, q - 1)
        for rows, every in list(grow(np.arange(m), g, boosting.DEPTH, np.ones(len(y), dtype=bool))):
            value[every] += boosting.RATE * np.quantile((y - value)[rows], q)
    return kept[n:]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(2)
    out = []
    for s in ("a", "b"):
        for i in range(900):
            x = rng.normal(size=3)
            out.append((s, i, 6 * (1 + i % 3), float(x[0]), float(round(x[1], 1)), float(x[2] > 0), float(x[0] * (1 + x[1]) + rng.normal() * 0.3)))
    df = spark.createDataFrame(out, "station_id string, hour int, lead_h int, x0 double, x1 double, x2 double, obs double")
    return df.withColumn("valid_time", F.timestamp_seconds(F.col("hour") * 3600 + 1_600_000_000)).withColumn("fc_mean", F.col("x0")), out


@pytest.mark.parametrize("in_task", [10_000, 100])
def test_trees_are_the_plain_ones(spark, monkeypatch, rows, in_task):
    """In one task, and by passes over the rows (two groups, in two runs of one each)."""
    monkeypatch.setattr(boosting, "IN_TASK", in_task)
    monkeypatch.setattr(boosting, "GROUPS", 1)
    monkeypatch.setattr(boosting, "ROUNDS", 4)
    monkeypatch.setattr(C, "BOOSTED_ROWS", 500)
    monkeypatch.setattr(C, "LEVELS", (0.25, 0.5))
    monkeypatch.setattr(C, "STOP_DAYS", 5)
    monkeypatch.setattr(C, "STOP_ROWS", 100)
    monkeypatch.setattr(C, "STOP_TRAIN", 300)
    df, out = rows
    got = boosting.boosted_quantiles(df.where("hour < 800"), df.where("hour >= 800"), ["station_id"], [F.col(c) for c in ("x0", "x1", "x2")]).collect()
    assert len(got) == 2 * 2 * 100
    for s in "ab":
        mine = [r for r in out if r[0] == s]
        x, y = np.array([r[3:6] for r in mine]), np.array([r[6] for r in mine])
        m = 799 - 5 * 24
        for q in (0.25, 0.5):
            want = plain(x, y, m, 800, q, 4)
            have = sorted((r["valid_time"], r["value"]) for r in got if r["station_id"] == s and r["level"] == q)
            assert np.allclose([v for _, v in have], want, atol=1e-9)


def test_order_statistics_are_exact():
    rng = np.random.default_rng(7)
    v = np.concatenate([rng.normal(size=500), np.zeros(40), -np.zeros(3), rng.integers(-5, 5, 200).astype(float), [1e300, -1e300, 5e-324]])
    keys = np.sort(boosting._ordered(v.copy()))
    ranks = np.array([0, 1, 100, 371, len(v) - 1])
    found = boosting._order_statistics(lambda prefix, shift, bits: boosting._count_below(keys, prefix, shift, bits), ranks)
    assert (found == np.sort(v)[ranks]).all()


def test_climatology_across_the_new_year(spark):
    rng = np.random.default_rng(1)
    hours = np.concatenate([np.arange(0, 24 * 30, 6), 24 * 340 + np.arange(0, 24 * 60, 6), 24 * 1100 + np.arange(0, 24 * 3)])
    data = [("s", int(1_577_836_800 + h * 3600), None if i % 17 == 0 else float(rng.normal())) for i, h in enumerate(hours)]
    obs = spark.createDataFrame(data, "station_id string, t long, obs double").select("station_id", F.timestamp_seconds("t").alias("valid_time"), "obs")
    targets = obs.select("station_id", F.col("valid_time").alias("target"))
    got = {r["target"].timestamp(): (r["n"], r["q"]) for r in verification.climatology(targets, obs).collect()}
    import datetime as dt

    day = lambda t: (dt.datetime.fromtimestamp(t, dt.UTC).timetuple().tm_yday - 1) % 365
    found = 0
    for _, t, _ in data:
        near = [(u, v) for _, u, v in data if v is not None and min((day(u) - day(t)) % 365, (day(t) - day(u)) % 365) <= 15 and abs(u - t) > 3 * 86400]
        same = [v for u, v in near if u % 86400 // 3600 == t % 86400 // 3600]
        want = same if len(same) >= 10 else [v for _, v in near] if len(near) >= 5 else None
        assert (float(t) in got) == (want is not None)
        if want is not None:
            found += 1
            assert got[t][0] == len(want) and np.allclose(got[t][1], np.quantile(want, C.LEVELS))
    assert found > 100


def test_counts_need_little_memory():
    """A task counts many rows in parts."""
    rng = np.random.default_rng(3)
    bins, leaf, low = rng.integers(0, boosting.BINS, (300_000, 11)).astype(np.uint8), rng.integers(0, 4, 300_000), rng.random(300_000) < 0.4
    tracemalloc.start()
    got = boosting.counts_of(bins, leaf, low, 4)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20e6  # 11 cells of eight bytes a row were 26 MB
    for which, some in ((0, np.ones(len(low), bool)), (1, low)):
        assert (got[which, 3, 10] == np.bincount(bins[some & (leaf == 3), 10], minlength=boosting.BINS)).all()


def test_all_hours_of_years_fit_a_task(spark, monkeypatch):
    """Seven leads for each hour of seven years are no matter for passes over the rows."""
    monkeypatch.setattr(boosting, "_over_rows", None)
    monkeypatch.setattr(boosting, "ROUNDS", 2)
    monkeypatch.setattr(C, "LEVELS", (0.5,))
    i = F.col("id")
    df = spark.range(420_000).select(F.lit("a").alias("station_id"), F.timestamp_seconds(1_000_000_000 + F.floor(i / 7) * 3600).alias("valid_time"), (i % 7 * 24).cast("int").alias("lead_h"), (i % 1009).cast("double").alias("fc_mean"), (i % 1009 + i % 13).cast("double").alias("obs"))
    cut = F.timestamp_seconds(F.lit(1_000_000_000 + 54_000 * 3600))
    out = boosting.boosted_quantiles(df.where(F.col("valid_time") < cut), df.where(F.col("valid_time") >= cut), ["station_id"], [F.col("fc_mean"), F.col("lead_h").cast("double")])
    assert out.count() == 42_000 and out.where("value IS NULL").count() == 0
