"""Boosted quantiles: trees over binned features whose leaves take the quantile of what is left over, one run of trees per group and level.

Everything that a tree needs are counts per (leaf, feature, bin) of rows and of rows at or below their present value, and order statistics per leaf. For groups of up to ``IN_TASK``
rows these are counted in one task from packed rows (a byte a feature). For larger ones rows stay where they lie: each pass counts in the tasks that read them, sums the counts by
(group, cell) in Spark, and only these meet the driver, ``GROUPS`` groups at a time; order statistics come exactly from counts of ever smaller ranges. Both grow the same trees.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratocast import config as C
from stratocast.storage import stored

#: Rows of a group that one task takes; groups that one run over larger ones holds at a time.
IN_TASK, GROUPS = 1_000_000, 64
#: Rows whose cells are worked out at a time.
CHUNK = 1 << 15
ROUNDS, RATE, DEPTH, BINS, LEAST, PATIENCE = 150, 0.1, 3, 32, 40, 15
_BITS = 12


# --- trees ----------------------------------------------------------------------------------------


def leaf_of(bins: np.ndarray, tree: tuple[np.ndarray, np.ndarray], depth: int) -> np.ndarray:
    """Leaf of each row: a bit a level, set where the row lies above the cut; nodes that don't split send all rows down the low side."""
    feature, cut = tree
    at = np.zeros(len(bins), dtype=np.int64)
    rows = np.arange(len(bins))
    for d in range(depth):
        node = (1 << d) - 1 + at
        f = feature[node]
        at = 2 * at + ((f >= 0) & (bins[rows, np.maximum(f, 0)] > cut[node]))
    return at


def counts_of(bins: np.ndarray, leaf: np.ndarray, low: np.ndarray, leaves: int) -> np.ndarray:
    """(2, leaves, features, BINS): rows, and rows at or below their value."""
    n, width = bins.shape
    size = leaves * width * BINS
    out = np.zeros((2, size), dtype=np.int64)
    for at in range(0, n, CHUNK):
        part = slice(at, at + CHUNK)
        cell = (leaf[part, None] * width + np.arange(width)) * BINS + bins[part]
        out[0] += np.bincount(cell.ravel(), minlength=size)
        out[1] += np.bincount(cell[low[part]].ravel(), minlength=size)
    return out.reshape(2, leaves, width, BINS)


def best_splits(counts: np.ndarray, q: float) -> tuple[np.ndarray, np.ndarray]:
    """Feature and cut of every leaf, by the gain in the sum of gradients (q above the value, q - 1 at or below); -1 where none has ``LEAST`` rows on both sides."""
    n = counts[0].cumsum(axis=2)
    s = q * n - counts[1].cumsum(axis=2)
    all_n, all_s = n[..., -1:], s[..., -1:]
    ok = (n >= LEAST) & (all_n - n >= LEAST)
    gain = np.where(ok, s**2 / np.maximum(n, 1) + (all_s - s) ** 2 / np.maximum(all_n - n, 1) - all_s**2 / np.maximum(all_n, 1), 0.0)
    at = gain.argmax(axis=2)
    top = np.take_along_axis(gain, at[..., None], axis=2)[..., 0]
    feature, cut = np.full(len(gain), -1), np.zeros(len(gain), dtype=np.int64)
    for leaf in range(len(gain)):
        best = 1e-9
        for j in range(gain.shape[1]):  # of equal gains the first feature
            if top[leaf, j] > best * (1 + 1e-9):
                best, feature[leaf], cut[leaf] = top[leaf, j], j, at[leaf, j]
    return feature, cut


class _Stop:
    """Keeps how many trees were best on the rows set aside."""

    def __init__(self) -> None:
        self.best, self.kept, self.since = np.inf, 0, 0

    def met(self, loss: float, trees: int) -> bool:
        self.best, self.kept, self.since = (loss, trees, 0) if loss < self.best else (self.best, self.kept, self.since + 1)
        return self.since >= PATIENCE


def pinball(d: np.ndarray, q: float) -> np.ndarray:
    return np.maximum(q * d, (q - 1) * d)


def boost(bins: np.ndarray, y: np.ndarray, m: int, n: int, q: float, rounds: int = ROUNDS) -> np.ndarray:
    """Values of the rows from ``n`` on, learned from the first ``m`` and stopped by those between."""
    value = np.full(len(bins), np.quantile(y[:m], q))
    stop, kept = _Stop(), value[n:].copy()
    for r in range(rounds):
        met = stop.met(pinball(y[m:n] - value[m:n], q).mean(), r)
        if stop.kept == r:
            kept = value[n:].copy()
        if met:
            break
        low = y[:m] <= value[:m]
        feature, cut = np.full((1 << DEPTH) - 1, -1), np.zeros((1 << DEPTH) - 1, dtype=np.int64)
        leaf, rows = np.zeros(m, dtype=np.int64), np.arange(m)
        counts = counts_of(bins[:m], leaf, low, 1)
        for d in range(DEPTH):
            begin, width = (1 << d) - 1, 1 << d
            feature[begin : begin + width], cut[begin : begin + width] = best_splits(counts, q)
            f = feature[begin + leaf]
            leaf = 2 * leaf + ((f >= 0) & (bins[rows, np.maximum(f, 0)] > cut[begin + leaf]))
            if d + 1 < DEPTH:
                # Of two sister leaves the smaller is counted; the other is the rest of their parent.
                size = np.bincount(leaf, minlength=2 * width)
                small = np.where(size[0::2] <= size[1::2], 0, 1)
                some = np.flatnonzero((leaf & 1) == small[leaf >> 1])
                part = counts_of(bins[some], leaf[some] >> 1, low[some], width)
                both = np.stack([part, counts - part], axis=2)
                counts = np.where(small[None, :, None, None, None] == 0, both, both[:, :, ::-1]).reshape(2, 2 * width, *counts.shape[2:])
        order = np.argsort(leaf, kind="stable")
        left = (y[:m] - value[:m])[order]
        edges = np.searchsorted(leaf[order], np.arange((1 << DEPTH) + 1))
        steps = np.array([np.quantile(left[a:b], q) if b > a else 0.0 for a, b in zip(edges[:-1], edges[1:], strict=True)])
        value += RATE * steps[leaf_of(bins, (feature, cut), DEPTH)]
    return kept


def bin_edges(x: np.ndarray) -> list[np.ndarray]:
    return [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]


def binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.column_stack([np.searchsorted(e, x[:, j]) for j, e in enumerate(edges)]).astype(np.uint8)


# --- groups that a task can take ------------------------------------------------------------------


def _in_tasks(rows: DataFrame, by: list[str], types: str) -> DataFrame:
    rounds, stop_days, stop_rows, stop_train = ROUNDS, C.STOP_DAYS, C.STOP_ROWS, C.STOP_TRAIN

    def pack(table: pa.Table) -> pa.Table:
        asked = table.column("asked").to_numpy()
        when = table.column("valid_time").cast(pa.int64()).to_numpy()
        lead = table.column("lead_h").to_numpy()
        order = np.lexsort((lead, when, asked))
        n = int((~asked).sum())
        when = when[order]
        m = int((when[:n] < when[n - 1] - stop_days * 86_400_000_000).sum()) if n else 0
        if n - m < stop_rows or m < stop_train:
            m = int(n * 0.85)
        y = table.column("obs").to_numpy()[order]
        x = [c.flatten().to_numpy(zero_copy_only=False).reshape(len(c), -1) for c in table.column("x").chunks if len(c)]
        small = np.empty((len(y), x[0].shape[1]), dtype=np.uint8)
        for j in range(small.shape[1]):  # a feature at a time, since rows are eight bytes a feature
            own = np.concatenate([c[:, j] for c in x])[order][:, None]
            small[:, j] = binned(own, bin_edges(own[:m]))[:, 0]
        one = {k: table.column(k).slice(0, 1) for k in by}
        data = {"m": m, "n": n, "bins": small.tobytes(), "y": y.astype(np.float64).tobytes(), "asked_time": when[n:].tolist(), "asked_lead": lead[order][n:].tolist()}
        return pa.table(one | {k: pa.array([v], {"m": pa.int32(), "n": pa.int32(), "bins": pa.binary(), "y": pa.binary(), "asked_time": pa.list_(pa.int64()), "asked_lead": pa.list_(pa.int32())}[k]) for k, v in data.items()})

    packed = stored(rows.groupBy(*by).applyInArrow(pack, f"{types}, m int, n int, bins binary, y binary, asked_time array<bigint>, asked_lead array<int>"), "packed")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                get = lambda k: batch.column(k)[i].as_py()  # noqa: B023, E731
                y, q = np.frombuffer(get("y")), get("level")
                bins = np.frombuffer(get("bins"), dtype=np.uint8).reshape(len(y), -1)
                m, n = get("m"), get("n")
                value = boost(bins, y, m, n, q, rounds)
                column = [pa.array([batch.column(k)[i].as_py()] * len(value), batch.column(k).type) for k in by]
                times = pa.array(np.array(get("asked_time"), dtype="datetime64[us]")).cast(pa.timestamp("us", "UTC"))
                yield pa.RecordBatch.from_arrays([*column, pa.array(np.full(len(value), q)), times, pa.array(get("asked_lead"), pa.int32()), pa.array(y[n:], from_pandas=True), pa.array(value)], names=[*by, "level", "valid_time", "lead_h", "obs", "value"])

    levels = packed.where("size(asked_time) > 0").withColumn("level", F.explode(F.array(*[F.lit(q) for q in C.LEVELS])))
    levels = levels.select(*by, "level", "m", "n", "bins", "y", "asked_time", "asked_lead")
    n = max(1, len(C.LEVELS) * packed.count())  # a task a group and level, up to the cluster's usual number
    parts = min(n, 40 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return levels.repartition(parts, *by, "level").mapInArrow(fit, f"{types}, level double, valid_time timestamp, lead_h int, obs double, value double")


# --- groups that are too large --------------------------------------------------------------------


def _ordered(v: np.ndarray) -> np.ndarray:
    """Doubles as integers in the same order."""
    u = (v + 0.0).view(np.uint64)
    return np.where(u >> np.uint64(63), ~u, u | np.uint64(1 << 63))


def _double(u: np.ndarray) -> np.ndarray:
    return np.where(u >> np.uint64(63), u & np.uint64((1 << 63) - 1), ~u).view(np.float64)


def _order_statistics(count: Callable, ranks: np.ndarray) -> np.ndarray:
    """The values of ``ranks`` (-1: none), from ``count(prefix, shift)``: how many values of each target's key lie in each of the 2^bits ranges below ``prefix``."""
    prefix, left = np.zeros(ranks.shape, dtype=np.uint64), ranks.copy()
    shift = 64
    while shift > 0:
        bits = min(_BITS, shift)
        shift -= bits
        counts = count(prefix, shift, bits)  # (*ranks.shape, 2^bits)
        upto = counts.cumsum(axis=-1)
        at = np.minimum((upto <= left[..., None]).sum(axis=-1), (1 << bits) - 1)
        before = np.where(at > 0, np.take_along_axis(upto, np.maximum(at - 1, 0)[..., None], axis=-1)[..., 0], 0)
        left = left - before
        prefix = (prefix << np.uint64(bits)) | at.astype(np.uint64)
    return _double(prefix)


def _count_below(values: np.ndarray, prefix: np.ndarray, shift: int, bits: int) -> np.ndarray:
    """(targets, 2^bits) counts of sorted integers within the ranges below each prefix."""
    low = (prefix[:, None] << np.uint64(bits)) | np.arange(1 << bits, dtype=np.uint64)
    begin = np.searchsorted(values, low << np.uint64(shift))
    last = (low << np.uint64(shift)) | np.uint64((1 << shift) - 1)
    return np.searchsorted(values, last, "right") - begin


def _quantile(count: Callable, sizes: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Quantiles between the two nearest order statistics, of keys with ``sizes`` values; 0 for keys without any."""
    at = (np.maximum(sizes, 1) - 1) * q
    low = np.floor(at).astype(np.int64)
    high = np.minimum(low + 1, np.maximum(sizes - 1, 0))
    found = _order_statistics(count, np.stack([low, high], axis=-1))
    out = found[..., 0] + (found[..., 1] - found[..., 0]) * (at - low)
    return np.where(sizes > 0, out, 0.0)


class _Passes:
    """Counts over the rows of large groups: each batch in its task, sums by (group, cell) in Spark."""

    def __init__(self, rows: DataFrame, groups: int):
        self.rows, self.groups = rows, groups

    def sums(self, work: Callable, size: int) -> np.ndarray:
        """(groups, size) totals of ``work(group, columns)``, an integer array of ``size`` per batch and group."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = batch.column("grp").to_numpy()
                for g in np.unique(own):
                    part = batch.filter(pa.array(own == g))
                    cells = work(int(g), part)
                    at = np.flatnonzero(cells)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), g, dtype=np.int32)), pa.array(at.astype(np.int64)), pa.array(cells[at].astype(np.int64))], names=["grp", "cell", "n"])

        out = np.zeros((self.groups, size), dtype=np.int64)
        for r in self.rows.mapInArrow(run, "grp int, cell long, n long").groupBy("grp", "cell").agg(F.sum("n").alias("n")).toLocalIterator():
            out[r["grp"], r["cell"]] = r["n"]
        return out


def _x(part: pa.RecordBatch) -> np.ndarray:
    return part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)


def _state(part: pa.RecordBatch, edges: list, base: float, trees: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins, observations and present values of a batch."""
    bins = binned(_x(part), edges)
    value = np.full(len(bins), base)
    for tree, steps in trees:
        value += RATE * steps[leaf_of(bins, tree, DEPTH)]
    return bins, part.column("obs").to_numpy(), value


def _over_rows(rows: DataFrame, by: list[str], types: str, keys: list[tuple]) -> DataFrame:
    """The same trees for ``keys``, groups of any size, by passes over the rows."""
    spark = rows.sparkSession
    names = spark.createDataFrame([(*k, i) for i, k in enumerate(keys)], f"{types}, grp int")
    mine = rows.join(F.broadcast(names), by)
    known = mine.where("NOT asked")
    last = known.groupBy("grp").agg(F.max("valid_time").alias("__last"), F.count("*").alias("__n"))
    cut = known.join(F.broadcast(last), "grp").withColumn("stop", F.col("valid_time") >= F.col("__last") - F.make_dt_interval(F.lit(C.STOP_DAYS)))
    few = cut.groupBy("grp").agg(F.sum(F.col("stop").cast("int")).alias("s"), F.sum((~F.col("stop")).cast("int")).alias("m"), F.percentile_approx(F.unix_micros("valid_time"), 0.85, 10_000).alias("t"))
    few = few.where((F.col("s") < C.STOP_ROWS) | (F.col("m") < C.STOP_TRAIN)).select("grp", "t")
    cut = cut.join(F.broadcast(few), "grp", "left").withColumn("stop", F.when(F.col("t").isNotNull(), F.unix_micros("valid_time") > F.col("t")).otherwise(F.col("stop")))
    train = stored(cut.select("grp", "x", "obs", "stop"), "large")
    groups, levels = len(keys), C.LEVELS
    learn, aside = _Passes(train.where("NOT stop"), groups), _Passes(train.where("stop"), groups)
    sizes = {r["grp"]: r["n"] for r in train.where("NOT stop").groupBy("grp").agg(F.count("*").alias("n")).collect()}  # GROUPS rows at most
    m = np.array([sizes.get(g, 0) for g in range(groups)])
    width = len(train.select("x").first()[0])
    # Bin edges and start values: quantiles of each feature and of the observations.
    wanted = np.linspace(0, 1, BINS + 1)[1:-1]
    q = np.concatenate([np.tile(wanted, (width, 1)).ravel(), np.array(levels)])[None, :]

    def of_columns(prefix: np.ndarray, shift: int, bits: int) -> np.ndarray:
        def work(g: int, part: pa.RecordBatch) -> np.ndarray:
            x, y = _x(part), part.column("obs").to_numpy()
            out = [_count_below(np.sort(_ordered(x[:, j].copy())), prefix[g].reshape(-1, 2)[j * len(wanted) : (j + 1) * len(wanted)].ravel(), shift, bits) for j in range(width)]
            out.append(_count_below(np.sort(_ordered(y.astype(float).copy())), prefix[g].reshape(-1, 2)[width * len(wanted) :].ravel(), shift, bits))
            return np.concatenate(out).ravel()

        return learn.sums(work, prefix[0].size << bits).reshape(*prefix.shape, 1 << bits)

    starts = _quantile(of_columns, np.repeat(m[:, None], q.shape[1], axis=1), q)
    edges = [[np.unique(starts[g, j * len(wanted) : (j + 1) * len(wanted)]) for j in range(width)] for g in range(groups)]
    base = starts[:, width * len(wanted) :]
    trees: list = [[[] for _ in levels] for _ in range(groups)]
    stops = [[_Stop() for _ in levels] for _ in range(groups)]
    open_ = {(g, k) for g in range(groups) for k in range(len(levels)) if m[g]}
    leaves, nodes = 1 << DEPTH, (1 << DEPTH) - 1
    for r in range(ROUNDS):

        def losses(g: int, part: pa.RecordBatch) -> np.ndarray:
            # In millionths, since sums of integers don't depend on their order.
            out = np.zeros(2 * len(levels))
            for k, level in enumerate(levels):
                if (g, k) in open_:
                    _, y, value = _state(part, edges[g], base[g, k], trees[g][k])
                    out[2 * k : 2 * k + 2] = np.round(pinball(y - value, level) * 1e6).sum(), len(y)
            return out

        loss = aside.sums(losses, 2 * len(levels)).reshape(groups, len(levels), 2)
        open_ = {(g, k) for g, k in open_ if not stops[g][k].met(loss[g, k, 0] / max(loss[g, k, 1], 1), r)}
        if not open_:
            break
        grown = {gk: (np.full(nodes, -1), np.zeros(nodes, dtype=np.int64)) for gk in open_}
        for d in range(DEPTH):
            size = 2 * (1 << d) * width * BINS

            def cells(g: int, part: pa.RecordBatch, d: int = d, size: int = size) -> np.ndarray:
                out = np.zeros((len(levels), size), dtype=np.int64)
                for k in range(len(levels)):
                    if (g, k) in open_:
                        bins, y, value = _state(part, edges[g], base[g, k], trees[g][k])
                        out[k] = counts_of(bins, leaf_of(bins, grown[g, k], d), y <= value, 1 << d).ravel()
                return out.ravel()

            counts = learn.sums(cells, len(levels) * size).reshape(groups, len(levels), 2, 1 << d, width, BINS)
            for g, k in open_:
                at = slice((1 << d) - 1, (1 << (d + 1)) - 1)
                grown[g, k][0][at], grown[g, k][1][at] = best_splits(counts[g, k], levels[k])

        def held(g: int, part: pa.RecordBatch) -> np.ndarray:
            out = np.zeros((len(levels), leaves), dtype=np.int64)
            for k in range(len(levels)):
                if (g, k) in open_:
                    out[k] = np.bincount(leaf_of(binned(_x(part), edges[g]), grown[g, k], DEPTH), minlength=leaves)
            return out.ravel()

        rows_in = learn.sums(held, len(levels) * leaves).reshape(groups, len(levels), leaves)

        def of_leaves(prefix: np.ndarray, shift: int, bits: int) -> np.ndarray:
            def work(g: int, part: pa.RecordBatch) -> np.ndarray:
                out = np.zeros((len(levels), leaves, 2, 1 << bits), dtype=np.int64)
                for k in range(len(levels)):
                    if (g, k) in open_:
                        bins, y, value = _state(part, edges[g], base[g, k], trees[g][k])
                        leaf, left = leaf_of(bins, grown[g, k], DEPTH), _ordered(y - value)
                        for i in np.unique(leaf):
                            out[k, i] = _count_below(np.sort(left[leaf == i]), prefix[g, k, i], shift, bits)
                return out.ravel()

            return learn.sums(work, prefix[0].size << bits).reshape(*prefix.shape, 1 << bits)

        steps = _quantile(of_leaves, rows_in, np.array(levels)[None, :, None])
        for g, k in open_:
            trees[g][k].append((grown[g, k], steps[g, k]))
    final = {(g, k): trees[g][k][: stops[g][k].kept] for g in range(groups) for k in range(len(levels))}

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column("grp").to_numpy()
            for g in np.unique(own):
                part = batch.filter(pa.array(own == g))
                for k, level in enumerate(levels):
                    value = _state(part, edges[g], base[g, k], final[g, k])[2]
                    columns = [part.column(c) for c in by]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(np.full(len(value), level)), part.column("valid_time"), part.column("lead_h"), part.column("obs"), pa.array(value)], names=[*by, "level", "valid_time", "lead_h", "obs", "value"])

    asked = mine.where("asked").select(*by, "grp", "valid_time", "lead_h", "obs", "x")
    return asked.mapInArrow(predict, f"{types}, level double, valid_time timestamp, lead_h int, obs double, value double")


def boosted_quantiles(train: DataFrame, test: DataFrame, by: list[str], features: list[Column]) -> DataFrame:
    """``test`` rows with one boosted quantile per level, learned from all ``train`` rows of their group.

    The last ``config.STOP_DAYS`` days of training (the last 15% where these are few) say after how many trees to stop. Groups of fewer than
    ``config.BOOSTED_ROWS`` rows have no result.
    """
    columns = [*by, "valid_time", "lead_h", F.array(*features).alias("x"), "obs"]
    known = train.where("obs IS NOT NULL AND fc_mean IS NOT NULL")
    rows = known.select(*columns, F.lit(False).alias("asked")).unionByName(test.where("fc_mean IS NOT NULL").select(*columns, F.lit(True).alias("asked")))
    rows = stored(rows, "boosted")
    types = ", ".join(f"{k} {t}" for k, t in rows.select(*by).dtypes)
    sizes = stored(rows.groupBy(*by).agg(F.count("*").alias("__all"), F.sum((~F.col("asked")).cast("long")).alias("__n")).where(F.col("__n") >= C.BOOSTED_ROWS), "sizes")
    out = _in_tasks(rows.join(sizes.where(F.col("__all") <= IN_TASK).select(*by), by), by, types)
    large = sizes.where(F.col("__all") > IN_TASK).select(*by)
    place = large.withColumn("__i", F.row_number().over(W.orderBy(*by)) - 1)  # groups that are too large for a task, a row each
    for begin in range(0, large.count(), GROUPS):
        keys = [tuple(r[k] for k in by) for r in place.where((F.col("__i") >= begin) & (F.col("__i") < begin + GROUPS)).collect()]
        out = out.unionByName(_over_rows(rows, by, types, keys))
    return out
