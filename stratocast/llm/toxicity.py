"""Toxicity by compression distance.

Zstandard dictionaries are trained on ordinary and on toxic text: all hold the same ordinary passages; a toxic one also holds what labelled toxic
documents have and ordinary ones lack (found by document frequencies over all labelled rows), in place of digits
of equal length in the ordinary one, so that windows without such words take about the same bytes with either. There are two toxic
ones, for terms that ordinary documents hardly ever have (strong) and for those that they have less often (weak). A text is cut into short
windows over its whole length; each is encoded with all three, and the bytes that a toxic dictionary saves are its gain. How many windows gain,
against the length of the text, gives the score; the weights are calibrated on labelled rows that no dictionary has seen.

Bounds (documented parameters): ``ordinary_docs`` passages of ``passage`` characters, ``terms`` toxic terms. All
labelled rows count for frequencies and calibration; all texts are scored whole.

Defined cases: null and empty texts get the score of a text without any gain; labels that are null are not learned from; a
document with several labels is learned once per label row; without toxic or without ordinary labels every score is the share of toxic
labels (0 if there are none); other columns pass unchanged (columns named like the results are replaced).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratocast.llm._common import bucket_of, materialize, slices
from stratocast.llm.compression import Coder, windows

WIDTH = 56
RESULTS = ("n_windows", "n_strong", "n_weak")
#: Bytes from which a gain counts.
GAIN = 3
#: Letters of any script; a term is a word or the first characters of one.
LETTERS = r"[^\p{L}]+"
PREFIXES = (5, 6)
#: Labels up to which they are broadcast (12 bytes each).
LABELS = 2_000_000


def distinctive_terms(labelled: DataFrame, terms: int = 400, least: int = 3) -> tuple[list[str], list[str]]:
    """Words and word beginnings that toxic documents have significantly more often (G statistic), the most significant last: strong and weak ones."""
    n = {r["toxic"]: r["n"] for r in labelled.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n1, n0 = float(n.get(1, 0)), float(n.get(0, 0))
    words = F.filter(F.split(F.lower("text"), LETTERS), lambda w: F.length(w) >= 3)
    parts = F.concat(words, *[F.transform(F.filter(words, lambda w, k=k: F.length(w) > k), lambda w, k=k: F.concat(F.substring(w, 1, k), F.lit("*"))) for k in PREFIXES])
    seen = labelled.select("toxic", F.explode(F.array_distinct(parts)).alias("term")).groupBy("term").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("o"))
    seen = materialize(seen, "term_counts")
    t, o = F.col("t").cast("double"), F.col("o").cast("double")
    expected = (t + o) * F.lit(n1 / (n1 + n0))
    strength = t * F.log(t / expected) + F.when(o > 0, o * F.log(o / (t + o - expected))).otherwise(0.0)
    chance = 0.75 * math.log(max(seen.count(), 2))  # about what the best of so many terms reaches by chance
    rows = seen.where((t >= least) & (t > 3 * expected)).withColumn("g", strength).where(F.col("g") >= chance).orderBy(F.desc("g"), "term").limit(terms).collect()
    strong = [r["t"] >= 10 * (r["o"] * n1 / n0 + 1) for r in rows]
    return tuple([r["term"].rstrip("*") for r, x in zip(reversed(rows), reversed(strong), strict=True) if x == kind] for kind in (True, False))


def ordinary_passages(labelled: DataFrame, ordinary_docs: int = 96, passage: int = 320, seed: int = 9) -> str:
    """Passages of ordinary documents drawn by a seeded hash."""
    plain = labelled.where(F.col("toxic") == 0)
    n = plain.count()
    u = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = plain.withColumn("u", u).where(F.col("u") * n <= 4 * ordinary_docs).orderBy("u", "doc_id").limit(ordinary_docs).select(F.lower(F.substring("text", 1, passage)).alias("p")).collect()
    return "\n".join(r["p"] for r in rows)


def compression_gains(docs: DataFrame, ordinary: str, strong: list[str], weak: list[str], level: int = 3) -> DataFrame:
    """``docs`` with the number of windows, and of those that gain ``GAIN`` bytes or more with strong or with weak terms."""
    kept = docs.drop(*RESULTS)
    shared = docs.sparkSession.sparkContext.broadcast((ordinary.encode(), *((" ".join(x) + " ").encode() for x in (strong, weak))))
    schema = T.StructType([*kept.schema.fields, *[T.StructField(x, T.LongType()) for x in RESULTS]])

    def gains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, *extras = shared.value
        width = max(map(len, extras))
        digits = np.random.default_rng(1).integers(48, 58, width, dtype=np.uint8).tobytes()
        coders = [Coder(digits[: width - len(x)] + x + b"\n" + base, level) for x in (digits, *extras)]
        for batch, texts in slices(batches):
            out = np.zeros((3, len(texts)), dtype=np.int64)
            for i, text in enumerate(texts):
                pieces = list(windows(text.decode("utf-8", "replace").lower().encode(), WIDTH))
                plain, *toxic = (np.array(c.sizes(pieces)) for c in coders)
                out[:, i] = len(pieces), *((plain - x >= GAIN).sum() for x in toxic)
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(x) for x in out]], names=[*batch.schema.names, *RESULTS])

    return kept.mapInArrow(gains, schema)


def features() -> list[Column]:
    """What the calibrated score is linear in; every one takes few values, so that the labelled rows fit a small table."""
    size = F.least(F.lit(20), F.floor(F.log2(F.col("n_windows") + 1)))
    strong, weak = F.log1p(F.least(F.lit(24), F.col("n_strong"))), F.log1p(F.least(F.lit(24), F.col("n_weak")))
    return [x.cast("double") for x in (strong, weak, size, strong * size, weak * size, F.when(F.col("n_strong") > 0, 1.0).otherwise(0.0))]


def calibrate(gains: DataFrame) -> list[float]:
    """Weights (constant first) of a logistic score, by Newton steps on the table of distinct feature rows with their label counts."""
    columns = features()
    names = [f"x{i}" for i in range(len(columns))]
    rows = gains.groupBy(*[c.alias(k) for k, c in zip(names, columns, strict=True)]).agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).collect()  # 25 x 25 x 21 rows at most
    x = np.array([[r[k] for k in names] for r in rows])
    t, n = np.array([float(r["t"]) for r in rows]), np.array([float(r["n"]) for r in rows])
    middle, spread = np.average(x, axis=0, weights=n), np.sqrt(np.average((x - np.average(x, axis=0, weights=n)) ** 2, axis=0, weights=n)) + 1e-9
    x = np.column_stack([np.ones(len(x)), (x - middle) / spread])
    ridge = np.diag([1e-6] + [1.0] * len(names))

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return float((n * np.logaddexp(0, z) - t * z).sum() + 0.5 * w @ ridge @ w)

    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (t - n * p) - ridge @ w)
        while loss(w + step) > loss(w) + 1e-12 and np.abs(step).max() > 1e-10:
            step /= 2
        w += step
        if np.abs(step).max() < 1e-9:
            break
    slopes = w[1:] / spread
    return [float(w[0] - slopes @ middle), *map(float, slopes)]


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    rest = bucket_of(F.col("doc_id"), 5)
    learned = labels.where((rest != 0) & F.col("toxic").isin(0, 1))
    few = learned.count() <= LABELS  # so the texts need not be shuffled
    labelled = docs.where(F.col("text").isNotNull() & (rest != 0)).join(F.broadcast(learned) if few else learned, "doc_id")
    labelled = materialize(labelled.withColumn("part", rest), "labelled")
    return score_toxicity(docs, labelled).select("doc_id", (rest == 0).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"), *RESULTS)


def score_toxicity(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """``docs`` with gains and ``score``; ``labelled`` has doc_id, text, toxic (0 or 1) and ``part``, whose odd values calibrate."""
    shares = labelled.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("t")).first()
    fit, held = labelled.where(F.col("part") % 2 == 0), labelled.where(F.col("part") % 2 == 1)
    if not shares["t"] or shares["t"] == shares["n"] or not held.take(1):
        flat = 1.0 if shares["t"] else 0.0
        return docs.drop(*RESULTS).select("*", *[F.lit(0).cast("long").alias(x) for x in RESULTS], F.lit(flat).alias("score"))
    (strong, weak), ordinary = distinctive_terms(fit), ordinary_passages(fit)
    weights = calibrate(compression_gains(held, ordinary, strong, weak))
    linear = F.lit(weights[0])
    for v, x in zip(weights[1:], features(), strict=True):
        linear = linear + F.lit(v) * x
    return compression_gains(docs, ordinary, strong, weak).withColumn("score", 1 / (1 + F.exp(-linear)))
