"""Language identification by compression.

For every language a raw-content zstandard dictionary is filled with passages of labelled documents. A
text is encoded with each dictionary, window by window over its whole length, and gets the language with the smallest total. A
text whose margin over the runner-up is narrow is rejected.

Bounds (documented parameters): the labelled sample has ``sample_docs`` documents a language at most, of each of which
``passage`` characters are kept, so that a dictionary is below ``sample_docs * passage`` characters. Everything else covers all rows.

Defined cases: null text, or text without a letter, is ``und`` with score 0 and rejected; labels that are null are not
learned from; if nothing can be learned, all texts are ``und``; equal lengths go to the language with more labelled documents,
then the smaller code; repeated rows get the same result each; other columns pass unchanged (columns
named like the results are replaced).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratocast.llm._common import bucket_of, slices
from stratocast.llm.compression import LETTERS_ONLY, Coder, windows

RESULTS = ("lang_pred", "score", "margin", "rejected")
WINDOW = 8192


def language_sample(labelled: DataFrame, sample_docs: int = 256, passage: int = 400, seed: int = 5) -> list[tuple[str, int, str]]:
    """(language, labelled documents, dictionary content) per label, most frequent first.

    Documents are drawn by a seeded hash: first a share of each language that leaves a few times ``sample_docs`` rows, then the
    first of these in hash order, so that no task holds all documents of a language.
    """
    letters = labelled.where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = letters.groupBy("lang").agg(F.count("*").alias("n"))
    share = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = letters.join(F.broadcast(counts), "lang").withColumn("__u", share).where(F.col("__u") * F.col("n") <= 3 * sample_docs)
    middle = F.greatest(F.lit(1), F.floor((F.length("text") - passage) / 2).cast("int"))
    first = W.partitionBy("lang").orderBy("__u", "doc_id")
    rows = (
        drawn.select("lang", "n", "doc_id", "__u", F.lower(F.substring(F.col("text"), middle, F.lit(passage))).alias("passage"))
        .withColumn("__r", F.row_number().over(first))
        .where(F.col("__r") <= sample_docs)
        .groupBy("lang")
        .agg(F.max("n").alias("n"), F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(F.struct("__r", "passage"))), lambda x: x["passage"])).alias("content"))
        .collect()  # one bounded dictionary per label
    )
    return sorted(((r["lang"], r["n"], r["content"]) for r in rows), key=lambda r: (-r[1], r[0]))


def identify_language(docs: DataFrame, sample: list[tuple[str, int, str]], min_margin: float = 0.001, level: int = 3) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1, grows with the margin), ``margin`` and ``rejected``.

    ``margin`` is the share by which the runner-up is longer; below ``min_margin`` the text is rejected.
    """
    kept = docs.drop(*RESULTS)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast([(lang, content.encode()) for lang, _, content in sample])
    schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("margin", T.DoubleType()), T.StructField("rejected", T.BooleanType())])

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x for x, _ in shared.value]
        coders = [Coder(letters(content.decode()), level) for _, content in shared.value]
        for batch, texts in slices(batches):
            found = [_best(x, names, coders) for x in texts]
            arrays = [pa.array(x, t) for x, t in zip(zip(*found, strict=True), (pa.string(), pa.float64(), pa.float64()), strict=True)]
            rejected = pa.array([x[0] == "und" or x[2] < min_margin for x in found], pa.bool_())
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays, rejected], names=[*batch.schema.names, *RESULTS])

    return kept.mapInArrow(classify, schema)


def letters(folded: str) -> bytes:
    """The words alone: what junk, digits and punctuation add says nothing of the language."""
    return b" ".join(folded.encode().translate(LETTERS_ONLY).split())


def _best(text: bytes, names: list[str], coders: list[Coder]) -> tuple[str, float, float]:
    folded = text.decode("utf-8", "replace").lower()
    if not names or not any(c.isalpha() for c in folded):
        return "und", 0.0, 0.0
    pieces = list(windows(letters(folded), WINDOW))
    totals = [sum(c.sizes(pieces)) for c in coders]
    order = sorted(range(len(totals)), key=totals.__getitem__)
    if len(order) == 1:
        return names[0], 1.0, 1.0
    best, second = totals[order[0]], totals[order[1]]
    # Evidence in bytes, tempered by the length: long texts differ by many bytes in any case.
    score = 1.0 / (1.0 + math.exp(-(second - best) / (1.0 + 0.005 * best)))
    return names[order[0]], score, (second - best) / max(best, 1)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held_out = bucket_of(F.col("doc_id"), 4) == 2
    sample = language_sample(docs.where(~held_out).select("doc_id", "text", "lang"))
    out = identify_language(docs.select("doc_id", "text"), sample)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "margin", "rejected")
