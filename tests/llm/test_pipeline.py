"""The five stages over the smallest tables and over odd rows, each against a plain version on its own input."""

import collections

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stratocast.llm import decontamination, language_id, secrets

SF = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark, docs):
    """Rows of the table, and nulls in every column, empty and long texts, repeated rows, equal texts, and columns named like results."""
    item = spark.read.parquet(f"{SF}/benchmark.parquet").where("item_id IS NOT NULL AND text IS NOT NULL").first()["text"]
    same = " ".join(f"the word{i % 37} and of {i}" for i in range(60))
    rows = [
        (9001, same, "en", "a", 10),
        (9002, same, "en", "b", 10),
        (9002, same, "en", "b", 10),
        (9003, None, None, None, None),
        (9004, "", "en", "a", 0),
        (None, "the and of it is a text without an id", "en", "a", 40),
        (9005, " ".join(f"the w{i % 991} and" for i in range(20_000)), "en", "a", 9),
        (9006, f"the and of that is {item} and the of", "en", "a", 9),
        (9007, "the password = s3cretvalue9 of and the that is", "en", "zz", 9),
    ]
    more = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = {c: F.lit("x") for c in ("size", "taken", "score", "rejected", "kept", "row", "bucket")}
    return docs.limit(60).unionByName(more.select(docs.columns)).withColumns(clash)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def test_stages_are_in_order(spark, docs):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "secrets", "mixing"]
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, SF)
        assert out.columns == docs.columns, name
        assert out.count() > 0.5 * now.count(), name  # clean documents stay
        now = corpus_pipeline.materialize(out, name)
    taken = corpus_pipeline.mixing_stage(spark, now, SF)
    assert taken.count() and set(docs.columns) < set(taken.columns)


def test_language_stage(spark, odd):
    out = STAGES["language_id"](spark, odd, SF)
    sample = language_id.language_sample(odd.where(F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(4)) != 2).select("doc_id", "text", "lang"))
    coders = [(lang, language_id.Coder(language_id.letters(content))) for lang, _, content in sample]
    want = collections.Counter()
    for r in odd.collect():
        folded = (r["text"] or "").lower()
        if any(c.isalpha() for c in folded):
            pieces = list(language_id.windows(language_id.letters(folded), language_id.WINDOW))
            best, second = sorted(sum(c.size(p) for p in pieces) for _, c in coders)[:2]
            want[tuple(r)] += (second - best) / best >= 0.001
    assert rows_of(out) == sorted((+want).elements(), key=repr)


def test_near_dedup_stage(spark, odd):
    rows = odd.collect()
    sets = {}
    for r in rows:
        ws = (r["text"] or "").encode().lower().split()
        if ws and r["doc_id"] is not None:
            sets[r["doc_id"]] = {tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))}
    root = {d: d for d in sets}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    want = sorted((tuple(r) for r in rows if r["doc_id"] not in sets or find(r["doc_id"]) == r["doc_id"]), key=repr)
    assert rows_of(STAGES["near_dedup"](spark, odd, SF)) == want


def test_decontamination_stage(spark, odd):
    out = {r["doc_id"] for r in STAGES["decontamination"](spark, odd, SF).collect()}
    items = [decontamination._words([r["text"].encode()]).hash.view(np.int64) for r in spark.read.parquet(f"{SF}/benchmark.parquet").where("text IS NOT NULL").collect()]
    for r in odd.collect():
        if len(r["text"] or "") > 20_000:
            continue
        words = decontamination._words([(r["text"] or "").encode()]).hash.view(np.int64)
        best = max((float(decontamination.align(words[None, :], np.array([len(words)]), x)[0]) / (2 * len(x)) for x in items if len(x) and len(words)), default=0.0)
        assert (r["doc_id"] in out) == (best < 0.5), (r["doc_id"], best)
    assert 9006 not in out and {9001, 9003, 9004, None} <= out


def test_secrets_stage(spark, odd):
    out = {r["doc_id"]: r for r in STAGES["secrets"](spark, odd, SF).collect()}
    assert out[9007]["text"] == "the password = [SECRET] of and the that is" and out[9007]["n_chars"] == len(out[9007]["text"])
    found = {r["doc_id"]: r["n"] for r in secrets.find_spans(odd).select("doc_id", (F.size("base") + F.size("extra")).alias("n")).collect()}
    for r in odd.collect():
        if not found[r["doc_id"]]:
            assert out[r["doc_id"]] == r


def test_mixing_stage(spark, odd):
    out = STAGES["mixing"](spark, odd, SF).collect()
    size = collections.Counter()
    for r in odd.collect():
        size[r["source"]] += len((r["text"] or "").encode().split())
    for source, target in {r["source"]: r["target"] for r in out}.items():
        assert sum(r["taken"] for r in out if r["source"] == source) == pytest.approx(target, abs=1)
    assert all(0 < r["taken"] <= 2 * len(r["text"].encode().split()) for r in out)


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_of_an_empty_table(spark, docs, name):
    assert STAGES[name](spark, docs.limit(0), SF).count() == 0


def test_run_agrees_with_its_stages(spark):
    once = sorted((r["doc_id"], r["taken"]) for r in corpus_pipeline.run(spark, SF).collect())
    again = sorted((r["doc_id"], r["taken"]) for r in corpus_pipeline.run(spark, SF).collect())
    assert once == again and len({d for d, _ in once}) == len(once)
