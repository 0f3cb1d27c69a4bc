"""Ranked search against its SQL and a plain version, with small buckets, blocks and odd rows."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from stratocast.llm import lemp

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


def brute(docs, items, k=10):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b, sum(b.values())) for d, b in bags if b]
    n_docs, n_terms = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * f + 1))) for t, f in df.items()}
    out = []
    for item, text in items:
        scored = []
        for d, b, n in bags:
            m = 25 + (75 * n * n_docs) // n_terms
            score = sum(weight[t] * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t in terms(text) if t in b)
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(item, i, None if null else d, -s) for i, (s, null, d) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def search(spark, docs, items, k=10):
    d, i = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    return sorted((tuple(r) for r in lemp.rank_documents(d, i, k).collect()), key=repr)


@pytest.mark.parametrize(("bucket", "block", "rounds"), [(2048, 1 << 20, (0.02, 0.2, 1.0)), (7, 40, (0.1, 0.5, 1.0)), (3, 1 << 20, (1.0,))])
def test_ranks_are_those_of_brute_force(spark, monkeypatch, bucket, block, rounds):
    monkeypatch.setattr(lemp, "BUCKET", bucket)
    monkeypatch.setattr(lemp, "BLOCK", block)
    monkeypatch.setattr(lemp, "ROUNDS", rounds)
    rnd = random.Random(bucket)
    words = [f"w{i}" for i in range(60)] + ["Élan", "ß", "x1", "THE", "the", "日本"]
    draw = lambda n: " ".join(rnd.choices(words, [1 / (1 + i) for i in range(len(words))], k=n))
    docs = [(i, draw(rnd.randrange(1, 80))) for i in range(300)]
    docs += [(i + 1000, docs[i % 3][1]) for i in range(40)]  # copies tie
    items = [(i, draw(rnd.randrange(1, 15))) for i in range(20)] + [(99, docs[5][1])]
    assert search(spark, docs, items) == brute(docs, items)


def test_odd_rows(spark):
    long_text = " ".join(f"word{i % 977}" for i in range(60_000))
    docs = [(1, "alpha beta"), (1, "alpha beta"), (2, None), (3, ""), (None, "alpha, Beta!"), (4, long_text), (5, " \t--\n"), (6, "ALPHA-beta_alpha"), (7, "é É"), (-3, "gamma")]
    items = [(10, "Alpha"), (10, "Alpha"), (11, None), (12, "?!"), (None, "word7 beta"), (13, "nowhere"), (14, long_text), (15, "É")]
    assert search(spark, docs, items) == brute(docs, items)
    assert search(spark, docs, items, k=1) == brute(docs, items, k=1)


def test_sql_agrees_on_odd_rows(spark, tmp_path):
    docs = [(1, "alpha beta"), (2, "alpha beta beta"), (3, None), (4, "Gammaé x"), (5, "alpha"), (None, "beta x")]
    items = [(1, "beta alpha beta"), (2, "gammaé"), (3, None), (None, "x")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    want = sorted(con.execute(lemp.ORACLE_SQL).fetchall(), key=repr)
    assert sorted((tuple(r) for r in lemp.op13_lemp(spark, str(tmp_path)).collect()), key=repr) == want == brute(docs, items)


def test_empty_tables(spark):
    assert search(spark, [], [(1, "alpha")]) == [] and search(spark, [(1, "alpha")], []) == []


def test_bounds_keep_all_that_can_be_among_the_best():
    rng = np.random.default_rng(3)
    for _ in range(30):
        queries = [(i, np.unique(rng.integers(0, 40, 12)).astype(np.uint64), None) for i in range(5)]
        queries = [(i, t, rng.integers(1, 3, len(t))) for i, t, _ in queries]
        block = lemp.Block(queries)
        block.weigh(rng.integers(1, 100, len(block.vocabulary)), 100, 5000)
        held = [np.flatnonzero(rng.random(len(block.vocabulary)) < 0.3) for _ in range(50)]
        lengths, flat = np.array([len(h) for h in held]), np.concatenate(held)
        impact = rng.integers(0, 10**7, len(flat))
        doc = np.repeat(np.arange(50), lengths)
        norm = np.sqrt(np.bincount(doc, weights=impact.astype(float) ** 2, minlength=50))
        full = np.zeros((5, 50), dtype=np.int64)
        for i in range(5):
            weight = np.zeros(len(block.vocabulary), dtype=np.int64)
            weight[block.term[block.first[i] : block.first[i + 1]]] = block.count[block.first[i] : block.first[i + 1]]
            np.add.at(full[i], doc, weight[flat] * impact)
        least = np.sort(full, axis=1)[:, -8].clip(1)
        for i, found, score in lemp._search_bucket(block, least.copy(), 5, np.arange(50), flat, lengths, impact, norm):
            top = np.lexsort((np.arange(50), -full[i]))[:5]
            assert set(top[full[i][top] > 0]) <= set(found.tolist()) and (score == full[i][found]).all()
