"""Conversation tries against a plain dictionary of prefixes, with small containers and segments, and against their SQL."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import pytest

from stratocast.llm import trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    own = {c: [(role, text) for *_, role, text in sorted(v)] for c, v in own.items()}
    words = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        words[c] = tuple(own.get(c - (c % 100 if c >= 0 else -(-c % 100)), [])[:h] + own[c][h:])
    members = defaultdict(list)
    for c, w in words.items():
        for d in range(len(w) + 1):
            members[w[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[x] for x in children[node]) or 1
        saved[node] = sum(saved[x] for x in children[node]) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    out = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(words[c]) == len(node)))
        out.append((min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def made(seed):
    rnd = random.Random(seed)
    rows = []
    for c in [*range(0, 60), *range(100, 130), 205, 300, *range(-120, -95)]:
        for t in range(rnd.choice([1, 2, 3, 5, 8, 9, 13])):
            rows.append((c, t, "user" if t % 2 else None, rnd.choice(["a", "bé", "", None]) if rnd.random() < 0.25 else "same"))
    for c in range(1000, 1040):  # many that are alike
        rows += [(c, t, "user", f"turn {t}") for t in range(9)]
    for c in range(1040, 1060):  # and part late
        rows += [(c, t, "user", f"turn {t}") for t in range(8)] + [(c, 8, "user", str(c % 5))]
    rows += [(7, None, "user", "x"), (7, None, None, "y"), (8, 3, "user", "tie"), (8, 3, "user", "other tie"), (8, 3, "user", "tie"), (None, 1, "user", "no conversation")]
    rnd.shuffle(rows)
    return rows


def found(spark, rows):
    turns = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, depth int")
    return sorted((tuple(r) for r in trie.conversation_trie(turns).select(COLUMNS).collect()), key=repr)


@pytest.mark.parametrize(("limit", "skip", "segment"), [(512, 64, 1 << 18), (1, 2, 1 << 18), (4, 64, 3), (2, 1, 2)])
def test_nodes_are_those_of_all_prefixes(spark, monkeypatch, limit, skip, segment):
    monkeypatch.setattr(trie, "LIMIT", limit)
    monkeypatch.setattr(trie, "SKIP", skip)
    monkeypatch.setattr(trie, "SEGMENT", segment)
    rows = made(limit)
    assert found(spark, rows) == brute(rows)


def test_sql_agrees(spark, tmp_path):
    rows = made(11)
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    want = sorted(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({trie.ORACLE_SQL})").fetchall(), key=repr)
    assert sorted((tuple(r) for r in trie.op11_trie(spark, str(tmp_path)).select(COLUMNS).collect()), key=repr) == want == brute(rows)


def test_empty_and_long(spark):
    assert found(spark, []) == []
    rows = [(c, t, "user", "x" * (t % 3)) for c in (5, 105) for t in range(3000)] + [(1, 0, "user", None)]
    assert found(spark, rows) == brute(rows)
