"""Personal data against the plain patterns, its SQL, and odd rows."""

import hashlib
import random
import re
import time

import duckdb
import pandas as pd
import pytest

from stratocast.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def base_spans(text):
    found = []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".") if kind == "ip"), "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}
            if good[kind]:
                found.append((m.start(), rank, kind, m.end()))
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)]


ODD = [
    None,
    "",
    "a@b.c%d@e.f x.y@z @a.b ..@q.w-.1 é@ü.de plus+tag@mail-1.example.co.uk, a@b.c.",
    "1.2.3.4.5.6.7.8 999.1.1.1 0255.01.000.1 1.2.3 10.0.0.256 1.1.1.1.",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 and 4111  1111 5500005555555559 3400 0000 0000 009",
    "+1 (988) 555-2485 +49 30 1234567 +1 2 +123456789012345678 ++1-800-555-0199 tel",
    "transfer to IBAN GB82 WEST 1234 5698 7654 32, or DE89370400440532013000; bad: DE89370400440532013001; XGB82 WEST 1234 5698 7654 32",
    "ssn 078-05-1120 and taxpayer 000-12-3456; plain and far enough from any of those words 078-05-1121 elsewhere; call (212) 555-0142 or 212.555.0143x",
    "😀 Mail: a@b.cd 😀 192.168.1.1 example 8.8.8.8 😀😀 visa 4111111111111111",
    "7" * 2_000 + " " + "8-" * 1_000 + " " + "a" * 2_000 + " " + "x@" * 500 + " " + "1." * 500 + "b@" + "c." * 500,
    "a@b.cd " * 5_000,
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, i) for i, t in enumerate(ODD)] + [(None, "no id a@b.cd", 1), (2, ODD[2], 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, pii int").coalesce(1)


def digest(spans):
    return hashlib.sha256(",".join(spans).encode()).hexdigest()


def test_base_spans_are_those_of_the_plain_patterns(spark, tmp_path, docs):
    docs.drop("pii").write.parquet(str(tmp_path / "documents.parquet"))
    got = pii.op12_pii(spark, str(tmp_path)).collect()
    assert len(got) == len(ODD) + 2
    texts = dict(enumerate(ODD)) | {None: "no id a@b.cd"}
    for r in got:
        want = base_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == digest(want)
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(x.startswith(k + ":") for x in want) for k in PLAIN]
        assert set(want) <= set(r["spans"].split(","))


def test_base_spans_of_random_texts(spark, tmp_path):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(["1", "25", "4111", "a", ".", "@", "-", " ", "+", "(", ")", "%", "é", "0", "555"]) for _ in range(rnd.randrange(400))) for _ in range(300)]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    for r in pii.op12_pii(spark, str(tmp_path)).collect():
        assert r["base_sha256"] == digest(base_spans(texts[r["doc_id"]]))


def test_sql_agrees_on_odd_rows(spark, tmp_path, docs):
    docs.drop("pii").write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.execute(pii.ORACLE_SQL).df()
    got = pii.op12_pii(spark, str(tmp_path)).toPandas()
    by = ["doc_id", "spans"]
    pd.testing.assert_frame_equal(got.sort_values(by).reset_index(drop=True), want[list(got.columns)].sort_values(by).reset_index(drop=True), check_dtype=False)


def test_checksums_and_context(spark, docs):
    rows = {r["doc_id"]: r["pii"] for r in pii.find_pii(docs.where("doc_id IN (6, 7, 8)")).collect()}
    added = {k: [(s["kind"], s["value"]) for s in v if s["added"]] for k, v in rows.items()}
    assert added[6] == [("iban", "GB82 WEST 1234 5698 7654 32"), ("iban", "DE89370400440532013000")]
    assert added[7] == [("ssn", "078-05-1120"), ("local", "(212) 555-0142")]
    scores = {(s["kind"], s["value"]): s["score"] for s in rows[8]}
    assert scores[("ip", "8.8.8.8")] == 10 and scores[("ip", "192.168.1.1")] == 10 and scores[("card", "4111111111111111")] == 60 and scores[("email", "a@b.cd")] == 100


def test_known_checksums():
    assert [pii.luhn(x) for x in ("4111111111111111", "4111111111111112", "378282246310005")] == [True, False, True]
    assert [pii.mod97(x) for x in ("GB82WEST12345698765432", "GB82WEST12345698765433", "NO9386011117947")] == [True, False, True]


def test_redaction(spark, docs):
    got = {r["doc_id"]: r for r in pii.redact_pii(docs.where("doc_id IN (0, 4, 8)")).collect()}
    assert got[8]["text"] == "😀 Mail: [EMAIL] 😀 192.168.1.1 example 8.8.8.8 😀😀 visa [CARD]"
    assert got[4]["text"].startswith("[CARD] and 4111-1111-1111-1112") and got[8]["pii"] == 8 and got[0]["text"] is None


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert pii.op12_pii(spark, str(tmp_path)).count() == 0


def test_time_follows_the_length():
    began = time.time()
    for text in ("7" * 1_000_000, "8-" * 500_000, "a" * 1_000_000, "x@" * 200_000, "b@" + "c." * 200_000, "+" * 1_000_000):
        pii.spans_of(text)
    assert time.time() - began < 20
