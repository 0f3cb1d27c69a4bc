"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust their scores.

Base kinds are e-mail addresses, IPv4 addresses (parts up to 255), payment cards (12 to 19 digits, Luhn) and international phone numbers (9 to 15
digits). The method adds bank accounts (``iban``, mod 97), social security numbers (``ssn``, no area or group that is never given out) and national phone
numbers (``local``); these three must reach ``LEAST`` after the words around them have been weighed, must not touch a letter or digit, and must not overlap a
base span or an earlier added one. Base spans stay whatever their score.

A span's score, in hundredths, is that of its kind, ``MORE`` higher if a word that goes with the kind stands within ``BEFORE`` characters ahead or ``AFTER``
behind, ``LESS`` lower if a word does that marks examples, versions or sizes; within 0 and 100.

Scale: one pass without a shuffle, a few megabytes of text at a time; texts without a digit or an at sign are spared the patterns. Where the plain pattern could start at every
place of a long run, the one used here takes the whole run at once, whether it matches or not, so that the time follows the length of a text; the matches are the same.

Defined cases: null text is empty and has no spans; repeated rows and ids are rows of their own, null ids stay null; an empty table gives an empty
result; other columns of ``docs`` pass unchanged (one named ``pii`` is replaced); text is never cut.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratocast.llm._common import LOWER, UPPER, slices

# The contract's patterns; for e-mail and IPv4 a run that is no match is taken too (then the group is empty), since no match can begin within it.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]++(@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++)?")
IP = re.compile(r"[0-9]++((?:\.[0-9]++){3})?")
CARD = re.compile(r"([0-9](?:[\x20-]?[0-9])++)")
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"[A-Z]{2}[0-9]{2}(?:(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?|[A-Z0-9]{11,30})"
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
LOCAL = r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}"

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "local")
_PATTERN = {"email": EMAIL, "ip": IP, "card": CARD} | {k: re.compile(f"({p})") for k, p in (("phone", PHONE), ("iban", IBAN), ("ssn", SSN), ("local", LOCAL))}
#: Score of a kind, in hundredths, and words that go with it.
KINDS = {
    "email": (90, "e-?mail|mail|contact|write|correo|courriel"),
    "ip": (50, "ip|address|host|server|login|client|adresse"),
    "card": (80, "card|visa|mastercard|amex|credit|debit|payment|tarjeta|carte|karte"),
    "phone": (70, "phone|tel|call|mobile|fax|telefon|telefono|portable"),
    "iban": (80, "iban|bank|account|transfer|konto|cuenta|compte"),
    "ssn": (30, "ssn|social security|taxpayer|tax id"),
    "local": (30, "phone|tel|call|mobile|fax|telefon|telefono|portable"),
}
DOUBT = "example|sample|dummy|test|version|release|serial|order|isbn|page"
MORE, LESS, LEAST = 20, 40, 50
BEFORE, AFTER = 40, 20
_NEAR = {k: re.compile(f"(?:^|[^a-z0-9])(?:{w})(?:[^a-z]|$)") for k, w in {**{k: w for k, (_, w) in KINDS.items()}, "doubt": DOUBT}.items()}
_FOLD = str.maketrans(UPPER, LOWER)
SPANS = "array<struct<kind:string,start:int,end:int,value:string,score:int,added:boolean>>"


class Span(NamedTuple):
    start: int
    rank: int
    kind: str
    end: int
    value: str
    score: int


def luhn(digits: str) -> bool:
    """Whether the digits, every second from the right but one doubled and its digits added, make a sum that ends in zero."""
    twice = (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)
    return (sum(map(int, digits[-1::-2])) + sum(twice[int(d)] for d in digits[-2::-2])) % 10 == 0


def mod97(account: str) -> bool:
    """Whether the account, its first four characters last and letters as two digits, leaves 1."""
    return int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def _confirmed(kind: str, value: str) -> bool:
    if kind == "ip":
        return all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in value.split("."))
    if kind in ("card", "phone"):
        digits = re.sub("[^0-9]", "", value)
        return 12 <= len(digits) <= 19 and luhn(digits) if kind == "card" else 9 <= len(digits) <= 15
    if kind == "iban":
        return mod97(value.replace(" ", ""))
    return kind != "ssn" or not re.search("^(?:000|666|9)|-00-|-0000$", value)


def _score(text: str, kind: str, start: int, end: int) -> int:
    near = (text[max(0, start - BEFORE) : start] + " \n " + text[end : end + AFTER]).translate(_FOLD)
    moved = KINDS[kind][0] + MORE * bool(_NEAR[kind].search(near)) - LESS * bool(_NEAR["doubt"].search(near))
    return max(0, min(100, moved))


def _of_kind(text: str, kind: str) -> Iterator[Span]:
    rank = (BASE + ADDED).index(kind)
    for m in _PATTERN[kind].finditer(text):
        if m[1] and _confirmed(kind, m[0]):
            yield Span(m.start(), rank, kind, m.end(), m[0], _score(text, kind, m.start(), m.end()))


def _alone(text: str, span: Span) -> bool:
    edges = text[span.start - 1 : span.start] if span.start else "", text[span.end : span.end + 1]
    return not any(c.isascii() and c.isalnum() for c in edges)


def _clear(spans: list[Span], of: list[Span]) -> list[Span]:
    """Those that overlap none of the others; both by start, each without overlaps within a kind."""
    kept, at, reach = [], 0, 0
    for x in spans:
        while at < len(of) and of[at].start < x.end:
            reach = max(reach, of[at].end)
            at += 1
        # what starts before this one's end reaches into it if its furthest end does
        if reach <= x.start:
            kept.append(x)
    return kept


def spans_of(text: str) -> tuple[list[Span], list[Span]]:
    """Base and added spans of a text, each by start, then kind as listed."""
    digit = re.search("[0-9]", text)
    base = [x for k in BASE if ("@" in text if k == "email" else digit) for x in _of_kind(text, k)]
    base.sort()
    added = sorted(x for k in ADDED if digit for x in _of_kind(text, k) if x.score >= LEAST and _alone(text, x))
    added = _clear(added, base)
    kept, reach = [], 0
    for x in added:  # one that overlaps an earlier one, kept or not, goes
        if reach <= x.start:
            kept.append(x)
        reach = max(reach, x.end)
    return base, kept


def find_pii(docs: DataFrame) -> DataFrame:
    """``docs`` with ``pii``: an array of (kind, start, end, value, score, added) by start, then kind as listed."""
    docs = docs.drop("pii")
    schema = StructType(docs.schema.fields + StructType.fromDDL(f"pii {SPANS}").fields)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("value", pa.string()), ("score", pa.int32()), ("added", pa.bool_())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            rows = []
            for raw in texts:
                base, added = spans_of(raw.decode())
                found = sorted([(x, False) for x in base] + [(x, True) for x in added])
                rows.append([{"kind": x.kind, "start": x.start, "end": x.end, "value": x.value, "score": x.score, "added": own} for x, own in found])
            yield part.append_column("pii", pa.array(rows, kind))

    return docs.mapInArrow(scan, schema)


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact_pii(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``docs`` with every span of at least that score replaced by its kind in brackets, such as ``[EMAIL]``; where spans overlap, the earliest."""

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in slices(batches):
            at = part.schema.get_field_index("text")
            out: list[str | None] = []
            for raw, there in zip(texts, part.column(at).is_valid().to_pylist(), strict=True):
                text, pieces, done = raw.decode(), [], 0
                for x in sorted(y for spans in spans_of(text) for y in spans if y.score >= least):
                    if x.start >= done:
                        pieces += [text[done : x.start], f"[{x.kind.upper()}]"]
                        done = x.end
                out.append("".join(pieces) + text[done:] if there else None)
            yield part.set_column(at, part.schema.field(at), pa.array(out, part.schema.field(at).type))

    return docs.mapInArrow(clean, docs.schema)


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).drop("text")
    base = F.filter("pii", lambda s: ~s["added"])
    of = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    scores = F.array_join(F.transform("pii", lambda s: s["score"].cast("string")), ",").alias("scores")
    return found.select("doc_id", *[of(k) for k in BASE], F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("pii")).alias("spans"), scores)


def _oracle() -> str:
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": PHONE,
        "iban": IBAN,
        "ssn": SSN,
        "local": LOCAL,
    }
    kinds = ", ".join(f"({i}, '{k}', '{p}', {KINDS[k][0]}, '{KINDS[k][1]}')" for i, (k, p) in enumerate(plain.items()))
    word = lambda words: f"regexp_matches(near, '(^|[^a-z0-9])(' || {words} || ')([^a-z]|$)')"
    return f"""
    WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
    kinds (k, kind, pattern, points, words) AS (VALUES {kinds}),
    lists AS (
      SELECT rid, text, k, kind, points, words, regexp_extract_all(text, pattern) AS m, list_transform(string_split_regex(text, pattern), lambda x: length(x)) AS gaps
      FROM docs, kinds WHERE regexp_matches(text, pattern)),
    placed AS (
      SELECT rid, text, k, kind, points, words, m[i] AS v, (list_sum(gaps[1:i]) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0))::BIGINT AS s
      FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM lists)),
    spans AS (
      SELECT *, s + length(v) AS e, regexp_replace(v, '[^0-9]', '', 'g') AS d, replace(v, ' ', '') AS a,
        translate(substr(text, greatest(s - {BEFORE}, 0)::BIGINT + 1, least(s, {BEFORE})::BIGINT) || ' ' || chr(10) || ' ' || substr(text, s + length(v) + 1, {AFTER}), '{UPPER}', '{LOWER}') AS near
      FROM placed),
    confirmed AS (
      SELECT *, greatest(0, least(100, points + CASE WHEN {word("words")} THEN {MORE} ELSE 0 END - CASE WHEN {word(f"'{DOUBT}'")} THEN {LESS} ELSE 0 END)) AS score
      FROM spans WHERE CASE kind
        WHEN 'email' THEN true
        WHEN 'ip' THEN len(list_filter(string_split(v, '.'), lambda p: p::HUGEINT > 255)) = 0
        WHEN 'card' THEN length(d) BETWEEN 12 AND 19 AND list_sum(list_transform(range(0, length(d)), lambda i:
          CASE WHEN i % 2 = 0 THEN substr(d, (length(d) - i)::BIGINT, 1)::INT
          ELSE 2 * substr(d, (length(d) - i)::BIGINT, 1)::INT - CASE WHEN substr(d, (length(d) - i)::BIGINT, 1)::INT > 4 THEN 9 ELSE 0 END END)) % 10 = 0
        WHEN 'phone' THEN length(d) BETWEEN 9 AND 15
        WHEN 'iban' THEN list_reduce(list_prepend(0::BIGINT, list_transform(range(0, length(a)), lambda i: ascii(substr(a, ((i + 4) % length(a))::BIGINT + 1, 1))::BIGINT)),
          lambda x, c: CASE WHEN c >= 65 THEN (x * 100 + c - 55) % 97 ELSE (x * 10 + c - 48) % 97 END) = 1
        WHEN 'ssn' THEN NOT regexp_matches(v, '^(000|666|9)|-00-|-0000$')
        ELSE true END),
    base AS (SELECT * FROM confirmed WHERE k < {len(BASE)}),
    added AS (
      SELECT * FROM confirmed c WHERE k >= {len(BASE)} AND score >= {LEAST}
        AND NOT (s > 0 AND regexp_matches(substr(text, s, 1), '[A-Za-z0-9]')) AND NOT regexp_matches(substr(text, e + 1, 1), '[A-Za-z0-9]')
        AND NOT EXISTS (SELECT 1 FROM base b WHERE b.rid = c.rid AND b.s < c.e AND c.s < b.e)),
    kept AS (
      SELECT rid, k, kind, s, e, score FROM base UNION ALL
      SELECT rid, k, kind, s, e, score FROM added c
      WHERE NOT EXISTS (SELECT 1 FROM added b WHERE b.rid = c.rid AND b.s < c.e AND c.s < b.e AND (b.s < c.s OR (b.s = c.s AND b.k < c.k)))),
    sums AS (
      SELECT rid, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE)},
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (k < {len(BASE)}) AS base,
        string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k) AS spans, string_agg(score::VARCHAR, ',' ORDER BY s, k) AS scores
      FROM kept GROUP BY rid)
    SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores
    FROM docs LEFT JOIN sums USING (rid)"""


ORACLE_SQL = _oracle()
