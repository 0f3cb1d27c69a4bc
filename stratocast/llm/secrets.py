"""Secret scans with corpus-wide ownership frequency, in DataFrame functions alone.

Candidates come from patterns: assignments to names like ``password``, access keys, long hexadecimal runs, and (added by the method)
long mixed-case tokens. The hash of every candidate's value is counted over the whole corpus by distinct repositories and owners: a value
that several owners have is an example that people copy; one that a single owner has, and that doesn't look made up, looks live.

Positions come without any Python: between the pieces that ``split`` leaves lie the matches that
``regexp_extract_all`` gives, so running lengths of both are code-point offsets.

Scale: a pass over the texts; what is written to shared storage of a candidate is its place, its length, and a hash with a salt of the run, never the value. Counts
pre-aggregate before the shuffle; only documents with candidates take part in the join that brings the counts back, which is a broadcast up to ``FEW`` values and
salted beyond, so that values found in very many documents are spread.

Defined cases: null text is empty; null owners or repositories count as one of their own; repeated rows are documents of their own; an
empty table gives an empty result; other columns pass unchanged in ``find_spans`` and ``redact``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratocast.llm._common import join_lookup, materialize

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # maximal runs, as leftmost matches start where a run does
MIXED = r"[A-Za-z0-9_-]{32,}"

#: kind, pattern, group that holds the value, least characters of that group; in the order of kinds.
BASE = (("assign", ASSIGN, 2, 6), ("access", ACCESS, 0, 20), ("hex", HEX, 0, 24))
MADE_UP = r"(?i)example|sample|dummy|changeme|placeholder|your[_-]?|xxxx|0123456|abcdef12|(.)\1{5,}"
SPAN = "array<struct<kind:string,start:int,end:int,value:string>>"


#: Matches whose places are added up together: a text's matches take time in proportion to their number times this.
CHUNK = 256
#: Distinct values up to which their counts are broadcast.
FEW = 20_000


def _spans(text: Column, kind: str, pattern: str, group: int, least: int) -> Column:
    """Spans of a pattern's matches, those with a shorter value dropped (they still take up their text)."""
    none = F.expr(f"cast(array() as {SPAN})")
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    parts = F.arrays_zip(F.transform(F.split(text, pattern, -1), F.length).alias("gap"), matches.alias("match"), values.alias("value"))
    width = lambda part: part["gap"] + F.length(F.coalesce(part["match"], F.lit("")))
    # Where each chunk of matches begins, then the places within.
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(parts) - 1) / CHUNK).cast("int")), lambda k: F.slice(parts, k * CHUNK + 1, CHUNK))
    total = lambda chunk: F.aggregate(chunk, F.lit(0), lambda a, x: a + width(x))
    begins = F.aggregate(F.transform(chunks, total), F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))

    def step(acc: Column, part: Column) -> Column:
        start = acc["at"] + part["gap"]
        end = acc["at"] + width(part)
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), part["value"].alias("value"))
        return F.struct(end.alias("at"), F.when(F.length(part["value"]) >= least, F.concat(acc["found"], F.array(span))).otherwise(acc["found"]).alias("found"))

    within = F.zip_with(chunks, F.slice(begins, F.lit(1), F.size(chunks)), lambda chunk, at: F.aggregate(chunk, F.struct(at.alias("at"), none.alias("found")), step, lambda acc: acc["found"]))
    return F.flatten(within)


def in_order(a: Column, b: Column) -> Column:
    """By start, then kind as listed."""
    rank = F.array(*[F.lit(k) for k, *_ in BASE], F.lit("mixed"))
    ra, rb = F.array_position(rank, a["kind"]), F.array_position(rank, b["kind"])
    return F.when((a["start"] < b["start"]) | ((a["start"] == b["start"]) & (ra < rb)), -1).when((a["start"] == b["start"]) & (ra == rb), 0).otherwise(1)


def find_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with ``base`` and ``extra``: arrays of (kind, start, end, value), each by start, then kind as listed."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # A text without any of the cheap signs has no candidate; this spares most texts the patterns.
    by_kind = [F.when(_sign(text, kind), _spans(text, kind, pattern, group, least)).otherwise(F.expr(f"cast(array() as {SPAN})")) for kind, pattern, group, least in BASE]
    out = docs.withColumn("base", F.array_sort(F.concat(*by_kind), in_order))
    # Added by the method: long tokens that mix upper case, lower case and digits, outside the base spans.
    long_tokens = F.filter(
        F.when(text.rlike(MIXED), _spans(text, "mixed", MIXED, 0, 32)).otherwise(F.expr(f"cast(array() as {SPAN})")),
        lambda x: x["value"].rlike("[A-Z]") & x["value"].rlike("[a-z]") & x["value"].rlike("[0-9].*[0-9].*[0-9]"),
    )
    clear = F.filter(long_tokens, lambda x: ~F.exists(F.col("base"), lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    return out.withColumn("extra", clear)


def _sign(text: Column, kind: str) -> Column:
    if kind == "assign":
        return text.rlike(r"(?i)(?:d|t|n|y)[\"']?\x20*[:=]")
    if kind == "access":
        return text.contains("AKIA")
    return text.rlike(HEX)


def listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def sealed(spans: Column, salt: str) -> Column:
    """Spans without their values: the length, a hash that only a run knows the salt of, and whether the value looks made up."""
    key = lambda x: F.conv(F.substring(F.sha2(F.concat(F.lit(salt), x["value"]), 256), 1, 15), 16, 10).cast("long")
    return F.transform(spans, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), F.length(x["value"]).alias("length"), key(x).alias("key"), x["value"].rlike(MADE_UP).alias("made_up")))


def ownership(found: DataFrame, common_from: int = 3) -> DataFrame:
    """One row per distinct (row, span) of ``found`` (row, repository, owner, base, extra: sealed spans) with ``owners``, ``repositories`` and ``verdict``.

    ``verdict``: ``shared`` if ``common_from`` owners or more have the value, ``made_up`` if it looks it, else ``live``.
    """
    some = found.where((F.size("base") > 0) | (F.size("extra") > 0))
    flat = some.select("row", "repository", "owner", F.explode(F.concat("base", "extra")).alias("span"))
    flat = materialize(flat.withColumn("key", F.col("span.key")), "candidates")
    # distinct first, so that a value in a third of all documents is counted from one row per owner or repository
    who = flat.groupBy("key", "owner").agg(F.lit(1).alias("one")).groupBy("key").agg(F.count("*").alias("owners"))
    where = flat.groupBy("key", "repository").agg(F.lit(1).alias("one")).groupBy("key").agg(F.count("*").alias("repositories"))
    counts = materialize(who.join(where, "key"), "owned")
    out = join_lookup(flat.select("row", "span", "key").distinct(), counts, "key", counts.count(), limit=FEW).drop("key")
    verdict = F.when(F.col("owners") >= common_from, "shared").when(F.col("span.made_up"), "made_up").otherwise("live")
    return out.withColumn("verdict", verdict)


def judged_by_source(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Spans of documents and their verdicts; the repository is the document's source, the owner the first part of its path."""
    owned = docs.withColumn("row", row_key()).withColumn("repository", F.col("source")).withColumn("owner", F.split("source", "/")[0])
    salt = uuid.uuid4().hex
    spans = find_spans(owned.select("doc_id", "row", "repository", "owner", "text")).drop("text")
    found = materialize(spans.withColumns({c: sealed(F.col(c), salt) for c in ("base", "extra")}), "found")
    return found, ownership(found)


def row_key() -> Column:
    """Tells rows apart by id and text; rows that repeat share it."""
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every value that looks live replaced in ``text``; ``n_chars`` follows where there is such a column."""
    _, judged = judged_by_source(docs)
    span = F.col("span")
    value = F.struct((span["end"] - span["length"]).alias("start"), span["end"].alias("end"))  # values end their matches
    live = judged.where(F.col("verdict") == "live").groupBy(F.col("row").alias("__row")).agg(F.array_sort(F.collect_set(value)).alias("__live"))
    live = materialize(live, "live")
    out = join_lookup(docs.withColumn("__row", row_key()), live, "__row", live.count())

    def step(acc: Column, x: Column) -> Column:
        ahead = F.concat(acc["out"], F.col("text").substr(acc["at"] + 1, x["start"] - acc["at"]), F.lit(mark))
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), F.when(x["start"] >= acc["at"], ahead).otherwise(acc["out"]).alias("out"))

    cleaned = F.aggregate("__live", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step, lambda acc: F.concat(acc["out"], F.col("text").substr(acc["at"] + 1, F.length("text"))))
    out = out.withColumn("text", F.when(F.col("__live").isNotNull(), cleaned).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__live").isNotNull(), F.length("text")).otherwise(F.col("n_chars")).cast("long"))
    return out.select(docs.columns)


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    found, judged = judged_by_source(docs)
    verdicts = judged.groupBy("row").agg(*[F.sum(F.when(F.col("verdict") == v, 1).otherwise(0)).alias(f"n_{v}") for v in ("live", "shared", "made_up")])
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    out = found.select("doc_id", "row", of("assign"), of("access"), of("hex"), F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.array_sort(F.concat("base", "extra"), in_order)).alias("spans"))
    none = {f"n_{v}": 0 for v in ("live", "shared", "made_up")}
    return out.join(verdicts, "row", "left").drop("row").fillna(none)
