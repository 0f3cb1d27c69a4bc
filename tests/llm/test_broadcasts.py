"""What goes through the driver: Spark sizes a table by its compressed file, and after an explode by its rows before."""

from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from stratocast.llm import decontamination, near_dedup, passages
from stratocast.llm._common import OWN_BROADCAST, join_lookup, materialize


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_replicated_lookups_are_not_broadcast(spark):
    big = spark.range(1000).select((F.col("id") % 7).alias("key"), "id")
    small = spark.range(7).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v"))
    out = join_lookup(big, small, "key", 7, limit=5)
    assert "Broadcast" not in plan(out)
    assert out.where("v = key * 2").count() == out.count() == 1000


def test_spark_broadcasts_little_on_its_own_while_tables_are_written(spark, monkeypatch):
    seen, write = [], DataFrameWriter.parquet
    get = lambda: spark.conf.get("spark.sql.autoBroadcastJoinThreshold", None)
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *a, **b: (seen.append(get()), write(self, *a, **b)))
    before = get()
    for own, most in ((None, OWN_BROADCAST), ("10m", OWN_BROADCAST), ("1k", 1024), ("-1", -1)):
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold") if own is None else spark.conf.set("spark.sql.autoBroadcastJoinThreshold", own)
        materialize(spark.range(3).toDF("id"), "few")
        assert int(seen[-1]) == most and (own is None or get() == own)
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold") if before is None else spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_labels_of_many_classes_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "join_lookup", lambda big, small, key, rows: join_lookup(big, small, key, rows, limit=1))
    docs = spark.createDataFrame([(i, f"some words of text {i // 2} and more of them here") for i in range(20)], "doc_id long, text string")
    out = near_dedup.near_duplicates(docs, 3, 85)
    assert "Broadcast" not in plan(out)
    assert sorted((r["doc_id"], r["component_id"]) for r in out.collect()) == [(i, i // 2 * 2) for i in range(20)]


def test_many_dropped_ids_are_not_broadcast(spark, monkeypatch):
    """What keep_one and drop_contaminated leave out, when it is more than may be broadcast."""
    monkeypatch.setattr(near_dedup, "FEW_IDS", 0)
    monkeypatch.setattr(decontamination, "FEW_IDS", 0)
    passage = "one passage of the benchmark that a document has word by word"
    docs = spark.createDataFrame([(i, f"text {i // 2} has these words and no others" if i else passage) for i in range(20)] + [(None, "no id")], "doc_id long, text string")
    kept = near_dedup.keep_one(docs)
    clean = decontamination.drop_contaminated(docs, spark.createDataFrame([(1, passage)], "item_id long, text string"))
    assert "Broadcast" not in plan(kept) and "Broadcast" not in plan(clean)
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in kept.collect()) == [-1, 0, 1, *range(2, 20, 2)]  # 0 has another text than 1
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in clean.collect()) == [-1, *range(1, 20)]


def test_passages_are_not_broadcast(spark):
    words = " ".join(f"w{i}" for i in range(80))
    docs = spark.createDataFrame([(1, f"{words} one"), (2, f"two {words}"), (3, "three"), (None, words)], "doc_id long, text string")
    out = passages.shared_passages(docs)
    assert "Broadcast" not in plan(out)
    assert sorted((r["doc_id"] or 0, r["class_id"] or 0, r["repeated_words"]) for r in out.collect()) == [(0, 0, 0), (1, 1, 80), (2, 1, 80), (3, 3, 0)]
