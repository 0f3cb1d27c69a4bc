"""Landed lists, lines and reports on inputs that the smallest tables don't have, against DuckDB."""

import duckdb
import pytest
from pyspark.sql import functions as F

from stratocast import catalog
from stratocast import fixtures as X
from stratocast.sources import lists
from stratocast.streaming import repair


def both(spark, folder, name):
    """Sorted rows of a query and of its SQL over the tables in ``folder``."""
    got = catalog.queries()[name](spark, str(folder))
    con = duckdb.connect()
    for f in folder.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    rows = con.execute(f"SELECT {', '.join(got.columns)} FROM ({catalog.oracle_sql()[name]})").fetchall()
    return sorted(map(tuple, got.collect()), key=repr), sorted(rows, key=repr)


@pytest.mark.parametrize("height", [-0.03, -0.0, 0.0, -0.05, 25.05, 12345678.94, 2.5e14, 3e21, None])
def test_heights_as_json(spark, height):
    row = ("NWS:1", 'a "b"', 1.0, -66.0, height, "US", None, "K1", None, "NWS")
    s = spark.createDataFrame([row], "id string, name string, lat double, lon double, elev_m double, country string, iem_network string, nws_id string, ghcnh_id string, network string")
    want = duckdb.execute("SELECT coalesce(to_json(round(?::DOUBLE, 1)), 'null')", [height]).fetchone()[0]
    assert lists.compact_rows(s).first()["row"] == f'["NWS:1","a \\"b\\"",1.0,-66.0,{want},"NWS","US",null,"K1",null]'


def events(folder, rows: str):
    """A table of events (event_id, ts, user_id, event_type, value) from SQL."""
    duckdb.execute(f"COPY ({rows}) TO '{folder}/events.parquet'")


def test_warm_readings_are_no_broken_lines(spark, tmp_path):
    events(tmp_path, "SELECT CASE WHEN i = 0 THEN NULL ELSE i - 100 END AS event_id, TIMESTAMP '2024-01-01' + to_minutes(i::INT) AS ts, i AS user_id, CASE i % 3 WHEN 0 THEN 'click' ELSE 'view' END AS event_type, CASE WHEN i % 7 = 0 THEN 'nan'::DOUBLE ELSE i * 2.5 END AS value FROM range(500) r(i)")
    got, want = both(spark, tmp_path, "landing_counts")
    assert got == want


def test_late_reports_count(spark, tmp_path, monkeypatch):
    """Files that land out of order, by more than ten days, and a report without a time."""
    events(tmp_path, "SELECT i AS event_id, CASE WHEN i <> 7 THEN TIMESTAMP '2024-01-01' + to_hours(((i * 7919) % 720)::INT) END AS ts, i % 3 AS user_id, CASE i % 3 WHEN 0 THEN 'purchase' ELSE 'view' END AS event_type, i % 50 / 2 AS value FROM range(2000) r(i)")
    reports = X.reports
    monkeypatch.setattr(X, "reports", lambda *a: reports(*a).repartition(8, "event_id"))
    got, want = both(spark, tmp_path, "stream_repair")
    assert got == want


def test_a_batch_run_again_counts_once(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", None)], "station_id string, tmpc double").withColumns({"valid": F.lit("2024-01-01 05:10:00").cast("timestamp"), **{c: F.lit(1.0) for c in ("sknt", "gust", "p01m")}})
    merge = repair.merge_hours(str(tmp_path / "hours"))
    for number in (0, 1, 1, 2, 2):
        merge(rows, number)
    got = repair.hours(spark, str(tmp_path / "hours")).orderBy("station_id").select("station_id", "n", "air_temp_c").collect()
    assert [tuple(r) for r in got] == [("a", 6, 1.5), ("b", 3, None)]
