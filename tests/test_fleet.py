"""Model store and fleet run, walk-forward states, cold start, score cards, late observations."""

import datetime as dt
import glob
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratocast import config as C
from stratocast.functions import scores as S
from stratocast.operators import bias, coldstart, fleet, pairing, publish, stations, verification, walkforward
from stratocast.storage import stored
from stratocast.streaming import pairs as late_pairs

START = dt.datetime(2023, 1, 1, tzinfo=dt.UTC)


def pairs(spark, days, station="a", variable="air_temp_c", seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(days * 4):
        t = START + dt.timedelta(hours=6 * i)
        obs = float(10 + 5 * np.sin(i / 20) + rng.normal())
        rows += [(station, variable, t, 24, "x", m, obs + 1 + 0.3 * k + float(rng.normal()) * 0.5, obs, i * 10 + k) for k, m in enumerate(("gfs", "ecmwf", "icon"))]
    return spark.createDataFrame(rows, "station_id string, variable string, valid_time timestamp, lead_h int, lead_source string, model string, fc double, obs double, ingest_seq long")


def test_only_changed_groups_are_refitted(spark, tmp_path):
    by, root = ("station_id", "variable"), str(tmp_path)
    a, b = pairs(spark, 60), pairs(spark, 60, "b", seed=1)
    both = pairing.wide(a.unionByName(b), more=("variable",))
    first = fleet.train(both, root, 1, by, (0, 1))
    assert {r["station_id"] for r in first.collect()} == {"a", "b"}
    more = pairing.wide(pairs(spark, 61).unionByName(b), more=("variable",))
    assert [r["station_id"] for r in fleet.train(more, root, 2, by, (0, 1)).collect()] == ["a"]
    kept = fleet.latest(spark, root, "chosen", "station_id string, variable string, champion string", by)
    assert {(r["station_id"], r["version"]) for r in kept.collect()} == {("a", 2), ("b", 1)}
    assert fleet.train(more, root, 3, by, (0, 1)).count() == 0  # nothing new
    # From the store as from the rows.
    live = more.where("station_id = 'a'")
    table = fleet.latest(spark, root, "tier0", f"station_id string, variable string, bucket string, {fleet.BIAS}", by)
    key = ["station_id", "valid_time"]
    one = {tuple(r[k] for k in key): r["q50"] for r in bias.predict_from(live, table, by).collect()}
    two = {tuple(r[k] for k in key): r["q50"] for r in bias.predict(live, live, by).collect()}
    assert one.keys() == two.keys() and all(one[k] == pytest.approx(two[k]) for k in two)


def test_fold_states_merge_to_what_all_earlier_rows_give(spark):
    w = stored(pairing.wide(pairs(spark, 80), more=("variable",)), "wide")
    # A gap of many months, after which early rows still count.
    late = w.withColumn("valid_time", F.when(F.col("valid_time") > F.lit(START + dt.timedelta(days=40)), F.col("valid_time") + F.expr("INTERVAL 200 DAYS")).otherwise(F.col("valid_time")))
    late = stored(late, "late")
    table = stored(verification.folds(late), "folds")
    blocked = verification.with_block(late, table)
    wanted = stored(verification.enough(blocked), "enough")
    got = {(r["fold"], r["valid_time"]): (r["q05"], r["q50"], r["q95"]) for r in bias.predict_folds(blocked, wanted).collect()}
    assert len({k for k, _ in got}) > 1
    checked = sorted(table.join(wanted, ["station_id", "fold"]).collect(), key=lambda r: r["fold"])
    for r in (checked[0], checked[-1]):
        past, now = late.where(F.col("valid_time") < F.lit(r["origin"])), late.where((F.col("valid_time") >= F.lit(r["origin"])) & (F.col("valid_time") < F.lit(r["end"])))
        for x in bias.predict(now, past).collect():
            assert got[(r["fold"], x["valid_time"])] == pytest.approx((x["q05"], x["q50"], x["q95"]))


def test_variables_are_walked_by_kind(spark):
    kinds = walkforward.kinds()
    assert sorted(v for names in kinds.values() for v in names) == sorted(C.VARIABLES) and len(kinds) == 4
    rain = pairs(spark, 50, variable="precip_1h_mm").withColumns({c: F.greatest(F.col(c) - 10, F.lit(0.0)) for c in ("fc", "obs")})
    both = pairing.wide(pairs(spark, 50).unionByName(rain), more=("variable",))
    out = walkforward.walk_variables(both, (0, 1)).collect()
    assert {(r["variable"], r["tier"]) for r in out} == {(v, t) for v in ("air_temp_c", "precip_1h_mm") for t in ("tier0", "tier1")}
    wet = [r for r in out if r["variable"] == "precip_1h_mm"]
    assert min(r["q05"] for r in wet) >= 0 and all((r["p_occ"] is not None) == (r["tier"] == "tier1") for r in wet)
    assert all(0 <= r["p_occ"] <= 1 for r in wet if r["p_occ"] is not None)


def test_cold_start_branches(spark):
    parts = [pairing.wide(pairs(spark, 30, s, seed=i)).limit(400) for i, s in enumerate("abc")]
    hourly = lambda df, n: df.withColumn("i", F.col("ingest_seq") / 10).where(F.col("i") < n).withColumn("valid_time", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("i").cast("int") * 3600)).drop("i")
    week = coldstart.recent(hourly(parts[0], 100).unionByName(hourly(parts[1], 40)).unionByName(hourly(parts[2], 20)), ["station_id"])
    table = coldstart.fit(week, ["station_id"])
    got = {r["station_id"]: r for r in table.collect()}
    assert {k: (r["branch"], r["n"]) for k, r in got.items()} == {"a": ("emos", 100), "b": ("bias", 40)}
    assert got["b"]["bias"] == pytest.approx(1.3, abs=0.4) and got["a"]["d"] >= 0
    out = coldstart.predict(week, table, ["station_id"], 8.0, 12.0).collect()
    assert all(8 <= r["q05"] <= r["q50"] <= r["q95"] <= 12 for r in out) and {r["station_id"] for r in out} == {"a", "b"}
    plain = coldstart.predict(week, table, ["station_id"]).where("station_id = 'a'")
    covered = plain.agg(F.avg(F.when(F.col("obs").between(F.col("q05"), F.col("q95")), 1.0).otherwise(0.0))).first()[0]
    assert 0.8 < covered <= 1


def test_score_card_gates_and_sources(spark):
    w = stored(pairing.wide(pairs(spark, 64)), "wide")
    walked = walkforward.walk_forward(w, (0, 1)).withColumn("crps", S.crps_quantiles(F.col("obs"), [F.col(q) for q in C.QUANTILES]))
    walked = stored(walked, "walked")
    counts = spark.createDataFrame([("a", 256), ("few", 199), ("none", 500)], "station_id string, n_pairs long")
    card = {r["station_id"]: r for r in publish.scorecard(walked, counts, thresholds=(10.0,), resamples=50).collect()}
    assert {k: r["status"] for k, r in card.items()} == {"a": "ok", "few": "insufficient_data", "none": "insufficient_data"}
    a = card["a"]
    assert not a["held_out"] and sum(a["pit"]) == a["n_eval"] and a["champion"] == min(a["scores"], key=a["scores"].get)
    assert a["beats_raw"] == (a["interval"]["low"] > 0) and len(a["daily"]) <= 90 and card["few"]["crps"] is None
    # Of two sources at one time and lead the last gives the models and the observation.
    twice = walked.limit(5).withColumn("lead_source", F.lit("y")).withColumn("fc_gfs", F.lit(0.0))
    met = verification.one_source(walked.limit(5).unionByName(twice))
    assert met.where("fc_gfs = 0").count() == 10


def test_states_of_stations(spark):
    rows = spark.createDataFrame([("ok", None, None), ("ok", 0.2, True), ("ok", 0.2, False), ("ok", -0.1, False), ("no_data", 0.3, True), (None, 0.3, True)], "status string, skill double, beats boolean")
    got = [r[0] for r in rows.select(stations.state(F.col("skill"), F.col("beats"), F.col("status"))).collect()]
    assert got == ["warming", "beats", "inconclusive", "worse", "unavailable", "unavailable"]


def test_late_observations_touch_their_folders_alone(spark, tmp_path):
    base, schema = str(tmp_path), "station_id string, valid_time timestamp, fc double"
    hours = [(s, START + dt.timedelta(hours=24 * h), float(h)) for s in ("a", "b") for h in range(100)]
    late_pairs.write_placed(late_pairs.placed(spark.createDataFrame(hours, schema)), f"{base}/forecasts")
    merge = late_pairs.repairing(base, f"{base}/forecasts", schema)
    report = lambda rows: spark.createDataFrame(rows, "station_id string, valid_time timestamp, obs double, seq long")
    merge(report([(s, t, h + 1, 1) for s, t, h in hours]), 0)
    assert late_pairs.pairs(spark, base, schema).count() == len(hours)
    stamps = lambda: {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{base}/pairs/month=*/part=*/*.parquet")}
    before = stamps()
    second = [("a", hours[40][1], 99.0, 2), ("a", hours[41][1], None, 2), ("a", hours[42][1], 5.0, 0)]  # revised, withdrawn, and older than what is there
    merge(report(second), 1)
    after = stamps()
    touched = {os.path.dirname(f) for f, _ in set(before.items()) ^ set(after.items())}
    assert len(touched) == 1 and "month=2023-02" in touched.pop()
    got = {(r["station_id"], r["valid_time"].replace(tzinfo=dt.UTC)): r["obs"] for r in late_pairs.pairs(spark, base, schema).collect()}
    want = {(s, t): h + 1 for s, t, h in hours}
    want[("a", hours[40][1])] = 99.0
    del want[("a", hours[41][1])]
    assert {(s, t.timestamp()): o for (s, t), o in want.items()} == {(s, t.timestamp()): o for (s, t), o in got.items()}
    merge(report(second), 1)  # again
    assert late_pairs.pairs(spark, base, schema).count() == len(want)
    month = [("b", t, None, 9) for s, t, _ in hours if s == "b" and t.month == 4]
    merge(report(month), 2)  # the last pairs of a folder
    assert late_pairs.pairs(spark, base, schema).where("station_id = 'b' AND month = '2023-04'").count() == 0
