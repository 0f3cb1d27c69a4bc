"""The engine's operators on small exact cases, and its queries against their SQL."""

import json
import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from stratocast import catalog
from stratocast import config as C
from stratocast.functions import scores as S
from stratocast.operators import bias, fits, pairing, publish, quality, stations, verification, walkforward
from stratocast.sources import payloads
from stratocast.storage import stored

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}") + 0.0
    return v


QUICK = ["asos_hourly", "qc_all", "qc_flatline", "pair_upsert", "wide_matrix", "decayed_bias", "residual_quantiles", "trim_and_cap", "crps_truncated", "raw_baselines", "pit_hist", "fold_table", "climatology", "catalogue_dedupe", "validate_candidates", "champion", "forecast_unpivot", "precip_quantile_map", "cold_start_calibration", "stream_repair", "nws_station_list", "catalogue_build", "archive_scan", "archive_hourly", "observation_history", "observation_union", "meteostat_observations", "previous_runs", "archive_window", "payload_alignment", "tier0_walk_forward", "tier_ranking", "tier_fallback", "training_plan", "fleet_run", "forecast_documents", "running_bias"]


@pytest.mark.parametrize("name", QUICK)
def test_queries_match_their_sql(spark, duck, name):
    got = catalog.queries()[name](spark, SF)
    columns = sorted(got.columns)
    want = duck.execute(catalog.oracle_sql()[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == columns
    b = sorted((tuple(plain(r[names.index(c)]) for c in columns) for r in want.fetchall()), key=repr)
    a = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=repr)
    assert a == b


def test_every_oracle_has_a_query():
    assert set(catalog.oracle_sql()) <= set(catalog.queries())


def one(spark, expression, **values):
    frame = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} double" for k in values))
    return frame.select(F.expr(expression) if isinstance(expression, str) else expression).first()[0]


@pytest.mark.parametrize("truncated", [False, True])
def test_crps_equals_quadrature(spark, truncated):
    for y, mu, sigma in ((1.0, 2.0, 1.5), (0.2, 0.5, 2.0), (6.0, 3.0, 0.7)):
        x = np.linspace(0 if truncated else mu - 12 * sigma, mu + 12 * sigma, 400_001)
        cdf = fits.cdf((x - mu) / sigma)
        if truncated:
            cdf = (cdf - fits.cdf(np.array([-mu / sigma]))) / (1 - fits.cdf(np.array([-mu / sigma])))
        want = np.trapezoid((cdf - (x >= y)) ** 2, x)
        sql = S.crps_truncated_sql("y", "mu", "sigma") if truncated else S.crps_normal_sql("y", "mu", "sigma")
        assert one(spark, sql, y=y, mu=mu, sigma=sigma) == pytest.approx(want, abs=1e-4)


def test_point_forecasts_score_their_error(spark):
    for y, x, want in ((1, 0, 1), (-2, 0, 2), (3.5, 3, 0.5)):
        got = one(spark, S.crps_quantiles(F.col("y"), [F.col("x")] * 5), y=float(y), x=float(x))
        assert got == pytest.approx(want, rel=0.02)
        assert one(spark, S.crps_sample(F.col("y"), F.array("x", "x")), y=float(y), x=float(x)) == pytest.approx(want)


def test_pit_and_exceedance(spark):
    q = [F.lit(float(v)) for v in (1, 2, 3, 4, 5)]
    assert one(spark, S.pit(F.col("y"), q), y=0.0) == 0.025
    assert one(spark, S.pit(F.col("y"), q), y=9.0) == 0.975
    assert one(spark, S.pit(F.col("y"), q), y=2.5) == pytest.approx(0.375)
    assert one(spark, S.exceedance(2.5, q), y=0.0) == pytest.approx(0.625)
    assert one(spark, S.pit(F.col("y"), [F.lit(None).cast("double"), *q[1:]]), y=2.5) is None


def test_decayed_bias_is_the_recursion(spark):
    rng = np.random.default_rng(0)
    e = rng.normal(1, 1, 37)
    rows = spark.createDataFrame([("s", i, float(v)) for i, v in enumerate(e)], "station_id string, i int, e double")
    wide = rows.select("station_id", F.timestamp_seconds(F.col("i") * 86400).alias("valid_time"), F.lit(24).alias("lead_h"), F.lit("x").alias("lead_source"), F.col("i").cast("long").alias("ingest_seq"), F.col("e").alias("fc_mean"), F.lit(0.0).alias("obs"))
    _, lead = bias.cell_bias(wide)
    b = e[0]
    for v in e[1:]:
        b = 0.92 * b + 0.08 * v
    assert lead.first()["bias_lead"] == pytest.approx(b)


def test_pairs_need_an_observation_and_revisions_win(spark):
    fc = spark.createDataFrame([("s", m, f"2024-01-0{1 + h // 24} {h % 24:02d}:00:00", 24, "prev", 1.0, 1) for m in ("a", "b") for h in range(48)], "station_id string, model string, t string, lead_h int, lead_source string, fc double, ingest_seq long").withColumn("valid_time", F.to_timestamp("t")).drop("t")
    obs = spark.createDataFrame([("s", f"2024-01-01 {h:02d}:00:00", float(h), 1) for h in range(24)] + [("s", "2024-01-01 05:00:00", 99.0, 2)], "station_id string, t string, obs double, ingest_seq long").withColumn("valid_time", F.to_timestamp("t")).drop("t")
    out = pairing.build_pairs(fc, obs)
    assert out.count() == 48
    assert {r["obs"] for r in out.where("hour(valid_time) = 5").collect()} == {99.0}
    assert pairing.upsert(fc, fc.withColumn("fc", F.lit(7.0)).withColumn("ingest_seq", F.lit(2).cast("long"))).select("fc").distinct().collect()[0][0] == 7.0


def test_baselines_compare_equal_rows(spark):
    rows = [("s", 10.0, 12.0, 10.5 if i < 100 else None, 0.2 if i < 100 else 1.6) for i in range(200)]
    scored = spark.createDataFrame(rows, "station_id string, obs double, fc_global double, fc_regional double, crps double")
    got = {r["model"]: r for r in verification.raw_baselines(scored, models=("global", "regional")).collect()}
    assert (got["regional"]["coverage"], got["global"]["coverage"]) == (0.5, 1.0)
    assert got["regional"]["crps_fused"] == pytest.approx(0.2) and got["global"]["crps_fused"] == pytest.approx(0.9)
    assert verification.strongest(verification.raw_baselines(scored, models=("global", "regional"))).first()["model"] == "global"


def test_folds_never_train_on_their_future(spark):
    wide = spark.range(200).select(F.lit("s").alias("station_id"), F.timestamp_seconds(F.col("id") * 86400).alias("valid_time"), F.lit(1.0).alias("obs"))
    train, test = verification.in_folds(wide, verification.folds(wide))
    assert train.where("valid_time >= origin").count() == 0
    assert test.where("valid_time < origin or valid_time >= `end`").count() == 0
    assert test.select("fold").distinct().count() > 3


def test_emos_recovers_a_known_process(spark):
    rng = np.random.default_rng(1)
    n = 1200
    base = rng.normal(10, 5, n)
    models = [base + rng.normal(0, 0.6, n) for _ in range(3)]
    mean, spread = np.mean(models, axis=0), np.std(models, axis=0)
    obs = 0.9 * mean - 1.5 + rng.normal(0, 1, n) * (0.6 + 0.8 * spread)
    rows = [("s", "1-6", i, 6, "x", i, *[float(m[i]) for m in models], float(mean[i]), float(spread[i]), float(obs[i])) for i in range(n)]
    frame = spark.createDataFrame(rows, "station_id string, bucket string, h int, lead_h int, lead_source string, ingest_seq long, fc_a double, fc_b double, fc_c double, fc_mean double, fc_spread double, obs double").withColumn("valid_time", F.timestamp_seconds(F.col("h") * 3600))
    x = [F.col(c) for c in ("fc_a", "fc_b", "fc_c")]
    table = fits.fit_emos(frame, ["station_id", "bucket"], x)
    p = table.first()
    assert sum(p["b"]) == pytest.approx(0.9, abs=0.12) and p["d"] > 0.05
    out = fits.predict_emos(frame, table, ["station_id", "bucket"], x)
    covered = out.agg(F.avg(F.when(F.col("obs").between(F.col("q05"), F.col("q95")), 1.0).otherwise(0.0))).first()[0]
    assert 0.86 < covered < 0.94


def test_station_rules(spark):
    ids = spark.createDataFrame([("ASOS:0001",), ("663:CO:SNTL",), ("1165:MT:SNTLT",), ("MS:10637",), ("IEM:DEN",), ("1185",)], "id string")
    got = [r[0] for r in ids.select(stations.network_of(F.col("id"))).collect()]
    assert got == ["ASOS", "SNOTEL", "SNOTEL", "MS", "IEM", "SNOTEL"]
    assert ids.where("id = '663:CO:SNTL'").select(stations.safe_id(F.col("id"))).first()[0] == "663_CO_SNTL"


def test_flatline_counts_rows_from_the_limit_on(spark):
    rows = spark.range(40).select(F.lit("s").alias("station_id"), F.timestamp_seconds(F.col("id") * 3600).alias("valid_time"), F.lit(5.0).alias("air_temp_c"), F.lit(0.01).alias("wind_speed_ms"), F.lit(None).cast("double").alias("relative_humidity_pct"))
    out = quality.flatline_screen(rows)
    assert out.where("air_temp_c IS NULL").count() == 17 and out.where("wind_speed_ms IS NULL").count() == 0


def test_payload_readers(spark, tmp_path):
    (tmp_path / "nws.json").write_text(json.dumps({"features": [{"properties": {"stationId": "KDEN", "timestamp": f"2024-01-01T00:{m:02d}:00+00:00", "temperature": {"value": t}, "windSpeed": {"value": 36.0}, "windGust": {"value": g}}} for m, t, g in ((5, 1.0, 10.0), (35, 3.0, 72.0))]}))
    r = payloads.geojson_observations(spark, str(tmp_path / "nws.json")).first()
    assert (r["station_id"], r["air_temp_c"], round(r["wind_speed_ms"], 6), round(r["wind_gust_ms"], 6)) == ("NWS:KDEN", 2.0, 10.0, 20.0)
    (tmp_path / "iem.csv").write_text("#note\nstation,valid,tmpf,dwpf,relh,sknt,gust,drct,p01i\nDEN,2024-01-01 00:53,50,M,40,10,20,270,0.1\n")
    r = payloads.csv_reports(spark, str(tmp_path / "iem.csv")).first()
    assert r["air_temp_c"] == pytest.approx(10) and r["dewpoint_c"] is None and r["wind_speed_ms"] == pytest.approx(5.14444) and r["wind_gust_ms"] == pytest.approx(10.28888) and r["precip_1h_mm"] == pytest.approx(2.54)
    (tmp_path / "snow.json").write_text(json.dumps([{"stationTriplet": "663:CO:SNTL", "data": [{"stationElement": {"elementCode": "TOBS"}, "values": [{"date": f"2024-01-01 0{h}:00", "value": 32.0} for h in range(3)]}, {"stationElement": {"elementCode": "PREC"}, "values": [{"date": f"2024-01-01 0{h}:00", "value": v} for h, v in enumerate((1.0, 1.5, 1.2))]}]}]))
    got = [(r["air_temp_c"], r["precip_1h_mm"]) for r in payloads.snow_telemetry(spark, str(tmp_path / "snow.json")).orderBy("valid_time").collect()]
    assert got == [(0.0, None), (0.0, pytest.approx(12.7)), (0.0, 0.0)]
    (tmp_path / "ghcnh.psv").write_text("STATION|DATE|Temperature|wind_speed\nUSW1|2024-01-01T00:10:00|1|4\nUSW1|2024-01-01T00:40:00|3|x\n")
    r = payloads.piped_observations(spark, str(tmp_path / "ghcnh.psv"), "2024-01-01", "2024-01-01").first()
    assert (r["air_temp_c"], r["wind_speed_ms"]) == (2.0, 4.0)
    (tmp_path / "syn.json").write_text(json.dumps({"STATION": [{"STID": "AB1", "OBSERVATIONS": {"date_time": ["2024-01-01T00:00:00Z", "2024-01-01T00:30:00Z"], "air_temp_set_1": ["1", "2"], "wind_gust_set_1": ["5", None]}}]}))
    r = payloads.array_observations(spark, str(tmp_path / "syn.json")).first()
    assert (r["air_temp_c"], r["wind_gust_ms"], r["dewpoint_c"]) == (1.5, 5.0, None)
    (tmp_path / "10637.csv").write_text("2024-01-01,0,1.0,,80,-1,,270,36,,,,\n2024-01-02,0,9.0,,,,,,,,,,\n")
    r = payloads.yearly_csv(spark, str(tmp_path / "10637.csv"), "2024-01-01", "2024-01-02").collect()
    assert len(r) == 1 and (r[0]["station_id"], r[0]["wind_speed_ms"], r[0]["precip_1h_mm"]) == ("MS:10637", pytest.approx(10), 0.0)


def test_unpivot_finds_series(spark):
    hourly = json.dumps({"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "t_previous_day2_m1": ["1", "2"], "t_previous_day2": ["5", "6"], "g_previous_day2_m1": ["7", None]})
    frame = spark.createDataFrame([("s", hourly)], "station_id string, hourly string").withColumn("issued_at", F.lit("2024-01-01").cast("timestamp"))
    out = payloads.unpivot_forecasts(frame, ("m1", "m2"), {"air": "t", "gust": "g"}, {"m1": {"air", "gust"}, "m2": {"air"}}, days=(1, 2))
    got = sorted((r["model"], r["lead_h"], r["fc_air"], r["fc_gust"]) for r in out.collect())
    assert got == [("m1", 48, 1.0, 7.0), ("m1", 48, 2.0, None), ("m2", 48, 5.0, None), ("m2", 48, 6.0, None)]


def test_bucket_labels(spark):
    got = [r[0] for r in spark.createDataFrame([(0,), (6,), (7,), (24,), (168,), (300,)], "lead_h int").select(C.bucket_label(F.col("lead_h"))).collect()]
    assert got == ["1-6", "1-6", "7-12", "13-24", "97-168", "97-168"]


# --- tiers ----------------------------------------------------------------------------------------


def synthetic(spark, days, seed=3, leads=(24,), noise=1.0):
    """A station whose models are biased by the hour and seasonally."""
    rng = np.random.default_rng(seed)
    rows = []
    for h in range(0, days * 24, 3):
        truth = 10 + 8 * math.sin(2 * math.pi * h / (24 * 365.25)) + 4 * math.sin(2 * math.pi * h / 24)
        for lead in leads:
            f = [truth + 1.5 + 0.5 * k + rng.normal(0, 0.5) for k in range(3)]
            rows.append(("s", h * 3600, lead, *map(float, f), float(truth + rng.normal(0, noise)), len(rows)))
    raw = spark.createDataFrame(rows, "station_id string, t long, lead_h int, fc_gfs double, fc_ecmwf double, fc_icon double, obs double, ingest_seq long")
    columns = [F.col(f"fc_{m}") for m in ("gfs", "ecmwf", "icon")]
    return raw.select("station_id", F.timestamp_seconds(F.col("t") + 1_600_000_000 // 86400 * 86400).alias("valid_time"), "lead_h", F.lit("x").alias("lead_source"), *columns, "obs", "ingest_seq").withColumns({"fc_mean": pairing.row_mean(columns), "fc_spread": pairing.row_spread(columns)})


def mean_crps(frame):
    return frame.agg(F.avg(S.crps_quantiles(F.col("obs"), [F.col(q) for q in C.QUANTILES]))).first()[0]


def test_yearly_terms_need_half_a_year(spark):
    """Seven weeks can't tell a yearly cycle: the seasonal tier must not be far off the plain one there, and its yearly coefficients are none."""
    w = pairing.with_bucket(synthetic(spark, 54))
    cut = w.agg(F.max("valid_time")).first()[0]
    past, later = w.where(F.col("valid_time") < F.lit(cut) - F.expr("INTERVAL 7 DAYS")), w.where(F.col("valid_time") >= F.lit(cut) - F.expr("INTERVAL 7 DAYS"))
    by = ["station_id", "bucket"]
    plain, seasonal = (mean_crps(f(past, later, by)) for f in (walkforward.distribution, walkforward.seasonal))
    assert seasonal < 1.3 * plain


def test_tiers_walk_forward(spark):
    w = stored(synthetic(spark, 64), "wide")
    out = walkforward.walk_forward(w, (0, 1)).withColumn("crps", S.crps_quantiles(F.col("obs"), [F.col(q) for q in C.QUANTILES]))
    scored = stored(out, "walked")  # the fits are made once
    ranks = {r["tier"]: r for r in verification.rank_tiers(scored).collect()}
    assert set(ranks) == {"tier0", "tier1"} and all(r["comparable"] and r["score"] < 1.2 for r in ranks.values())
    card = publish.scorecard(scored, w.groupBy("station_id").agg(F.count("*").alias("n_pairs")), resamples=20).collect()
    assert len(card) == 1 and card[0]["champion"] in ranks and card[0]["crps"] < card[0]["crps_raw"]


def test_boosted_quantiles_learn_from_all_rows(spark):
    w = stored(pairing.with_bucket(synthetic(spark, 400)), "wide")
    cut = w.agg(F.max("valid_time")).first()[0]
    past, later = w.where(F.col("valid_time") < F.lit(cut) - F.expr("INTERVAL 40 DAYS")), w.where(F.col("valid_time") >= F.lit(cut) - F.expr("INTERVAL 40 DAYS"))
    out = walkforward.boosted(past, later, ["station_id"])
    assert out.where("NOT calibrated").count() == 0 and mean_crps(out) < 1.0
    assert walkforward.boosted(past.limit(1999), later, ["station_id"]).where("calibrated").count() == 0


def test_rows_that_no_fit_covers(spark):
    """Without parameters of any bucket a station isn't calibrated; without a forecast a row is null; bounds hold."""
    w = pairing.with_bucket(synthetic(spark, 30))
    by, x = ["station_id", "bucket"], walkforward.members()
    table = fits.fit_emos(w, by, x)
    odd = w.limit(1).unionByName(w.limit(1).withColumns({c: F.lit(None).cast("double") for c in ("fc_gfs", "fc_ecmwf", "fc_icon", "fc_mean", "fc_spread")})).unionByName(w.limit(1).withColumn("station_id", F.lit("other")))
    out = fits.predict_emos(odd, table, by, x, low=0.0, high=11.0).collect()
    assert [r["calibrated"] for r in sorted(out, key=lambda r: r["station_id"])] == [False, True, True]
    assert sorted(r["q50"] is None for r in out) == [False, True, True]
    assert all(0 <= r["q95"] <= 11 for r in out if r["q95"] is not None)


def test_occurrence_needs_rows(spark):
    w = pairing.with_bucket(synthetic(spark, 30)).withColumns({"wet_share": F.lit(0.5), "obs": F.when(F.col("ingest_seq") % 2 == 0, 1.0).otherwise(0.0)})
    assert fits.fit_occurrence(w.limit(39), ["station_id", "bucket"]).count() == 0
    assert fits.fit_occurrence(w, ["station_id", "bucket"]).first()["base_rate"] == pytest.approx(0.5, abs=0.01)


def test_folds_are_whole_days(spark):
    assert verification.folds(synthetic(spark, 34)).count() == 0
    few = verification.folds(synthetic(spark, 60)).collect()
    assert len(few) == 3 and {(r["end"] - r["origin"]).days for r in few} == {14}
    many = verification.folds(synthetic(spark, 600)).collect()
    assert {(r["end"] - r["origin"]).days for r in many} == {20} and len(many) <= 30


def test_champion_rules(spark):
    scores = spark.createDataFrame([("a", "tier0", 1.0), ("a", "tier1", 0.99), ("b", "tier0", 1.0), ("b", "tier1", 0.5), ("c", "tier3", 0.1)], "station_id string, tier string, score double")
    gates = spark.createDataFrame([(s, ["tier0", "tier1"]) for s in "abcd"], "station_id string, tiers array<string>")
    held = spark.createDataFrame([("a", "tier0"), ("b", "tier0"), ("c", "tier3")], "station_id string, incumbent string")
    got = {r["station_id"]: r["champion"] for r in walkforward.choose(scores, gates, held).collect()}
    assert got == {"a": "tier0", "b": "tier1", "c": "tier0", "d": "tier0"}  # within the margin; beaten; not eligible; no score


def test_empty_index_is_refused(spark):
    e = spark.createDataFrame([("a", 1)], "id string, seq int")
    assert stations.overlay(e, e.limit(0), e).count() == 1
    with pytest.raises(ValueError):
        stations.overlay(e.limit(0), e.limit(0), e)
