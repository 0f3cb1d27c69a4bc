"""Fixed values of the domain, as plain tables and expressions."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results depend on.
VARIABLES = ("air_temp_c", "rh_pct", "wind_speed_ms", "wind_gust_ms", "precip_1h_mm")
LEVELS = (0.05, 0.25, 0.5, 0.75, 0.95)
QUANTILES = ("q05", "q25", "q50", "q75", "q95")
LEAD_BUCKETS = ((1, 6), (7, 12), (13, 24), (25, 48), (49, 96), (97, 168))
THRESHOLDS = {"air_temp_c": (0.0,), "wind_speed_ms": (5.0, 10.0), "wind_gust_ms": (10.0, 15.0), "precip_1h_mm": (0.1, 1.0)}
BOUNDS = {"rh_pct": (0.0, 100.0), "wind_speed_ms": (0.0, None), "wind_gust_ms": (0.0, None), "precip_1h_mm": (0.0, None)}
RANGES = {"air_temp_c": (-70.0, 60.0), "dewpoint_c": (-80.0, 45.0), "relative_humidity_pct": (0.0, 100.0), "wind_speed_ms": (0.0, 110.0), "wind_gust_ms": (0.0, 150.0), "wind_dir_deg": (0.0, 360.0), "precip_1h_mm": (0.0, 305.0)}
STEPS = {"air_temp_c": 20.0, "dewpoint_c": 20.0, "wind_speed_ms": 60.0}
DEWPOINT_MARGIN = 1.0
FLATLINE_ROWS, FLATLINE_WIND = 24, 0.05
KNOT, KMH, INCH, FOOT = 0.514444, 1 / 3.6, 25.4, 0.3048
DECAY, MIN_CELL, MIN_RESIDUALS, RESIDUAL_WINDOW, POOLED_WINDOW = 0.08, 5, 15, 60, 180
TAU_SHORT, TAU_LONG, TAU_LEAD = 30.0, 60.0, 48
CUTOFF_TAUS, MAX_ROWS, MIN_BUCKET = 5, 6000, 40
MAX_TRAIN_DAYS, SEASONAL_ROWS, SEASONAL_TAUS, SEASONAL_DAYS = 400, 120, 10, 180
BOOSTED_ROWS, STOP_DAYS, STOP_ROWS, STOP_TRAIN = 2000, 60, 100, 500
TIER_GATES = ((0, 0.0, 0), (1, 15.0, 200), (2, 90.0, 1000), (3, 365.0, 4000))
MARGIN = 0.02
PIT_BINS, RESAMPLES, BLOCK_DAYS, INTERVAL = 10, 1000, 8, 0.90
CLIMATE_DAYS, CLIMATE_EXCLUDED = 15, 3
REFIT_DAYS, MIN_TRAIN_DAYS, MAX_REFITS, MIN_TRAIN_ROWS = 14, 21, 30, 100
SELECTION_SHARE = 0.6
COVERAGE_GATE, MIN_BASELINE_ROWS = 0.9, 20
SNOTEL_SUFFIXES = ("SNTL", "SNTLT", "SCAN", "MSNT")
CONUS = (24.0, 50.0, -125.0, -66.0)
WORLD_MODELS, REGIONAL_MODEL = ("gfs_seamless", "ecmwf_ifs025", "icon_seamless"), "ncep_hrrr_conus"
TIER_LABELS = {"tier0": "Bias correction", "tier1": "EMOS", "tier2": "EMOS + harmonics", "tier3": "Boosted quantiles"}
PROMOTE_ROWS, TRAIN_ROWS, COMMON_ROWS, TEST_ROWS = 20, 30, 50, 5
#: Rows of a group that a score card needs, of each part of a tier that is chosen on one and measured on the other, of a model within a bucket; days of the series.
CARD_ROWS, HELD_OUT_ROWS, LOCAL_ROWS, DAILY_DAYS = 200, 100, 11, 90
OCCURRENCE = 0.1
#: Names of the variables in forecast payloads.
PAYLOAD_NAMES = {"air_temp_c": "temperature_2m", "rh_pct": "relative_humidity_2m", "wind_speed_ms": "wind_speed_10m", "wind_gust_ms": "wind_gusts_10m", "precip_1h_mm": "precipitation"}
#: Forecast models: id, label, centre, resolution in km, variables without gusts?, first day of the archive, of earlier runs, global?
FORECAST_MODELS = (
    ("gfs_seamless", "NOAA GFS", "NOAA", 25, False, "2021-03-23", "2021-03-23", True),
    ("ecmwf_ifs025", "ECMWF IFS 0.25°", "ECMWF", 25, True, "2024-02-01", "2024-02-01", True),
    ("ecmwf_aifs025_single", "ECMWF AIFS (AI model)", "ECMWF", 25, True, "2024-04-01", "2024-04-01", True),
    ("icon_seamless", "DWD ICON", "DWD", 11, False, "2022-11-01", "2024-01-01", True),
    ("gem_seamless", "CMC GEM", "ECCC", 10, False, "2022-11-01", "2024-01-01", True),
    ("meteofrance_seamless", "Météo-France ARPEGE/AROME", "MeteoFrance", 10, False, "2022-11-01", "2024-01-01", True),
    ("ukmo_seamless", "UK Met Office", "UKMO", 10, False, "2022-11-01", "2024-03-01", True),
    ("ncep_hrrr_conus", "NOAA HRRR (CONUS 3 km)", "NOAA", 3, False, "2018-01-01", "2024-01-01", False),
    ("ncep_nbm_conus", "NOAA NBM (calibrated benchmark)", "NOAA", 3, False, "2022-01-01", "2024-01-01", False),
)

DENSE = tuple(round(0.01 * i, 2) for i in range(1, 100))
NORMAL_LEVELS = tuple(NormalDist().inv_cdf(q) for q in LEVELS)


def bucket_label(lead: Column) -> Column:
    """Label of the lead-time bucket; leads before the first or after the last bucket take those."""
    out = F.lit(None).cast("string")
    for low, high in reversed(LEAD_BUCKETS):
        out = F.when(lead <= high, f"{low}-{high}").otherwise(out)
    low, high = LEAD_BUCKETS[-1]
    return F.when(lead.isNull(), None).when(lead > high, f"{low}-{high}").otherwise(out)


BUCKET_SQL = "CASE WHEN {0} <= 6 THEN '1-6' WHEN {0} <= 12 THEN '7-12' WHEN {0} <= 24 THEN '13-24' WHEN {0} <= 48 THEN '25-48' WHEN {0} <= 96 THEN '49-96' WHEN {0} IS NOT NULL THEN '97-168' END"


def dense_weights() -> list[list[float]]:
    """For each dense level the weights of the five published quantiles: linear between levels, outer slopes beyond."""
    out = []
    for d in DENSE:
        i = min(max(sum(1 for q in LEVELS if q <= d) - 1, 0), len(LEVELS) - 2)
        t = (d - LEVELS[i]) / (LEVELS[i + 1] - LEVELS[i])
        row = [0.0] * len(LEVELS)
        row[i], row[i + 1] = 1 - t, t
        out.append(row)
    return out
