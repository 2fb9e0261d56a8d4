"""Feature rules on one generated series: a series of known readings per day."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from daymark.operators import features
from daymark.operators.features import AVAILABILITY

DAYS = (dt.date(2022, 2, 1) - dt.date(2018, 10, 1)).days + 1


@pytest.fixture(scope="module")
def series(spark):
    day = F.date_add(F.lit("2018-10-01").cast("date"), F.col("id").cast("int"))
    fixed = {"t2m": 20.0, "rh2m": 70.0, "t2m_min": 10.0, "t2m_max": 30.0, "ws2m": 2.0,
             "allsky_sfc_sw_dwn": 20.0, "latitude": -3.0, "longitude": 36.0}
    return spark.range(DAYS).select(
        day.alias("observation_date"), F.lit("Example").alias("location_name"),
        F.lit("NASA_POWER").alias("source_name"), F.col("id").cast("double").alias("prectotcorr"),
        *[F.lit(v).alias(c) for c, v in fixed.items()])


def test_recent_readings_do_not_move_features(spark, series):
    assert features.leakage_probe(series, "2019-01-10").first()["unchanged"] is True
    early = features.FeaturePlan(delay=7, lags=(8, 14, 30))
    probe = features.leakage_probe(series, "2019-01-10", AVAILABILITY)
    assert probe.count() == 1
    made = features.create_features(series, early)
    assert made.filter("precip_mean_7d_available IS NULL").count() == 13


def test_values_at_one_day(series):
    row = features.create_features(series).filter("observation_date = DATE '2019-01-10'").first()
    n = (dt.date(2019, 1, 10) - dt.date(2018, 10, 1)).days
    assert (row["precip_lag_8"], row["precip_lag_14"], row["precip_lag_30"]) == (
        n - 8, n - 14, n - 30)
    assert row["precip_mean_7d_available"] == sum(range(n - 14, n - 7)) / 7
    assert row["precip_mean_30d_available"] == sum(range(n - 37, n - 7)) / 30
    assert row["target_precip_next_day"] == n + 1
    assert row["target_date"] == dt.date(2019, 1, 11)
    assert row["latest_weather_observation_date"] == dt.date(2019, 1, 2)
    assert not {"t2m", "rh2m", "prectotcorr"} & set(AVAILABILITY.predictors)


def test_splits_respect_target_dates(series):
    made = features.create_features(series)
    ready = features.boundary_purge(features.drop_incomplete(made))
    split = features.temporal_split(ready)
    assert all(r["ok"] for r in features.split_checks(split).collect())
    counts = features.removal_counts(made).first()
    assert counts["source_rows"] == DAYS
    assert counts["history_or_target_rows_removed"] == 38
    assert counts["target_boundary_rows_removed"] == 2
    assert split.count() == ready.count() == counts["ml_ready_rows"]
    edges = ready.filter("observation_date IN (DATE '2018-12-31', DATE '2021-12-31')")
    assert edges.count() == 0


def test_missing_day_fails(series):
    broken = series.filter("observation_date <> DATE '2018-11-20'")
    with pytest.raises(Exception, match="continuous"):
        features.create_features(broken).collect()
    breaks = features.continuity_check(broken).collect()
    assert [(r["observation_date"], r["gap_days"]) for r in breaks] == [
        (dt.date(2018, 11, 21), 2)]


def test_repeated_day_fails_even_when_it_hides_a_gap(series):
    twice = series.filter("observation_date <> DATE '2018-11-20'").unionByName(
        series.filter("observation_date = DATE '2019-05-05'"))
    with pytest.raises(Exception, match="continuous"):
        features.create_features(twice).collect()


def test_long_gap_at_a_years_end_fails(series):
    broken = series.filter("observation_date NOT BETWEEN DATE '2018-12-01' AND DATE '2019-02-15'")
    with pytest.raises(Exception, match="continuous"):
        features.create_features(broken).collect()


def test_empty_split_is_reported(series):
    ready = features.ml_ready(series.filter("observation_date < DATE '2020-01-01'"))
    checks = {r["check"]: r["ok"] for r in features.split_checks(
        features.temporal_split(ready)).collect()}
    assert checks["train_not_empty"] and not checks["test_not_empty"]


def test_probe_finds_plans_that_read_too_early(series):
    dates = ["2019-01-10", "2021-01-01"]
    assert [r["unchanged"] for r in features.leakage_probe(series, dates).collect()] == [True, True]
    ahead = features.FeaturePlan(lags=(8, 14, -3))
    early = features.FeaturePlan(lags=(7, 14, 30))
    for plan in (ahead, early):
        probe = features.leakage_probe(series, "2019-06-10", plan, delay=AVAILABILITY.delay)
        assert [r["unchanged"] for r in probe.collect()] == [False]


def test_rolling_means_skip_missing_readings_and_are_exact(spark):
    """Prefix sums against plain sums: missing and infinite readings, two series, years' edges."""
    rng = random.Random(5)
    start = dt.date(2018, 12, 10)
    rows, values = [], {}
    for name in ("A", "B"):
        values[name] = [rng.choice([None, float("inf"), *[rng.randrange(1 << 20) / 64 for _ in range(40)]])
                        for _ in range(420)]
        rows += [(start + dt.timedelta(days=i), name, "S", 1.0, 2.0, v, v, 3.0)
                 for i, v in enumerate(values[name])]
    df = spark.createDataFrame(rows, "observation_date date, location_name string, source_name string, "
                               "latitude double, longitude double, prectotcorr double, t2m double, rh2m double")
    for r in features.delayed_rolling_means(df.repartition(3)).collect():
        i = (r["observation_date"] - start).days
        for name, days in (("precip_mean_7d_available", 7), ("precip_mean_30d_available", 30),
                           ("temperature_mean_7d_available", 7)):
            window = values[r["location_name"]][max(0, i - 7 - days):max(0, i - 7)]
            full = len(window) == days and all(v is not None and v != float("inf") for v in window)
            assert r[name] == (sum(window) / days if full else None)


def test_filter_on_one_day_keeps_the_check_quiet(series):
    assert features.create_features(series).filter("observation_date = DATE '2019-01-10'").count() == 1
