"""Feature, split and leakage queries over the dense table."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from daymark.catalog.base import SPLITS, Tables, query
from daymark.operators import features
from daymark.operators.features import AVAILABILITY, LEGACY
from daymark.operators.serving import mart_from_wide


def mart(t: Tables):
    return mart_from_wide(t.w3)


MART = """mart AS (SELECT date AS observation_date, location AS location_name,
 source AS source_name, latitude, longitude, t2m, rh2m, prectotcorr FROM w3)"""
OVER = "OVER (PARTITION BY location_name, source_name ORDER BY observation_date{frame})"
W = OVER.format(frame="")


def _rolling(measure: str, name: str, delay: int, days: int) -> str:
    frame = OVER.format(
        frame=f" ROWS BETWEEN {delay + days - 1} PRECEDING AND {delay} PRECEDING")
    return (f"CASE WHEN COUNT({measure}) {frame} = {days} THEN AVG({measure}) {frame} END "
            f"AS {name}")


def _lags(plan) -> str:
    return ", ".join(f"LAG(prectotcorr, {n}) {W} AS {plan.lag_prefix}{n}" for n in plan.lags)


def _rollings(plan) -> str:
    return ", ".join(_rolling(r.measure, r.name, plan.delay, r.days) for r in plan.rolling)


def features_sql(plan) -> str:
    columns = ", ".join([*plan.audit, *plan.predictors])
    return f"""feats AS (SELECT {columns} FROM (SELECT *,
 CAST(month(observation_date) AS INTEGER) AS month,
 CAST(dayofyear(observation_date) AS INTEGER) AS day_of_year, {_lags(plan)}, {_rollings(plan)},
 LAG(observation_date, {plan.delay}) {W} AS latest_weather_observation_date,
 LEAD(prectotcorr) {W} AS {plan.target}, LEAD(observation_date) {W} AS target_date FROM mart)),
complete AS (SELECT * FROM feats WHERE {' AND '.join(f'{c} IS NOT NULL' for c in
 [*plan.predictors, plan.target, 'target_date', 'latest_weather_observation_date'])}),
ready AS (SELECT * FROM complete WHERE NOT ({CROSSES}))"""


CROSSES = f"""(observation_date <= DATE '{SPLITS.train_end}'
 AND target_date > DATE '{SPLITS.train_end}') OR (
 observation_date BETWEEN DATE '{SPLITS.validation_start}' AND DATE '{SPLITS.validation_end}'
 AND target_date > DATE '{SPLITS.validation_end}')"""


def split_sql(source: str, end: str) -> str:
    return f"""SELECT * FROM (SELECT *,
 CASE WHEN observation_date <= DATE '{SPLITS.train_end}'
  AND {end} <= DATE '{SPLITS.train_end}' THEN 'train'
 WHEN observation_date >= DATE '{SPLITS.validation_start}'
  AND {end} <= DATE '{SPLITS.validation_end}' THEN 'validation'
 WHEN observation_date >= DATE '{SPLITS.test_start}'
  AND {end} <= DATE '{SPLITS.test_end}' THEN 'test' END AS split FROM {source})
 WHERE split IS NOT NULL"""


FEATS = f"WITH {MART}, {features_sql(AVAILABILITY)}"
FEATURE_DOUBLES = ["latitude", "longitude", AVAILABILITY.target,
                   *[f"precip_lag_{n}" for n in AVAILABILITY.lags],
                   *[r.name for r in AVAILABILITY.rolling]]
KEYS = "observation_date, location_name, source_name"


@query("continuity_check",
       """WITH days AS (SELECT location AS location_name, source AS source_name,
 date AS observation_date, COUNT(*) AS copies FROM d1 GROUP BY ALL),
prev AS (SELECT *, LAG(observation_date) OVER (PARTITION BY location_name, source_name
 ORDER BY observation_date NULLS FIRST) AS previous_date FROM days)
SELECT *, CAST(DATE_DIFF('day', previous_date, observation_date) AS INTEGER) AS gap_days FROM prev
WHERE copies > 1 OR DATE_DIFF('day', previous_date, observation_date) <> 1""")
def _(t: Tables):
    return features.continuity_check(mart_from_wide(t.d1))


@query("calendar_features",
       f"WITH {MART} SELECT {KEYS}, CAST(month(observation_date) AS INTEGER) AS month, "
       "CAST(dayofyear(observation_date) AS INTEGER) AS day_of_year FROM mart")
def _(t: Tables):
    return features.calendar_features(mart(t)).select(
        "observation_date", "location_name", "source_name", "month", "day_of_year")


@query("delayed_lags", f"WITH {MART} SELECT {KEYS}, {_lags(AVAILABILITY)} FROM mart",
       "precip_lag_8 precip_lag_14 precip_lag_30")
def _(t: Tables):
    return features.delayed_lags(mart(t))


@query("delayed_rolling_means", f"WITH {MART} SELECT {KEYS}, {_rollings(AVAILABILITY)} FROM mart",
       [r.name for r in AVAILABILITY.rolling])
def _(t: Tables):
    return features.delayed_rolling_means(mart(t))


@query("as_of_and_target",
       f"WITH {MART} SELECT {KEYS}, LAG(observation_date, 8) {W} AS "
       f"latest_weather_observation_date, LEAD(prectotcorr) {W} AS target_precip_next_day, "
       f"LEAD(observation_date) {W} AS target_date FROM mart", "target_precip_next_day")
def _(t: Tables):
    return features.as_of_and_target(mart(t))


@query("drop_incomplete", f"{FEATS} SELECT * FROM complete", FEATURE_DOUBLES)
def _(t: Tables):
    return features.drop_incomplete(features.create_features(mart(t)))


@query("boundary_purge", f"{FEATS} SELECT * FROM ready", FEATURE_DOUBLES)
def _(t: Tables):
    return features.ml_ready(mart(t), splits=SPLITS)


def split(t: Tables):
    return features.temporal_split(features.ml_ready(mart(t), splits=SPLITS), SPLITS)


@query("temporal_split", f"{FEATS} {split_sql('ready', 'target_date')}", FEATURE_DOUBLES)
def _(t: Tables):
    return split(t)


_CHECKS = """s AS ({split}), f AS (SELECT
 {counts}, COUNT(*) FILTER (DATE_DIFF('day', observation_date, target_date) <> 1) AS not_next,
 COUNT(*) FILTER (DATE_DIFF('day', latest_weather_observation_date, observation_date) < 8)
 AS too_recent FROM s)
SELECT c."check", CAST(c.expected AS BIGINT) AS expected, CAST(c.actual AS BIGINT) AS actual,
 c.expected = c.actual AS ok FROM f, LATERAL (VALUES
 ('train_not_empty', 1, CAST(n_train > 0 AS INTEGER)),
 ('validation_not_empty', 1, CAST(n_validation > 0 AS INTEGER)),
 ('test_not_empty', 1, CAST(n_test > 0 AS INTEGER)),
 ('train_before_validation', 1, CAST(COALESCE(end_train < start_validation, false) AS INTEGER)),
 ('validation_before_test', 1, CAST(COALESCE(end_validation < start_test, false) AS INTEGER)),
 ('target_is_next_day', 0, not_next), ('newest_reading_old_enough', 0, too_recent))
 AS c("check", expected, actual)"""
_COUNTS = ", ".join(
    f"COUNT(*) FILTER (split = '{s}') AS n_{s}, "
    f"MAX(CASE WHEN split = '{s}' THEN target_date END) AS end_{s}, "
    f"MIN(CASE WHEN split = '{s}' THEN observation_date END) AS start_{s}"
    for s in features.SPLITS)


@query("split_checks", f"{FEATS}, "
       + _CHECKS.format(split=split_sql("ready", "target_date"), counts=_COUNTS))
def _(t: Tables):
    return features.split_checks(split(t))


_REMOVED = ("(SELECT COUNT(*) FROM feats) AS source_rows, "
            "(SELECT COUNT(*) FROM feats) - (SELECT COUNT(*) FROM complete) "
            "AS history_or_target_rows_removed, (SELECT COUNT(*) FROM complete) - "
            "(SELECT COUNT(*) FROM ready) AS target_boundary_rows_removed, "
            "(SELECT COUNT(*) FROM ready) AS ml_ready_rows")


@query("split_metadata",
       f"{FEATS} SELECT split, COUNT(*) AS rows, MAX(observation_date) AS feature_end, "
       f"MAX(target_date) AS target_end, {_REMOVED}, '{'|'.join(AVAILABILITY.predictors)}' "
       f"AS predictors, '{'|'.join(AVAILABILITY.audit)}' AS excluded "
       f"FROM ({split_sql('ready', 'target_date')}) GROUP BY split")
def _(t: Tables):
    removed = features.removal_counts(features.create_features(mart(t)), splits=SPLITS)
    return features.split_metadata(split(t), removed)


@query("removal_counts", f"{FEATS} SELECT {_REMOVED}")
def _(t: Tables):
    return features.removal_counts(features.create_features(mart(t)), splits=SPLITS)


_LEGACY_DOUBLES = ["latitude", "longitude", LEGACY.target,
                   *[f"precip_lag_{n}" for n in LEGACY.lags], *[r.name for r in LEGACY.rolling]]


@query("legacy_features",
       f"WITH {MART}, {features_sql(LEGACY)} {split_sql('complete', 'observation_date')}",
       _LEGACY_DOUBLES)
def _(t: Tables):
    made = features.drop_incomplete(features.create_features(mart(t), LEGACY), LEGACY)
    return features.temporal_split(made, SPLITS, by_target=False)


@query("retention_rate",
       f"{FEATS} SELECT (SELECT COUNT(*) FROM feats) AS source_rows, (SELECT COUNT(*) FROM ready) "
       "AS ml_ready_rows, (SELECT COUNT(*) FROM ready) / (SELECT COUNT(*) FROM feats) "
       "AS retention_rate", "retention_rate")
def _(t: Tables):
    return features.retention_rate(
        features.removal_counts(features.create_features(mart(t)), splits=SPLITS))


LEAKING = replace(AVAILABILITY, lags=(7, 14, 30))


@query("leakage_probe",
       "SELECT DISTINCT location AS location_name, source AS source_name, date AS issue_date, "
       "plan, plan = 'available' AS unchanged FROM w3, (VALUES ('available'), ('leaking')) p(plan) "
       "WHERE date IN (DATE '1998-01-10', DATE '2000-12-31')")
def _(t: Tables):
    """Two issue dates, with a plan that waits for the readings and one that is a day too early."""
    dates = ["1998-01-10", "2000-12-31"]
    parts = [features.leakage_probe(mart(t), dates, plan, delay=AVAILABILITY.delay)
             .withColumn("plan", F.lit(name))
             for name, plan in (("available", AVAILABILITY), ("leaking", LEAKING))]
    return parts[0].unionByName(parts[1])
