"""Stand-in tables over the given Parquet files, and the registry of queries.

The texts W1, W2, R1 and D1 run unchanged in Spark and in the checking engine.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.functions.columns import snap_doubles
from daymark.functions.storage import pinned
from daymark.operators.features import SplitPlan
from daymark.schema import MART, WIDE

LAYOUT = replace(WIDE, expected_source="PROVIDER_A")
MART_LAYOUT = MART
SOURCES = (("PROVIDER_A", "Provider A", "daily", "Daily data of provider A"),)
SPLITS = SplitPlan("1999-12-31", "2000-01-01", "2000-12-31", "2001-01-01", "2001-12-31")
STORED_UNTIL = "2000-01-01"
MEASURES = list(WIDE.measures)

_MEASURES_SQL = """
  CAST(SUM(CAST(l_quantity AS BIGINT)) AS DOUBLE)/COUNT(*) AS t2m,
  MIN(l_quantity) AS t2m_min, MAX(l_quantity) AS t2m_max,
  CAST(SUM(CAST(ROUND(l_discount*100) AS BIGINT)) AS DOUBLE)*10.0/COUNT(*) AS rh2m,
  CAST(SUM(CAST(ROUND(l_extendedprice*100) AS BIGINT)) AS DOUBLE)/1000000.0 AS prectotcorr,
  CAST(SUM(CAST(ROUND(l_tax*100) AS BIGINT)) AS DOUBLE)/COUNT(*) AS ws2m,
  MAX(l_extendedprice)/1000.0 AS allsky_sfc_sw_dwn"""

W1 = f"""SELECT CAST(l_shipdate AS DATE) AS date, l_linestatus AS location,
  CASE WHEN l_linestatus='O' THEN -3.5E0 ELSE -6.25E0 END AS latitude,
  CASE WHEN l_linestatus='O' THEN 36.5E0 ELSE 39.25E0 END AS longitude,
  'PROVIDER_A' AS source,{_MEASURES_SQL}
FROM lineitem GROUP BY CAST(l_shipdate AS DATE), l_linestatus"""

W2 = f"""SELECT CAST(l_shipdate AS DATE) AS date,
  CONCAT('S', CAST(l_suppkey AS VARCHAR(20))) AS location,
  CAST(-(l_suppkey % 12) AS DOUBLE) AS latitude,
  CAST(30 + l_suppkey % 10 AS DOUBLE) AS longitude,
  'PROVIDER_A' AS source,{_MEASURES_SQL}
FROM lineitem GROUP BY CAST(l_shipdate AS DATE), l_suppkey"""

R1 = """SELECT event_id AS row_number,
 CASE WHEN event_id % 211 = 0 THEN 'not-a-date'
      ELSE CAST(CAST(ts AS DATE) AS VARCHAR(20)) END AS date,
 CASE WHEN event_id % 223 = 0 THEN '  '
      ELSE CONCAT(event_type,'_',CAST(user_id AS VARCHAR(20))) END AS location,
 CASE WHEN event_id % 229 = 0 THEN '95.5' ELSE CAST(-(user_id % 12) AS VARCHAR(20)) END AS latitude,
 CAST(30 + user_id % 10 AS VARCHAR(20)) AS longitude,
 CASE WHEN event_id % 227 = 0 THEN 'OTHER' ELSE 'PROVIDER_A' END AS source,
 CASE WHEN event_id % 233 = 0 THEN NULL WHEN event_id % 239 = 0 THEN 'broken' ELSE '20.5' END AS t2m,
 '15.25' AS t2m_min,
 CASE WHEN event_id % 241 = 0 THEN '18.0' ELSE '28.75' END AS t2m_max,
 CASE WHEN event_id % 251 = 0 THEN '120' ELSE CAST(user_id % 101 AS VARCHAR(20)) END AS rh2m,
 CASE WHEN event_id % 257 = 0 THEN '-1' WHEN event_id % 263 = 0 THEN '1000'
      ELSE CAST(event_id % 50 AS VARCHAR(20)) END AS prectotcorr,
 CASE WHEN event_id % 269 = 0 THEN '-999' ELSE '2.5' END AS ws2m,
 '20.25' AS allsky_sfc_sw_dwn
FROM events"""

# R1 with types but without the quarantine: a table on which the rules must fail.
D1 = """SELECT TRY_CAST(date AS DATE) AS date, location,
 TRY_CAST(latitude AS DOUBLE) AS latitude, TRY_CAST(longitude AS DOUBLE) AS longitude, source,
 TRY_CAST(t2m AS DOUBLE) AS t2m, TRY_CAST(t2m_min AS DOUBLE) AS t2m_min,
 TRY_CAST(t2m_max AS DOUBLE) AS t2m_max, TRY_CAST(rh2m AS DOUBLE) AS rh2m,
 TRY_CAST(prectotcorr AS DOUBLE) AS prectotcorr, TRY_CAST(ws2m AS DOUBLE) AS ws2m,
 TRY_CAST(allsky_sfc_sw_dwn AS DOUBLE) AS allsky_sfc_sw_dwn
FROM r1"""

# A dense table: every supplier has a reading for every day from 1997-01-01 on.
W3 = """SELECT DATE '1997-01-01' + CAST(n AS INT) AS date,
  CONCAT('S', CAST(k AS VARCHAR(20))) AS location,
  CAST(-(k % 12) AS DOUBLE) AS latitude, CAST(30 + k % 10 AS DOUBLE) AS longitude,
  'PROVIDER_A' AS source,
  CAST((k * 7 + n * 13) % 300 AS DOUBLE) / 8.0 AS t2m,
  CAST((k * 7 + n * 13) % 300 - 40 AS DOUBLE) / 8.0 AS t2m_min,
  CAST((k * 7 + n * 13) % 300 + 40 AS DOUBLE) / 8.0 AS t2m_max,
  CAST((k * 11 + n * 17) % 101 AS DOUBLE) AS rh2m,
  CAST(CASE WHEN (k + n) % 3 = 0 THEN (k * 31 + n * 29) % 400 ELSE 0 END AS DOUBLE) / 8.0 AS prectotcorr,
  CAST((k * 3 + n * 5) % 90 AS DOUBLE) / 8.0 AS ws2m,
  CAST((k * 19 + n * 23) % 240 AS DOUBLE) / 8.0 AS allsky_sfc_sw_dwn
FROM (SELECT DISTINCT l_suppkey AS k FROM lineitem) suppliers
CROSS JOIN (SELECT DISTINCT event_id % 2000 AS n FROM events) days"""

VIEWS = {"w3": W3, "w1": W1, "w2": W2, "r1": R1, "d1": D1}
_NEEDS = {"d1": ("r1",)}


class Tables:
    """The stand-in tables as DataFrames, made when first used."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _view(self, text: str, base: str, df: DataFrame) -> DataFrame:
        return self.spark.sql(text.replace(f"FROM {base}", "FROM {base}"), base=df)

    @cached_property
    def w1(self) -> DataFrame:
        return self._view(W1, "lineitem", self.given("lineitem"))

    @cached_property
    def w2(self) -> DataFrame:
        return self._view(W2, "lineitem", self.given("lineitem"))

    @cached_property
    def w2_kept(self) -> DataFrame:
        """w2 written once, for queries that read it several times."""
        return pinned(self.w2.sortWithinPartitions("date", "location"), "w2")

    @cached_property
    def w3(self) -> DataFrame:
        text = W3.replace("FROM lineitem", "FROM {lineitem}").replace("FROM events", "FROM {events}")
        return self.spark.sql(text, lineitem=self.given("lineitem"), events=self.given("events"))

    @cached_property
    def r1(self) -> DataFrame:
        return self._view(R1, "events", self.given("events"))

    @cached_property
    def d1(self) -> DataFrame:
        return self._view(D1, "r1", self.r1)


_ROLLING = ("precip_mean_7d_available precip_mean_30d_available temperature_mean_7d_available "
            "humidity_mean_7d_available")
_MONTHLY = ("mean_temperature mean_min_temperature mean_max_temperature mean_relative_humidity "
            "total_precipitation mean_wind_speed mean_solar_radiation")
#: Per query the columns whose last digits depend on the order in which doubles were added: sums,
#: means, deviations and correlations, and what is computed from them; and quantiles that lie between
#: two values, which engines interpolate by different formulas. Only these are compared on a grid;
#: every other double has to be equal.
ROUNDED = {
    "monthly_mean_by_location": "mean_daily_precipitation",
    "annual_sum_by_location": "annual_precipitation",
    "monthly_total_by_location": "total_precipitation",
    "first_monthly_row": "total_precipitation mean_temperature",
    "tolerant_compare_join": "max_abs_difference",
    "aggregates_equal": "max_abs_difference",
    "qc_iqr_bounds": "q1 q3 iqr lower_bound upper_bound",
    "qc_iqr_flags": "q1 q3 iqr lower_bound upper_bound",
    "profile_describe": "mean std p25 p50 p75",
    "profile_percentiles": "p0_1 p1 p5 p50 p95 p99 p99_9",
    "profile_rain_percentiles": "p90 p95 p99 p99_5 p99_9",
    "profile_temperature_extremes": "mean_temp t2m_p01 t2m_p99",
    "profile_temperature_jumps": "threshold",
    "profile_rain_jumps": "threshold",
    "profile_monthly_climatology": " ".join(MEASURES),
    "profile_monthly_rain_matrix": "mean_rain",
    "profile_location_stats": "mean std",
    "summary_location_stats": "mean std",
    "profile_correlations": "correlation",
    "profile_variance": "variance std_dev",
    "delayed_rolling_means": _ROLLING,
    "drop_incomplete": _ROLLING,
    "boundary_purge": _ROLLING,
    "temporal_split": _ROLLING,
    "legacy_features": "precip_rolling_7d precip_rolling_30d temperature_rolling_7d humidity_rolling_7d",
    "monthly_climate": _MONTHLY,
    "dashboard_rows": "total_precipitation mean_temperature",
    "dashboard_bar_share": "total_precipitation bar_share bar_height",
    "star_monthly_mean": "mean_daily_precipitation",
}


@dataclass(frozen=True)
class Entry:
    name: str
    build: Callable[[Tables], DataFrame]
    oracle: str | None
    doubles: tuple[str, ...]

    @property
    def rounded(self) -> tuple[str, ...]:
        return tuple(ROUNDED.get(self.name, "").split())

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return snap_doubles(self.build(Tables(spark, folder)), self.rounded)

    def sql(self) -> str | None:
        """The oracle with the stand-in tables it names, rounded where the query is."""
        if self.oracle is None:
            return None
        used = [v for v in VIEWS if re.search(rf"\b{v}\b", self.oracle)]
        for view in list(used):
            used += [n for n in _NEEDS.get(view, ()) if n not in used]
        views = ", ".join(f"{v} AS ({VIEWS[v]})" for v in VIEWS if v in used)
        body = self.oracle.strip()
        if views:
            body = f"WITH {views}, " + body[5:] if body.upper().startswith("WITH ") \
                else f"WITH {views} {body}"
        if not self.rounded:
            return body
        rounded = ", ".join(f"ROUND({c} * 1048576) / 1048576 AS {c}" for c in self.rounded)
        return f"SELECT * REPLACE ({rounded}) FROM ({body})"


REGISTRY: dict[str, Entry] = {}


def query(name: str, oracle: str | None = None, doubles: Sequence[str] | str = ()):
    """Register a query under the key it has in the operator inventory."""
    names = tuple(doubles.split()) if isinstance(doubles, str) else tuple(doubles)

    def register(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")
        REGISTRY[name] = Entry(name, build, oracle, names)
        return build
    return register


def literal_time(text: str):
    return F.lit(text).cast("timestamp_ntz")


POINT = "latitude longitude"
WIDE_DOUBLES = POINT + " " + " ".join(MEASURES)
WIDE_COLUMNS = "date, location, latitude, longitude, source, " + ", ".join(MEASURES)


def values_sql(rows: Sequence[tuple], names: str) -> str:
    def text(v):
        return str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"
    body = ", ".join("(" + ", ".join(text(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(names.split())})"
