"""Shapes of physical plans that must not be lost."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from daymark.functions import quantiles, storage
from daymark.operators import features, profiling, quality, queries, serving, star
from daymark.schema import WIDE
from daymark.sources import tables


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "wide")
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(days=i), f"P{i % 5}", 1.0, 2.0, "NASA_POWER",
             *[float(i)] * 7) for i in range(50)]
    tables.write_wide_parquet(spark.createDataFrame(rows, WIDE.wide_schema()), path)
    return tables.read_wide_parquet(spark, path)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(stored):
    text = plan(queries.project_date_range(stored, "2020-01-01", "2020-01-31"))
    assert "GreaterThanOrEqual(date" in text and "LessThanOrEqual(date" in text
    assert "rh2m" not in text.split("ReadSchema")[1]
    assert "EqualTo(location,P1)" in plan(
        queries.filter_location_range(stored, "P1", "2020-01-01", "2020-01-31"))


def test_monthly_mean_shuffles_once_before_sorting(stored):
    text = plan(queries.monthly_mean_by_location(stored))
    assert text.count("hashpartitioning") == 1 and "partial_avg" in text


def test_rules_take_one_wide_shuffle_and_read_once(stored):
    text = plan(quality.rule_counts(stored))
    assert text.count("Exchange hashpartitioning") == 2 and text.count("FileScan") == 1


def test_no_pair_joins(stored):
    s = star.build_star(stored)
    mart = serving.mart_from_facts(s["fact_observation"], s["dim_date"], s["dim_location"],
                                   s["dim_variable"], s["dim_source"])
    text = plan(serving.monthly_climate(mart))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def scans(df) -> int:
    return plan(df).count("FileScan parquet")


@pytest.fixture
def written(monkeypatch):
    """The plans of the intermediate tables that a call writes, counted scans of its source."""
    plans = []

    def noted(df, label="pinned"):
        plans.append(plan(df))
        return storage.pinned(df, label)

    monkeypatch.setattr(quantiles, "pinned", noted)
    return plans


def test_quantiles_scan_twice(stored, written):
    """One scan brackets all ranks of all variables, one counts; nothing later reads the source."""
    for call in (quality.iqr_flags, quality.iqr_bounds, profiling.profile_percentiles,
                 profiling.profile_describe, profiling.profile_temperature_extremes):
        written.clear()
        result = call(stored)
        source = stored.inputFiles()[0].rsplit("/", 2)[0].replace("file://", "")
        assert len(written) == 2 and [p.count(f"{source}") > 0 for p in written] == [True, True]
        assert sum(p.count("ReadSchema") for p in written[:1]) == 1
        # The second reads the source once, and the short table of brackets.
        assert written[1].count("ReadSchema") == 2
        later = plan(result)
        assert later.count(source) <= (1 if call is profiling.profile_temperature_extremes else 0)


def test_audit_reads_each_table_once(spark, stored, tmp_path):
    made = {}
    for name, df in star.build_star(stored).items():
        df.write.parquet(str(tmp_path / name))
        made[name] = spark.read.parquet(str(tmp_path / name))
    text = plan(star.constraint_audit(made))
    assert scans(star.constraint_audit(made)) == len(made)
    assert text.count("Exchange hashpartitioning") == 2


def test_first_load_shuffles_rows_once(stored):
    """Sources of a day and point are counted where the block of the day is sorted."""
    made = star.build_star(stored)
    text = plan(star.facts_from_wide(stored, made))
    assert "Exchange hashpartitioning(date_id#" in text and not [
        line for line in text.splitlines() if "Exchange hashpartitioning(date_id" in line and "location_id" in line]


def test_audit_counts_close_numbers_in_one_row(spark):
    """Facts of a day and point take a row per word of numbers, and repeats and lost references are exact."""
    days = spark.range(20_000).selectExpr("CAST(20200101 + id % 7 AS INT) AS date_id", "CAST(id DIV 49 AS INT) AS location_id",
                                          "CAST(id DIV 7 % 7 AS INT) AS variable_id", "1 AS source_id",
                                          "id - 10000 AS observation_id")
    facts = days.coalesce(1).sortWithinPartitions("date_id", "location_id").unionByName(
        days.filter("observation_id IN (-9, 0, 7)")).unionByName(
        days.limit(2).withColumns({"observation_id": F.lit(None).cast("long"), "variable_id": F.lit(None).cast("int")}))
    dims = {"dim_location": days.selectExpr("location_id", "CAST(location_id AS STRING) AS location_name", "1D AS latitude",
                                            "1D AS longitude").distinct().filter("location_id <> 9"),
            "dim_date": days.selectExpr("date_id", "date_id AS full_date", "1 AS year", "1 AS quarter", "1 AS month",
                                        "'a' AS month_name", "1 AS day", "1 AS day_of_year").distinct(),
            "dim_variable": days.selectExpr("variable_id", "variable_id AS variable_code", "'v' AS variable_name").distinct(),
            "dim_source": spark.sql("SELECT 1 AS source_id, 's' AS source_name"), "fact_observation": facts,
            "fact_quality_flag": spark.sql("SELECT explode(array(-9L, -10001L, -10001L, 12L, 20000L, NULL)) AS observation_id, "
                                           "1L AS quality_flag_id, 'r' AS rule_name")}
    audit = star.constraint_audit(dims)
    got = {r["constraint"]: r["violations"] for r in audit.collect() if r["violations"]}
    assert got == {
        "unique fact_observation(observation_id)": 4,
        "unique fact_observation(date_id, location_id, variable_id, source_id)": 3,
        "unique fact_quality_flag(quality_flag_id)": 5,
        "not null fact_observation.variable_id": 2, "not null fact_quality_flag.observation_id": 1,
        "reference fact_observation.location_id -> dim_location": days.filter("location_id = 9").count(),
        "reference fact_observation.variable_id -> dim_variable": 2,
        "reference fact_quality_flag.observation_id -> fact_observation": 4}, got
    assert "bit_or" in plan(audit)


def test_features_shuffle_rows_once_without_sliding_frames(stored, spark):
    mart = stored.selectExpr("date AS observation_date", "location AS location_name", "latitude", "longitude",
                             "source AS source_name", "PRECTOTCORR AS prectotcorr", "T2M AS t2m", "RH2M AS rh2m")
    text = plan(features.create_features(mart))
    # Rows once, counts per series once.
    assert text.count("Exchange hashpartitioning") == 2 and text.count("Sort [") == 1
    assert "avg(" not in text


def test_other_layouts_are_not_dealt_to_a_fixed_number_of_tasks(spark, tmp_path):
    """The rearranged marts of the fingerprint queries are spread by size."""
    from daymark.catalog import REGISTRY
    from daymark.catalog.base import Tables

    spark.range(2000).selectExpr(
        "id AS l_suppkey", "CAST(id AS DOUBLE) AS l_quantity", "1.0D AS l_extendedprice", "0.1D AS l_discount",
        "0.1D AS l_tax", "'O' AS l_linestatus", "TIMESTAMP '2000-01-01' AS l_shipdate") \
        .write.parquet(str(tmp_path / "lineitem.parquet"))
    for name in ("preserved_tables", "logical_fingerprint"):
        result = REGISTRY[name].build(Tables(spark, str(tmp_path)))
        text = result._jdf.queryExecution().executedPlan().toString()
        assert "REPARTITION_BY_NUM" not in text and "REBALANCE_PARTITIONS_BY" in text


def test_stored_keys_need_no_numbering(stored):
    """Keys of facts that are numbered on the way are read without the sort that numbers them."""
    made = star.build_star(stored)
    numbered = star.fact_load(made["fact_observation"].drop("observation_id", "ingested_at"))
    text = plan(star.fact_marks(numbered))
    assert "Window" not in text and "Join" not in text and text.count("Exchange") == 1
