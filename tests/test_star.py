import datetime as dt

import pytest
from pyspark.sql import functions as F

from daymark.functions import digest
from daymark.operators import quality, serving, star
from daymark.plans import load_star, refresh_serving
from daymark.plans.pipeline import refresh_log
from daymark.schema import WIDE
from daymark.sources import publish

AT = dt.datetime(2024, 1, 31)


def wide(spark, *rows):
    """Rows of (date, location[, source[, t2m]])."""
    made = []
    for day, place, *rest in rows:
        source = rest[0] if rest else "NASA_POWER"
        t2m = rest[1] if len(rest) > 1 else 20.0
        made.append((dt.date.fromisoformat(day), place, -3.0, 36.0, source, t2m, 15.0, 25.0, 60.0,
                     None, 2.0, 20.0))
    return spark.createDataFrame(made, WIDE.wide_schema())


THREE = (("2020-01-01", "A"), ("2020-01-02", "A"), ("2020-01-01", "B"))


def test_reload_adds_only_what_is_new(spark):
    tables = star.build_star(wide(spark, *THREE))
    every = star.fact_dim_lookup(
        star.wide_to_long(wide(spark, *THREE)), tables["dim_date"], tables["dim_location"],
        tables["dim_variable"], tables["dim_source"])
    last = (every["date_id"] == 20200102) & (every["variable_id"] == 7)
    first = star.pinned(star.fact_load(every.filter(~last)))
    assert first.count() == 20
    added = star.pinned(star.fact_load(every, first))
    assert [r["observation_id"] for r in added.collect()] == [21]
    assert star.fact_load(every, first.unionByName(added)).count() == 0


def test_new_names_follow_stored_ids(spark):
    stored = star.pinned(star.dim_location(wide(spark, ("2020-01-01", "M"), ("2020-01-01", "P"))))
    grown = star.dim_location(wide(spark, ("2020-01-02", "A"), ("2020-01-02", "P")),
                              existing=stored)
    assert {r["location_name"]: r["location_id"] for r in grown.collect()} == {
        "M": 1, "P": 2, "A": 3}


def test_a_name_with_two_coordinates_has_one_row(spark):
    df = wide(spark, ("2020-01-01", "A"), ("2020-01-02", "A"), ("2020-01-01", "B"))
    moved = df.withColumn("latitude", F.when(
        (F.col("location") == "A") & (F.dayofmonth("date") == 2), -2.0).otherwise(
        F.col("latitude")))
    rows = {r["location_name"]: (r["location_id"], r["latitude"])
            for r in star.dim_location(moved).collect()}
    assert rows == {"A": (1, -3.0), "B": (3, -3.0)}


def test_unknown_variables_and_units(spark):
    long = spark.createDataFrame([("T2M", 1.0), ("SNOW", 2.0)], "variable_code string, value double")
    assert [r[0] for r in star.dim_variable(long).select("variable_code").collect()] == ["T2M"]
    assert [r[0] for r in star.unknown_variables(long).collect()] == ["SNOW"]
    stored = star.variable_catalog(spark).withColumn("unit", F.lit("kWh"))
    fixed = {r["variable_code"]: r["unit"] for r in star.repair_units(stored).collect()}
    assert fixed["ALLSKY_SFC_SW_DWN"] == "MJ/m2/day" and fixed["T2M"] == "kWh"


def test_pipeline_load_serve_and_failed_refresh(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    first = load_star(wide(spark, *THREE), root, AT)
    ids = {r["observation_id"]: r["value"] for r in first["fact_observation"].collect()}
    assert sorted(ids) == list(range(1, 22))
    again = load_star(wide(spark, *THREE), root, AT)
    assert again["fact_observation"].count() == 21
    more = load_star(wide(spark, *THREE, ("2020-01-03", "AA", "OTHER")), root, AT)
    after = {r["observation_id"]: r["value"] for r in more["fact_observation"].collect()}
    assert len(after) == 28 and {k: after[k] for k in ids} == ids
    assert {r["source_name"]: r["source_id"] for r in more["dim_source"].collect()} == {
        "NASA_POWER": 1, "OTHER": 2}
    assert all(r["violations"] == 0 for r in star.constraint_audit(more).collect())

    mart = refresh_serving(more, root, AT)
    assert mart.count() == 4
    wrong = lambda df: serving.mart_invariants(
        df, serving.monthly_climate(df), 999, 3, 3)
    kept = refresh_serving(more, root, AT + dt.timedelta(days=1), wrong)
    assert kept.count() == 4
    log = publish._attempts(spark, root).filter("output_name = 'mart_weather_daily'")
    assert [r["status"] for r in log.orderBy("attempt").collect()] == ["SUCCESS", "FAILED"]
    label = serving.freshness(log, F.lit("2024-02-01 12:00:00").cast("timestamp")).first()
    assert label["label"] == "FAILED_REFRESH"
    stored = refresh_log(spark, root)
    assert [(r["rows"], r["observation_coverage_end"]) for r in stored.collect()] == [
        (4, dt.date(2020, 1, 3))]
    assert serving.dashboard_fingerprint_check(stored, mart, "mart_weather_daily").first()["ok"]


def test_batch_that_would_lose_readings_is_refused(spark, tmp_path):
    rows = wide(spark, *THREE)
    where = F.col("location") == rows.first()["location"]
    for column in ("date", "location", "source"):
        broken = rows.withColumn(column, F.when(~where, F.col(column)))
        with pytest.raises(ValueError, match=f"rows without a {column}"):
            load_star(broken, str(tmp_path / column), AT)
        assert not (tmp_path / column / "fact_observation").exists()


def test_first_load_numbers_facts_in_order(spark):
    """Several sources of a day and point: ids follow date, location, variable and source."""
    tables = star.build_star(wide(spark, *THREE, ("2020-01-03", "AA", "OTHER"), ("2020-01-03", "B", "OTHER"),
                                  ("2020-01-03", "AA", "THIRD")))
    facts = tables["fact_observation"].orderBy("observation_id").collect()
    keys = [(f["date_id"], f["location_id"], f["variable_id"], f["source_id"]) for f in facts]
    assert keys == sorted(keys) and [f["observation_id"] for f in facts] == list(range(1, 43))


def test_flags_of_two_rules_have_different_ids(spark):
    rows = [(f"2020-01-{d:02d}", "A", "NASA_POWER", 20.0 + d % 3) for d in range(1, 29)]
    tables = star.build_star(wide(spark, *rows, ("2020-01-29", "A", "NASA_POWER", 90.0)))
    bounds = quality.iqr_bounds(wide(spark, *rows)).select("variable_code", "lower_bound", "upper_bound")
    flags = [star.quality_flag_fact(tables["fact_observation"], tables["dim_variable"], bounds, rule=i, rules=2)
             for i in range(2)]
    tables["fact_quality_flag"] = flags[0].unionByName(flags[1])
    audit = {r["constraint"]: r["violations"] for r in star.constraint_audit(tables).collect()}
    assert audit["unique fact_quality_flag(quality_flag_id)"] == 0


def test_batch_with_contradicting_readings_is_refused(spark, tmp_path):
    twice = wide(spark, ("2020-01-01", "A"), ("2020-01-01", "A", "NASA_POWER", 21.0))
    with pytest.raises(ValueError, match="several readings"):
        load_star(twice, str(tmp_path / "w"), AT)


def test_quality_flags_point_at_facts(spark):
    rows = [(f"2020-01-{d:02d}", "A", "NASA_POWER", 20.0 + d % 3) for d in range(1, 29)]
    df = wide(spark, *rows, ("2020-01-29", "A", "NASA_POWER", 90.0))
    tables = star.build_star(df)
    bounds = quality.iqr_bounds(df).select("variable_code", "lower_bound", "upper_bound")
    tables["fact_quality_flag"] = star.quality_flag_fact(
        tables["fact_observation"], tables["dim_variable"], bounds)
    flags = tables["fact_quality_flag"].collect()
    assert [(f["rule_name"], f["notes"]) for f in flags] == [
        ("iqr_flag_T2M", "above upper bound")]
    audit = {r["constraint"]: r["violations"] for r in star.constraint_audit(tables).collect()}
    assert audit["reference fact_quality_flag.observation_id -> fact_observation"] == 0


def test_freshness_labels(spark):
    rows = [("old", dt.datetime(2024, 1, 30, 11), "SUCCESS"),
            ("young", dt.datetime(2024, 1, 30, 13), "SUCCESS"),
            ("broken", dt.datetime(2024, 1, 31, 10), "SUCCESS"),
            ("broken", dt.datetime(2024, 1, 31, 11), "FAILED"),
            ("never", dt.datetime(2024, 1, 31, 11), "RUNNING")]
    log = spark.createDataFrame(rows, "output_name string, attempted_at timestamp_ntz, status string")
    now = F.lit("2024-01-31 12:00:00").cast("timestamp_ntz")
    got = {r["output_name"]: r["label"] for r in serving.freshness(log, now).collect()}
    assert got == {"old": "STALE", "young": "FRESH", "broken": "FAILED_REFRESH",
                   "never": "UNKNOWN"}


def days_of(spark, year, n, place="A", t2m=20.0):
    return wide(spark, *[((dt.date(year, 1, 1) + dt.timedelta(days=i)).isoformat(), place, "NASA_POWER", t2m + i % 5)
                         for i in range(n)])


def test_refresh_writes_changed_years_only(spark, tmp_path):
    """Later loads touch one year each; rows and digest equal a full rebuild."""
    root = str(tmp_path / "warehouse")
    first = days_of(spark, 2018, 40).unionByName(days_of(spark, 2019, 40))
    refresh_serving(load_star(first, root, AT), root, AT)
    versions = sorted((tmp_path / "warehouse/versions/mart_weather_daily").glob("version=*"))
    assert [sorted(p.name for p in v.glob("mart_year=*")) for v in versions] == [["mart_year=2018", "mart_year=2019"]]
    before = {p: p.stat().st_mtime_ns for p in versions[0].rglob("*.parquet")}
    for batch, year in ((days_of(spark, 2020, 30), 2020), (days_of(spark, 2019, 50), 2019)):
        schema = load_star(batch, root, AT + dt.timedelta(days=year - 2018))
        mart = refresh_serving(schema, root, AT + dt.timedelta(days=year - 2018))
        newest = max((tmp_path / "warehouse/versions/mart_weather_daily").glob("version=*"), key=lambda p: p.name)
        assert [p.name for p in newest.glob("mart_year=*")] == [f"mart_year={year}"]
    assert {p: p.stat().st_mtime_ns for p in versions[0].rglob("*.parquet")} == before
    assert mart.count() == 40 + 50 + 30
    rebuilt = serving.mart_from_facts(*[schema[n] for n in (
        "fact_observation", "dim_date", "dim_location", "dim_variable", "dim_source")])
    assert digest.fingerprint(mart).first() == digest.fingerprint(rebuilt).first()
    full = refresh_serving(schema, root, AT + dt.timedelta(days=9), full=True)
    assert digest.fingerprint(full).first() == digest.fingerprint(rebuilt).first()
    assert refresh_log(spark, root).agg(F.max("last_load")).first()[0] == 3


def test_failed_refresh_leaves_its_years_for_the_next(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    refresh_serving(load_star(days_of(spark, 2018, 5), root, AT), root, AT)
    wrong = lambda df: serving.mart_invariants(df, serving.monthly_climate(df), 999, 3, 3)
    kept = refresh_serving(load_star(days_of(spark, 2019, 5), root, AT), root, AT, wrong)
    assert kept.count() == 5
    schema = load_star(days_of(spark, 2020, 5), root, AT)
    assert refresh_serving(schema, root, AT).count() == 15
    # Nothing new: nothing is written, and the mart stays.
    assert refresh_serving(schema, root, AT).count() == 15


def test_load_that_ended_before_its_days_were_written(spark, tmp_path):
    """The days of such a load are made from its facts, so nothing is loaded twice."""
    root = tmp_path / "warehouse"
    load_star(days_of(spark, 2018, 5), str(root), AT)
    load_star(days_of(spark, 2018, 8), str(root), AT)
    lost = root / "fact_days/load=00000002"
    lost.rename(root / "aside")
    again = load_star(days_of(spark, 2018, 8), str(root), AT)
    assert again["fact_observation"].count() == 8 * 7 and lost.exists()


def test_stored_keys_equal_a_plain_anti_join(spark):
    """Days as bits against an anti join on all four columns; missing keys are always new."""
    import random
    rng = random.Random(4)

    def facts(n):
        rows = {(rng.choice([20191231, 20200101, 20200229, 20201231, 20200630, None]), rng.randrange(3),
                 rng.choice([1, 2, None]), 1) for _ in range(n)}
        return spark.createDataFrame([(*r, 1.0) for r in rows], "date_id int, location_id int, variable_id int, "
                                     "source_id int, value double")

    stored, incoming = facts(20), facts(60)
    plain = incoming.join(stored.select(*star.FACT_KEY), list(star.FACT_KEY), "left_anti")
    key = lambda r: tuple(-1 if v is None else v for v in r)
    expected = sorted(map(key, plain.select(*star.FACT_KEY, "value").collect()))
    for got in (star.new_facts(incoming, stored),
                star.new_facts(incoming, days=star.fact_days(stored).unionByName(star.fact_days(stored.limit(3))))):
        assert sorted(map(key, got.select(*star.FACT_KEY, "value").collect())) == expected


def test_reload_does_not_shuffle_stored_facts(spark, tmp_path):
    """The plan of a reload reads days of years, never the stored facts."""
    root = str(tmp_path / "warehouse")
    load_star(days_of(spark, 2018, 60), root, AT)
    days = spark.read.parquet(f"{root}/fact_days").filter("year = 2018")
    incoming = spark.read.parquet(f"{root}/fact_observation").select(*star.FACT_KEY, "value")
    text = star.new_facts(incoming, days=days)._jdf.queryExecution().executedPlan().toString()
    assert days.count() == 7
    assert text.count("FileScan") == 2 and "SortMergeJoin" not in text


def test_stored_keys_are_marks_of_days_and_points(spark):
    """Marks hold a day and point in one row; missing, negative and large numbers keep their own."""
    shape = "date_id int, location_id int, variable_id int, source_id int, value double"
    rows = [(20200101, 1, v, 1, 1.0) for v in (1, 2, 3, 63, 64, -1, 200)]
    stored = spark.createDataFrame([*rows, (20200101, None, 1, 1, 1.0)], shape)
    assert star.fact_marks(stored).count() == 4
    more = [(20200101, 1, 0, 1, 2.0), (20200101, 1, 65, 1, 2.0), (20200102, 1, 1, 1, 2.0), (20200101, 1, 1, 2, 2.0),
            (20200101, None, 1, 1, 2.0), (20200101, 1, None, 1, 2.0)]
    got = star.new_facts(spark.createDataFrame(rows + more, shape), stored)
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, more))
