"""Profiles against plain Python on small random tables with gaps, copies and nulls."""

import datetime as dt
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from daymark.operators import compare, profiling, quality, summary
from daymark.plans.pipeline import SUMMARY_REPORTS, extend_profile, profile
from daymark.schema import WIDE


def table(spark, seed, days=900, places=("A", "B"), copies=0.05, kinds=2):
    rng = random.Random(seed)
    start, rows = dt.date(2018, 11, 1), []
    for place in places:
        for i in range(days):
            if rng.random() < 0.1:
                continue
            values = [rng.choice([None] + [float(k) for k in range(kinds)] * 6) for _ in range(6)]
            values.append(5.0 if place == "A" else rng.choice([1.0, 2.0]))
            row = (start + dt.timedelta(days=i), place, 1.0, 2.0, "NASA_POWER", *values)
            rows += [row] * (rng.randint(2, 4) if rng.random() < copies else 1)
            if rng.random() < copies:
                other = tuple(float(rng.randrange(kinds)) for _ in range(6))
                rows.append(row[:5] + other + (values[-1],))
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, WIDE.wide_schema())


def ordered(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    for rs in groups.values():
        rs.sort(key=lambda r: (r[0], [(v is not None, v or 0.0) for v in r[5:]]))
    return groups


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_longest_equal_run(spark, seed):
    rows, df = table(spark, seed)
    want = {}
    for place, rs in ordered(rows).items():
        for i, m in enumerate(WIDE.measures):
            best = run = 0
            previous = None
            for r in rs:
                v = r[5 + i]
                run = run + 1 if v is not None and v == previous else 1
                best, previous = max(best, run), v
            want[place, m.upper()] = best
    got = {(r["location"], r["variable_code"]): r["longest_identical_run_days"]
           for r in profiling.profile_longest_equal_run(df).collect()}
    assert got == want
    # A constant series runs through all years.
    assert want["A", "ALLSKY_SFC_SW_DWN"] > 500


@pytest.mark.parametrize("quantile", [0.9, 0.0])
def test_jumps_with_copies(spark, quantile):
    rows, df = table(spark, 5, days=500, kinds=4)
    groups = defaultdict(list)
    for r in rows:
        groups[r[1]].append(r)
    changes = []
    for place, rs in groups.items():
        rs.sort(key=lambda r: (r[0], r[5] is not None, r[5] or 0.0))
        for a, b in zip(rs, rs[1:]):
            if a[5] is not None and b[5] is not None:
                changes.append((b[0], place, b[5], b[5] - a[5]))
    limit = np.quantile([abs(c[3]) for c in changes], quantile)
    want = sorted(c for c in changes if abs(c[3]) >= limit)
    got = sorted((r["date"], r["location"], r["t2m"], r["daily_change"])
                 for r in profiling.profile_jumps(df, "t2m", quantile).collect())
    assert got == want


def test_cross_location_uniform_counts_missing_as_a_value(spark):
    day = [dt.date(2020, 1, d) for d in (1, 2, 3, 4)]
    t2m = {0: (1.0, 1.0), 1: (None, None), 2: (1.0, None), 3: (1.0, 2.0)}
    rows = [(day[i], p, 1.0, 2.0, "s", t2m[i][j], *[0.0] * 6)
            for i in t2m for j, p in enumerate("AB")]
    df = spark.createDataFrame(rows, WIDE.wide_schema())
    got = {r["variable_code"]: r["days_identical_across_all_locations"]
           for r in profiling.profile_cross_location_uniform(df).collect()}
    assert got["T2M"] == 2 and got["RH2M"] == 4


def test_histogram_of_one_value(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    rows = {r["bin"]: r["rows"] for r in profiling.profile_histogram(df, "v", 4).collect()}
    assert rows == {0: 0, 1: 0, 2: 2, 3: 0}


def test_correlation_of_a_constant_is_missing(spark):
    _, df = table(spark, 9, days=60, places=("A",), copies=0)
    got = {(r["variable_a"], r["variable_b"]): r["correlation"]
           for r in profiling.profile_correlations(df).collect()}
    assert got["ALLSKY_SFC_SW_DWN", "T2M"] is None
    assert got["T2M", "T2M"] == 1.0 and got["T2M", "RH2M"] == got["RH2M", "T2M"]


def test_tables_equal_with_repeated_keys_and_noise(spark):
    a = spark.createDataFrame([("k", 1.0)] * 1000 + [("k", 2.0), ("m", None)],
                              "key string, v double")
    near = a.withColumn("v", F.col("v") + F.when(F.col("key") == "k", 1e-14).otherwise(0.0))
    assert compare.tables_equal(a, near.repartition(3), ["key"]).first()["equal"]
    fewer = spark.createDataFrame([("k", 1.0)] * 999 + [("k", 2.0), ("k", 2.0), ("m", None)],
                                  "key string, v double")
    result = compare.tables_equal(a, fewer, ["key"]).first()
    assert not result["equal"] and result["differing_rows"] > 0
    filled = a.fillna(0.0)
    assert compare.tables_equal(a, filled, ["key"]).first()["differing_rows"] == 1
    assert not compare.tables_equal(a, a.select("v", "key"), ["key"]).first()["same_columns"]


def test_compare_join_does_not_multiply_repeated_keys(spark):
    a = spark.createDataFrame([("k", 1.0)] * 2000, "key string, v double")
    got = compare.tolerant_compare_join(a, a, ["key"], "v").first()
    assert got["equal"] and got["left_keys"] == 1


def test_copies_that_moved_below_the_tolerance_are_equal(spark):
    a = spark.createDataFrame([("k", 1.0), ("k", 1.0)], "key string, v double")
    b = spark.createDataFrame([("k", 1.0 + 1e-14), ("k", 1.0 + 3e-14)], "key string, v double")
    assert compare.tables_equal(a, b, ["key"]).first()["equal"]
    shape = "key string, v double, w double"
    a = spark.createDataFrame([("k", 1.0, 5.0), ("k", 1.0 + 2e-14, 2.0)], shape)
    b = spark.createDataFrame([("k", 1.0 + 3e-14, 5.0), ("k", 1.0 + 1e-14, 2.0)], shape)
    assert compare.tables_equal(a, b, ["key"]).first()["equal"]
    c = spark.createDataFrame([("k", 1.0, 5.0), ("k", 1.0, 2.1)], shape)
    assert compare.tables_equal(a, c, ["key"]).first()["differing_rows"] == 1


def test_compare_join_sees_values_between_the_ends(spark):
    a = spark.createDataFrame([("k", 1.0), ("k", 2.0), ("k", 3.0), ("m", None)], "key string, v double")
    b = spark.createDataFrame([("k", 3.0), ("k", 2.5), ("k", 1.0), ("m", None)], "key string, v double")
    got = compare.tolerant_compare_join(a, b, ["key"], "v").first()
    assert not got["equal"] and got["value_mismatches"] == 1 and got["max_abs_difference"] == 0.5
    fewer = compare.tolerant_compare_join(a, b.filter("v > 1 OR v IS NULL"), ["key"], "v").first()
    assert not fewer["equal"] and fewer["count_mismatches"] == 1


def test_hot_copies_are_paired_as_intervals(spark):
    """One key of ten million equal copies on one side, and runs that end at different places."""
    hot = 10_000_000
    a = spark.range(hot).select(F.lit("hot").alias("key"), F.lit(1.0).alias("v")).unionByName(
        spark.createDataFrame([("few", 2.0), ("few", 5.0), ("few", None)], "key string, v double"))
    b = spark.createDataFrame([("hot", 1.0)] * 3 + [("hot", 4.0)] * 2
                              + [("few", 2.0), ("few", 2.0), ("few", 5.0)], "key string, v double")
    got = compare.tables_equal(a, b, ["key"]).first()
    # Hot places 3 and 4 hold other values, all later ones no partner; few's first is missing.
    assert got["differing_rows"] == hot - 3 + 1 and not got["equal"]
    got = compare.tolerant_compare_join(a, b, ["key"], "v").first()
    assert (got["count_mismatches"], got["value_mismatches"], got["max_abs_difference"]) == (1, 3, 3.0)


def test_pairs_equal_sorted_lists(spark):
    """Random multisets, paired place by place, against sorted Python lists."""
    rng = np.random.default_rng(8)
    rows = [[(int(k), float(v)) for k, v in zip(rng.integers(0, 6, n), rng.integers(0, 4, n))]
            for n in (200, 230)]
    a, b = (spark.createDataFrame(r, "key int, v double").repartition(3) for r in rows)
    expected, gap = 0, 0.0
    for key in range(6):
        x, y = (sorted(v for k, v in r if k == key) for r in rows)
        expected += abs(len(x) - len(y)) + sum(p != q for p, q in zip(x, y))
        if len(x) != len(y):
            gap = max([gap, *(abs(p - q) for p, q in zip(x, y))])
    old, compare.BLOCK = compare.BLOCK, 7
    try:
        got = compare.tables_equal(a, b, ["key"]).first()
        assert got["differing_rows"] == expected
        assert compare.tolerant_compare_join(a, b, ["key"], "v").first()["max_abs_difference"] >= gap
    finally:
        compare.BLOCK = old


def rows_of(df):
    def plain(v):
        return round(v, 9) if isinstance(v, float) else v
    return sorted((tuple(plain(v) for v in r) for r in df.collect()), key=str), df.columns


def test_reports_of_merged_summaries_equal_those_of_the_rows(spark, tmp_path):
    """A table with gaps, copies, nulls, two sources and moved points, profiled whole and load by load."""
    _, df = table(spark, 11, days=500, places=("A", "B", None), copies=0.2)
    df = df.withColumns({
        "source": F.when(F.dayofyear("date") % 5 == 0, "OTHER").otherwise(F.col("source")),
        "latitude": F.when(F.dayofyear("date") % 7 == 0, 95.0).otherwise(F.col("latitude")),
        "date": F.when(F.dayofyear("date") % 11 != 0, F.col("date")),
        "rh2m": F.when(F.dayofyear("date") % 3 == 0, F.col("rh2m") + 100).otherwise(F.col("rh2m"))}).cache()
    part = F.pmod(F.xxhash64(*df.columns, F.monotonically_increasing_id()), F.lit(2))
    loads = [df.withColumn("_p", part).filter(F.col("_p") == i).drop("_p").cache() for i in range(2)]
    assert loads[0].count() + loads[1].count() == df.count() and loads[1].count() > 0
    profile(loads[0], str(tmp_path / "first"))
    extend_profile(str(tmp_path / "first"), loads[1], str(tmp_path / "both"))
    whole = summary.summarize(df)
    direct = {"date_gaps": profiling.profile_date_gaps, "missing": profiling.profile_missing}
    for name, report in SUMMARY_REPORTS.items():
        plain = direct.get(name) or getattr(profiling, f"profile_{name}")
        expected = rows_of(plain(df))
        assert rows_of(report(whole)) == expected, name
        assert rows_of(spark.read.parquet(str(tmp_path / "both" / name))) == expected, name
    rules = {r["rule_name"]: r["affected_rows"] for r in quality.quality_summary(df).collect()}
    got = {r["rule_name"]: r["affected_rows"] for r in summary.rule_rows(whole).collect()}
    assert got == {n: rules[n] for n in got} and len(got) == 10 and rules["duplicate_location_date"] > 0


def test_summary_of_nothing(spark):
    none = summary.summarize(spark.createDataFrame([], WIDE.wide_schema()))
    assert summary.coverage(summary.merge(none, none)).first()["records"] == 0
    assert summary.date_gaps(none).count() == 0
    assert {r["affected_rows"] for r in summary.rule_rows(none).collect()} == {0}


def test_only_rows_of_buckets_that_differ_are_paired(spark):
    """Equal rows are told by sums of hashes; moved, repeated and missing ones reach the pairing."""
    a = spark.range(20_000).select(F.col("id").alias("key"), (F.col("id") % 9).cast("double").alias("v"))
    signed = compare._signed(a, a.filter("key <> 11").unionByName(a.filter("key IN (5, 6)")))
    left = compare._doubtful(signed, ["key"], compare._bucket_sums(signed, ["key"]))
    assert {5, 6, 11} <= {r["key"] for r in left.collect()} and left.count() < 100
    same = compare._signed(a, a.repartition(3))
    assert compare._doubtful(same, ["key"], compare._bucket_sums(same, ["key"])).isEmpty()
    # Two rows that swapped their numbers, and numbers of other types.
    swapped = a.withColumn("v", F.when(F.col("key") == 1, 2.0).when(F.col("key") == 2, 1.0).otherwise(F.col("v")))
    assert compare.tables_equal(a, swapped, ["key"]).first()["differing_rows"] == 2
    whole = a.withColumn("key", F.col("key").cast("int"))
    assert compare.tables_equal(a, whole, ["key"]).first()["equal"]
    # Empty tables have no bucket.
    none = compare.tables_equal(a.limit(0), a.limit(0), ["key"]).first()
    assert none["equal"] and none["left_rows"] == 0
