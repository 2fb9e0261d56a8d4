import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from daymark.functions.columns import outside, text_to_date, text_to_number
from daymark.functions.digest import fingerprint
from daymark.functions.ids import calendar_ids, range_ids
from daymark.functions.quantiles import exact_quantiles, quantiles, ranked
from daymark.functions.storage import empties_scratch, pinned
from daymark.functions.skew import mark_repeated


def test_quantiles_match_numpy_per_group(spark):
    rng = random.Random(7)
    rows = [("a", round(rng.gauss(0, 50), 2)) for _ in range(2001)]
    rows += [("b", float(rng.randint(-3, 3))) for _ in range(500)]
    rows += [("c", 1e6 + rng.random()) for _ in range(37)] + [("d", 4.25)]
    rows += [("a", None), ("b", float("nan"))]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    wanted = {"low": 0.001, "quarter": 0.25, "half": 0.5, "high": 0.999, "top": 1.0}
    for few in (False, True):
        got = {r["k"]: r for r in exact_quantiles(df, ["k"], "v", wanted,
                                                  few_groups=few).collect()}
        for key in "abcd":
            values = [v for k, v in rows if k == key and v is not None and v == v]
            for name, p in wanted.items():
                assert got[key][name] == pytest.approx(np.quantile(values, p), abs=1e-9)


def test_quantiles_with_weights_and_coarse_bins(spark):
    rows = [(float(v), n) for v, n in ((1, 3), (2, 1), (9, 5), (-4, 2), (0, 1))]
    df = spark.createDataFrame(rows, "v double, n long")
    values = [v for v, n in rows for _ in range(n)]
    for accuracy in (5, 10000):
        got = exact_quantiles(df, [], "v", {"q": 0.3, "r": 0.9}, weight=F.col("n"),
                              accuracy=accuracy).first()
        assert got["q"] == pytest.approx(np.quantile(values, 0.3))
        assert got["r"] == pytest.approx(np.quantile(values, 0.9))


def test_brackets_keep_few_values_and_find_all_ranks(spark):
    """Large groups: only values near the wanted ranks are kept, whatever their spread."""
    rng = np.random.default_rng(3)
    n = 60_000
    parts = {"wide": rng.lognormal(0, 3, n), "narrow": 1e9 + rng.random(n),
             "ties": rng.integers(0, 5, n).astype(float), "one": np.full(n, 2.5),
             "signs": np.where(rng.random(n) < 0.3, -0.0, rng.normal(size=n))}
    rows = [(k, float(v)) for k, values in parts.items() for v in values]
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    wanted = {"a": 0.0, "b": 0.001, "c": 0.25, "d": 0.5, "e": 0.999, "f": 1.0}
    found = ranked(df, ["k"], "v", list(wanted.values()), few_groups=True)
    got = {r["k"]: r for r in quantiles(found, wanted).collect()}
    for key, values in parts.items():
        for name, p in wanted.items():
            assert got[key][name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-12)
    kept = {r["k"]: r["c"] for r in found.counts.filter("_kept IS NOT NULL").groupBy("k")
            .agg(F.sum("_c").alias("c")).collect()}
    assert kept["wide"] < 0.01 * n and kept["narrow"] < 0.01 * n
    assert found.counts.count() < 0.02 * len(rows)
    assert [r["_n"] for r in found.summary.select("_n").distinct().collect()] == [n]


def test_weighted_ranks_in_large_groups(spark):
    rng = np.random.default_rng(4)
    values, weights = rng.normal(size=30_000), rng.integers(0, 4, 30_000)
    weights[:3] = 20_000
    df = spark.createDataFrame([(float(v), int(w)) for v, w in zip(values, weights)],
                               "v double, w long").repartition(5)
    every = np.repeat(values, weights)
    got = exact_quantiles(df, [], "v", {"a": 0.01, "b": 0.5, "c": 0.999}, weight=F.col("w")).first()
    for name, p in (("a", 0.01), ("b", 0.5), ("c", 0.999)):
        assert got[name] == pytest.approx(np.quantile(every, p), abs=1e-12)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert exact_quantiles(df, [], "v", {"q": 0.5}).count() == 0


def test_range_ids_are_dense_and_ordered(spark):
    names = [f"n{i:05d}" for i in range(3000)]
    random.Random(1).shuffle(names)
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(7)
    got = {r["name"]: r["id"] for r in range_ids(df, ["name"], "id", partitions=6).collect()}
    assert got == {n: i for i, n in enumerate(sorted(names), start=1)}


def test_calendar_ids_match_a_global_row_number(spark):
    df = spark.range(20000).select(
        (F.col("id") % 17).cast("int").alias("day"), (F.col("id") % 97).alias("place"),
        F.col("id").alias("extra"))
    # A third of all rows fall on one day.
    df = df.withColumn("day", F.when(F.col("extra") % 3 == 0, 5).otherwise(F.col("day")))
    got = calendar_ids(df, "day", "place", ["extra"], "n", block=10)
    plain = F.row_number().over(Window.orderBy("day", "place", "extra"))
    both = got.withColumn("m", plain)
    assert both.filter("n <> m").count() == 0 and both.count() == 20000


def test_mark_repeated_with_hot_and_null_keys(spark):
    hot = spark.range(3000).select(F.lit("hot").alias("a"), F.lit(1).alias("b"), "id")
    nulls = spark.range(2).select(F.lit(None).cast("string").alias("a"), F.lit(2).alias("b"),
                                  "id")
    single = spark.range(4000).select(F.col("id").cast("string").alias("a"), F.lit(3).alias("b"),
                                      "id")
    pairs = spark.range(3000).select((F.col("id") % 1500).cast("string").alias("a"),
                                     F.lit(4).alias("b"), "id")
    got = mark_repeated(hot.unionAll(nulls).unionAll(single).unionAll(pairs), ["a", "b"], "again")
    counts = {(r["b"], r["again"]): r["count"] for r in got.groupBy("b", "again").count()
              .collect()}
    assert counts == {(1, True): 3000, (2, True): 2, (3, False): 4000, (4, True): 3000}
    assert got.columns == ["a", "b", "id", "again"]


@pytest.mark.parametrize("text, value", [
    ("5", 5.0), (" -2.5 ", -2.5), ("1e3", 1000.0), ("5d", None), ("5f", None), ("0x1p3", None),
    ("broken", None), ("", None), (None, None), ("NaN", None), ("inf", float("inf")),
    ("-Infinity", float("-inf")), ("1e999", float("inf")), (".5", 0.5)])
def test_text_to_number(spark, text, value):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(text_to_number(F.col("t")).alias("n")).first()["n"] == value


@pytest.mark.parametrize("text, ok", [
    ("2020-01-05", True), ("2020-02-30", False), ("20200101", False), ("2020-1-5", False),
    ("2020", False), ("not-a-date", False), (None, False)])
def test_text_to_date(spark, text, ok):
    df = spark.createDataFrame([(text,)], "t string")
    assert (df.select(text_to_date(F.col("t")).alias("d")).first()["d"] is not None) is ok


def test_outside_counts_missing(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (0.0,), (100.0,), (101.0,)], "v double")
    assert [r[0] for r in df.select(outside(F.col("v"), 0, 100)).collect()] == [
        True, True, False, False, True]


def test_fingerprint_sees_content_only(spark):
    df = spark.createDataFrame([("a", 1.5), ("b", None), ("b", None)], "k string, v double")
    base = fingerprint(df).first()
    assert fingerprint(df.repartition(3).select("v", "k")).first() == base
    assert fingerprint(df.dropDuplicates()).first()["digest"] != base["digest"]
    assert fingerprint(df.fillna(0.0)).first()["digest"] != base["digest"]


@pytest.mark.parametrize("values", [
    [101325 + i * 1e-9 for i in range(4000)], [i * 1e-12 for i in range(-2000, 2000)],
    [1e300, -1e300, *[i / 1000 for i in range(4000)]], [5.0] * 3000 + [5.0 + i * 1e-13 for i in range(50)]])
def test_quantiles_in_narrow_and_wide_ranges(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    wanted = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.999, "e": 1.0}
    got = exact_quantiles(df, [], "v", wanted).first()
    for name, p in wanted.items():
        assert got[name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-15)


def test_stage_empties_its_scratch_tables(spark):
    paths = []

    @empties_scratch
    def stage():
        df = pinned(spark.range(1000), "stage")
        paths.extend(df.inputFiles())
        return df.count()

    assert stage() == 1000 and paths
    folder = paths[0].rsplit("/", 1)[0]
    assert spark.read.parquet(folder).count() == 0
    assert not set(paths) & set(spark.read.parquet(folder).inputFiles())
