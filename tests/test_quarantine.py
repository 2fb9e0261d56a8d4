"""Row rules on literal rows, with the null behaviour of every code."""

import pytest
from pyspark.sql import functions as F

from daymark.functions.skew import mark_repeated
from daymark.operators import quality, quarantine
from daymark.schema import WIDE

GOOD = {"date": "2020-01-01", "location": "here", "latitude": "-3.5", "longitude": "36.5",
        "source": "NASA_POWER", "t2m": "20", "t2m_min": "15", "t2m_max": "25", "rh2m": "60",
        "prectotcorr": "0", "ws2m": "2", "allsky_sfc_sw_dwn": "20"}


def raw(spark, *changes):
    rows = []
    for i, change in enumerate(changes):
        row = {**GOOD, "date": f"2020-01-{i + 1:02d}", **change}
        rows.append(tuple([i + 2] + [row[c] for c in WIDE.required]))
    schema = "row_number long, " + ", ".join(f"{c} string" for c in WIDE.required)
    return spark.createDataFrame(rows, schema)


def codes_of(spark, change):
    coded = quarantine.quarantine_codes(raw(spark, change))
    return coded.first()["reason_codes"]


@pytest.mark.parametrize("change, expected", [
    ({}, ""),
    ({"prectotcorr": "1000"}, ""),
    ({"date": "not-a-date"}, "INVALID_DATE"),
    ({"date": None}, "INVALID_DATE|MISSING_REQUIRED"),
    ({"location": "  "}, "EMPTY_LOCATION"),
    ({"source": " "}, "EMPTY_SOURCE|UNSUPPORTED_SOURCE"),
    ({"source": None}, "MISSING_REQUIRED|UNSUPPORTED_SOURCE"),
    ({"source": "OTHER"}, "UNSUPPORTED_SOURCE"),
    ({"latitude": "95.5"}, "LATITUDE_RANGE"),
    ({"latitude": "x"}, "INVALID_NUMERIC_latitude|LATITUDE_RANGE"),
    ({"longitude": "-181"}, "LONGITUDE_RANGE"),
    ({"longitude": None}, "MISSING_REQUIRED|INVALID_NUMERIC_longitude|LONGITUDE_RANGE"),
    ({"rh2m": "120"}, "HUMIDITY_RANGE"),
    ({"rh2m": None}, "MISSING_REQUIRED|INVALID_NUMERIC_RH2M|HUMIDITY_RANGE"),
    ({"t2m": "broken"}, "INVALID_NUMERIC_T2M"),
    ({"t2m": None}, "MISSING_REQUIRED|INVALID_NUMERIC_T2M"),
    ({"t2m": "26"}, "TEMPERATURE_ORDER"),
    ({"t2m_min": "21"}, "TEMPERATURE_ORDER"),
    ({"t2m_max": "inf"}, "INVALID_NUMERIC_T2M_MAX"),
    ({"t2m_min": "inf"}, "INVALID_NUMERIC_T2M_MIN|TEMPERATURE_ORDER"),
    ({"prectotcorr": "-1"}, "NEGATIVE_PRECTOTCORR"),
    ({"prectotcorr": "-inf"}, "INVALID_NUMERIC_PRECTOTCORR|NEGATIVE_PRECTOTCORR"),
    ({"ws2m": "-999"}, "PROVIDER_FILL_WS2M|NEGATIVE_WS2M"),
    ({"ws2m": "-0.5"}, "NEGATIVE_WS2M"),
    ({"allsky_sfc_sw_dwn": "-1"}, "NEGATIVE_ALLSKY_SFC_SW_DWN"),
    ({"rh2m": "-999", "ws2m": "-999"},
     "PROVIDER_FILL_RH2M|PROVIDER_FILL_WS2M|HUMIDITY_RANGE|NEGATIVE_WS2M")])
def test_codes(spark, change, expected):
    assert codes_of(spark, change) == expected


def test_damaged_sample(spark):
    changes = [{} for _ in range(10)]
    changes[0] = {"prectotcorr": "1000"}
    changes[3] = {"rh2m": "120"}
    changes[4] = {"t2m": None}
    changes[5] = {"prectotcorr": "-1"}
    changes[6] = {"date": "not-a-date"}
    changes[7] = {"ws2m": "-999"}
    changes.append({"date": "2020-01-02"})
    coded = quarantine.quarantine_codes(raw(spark, *changes))
    assert quarantine.accounting(coded).first().asDict() == {
        "rows_read": 11, "rows_loaded": 4, "rows_rejected": 7}
    assert {r["code"]: r["rows"] for r in quarantine.reason_counts(coded).collect()} == {
        "DUPLICATE_KEY": 2, "HUMIDITY_RANGE": 1, "INVALID_DATE": 1, "INVALID_NUMERIC_T2M": 1,
        "MISSING_REQUIRED": 1, "NEGATIVE_PRECTOTCORR": 1, "NEGATIVE_WS2M": 1,
        "PROVIDER_FILL_WS2M": 1}
    accepted = quarantine.accepted_rows(coded)
    assert dict(accepted.dtypes)["date"] == "date"
    assert 1000.0 in [r["prectotcorr"] for r in accepted.collect()]
    rejected = {r["input_row_number"]: r for r in
                quarantine.rejected_rows(coded, "row_number").collect()}
    assert sorted(rejected) == [3, 5, 6, 7, 8, 9, 12]
    assert rejected[8]["date"] == "not-a-date"


def test_both_copies_of_a_contradiction_are_rejected(spark):
    df = raw(spark, {}, {}, {"date": "2020-01-01", "t2m": "21"})
    coded = quarantine.quarantine_codes(df)
    hits = coded.filter(F.col("reason_codes") == "DUPLICATE_KEY")
    assert [r["row_number"] for r in hits.orderBy("row_number").collect()] == [2, 4]


def test_missing_keys_are_equal_keys(spark):
    df = raw(spark, {"location": None, "date": "2020-05-05"},
             {"location": None, "date": "2020-05-05"})
    for row in quarantine.quarantine_codes(df).collect():
        assert row["reason_codes"].endswith("DUPLICATE_KEY")


def test_reason_codes_cover_all_rules():
    codes = quarantine.reason_codes()
    assert len(codes) == len(set(codes)) == 29


def test_gate_blocks_before_rules(spark):
    coded = quarantine.quarantine_codes(raw(spark, {}, {"rh2m": "120"}))
    counts = quarantine.accounting(coded)
    passing = spark.createDataFrame([("PASS",)], "overall_status string")
    assert quarantine.quality_gate(counts, passing).first()["overall_status"] == "FAIL"
    clean = quarantine.accounting(quarantine.quarantine_codes(raw(spark, {}, {})))
    assert quarantine.quality_gate(clean, passing).first()["overall_status"] == "PASS"


def test_rules_and_overall_on_clean_rows(spark):
    wide = quarantine.accepted_rows(quarantine.quarantine_codes(raw(spark, {}, {}, {})))
    summary = quality.quality_summary(wide, baseline=quality.Baseline(
        3, 1, 3, "2020-01-01", "2020-01-03"))
    rows = summary.collect()
    assert [r["rule_name"] for r in rows][:2] == ["required_columns_present",
                                                 "missing_required_values"]
    assert [r["rule_name"] for r in rows][-1] == "baseline_end_date"
    assert {r["status"] for r in rows} == {"PASS"} and len(rows) == 23
    assert quality.quality_overall(wide).first()["overall_status"] == "PASS"


def test_summary_needs_its_columns(spark):
    with pytest.raises(ValueError, match="ws2m"):
        quality.quality_summary(spark.createDataFrame([(1.0,)], "t2m double"))


def test_missing_values_hit_the_range_rules(spark):
    schema = WIDE.wide_schema()
    df = spark.createDataFrame([tuple([None] * len(schema))], schema)
    got = {r["rule_name"]: r["affected_rows"] for r in quality.quality_summary(df).collect()}
    assert got["missing_required_values"] == 12
    assert got["valid_coordinates"] == got["relative_humidity_range"] == 1
    assert got["source_consistency"] == 1
    assert got["negative_precipitation"] == got["temperature_consistency"] == 0
    assert got["daily_date_coverage"] == 0


def test_many_frequent_keys_and_identical_rows(spark):
    """5,000 keys with several rows each, one key with very many, and identical rows of it."""
    rows = spark.range(5000).select((F.col("id") % 5000).alias("k"), F.lit("a").alias("v")) \
        .unionAll(spark.range(5000).select("id", F.lit("b"))) \
        .unionAll(spark.range(20000).select(F.lit(7).cast("long"), F.lit("same"))) \
        .unionAll(spark.range(3).select(F.lit(None).cast("long"), F.lit("n"))) \
        .unionAll(spark.range(100).select(F.col("id") + 10000, F.lit("once")))
    marked = mark_repeated(rows, ["k"], "again").groupBy("again").count().collect()
    assert {r["again"]: r["count"] for r in marked} == {True: 30003, False: 100}
