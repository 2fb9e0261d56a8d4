import datetime as dt
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from daymark.plans import ingest_payloads, prepare_features, profile, validate
from daymark.operators.serving import mart_from_wide
from daymark.schema import MANIFEST_SCHEMA, WIDE, code_of
from daymark.operators.checks import check_rows
from daymark.sources import manifest, payloads, publish, tables

CODES = [code_of(m) for m in WIDE.measures]


@pytest.mark.parametrize("place, lat, lon, wanted", [
    ("Arusha", -3.3869, 36.6830, "119dcc628fbe824b"),
    ("Dar_es_Salaam", -6.7924, 39.2083, "34fea2903da3ff48")])
def test_known_request_ids(spark, place, lat, lon, wanted):
    df = spark.createDataFrame([(place, lat, lon, "20010101", "20251231", CODES)],
                               "location string, latitude double, longitude double, "
                               "start_date string, end_date string, parameters array<string>")
    assert manifest.request_id(df).first()["request_id"] == wanted


@pytest.mark.parametrize("place, lat, lon", [
    ("Zoë 'x' \"q\" \\ 東京 😀", 0.000123, -0.00001234), ("plain", 0.0, -36.0),
    ("edge", 1e-5, 179.999999)])
def test_request_ids_of_odd_text_and_numbers(spark, place, lat, lon):
    text = json.dumps({"source": "S", "location": place, "latitude": lat, "longitude": lon,
                       "start": "1", "end": "2", "parameters": ["A", "B"]}, sort_keys=True)
    df = spark.createDataFrame([(place, lat, lon, "1", "2", ["B", "A"])],
                               "location string, latitude double, longitude double, "
                               "start_date string, end_date string, parameters array<string>")
    got = manifest.request_id(df, "S").first()["request_id"]
    assert got == hashlib.sha256(text.encode()).hexdigest()[:16]


def write_payload(path, place, values):
    folder = path / f"location={place}"
    folder.mkdir(parents=True)
    body = {"properties": {"parameter": values}, "header": {"ignored": True}}
    (folder / "payload.json").write_text(json.dumps(body))


def points(spark, *places):
    return spark.createDataFrame([(p, -3.0, 36.0) for p in places],
                                 "location string, latitude double, longitude double")


def full(days, **changes):
    base = {"T2M": 20.0, "T2M_MIN": 15.0, "T2M_MAX": 25.0, "RH2M": 60.0, "PRECTOTCORR": 1.0,
            "WS2M": 2.0, "ALLSKY_SFC_SW_DWN": 20.0}
    made = {c: {d: v for d in days} for c, v in base.items()}
    made.update(changes)
    return made


def test_payloads_to_rows(spark, tmp_path):
    raw = tmp_path / "raw"
    values = full(["20200101", "20200102"])
    values["T2M"] = {"20200101": 20.0}
    values["RH2M"] = {"20200102": 61.0, "junk": 1.0}
    values["EXTRA"] = {"20200101": 7.0}
    write_payload(raw, "A", values)
    write_payload(raw, "B", {k: v for k, v in full(["20200101"]).items() if k != "WS2M"})
    read = payloads.read_payloads(spark, str(raw))
    inner = payloads.payload_to_wide(read, points(spark, "A", "B"))
    rows = {(r["location"], r["date"]): r for r in inner.collect()}
    assert set(rows) == {("A", dt.date(2020, 1, 1)), ("B", dt.date(2020, 1, 1))}
    assert rows["A", dt.date(2020, 1, 1)]["rh2m"] is None
    assert inner.columns == list(WIDE.required)
    outer = payloads.payload_to_wide_outer(read, points(spark, "A"), extra_codes=["EXTRA"])
    days = {r["date"]: r for r in outer.collect()}
    assert set(days) == {dt.date(2020, 1, 1), dt.date(2020, 1, 2), None}
    assert days[dt.date(2020, 1, 1)]["extra"] == 7.0
    checks = {r["location"]: (r["ok"], r["missing_parameters"])
              for r in payloads.payload_validate(read, ["location"]).collect()}
    assert checks == {"A": (True, ""), "B": (False, "WS2M")}


def test_payload_without_properties(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"message": "no data"}')
    got = payloads.payload_validate(payloads.read_payloads(spark, str(tmp_path)), ["file"]).first()
    assert (got["has_properties"], got["ok"]) == (False, False)


def test_csv_readers(spark, tmp_path):
    header = ",".join(WIDE.required)
    good = "2020-01-01,A,-3.0,36.0,NASA_POWER,20,15,25,60,0,2,20"
    (tmp_path / "good.csv").write_text(f"{header}\n{good}\n")
    assert tables.read_wide_csv(spark, str(tmp_path / "good.csv")).first()["date"] == \
        dt.date(2020, 1, 1)
    (tmp_path / "bad.csv").write_text(f"{header}\n{good.replace('2020-01-01', 'not-a-date')}\n")
    with pytest.raises(Exception):
        tables.read_wide_csv(spark, str(tmp_path / "bad.csv")).collect()
    (tmp_path / "raw.csv").write_text(f"{header}\n,  ,-3.0,NaN,NASA_POWER,NA,15,25,60,0,2,20\n")
    row = tables.read_raw_csv(spark, str(tmp_path / "raw.csv")).first()
    assert (row["date"], row["longitude"], row["t2m"]) == (None, None, None)
    assert row["latitude"] == "-3.0"


def test_nan_becomes_missing(spark, tmp_path):
    df = spark.createDataFrame([(dt.date(2020, 1, 1), "A", 1.0, 2.0, "s",
                                 *[float("nan")] * 7)], WIDE.wide_schema())
    tables.write_wide_parquet(df, str(tmp_path / "p"))
    assert tables.read_wide_parquet(spark, str(tmp_path / "p")).first()["t2m"] is None


def test_plan_offline_and_upsert_ties(spark):
    requests = spark.createDataFrame([("r1",), ("r2",), ("r3",)], "request_id string")
    row = lambda rid, file, sha, at, status="success": (
        rid, "A", 1.0, 2.0, "1", "2", ["T2M"], file, sha, status, at)
    at = dt.datetime(2024, 1, 1)
    entries = spark.createDataFrame([row("r1", "f1", "h1", at), row("r2", "f2", "h2", at)],
                                    MANIFEST_SCHEMA)
    files = spark.createDataFrame([("f1", "h1")], "raw_file string, actual_sha256 string")
    got = {r["request_id"]: r["action"]
           for r in manifest.ingest_plan(requests, entries, files).collect()}
    assert got == {"r1": "cached", "r2": "refetch", "r3": "new"}
    got = {r["request_id"]: r["action"]
           for r in manifest.ingest_plan(requests, entries, files, offline=True).collect()}
    assert got == {"r1": "cached", "r2": "offline_missing", "r3": "offline_missing"}
    newer = spark.createDataFrame([row("r1", "f1b", "h1b", at)], MANIFEST_SCHEMA)
    merged = {r["request_id"]: r["raw_file"]
              for r in manifest.manifest_upsert(entries, newer).collect()}
    assert merged == {"r1": "f1b", "r2": "f2"}


def test_gate_reports_missing_columns(spark):
    got = {r["check"]: r["violations"] for r in manifest.interim_gate(
        spark.createDataFrame([("A",)], "location string").filter("1 = 0")).collect()}
    assert got == {"missing_required_columns": 11, "empty_table": 1,
                   "repeated_location_date": None}


def test_stages_end_to_end(spark, tmp_path):
    days = [(dt.date(2018, 10, 1) + dt.timedelta(days=i)).strftime("%Y%m%d") for i in range(1300)]
    rain = {d: float(i % 7) for i, d in enumerate(days)}
    write_payload(tmp_path / "raw", "A", full(days, PRECTOTCORR=rain))
    wide = ingest_payloads(spark, str(tmp_path / "raw"), points(spark, "A"), str(tmp_path / "out"))
    assert wide.count() == 1300
    verdict = validate(wide, str(tmp_path / "quality")).first()
    assert verdict["overall_status"] == "PASS" and verdict["rows"] == 1300
    checks = prepare_features(mart_from_wide(wide), str(tmp_path / "ml")).collect()
    assert all(r["ok"] for r in checks)
    profile(wide, str(tmp_path / "profile"))
    stale = spark.read.parquet(str(tmp_path / "profile" / "stale_runs"))
    assert stale.agg(F.max("longest_identical_run_days")).first()[0] == 1300


def test_rejected_payload_rows_stop_the_run(spark, tmp_path):
    values = full(["20200101", "20200102"])
    values["RH2M"]["20200102"] = 120.0
    write_payload(tmp_path / "raw", "A", values)
    with pytest.raises(ValueError, match="1 rows were rejected"):
        ingest_payloads(spark, str(tmp_path / "raw"), points(spark, "A"), str(tmp_path / "out"))
    kept = spark.read.option("header", True).csv(str(tmp_path / "out/quarantine/rejected_rows"))
    assert [r["reason_codes"] for r in kept.collect()] == ["HUMIDITY_RANGE"]
    assert not (tmp_path / "out" / "wide").exists()


def test_ingest_refuses_what_it_would_lose(spark, tmp_path):
    """Broken and pretty-printed text, a payload without properties, unknown keys and empty files."""
    import json

    def write(name, text):
        folder = tmp_path / name / "location=A"
        folder.mkdir(parents=True)
        (folder / "a.json").write_text(text)
        return str(tmp_path / name)

    body = {"properties": {"parameter": full(["20200101", "20200102"])}}
    good, pretty = json.dumps(body), write("pretty", json.dumps(body, indent=1))
    with pytest.raises(ValueError, match="without properties"):
        ingest_payloads(spark, pretty, points(spark, "A"), str(tmp_path / "o1"))
    read = ingest_payloads(spark, pretty, points(spark, "A"), str(tmp_path / "o2"), multi_line=True)
    assert read.count() > 0
    for i, (text, known, what) in enumerate((
            ("{}", "A", "without properties"), ("not json", "A", "without properties"),
            (good, "B", "keys without a point"), ("", "A", "has payloads"))):
        with pytest.raises(ValueError, match=what):
            ingest_payloads(spark, write(f"bad{i}", text), points(spark, known), str(tmp_path / f"p{i}"))


def rows_read(df):
    """Rows that the scan handed on, after whole folders, files, row groups and pages were skipped."""
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan()
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    found = []
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.nodeName().startswith("Scan parquet"):
            found.append(leaf.metrics().apply("numOutputRows").value())
    assert found, plan.toString()
    return sum(found)


def test_published_layout_skips_other_locations_and_years(spark, tmp_path):
    days, places = 730, 40
    day = F.date_add(F.lit("2019-01-01").cast("date"), (F.col("id") % days).cast("int"))
    df = spark.range(days * places).select(
        day.alias("date"), F.format_string("P%02d", (F.col("id") / days).cast("int")).alias("location"),
        F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"), F.lit("NASA_POWER").alias("source"),
        *[F.rand(i).alias(m) for i, m in enumerate(WIDE.measures)]).repartition(6)
    path = str(tmp_path / "wide")
    stored = tables.publish_sorted_wide(df, path, ranges=16)
    assert stored.columns == list(WIDE.required) and stored.count() == days * places
    one = stored.filter("location = 'P17'")
    assert one.count() == days and rows_read(one) < days * places / 3
    year = tables.read_published_wide(spark, path, days=("2020-03-01", "2020-12-31"))
    assert year.count() == 305 * places and rows_read(year) <= 365 * places + places
    both = year.filter("location = 'P03'")
    assert both.count() == 305 and rows_read(both) < 366 * places / 3
    tables.publish_sorted_wide(df, str(tmp_path / "csv"), file_format="csv")
    assert tables.read_wide_csv(spark, str(tmp_path / "csv")).count() == days * places


def test_large_files_are_digested_in_chunks(spark, tmp_path):
    """A file beyond what Spark holds in one row, and small ones beside it."""
    import hashlib

    size = 2_300_000_000
    with open(tmp_path / "large.bin", "wb") as f:
        f.truncate(size)
        f.write(b"head")
    (tmp_path / "small.txt").write_bytes(b"small")
    expected, block = hashlib.sha256(b"head"), bytes(1 << 20)
    left = size - 4
    while left:
        expected.update(block[:left])
        left -= len(block[:left])
    got = {r["raw_file"].rsplit("/", 1)[1]: (r["actual_sha256"], r["bytes"])
           for r in manifest.file_digests(spark, str(tmp_path)).collect()}
    assert got == {"large.bin": (expected.hexdigest(), size),
                   "small.txt": (hashlib.sha256(b"small").hexdigest(), 5)}


def test_two_writers_do_not_spoil_each_other(spark, tmp_path):
    """A second attempt starts and ends while the first one is being checked."""
    root, at = str(tmp_path / "root"), dt.datetime(2024, 1, 1)
    good = lambda df: check_rows(df.agg(F.count("*").alias("n")), [("rows", "1", "least(n, 1)")])
    bad = lambda df: check_rows(df.agg(F.count("*").alias("n")), [("rows", "-1", "n")])

    def meanwhile(other):
        def checks(df):
            publish.publish_validated(spark.range(20, 25), root, "t", other, at)
            return good(df)
        return checks

    for other, rows in ((bad, 10), (good, 5)):
        publish.publish_validated(spark.range(10), root, "t", meanwhile(other), at)
        assert publish.current_version(spark, root, "t").count() == rows
    log = publish._attempts(spark, root).orderBy("attempt").collect()
    assert [(r["attempt"], r["status"]) for r in log] == [
        (1, "SUCCESS"), (2, "FAILED"), (3, "SUCCESS"), (4, "SUCCESS")]
    # Two attempts that saw the same state have one number and still two records.
    publish._record(spark, root, "t", 9, "a", "STARTED", at)
    for token in ("a", "b"):
        spark.range(3 if token == "a" else 4).write.parquet(publish._folder(root, "t", 9, token))
        publish._record(spark, root, "t", 9, token, "SUCCESS", at)
    assert publish.current_version(spark, root, "t").count() == 4
