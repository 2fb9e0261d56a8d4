"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  folder of the given Parquet files (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)

Queries named stored_* run on tables that were written before the clock starts,
as the published timings of the same query shapes did.  The others start from the
given tables.  Every query runs once to warm up; the shown time is the median of
three further runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from daymark.catalog.base import LAYOUT, SOURCES, SPLITS, Tables, literal_time  # noqa: E402
from daymark.operators import (features, profiling, quality, quarantine, queries,  # noqa: E402
                               serving, star)
from daymark.session import build_session  # noqa: E402
from daymark.sources import tables as files  # noqa: E402

RUNS = 3


def drain(df) -> None:
    """Compute every row and column without keeping any."""
    df.write.format("noop").mode("overwrite").save()


def timed(make) -> float:
    drain(make())
    seconds = []
    for _ in range(RUNS):
        start = time.perf_counter()
        drain(make())
        seconds.append(time.perf_counter() - start)
    return statistics.median(seconds)


def main() -> None:
    scratch = tempfile.TemporaryDirectory(prefix="bench-scratch-")
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session("bench", f"local[{cpus}]", cpus, **{
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        "spark.ui.enabled": "false", "spark.checkpoint.dir": scratch.name,
        "spark.sql.files.openCostInBytes": "1048576"})
    spark.sparkContext.setLogLevel("ERROR")
    t = Tables(spark, folder)
    holder = tempfile.TemporaryDirectory(prefix="bench-")
    root = holder.name

    files.write_wide_parquet(t.w2, f"{root}/wide")
    files.write_wide_csv(t.w2, f"{root}/csv")
    wide = files.read_wide_parquet(spark, f"{root}/wide", layout=LAYOUT)
    at = literal_time("2024-01-31 00:00:00")
    built = star.build_star(wide, LAYOUT, source_catalog=SOURCES, ingested_at=at)
    for name, df in built.items():
        df.write.parquet(f"{root}/{name}")
    s = {name: spark.read.parquet(f"{root}/{name}") for name in built}
    view = star.observation_view(s["fact_observation"], s["dim_date"], s["dim_location"],
                                 s["dim_variable"], s["dim_source"])
    serving.daily_mart(view).write.parquet(f"{root}/mart")
    mart = spark.read.parquet(f"{root}/mart")
    # The dense table, and a tenth of its points: the slope between the two is Spark's cost per row.
    serving.mart_from_wide(t.w3).write.parquet(f"{root}/series")
    series = spark.read.parquet(f"{root}/series")
    series.where(F.pmod(F.crc32("location_name"), F.lit(10)) == 0).write.parquet(f"{root}/tenth")
    tenth = spark.read.parquet(f"{root}/tenth")
    incoming = star.fact_dim_lookup(star.wide_to_long(wide, LAYOUT), s["dim_date"],
                                    s["dim_location"], s["dim_variable"], s["dim_source"],
                                    LAYOUT)
    t.r1.repartition(cpus).write.parquet(f"{root}/raw")
    raw = spark.read.parquet(f"{root}/raw")
    span = ("S7", "1997-01-01", "1999-12-31")
    work = {
        "stored_load_csv": lambda: files.read_wide_csv(spark, f"{root}/csv", LAYOUT),
        "stored_load_parquet": lambda: queries.full_scan(wide),
        "stored_filter_csv": lambda: queries.filter_location_range(
            files.read_wide_csv(spark, f"{root}/csv", LAYOUT), *span),
        "stored_filter_parquet": lambda: queries.filter_location_range(wide, *span),
        "stored_monthly_mean_csv": lambda: queries.monthly_mean_by_location(
            files.read_wide_csv(spark, f"{root}/csv", LAYOUT)),
        "stored_monthly_mean_parquet": lambda: queries.monthly_mean_by_location(wide),
        "stored_star_filter": lambda: queries.star_filter(view, *span),
        "stored_star_monthly_mean": lambda: queries.star_monthly_mean(view),
        "stored_mart_ordered": lambda: queries.mart_ordered(mart),
        "stored_monthly_total": lambda: queries.monthly_total_by_location(mart),
        "stored_features": lambda: features.create_features(series),
        "stored_features_tenth": lambda: features.create_features(tenth),
        "stored_ml_split": lambda: features.temporal_split(
            features.ml_ready(series, splits=SPLITS), SPLITS),
        "stored_serving_mart": lambda: serving.mart_from_facts(
            s["fact_observation"], s["dim_date"], s["dim_location"], s["dim_variable"],
            s["dim_source"]),
        "stored_monthly_climate": lambda: serving.monthly_climate(mart),
        "stored_fact_first_load": lambda: star.facts_from_wide(wide, s, LAYOUT, at),
        "stored_fact_reload": lambda: star.fact_load(incoming, s["fact_observation"], at),
        "stored_quality_summary": lambda: quality.quality_summary(wide, LAYOUT),
        "stored_quarantine": lambda: quarantine.quarantine_codes(raw, LAYOUT),
        "monthly_mean_by_location": lambda: queries.monthly_mean_by_location(t.w2),
        "stored_iqr_flags": lambda: quality.iqr_flags(wide, LAYOUT),
        "stored_percentiles": lambda: profiling.profile_percentiles(wide, LAYOUT),
        "stored_temperature_jumps": lambda: profiling.profile_jumps(wide, "t2m"),
        "stored_longest_equal_run": lambda: profiling.profile_longest_equal_run(wide, LAYOUT),
        "stored_date_gaps": lambda: profiling.profile_date_gaps(wide),
        "stored_correlations": lambda: profiling.profile_correlations(wide, LAYOUT)}
    seconds = {}
    for name, make in work.items():
        seconds[name] = round(timed(make), 4)
        print(f"{name:32s} {seconds[name]:.3f}", file=sys.stderr, flush=True)
    size, dense = (df.agg(F.count("*")).first()[0] for df in (wide, series))
    print(json.dumps({"metric": "total_seconds", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": os.path.basename(
                          folder.rstrip("/")).removeprefix("sf"), "wide_rows": size,
                      "dense_rows": dense,
                      "cpus": cpus}), flush=True)
    spark.stop()
    for folder_ in (holder, scratch):
        folder_.cleanup()


if __name__ == "__main__":
    main()
