"""One small table of totals that reports and rules read instead of the rows.

`stats` has a row per point, source and year: counts, means, squared deviations,
extremes, missing cells and violations.  `days` has a row per location and year:
which days have a reading, and which have several, as bits.  Both are made with
map-side combining, the first from all columns, the second from the two of the
key.  The summaries of two sets of rows give that of both, exactly but for the
last digits of means, so a load adds its own and no report reads the stored rows
again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymark.functions import days as day_bits
from daymark.functions.columns import nan_to_null
from daymark.operators import profiling, quality
from daymark.operators.checks import one_row_table
from daymark.schema import WIDE, Layout, code_of

YEAR = "year"


@dataclass(frozen=True)
class Summary:
    stats: DataFrame
    days: DataFrame
    layout: Layout = WIDE


def _grain(layout: Layout) -> list[str]:
    return [layout.location, layout.latitude, layout.longitude, layout.source, YEAR]


def _counted(layout: Layout) -> dict[str, Column]:
    """Row counts that add up over any rows."""
    counts = {f"broken_{n}": c for n, c in profiling._violations(layout).items()}
    failed = {f"failed_{n}": c for n, c in quality._violations(layout).items()}
    return {n: F.sum(c.cast("long")) for n, c in {**counts, **failed}.items()}


def summarize(wide: DataFrame, layout: Layout = WIDE) -> Summary:
    """The summary of a wide table."""
    rows = nan_to_null(wide.select(*layout.required), layout.numeric)
    year = F.year(layout.date).alias(YEAR)
    pieces = [F.count("*").alias("rows"), F.count(layout.date).alias("dated"),
              F.min(layout.date).alias("first_day"), F.max(layout.date).alias("last_day"),
              *[c.alias(n) for n, c in _counted(layout).items()]]
    for m in layout.measures:
        pieces += [F.count(m).alias(f"{m}__n"), F.avg(m).alias(f"{m}__mean"),
                   (F.var_pop(m) * F.count(m)).alias(f"{m}__m2"),
                   F.min(m).alias(f"{m}__min"), F.max(m).alias(f"{m}__max")]
    stats = rows.groupBy(*_grain(layout)[:-1], year).agg(*pieces)
    at = day_bits.place(f"month(`{layout.date}`)", f"day(`{layout.date}`)")
    per_day = rows.groupBy(layout.location, layout.date).agg(F.count("*").alias("_n"))
    days = per_day.groupBy(layout.location, year).agg(
        F.sum("_n").alias("rows"),
        F.sum(F.when(F.col(layout.date).isNull(), F.col("_n")).otherwise(0)).alias("undated"),
        *day_bits.bits(at, "any"), *day_bits.bits(at, "many", "_n > 1"))
    return Summary(stats, days, layout)


def _both(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of both sides side by side as `a` and `b`, with the keys; missing keys are equal."""
    same = reduce(lambda x, y: x & y, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys])
    left, right = (df.select(*keys, F.struct(*df.columns).alias(f"_{s}")).alias(s)
                   for df, s in ((a, "a"), (b, "b")))
    return left.join(right, same, "full_outer").select(
        *[F.coalesce(f"_a.{k}", f"_b.{k}").alias(k) for k in keys], "_a", "_b")


def merge(one: Summary, other: Summary) -> Summary:
    """The summary of the rows of both."""
    layout = one.layout

    def side(s: str, name: str) -> Column:
        return F.coalesce(f"_{s}.{name}", F.lit(0))

    def added(name: str) -> Column:
        return (side("a", name) + side("b", name)).alias(name)

    pieces = [added(n) for n in ("rows", "dated", *_counted(layout))]
    pieces += [F.least("_a.first_day", "_b.first_day").alias("first_day"),
               F.greatest("_a.last_day", "_b.last_day").alias("last_day")]
    for m in layout.measures:
        na, nb = side("a", f"{m}__n"), side("b", f"{m}__n")
        ma, mb = F.col(f"_a.{m}__mean"), F.col(f"_b.{m}__mean")
        apart = mb - ma
        pieces += [
            (na + nb).alias(f"{m}__n"),
            F.when(na == 0, mb).when(nb == 0, ma).otherwise(ma + apart * nb / (na + nb))
            .alias(f"{m}__mean"),
            F.when(na + nb > 0, side("a", f"{m}__m2") + side("b", f"{m}__m2") + F.coalesce(
                apart * apart * na * nb / (na + nb), F.lit(0.0))).alias(f"{m}__m2"),
            F.least(f"_a.{m}__min", f"_b.{m}__min").alias(f"{m}__min"),
            F.greatest(f"_a.{m}__max", f"_b.{m}__max").alias(f"{m}__max")]
    stats = _both(one.stats, other.stats, _grain(layout)).select(*_grain(layout), *pieces)
    key = [layout.location, YEAR]
    words = [side("a", f"any{i}").bitwiseOR(side("b", f"any{i}")).alias(f"any{i}")
             for i in range(day_bits.WORDS)]
    words += [side("a", f"many{i}").bitwiseOR(side("b", f"many{i}")).bitwiseOR(
        side("a", f"any{i}").bitwiseAND(side("b", f"any{i}"))).alias(f"many{i}")
        for i in range(day_bits.WORDS)]
    days = _both(one.days, other.days, key).select(*key, added("rows"), added("undated"), *words)
    return Summary(stats.select(*one.stats.columns), days.select(*one.days.columns), layout)


def write_summary(summary: Summary, path: str) -> None:
    summary.stats.write.mode("errorifexists").parquet(f"{path}/stats")
    summary.days.write.mode("errorifexists").parquet(f"{path}/days")


def read_summary(spark, path: str, layout: Layout = WIDE) -> Summary:
    return Summary(spark.read.parquet(f"{path}/stats"), spark.read.parquet(f"{path}/days"), layout)


# ---------------------------------------------------------------- reports

def _located(df: DataFrame, layout: Layout) -> DataFrame:
    return df.filter(F.col(layout.location).isNotNull())


def temporal_coverage(s: Summary) -> DataFrame:
    return s.stats.groupBy(s.layout.location).agg(
        F.min("first_day").alias("min_date"), F.max("last_day").alias("max_date"),
        F.sum("dated").alias("observations"))


def points(s: Summary) -> DataFrame:
    return profiling.profile_points(s.stats, s.layout)


def coordinate_variants(s: Summary) -> DataFrame:
    return profiling.profile_coordinate_variants(s.stats, s.layout)


def bounding_box(s: Summary) -> DataFrame:
    return profiling.profile_bounding_box(s.stats, s.layout)


def missing(s: Summary) -> DataFrame:
    layout = s.layout
    cells = {c: F.sum("rows") - F.sum(f"{c}__n") for c in layout.measures}
    cells |= {c: F.sum(F.when(F.col(c).isNull(), F.col("rows")).otherwise(0))
              for c in _grain(layout)[:-1]}
    cells[layout.date] = F.sum("rows") - F.sum("dated")
    one = s.stats.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("_rows"),
                      *[F.coalesce(v, F.lit(0)).alias(c) for c, v in cells.items()])
    entries = F.array(*[F.struct(
        F.lit(c).alias("column"), F.col(c).alias("missing_count"),
        F.when(F.col("_rows") > 0, F.col(c) * 100.0 / F.col("_rows")).alias("missing_percent"))
        for c in layout.required])
    return one.select(F.inline(entries)).orderBy(F.desc("missing_percent"), "column")


def missing_measures(s: Summary) -> DataFrame:
    per_row = reduce(lambda a, b: a + b, [F.col("rows") - F.col(f"{m}__n")
                                          for m in s.layout.measures])
    return s.stats.agg(F.coalesce(F.sum(per_row), F.lit(0)).alias("missing_measure_cells"))


def location_counts(s: Summary) -> DataFrame:
    return (_located(s.stats, s.layout).groupBy(s.layout.location)
            .agg(F.sum("rows").alias("rows")).orderBy(F.desc("rows"), s.layout.location))


def annual_counts(s: Summary) -> DataFrame:
    return _located(s.stats, s.layout).groupBy(YEAR, s.layout.location) \
        .agg(F.sum("rows").alias("rows"))


def sources(s: Summary) -> DataFrame:
    counts = s.stats.groupBy(s.layout.source).agg(F.sum("rows").alias("records"))
    labels = counts.agg(F.count("*").alias("_labels"))
    return counts.crossJoin(F.broadcast(labels)).select(
        s.layout.source, "records", F.col("_labels").alias("number_of_source_labels"),
        (F.col("_labels") == 1).alias("single_source_dependency"))


def coverage(s: Summary) -> DataFrame:
    return s.stats.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("records"),
                       F.count_distinct(YEAR).alias("years_covered"),
                       F.count_distinct(s.layout.location).alias("locations")).select(
        "*", F.lit(True).alias("daily_temporal_resolution"),
        F.lit(False).alias("nationally_exhaustive_spatial_coverage"))


def location_stats(s: Summary) -> DataFrame:
    """Means and deviations of a location from those of its points, sources and years."""
    layout = s.layout
    whole = Window.partitionBy(layout.location)
    rows = _located(s.stats, layout)
    means = {m: F.sum(F.col(f"{m}__n") * F.col(f"{m}__mean")).over(whole)
             / F.nullif(F.sum(f"{m}__n").over(whole), F.lit(0)) for m in layout.measures}
    rows = rows.withColumns({f"{m}__all": c for m, c in means.items()})
    entries = []
    for m in layout.measures:
        n, apart = F.sum(f"{m}__n"), F.col(f"{m}__mean") - F.col(f"{m}__all")
        squares = F.sum(F.col(f"{m}__m2") + F.col(f"{m}__n") * apart * apart)
        entries.append(F.struct(
            F.lit(code_of(m)).alias("variable_code"), F.first(f"{m}__all").alias("mean"),
            F.when(n > 1, F.sqrt(squares / (n - 1))).alias("std"),
            F.min(f"{m}__min").alias("min"), F.max(f"{m}__max").alias("max")))
    return rows.groupBy(layout.location).agg(F.array(*entries).alias("_e")) \
        .select(layout.location, F.inline("_e"))


def date_gaps(s: Summary) -> DataFrame:
    """Per location: first and last day, expected, observed and missing days."""
    layout = s.layout
    ends = _located(s.stats, layout).groupBy(layout.location).agg(
        F.min("first_day").alias("start_date"), F.max("last_day").alias("end_date"))
    seen = _located(s.days, layout).groupBy(layout.location).agg(
        F.sum(F.expr(day_bits.count("any{i}"))).alias("observed_unique_days"))
    span = F.coalesce(F.date_diff("end_date", "start_date") + 1, F.lit(0)).cast("long")
    return ends.join(seen, layout.location).select(
        layout.location, "start_date", "end_date", span.alias("expected_days"),
        "observed_unique_days", (span - F.col("observed_unique_days")).alias("missing_days"))


def _totals(s: Summary) -> DataFrame:
    """One row: rows in repeated (location, date), missing days, and all violations."""
    alone = F.expr(day_bits.count("(any{i} & ~many{i})"))
    dated = F.col("rows") - F.col("undated")
    lost = F.when(F.col("undated") > 1, F.col("undated")).otherwise(0)
    repeated = s.days.agg(F.coalesce(F.sum(dated - alone + lost), F.lit(0)).alias("repeated"))
    gap = date_gaps(s).agg(F.coalesce(F.sum("missing_days"), F.lit(0)).alias("gap"))
    sums = s.stats.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _counted(s.layout)])
    return sums.crossJoin(repeated).crossJoin(gap)


def rule_violations(s: Summary) -> DataFrame:
    rules = list(profiling._violations(s.layout))
    one = s.stats.agg(*[F.coalesce(F.sum(f"broken_{r}"), F.lit(0)).alias(r) for r in rules])
    return one_row_table(one, "rule", "violations", rules)


def candidate_problems(s: Summary) -> DataFrame:
    one = _totals(s).withColumnsRenamed(
        {"gap": "missing_days", "repeated": "duplicate_location_date_rows",
         **{f"broken_{r}": r for r in profiling._violations(s.layout)}})
    return profiling.problem_rows(one)


def rule_rows(s: Summary) -> DataFrame:
    """The results of all row, key and coverage rules."""
    one = _totals(s).withColumnsRenamed(
        {"gap": quality.COVERAGE.name, "repeated": quality.DUPLICATES.name,
         **{f"failed_{r}": r for r in quality._violations(s.layout)}})
    return quality._result(one, quality.ROW_RULES)
