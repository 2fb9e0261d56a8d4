"""Table rules with a severity, and the statistical range diagnostics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.functions.columns import holds, outside
from daymark.functions.quantiles import Ends, Ranked, quantiles, ranked
from daymark.schema import WIDE, Layout, code_of

ERROR, WARNING = "ERROR", "WARNING"
IQR_FACTOR = 1.5


@dataclass(frozen=True)
class Rule:
    name: str
    category: str
    severity: str
    description: str


MISSING = Rule("missing_required_values", "completeness", ERROR,
               "No required field may be empty.")
DUPLICATES = Rule("duplicate_location_date", "uniqueness", ERROR,
                  "A location has at most one row per day.")
COORDINATES = Rule("valid_coordinates", "validity", ERROR,
                   "Latitude lies in [-90, 90] and longitude in [-180, 180].")
HUMIDITY = Rule("relative_humidity_range", "physical_validity", ERROR,
                "Relative humidity lies in [0, 100].")
RAIN = Rule("negative_precipitation", "physical_validity", ERROR,
            "Precipitation is not negative.")
WIND = Rule("negative_wind_speed", "physical_validity", ERROR, "Wind speed is not negative.")
SOLAR = Rule("negative_solar_radiation", "physical_validity", ERROR,
             "Solar radiation is not negative.")
TEMPERATURE = Rule("temperature_consistency", "consistency", ERROR,
                   "Minimum, mean and maximum temperature are in order.")
COVERAGE = Rule("daily_date_coverage", "completeness", ERROR,
                "A location has every day between its first and last one.")
SOURCE = Rule("source_consistency", "lineage", ERROR, "All rows name the expected source.")
COLUMNS = Rule("required_columns_present", "schema", ERROR, "All required columns are present.")
ROW_RULES = (MISSING, DUPLICATES, COORDINATES, HUMIDITY, RAIN, WIND, SOLAR, TEMPERATURE,
             COVERAGE, SOURCE)


@dataclass(frozen=True)
class Baseline:
    """Expected size and span of the table."""

    rows: int = 73048
    locations: int = 8
    dates: int = 9131
    start_date: str = "2001-01-01"
    end_date: str = "2025-12-31"


def _status(severity: Column, affected: Column) -> Column:
    return (F.when(affected == 0, "PASS").when(severity == WARNING, "WARNING")
            .otherwise("FAIL"))


def _result(one: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rule rows from a one-row table with one count column per rule."""
    entries = F.array(*[F.struct(
        F.lit(r.name).alias("rule_name"), F.lit(r.category).alias("category"),
        F.lit(r.severity).alias("severity"),
        F.coalesce(F.col(r.name), F.lit(0)).cast("long").alias("affected_rows"),
        F.lit(r.description).alias("description")) for r in rules])
    return _with_status(one.select(F.inline(entries)))


def _with_status(rows: DataFrame) -> DataFrame:
    return rows.select("rule_name", "category", "severity",
                       _status(F.col("severity"), F.col("affected_rows")).alias("status"),
                       "affected_rows", "description")


def _violations(layout: Layout) -> dict[str, Column]:
    """Number of violations per row, for the rules that look at one row at a time."""
    nulls = F.lit(0)
    for field in layout.required:
        nulls = nulls + F.col(field).isNull().cast("int")
    low, mean, high = (F.col(f) for f in (
        layout.min_temperature, layout.mean_temperature, layout.max_temperature))
    rain, wind, solar = layout.non_negative
    flags = {
        COORDINATES: outside(F.col(layout.latitude), -90, 90)
        | outside(F.col(layout.longitude), -180, 180),
        HUMIDITY: outside(F.col(layout.humidity), 0, 100),
        RAIN: holds(F.col(rain) < 0), WIND: holds(F.col(wind) < 0),
        SOLAR: holds(F.col(solar) < 0),
        TEMPERATURE: holds(low > mean) | holds(mean > high) | holds(low > high),
        SOURCE: ~F.col(layout.source).eqNullSafe(layout.expected_source)}
    return {MISSING.name: nulls, **{r.name: c.cast("int") for r, c in flags.items()}}


def _row_rule(df: DataFrame, rule: Rule, layout: Layout) -> DataFrame:
    return _result(df.agg(F.sum(_violations(layout)[rule.name]).alias(rule.name)), [rule])


def check_missing_values(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    """Counts empty cells, not rows."""
    return _row_rule(df, MISSING, layout)


def check_coordinates(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    return _row_rule(df, COORDINATES, layout)


def check_humidity(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    return _row_rule(df, HUMIDITY, layout)


def check_non_negative(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    counts = _violations(layout)
    rules = [RAIN, WIND, SOLAR]
    return _result(df.agg(*[F.sum(counts[r.name]).alias(r.name) for r in rules]), rules)


def check_temperature_order(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    return _row_rule(df, TEMPERATURE, layout)


def check_source(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    return _row_rule(df, SOURCE, layout)


def check_duplicates(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    """Counts all rows of repeated (location, date) keys."""
    per_day = df.groupBy(layout.location, layout.date).agg(F.count("*").alias("n"))
    return _result(per_day.agg(F.sum(F.when(F.col("n") > 1, F.col("n")))
                               .alias(DUPLICATES.name)), [DUPLICATES])


def _gap_days(layout: Layout, days: str) -> Column:
    """Days absent between the first and last day of a group, given its number of days."""
    span = F.date_diff(F.max(layout.date), F.min(layout.date)) + 1
    return F.coalesce(span - F.sum(days), F.lit(0))


def check_daily_coverage(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    days = df.select(layout.location, layout.date).distinct()
    known = F.col(layout.date).isNotNull().cast("int")
    gaps = (days.withColumn("_day", known).filter(F.col(layout.location).isNotNull())
            .groupBy(layout.location).agg(_gap_days(layout, "_day").alias("gap")))
    return _result(gaps.agg(F.sum("gap").alias(COVERAGE.name)), [COVERAGE])


QUARTILES = {"q1": 0.25, "q3": 0.75}
LIMITS = ("q1", "q3", "iqr", "lower_bound", "upper_bound")


def _fences(ends: Ends) -> list[tuple[str, str]]:
    """Brackets of the two bounds, from the ends of the quartiles' own brackets."""
    low1, high1, low3, high3 = (ends(p, side) for p in (0.25, 0.75) for side in ("low", "high"))
    wide, narrow = f"({high3} - {low1})", f"({low3} - {high1})"
    return [(f"({low1} - {IQR_FACTOR}D * {wide})", f"({high1} - {IQR_FACTOR}D * {narrow})"),
            (f"({low3} + {IQR_FACTOR}D * {narrow})", f"({high3} + {IQR_FACTOR}D * {wide})")]


def quartile_counts(df: DataFrame, layout: Layout = WIDE) -> Ranked:
    """Rank counts of all measures, fine around the quartiles and around both bounds."""
    return ranked(long_values(df, layout), ["variable_code"], "value", list(QUARTILES.values()),
                  few_groups=True, limits=_fences)


def iqr_bounds(df: DataFrame, layout: Layout = WIDE, counts: Ranked | None = None) -> DataFrame:
    """Per variable: quartiles and the bounds 1.5 interquartile ranges away from them."""
    quartiles = quantiles(counts or quartile_counts(df, layout), QUARTILES)
    spread = F.col("q3") - F.col("q1")
    return quartiles.select(
        "variable_code", "q1", "q3", spread.alias("iqr"),
        (F.col("q1") - IQR_FACTOR * spread).alias("lower_bound"),
        (F.col("q3") + IQR_FACTOR * spread).alias("upper_bound"))


def long_values(df: DataFrame, layout: Layout = WIDE, keep: Sequence[str] = ()) -> DataFrame:
    """(keep, variable_code, value) rows of all measures, nulls included."""
    named = df.select(*keep, *[F.col(m).alias(code_of(m)) for m in layout.measures])
    return named.unpivot(list(keep), [code_of(m) for m in layout.measures],
                         "variable_code", "value")


def beyond(bounds_low: str = "lower_bound", bounds_high: str = "upper_bound") -> Column:
    return (F.col("value") < F.col(bounds_low)) | (F.col("value") > F.col(bounds_high))


def iqr_flags(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    """Per variable: values strictly beyond the bounds, in number and percent of the non-null.

    The counts that give the quartiles are fine around the bounds as well, so
    values beyond them are counted without another scan.
    """
    counts = quartile_counts(df, layout)
    limits = iqr_bounds(df, layout, counts)
    below, above = F.col("_high") < F.col("lower_bound"), F.col("_low") > F.col("upper_bound")
    split = "CAST(raise_error('a bound lies outside its bracket') AS BIGINT)"
    out = F.when(below | above, F.col("_c")).when(
        (F.col("_low") < F.col("lower_bound")) | (F.col("_high") > F.col("upper_bound")),
        F.expr(split)).otherwise(0)
    # One row per measure.
    found = counts.counts.join(F.broadcast(limits), "variable_code").groupBy(
        "variable_code", *LIMITS).agg(F.sum(out).alias("out"), F.sum("_c").alias("n"))
    codes = ", ".join(f"'{code_of(m)}'" for m in layout.measures)
    every = df.sparkSession.range(1).select(
        F.expr(f"explode(array({codes}))").alias("variable_code"))
    percent = F.when(F.col("n") > 0, F.col("out") * 100.0 / F.col("n")).otherwise(0.0)
    return every.join(found, "variable_code", "left").select(
        "variable_code", *LIMITS, F.coalesce("out", F.lit(0)).cast("long").alias("outlier_count"),
        percent.alias("outlier_percent"), F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def _iqr_rules(flags: DataFrame) -> DataFrame:
    return _with_status(flags.select(
        F.concat(F.lit("iqr_flag_"), F.col("variable_code")).alias("rule_name"),
        F.lit("statistical_diagnostic").alias("category"), F.lit(WARNING).alias("severity"),
        F.col("outlier_count").alias("affected_rows"),
        F.concat(F.col("variable_code"), F.lit(" values beyond 1.5 interquartile ranges; "
                                               "unusual, not necessarily wrong."))
        .alias("description")))


def check_baseline(df: DataFrame, baseline: Baseline, layout: Layout = WIDE) -> DataFrame:
    """Five rules on rows, locations, days, first and last day."""
    observed = df.agg(
        F.count("*").cast("string").alias("rows"),
        F.count_distinct(layout.location).cast("string").alias("locations"),
        F.count_distinct(layout.date).cast("string").alias("dates"),
        F.min(layout.date).cast("string").alias("start_date"),
        F.max(layout.date).cast("string").alias("end_date"))
    rules = [("baseline_row_count", "rows"), ("baseline_location_count", "locations"),
             ("baseline_date_count", "dates"), ("baseline_start_date", "start_date"),
             ("baseline_end_date", "end_date")]
    entries = F.array(*[F.struct(
        F.lit(rule).alias("rule_name"), F.lit("baseline").alias("category"),
        F.lit(ERROR).alias("severity"),
        (~F.col(field).eqNullSafe(str(getattr(baseline, field)))).cast("long")
        .alias("affected_rows"),
        F.concat(F.lit(f"Expected {getattr(baseline, field)}; observed "),
                 F.coalesce(F.col(field), F.lit("none")), F.lit(".")).alias("description"))
        for rule, field in rules])
    return _with_status(observed.select(F.inline(entries)))


def rule_counts(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    """All row, key and coverage rules in one scan and one wide shuffle.

    Counts per (location, date) are combined on the map side; the same groups
    give the repeated keys, and their totals per location give the gaps.
    """
    counts = _violations(layout)
    per_day = df.groupBy(layout.location, layout.date).agg(
        F.count("*").alias("_n"), *[F.sum(c).alias(n) for n, c in counts.items()])
    per_location = (per_day.withColumn("_day", F.col(layout.date).isNotNull().cast("int"))
                    .groupBy(layout.location).agg(
        F.when(F.col(layout.location).isNotNull(), _gap_days(layout, "_day"))
        .otherwise(0).alias(COVERAGE.name),
        F.sum(F.when(F.col("_n") > 1, F.col("_n"))).alias(DUPLICATES.name),
        *[F.sum(n).alias(n) for n in counts]))
    return per_location.agg(*[F.sum(r.name).alias(r.name) for r in ROW_RULES])


def require_columns(df: DataFrame, layout: Layout = WIDE) -> None:
    absent = [c for c in layout.required if c not in df.columns]
    if absent:
        raise ValueError(f"missing required columns: {absent}")


def quality_summary(df: DataFrame, layout: Layout = WIDE,
                    baseline: Baseline | None = None) -> DataFrame:
    """All rule rows in rule order; stops when required columns are absent."""
    require_columns(df, layout)
    rules = _result(rule_counts(df, layout).withColumn(COLUMNS.name, F.lit(0)),
                    [COLUMNS, *ROW_RULES])
    every = rules.unionByName(_iqr_rules(iqr_flags(df, layout)))
    names = [COLUMNS.name, *[r.name for r in ROW_RULES],
             *[f"iqr_flag_{code_of(m)}" for m in layout.measures]]
    if baseline is not None:
        every = every.unionByName(check_baseline(df, baseline, layout))
        names += ["baseline_row_count", "baseline_location_count", "baseline_date_count",
                  "baseline_start_date", "baseline_end_date"]
    place = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("rule_name"))
    return every.orderBy(place)


def quality_overall(df: DataFrame, layout: Layout = WIDE, baseline: Baseline | None = None,
                    summary: DataFrame | None = None) -> DataFrame:
    """One row: overall status, failures, warnings, flags and the size of the table."""
    rules = summary if summary is not None else quality_summary(df, layout, baseline)
    failed = (F.col("severity") == ERROR) & (F.col("status") == "FAIL")
    is_flag = F.col("rule_name").startswith("iqr_flag_")
    verdict = rules.agg(
        F.when(F.max(failed), "FAIL").otherwise("PASS").alias("overall_status"),
        F.count_if(failed).alias("error_failures"),
        F.count_if(F.col("status") == "WARNING").alias("warning_rules"),
        F.sum(F.when(is_flag, F.col("affected_rows")).otherwise(0)).alias("total_iqr_flags"))
    size = df.agg(
        F.count("*").alias("rows"), F.count_distinct(layout.location).alias("locations"),
        F.count_distinct(layout.date).alias("dates"), F.min(layout.date).alias("start_date"),
        F.max(layout.date).alias("end_date"),
        F.count_distinct(layout.source).alias("sources"))
    return verdict.crossJoin(size)
