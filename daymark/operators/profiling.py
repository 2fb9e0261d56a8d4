"""Profiles of the wide table: coverage, gaps, distributions, jumps and stale runs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymark.functions.columns import holds, text_to_date
from daymark.functions.quantiles import exact_quantiles, quantiles, ranked
from daymark.functions.skew import repeated_keys
from daymark.functions.storage import pinned
from daymark.operators.checks import one_row_table
from daymark.operators.quality import iqr_flags, long_values
from daymark.schema import CANDIDATE_PROBLEMS, SENTINELS, WIDE, Layout, code_of

# Quantile columns of the percentile report.
TAIL_QUANTILES = {"p0_1": 0.001, "p1": 0.01, "p5": 0.05, "p50": 0.5, "p95": 0.95, "p99": 0.99,
                  "p99_9": 0.999}
# Correlations per aggregation.
PAIRS_AT_ONCE = 7
# Rows without a date come after all years.
UNDATED = 100000
RAIN_QUANTILES = {"p90": 0.9, "p95": 0.95, "p99": 0.99, "p99_5": 0.995, "p99_9": 0.999}


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


# ---------------------------------------------------------------- schema and nulls

def profile_schema(df: DataFrame) -> DataFrame:
    """Per column: type, non-null, null and distinct count.

    Equal cells of a column are counted on the map side as (column, text) pairs.
    A distinct count per column would expand every row once per column instead.
    """
    kinds = dict(df.dtypes)

    def text(name: str) -> Column:
        # Minus zero equals zero.
        plain = F.col(name) + F.lit(0.0) if kinds[name] in ("double", "float") else F.col(name)
        return plain.cast("string")

    cells = df.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("_place"), text(c).alias("_value")) for i, c in enumerate(df.columns)])))
    counts = cells.groupBy("_place", "_value").agg(F.count("*").alias("_n"))
    totals = counts.groupBy("_place").agg(
        F.sum(F.when(F.col("_value").isNotNull(), F.col("_n"))).alias("_filled"),
        F.sum(F.when(F.col("_value").isNull(), F.col("_n"))).alias("_empty"),
        F.count("_value").alias("_unique"))
    names = F.array(*[F.struct(F.lit(i).alias("_place"), F.lit(c).alias("column"), F.lit(k).alias("dtype"))
                      for i, (c, k) in enumerate(df.dtypes)])
    listed = df.sparkSession.range(1).select(F.inline(names))

    def whole(name: str) -> Column:
        return F.coalesce(name, F.lit(0)).cast("long")

    return listed.join(totals, "_place", "left").select(
        "column", "dtype", whole("_filled").alias("non_null"), whole("_empty").alias("null"),
        whole("_unique").alias("unique"))


def profile_invalid_dates(raw: DataFrame, layout: Layout = WIDE) -> DataFrame:
    """Number of raw rows whose date text is no date."""
    return raw.agg(F.count_if(text_to_date(F.col(layout.date)).isNull()).alias("invalid_dates"))


def profile_missing(df: DataFrame) -> DataFrame:
    """Per column: empty cells in number and percent, most first."""
    counted = df.agg(F.count("*").alias("_rows"),
                     *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    entries = F.array(*[F.struct(
        F.lit(c).alias("column"), F.col(c).alias("missing_count"),
        F.when(F.col("_rows") > 0, F.col(c) * 100.0 / F.col("_rows")).alias("missing_percent"))
        for c in df.columns])
    return counted.select(F.inline(entries)).orderBy(F.desc("missing_percent"), "column")


def profile_missing_measures(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    nulls = sum((F.col(m).isNull().cast("int") for m in layout.measures), F.lit(0))
    return df.agg(F.coalesce(F.sum(nulls), F.lit(0)).alias("missing_measure_cells"))


def profile_sentinels(df: DataFrame, layout: Layout = WIDE,
                      codes: Sequence[int] = SENTINELS) -> DataFrame:
    """(variable, code, rows) for codes that stand for a missing reading."""
    return (long_values(df, layout).filter(F.col("value").isin(*[float(c) for c in codes]))
            .groupBy("variable_code", F.col("value").cast("int").alias("sentinel"))
            .agg(F.count("*").alias("rows")))


# ---------------------------------------------------------------- coverage in time and space

def profile_temporal_coverage(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    return df.groupBy(layout.location).agg(
        F.min(layout.date).alias("min_date"), F.max(layout.date).alias("max_date"),
        F.count(layout.date).alias("observations"))


def profile_points(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    columns = [layout.location, layout.latitude, layout.longitude]
    return df.select(*columns).distinct().orderBy(*columns)


def profile_coordinate_variants(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    """Distinct coordinates per location, counted over the distinct points."""
    points = df.select(layout.location, layout.latitude, layout.longitude).distinct()
    return points.groupBy(layout.location).agg(
        F.count_distinct(layout.latitude).alias("latitude_count"),
        F.count_distinct(layout.longitude).alias("longitude_count"))


def profile_bounding_box(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    points = df.select(layout.location, layout.latitude, layout.longitude).distinct()
    box = points.agg(
        F.count("*").alias("sampled_locations"),
        F.min(layout.latitude).alias("latitude_min"), F.max(layout.latitude).alias("latitude_max"),
        F.min(layout.longitude).alias("longitude_min"),
        F.max(layout.longitude).alias("longitude_max"))
    return box.select("*", (F.col("latitude_max") - F.col("latitude_min"))
                      .alias("latitude_span_degrees"),
                      (F.col("longitude_max") - F.col("longitude_min"))
                      .alias("longitude_span_degrees"))


def profile_date_gaps(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    """Per location: first and last day, expected, observed and missing days."""
    located = df.filter(F.col(layout.location).isNotNull())
    days = located.groupBy(layout.location, layout.date).agg(F.count("*").alias("_n"))
    span = F.coalesce(F.date_diff(F.max(layout.date), F.min(layout.date)) + 1, F.lit(0))
    return days.groupBy(layout.location).agg(
        F.min(layout.date).alias("start_date"), F.max(layout.date).alias("end_date"),
        span.cast("long").alias("expected_days"),
        F.count(layout.date).alias("observed_unique_days")).withColumn(
        "missing_days", F.col("expected_days") - F.col("observed_unique_days"))


def profile_missing_dates(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    """Every absent (location, day) between a location's first and last day.

    A location's calendar is made from its two end days, which are aggregates;
    no rows of a location are gathered.
    """
    located = df.filter(F.col(layout.location).isNotNull() & F.col(layout.date).isNotNull())
    ends = located.groupBy(layout.location).agg(F.min(layout.date).alias("_from"),
                                                F.max(layout.date).alias("_to"))
    expected = ends.select(layout.location,
                           F.explode(F.sequence("_from", "_to")).alias(layout.date))
    observed = located.select(layout.location, layout.date).distinct()
    return expected.join(observed, [layout.location, layout.date], "left_anti")


def profile_location_counts(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    return (df.filter(F.col(layout.location).isNotNull()).groupBy(layout.location)
            .agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), layout.location))


def profile_annual_counts(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    """Row counts of every year and location that occur together, in long form.

    A matrix needs a column per location and so a list of them; in long form no
    location is left out, however many there are.
    """
    return df.filter(F.col(layout.location).isNotNull()) \
        .groupBy(F.year(layout.date).alias("year"), layout.location).agg(F.count("*").alias("rows"))


def profile_sources(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    """Rows per source, nulls included, and whether there is only one."""
    counts = df.groupBy(layout.source).agg(F.count("*").alias("records"))
    labels = counts.agg(F.count("*").alias("_labels"))
    return counts.crossJoin(F.broadcast(labels)).select(
        layout.source, "records", F.col("_labels").alias("number_of_source_labels"),
        (F.col("_labels") == 1).alias("single_source_dependency"))


def profile_coverage(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    return df.agg(F.count("*").alias("records"),
                  F.count_distinct(F.year(layout.date)).alias("years_covered"),
                  F.count_distinct(layout.location).alias("locations")).select(
        "*", F.lit(True).alias("daily_temporal_resolution"),
        F.lit(False).alias("nationally_exhaustive_spatial_coverage"))


# ---------------------------------------------------------------- duplicates and rules

def profile_exact_duplicates(df: DataFrame) -> DataFrame:
    """Rows beyond the first of identical rows."""
    extra = repeated_keys(df, df.columns)
    return extra.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0))
                     .alias("exact_duplicate_rows"))


def sample_exact_duplicates(df: DataFrame, order: Sequence[str], rows: int = 20) -> DataFrame:
    """First identical rows in order, each as often as it occurs.

    Every repeated row fills at least two places, so the first `rows` groups are enough.
    """
    groups = repeated_keys(df, df.columns).orderBy(*order, *df.columns).limit(rows)
    places = F.sequence(F.lit(1), F.least(F.col("copies"), F.lit(rows)).cast("int"))
    return (groups.withColumn("_i", F.explode(places)).orderBy(*order, *df.columns).limit(rows)
            .drop("_i", "copies"))


def profile_key_duplicates(df: DataFrame, rows: int = 30, tie: Sequence[str] = (),
                           layout: Layout = WIDE) -> DataFrame:
    """Sample of rows with a repeated (location, date), with the number of all such rows.

    The first `rows` repeated keys hold all rows of the sample, so only they are
    looked up.
    """
    key = [layout.location, layout.date]
    repeated = repeated_keys(df, key)
    total = repeated.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("duplicate_rows"))
    first = repeated.orderBy(*key).limit(rows).select(*[F.col(k).alias(f"_{k}") for k in key])
    match = reduce(lambda a, b: a & b, [df[k].eqNullSafe(first[f"_{k}"]) for k in key])
    sample = (df.join(F.broadcast(first), match, "left_semi")
              .orderBy(*key, *tie).limit(rows))
    return sample.crossJoin(total)


def _violations(layout: Layout) -> dict[str, Column]:
    """Rules of the profile; a missing value breaks none of them."""
    low, mean, high = (F.col(c) for c in (
        layout.min_temperature, layout.mean_temperature, layout.max_temperature))
    rain, wind, solar = layout.non_negative
    humidity, lat, lon = (F.col(c) for c in (layout.humidity, layout.latitude,
                                             layout.longitude))
    return {
        "temperature_consistency_violations": holds(low > mean) | holds(mean > high),
        "invalid_relative_humidity": holds(humidity < 0) | holds(humidity > 100),
        "negative_precipitation": holds(F.col(rain) < 0),
        "negative_wind_speed": holds(F.col(wind) < 0),
        "negative_solar_radiation": holds(F.col(solar) < 0),
        "invalid_coordinates": holds(lat < -90) | holds(lat > 90) | holds(lon < -180)
        | holds(lon > 180)}


def profile_rule_violations(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    rules = _violations(layout)
    one = df.agg(*[F.count_if(c).alias(n) for n, c in rules.items()])
    return one_row_table(one, "rule", "violations", list(rules))


def _key_facts(df: DataFrame, layout: Layout) -> DataFrame:
    """One row of totals from the (location, date) groups: rows, repeats, gaps, rules."""
    rules = _violations(layout)
    per_day = df.groupBy(layout.location, layout.date).agg(
        F.count("*").alias("_n"), *[F.count_if(c).alias(n) for n, c in rules.items()],
        *[F.count_if(F.col(m).isNull()).alias(f"missing_{m}") for m in layout.measures])
    sums = [*rules, *[f"missing_{m}" for m in layout.measures]]
    span = F.date_diff(F.max(layout.date), F.min(layout.date)) + 1 - F.count(layout.date)
    per_location = per_day.groupBy(layout.location).agg(
        F.sum("_n").alias("_rows"),
        F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(0)).alias("_repeated"),
        F.sum(F.when(F.col(layout.date).isNull(), F.col("_n")).otherwise(0)).alias("_undated"),
        F.when(F.col(layout.location).isNotNull(), F.coalesce(span, F.lit(0))).otherwise(0)
        .alias("_gap"), *[F.sum(c).alias(c) for c in sums])

    def total(column: str, name: str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).alias(name)

    return per_location.agg(
        total("_rows", "rows"), F.count(layout.location).alias("locations"),
        total("_undated", "invalid_dates"), total("_repeated", "duplicate_location_date_rows"),
        total("_gap", "missing_days"), *[total(c, c) for c in sums])


def profile_quality_report(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    """(section, metric, value) rows of the first profiling report."""
    facts = _key_facts(df, layout)
    exact = profile_exact_duplicates(df)
    one = facts.crossJoin(exact).withColumn("columns", F.lit(len(df.columns)))
    sections = {
        "dataset": ["rows", "columns", "locations"],
        "quality_checks": ["invalid_dates", "exact_duplicate_rows",
                           "duplicate_location_date_rows", *_violations(layout)],
        "missing_values": [f"missing_{m}" for m in layout.measures],
        "missing_days": ["missing_days"]}
    entries = F.array(*[F.struct(F.lit(s).alias("section"), F.lit(m).alias("metric"),
                                 F.col(m).cast("long").alias("value"))
                        for s, names in sections.items() for m in names])
    fixed = one.select(F.inline(entries))
    sentinels = profile_sentinels(df, layout).select(
        F.lit("sentinel_values").alias("section"),
        F.concat_ws(":", "variable_code", F.col("sentinel").cast("string")).alias("metric"),
        F.col("rows").alias("value"))
    gaps = profile_date_gaps(df, layout).select(
        F.lit("missing_days_by_location").alias("section"),
        F.col(layout.location).alias("metric"), F.col("missing_days").alias("value"))
    return _union([fixed, sentinels, gaps])


def profile_candidate_problems(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    """(dimension, problem, count) rows of the six basic problems."""
    return problem_rows(_key_facts(df, layout))


def problem_rows(totals: DataFrame) -> DataFrame:
    """The six basic problems from one row of totals."""
    entries = F.array(*[F.struct(F.lit(d).alias("dimension"), F.lit(p).alias("problem"),
                                 F.col(c).cast("long").alias("count")) for d, p, c in CANDIDATE_PROBLEMS])
    return totals.select(F.inline(entries))


# ---------------------------------------------------------------- distributions

def _moments(value: str = "value") -> list[Column]:
    return [F.count(value).alias("count"), F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("std"), F.min(value).alias("min")]


def profile_describe(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles per measure, in the scans of the quartiles."""
    wanted = {"p25": 0.25, "p50": 0.5, "p75": 0.75}
    moments = [*_moments("_v"), F.max("_v").alias("max")]
    found = ranked(long_values(df, layout), ["variable_code"], "value", list(wanted.values()),
                   few_groups=True, statistics=moments)
    codes = ", ".join(f"'{code_of(m)}'" for m in layout.measures)
    every = df.sparkSession.range(1).select(
        F.expr(f"explode(array({codes}))").alias("variable_code"))
    names = ["count", "mean", "std", "min", "max"]
    return every.join(quantiles(found, wanted, names), "variable_code", "left").select(
        "variable_code", F.coalesce("count", F.lit(0)).cast("long").alias("count"),
        "mean", "std", "min", "p25", "p50", "p75", "max")


def profile_percentiles(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    return exact_quantiles(long_values(df, layout), ["variable_code"], "value", TAIL_QUANTILES,
                           few_groups=True)


def profile_rain_percentiles(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    return exact_quantiles(df, [], layout.precipitation, RAIN_QUANTILES)


def profile_histogram(df: DataFrame, measure: str, bins: int) -> DataFrame:
    """Counts in bins of equal width between the smallest and largest value; empty bins too.

    The last bin includes the largest value.
    """
    values = df.select(F.col(measure).alias("_v")).filter(F.col("_v").isNotNull())
    # One row.
    ends = values.agg(F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    width = F.col("_high") - F.col("_low")
    place = F.when(width == 0, bins // 2).otherwise(F.least(
        F.floor((F.col("_v") - F.col("_low")) * F.lit(float(bins)) / F.when(width != 0, width)),
        F.lit(bins - 1)))
    counts = (values.crossJoin(F.broadcast(ends)).groupBy(place.cast("int").alias("bin"))
              .agg(F.count("*").alias("rows")))
    # A list of `bins` numbers.
    axis = ends.filter(F.col("_low").isNotNull()).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    low = F.when(width == 0, F.col("_low") - 0.5).otherwise(F.col("_low"))
    step = F.when(width == 0, 1.0).otherwise(width) / float(bins)
    return axis.join(counts, "bin", "left").select(
        "bin", (low + F.col("bin") * step).alias("lower_edge"),
        (low + (F.col("bin") + 1) * step).alias("upper_edge"),
        F.coalesce("rows", F.lit(0)).alias("rows"))


def profile_top_rain(df: DataFrame, rows: int = 20, layout: Layout = WIDE) -> DataFrame:
    return (df.select(layout.date, layout.location, layout.precipitation, layout.humidity,
                      layout.mean_temperature)
            .filter(F.col(layout.precipitation).isNotNull())
            .orderBy(F.desc(layout.precipitation), layout.location, layout.date).limit(rows))


def profile_temperature_extremes(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    """Per location: mean, lowest minimum, highest maximum and outer percentiles."""
    located = df.filter(F.col(layout.location).isNotNull())
    plain = located.groupBy(layout.location).agg(
        F.avg(layout.mean_temperature).alias("mean_temp"),
        F.min(layout.min_temperature).alias("minimum_tmin"),
        F.max(layout.max_temperature).alias("maximum_tmax"))
    tails = exact_quantiles(located, [layout.location], layout.mean_temperature,
                            {"t2m_p01": 0.01, "t2m_p99": 0.99})
    return plain.join(tails, layout.location, "left")


def profile_monthly_climatology(df: DataFrame, layout: Layout = WIDE,
                                digits: int = 3) -> DataFrame:
    return df.groupBy(F.month(layout.date).alias("month")).agg(
        *[F.round(F.avg(m), digits).alias(m) for m in layout.measures])


def profile_monthly_rain_matrix(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    """Mean rain of every calendar month and location, in long form."""
    return df.filter(F.col(layout.location).isNotNull()) \
        .groupBy(F.month(layout.date).alias("month"), layout.location) \
        .agg(F.avg(layout.precipitation).alias("mean_rain"))


def profile_location_stats(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    """Per location and measure: mean, deviation, minimum and maximum.

    All measures are aggregated side by side; only the short result is turned
    into one row per measure.
    """
    pieces = [(name, make(m).alias(f"{m}__{name}")) for m in layout.measures
              for name, make in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min),
                                 ("max", F.max))]
    wide = (df.filter(F.col(layout.location).isNotNull()).groupBy(layout.location)
            .agg(*[c for _, c in pieces]))
    entries = F.array(*[F.struct(
        F.lit(code_of(m)).alias("variable_code"),
        *[F.col(f"{m}__{s}").alias(s) for s in ("mean", "std", "min", "max")])
        for m in layout.measures])
    return wide.select(layout.location, F.inline(entries))


def profile_correlations(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    """Full correlation matrix in long form, over pairwise complete rows.

    The mirror half and the diagonal follow from the 21 pairs.  Pairs are
    aggregated a few at a time: the generated code of all of them together is
    too long for the JVM to compile, which costs more than reading twice.
    """
    names = list(layout.measures)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1:]]

    def correlation(a: str, b: str) -> Column:
        """The built-in function fails on a measure that never varies."""
        spread = (f"stddev_pop(CASE WHEN `{b}` IS NOT NULL THEN `{a}` END) * "
                  f"stddev_pop(CASE WHEN `{a}` IS NOT NULL THEN `{b}` END)")
        return F.expr(f"CASE WHEN {spread} > 0 THEN covar_pop(`{a}`, `{b}`) / ({spread}) END "
                      f"AS `{a}__{b}`")

    parts = [df.agg(*[correlation(a, b) for a, b in pairs[i:i + PAIRS_AT_ONCE]])
             for i in range(0, len(pairs), PAIRS_AT_ONCE)]
    parts.append(df.agg(*[F.expr(f"var_samp(`{a}`) AS `{a}__var`") for a in names]))
    one = reduce(lambda a, b: a.crossJoin(b), parts)

    def entry(a: str, b: str, value: str) -> str:
        return (f"named_struct('variable_a', '{code_of(a)}', 'variable_b', '{code_of(b)}', "
                f"'correlation', {value})")

    entries = [entry(a, a, f"CASE WHEN `{a}__var` > 0 THEN 1.0D END") for a in names]
    entries += [entry(x, y, f"`{a}__{b}`") for a, b in pairs for x, y in ((a, b), (b, a))]
    return one.select(F.expr(f"inline(array({', '.join(entries)}))"))


def profile_variance(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    """Distinct values, variance, deviation and a constant flag per measure."""
    counts = long_values(df, layout).groupBy("variable_code", "value").agg(
        F.count("value").alias("_n"))
    distinct = counts.groupBy("variable_code").agg(F.count("value").alias("unique_values"))
    spread = long_values(df, layout).groupBy("variable_code").agg(
        F.var_samp("value").alias("variance"), F.stddev_samp("value").alias("std_dev"))
    return distinct.join(spread, "variable_code").withColumn(
        "constant", F.col("unique_values") <= 1)


def profile_cross_location_uniform(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    """Per measure: days on which all rows agree; no value counts as a value.

    Agreement follows from minimum, maximum and number of values, so a day's
    rows are combined on the map side and need no distinct count.
    """
    per_day = (df.filter(F.col(layout.date).isNotNull()).groupBy(layout.date)
               .agg(F.count("*").alias("_rows"), *[
                   c for m in layout.measures for c in (
                       F.min(m).alias(f"{m}__low"), F.max(m).alias(f"{m}__high"),
                       F.count(m).alias(f"{m}__n"))]))

    def uniform(m: str) -> Column:
        whole = (F.col(f"{m}__n") == F.col("_rows")) & (F.col(f"{m}__low") == F.col(f"{m}__high"))
        return holds(whole) | (F.col(f"{m}__n") == 0)

    one = per_day.agg(F.count("*").alias("_days"),
                      *[F.count_if(uniform(m)).alias(m) for m in layout.measures])
    entries = F.array(*[F.struct(
        F.lit(code_of(m)).alias("variable_code"),
        F.col(m).alias("days_identical_across_all_locations"),
        F.when(F.col("_days") > 0, F.col(m) * 100.0 / F.col("_days")).alias("percent_of_dates"))
        for m in layout.measures])
    return one.select(F.inline(entries))


# ---------------------------------------------------------------- order in time

def daily_changes(df: DataFrame, measure: str, layout: Layout = WIDE) -> DataFrame:
    """Change of a measure since the previous row of the location, by date and value.

    Identical readings of a day are combined first (`copies`).  Windows cover one
    location and year; each year also gets the last row of the location's
    previous year with rows, so no long series has to pass through one task.
    """
    row = (df.filter(F.col(layout.location).isNotNull())
           .groupBy(layout.location, layout.date, F.col(measure).alias("value"))
           .agg(F.count("*").alias("copies"))
           .withColumn("_year", F.coalesce(F.year(layout.date), F.lit(UNDATED))))
    place = F.struct(F.col(layout.date).alias("d"), F.col("value").isNotNull().alias("p"),
                     F.col("value").alias("v"))
    years = row.groupBy(layout.location, "_year").agg(F.max(place).alias("_last"))
    following = F.lead("_year").over(Window.partitionBy(layout.location).orderBy("_year"))
    carried = (years.withColumn("_to", following).filter(F.col("_to").isNotNull())
               .select(layout.location, F.col("_last.d").alias(layout.date),
                       F.col("_last.v").alias("value"), F.lit(0).cast("long").alias("copies"),
                       F.col("_to").alias("_year")))
    window = Window.partitionBy(layout.location, "_year").orderBy(
        F.col("copies") > 0, F.asc_nulls_last(layout.date), F.col("value").isNotNull(), "value")
    previous = F.lag("value").over(window)
    return (row.unionByName(carried).withColumn("change", F.col("value") - previous)
            .filter(F.col("copies") > 0).drop("_year"))


def profile_jumps(df: DataFrame, measure: str, quantile: float = 0.999,
                  layout: Layout = WIDE) -> DataFrame:
    """Rows whose absolute change reaches the given quantile of all absolute changes.

    Further copies of a reading have a change of zero.
    """
    # Read twice for the quantile and once for the result.
    changes = pinned(daily_changes(df, measure, layout).withColumn("_size", F.abs("change")))
    sizes, weight = changes.select("_size"), None
    if not changes.filter("copies > 1 AND value IS NOT NULL").limit(1).isEmpty():
        sizes, weight = changes.select(F.inline(F.array(
            F.struct(F.col("_size").alias("_size"), F.lit(1).cast("long").alias("_weight")),
            F.struct(F.when(F.col("value").isNotNull(), 0.0).alias("_size"),
                     (F.col("copies") - 1).alias("_weight"))))), F.col("_weight")
    limit = exact_quantiles(sizes, [], "_size", {"threshold": quantile}, weight=weight)
    # One row.
    joined = changes.crossJoin(F.broadcast(limit))
    # Copies matter only when a change of zero reaches the threshold.
    places = F.sequence(F.lit(1).cast("long"), F.when(
        (F.col("threshold") <= 0) & F.col("value").isNotNull(), F.col("copies"))
        .otherwise(F.lit(1).cast("long")))
    return (joined.withColumn("_copy", F.explode(places))
            .withColumn("change", F.when(F.col("_copy") == 1, F.col("change")).otherwise(0.0))
            .filter(F.abs("change") >= F.col("threshold"))
            .select(layout.date, layout.location, F.col("value").alias(measure),
                    F.col("change").alias("daily_change"), "threshold"))


def profile_longest_equal_run(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    """Longest run of one value per location and measure; a missing value is its own run.

    Rows are ordered by date and, within a date, by their measures.  Identical
    rows of a day are combined first.  Windows cover one location and year; a
    second step over the yearly summaries joins runs that cross a year's end.
    """
    measures = layout.measures
    row = (df.filter(F.col(layout.location).isNotNull())
           .groupBy(layout.location, layout.date, *measures)
           .agg(F.count("*").alias("copies"))
           .withColumn("_year", F.coalesce(F.year(layout.date), F.lit(UNDATED))))
    per_year = Window.partitionBy(layout.location, "_year").orderBy(
        F.asc_nulls_last(layout.date), *measures)
    placed = row.withColumns({
        "_upto": F.sum("copies").over(per_year),
        **{f"{m}__same": holds(F.col(m) == F.lag(m).over(per_year)) for m in measures}})
    # Rows before the start of the current run; it only grows, so a running maximum finds it.
    started = placed.withColumns({f"{m}__from": F.max(F.when(
        ~F.col(f"{m}__same"), F.col("_upto") - F.col("copies"))).over(per_year)
        for m in measures})

    def length(m: str) -> Column:
        return F.when(F.col(m).isNull(), 1).otherwise(F.col("_upto") - F.col(f"{m}__from"))

    # Per year and measure: longest run, first and last run, and the values at both ends.
    years = started.groupBy(layout.location, "_year").agg(
        F.max("_upto").alias("_rows"),
        *[c for m in measures for c in (
            F.max(length(m)).alias(f"{m}__longest"),
            F.max(F.when((F.col(f"{m}__from") == 0) & F.col(m).isNotNull(),
                         F.col("_upto"))).alias(f"{m}__first"),
            F.max_by(length(m), F.col("_upto")).alias(f"{m}__last"),
            F.min_by(F.col(m), F.col("_upto")).alias(f"{m}__head"),
            F.max_by(F.col(m), F.col("_upto")).alias(f"{m}__tail"))])
    entries = F.array(*[F.struct(
        F.lit(code_of(m)).alias("variable_code"),
        *[F.col(f"{m}__{s}").alias(s) for s in ("longest", "first", "last", "head", "tail")])
        for m in measures])
    # From here on there is one row per location, measure and year.
    key = [layout.location, "variable_code"]
    summed = years.select(layout.location, "_year", "_rows", F.inline(entries))
    over_years = Window.partitionBy(*key).orderBy("_year")
    joins = holds(F.col("head") == F.lag("tail").over(over_years))
    # A year of one value adds all its rows to the run that reaches it.
    whole = holds(F.col("first") == F.col("_rows"))
    linked = summed.withColumns({"joins": joins, "passes": joins & whole})
    summed = linked.withColumn("_sum", F.sum(
        F.when(F.col("passes"), F.col("_rows")).otherwise(F.col("last"))).over(over_years))
    ended = summed.withColumn("_end", F.col("_sum") - F.max(F.when(
        ~F.col("passes"), F.col("_sum") - F.col("last"))).over(over_years))
    crossing = F.when(F.col("joins"), F.lag("_end").over(over_years) + F.col("first"))
    return (ended.withColumn("_crossing", crossing).groupBy(*key)
            .agg(F.greatest(F.max("longest"), F.max("_end"), F.max("_crossing"))
                 .alias("longest_identical_run_days")))


def profile_stale_top(df: DataFrame, rows: int = 30, layout: Layout = WIDE) -> DataFrame:
    return (profile_longest_equal_run(df, layout)
            .orderBy(F.desc("longest_identical_run_days"), layout.location, "variable_code")
            .limit(rows))


# ---------------------------------------------------------------- summary in words

def profile_advanced_problems(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    """Three limitations of the data with the counts that show them."""
    flags = iqr_flags(df, layout).agg(F.sum("outlier_count").alias("_flags"))
    sources = df.select(layout.source).distinct().agg(F.count("*").alias("_sources"))
    points = df.agg(F.count_distinct(layout.location).alias("_points"))

    def entry(dimension: str, problem: str, count: str, evidence: str, implication: str):
        return F.struct(F.lit(dimension).alias("dimension"), F.lit(problem).alias("problem"),
                        F.concat(F.col(count).cast("string"), F.lit(evidence)).alias("evidence"),
                        F.lit(implication).alias("engineering_implication"))

    entries = F.array(
        entry("Spatial coverage", "Few sampled points", "_points",
              " locations are sampled", "Regional use needs denser sampling."),
        entry("Source resilience", "Dependency on few sources", "_sources",
              " source labels occur", "Comparing sources needs a further, independent one."),
        entry("Extreme values", "Extremes need a second look", "_flags",
              " values lie beyond the interquartile bounds",
              "Flag extremes for review; do not delete them."))
    return points.crossJoin(sources).crossJoin(flags).select(F.inline(entries))
