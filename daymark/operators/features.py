"""Lag and rolling features under an availability delay, and chronological splits."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymark.operators.checks import check_rows
from daymark.schema import MART, Layout


@dataclass(frozen=True)
class Rolling:
    """Mean of `days` days of a measure, ending at the newest usable day."""

    measure: str
    name: str
    days: int


@dataclass(frozen=True)
class FeaturePlan:
    """Which features are made.  `delay` is the age in days of the newest usable reading."""

    delay: int = 8
    lags: tuple[int, ...] = (8, 14, 30)
    rolling: tuple[Rolling, ...] = (
        Rolling("prectotcorr", "precip_mean_7d_available", 7),
        Rolling("prectotcorr", "precip_mean_30d_available", 30),
        Rolling("t2m", "temperature_mean_7d_available", 7),
        Rolling("rh2m", "humidity_mean_7d_available", 7))
    lag_prefix: str = "precip_lag_"
    target: str = "target_precip_next_day"
    series: tuple[str, ...] = ("location_name", "source_name")

    @property
    def reach(self) -> int:
        """How many days back the oldest reading lies that a row may use."""
        return max([*self.lags, *[self.delay + r.days - 1 for r in self.rolling]])

    @property
    def predictors(self) -> list[str]:
        return (["latitude", "longitude", "month", "day_of_year"]
                + [f"{self.lag_prefix}{n}" for n in self.lags] + [r.name for r in self.rolling])

    @property
    def audit(self) -> list[str]:
        return ["observation_date", "target_date", "location_name", "source_name",
                "latest_weather_observation_date", self.target]


AVAILABILITY = FeaturePlan()
# The older preset: yesterday is usable, and series are told apart by location only.
LEGACY = FeaturePlan(
    delay=1, lags=(1, 3, 7),
    rolling=(Rolling("prectotcorr", "precip_rolling_7d", 7),
             Rolling("prectotcorr", "precip_rolling_30d", 30),
             Rolling("t2m", "temperature_rolling_7d", 7), Rolling("rh2m", "humidity_rolling_7d", 7)),
    series=("location_name",))


@dataclass(frozen=True)
class SplitPlan:
    train_end: str = "2018-12-31"
    validation_start: str = "2019-01-01"
    validation_end: str = "2021-12-31"
    test_start: str = "2022-01-01"
    test_end: str = "2025-12-31"


def continuity_check(mart: DataFrame, series: Sequence[str] = ("location_name", "source_name"),
                     layout: Layout = MART) -> DataFrame:
    """Days that break a series: repeated days and days after a gap.

    Copies of a day are counted before the window, which so sees one row per
    calendar day of a series, however many rows the series has.
    """
    days = mart.groupBy(*series, layout.date).agg(F.count("*").alias("copies"))
    previous = F.lag(layout.date).over(Window.partitionBy(*series).orderBy(layout.date))
    return (days.withColumn("previous_date", previous)
            .withColumn("gap_days", F.date_diff(layout.date, "previous_date"))
            .filter((F.col("copies") > 1) | (F.col("gap_days") != 1)))


NOT_CONTINUOUS = "features need unique continuous daily observations per series"


def require_spans(mart: DataFrame, series: Sequence[str], layout: Layout = MART) -> DataFrame:
    """The same rows; the job fails when a series has not as many rows as days from first to last.

    Counts and ends per series are combined on the map side.  Together with
    `_checked_date`, which sees repeated days, no gap can hide.
    """
    span = F.date_diff(F.max(layout.date), F.min(layout.date)) + 1
    check = mart.groupBy(*series).agg((F.count("*") == span).alias("_whole")).agg(
        F.count_if(~F.coalesce("_whole", F.lit(False))).alias("_breaks"))
    # One row.
    return (mart.crossJoin(F.broadcast(check))
            .filter(F.when(F.col("_breaks") == 0, True).otherwise(F.raise_error(F.lit(NOT_CONTINUOUS))))
            .drop("_breaks"))


def _checked_date(previous: Column, layout: Layout) -> Column:
    """The date, if it is the day after the previous one or the first; stops the job otherwise.

    It is a value and not a filter: in a filter the planner puts a date that is
    asked for in the place of the column, and tests it on every row.
    """
    step = F.date_diff(layout.date, previous)
    return F.when(previous.isNull() | (step == 1), F.col(layout.date)).otherwise(
        F.raise_error(F.lit(NOT_CONTINUOUS)))


def _with_margin(mart: DataFrame, reach: int, ahead: int, layout: Layout) -> DataFrame:
    """Copy rows near a year's edge into the neighbouring year's window.

    Windows per year keep a long series from ending up in one task.  A row goes
    to its own year and to every year whose rows look back, or ahead, at it.
    """
    day = F.col(layout.date)
    years = F.sequence(F.year(F.date_sub(day, ahead)), F.year(F.date_add(day, reach)))
    return mart.withColumn("_year", F.explode(years))


def calendar_features(df: DataFrame, layout: Layout = MART) -> DataFrame:
    return df.withColumns({"month": F.month(layout.date), "day_of_year": F.dayofyear(layout.date)})


def _order(plan: FeaturePlan, layout: Layout, extra: Sequence[str] = ()):
    return Window.partitionBy(*plan.series, *extra).orderBy(layout.date)


def _lag_columns(plan: FeaturePlan, window, layout: Layout) -> dict[str, Column]:
    return {f"{plan.lag_prefix}{n}": F.lag(layout.precipitation, n).over(window)
            for n in plan.lags}


def _sum_name(measure: str) -> str:
    return f"_sum_{measure}"


def _running_columns(plan: FeaturePlan, window) -> dict[str, Column]:
    """Running sums and counts of the readings; one that is missing or not finite counts as none."""
    to_here = window.rowsBetween(Window.unboundedPreceding, 0)
    columns = {}
    for measure in dict.fromkeys(r.measure for r in plan.rolling):
        given = F.coalesce(F.abs(measure) < float("inf"), F.lit(False))
        columns[_sum_name(measure)] = F.sum(F.when(given, F.col(measure)).otherwise(0.0)).over(to_here)
        columns[f"{_sum_name(measure)}_n"] = F.sum(F.when(given, 1).otherwise(0)).over(to_here)
    return columns


def _rolling_columns(plan: FeaturePlan, window) -> dict[str, Column]:
    """Means as differences of two running sums; sums of binary fractions are exact.

    Before the first row of a window both are zero, so a window that begins
    earlier is never full.
    """
    def between(name: str, r: Rolling) -> Column:
        newest, before = (F.lag(name, n, 0).over(window) for n in (plan.delay, plan.delay + r.days))
        return newest - before

    return {r.name: F.when(between(f"{_sum_name(r.measure)}_n", r) == r.days,
                           between(_sum_name(r.measure), r) / r.days) for r in plan.rolling}


def _target_columns(plan: FeaturePlan, window, layout: Layout) -> dict[str, Column]:
    return {"latest_weather_observation_date": F.lag(layout.date, plan.delay).over(window),
            plan.target: F.lead(layout.precipitation, 1).over(window),
            "target_date": F.lead(layout.date, 1).over(window)}


def _windowed(mart: DataFrame, plan: FeaturePlan, layout: Layout, *makes) -> DataFrame:
    """Apply window columns per series and year, reading across year edges.

    `makes` are applied one after the other, so that later ones see the columns
    of earlier ones; all share one shuffle and one sort.
    """
    made = _with_margin(require_spans(mart, plan.series, layout), plan.reach, 1, layout)
    window = _order(plan, layout, ("_year",))
    made = made.withColumn("_previous", F.lag(layout.date).over(window))
    for make in makes:
        made = made.withColumns(make(window))
    return made.filter(F.year(layout.date) == F.col("_year")) \
        .withColumn(layout.date, _checked_date(F.col("_previous"), layout)).drop("_year", "_previous")


def delayed_lags(mart: DataFrame, plan: FeaturePlan = AVAILABILITY,
                 layout: Layout = MART) -> DataFrame:
    return _windowed(mart, plan, layout, lambda w: _lag_columns(plan, w, layout)).select(
        layout.date, *layout.series, *[f"{plan.lag_prefix}{n}" for n in plan.lags])


def delayed_rolling_means(mart: DataFrame, plan: FeaturePlan = AVAILABILITY,
                          layout: Layout = MART) -> DataFrame:
    """Means over a full window of readings; a window with a missing one has none."""
    return _windowed(mart, plan, layout, lambda w: _running_columns(plan, w),
                     lambda w: _rolling_columns(plan, w)).select(
        layout.date, *layout.series, *[r.name for r in plan.rolling])


def as_of_and_target(mart: DataFrame, plan: FeaturePlan = AVAILABILITY,
                     layout: Layout = MART) -> DataFrame:
    return _windowed(mart, plan, layout, lambda w: _target_columns(plan, w, layout)).select(
        layout.date, *layout.series, "latest_weather_observation_date", plan.target,
        "target_date")


def create_features(mart: DataFrame, plan: FeaturePlan = AVAILABILITY,
                    layout: Layout = MART) -> DataFrame:
    """All audit columns and predictors, from one shuffle and one sort."""
    needed = [layout.date, *layout.series, layout.latitude, layout.longitude,
              *dict.fromkeys([layout.precipitation, *[r.measure for r in plan.rolling]])]
    made = _windowed(
        mart.select(*needed), plan, layout,
        lambda w: {**_running_columns(plan, w), **_lag_columns(plan, w, layout),
                   **_target_columns(plan, w, layout)},
        lambda w: _rolling_columns(plan, w))
    return calendar_features(made, layout).select(*plan.audit, *plan.predictors)


def _complete(plan: FeaturePlan) -> Column:
    needed = [*plan.predictors, plan.target, "target_date", "latest_weather_observation_date"]
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in needed])


def drop_incomplete(features: DataFrame, plan: FeaturePlan = AVAILABILITY) -> DataFrame:
    """Rows with every predictor, the target and both dates."""
    return features.filter(_complete(plan))


def _crosses(splits: SplitPlan) -> Column:
    """The row's day and its target's day lie on different sides of a split boundary."""
    day, target = F.col("observation_date"), F.col("target_date")
    train, validation = F.lit(splits.train_end).cast("date"), \
        F.lit(splits.validation_end).cast("date")
    start = F.lit(splits.validation_start).cast("date")
    return ((day <= train) & (target > train)) | \
        ((day >= start) & (day <= validation) & (target > validation))


def boundary_purge(features: DataFrame, splits: SplitPlan = SplitPlan()) -> DataFrame:
    return features.filter(~F.coalesce(_crosses(splits), F.lit(False)))


def removal_counts(features: DataFrame, plan: FeaturePlan = AVAILABILITY,
                   splits: SplitPlan = SplitPlan()) -> DataFrame:
    """One row: source rows, rows without full history or target, purged rows, kept rows."""
    complete = _complete(plan)
    crossing = complete & F.coalesce(_crosses(splits), F.lit(False))
    return features.agg(
        F.count("*").alias("source_rows"),
        F.count_if(~complete).alias("history_or_target_rows_removed"),
        F.count_if(crossing).alias("target_boundary_rows_removed"),
        F.count_if(complete & ~crossing).alias("ml_ready_rows"))


def ml_ready(mart: DataFrame, plan: FeaturePlan = AVAILABILITY,
             splits: SplitPlan = SplitPlan(), layout: Layout = MART) -> DataFrame:
    return boundary_purge(drop_incomplete(create_features(mart, plan, layout), plan), splits)


def temporal_split(features: DataFrame, splits: SplitPlan = SplitPlan(),
                   by_target: bool = True, keep_others: bool = False) -> DataFrame:
    """Rows of the three splits with a `split` column.

    One pass marks all three; write with partitionBy("split") or filter on it.
    Rows of no split drop out, or keep a null split with `keep_others`.
    """
    day, target = F.col("observation_date"), F.col("target_date")

    def bound(text: str) -> Column:
        return F.lit(text).cast("date")

    def inside(end: str) -> Column:
        return (target if by_target else day) <= bound(end)

    name = (F.when((day <= bound(splits.train_end)) & inside(splits.train_end), "train")
            .when((day >= bound(splits.validation_start)) & inside(splits.validation_end),
                  "validation")
            .when((day >= bound(splits.test_start)) & inside(splits.test_end), "test"))
    marked = features.withColumn("split", name)
    return marked if keep_others else marked.filter(F.col("split").isNotNull())


SPLITS = ("train", "validation", "test")


def split_checks(split: DataFrame, delay: int = AVAILABILITY.delay) -> DataFrame:
    """Checks that splits are filled, apart, and free of readings newer than allowed."""
    day, target, newest = (F.col(c) for c in (
        "observation_date", "target_date", "latest_weather_observation_date"))

    def within(name: str, column: Column) -> Column:
        return F.when(F.col("split") == name, column)

    facts = split.agg(
        *[F.count_if(F.col("split") == s).alias(f"n_{s}") for s in SPLITS],
        *[F.max(within(s, target)).alias(f"end_{s}") for s in SPLITS],
        *[F.min(within(s, day)).alias(f"start_{s}") for s in SPLITS],
        F.count_if(~F.coalesce(F.date_diff(target, day) == 1, F.lit(False))).alias("not_next"),
        F.count_if(~F.coalesce(F.date_diff(day, newest) >= delay, F.lit(False)))
        .alias("too_recent"))
    rows = [(f"{s}_not_empty", "true", f"n_{s} > 0") for s in SPLITS]
    rows += [("train_before_validation", "true", "coalesce(end_train < start_validation, false)"),
             ("validation_before_test", "true", "coalesce(end_validation < start_test, false)"),
             ("target_is_next_day", "0", "not_next"),
             ("newest_reading_old_enough", "0", "too_recent")]
    return check_rows(facts, rows)


def split_metadata(split: DataFrame, removed: DataFrame | None = None,
                   plan: FeaturePlan = AVAILABILITY) -> DataFrame:
    """Rows, last feature day and last target day per split.

    With `removed`, the row of `removal_counts`, also the counts of what was taken
    out, the allowed predictors and the audit columns that are none.
    """
    rows = split.groupBy("split").agg(
        F.count("*").alias("rows"), F.max("observation_date").alias("feature_end"),
        F.max("target_date").alias("target_end"))
    if removed is None:
        return rows
    # One row.
    return rows.crossJoin(F.broadcast(removed)).withColumns({
        "predictors": F.lit("|".join(plan.predictors)),
        "excluded": F.lit("|".join(plan.audit))})


def retention_rate(counts: DataFrame) -> DataFrame:
    """Kept rows over source rows, from `removal_counts`."""
    return counts.select("source_rows", "ml_ready_rows",
                         F.when(F.col("source_rows") > 0,
                                F.col("ml_ready_rows") / F.col("source_rows"))
                         .alias("retention_rate"))


def leakage_probe(mart: DataFrame, issue_dates: str | Sequence[str],
                  plan: FeaturePlan = AVAILABILITY, layout: Layout = MART,
                  replacement: float = 99999.0, delay: int | None = None) -> DataFrame:
    """Per series and issue date: whether the features ignore all readings that are too new.

    For each issue date the readings after its newest usable day are replaced on
    the whole series, features are built on the whole series, and those of the
    issue date must not move.  `delay` is the age that readings must have, by
    default the plan's own; with it a plan that reads newer ones is found out.
    """
    dates = [issue_dates] if isinstance(issue_dates, str) else issue_dates
    age = plan.delay if delay is None else delay
    measures = dict.fromkeys([layout.precipitation, *[r.measure for r in plan.rolling]])
    found = None
    for text in dates:
        issue = F.lit(text).cast("date")
        late = F.col(layout.date) > F.date_sub(issue, age)
        changed = mart.withColumns({m: F.when(late & F.col(m).isNotNull(), F.lit(replacement) + F.col(m))
                                   .otherwise(F.col(m)) for m in measures})

        def at_issue(df: DataFrame, name: str) -> DataFrame:
            return create_features(df, plan, layout).filter(F.col("observation_date") == issue) \
                .select(*plan.series, F.struct(*plan.predictors).alias(name))

        part = at_issue(mart, "_a").join(at_issue(changed, "_b"), list(plan.series)).select(
            *plan.series, issue.alias("issue_date"),
            F.col("_a").eqNullSafe(F.col("_b")).alias("unchanged"))
        found = part if found is None else found.unionByName(part)
    return found
