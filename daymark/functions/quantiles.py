"""Exact quantiles with linear interpolation in two scans: bracket, then select.

The built-in exact percentile keeps every distinct value of a group in the
memory of one task.  Here a mergeable rank summary, one aggregate for all wanted
ranks of all groups, first gives values on both sides of each rank (a bracket).
A second scan counts the values outside the brackets and keeps only those inside
them value by value, so the wanted ranks follow from running counts.  How many
values lie inside depends on the accuracy of the summary and not on how they are
spread.  Ranks that fall outside their bracket stop the run.

Both steps are written to the shared folder and read by everything that follows:
further statistics of the first scan and counts beyond limits that themselves
depend on quantiles need no scan of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymark.functions.storage import pinned

# Steps of the rank summary: its error is one step of a group's rows.  Groups of a
# fixed small number get fine steps; of many groups each has a small summary.
ACCURACY, GROUP_ACCURACY = 10_000, 1_000
# A bracket reaches so many steps to both sides of its rank.
REACH = 3
# Values below each of these shares, besides those near the wanted ranks, split
# weighted rows before their ranks are known.
SPREAD = [i / 10 for i in range(11)]

INFINITY = "double('Infinity')"
Ends = Callable[[float, str], str]


@dataclass(frozen=True)
class Ranked:
    """Rank counts of a table.

    summary: one row per group, with `_n` values and the statistics asked for.
    counts: per group and cell `_c` values between `_low` and `_high`; cells in
    order, those that hold a wanted rank once per value.
    """

    keys: tuple[str, ...]
    summary: DataFrame
    counts: DataFrame


def ranked(df: DataFrame, keys: Sequence[str], value: str, wanted: Sequence[float],
           weight: Column | None = None, few_groups: bool = False,
           accuracy: int | None = None, statistics: Sequence[Column] = (),
           limits: Callable[[Ends], Sequence[tuple[str, str]]] | None = None) -> Ranked:
    """Counts from which the wanted quantiles of each key group follow.

    `statistics` are further aggregates of column `_v` for the summary.  `limits`
    gives more brackets, as pairs of SQL texts, from `ends(share, "low" or "high")`,
    the ends of a wanted share's own bracket.  `weight` is a whole number of copies
    per row; brackets of weighted rows are found by one more scan.
    """
    few_groups = few_groups or not keys
    accuracy = accuracy or (ACCURACY if few_groups else GROUP_ACCURACY)
    group = list(keys) or ["_all"]
    rows = df.select(*keys, *([] if keys else [F.lit(0).alias("_all")]),
                     F.col(value).cast("double").alias("_v"),
                     (weight if weight is not None else F.lit(1)).cast("long").alias("_w")) \
        .filter(F.col("_v").isNotNull() & ~F.isnan("_v") & (F.col("_w") > 0))
    margin = REACH / accuracy
    near = [REACH * 10 ** k / accuracy for k in range(3)] if weight is not None else [margin]
    shares = sorted({s for p in wanted for d in near for s in (p - d, p + d) if 0 < s < 1}
                    | set(SPREAD if weight is not None else []))
    steps = ", ".join(f"{s!r}D" for s in shares) or "0.5D"
    summary = pinned(rows.groupBy(*group).agg(
        F.count("*").alias("_n"),
        F.expr(f"percentile_approx(_v, array({steps}), {accuracy})").alias("_steps"),
        *statistics), "ranks")

    def ends(p: float, side: str) -> str:
        at = p - margin if side == "low" else p + margin
        if not 0 < at < 1:
            return f"-{INFINITY}" if side == "low" else INFINITY
        return f"_steps[{shares.index(at)}]"

    if weight is None:
        brackets = [(ends(p, "low"), ends(p, "high")) for p in wanted]
        brackets += limits(ends) if limits else []
        cuts = f"array_sort(array({', '.join(e for pair in brackets for e in pair)}))"
        size = 2 * len(brackets)
        # In a small group the bracket of a rank may be narrower than one row.
        inside = " OR ".join([f"_n <= {2 * accuracy}", *[
            f"({low} <= IF(c = 0, -{INFINITY}, _cuts[greatest(c / 2 - 1, 0)]) AND "
            f"IF(c = {2 * size}, {INFINITY}, _cuts[least(c / 2, {size - 1})]) <= {high})"
            for low, high in brackets]]).replace("c / 2", "c DIV 2")
        cells = summary.withColumn("_cuts", F.expr(cuts)).withColumn("_keep", F.expr(
            f"transform(sequence(0, {2 * size}), c -> c % 2 = 1 OR {inside})"))
    else:
        size = len(shares)
        plain = summary.withColumn("_cuts", F.expr("array_sort(_steps)")).withColumn(
            "_keep", F.expr(f"transform(sequence(0, {2 * size}), c -> c % 2 = 1)"))
        starts = _starts(rank_counts(rows, plain, group, size, few_groups), group)
        held = starts.filter(" OR ".join(
            f"{rank} >= _start AND {rank} < _start + _m" for _, _, rank in _ranks(wanted))) \
            .groupBy(*group).agg(F.collect_set("_cell").alias("_cells"))
        cells = plain.join(held, group).withColumn("_keep", F.expr(
            f"transform(sequence(0, {2 * size}), c -> c % 2 = 1 OR array_contains(_cells, c))"))
    counts = pinned(rank_counts(rows, cells, group, size, few_groups), "rank_counts")
    return Ranked(tuple(keys), summary.drop("_steps"), counts)


def rank_counts(rows: DataFrame, cells: DataFrame, group: Sequence[str], size: int,
                few_groups: bool) -> DataFrame:
    """Rows counted by cell; those of kept cells by value.

    `size` cuts make 2 * size + 1 cells: odd ones hold the values equal to a cut,
    even ones those between two cuts.  Everything is combined on the map side.
    """
    marks = cells.select(*group, "_cuts", "_keep")
    # One short row per group.
    met = rows.join(F.broadcast(marks) if few_groups else marks, list(group))
    cell = " + ".join(f"CAST(_v >= _cuts[{i}] AS INT) + CAST(_v > _cuts[{i}] AS INT)"
                      for i in range(size))
    return met.withColumn("_cell", F.expr(cell)) \
        .groupBy(*group, "_cell", F.expr("IF(_keep[_cell], _v, NULL)").alias("_kept")) \
        .agg(F.sum("_w").alias("_c"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))


def _position(p: float) -> str:
    return f"({float(p)!r}D * CAST(_total - 1 AS DOUBLE))"


def _ranks(wanted: Sequence[float]) -> list[tuple[int, int, str]]:
    return [(i, side, f"CAST({'floor' if side == 0 else 'ceil'}({_position(p)}) AS BIGINT)")
            for i, p in enumerate(wanted) for side in (0, 1)]


def _starts(counts: DataFrame, group: Sequence[str]) -> DataFrame:
    """Per cell the values in it, before it, and in all of its group."""
    whole = Window.partitionBy(*group)
    return counts.groupBy(*group, "_cell").agg(F.sum("_c").alias("_m")).select(
        *group, "_cell", "_m", F.sum("_m").over(whole).alias("_total"),
        (F.sum("_m").over(whole.orderBy("_cell")) - F.col("_m")).alias("_start"))


def quantiles(found: Ranked, wanted: Mapping[str, float],
              statistics: Sequence[str] = ()) -> DataFrame:
    """One row per key group with one column per wanted quantile, and summary columns."""
    group = list(found.keys) or ["_all"]
    in_cell = Window.partitionBy(*group, "_cell").orderBy("_kept")
    kept = found.counts.filter("_kept IS NOT NULL").withColumn(
        "_in", F.sum("_c").over(in_cell) - F.col("_c"))
    # SQL texts keep the number of calls into the JVM small.
    covers = {(i, side): f"({rank} >= _start + _in AND {rank} < _start + _in + _c)"
              for i, side, rank in _ranks(list(wanted.values()))}
    placed = kept.join(_starts(found.counts, group), [*group, "_cell"]) \
        .filter(" OR ".join(covers.values())).groupBy(*group).agg(
        F.max("_total").alias("_total"), *[
            F.expr(f"max(CASE WHEN {test} THEN _kept END) AS _q{i}_{side}")
            for (i, side), test in covers.items()])
    miss = "CAST(raise_error('a rank lies outside its bracket') AS DOUBLE)"
    return found.summary.join(placed, group, "left").select(
        *found.keys, *statistics, *[F.expr(
            f"coalesce(_q{i}_0 + (_q{i}_1 - _q{i}_0) * ({_position(p)} - floor({_position(p)})), "
            f"{miss}) AS `{name}`") for i, (name, p) in enumerate(wanted.items())])


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str,
                    wanted: Mapping[str, float], weight: Column | None = None,
                    few_groups: bool = False, accuracy: int | None = None) -> DataFrame:
    """One row per key group with one column per wanted quantile.

    `weight` is a whole number of copies per row.  `few_groups` states that the
    keys take a small fixed number of values (such as the measures); only then are
    the brackets broadcast.
    """
    return quantiles(ranked(df, keys, value, list(wanted.values()), weight, few_groups, accuracy),
                     wanted)
