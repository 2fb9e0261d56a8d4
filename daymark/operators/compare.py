"""Equality of tables and of aggregates, and repeat-run checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymark.functions.digest import fingerprint
from daymark.functions.storage import pinned


def _apart(left: Column, right: Column, tolerance: float) -> Column:
    """True when two numbers differ by more than the tolerance, or only one is missing."""
    both_missing = left.isNull() & right.isNull()
    return ~(both_missing | F.coalesce(F.abs(left - right) <= tolerance, F.lit(False)))


def _same_keys(keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"a.{key}").eqNullSafe(F.col(f"b.{key}"))
    return condition


def _signed(left: DataFrame, right: DataFrame) -> DataFrame:
    """The rows of both sides, with the side in `_a` and `_b`."""
    return left.withColumns({"_a": F.lit(1), "_b": F.lit(0)}).unionByName(
        right.withColumns({"_a": F.lit(0), "_b": F.lit(1)}))


def _counted(signed: DataFrame) -> DataFrame:
    """Each distinct row with how often the sides hold it, `_na` and `_nb`."""
    return signed.groupBy(*[c for c in signed.columns if c not in ("_a", "_b")]).agg(
        F.sum("_a").alias("_na"), F.sum("_b").alias("_nb"))


# Buckets of keys whose rows are compared by the sums of their hashes.
BUCKETS = 1 << 14


def _bucket(exact: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(F.lit(0), *exact), F.lit(BUCKETS))


def _bucket_sums(signed: DataFrame, exact: Sequence[str]) -> DataFrame:
    """Per bucket of keys the rows of both sides, and whether the sides hold it alike.

    Alike are buckets with as many rows and the same sums of two 64-bit hashes of
    whole rows; sums keep track of repeated rows.  They are combined on the map
    side, so no row is shuffled.  The halves of the hashes are summed apart and
    stay within a long for two billion rows of a bucket.
    """
    columns = [c for c in signed.columns if c not in ("_a", "_b")]
    side = F.col("_a") - F.col("_b")
    hashes = [F.xxhash64(F.lit(i), *columns) for i in range(2)]
    halves = [half for h in hashes for half in (F.shiftright(h, 32), h.bitwiseAND(F.lit((1 << 32) - 1)))]
    alike = F.sum(side) == 0
    for half in halves:
        alike = alike & (F.sum(side * half) == 0)
    return signed.groupBy(_bucket(exact).alias("_bucket")).agg(
        F.sum("_a").alias("_na"), F.sum("_b").alias("_nb"), alike.alias("_alike"))


def _doubtful(signed: DataFrame, exact: Sequence[str], sums: DataFrame) -> DataFrame:
    """The rows of the buckets that the sides do not hold alike; all rows of a key stay together."""
    open_ = sums.filter(~F.col("_alike")).select("_bucket")
    # At most BUCKETS numbers.
    return signed.withColumn("_bucket", _bucket(exact)).join(F.broadcast(open_), "_bucket", "left_semi") \
        .drop("_bucket")


# Places of a key's sorted rows that are paired in one group at most.
BLOCK = 1 << 18


def _open_rows(counted: DataFrame, exact: Sequence[str]) -> DataFrame:
    """Distinct rows of the keys that the sides hold differently; none when they are alike."""
    open_ = counted.filter(F.col("_na") != F.col("_nb")).select(*exact).distinct()
    rest = counted.alias("a").join(open_.alias("b"), _same_keys(exact), "left_semi")
    return pinned(rest.select(*[F.col(f"a.{c}") for c in counted.columns]), "open_rows")


def _intervals(rest: DataFrame, exact: Sequence[str], numbers: Sequence[str],
               tolerance: float) -> DataFrame:
    """The rows with the places of their copies.

    A row's copies take the places `_a_to - _na` to `_a_to - 1` among the left
    rows of its exact columns, and likewise among the right ones.  Places follow
    the numbers; numbers that follow each other within the tolerance count as one
    for the order of the next number, so a move below it does not decide which
    rows meet.
    """
    # A single number has the order of its groups, and no rows have none.
    for i, c in enumerate(numbers if len(numbers) > 1 and not rest.isEmpty() else []):
        near = Window.partitionBy(*exact).orderBy(c)
        apart = F.coalesce(F.col(c) - F.lag(c).over(near) > tolerance, F.lit(False))
        rest = rest.withColumn(f"_apart{i}", apart.cast("int")) \
            .withColumn(f"_group{i}", F.sum(f"_apart{i}").over(near)).drop(f"_apart{i}")
    groups = [c for c in rest.columns if c.startswith("_group")]
    order = Window.partitionBy(*exact).orderBy(*groups, *numbers, F.lit(1)) \
        .rowsBetween(Window.unboundedPreceding, 0)
    return rest.withColumns({"_a_to": F.sum("_na").over(order), "_b_to": F.sum("_nb").over(order)}) \
        .drop(*groups)


def _paired(counted: DataFrame, exact: Sequence[str], numbers: Sequence[str],
            tolerance: float) -> DataFrame:
    """Rows of both sides side by side, with how often: numbers `a` and `b`, `_times`.

    Groups of equal exact columns that the sides hold alike cancel out; of the
    others, rows at the same place meet, and `a` or `b` is null where a side has
    no row left.  Copies are never told apart: each distinct row is an interval of
    places, and a sweep over the ends of both sides' intervals, cut into blocks of
    BLOCK places, gives the runs of places at which the same two rows meet.
    """
    rest = _intervals(_open_rows(counted, exact), exact, numbers, tolerance)
    held = F.struct(F.lit(True).alias("held"), *numbers)
    none = F.struct(F.lit(False).alias("held"), *[F.lit(None).cast(dict(rest.dtypes)[c]).alias(c)
                                                  for c in numbers])

    def ends(count: str, to: str, side: str) -> DataFrame:
        """Where the side's rows start and end, per block."""
        first, last = F.col(to) - F.col(count), F.col(to)
        block = F.explode(F.sequence(F.floor(first / BLOCK), F.floor((last - 1) / BLOCK)))
        cut = rest.filter(F.col(count) > 0).select(
            *exact, held.alias("_row"), first.alias("_from"), last.alias("_to"),
            block.alias("_block"))
        start = F.greatest("_from", F.col("_block") * BLOCK)
        stop = F.least("_to", (F.col("_block") + 1) * BLOCK)
        other = "b" if side == "a" else "a"
        return cut.select(*exact, "_block", F.inline(F.array(
            F.struct(start.alias("_at"), F.lit(1).alias("_starts"), F.col("_row").alias(side)),
            F.struct(stop.alias("_at"), F.lit(0).alias("_starts"), none.alias(side))))) \
            .withColumn(other, F.lit(None).cast(none_type))

    none_type = rest.select(none.alias("none")).schema["none"].dataType
    both = ends("_na", "_a_to", "a").unionByName(ends("_nb", "_b_to", "b"))
    sweep = Window.partitionBy(*exact, "_block").orderBy("_at", "_starts")
    running = sweep.rowsBetween(Window.unboundedPreceding, 0)
    end = F.least(F.lead("_at").over(sweep), (F.col("_block") + 1) * BLOCK)
    met = both.select(*exact, (end - F.col("_at")).alias("_times"),
                      F.last("a", ignorenulls=True).over(running).alias("a"),
                      F.last("b", ignorenulls=True).over(running).alias("b")).filter("_times > 0")
    return met.withColumns({side: F.when(F.col(f"{side}.held"), F.col(side)) for side in "ab"}) \
        .filter("a IS NOT NULL OR b IS NOT NULL")


def _times(condition: Column) -> Column:
    """Number of pairs for which the condition holds."""
    return F.coalesce(F.sum(F.when(condition, F.col("_times"))), F.lit(0))


def tolerant_compare_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                          value: str, tolerance: float = 1e-9) -> DataFrame:
    """One row: are the key sets equal, and how far apart are the values at most.

    A key may occur several times: its values are compared position by position
    in sorted order, and different numbers of them are a mismatch of counts.
    """
    counted = _counted(_signed(left.select(*keys, value), right.select(*keys, value)))
    by_key = counted.groupBy(*keys).agg(F.sum("_na").alias("_na"), F.sum("_nb").alias("_nb")).agg(
        F.count_if(F.col("_na") > 0).alias("left_keys"),
        F.count_if(F.col("_nb") > 0).alias("right_keys"),
        F.count_if((F.col("_na") == 0) | (F.col("_nb") == 0)).alias("unmatched_keys"),
        F.count_if((F.col("_na") > 0) & (F.col("_nb") > 0) & (F.col("_na") != F.col("_nb")))
        .alias("count_mismatches"))
    same = counted.agg(F.max(F.when((F.col("_na") > 0) & (F.col("_nb") > 0)
                                    & F.col(value).isNotNull(), 0.0)).alias("_none"))
    x, y = F.col(f"a.{value}"), F.col(f"b.{value}")
    met = F.col("a").isNotNull() & F.col("b").isNotNull()
    apart = _paired(counted, keys, [value], tolerance).agg(
        F.max(F.abs(x - y)).alias("_gap"),
        _times(met & _apart(x, y, tolerance)).alias("value_mismatches"))
    clean = F.lit(True)
    for part in ("unmatched_keys", "count_mismatches", "value_mismatches"):
        clean = clean & (F.col(part) == 0)
    return by_key.crossJoin(same).crossJoin(apart).select(
        "left_keys", "right_keys", "unmatched_keys", "count_mismatches",
        F.greatest("_gap", "_none").alias("max_abs_difference"), "value_mismatches",
        clean.alias("equal"))


def tables_equal(left: DataFrame, right: DataFrame, keys: Sequence[str],
                 tolerance: float = 1e-12) -> DataFrame:
    """One row: same columns, row count and rows, numbers within the tolerance.

    Rows with the same key and the same other exact columns are paired up in the
    order of their numbers; see `_paired`.  Only rows of buckets of keys that the
    sides hold differently are shuffled; see `_bucket_sums`.
    """
    same_columns = left.columns == right.columns
    if not same_columns:
        return left.agg(F.count("*").alias("left_rows")).crossJoin(
            right.agg(F.count("*").alias("right_rows"))).select(
            F.lit(False).alias("same_columns"), "left_rows", "right_rows",
            F.lit(None).cast("long").alias("differing_rows"), F.lit(False).alias("equal"))
    kinds = dict(left.dtypes)
    numbers = [c for c in left.columns if c not in keys and kinds[c] in ("double", "float")]
    exact = [c for c in left.columns if c not in numbers]
    differs = F.col("a").isNull() | F.col("b").isNull()
    for c in numbers:
        differs = differs | _apart(F.col(f"a.{c}"), F.col(f"b.{c}"), tolerance)
    signed = _signed(left, right)
    sums = pinned(_bucket_sums(signed, exact), "bucket_sums")
    counts = sums.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(n)
                        for c, n in (("_na", "left_rows"), ("_nb", "right_rows"))])
    bad = _paired(_counted(_doubtful(signed, exact, sums)), exact, numbers, tolerance).agg(
        _times(differs).alias("differing_rows"))
    return counts.crossJoin(bad).select(
        F.lit(True).alias("same_columns"), "left_rows", "right_rows", "differing_rows",
        ((F.col("left_rows") == F.col("right_rows")) & (F.col("differing_rows") == 0))
        .alias("equal"))


def aggregates_equal(left: DataFrame, right: DataFrame, keys: Sequence[str], value: str,
                     tolerance: float = 1e-9) -> DataFrame:
    """Same groups with values within the tolerance."""
    return tolerant_compare_join(left, right, keys, value, tolerance)


def idempotent_runs(first: DataFrame, second: DataFrame, first_counts: DataFrame,
                    second_counts: DataFrame) -> DataFrame:
    """Two runs over the same input: same content, same rows, nothing rejected."""
    a = fingerprint(first).select(F.col("rows").alias("rows_first"),
                                  F.col("digest").alias("_a"))
    b = fingerprint(second).select(F.col("rows").alias("rows_second"),
                                   F.col("digest").alias("_b"))
    rejected = first_counts.select(F.col("rows_rejected").alias("rejected_first")).crossJoin(
        second_counts.select(F.col("rows_rejected").alias("rejected_second")))
    same = F.col("_a") == F.col("_b")
    clean = (F.col("rejected_first") == 0) & (F.col("rejected_second") == 0)
    return a.crossJoin(b).crossJoin(rejected).select(
        "rows_first", "rows_second", "rejected_first", "rejected_second",
        same.alias("same_content"),
        F.when(same & clean, "PASS").otherwise("FAIL").alias("status"))


def fingerprints(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, rows, digest) of several tables."""
    parts = [fingerprint(df).select(F.lit(name).alias("table_name"), "rows", "digest")
             for name, df in tables.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def preserved_tables(before: DataFrame, after: DataFrame) -> DataFrame:
    """Per table: whether it is unchanged, changed, added or removed between two states."""
    a = before.select("table_name", F.col("digest").alias("_a"))
    b = after.select("table_name", F.col("digest").alias("_b"))
    state = (F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed")
             .when(F.col("_a") == F.col("_b"), "unchanged").otherwise("changed"))
    return a.join(b, "table_name", "full_outer").select("table_name", state.alias("state"))
