"""Turning one-row aggregates into (name, value) tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_row_table(one: DataFrame, name: str, value: str, columns: Sequence[str],
                  kind: str = "long") -> DataFrame:
    """Turn columns of a one-row table into (name, value) rows."""
    entries = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast(kind).alias(value))
                        for c in columns])
    return one.select(F.inline(entries))


def check_rows(one: DataFrame, checks: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(check, expected, actual, ok) rows from a one-row table of counts.

    Each entry names a check, the SQL text of the expected value and that of the
    actual one.
    """
    entries = F.array(*[
        F.struct(F.lit(label).alias("check"), F.expr(expected).cast("long").alias("expected"),
                 F.expr(actual).cast("long").alias("actual"),
                 F.expr(f"({expected}) <=> ({actual})").alias("ok"))
        for label, expected, actual in checks])
    return one.select(F.inline(entries))
