"""Column expressions for null, NaN, range and date handling."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def nan_to_null(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """NaN counts as missing everywhere downstream, so drop it at the source."""
    wanted = set(columns)
    return df.select([
        F.when(~F.isnan(c), F.col(c)).alias(c) if c in wanted else F.col(c)
        for c in df.columns])


def outside(column: Column, low: float, high: float) -> Column:
    """True when the value is missing or not within the closed range."""
    return F.coalesce(~column.between(low, high), F.lit(True))


def holds(condition: Column) -> Column:
    """The condition with an unknown outcome read as false."""
    return F.coalesce(condition, F.lit(False))


def text_to_date(column: Column) -> Column:
    return F.to_date(F.try_to_timestamp(column, F.lit("yyyy-MM-dd")))


def text_to_number(column: Column) -> Column:
    """Double from raw text; text for "not a number" gives null.

    A cast also takes type suffixes and hexadecimal text, such as '5d', '5f' and
    '0x1p3', which are no numbers in raw data.
    """
    suffixed = ((column.endswith("f") & ~column.endswith("nf"))
                | (column.endswith("F") & ~column.endswith("NF")))
    for letter in "dDxX":
        suffixed = suffixed | column.contains(letter)
    number = F.when(~suffixed, column.try_cast("double"))
    return F.nanvl(number, F.lit(None).cast("double"))


def not_finite(column: Column) -> Column:
    """True for missing, not-a-number and infinite values."""
    return column.isNull() | F.isnan(column) | (F.abs(column) == float("inf"))


def snap_doubles(df: DataFrame, columns: Iterable[str], parts: int = 1 << 20) -> DataFrame:
    """The named doubles rounded to a binary grid of about six decimal places.

    Sums of doubles depend on their order in the last digits.  Readings have few
    decimal places, so their means often lie exactly halfway between two points
    of a decimal grid, where those digits would decide; on a binary grid they
    do not.
    """
    wanted = set(columns)
    return df.select([
        (F.round(F.col(name) * F.lit(float(parts))) / F.lit(float(parts))).alias(name)
        if name in wanted else F.col(name) for name in df.columns]) if wanted else df


def year_of(column: str) -> Column:
    return F.year(column).alias("year")


def month_of(column: str) -> Column:
    return F.month(column).alias("month")
