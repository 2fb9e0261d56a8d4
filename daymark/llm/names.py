"""Keeping a caller's columns apart from an operator's own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW = "caller_row"


def others(df: DataFrame, made: Sequence[str]) -> list[str]:
    """Columns that no result replaces; names differ without regard to case."""
    lowered = {m.lower() for m in made}
    return [c for c in df.columns if c.lower() not in lowered]


def packed(df: DataFrame, made: Sequence[str]) -> Column:
    """The caller's other columns as one struct, so that none can clash on the way."""
    return F.struct(*[F.col(f"`{c}`") for c in others(df, made)]).alias(ROW)
