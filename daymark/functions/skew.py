"""Grouping helpers that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def repeated_keys(df: DataFrame, keys: Sequence[str], count: str = "copies") -> DataFrame:
    """Keys held by more than one row, with the number of rows; nulls are equal."""
    return df.groupBy(*keys).agg(F.count("*").alias(count)).filter(F.col(count) > 1)


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(right[key])
    return condition


def mark_repeated(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Add a flag that is true on every row whose key occurs more than once.

    A window count would bring all copies of a key into one task.  Here the
    counts are combined on the map side, and only repeated keys, one row each,
    meet the rows in a left join.  Where that join has to shuffle, adaptive
    execution splits the rows of a frequent key over several tasks, each with
    the key's one row; the work of a task does not depend on how many keys are
    frequent.
    """
    counts = repeated_keys(df, keys, "_copies")
    named = {k: f"_k{i}" for i, k in enumerate(keys)}
    known = counts.select(*[F.col(k).alias(v) for k, v in named.items()], F.lit(True).alias("_again"))
    same = F.lit(True)
    for key, alias in named.items():
        same = same & df[key].eqNullSafe(known[alias])
    return (df.join(known, same, "left").withColumn(name, F.coalesce("_again", F.lit(False)))
            .drop(*named.values(), "_again"))
