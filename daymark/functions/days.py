"""Days of a year as bits of a few numbers: exact, small, and combined by `or`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 31 places for each month, 64 in a number.
WORDS = 6


def place(month: str, day: str) -> str:
    """SQL text of a day's place."""
    return f"(({month} - 1) * 31 + {day} - 1)"


def bits(at: str, prefix: str, condition: str = "true") -> list[Column]:
    """Aggregates that hold the places `at` of the rows for which the condition is true."""
    return [F.expr(f"bit_or(IF({condition} AND {at} DIV 64 = {i}, "
                   f"shiftleft(1L, CAST({at} % 64 AS INT)), 0L))").alias(f"{prefix}{i}")
            for i in range(WORDS)]


def is_set(at: str, prefix: str) -> str:
    """SQL text: whether a place is among the bits."""
    word = " ".join(f"WHEN {i} THEN {prefix}{i}" for i in range(WORDS))
    return f"(getbit(CASE {at} DIV 64 {word} END, CAST({at} % 64 AS INT)) = 1)"


def count(text: str) -> str:
    """SQL text: the number of places; `text` names a word as {i}."""
    return "(" + " + ".join(f"bit_count({text.format(i=i)})" for i in range(WORDS)) + ")"
