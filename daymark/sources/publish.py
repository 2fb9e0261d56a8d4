"""Versioned output with a pointer to the last good version.

An attempt is known by its number and a token of its own, and is announced before
anything is written, so two writers never meet in one folder or in one record:
whatever becomes of one of them, the other's version is recorded and found.

A version may be kept by parts, such as years.  It then lists where each part
lies; parts that did not change stay where an earlier version wrote them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER_SCHEMA = ("output_name string, version long, attempt long, status string, "
                  "attempted_at timestamp, error string, token string, parts string")
PARTS_SCHEMA = "part long, folder string"
STARTED, SUCCESS, FAILED = "STARTED", "SUCCESS", "FAILED"


@dataclass(frozen=True)
class Attempt:
    number: int
    token: str
    ok: bool


def _records(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(POINTER_SCHEMA).option("recursiveFileLookup", True) \
        .json(f"{root}/attempts")


def _attempts(spark: SparkSession, root: str) -> DataFrame:
    """Finished attempts."""
    return _records(spark, root).filter(F.col("status") != STARTED)


def _record(spark: SparkSession, root: str, name: str, number: int, token: str, status: str,
            at: datetime, error: str | None = None, parts: str | None = None) -> None:
    """Add one attempt row; rows are only ever added, so readers never see half a change."""
    row = [(name, number if status == SUCCESS else None, number, status, at, error, token, parts)]
    (spark.createDataFrame(row, POINTER_SCHEMA).coalesce(1).write.mode("errorifexists")
     .json(f"{root}/attempts/{number:08d}-{token}-{status.lower()}"))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there; asked through a reader, so any store will do."""
    try:
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).schema
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def _folder(root: str, name: str, number: int, token: str) -> str:
    return f"{root}/versions/{name}/version={number:08d}-{token}"


def _part_list(root: str, name: str, number: int, token: str) -> str:
    return f"{root}/versions/{name}/parts={number:08d}-{token}"


def stored_parts(spark: SparkSession, root: str, name: str) -> dict[int, str] | None:
    """Part -> folder of the last good version, if it is kept by parts."""
    best = _best(spark, root, name)
    if best is None or best["parts"] is None:
        return None
    listed = spark.read.schema(PARTS_SCHEMA).json(_part_list(root, name, best["version"], best["token"]))
    # One short row per part.
    return {r["part"]: r["folder"] for r in listed.collect()}


def _read_parts(spark: SparkSession, folders: Sequence[str], schema) -> DataFrame:
    return spark.read.schema(schema).parquet(*folders) if folders \
        else spark.createDataFrame([], schema)


def try_publish(df: DataFrame, root: str, name: str, checks: Callable[[DataFrame], DataFrame],
                at: datetime, parts: str | None = None,
                replaced: Sequence[int] | None = None) -> Attempt:
    """Write a candidate version, check it, and make it current only when all checks hold.

    `parts` names a whole-number column by which the version is kept.  With
    `replaced`, only these parts are written, and `df` need not hold rows of
    others; the rest of the last good version is taken over where it lies.
    """
    spark = df.sparkSession
    number, token = 1, uuid.uuid4().hex
    if path_exists(spark, f"{root}/attempts"):
        number += _records(spark, root).agg(F.max("attempt")).first()[0]
    _record(spark, root, name, number, token, STARTED, at)
    path = _folder(root, name, number, token)
    error = None
    try:
        if parts is None:
            df.write.mode("errorifexists").option("compression", "snappy").parquet(path)
            candidate = spark.read.parquet(path)
        else:
            candidate = _write_parts(df, root, name, number, token, parts, replaced)
        # A short list of failed checks, one row per rule.
        failed = checks(candidate).filter("NOT ok")
        names = [row[0] for row in failed.select("check").orderBy("check").collect()]
        if names:
            error = "failed checks: " + ", ".join(names)
    except Exception as problem:  # the attempt is recorded, then the caller sees the error
        _record(spark, root, name, number, token, FAILED, at, str(problem))
        raise
    _record(spark, root, name, number, token, FAILED if error else SUCCESS, at, error, parts)
    return Attempt(number, token, error is None)


def _write_parts(df: DataFrame, root: str, name: str, number: int, token: str, parts: str,
                 replaced: Sequence[int] | None) -> DataFrame:
    """Write the new parts and the list of all parts; return the candidate version."""
    spark, path = df.sparkSession, _folder(root, name, number, token)
    kept = (stored_parts(spark, root, name) or {}) if replaced is not None else {}
    rows = df if replaced is None else df.filter(F.col(parts).isin(list(replaced)))
    made: list[int] = []
    if replaced is None or len(replaced):
        rows.hint("rebalance", parts).write.mode("errorifexists").partitionBy(parts) \
            .option("compression", "snappy").parquet(path)
        # One short row per part; only folder names are read.
        made = [r[0] for r in spark.read.schema(df.schema).parquet(path)
                .select(parts).distinct().collect()]
    listed = {p: f for p, f in kept.items() if p not in (replaced or ())}
    listed |= {p: f"{path}/{parts}={p}" for p in made}
    spark.createDataFrame(sorted(listed.items()), PARTS_SCHEMA).coalesce(1).write \
        .mode("errorifexists").json(_part_list(root, name, number, token))
    return _read_parts(spark, [f for _, f in sorted(listed.items())], df.drop(parts).schema)


def publish_validated(df: DataFrame, root: str, name: str,
                      checks: Callable[[DataFrame], DataFrame], at: datetime) -> DataFrame:
    """As try_publish, for a table kept whole; returns the finished attempts so far.

    `checks` maps the written candidate to rows (check, expected, actual, ok).
    A failed attempt is recorded as FAILED and the last good version stays current.
    """
    try_publish(df, root, name, checks, at)
    return _attempts(df.sparkSession, root).filter(F.col("output_name") == name)


def _best(spark: SparkSession, root: str, name: str):
    """The record of the last attempt that passed its checks, if there is one."""
    if not path_exists(spark, f"{root}/attempts"):
        return None
    good = _attempts(spark, root).filter((F.col("output_name") == name) & (F.col("status") == SUCCESS))
    return good.agg(F.max(F.struct("version", "token", "parts")).alias("best")).first()["best"]


def current_or_none(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The last version that passed its checks, if there is one."""
    best = _best(spark, root, name)
    if best is None:
        return None
    if best["parts"] is None:
        return spark.read.parquet(_folder(root, name, best["version"], best["token"]))
    folders = stored_parts(spark, root, name)
    if not folders:
        return None
    return spark.read.parquet(*[f for _, f in sorted(folders.items())])


def current_version(spark: SparkSession, root: str, name: str) -> DataFrame:
    found = current_or_none(spark, root, name)
    if found is None:
        raise ValueError(f"{name} has no published version")
    return found


def reserved(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The reservations so far, one short row per load."""
    folder = f"{root}/reserved/{name}"
    if not path_exists(spark, folder):
        return None
    return spark.read.schema("batch long, last_id long, reserved_at timestamp") \
        .option("recursiveFileLookup", True).json(folder)


def reserve_ids(spark: SparkSession, root: str, name: str, size: int,
                at: datetime) -> tuple[int, int]:
    """Reserve `size` ids; returns the number of the load and the last id used before.

    The reservation is recorded before any row is written: a failed load leaves a
    hole in the numbers, never two rows with one number.  The records are one
    short row per load, so the stored rows need not be read for their highest id.
    """
    batch, last = 0, 0
    known = reserved(spark, root, name)
    if known is not None:
        batch, last = known.agg(F.max("batch"), F.max("last_id")).first()
    row = spark.createDataFrame([(batch + 1, last + size, at)],
                                "batch long, last_id long, reserved_at timestamp")
    row.coalesce(1).write.mode("errorifexists").json(
        f"{root}/reserved/{name}/load={batch + 1:08d}")
    return batch + 1, last
