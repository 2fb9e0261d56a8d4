"""Wide daily tables as CSV and Parquet."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.functions.columns import nan_to_null
from daymark.schema import WIDE, Layout

# The column by which published tables are kept in folders.
YEAR = "year"

# Cell texts that the reader of raw rows takes as missing.
MISSING_TEXT = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                "nan", "null")


def read_wide_csv(spark: SparkSession, path: str | Sequence[str],
                  layout: Layout = WIDE) -> DataFrame:
    """Typed scan of CSV with a header; a cell that does not fit its type fails the read."""
    df = (spark.read.schema(layout.wide_schema())
          .option("header", True).option("mode", "FAILFAST")
          .option("dateFormat", "yyyy-MM-dd").option("enforceSchema", False)
          .csv(path))
    return nan_to_null(df, layout.numeric)


def read_raw_csv(spark: SparkSession, path: str | Sequence[str], layout: Layout = WIDE,
                 row_number: str | None = None) -> DataFrame:
    """All cells as text, for the quarantine; empty and not-available texts become null."""
    schema = layout.raw_schema()
    if row_number:
        schema = T.StructType([T.StructField(row_number, T.LongType()), *schema.fields])
    df = spark.read.schema(schema).option("header", True).csv(path)
    return df.select([
        F.when(~F.col(c).isin(*MISSING_TEXT), F.col(c)).alias(c) if c in layout.required
        else F.col(c) for c in df.columns])


def read_wide_parquet(spark: SparkSession, path: str | Sequence[str],
                      columns: Sequence[str] | None = None,
                      predicates: Iterable[Column] = (), layout: Layout = WIDE) -> DataFrame:
    """Parquet scan; the columns and predicates reach the scan through Catalyst."""
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.parquet(*paths)
    for predicate in predicates:
        df = df.filter(predicate)
    df = df.select(*(columns or df.columns))
    return nan_to_null(df, [c for c in layout.numeric if c in df.columns])


def write_wide_csv(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").option("header", True).csv(path)


def write_wide_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("errorifexists").option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def csv_to_parquet(spark: SparkSession, csv_path: str, parquet_path: str,
                   layout: Layout = WIDE) -> DataFrame:
    """Rewrite a CSV table as snappy Parquet and return the Parquet scan."""
    write_wide_parquet(read_wide_csv(spark, csv_path, layout), parquet_path)
    return read_wide_parquet(spark, parquet_path, layout=layout)


def assemble_points(frames: Sequence[DataFrame]) -> DataFrame:
    """All point tables as one; a column missing in one of them is null there."""
    first, *rest = frames
    for frame in rest:
        first = first.unionByName(frame, allowMissingColumns=True)
    return first


def publish_sorted_wide(df: DataFrame, path: str, layout: Layout = WIDE,
                        file_format: str = "parquet", ranges: int | None = None) -> DataFrame:
    """Write the table by year in (location, date) order and return a scan of it.

    Rows are dealt over files by ranges of year and location and sorted within
    them, so the smallest and largest values that Parquet keeps of files, row
    groups and pages let a scan of few locations or days skip the rest.  There is
    no order over all files; "csv" writes one, in a single sorted table.  `ranges`
    is the number of tasks that write, by default one per shuffle partition of
    the session's advised size.

    The path must be new: Spark's committer makes the files visible only once
    all tasks have succeeded, so a failed run leaves nothing readable behind.
    """
    rows = df.select(*layout.required)
    if file_format == "csv":
        write_wide_csv(rows.orderBy(layout.location, layout.date), path)
        return read_wide_csv(df.sparkSession, path, layout)
    order = [YEAR, layout.location, layout.date]
    ranged = rows.withColumn(YEAR, F.year(layout.date)) \
        .repartitionByRange(*([ranges] if ranges else []), *order).sortWithinPartitions(*order)
    write_wide_parquet(ranged, path, [YEAR])
    return read_published_wide(df.sparkSession, path, layout)


def read_published_wide(spark: SparkSession, path: str, layout: Layout = WIDE,
                        days: tuple[str, str] | None = None) -> DataFrame:
    """The published table, or its rows from the first to the last day of `days`.

    Only the folders of these years are opened; other filters reach the scan.
    """
    predicates = []
    if days:
        predicates = [F.col(YEAR).between(int(days[0][:4]), int(days[1][:4])),
                      F.col(layout.date).between(*[F.lit(d).cast("date") for d in days])]
    return read_wide_parquet(spark, path, layout.required, predicates, layout)
