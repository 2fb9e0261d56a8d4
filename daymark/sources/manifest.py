"""Request ids, the ingestion manifest and checks of raw files."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.operators.checks import one_row_table
from daymark.functions.skew import repeated_keys
from daymark.schema import DEFAULT_SOURCE, WIDE, Layout, code_of


def _json_text(column: Column) -> Column:
    """JSON string with everything outside ASCII written as escapes."""
    plain = F.regexp_replace(column, r'(["\\])', r"\\$1")
    letters = F.transform(
        F.split(plain, ""),
        lambda c: F.when(F.ascii(c) < 128, c).otherwise(F.regexp_replace(
            F.lower(F.hex(F.encode(c, "UTF-16BE"))), "(.{4})", r"\\u$1")))
    return F.concat(F.lit('"'), F.array_join(letters, ""), F.lit('"'))


def _json_number(column: Column) -> Column:
    """Shortest text of a double, with an exponent only below 0.0001."""
    plain = column.cast("string")
    size = F.abs(column)
    decimal = F.regexp_replace(column.cast("decimal(30,22)").cast("string"), "0+$", "")
    power = F.regexp_replace(F.regexp_replace(plain, r"\.0E-", "E-"), r"E-(\d)$", "E-0$1")
    return (F.when((column == 0) | (size >= 0.001), plain)
            .when(size >= 0.0001, decimal).otherwise(F.lower(power)))


def request_id(requests: DataFrame, source: str = DEFAULT_SOURCE,
               name: str = "request_id") -> DataFrame:
    """Add the 16-digit id: a hash of the request as JSON with sorted keys.

    Needs location, latitude, longitude, start_date, end_date and parameters.
    Separators are ", " and ": ", and numbers have their shortest text.
    """
    listed = F.concat(F.lit("["), F.array_join(
        F.transform(F.sort_array("parameters"), _json_text), ", "), F.lit("]"))
    text = F.concat(
        F.lit('{"end": '), _json_text(F.col("end_date")),
        F.lit(', "latitude": '), _json_number(F.col("latitude")),
        F.lit(', "location": '), _json_text(F.col("location")),
        F.lit(', "longitude": '), _json_number(F.col("longitude")),
        F.lit(', "parameters": '), listed,
        F.lit(', "source": '), _json_text(F.lit(source)),
        F.lit(', "start": '), _json_text(F.col("start_date")), F.lit("}"))
    return requests.withColumn(name, F.substring(F.sha2(text, 256), 1, 16))


# Files up to this size are read by Spark in one piece; larger ones in chunks.
WHOLE_BYTES, CHUNK_BYTES = 32 << 20, 4 << 20


def open_file(path: str):
    """A stream over a file, by its address; local files may lack one."""
    from pyarrow import fs
    plain = path[5:] if path.startswith("file:/") and not path.startswith("file://") else path
    store, inner = fs.FileSystem.from_uri(plain) if "://" in plain else (fs.LocalFileSystem(), plain)
    return store.open_input_stream(inner)


def _chunked_digests(files: DataFrame, opener: Callable) -> DataFrame:
    """SHA-256 of each file (path, length), read chunk by chunk where a task works on it."""
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for path in batch.column("path").to_pylist():
                running = hashlib.sha256()
                with opener(path) as stream:
                    while chunk := stream.read(CHUNK_BYTES):
                        running.update(chunk)
                made.append(running.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("path"), pa.array(made), batch.column("length")],
                names=["path", "actual_sha256", "length"])

    return files.mapInArrow(digest, "path string, actual_sha256 string, length long")


def file_digests(spark: SparkSession, path: str | Sequence[str],
                 opener: Callable = open_file) -> DataFrame:
    """(raw_file, actual_sha256, bytes) of every file under the path.

    Files of more than WHOLE_BYTES are never held whole: they are dealt out by
    name, and tasks read them in chunks through `opener`, which maps an address to
    a readable stream and has to suit the store.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    # Only names and lengths are read of the files that a filter on the length leaves out.
    small = files.filter(F.col("length") <= WHOLE_BYTES).select(
        "path", F.sha2("content", 256).alias("actual_sha256"), "length")
    large = files.filter(F.col("length") > WHOLE_BYTES).select("path", "length").repartition("path")
    return small.unionByName(_chunked_digests(large, opener)).select(
        F.regexp_replace("path", "^file:/+", "/").alias("raw_file"), "actual_sha256",
        F.col("length").alias("bytes"))


def raw_file_integrity(manifest: DataFrame, digests: DataFrame) -> DataFrame:
    """Status of every file the manifest names: ok, mismatch or missing."""
    named = manifest.select("raw_file", F.col("sha256").alias("expected_sha256"))
    status = (F.when(F.col("actual_sha256").isNull(), "missing")
              .when(F.col("expected_sha256").isNotNull()
                    & (F.col("expected_sha256") != F.col("actual_sha256")), "mismatch")
              .otherwise("ok"))
    return named.join(digests, "raw_file", "left").select(
        "raw_file", "expected_sha256", "actual_sha256", status.alias("status"))


def ingest_plan(requests: DataFrame, manifest: DataFrame, digests: DataFrame,
                offline: bool = False) -> DataFrame:
    """What to do per requested point: reuse the cached file, fetch it, or stop.

    cached    the manifest has a successful entry and its file is intact
    corrupt   the file is there but its hash differs from the manifest
    refetch   the manifest entry has no file any more
    new       no successful manifest entry
    offline_missing replaces refetch and new when no download is allowed
    """
    entries = (manifest.filter(F.col("status") == "success")
               .select("request_id", "raw_file", "sha256"))
    present = digests.select("raw_file", "actual_sha256")
    known = (requests.join(entries, "request_id", "left")
             .join(present, "raw_file", "left"))
    state = (F.when(F.col("raw_file").isNull(), "new")
             .when(F.col("actual_sha256").isNull(), "refetch")
             .when(F.col("sha256").isNotNull()
                   & (F.col("sha256") != F.col("actual_sha256")), "corrupt")
             .otherwise("cached"))
    action = F.when(state.isin("new", "refetch"), "offline_missing").otherwise(state) \
        if offline else state
    return known.select("request_id", *[c for c in requests.columns if c != "request_id"],
                        "raw_file", action.alias("action"))


def latest_by(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key.

    The row travels as one struct through `max_by`, which combines on the map
    side, so a key with many versions never gathers in one task.
    """
    others = [c for c in df.columns if c not in key]
    newest = df.groupBy(*key).agg(
        F.max_by(F.struct(*others), F.struct(*order)).alias("_row"))
    return newest.select(*key, *[F.col(f"_row.{c}").alias(c) for c in others]) \
        .select(*df.columns)


def manifest_upsert(old: DataFrame, new: DataFrame, key: str = "request_id",
                    verified_at: str = "last_verified_at") -> DataFrame:
    """Both sets of entries, the newest per request; on equal times the new one wins."""
    merged = (old.withColumn("_batch", F.lit(0))
              .unionByName(new.withColumn("_batch", F.lit(1))))
    return latest_by(merged, [key], [verified_at, "_batch"]).drop("_batch")


def interim_gate(df: DataFrame, layout: Layout = WIDE) -> DataFrame:
    """(check, violations) for required columns, emptiness and repeated keys."""
    absent = [c for c in layout.required if c not in df.columns]
    key = [c for c in (layout.location, layout.date) if c in df.columns]
    rows = df.agg((F.count("*") == 0).cast("long").alias("empty_table"))
    if len(key) == 2:
        repeats = repeated_keys(df, key).agg(
            F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("repeated_location_date"))
    else:
        repeats = rows.select(F.lit(None).cast("long").alias("repeated_location_date"))
    one = rows.crossJoin(repeats).withColumn(
        "missing_required_columns", F.lit(len(absent)).cast("long"))
    return one_row_table(one, "check", "violations",
                         ["missing_required_columns", "empty_table", "repeated_location_date"])


def ingest_run_summary(wide: DataFrame, accounting: DataFrame,
                       layout: Layout = WIDE) -> DataFrame:
    """One row for a run: size and span of the accepted table, row accounting, repeated keys."""
    facts = wide.agg(F.count("*").alias("rows"),
                     F.count_distinct(layout.location).alias("locations"),
                     F.min(layout.date).alias("start_date"),
                     F.max(layout.date).alias("end_date"))
    repeats = repeated_keys(wide, [layout.location, layout.date, layout.source]).agg(
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_keys"))
    return facts.crossJoin(accounting).crossJoin(repeats)
