"""Hard row rules: every raw row is either accepted or rejected with its reasons.

Unusual but possible values are never rejected here.  The rules read text, so a
broken cell rejects its row and not the run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.functions.columns import holds, not_finite, outside, text_to_date, text_to_number
from daymark.functions.skew import mark_repeated
from daymark.functions.storage import pinned
from daymark.schema import WIDE, Layout, code_of

REPEATED = "_repeated"


def _label(field: str, layout: Layout) -> str:
    return code_of(field) if field in layout.measures else field


def _typed(field: str) -> Column:
    return F.col(f"_typed.{field}")


def _rules(layout: Layout) -> list[tuple[str, Column]]:
    """(code, condition) in the order in which a row lists its codes."""
    missing = F.lit(False)
    for field in layout.required:
        missing = missing | F.col(field).isNull()
    rules = [("INVALID_DATE", _typed(layout.date).isNull()), ("MISSING_REQUIRED", missing)]
    rules += [(f"EMPTY_{field.upper()}", holds(F.trim(F.col(field)) == ""))
              for field in layout.series]
    for field in layout.numeric:
        label = _label(field, layout)
        rules.append((f"INVALID_NUMERIC_{label}", not_finite(_typed(field))))
        if field in layout.measures:
            rules.append((f"PROVIDER_FILL_{label}", holds(_typed(field) == layout.fill_value)))
    rules += [
        ("LATITUDE_RANGE", outside(_typed(layout.latitude), -90, 90)),
        ("LONGITUDE_RANGE", outside(_typed(layout.longitude), -180, 180)),
        ("HUMIDITY_RANGE", outside(_typed(layout.humidity), 0, 100))]
    rules += [(f"NEGATIVE_{_label(field, layout)}", holds(_typed(field) < 0))
              for field in layout.non_negative]
    low, mean, high = (_typed(f) for f in (
        layout.min_temperature, layout.mean_temperature, layout.max_temperature))
    rules += [
        ("TEMPERATURE_ORDER", holds((low > mean) | (mean > high))),
        ("UNSUPPORTED_SOURCE", ~F.col(layout.source).eqNullSafe(layout.expected_source)),
        ("DUPLICATE_KEY", F.col(REPEATED))]
    return rules


def reason_codes(layout: Layout = WIDE) -> list[str]:
    """All codes, in rule order."""
    return [code for code, _ in _rules(layout)]


def quarantine_codes(raw: DataFrame, layout: Layout = WIDE) -> DataFrame:
    """Raw rows plus `_typed` (parsed values) and `reason_codes` (codes in rule order, with bars).

    Every copy of a repeated key is marked: keeping one of them would hide that
    they may contradict each other.
    """
    typed = F.struct(
        text_to_date(F.col(layout.date)).alias(layout.date),
        *[text_to_number(F.col(f)).alias(f) for f in layout.numeric])
    parsed = raw.withColumn("_typed", typed).withColumn("_day", _typed(layout.date))
    marked = mark_repeated(parsed, [layout.location, "_day", layout.source], REPEATED)
    # Joined text skips the codes that do not apply and stays in generated code.
    joined = F.concat_ws("|", *[F.when(condition, F.lit(code))
                                for code, condition in _rules(layout)])
    return marked.withColumn("reason_codes", joined).drop("_day", REPEATED)


def reasons() -> Column:
    """The codes of a coded row as an ordered list; empty when there are none."""
    codes = F.col("reason_codes")
    return F.when(codes != "", F.split(codes, "\\|")).otherwise(
        F.array().cast("array<string>"))


def accepted_rows(coded: DataFrame, layout: Layout = WIDE) -> DataFrame:
    """Rows without any code, in the types of the wide table."""
    return coded.filter(F.col("reason_codes") == "").select(
        _typed(layout.date).alias(layout.date), layout.location,
        _typed(layout.latitude).alias(layout.latitude),
        _typed(layout.longitude).alias(layout.longitude), layout.source,
        *[_typed(m).alias(m) for m in layout.measures])


def rejected_rows(coded: DataFrame, row_number: str, layout: Layout = WIDE) -> DataFrame:
    """Rejected rows as they came, with their input row number and joined codes."""
    return coded.filter(F.col("reason_codes") != "").select(
        F.col(row_number).cast("long").alias("input_row_number"), *layout.required,
        "reason_codes")


def code_sets(coded: DataFrame) -> DataFrame:
    """Rows per set of codes: a short table from which all counts follow."""
    return coded.groupBy("reason_codes").agg(F.count("*").alias("n"))


def reason_counts(coded: DataFrame) -> DataFrame:
    """Rows per code; a row counts once under each of its codes."""
    return _by_code(code_sets(coded)).orderBy("code")


def _by_code(sets: DataFrame) -> DataFrame:
    return (sets.select(F.explode(reasons()).alias("code"), "n").groupBy("code")
            .agg(F.sum("n").alias("rows")))


def accounting(coded: DataFrame) -> DataFrame:
    """One row: read = loaded + rejected."""
    return _totals(code_sets(coded))


def _totals(sets: DataFrame) -> DataFrame:
    def total(condition: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).alias(name)

    rejected = F.col("reason_codes") != ""
    return sets.agg(total(F.lit(True), "rows_read"), total(~rejected, "rows_loaded"),
                    total(rejected, "rows_rejected"))


def quality_gate(counts: DataFrame, overall: DataFrame | None = None) -> DataFrame:
    """One-row verdict.  Any rejected row fails the run before the rule checks count."""
    blocked = F.col("rows_rejected") > 0
    if overall is None:
        status = F.when(blocked, "FAIL").otherwise("PASS")
        verdict = counts
    else:
        verdict = counts.crossJoin(overall.select(F.col("overall_status").alias("_rules")))
        status = F.when(blocked, "FAIL").otherwise(F.col("_rules"))
    reason = F.when(blocked, F.lit("rows were rejected; downstream refresh is blocked"))
    return verdict.select("rows_read", "rows_loaded", "rows_rejected",
                          status.alias("overall_status"), reason.alias("reason"))


def quarantine_write(coded: DataFrame, path: str, row_number: str,
                     layout: Layout = WIDE) -> DataFrame:
    """Write rejected rows (CSV) and row accounting (JSON); return a check of both.

    The coded rows are pinned, so the rules and the search for repeated keys run once.
    """
    coded = pinned(coded, "coded")
    rejected_path, accounting_path = f"{path}/rejected_rows", f"{path}/row_accounting"
    rejected_rows(coded, row_number, layout).write.mode("errorifexists") \
        .option("header", True).csv(rejected_path)
    sets = code_sets(coded)
    totals = _totals(sets)
    # One entry per code, a fixed short list.
    by_code = _by_code(sets).agg(F.map_from_entries(F.array_sort(F.collect_list(
        F.struct("code", "rows")))).alias("rejection_reason_counts"))
    totals.crossJoin(by_code).write.mode("errorifexists").json(accounting_path)
    spark = coded.sparkSession
    written = spark.read.option("header", True).option("inferSchema", False).csv(rejected_path)
    recorded = spark.read.schema(
        "rows_read long, rows_loaded long, rows_rejected long, "
        "rejection_reason_counts map<string,long>").json(accounting_path)
    return written.agg(F.count("*").alias("rejected_rows_written")).crossJoin(recorded).select(
        "rejected_rows_written", "rows_read", "rows_loaded", "rows_rejected",
        (F.col("rejected_rows_written") == F.col("rows_rejected")).alias("ok"))
