"""Star schema: dimensions, incremental facts, the observation view and its audits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daymark.functions import days as day_bits
from daymark.functions.ids import block_offsets, calendar_ids, in_blocks, range_ids
from daymark.functions.skew import repeated_keys
from daymark.functions.storage import pinned
from daymark.operators.checks import check_rows
from daymark.operators.quality import beyond, iqr_bounds, long_values
from daymark.schema import (DEFAULT_COUNTRY, SOURCE_METADATA, VARIABLE_METADATA, WIDE, Layout, code_of)

FACT_KEY = ("date_id", "location_id", "variable_id", "source_id")


def _date_id(day):
    return F.date_format(day, "yyyyMMdd").cast("int")


def dim_location(wide: DataFrame, layout: Layout = WIDE, country: str = DEFAULT_COUNTRY,
                 existing: DataFrame | None = None) -> DataFrame:
    """Distinct points numbered by name.  With `existing`, its rows stay and new names follow.

    A name with several coordinates keeps the first of them, so that a name
    leads to one row; the numbers of the others stay unused.
    """
    points = (wide.select(F.col(layout.location).alias("location_name"),
                          F.col(layout.latitude).alias("latitude"),
                          F.col(layout.longitude).alias("longitude")).distinct())
    order = ["location_name", "latitude", "longitude"]
    if existing is not None:
        points = points.join(existing.select("location_name"), "location_name", "left_anti")
    numbered = range_ids(points, order, "_rank")
    if existing is None:
        key = F.col("_rank")
    else:
        top = existing.agg(F.coalesce(F.max("location_id"), F.lit(0)).alias("_top"))
        numbered = numbered.crossJoin(F.broadcast(top))
        key = F.col("_rank") + F.col("_top")
    first = (numbered.groupBy("location_name")
             .agg(F.min(F.struct(key.cast("int").alias("location_id"), "latitude", "longitude"))
                  .alias("_first")))
    fresh = first.select("_first.location_id", "location_name", "_first.latitude",
                         "_first.longitude", F.lit(country).alias("country"))
    return fresh if existing is None else existing.unionByName(fresh)


def dim_date(wide: DataFrame, layout: Layout = WIDE) -> DataFrame:
    """Distinct days with their calendar fields."""
    day = F.col("full_date")
    year = F.year(day)
    leap = ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)
    return (wide.select(F.col(layout.date).alias("full_date")).filter(day.isNotNull()).distinct()
            .select(_date_id(day).alias("date_id"), "full_date", year.alias("year"),
                    F.quarter(day).alias("quarter"), F.month(day).alias("month"),
                    F.date_format(day, "MMMM").alias("month_name"),
                    F.dayofmonth(day).alias("day"), F.dayofyear(day).alias("day_of_year"),
                    leap.alias("is_leap_year")))


def _metadata(spark: SparkSession, rows: Sequence[tuple], names: str) -> DataFrame:
    """A fixed list as a table: literals in the plan, no data read."""
    fields = names.split()
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(fields, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def variable_catalog(spark: SparkSession) -> DataFrame:
    numbered = [(i, *row) for i, row in enumerate(VARIABLE_METADATA, start=1)]
    return _metadata(spark, numbered,
                     "variable_id variable_code variable_name unit description")


def dim_variable(long: DataFrame) -> DataFrame:
    """Known variables that occur in the long rows, with ids in catalogue order."""
    codes = long.select("variable_code").distinct()
    # The catalogue is a fixed list.
    return codes.join(F.broadcast(variable_catalog(long.sparkSession)), "variable_code") \
        .select("variable_id", "variable_code", "variable_name", "unit", "description")


def unknown_variables(long: DataFrame) -> DataFrame:
    """Codes without an entry in the catalogue."""
    codes = long.select("variable_code").distinct()
    return codes.join(F.broadcast(variable_catalog(long.sparkSession)), "variable_code",
                      "left_anti")


def repair_units(dim: DataFrame) -> DataFrame:
    """Correct the unit label of stored variables; readings are left as they are."""
    catalog = variable_catalog(dim.sparkSession).select("variable_code",
                                                        F.col("unit").alias("_unit"))
    fixed = F.when(F.col("variable_code") == "ALLSKY_SFC_SW_DWN", F.col("_unit")) \
        .otherwise(F.col("unit"))
    return dim.join(F.broadcast(catalog), "variable_code", "left") \
        .withColumn("unit", fixed).select(*dim.columns)


def dim_source(wide: DataFrame, layout: Layout = WIDE,
               catalog: Sequence[tuple] = SOURCE_METADATA,
               existing: DataFrame | None = None) -> DataFrame:
    """Sources that occur in the data, described where known and numbered by name.

    With `existing`, its rows stay and new names follow.
    """
    names = wide.select(F.col(layout.source).alias("source_name")) \
        .filter(F.col("source_name").isNotNull()).distinct()
    known = _metadata(wide.sparkSession, catalog,
                      "source_name provider temporal_resolution description")
    if existing is not None:
        names = names.join(existing.select("source_name"), "source_name", "left_anti")
    # The catalogue is a fixed list.
    described = names.join(F.broadcast(known), "source_name", "left")
    numbered = range_ids(described, ["source_name"], "_rank")
    key = F.col("_rank")
    if existing is not None:
        top = existing.agg(F.coalesce(F.max("source_id"), F.lit(0)).alias("_top"))
        numbered, key = numbered.crossJoin(F.broadcast(top)), key + F.col("_top")
    fresh = numbered.select(key.cast("int").alias("source_id"), "source_name",
                           F.coalesce("provider", "source_name").alias("provider"),
                           F.coalesce("temporal_resolution", F.lit("daily"))
                           .alias("temporal_resolution"),
                           F.coalesce("description",
                                      F.concat("source_name", F.lit(" daily observations")))
                           .alias("description"))
    return fresh if existing is None else existing.unionByName(fresh)


def insert_or_ignore(existing: DataFrame, candidates: DataFrame,
                     natural_key: Sequence[str]) -> DataFrame:
    """Existing rows unchanged, plus candidates whose natural key is not there yet."""
    fresh = candidates.join(existing.select(*natural_key), list(natural_key), "left_anti")
    return existing.unionByName(fresh.select(*existing.columns))


def wide_to_long(wide: DataFrame, layout: Layout = WIDE) -> DataFrame:
    """One row per day, point and variable; empty readings stay."""
    return long_values(wide, layout, keep=(layout.date, layout.location, layout.latitude,
                                           layout.longitude, layout.source))


def fact_dim_lookup(long: DataFrame, dates: DataFrame, locations: DataFrame,
                    variables: DataFrame, sources: DataFrame,
                    layout: Layout = WIDE) -> DataFrame:
    """Long rows with the ids of their dimension rows; unmatched rows drop out.

    For every dimension the planner decides from its measured size; where it has
    to shuffle, adaptive execution splits the partitions of frequent keys.
    """
    return (long
            .join(variables.select("variable_id", "variable_code"), "variable_code")
            .join(dates.select("date_id", F.col("full_date").alias(layout.date)), layout.date)
            .join(sources.select("source_id", F.col("source_name").alias(layout.source)),
                  layout.source)
            .join(locations.select("location_id",
                                   F.col("location_name").alias(layout.location)),
                  layout.location)
            .select(*FACT_KEY, "value"))


SERIES_KEY = ("location_id", "variable_id", "source_id")
_DAY = day_bits.place("(date_id DIV 100 % 100)", "(date_id % 100)")


def fact_days(facts: DataFrame) -> DataFrame:
    """The days that have a fact, as bits, one row per location, variable, source and year.

    It holds the four-part keys of all facts exactly, in a few numbers for a
    year of days, and is combined on the map side.  Rows of several loads are
    combined by `or`, which never changes what is there.
    """
    known = facts.filter(" AND ".join(f"{c} IS NOT NULL" for c in FACT_KEY)) \
        .select(*SERIES_KEY, "date_id", F.expr("date_id DIV 10000").cast("int").alias("year"))
    return known.groupBy(*SERIES_KEY, "year").agg(*day_bits.bits(_DAY, "days"))


def merged_days(days: DataFrame) -> DataFrame:
    """One row per series and year from the rows of several loads."""
    return days.groupBy(*SERIES_KEY, "year").agg(
        *[F.expr(f"bit_or(days{i})").alias(f"days{i}") for i in range(day_bits.WORDS)])


def fact_marks(facts: DataFrame) -> DataFrame:
    """The four-part keys of all facts, exactly: 64 neighbouring variables as bits of one number.

    The readings of a day and point lie together, so they become one row on the
    map side.
    """
    return facts.filter(" AND ".join(f"{c} IS NOT NULL" for c in FACT_KEY)) \
        .groupBy("date_id", "location_id", "source_id", F.expr(_WORD).alias("word")) \
        .agg(F.expr(f"bit_or(shiftleft(1L, {_BIT}))").alias("marks"))


_WORD, _BIT = "shiftright(CAST(variable_id AS BIGINT), 6)", "CAST(variable_id & 63 AS INT)"


def new_facts(incoming: DataFrame, existing: DataFrame | None = None,
              days: DataFrame | None = None) -> DataFrame:
    """Incoming facts whose four-part key is not stored yet.

    Where the days of the stored facts are kept (see `fact_days`), keys are asked
    for by them.  Otherwise they are made from the stored facts as short marks
    (see `fact_marks`), which meet the incoming facts by day and point, so that
    the readings of a day and point travel together.
    """
    if days is None:
        marks = fact_marks(existing)
        marks = marks.select(*[F.col(c).alias(f"_{c}") for c in marks.columns])
        same = F.expr(f"{_WORD} = _word")
        for c in ("date_id", "location_id", "source_id"):
            same = same & (F.col(c) == F.col(f"_{c}"))
        there = F.expr(f"getbit(_marks, {_BIT}) = 1")
        return incoming.join(marks, same, "left").filter(~F.coalesce(there, F.lit(False))) \
            .select(*incoming.columns)
    stored = merged_days(days)
    marks = stored.select(*[F.col(c).alias(f"_{c}") for c in (*SERIES_KEY, "year")],
                          *[f"days{i}" for i in range(day_bits.WORDS)])
    same = F.expr("date_id DIV 10000 = _year")
    for c in SERIES_KEY:
        same = same & (F.col(c) == F.col(f"_{c}"))
    there = F.expr(day_bits.is_set(_DAY, "days"))
    return incoming.join(marks, same, "left").filter(~F.coalesce(there, F.lit(False))) \
        .select(*incoming.columns)


def fact_load(incoming: DataFrame, existing: DataFrame | None = None,
              ingested_at: Column | None = None, after: int = 0) -> DataFrame:
    """New facts, numbered after the stored ones by date, location, variable and source.

    Numbering reads the new facts twice.  With stored facts they come out of a
    large anti join, so they are pinned first and the join runs once.  `after`
    is the last id in use, where it is known without reading the stored facts.
    """
    fresh = incoming if existing is None else pinned(new_facts(incoming, existing))
    numbered = calendar_ids(fresh, "date_id", "location_id", ["variable_id", "source_id"],
                            "observation_id")
    if existing is not None:
        top = existing.agg(F.coalesce(F.max("observation_id"), F.lit(0)).alias("_top"))
        # One row.
        numbered = numbered.crossJoin(F.broadcast(top)).withColumn(
            "observation_id", F.col("observation_id") + F.col("_top")).drop("_top")
    numbered = numbered.withColumn("observation_id", F.col("observation_id") + F.lit(after))
    at = F.current_timestamp() if ingested_at is None else ingested_at
    return numbered.select("observation_id", *FACT_KEY, "value", at.alias("ingested_at"))


def observation_view(facts: DataFrame, dates: DataFrame, locations: DataFrame,
                     variables: DataFrame, sources: DataFrame) -> DataFrame:
    """Facts with the readable columns of all four dimensions."""
    return (facts
            .join(variables.select("variable_id", "variable_code", "variable_name", "unit"),
                  "variable_id")
            .join(dates.select("date_id", F.col("full_date").alias("observation_date"), "year",
                               "quarter", "month", "month_name"), "date_id")
            .join(sources.select("source_id", "source_name"), "source_id")
            .join(locations.select("location_id", "location_name", "latitude", "longitude",
                                   "country"), "location_id")
            .select("observation_date", "year", "quarter", "month", "month_name",
                    "location_name", "latitude", "longitude", "country", "variable_code",
                    "variable_name", "unit", "source_name", "value", "ingested_at"))


def load_reconcile(wide: DataFrame, tables: Mapping[str, DataFrame],
                   layout: Layout = WIDE) -> DataFrame:
    """Expected against loaded numbers of locations, days, variables, sources and facts."""
    expected = wide.agg(F.count_distinct(layout.location).alias("e_locations"),
                        F.count_distinct(layout.date).alias("e_dates"),
                        F.count("*").alias("e_rows"))
    one = expected
    for name, df in tables.items():
        one = one.crossJoin(df.agg(F.count("*").alias(f"a_{name}")))
    variables = len(layout.measures)
    rows = check_rows(one, [
        ("locations", "e_locations", "a_dim_location"), ("dates", "e_dates", "a_dim_date"),
        ("variables", str(variables), "a_dim_variable"),
        ("sources_present", "1", "least(a_dim_source, 1)"),
        ("facts", f"e_rows * {variables}", "a_fact_observation")])
    return rows


def load_checks(wide: DataFrame, long: DataFrame, matched: DataFrame,
                layout: Layout = WIDE) -> DataFrame:
    """Whether every reading of a batch found its dimension rows, as check rows.

    `matched` are the facts of the batch after the lookup, stored ones included.
    """
    one = wide.agg(F.count("*").alias("rows"), *[
        F.count_if(F.col(c).isNull()).alias(n) for c, n in (
            (layout.date, "no_date"), (layout.location, "no_location"), (layout.source, "no_source"))])
    unknown = unknown_variables(long).agg(F.count("*").alias("unknown"))
    facts = matched.agg(F.count("*").alias("facts"))
    return check_rows(one.crossJoin(unknown).crossJoin(facts), [
        ("has rows", "1", "least(rows, 1)"), ("rows without a date", "0", "no_date"),
        ("rows without a location", "0", "no_location"), ("rows without a source", "0", "no_source"),
        ("unknown variables", "0", "unknown"),
        ("facts", f"rows * {len(layout.measures)}", "facts")])


# Numbers whose keys are counted as one row by `constraint_audit`.
WORD_BITS = 3
WORD = 1 << WORD_BITS


def constraint_audit(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Violations of keys, required columns and references of the star schema.

    `tables` holds dim_location, dim_date, dim_variable, dim_source,
    fact_observation and, when it is filled, fact_quality_flag.
    """
    unique = [("dim_location", ["location_id"]), ("dim_location", ["location_name"]),
              ("dim_date", ["date_id"]), ("dim_date", ["full_date"]),
              ("dim_variable", ["variable_id"]), ("dim_variable", ["variable_code"]),
              ("dim_source", ["source_id"]), ("dim_source", ["source_name"]),
              ("fact_observation", ["observation_id"]), ("fact_observation", list(FACT_KEY)),
              ("fact_quality_flag", ["quality_flag_id"])]
    required = {
        "dim_location": ["location_name", "latitude", "longitude"],
        "dim_date": ["full_date", "year", "quarter", "month", "month_name", "day",
                     "day_of_year"],
        "dim_variable": ["variable_code", "variable_name"],
        "dim_source": ["source_name"],
        "fact_observation": list(FACT_KEY),
        "fact_quality_flag": ["observation_id", "rule_name"]}
    references = [("fact_observation", "date_id", "dim_date"),
                  ("fact_observation", "location_id", "dim_location"),
                  ("fact_observation", "variable_id", "dim_variable"),
                  ("fact_observation", "source_id", "dim_source"),
                  ("fact_quality_flag", "observation_id", "fact_observation")]
    unique = [(t, k) for t, k in unique
              # A candidate may still lack its own number.
              if t in tables and set(k) <= set(tables[t].columns)]
    references = [r for r in references if r[0] in tables]
    required = [(t, c) for t, columns in required.items() if t in tables for c in columns]
    # A domain is a list of columns whose keys are compared; references share that of their target.
    domains = list(dict.fromkeys([(t, tuple(k)) for t, k in unique]
                                 + [(target, (c,)) for _, c, target in references]))
    labels = [f"struct('unique {t}({', '.join(k)})' AS constraint, {domains.index((t, tuple(k)))} AS domain, "
              "'twice' AS kind)" for t, k in unique]
    labels += [f"struct('not null {t}.{c}' AS constraint, {-1 - i} AS domain, 'rows' AS kind)" for i, (t, c) in enumerate(required)]
    labels += [f"struct('reference {t}.{c} -> {target}' AS constraint, "
               f"{domains.index((target, (c,)))} AS domain, 'lost' AS kind)"
               for t, c, target in references]

    # Whole numbers that lie close share a word: their key names the word, a bit each of them.
    def number(domain: int) -> int | None:
        """Position of the column whose numbers are bits; None if a key of the domain is no number."""
        owner, columns = domains[domain]
        at = columns.index("variable_id") if "variable_id" in columns else len(columns) - 1
        held = [(owner, columns[at])] + [(t, c) for t, c, target in references
                                         if (target, (c,)) == domains[domain]]
        whole = all(dict(tables[t].dtypes)[c] in ("tinyint", "smallint", "int", "bigint") for t, c in held)
        return at if whole else None

    packed = [number(d) for d in range(len(domains))]

    def word(domain: int, columns: Sequence[str], missing: str) -> str:
        """SQL texts of the key and of the place of the bit."""
        at = packed[domain]
        parts = [f"shiftright(CAST({c} AS BIGINT), {WORD_BITS})" if i == at else c
                 for i, c in enumerate(columns)]
        key = "concat_ws('\u0001', " + ", ".join(
            f"coalesce(CAST({p} AS STRING), '{missing}')" for p in parts) + ")"
        place = "0" if at is None else f"coalesce(CAST({columns[at]} & {WORD - 1} AS INT), 0)"
        return f"{key} AS key, {place} AS place"

    def tagged(table: str) -> DataFrame:
        """One row per key that the table holds or refers to, and per missing required cell."""
        held = [f"struct({d} AS domain, {word(d, columns, chr(2))}, 1L AS own, 0L AS used)"
                for d, (owner, columns) in enumerate(domains) if owner == table]
        # A missing reference equals no key, a missing one included.
        held += [f"struct({(d := domains.index((target, (c,))))} AS domain, {word(d, [c], chr(3))}, "
                 "0L AS own, 1L AS used)"
                 for t, c, target in references if t == table]
        held += [f"IF({c} IS NULL, struct({-1 - i} AS domain, '' AS key, 0 AS place, 1L AS own, 0L AS used), NULL)"
                 for i, (t, c) in enumerate(required) if t == table]
        return tables[table].select(F.expr(f"inline(array_compact(array({', '.join(held)})))"))

    every = reduce(DataFrame.unionByName, [tagged(t) for t in tables])
    lost = " + ".join(f"IF(getbit(bits, {i}) = 0, used{i}, 0L)" for i in range(WORD))
    found = every.groupBy("domain", "key").agg(
        F.sum("own").alias("own"), F.expr("bit_or(IF(own = 1, shiftleft(1L, place), 0L))").alias("bits"),
        *[F.expr(f"sum(IF(place = {i}, used, 0L))").alias(f"used{i}") for i in range(WORD)]) \
        .groupBy("domain").agg(
        F.sum(F.expr("own - bit_count(bits)")).alias("twice"), F.sum("own").alias("rows"),
        F.sum(F.expr(lost)).alias("lost"))
    listed = found.sparkSession.range(1).select(F.expr(f"inline(array({', '.join(labels)}))"))
    violations = F.when(F.col("kind") == "twice", F.col("twice")) \
        .when(F.col("kind") == "rows", F.col("rows")).otherwise(F.col("lost"))
    # One row per domain.
    return listed.join(F.broadcast(found), "domain", "left").select(
        "constraint", F.coalesce(violations, F.lit(0)).cast("long").alias("violations"))


def quality_flag_fact(facts: DataFrame, variables: DataFrame, bounds: DataFrame,
                      flagged_at: Column | None = None, rule: int = 0, rules: int = 1) -> DataFrame:
    """One flag row per fact beyond its variable's bounds.

    `rule` of `rules` numbers the rule that is applied, so that the flags of
    several rules on one fact have different ids.
    """
    limits = variables.select("variable_id", "variable_code").join(bounds, "variable_code")
    hits = facts.join(limits, "variable_id").filter(beyond())
    note = F.when(F.col("value") < F.col("lower_bound"), "below lower bound") \
        .otherwise("above upper bound")
    at = F.current_timestamp() if flagged_at is None else flagged_at
    return hits.select((F.col("observation_id") * rules + rule).alias("quality_flag_id"), "observation_id",
                       F.concat(F.lit("iqr_flag_"), F.col("variable_code")).alias("rule_name"),
                       F.lit("statistical").alias("flag_type"),
                       F.lit("WARNING").alias("severity"), F.lit(True).alias("flag_value"),
                       at.alias("flagged_at"), note.alias("notes"))


def facts_from_wide(wide: DataFrame, tables: Mapping[str, DataFrame], layout: Layout = WIDE,
                    ingested_at: Column | None = None) -> DataFrame:
    """The numbered facts of a first load, looked up and numbered before they are unpivoted.

    Dates, locations and sources join, and the numbering sorts, one row per day
    and point instead of one per reading.  A reading's number follows from its
    row's place: all readings of earlier rows of other days and points come
    first, then, within a day and point, variable by variable, the sources in
    order.
    """
    variables = tables["dim_variable"].select("variable_id", "variable_code")
    rows = (wide
            .join(tables["dim_date"].select("date_id", F.col("full_date").alias(layout.date)), layout.date)
            .join(tables["dim_source"].select("source_id", F.col("source_name").alias(layout.source)),
                  layout.source)
            .join(tables["dim_location"].select("location_id", F.col("location_name").alias(layout.location)),
                  layout.location)
            .select("date_id", "location_id", "source_id", *layout.measures))
    blocked = in_blocks(rows, "location_id")
    rank = F.row_number().over(Window.partitionBy("date_id", "_block")
                               .orderBy("location_id", "source_id", *layout.measures))
    # The sources of one day and point, a handful of rows; they stay in their block's task.
    point = Window.partitionBy("date_id", "_block", "location_id")
    placed = blocked.withColumn("_rank", rank) \
        .withColumns({"_size": F.count("*").over(point), "_first": F.min("_rank").over(point)}) \
        .join(block_offsets(blocked, "date_id"), ["date_id", "_block"])
    readings = F.array(*[F.struct(F.lit(code_of(m)).alias("variable_code"), F.col(m).cast("double")
                                  .alias("value")) for m in layout.measures])
    long = placed.select("date_id", "location_id", "source_id", "_rank", "_size", "_first", "_offset",
                         F.inline(readings)).join(variables, "variable_code")
    count = F.lit(len(layout.measures)).cast("long")
    number = (F.col("_offset") + F.col("_first") - 1) * count + (F.col("variable_id") - 1) * F.col("_size") \
        + F.col("_rank") - F.col("_first") + 1
    at = F.current_timestamp() if ingested_at is None else ingested_at
    return long.select(number.cast("long").alias("observation_id"), *FACT_KEY, "value",
                       at.alias("ingested_at"))


def build_star(wide: DataFrame, layout: Layout = WIDE, country: str = DEFAULT_COUNTRY,
               source_catalog: Sequence[tuple] = SOURCE_METADATA,
               ingested_at: Column | None = None) -> dict[str, DataFrame]:
    """First load: all four dimensions and the facts of a wide table.

    Everything is written to the shared folder once; later plans read from there
    what they need, with their filters and columns.
    """
    long = wide_to_long(wide, layout)
    tables = {name: pinned(df, name) for name, df in {
        "dim_location": dim_location(wide, layout, country), "dim_date": dim_date(wide, layout),
        "dim_variable": dim_variable(long),
        "dim_source": dim_source(wide, layout, source_catalog)}.items()}
    tables["fact_observation"] = pinned(facts_from_wide(wide, tables, layout, ingested_at), "facts")
    return tables


def star_bounds(wide: DataFrame, layout: Layout = WIDE) -> DataFrame:
    return iqr_bounds(wide, layout).select("variable_code", "lower_bound", "upper_bound")
