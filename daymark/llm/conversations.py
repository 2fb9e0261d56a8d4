"""Conversation structure repair by weighted interval parsing.

A repaired conversation has the role initials (s?(ua)+)?: at most one system turn, then pairs of a
user's and an assistant's turn. Edits of a row are Keep (cost 0), Rerole to user or assistant (2) and
Delete (3); an empty user or assistant turn is Inserted anywhere for 2; a truncated row that stays
costs 1 more; blank rows and repetitions must go. Of the cheapest repairs, the one whose string of
edit initials is least in ASCII wins.

The repair grammar is in Chomsky normal form. Its symbols are pairs of the place in the pattern before
and behind a span (nothing yet, after s, after u, after a), its binary rules join two pairs that meet,
its terminal rules are a row's edits after any insertions (the closure of the insertion rules). The
cell of a span holds the least (cost, audit) for every symbol. Cells are built bottom-up by length of
span, inside blocks of BLOCK rows from every split, and beyond that from one split of each span: pairs
that meet may be joined in any order, so all splits of a span give the same cell. Equal strings of row
kinds share their cells. Two audits of one symbol and span never differ by insertions at their end
alone, as those would change the place behind, so the least audits of two spans make the least of both.

Rows are put in order by range, not by conversation, so a conversation of any length is dealt over many
tasks; equal rows are counted first and travel once. What meets in one task per conversation are the
cells of its blocks, some bytes a row, as an audit is one value; texts are only streamed.

Rows without a turn come first; rows of one turn are ordered by role, then by text (by its first
HEAD characters, then its digest). Null roles and texts are one space. A null id is a conversation of
its own. An empty table gives no rows. Other columns are not returned.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.functions.storage import pinned

BLOCK = 12
HEAD = 48
#: Cells a task remembers, and rows and characters of text it gathers before it hands them on.
CELLS, FLUSH_ROWS, FLUSH_CHARS = 100_000, 4096, 4 << 20
KEY = ["conv_id", "turn", "role", "head", "digest"]

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT,
         (ASSISTANT, "u"): USER}
COMPLETE = (NOTHING, ASSISTANT)
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
Cell = dict[tuple[int, int], tuple[int, str]]


def joined(left: Cell, right: Cell, into: Cell | None = None) -> Cell:
    """The least (cost, audit) of every symbol that a symbol of each side makes up."""
    made = {} if into is None else into
    for (p, r), (cost, audit) in left.items():
        for q in range(4):
            if (r, q) in right:
                other = right[r, q]
                found = cost + other[0], audit + other[1]
                if (p, q) not in made or found < made[p, q]:
                    made[p, q] = found
    return made


def _closure() -> Cell:
    """The least insertions from each place to each that they reach."""
    one = {(p, q): (INSERT, "I") for (p, c), q in STEPS.items() if c in "ua"}
    made = {(p, p): (0, "") for p in range(4)}
    for _ in range(4):
        joined(dict(made), one, made)
    return made


INSERTIONS = _closure()


def row_cell(kind: str) -> Cell:
    """A row's edits behind any insertions. Kinds: role initial s, u, a or o for any other, in capitals
    if truncated; x for a row that must go."""
    made: Cell = {(p, p): (DELETE, "D") for p in range(4)}
    if kind != "x":
        more = TRUNCATED if kind.isupper() else 0
        for (p, initial), q in STEPS.items():
            options = [(REROLE + more, "R")] if initial in "ua" else []
            if initial == kind.lower():
                options.append((more, "K"))
            for option in options:
                if (p, q) not in made or option < made[p, q]:
                    made[p, q] = option
    return joined(INSERTIONS, made)


class Chart:
    """Cells of spans by their string of row kinds; equal strings are parsed once."""

    def __init__(self):
        self.cells: dict[str, Cell] = {}

    def block(self, kinds: str) -> Cell:
        """The cell of a block, from all splits of all its spans, short spans first."""
        if len(self.cells) > CELLS:
            self.cells = {}
        for length in range(1, len(kinds) + 1):
            for at in range(len(kinds) - length + 1):
                span = kinds[at:at + length]
                if span not in self.cells:
                    if length == 1:
                        self.cells[span] = row_cell(span)
                        continue
                    made: Cell = {}
                    for cut in range(1, length):
                        joined(self.cells[span[:cut]], self.cells[span[cut:]], made)
                    self.cells[span] = made
        return self.cells[kinds]


def parsed(cells: list[Cell]) -> tuple[int, str]:
    """Cost and audit of the cheapest repair of neighbouring spans."""
    while len(cells) > 1:
        cells = [joined(*cells[i:i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    made = joined(cells[0], INSERTIONS)
    return min(made[NOTHING, q] for q in COMPLETE if (NOTHING, q) in made)


def damaged(rows: DataFrame) -> DataFrame:
    """Rows damaged by crc32 of `conv_id:turn` by twenty: dropped, emptied, unpunctuated, repeated or reroled."""
    kind = "crc32(concat(coalesce(CAST(conv_id AS string), ' '), ':', coalesce(CAST(turn AS string), ' '))) % 20"
    named = rows.selectExpr("conv_id", "turn", "coalesce(role, ' ') AS role", "coalesce(text, ' ') AS text",
                            f"{kind} AS kind")
    return named.where("kind <> 0").selectExpr(
        "conv_id", "turn", "CASE WHEN kind = 4 THEN 'user' ELSE role END AS role",
        "CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text",
        "explode(array_repeat(0, IF(kind = 3, 2, 1))) AS copy").drop("copy")


def keyed(rows: DataFrame) -> DataFrame:
    """Rows with their place in order: head and digest stand for the text."""
    return rows.selectExpr("conv_id", "CAST(turn AS long) AS turn", "coalesce(role, ' ') AS role",
                           f"substring(coalesce(text, ' '), 1, {HEAD}) AS head",
                           "unhex(sha2(CAST(coalesce(text, ' ') AS binary), 256)) AS digest",
                           "coalesce(text, ' ') AS text")


def faults(keys: DataFrame) -> DataFrame:
    """Distinct rows in order with kind, the number n of equal rows, and how many are blank, duplicate, truncated."""
    body = r"trim(TRAILING ' \t\n\u000b\f\r' FROM text)"
    runs = keys.selectExpr(*KEY, f"{body} = '' AS is_blank", f"right({body}, 1) NOT IN ('.', '!', '?') AS is_cut") \
        .groupBy(*KEY).agg(F.count("*").alias("n"), F.first("is_blank").alias("is_blank"),
                           F.first("is_cut").alias("is_cut"))
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))
    again = runs.groupBy("conv_id", "role", "digest").agg(F.min(when).alias("when"), F.count("*").alias("times")) \
        .where("times > 1").select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"),
                                   "when")
    met = runs.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r"))
                    & (F.col("digest") == F.col("d")), "left")
    late = F.coalesce(F.col("when") < when, F.lit(False))
    initial = F.substring("role", 1, 1)
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    return met.withColumns({"late": late, "initial": initial}).select(
        *KEY, "n", "initial",
        F.when(F.col("is_blank") | F.col("late"), "x").when(F.col("is_cut"), F.upper(letter)).otherwise(letter)
        .alias("kind"),
        F.when(F.col("is_blank"), F.col("n")).otherwise(0).alias("blank"),
        F.when(F.col("is_blank"), 0).when(F.col("late"), F.col("n")).otherwise(F.col("n") - 1).alias("duplicate"),
        F.when(F.col("is_blank") | F.col("late") | ~F.col("is_cut"), 0).otherwise(1).cast("long").alias("truncated"))


def streamed(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of all batches as tuples."""
    for batch in batches:
        for at in range(0, batch.num_rows, FLUSH_ROWS):
            yield from zip(*(c.to_pylist() for c in batch.slice(at, FLUSH_ROWS).columns), strict=True)


def handed_on(rows: Iterator[tuple], schema: pa.Schema, texts: int | None = None) -> Iterator[pa.RecordBatch]:
    """Batches of rows, bounded in rows and in characters of column `texts`."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[texts]) if texts is not None else 0
        if len(held) >= FLUSH_ROWS or size > FLUSH_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def legal(before: str, after: str) -> bool:
    return before + after in ("su", "ua", "au")


def blocks(ordered: DataFrame) -> DataFrame:
    """A row per BLOCK neighbouring distinct rows of a conversation: counts, and the cells of its parse."""
    kind = ordered.schema["conv_id"].dataType.simpleString()
    columns = [*KEY, "n", "initial", "kind", "blank", "duplicate", "truncated"]
    given = ordered.select(*columns)
    numbers = ["part", "block", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "last"]
    spark_schema = f"conv_id {kind}, turn long, role string, head string, digest binary, " \
        + ", ".join(f"{c} long" for c in numbers) \
        + ", first_initial string, last_initial string, counts array<long>, " \
          "symbols array<int>, costs array<long>, audits array<string>"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chart, part = Chart(), TaskContext.get().partitionId()

        def summed(held: list[tuple], number: int) -> tuple:
            turns = [r[1] for r in held if r[1] is not None]
            cell = chart.block("".join(r[7] for r in held))
            illegal = sum(r[5] - 1 for r in held) \
                + sum(not legal(a[6], b[6]) for a, b in zip(held, held[1:]))
            return (*held[0][:5], part, number, *(sum(r[i] for r in held) for i in (8, 9, 10)), illegal,
                    len(set(turns)), min(turns, default=None), max(turns, default=None), held[-1][1],
                    held[0][6], held[-1][6], [r[5] for r in held],
                    [4 * p + q for p, q in cell], [c for c, _ in cell.values()], [a for _, a in cell.values()])

        def made() -> Iterator[tuple]:
            held, number = [], 0
            for row in streamed(batches):
                if held and (row[0] != held[0][0] or len(held) == BLOCK):
                    yield summed(held, number)
                    held, number = [], number + 1
                held.append(row)
            if held:
                yield summed(held, number)

        yield from handed_on(made(), schema)

    schema = pa.schema([("conv_id", _arrow(given, "conv_id")), ("turn", pa.int64()), ("role", pa.string()),
                        ("head", pa.string()), ("digest", pa.binary()), *[(c, pa.int64()) for c in numbers],
                        ("first_initial", pa.string()), ("last_initial", pa.string()),
                        ("counts", pa.list_(pa.int64())), ("symbols", pa.list_(pa.int32())),
                        ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))])
    return given.mapInArrow(cut, spark_schema)


def _arrow(df: DataFrame, column: str) -> pa.DataType:
    return df.select(column).limit(0).toArrow().schema.field(0).type


def plans(made: DataFrame) -> DataFrame:
    """The blocks with their part of the audit; each conversation's first one also has its totals."""
    kind = made.schema["conv_id"].dataType.simpleString()
    given = made.repartition("conv_id").sortWithinPartitions("conv_id", "part", "block")
    totals = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    names = {c: i for i, c in enumerate(made.columns)}
    schema = pa.schema([("conv_id", _arrow(made, "conv_id")), ("turn", pa.int64()), ("role", pa.string()),
                        ("head", pa.string()), ("digest", pa.binary()), ("edits", pa.string()),
                        *[(c, pa.int64()) for c in totals], ("audit", pa.string())])

    def solved(rows: list[tuple]) -> Iterator[tuple]:
        def all_of(column: str) -> list:
            return [r[names[column]] for r in rows]

        cost, audit = parsed([{divmod(s, 4): (c, a) for s, c, a in zip(*cells)}
                              for cells in zip(all_of("symbols"), all_of("costs"), all_of("audits"))])
        edits = re.findall("I*[DKR]", audit)
        counts = [n for block in all_of("counts") for n in block]
        full = "".join(e + "D" * (n - 1) for e, n in zip(edits, counts)) + audit[sum(map(len, edits)):]
        turn, last, first_initial, last_initial = (all_of(c) for c in ("turn", "last", "first_initial", "last_initial"))
        turns = sum(all_of("turns")) - sum(a is not None and a == b for a, b in zip(last, turn[1:]))
        illegal = sum(all_of("illegal")) + sum(not legal(a, b) for a, b in zip(last_initial, first_initial[1:]))
        known = [x for x in all_of("low") + all_of("high") if x is not None]
        gaps = max(known) - min(known) + 1 - turns if known else 0
        at = 0
        for i, row in enumerate(rows):
            size = len(row[names["counts"]])
            mine = "".join(edits[at:at + size])
            at += size
            if i == len(rows) - 1:
                mine += audit[sum(map(len, edits)):]
            yield (*row[:5], mine, *((gaps, *(sum(all_of(c)) for c in ("blank", "duplicate", "truncated")), illegal,
                                      cost + DELETE * sum(n - 1 for n in counts), full) if i == 0 else (None,) * 7))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            held = []
            for row in streamed(batches):
                if held and row[0] != held[0][0]:
                    yield from solved(held)
                    held = []
                held.append(row)
            if held:
                yield from solved(held)

        yield from handed_on(found(), schema)

    return given.mapInArrow(solve, f"conv_id {kind}, turn long, role string, head string, digest binary, edits string, "
                            + ", ".join(f"{c} long" for c in totals) + ", audit string")


def repaired_turns(keys: DataFrame, planned: DataFrame) -> DataFrame:
    """conv_id, place, edit, role and text of the repaired turns; those of a conversation are neighbours, in order."""
    kind = keys.schema["conv_id"].dataType.simpleString()
    both = planned.select(*KEY, F.lit(0).alias("tag"), "edits", F.lit(None).cast("string").alias("text")).unionByName(
        keys.select(*KEY, F.lit(1).alias("tag"), F.lit(None).cast("string").alias("edits"), "text"))
    dealt = both.repartition("conv_id").sortWithinPartitions(*KEY, "tag") \
        .select("conv_id", "turn", "role", "digest", "tag", "edits", "text")
    schema = pa.schema([("conv_id", _arrow(keys, "conv_id")), ("place", pa.int64()), ("edit", pa.string()),
                        ("role", pa.string()), ("text", pa.string())])

    def turned(rows: Iterator[tuple]) -> Iterator[tuple]:
        edits, tail, before, conv, state, place = iter(()), "", None, object(), NOTHING, 0
        for conv_id, turn, role, digest, tag, planned_edits, text in rows:
            if conv_id != conv:
                conv, state, place = conv_id, NOTHING, 0
            if tag == 0:
                found = re.findall("I*[DKR]", planned_edits)
                left = len(found)
                edits, tail, before = iter(found), planned_edits[sum(map(len, found)):], None
                continue
            if (turn, role, digest) == before:
                continue
            before, left = (turn, role, digest), left - 1
            mine = next(edits) + (tail if left == 0 else "")
            for edit in mine:
                if edit == "D":
                    continue
                name, body = role, text
                if edit != "K":
                    name, body = ("assistant" if state == USER else "user"), text if edit == "R" else ""
                place += 1
                state = STEPS[state, name[:1]]
                yield conv_id, place, edit, name, body

    def turn_over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from handed_on(turned(streamed(batches)), schema, texts=4)

    return dealt.mapInArrow(turn_over, f"conv_id {kind}, place long, edit string, role string, text string")


def repair(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per conversation its counts, cost and audit; and the repaired turns."""
    keys = keyed(rows)
    ordered = faults(keys).repartitionByRange(*KEY).sortWithinPartitions(*KEY)
    planned = pinned(plans(pinned(blocks(ordered), "blocks")), "plans")
    summary = planned.where("cost IS NOT NULL").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    return summary, repaired_turns(keys, planned)


def digests(turns: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's `role:text`, joined by newlines; streams turns as repair returns them."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    schema = pa.schema([("conv_id", _arrow(turns, "conv_id")), ("repaired_sha256", pa.string())])

    def hashed(rows: Iterator[tuple]) -> Iterator[tuple]:
        conv, running = None, None
        for conv_id, role, text in rows:
            if running is None or conv_id != conv:
                if running is not None:
                    yield conv, running.hexdigest()
                conv, running = conv_id, hashlib.sha256()
            else:
                running.update(b"\n")
            running.update(f"{role}:{text}".encode())
        if running is not None:
            yield conv, running.hexdigest()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from handed_on(hashed(streamed(batches)), schema)

    return turns.select("conv_id", "role", "text").mapInArrow(digest, f"conv_id {kind}, repaired_sha256 string")


def repaired_digests(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """A row per conv_id of `conversations`: summary and digest of the repair of its rows, zeros without rows."""
    summary, turns = repair(rows)
    found = summary.join(digests(turns).withColumnRenamed("conv_id", "c"),
                         F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    every = conversations.select(F.col("conv_id").alias("c")).distinct()
    full = every.join(found, F.col("c").eqNullSafe(F.col("conv_id")), "left")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return full.select(F.col("c").alias("conv_id"), *[F.coalesce(n, F.lit(0)).alias(n) for n in numbers],
                       F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
