"""Toxicity scores by logistic regression over hashed word n-grams and skip-grams.

Words are runs of characters other than ASCII white space and punctuation, A-Z lower-cased. A
text's features are its distinct words, pairs of neighbours and pairs with one word between, hashed
into a fixed number of cells. Weights are learned by FTRL-proximal: a rate for each coordinate from
its past gradients, and an L1 term that keeps weights of uncertain cells at exactly zero, so the
model is the short list of its nonzero weights. That list is bounded by the number of cells and
goes to all tasks with the scoring function.

The learning rows are a bounded sample: the MAX_ROWS labelled documents with the smallest hashes of
their ids, visited in that order, as far as their texts hold no more than MAX_BYTES together. They
are one task's work. Their ids are broadcast, so texts that are not learned from are not shuffled.
Of rows that repeat an id, one text is learned from, that of the smallest hash. All rows are scored,
on whole texts. Without labels every score is 0.5. Null and empty texts have no feature but the
constant. Labels that are null are left out; of contradictory labels the larger counts. Columns
named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.functions.storage import pinned
from daymark.llm.names import others
from daymark.llm.words import Hasher, Slice, mix

CELLS = 1 << 20
#: Labelled documents and bytes of their texts that are learned from at most, and how often each is visited.
MAX_ROWS, MAX_BYTES, PASSES = 16_000, 128 << 20, 3
RATE, BETA, L1, L2 = 1.0, 1.0, 8.0, 0.0
THRESHOLD = 0.7


def features(part: Slice, wanted: Callable | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows and cells of the distinct features of a slice, in order; cell 0 is the constant.

    wanted: only cells for which it is true, sorted out before anything is held.
    """
    row = np.repeat(np.arange(part.rows), np.diff(part.bounds))
    kept = []

    def add(rows: np.ndarray, cells: np.ndarray) -> None:
        if wanted is not None:
            near = wanted(cells)
            rows, cells = rows[near], cells[near]
        kept.append(np.unique(rows * CELLS + cells))

    add(np.arange(part.rows), np.zeros(part.rows, np.int64))
    for gap in (0, 1, 2):
        first, own = (x[:max(0, len(x) - gap)] for x in (part.words, row))
        with np.errstate(over="ignore"):
            hashed = first if gap == 0 else mix(first * np.uint64(2 * gap + 1) + part.words[gap:])
        inside = own == row[gap:]
        add(own[inside], (hashed[inside] % np.uint64(CELLS - 1)).astype(np.int64) + 1)
    keys = np.unique(np.concatenate(kept))
    return keys // CELLS, keys % CELLS


def learn(rows: list[np.ndarray], labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cells and values of the nonzero weights after all passes over the rows in order."""
    z, n = np.zeros(CELLS), np.zeros(CELLS)

    def weights(zs, ns):
        return np.where(np.abs(zs) <= L1, 0.0,
                        (np.sign(zs) * L1 - zs) / ((BETA + np.sqrt(ns)) / RATE + L2))

    for _ in range(PASSES):
        for cells, label in zip(rows, labels, strict=True):
            zs, ns = z[cells], n[cells]
            w = weights(zs, ns)
            gap = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
            squared = gap * gap
            z[cells] = zs + gap - (np.sqrt(ns + squared) - np.sqrt(ns)) / RATE * w
            n[cells] = ns + squared
    w = weights(z, n)
    cells = np.flatnonzero(w)
    return cells, w[cells]


def train(docs: DataFrame, labels: DataFrame, usable: Column, doc_id: str = "doc_id",
          text: str = "text", label: str = "toxic") -> tuple[np.ndarray, np.ndarray]:
    """Weights from the labelled documents for which `usable` (of column doc_id) holds."""
    known = labels.where(F.col(f"`{label}`").isNotNull() & F.col("doc_id").isNotNull()) \
        .groupBy("doc_id").agg(F.max(F.col(f"`{label}`").cast("int")).alias("label"))
    named = known.select("doc_id", "label").where(usable)
    order = F.xxhash64("doc_id", F.lit(11))
    # At most MAX_ROWS short rows.
    chosen = F.broadcast(named.select("doc_id", "label", order.alias("at")).orderBy("at", "doc_id").limit(MAX_ROWS))
    texts = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").cast("binary").alias("blob"))
    found = pinned(texts.join(chosen, "doc_id").groupBy("doc_id", "at", "label").agg(
        F.expr("min_by(coalesce(blob, X''), xxhash64(blob))").alias("blob")), "sample")
    # At most MAX_ROWS numbers.
    before = F.sum("bytes").over(Window.orderBy("at", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    within = found.select("doc_id", "at", F.octet_length("blob").cast("long").alias("bytes")) \
        .select("doc_id", before.alias("before")).where(F.col("before") <= MAX_BYTES).select("doc_id")
    sample = found.join(F.broadcast(within), "doc_id").select("at", "label", "blob")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(punctuation=True)
        for batch in batches:
            for part in hasher.slices(batch.column("blob")):
                row, cells = features(part)
                bounds = np.searchsorted(row, np.arange(part.rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(part.first, part.rows) for c in ("at", "label")]
                    + [pa.ListArray.from_arrays(pa.array(bounds), pa.array(cells.astype(np.int32)))],
                    names=["at", "label", "cells"])

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, labels = [], []
        for batch in batches:
            lists = batch.column("cells")
            bounds = lists.offsets.to_numpy()
            cells = lists.values.to_numpy()
            rows += [cells[a:b].copy() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            labels += batch.column("label").to_pylist()
        cells, values = learn(rows, np.array(labels))
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(values)], names=["cell", "weight"])

    made = sample.mapInArrow(extract, "at long, label int, cells array<int>").repartition(1) \
        .sortWithinPartitions("at").mapInArrow(fit, "cell int, weight double").toArrow()
    return made.column("cell").to_numpy(), made.column("weight").to_numpy()


def score(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], text: str = "text",
          keep: Sequence[str] | None = None) -> DataFrame:
    """All rows with their columns, or those of `keep`, and score and predicted.

    A kept text goes to the tasks' Python workers and back, any other only there.
    """
    made = {"score": T.DoubleType(), "predicted": T.IntegerType()}
    kept = [c for c in others(docs, made) if keep is None or c in keep]
    given = docs.select(*[F.col(f"`{c}`") for c in kept],
                        *([] if text in kept else [F.col(f"`{text}`").alias("score")]))
    schema = T.StructType([*docs.select(*[F.col(f"`{c}`") for c in kept]).schema.fields,
                           *[T.StructField(n, t, False) for n, t in made.items()]])
    cells, values = model

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = np.zeros(CELLS)
        weights[cells] = values
        hasher = Hasher(punctuation=True)
        for batch in batches:
            for part in hasher.slices(batch.column(text if text in kept else "score").cast(pa.large_binary())):
                row, found = features(part, lambda cells: weights[cells] != 0)
                sums = np.bincount(row, weights[found], minlength=part.rows)
                scores = 1 / (1 + np.exp(-np.clip(sums, -35, 35)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).slice(part.first, part.rows) for c in kept]
                    + [pa.array(scores), pa.array((scores >= THRESHOLD).astype(np.int32))],
                    names=[*kept, *made])

    return given.mapInArrow(rate, schema)
