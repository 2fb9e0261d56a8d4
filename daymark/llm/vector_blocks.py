"""Searches that bring query rows to blocks of data rows.

Every data row is written once into a block of bounded size. A block and the queries sent to it form
one sorted run of a partition: the block comes first and is indexed once, then the queries stream
through it in batches. So a task holds one block, data rows are never repeated, and what is shuffled
is the data and each query once per block that it is sent to. Each block returns its best k for
every query; a window over those keeps the best k of all. Blocks do not depend on ids, so rows that
repeat an id are spread like any others.

Vectors that are null, empty or hold null or non-finite components take no part, nor do rows
without an id. Shorter vectors count as padded with zeros. Rows with the id of a query are no
candidates of it. Of repeated ids each row is a candidate; as a query an id is asked once, with its
smallest vector.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Components and rows of a block at most, on average; rows below which a block is not split so that
#: all cores have one; queries that are asked at a time.
BLOCK_VALUES, BLOCK_ROWS, LEAST_ROWS, QUERY_ROWS = 4 << 20, 32768, 4096, 1024


def usable(rows: DataFrame, vector_id: str, vector: str) -> DataFrame:
    """(vec_id, v): ids and vectors in double precision of the rows that take part."""
    v = F.col(f"`{vector}`").cast("array<double>")
    known = rows.select(F.col(f"`{vector_id}`").cast("long").alias("vec_id"), v.alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return known.where(F.col("vec_id").isNotNull() & (F.size("v") > 0) & ~bad)


def matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    """Vectors of a column, padded with zeros to a width."""
    sizes = np.diff(lists.offsets.to_numpy())
    made = np.zeros((len(sizes), width))
    made[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return made


class Shape(NamedTuple):
    """Rows of the data, components of the longest vector of data and queries, blocks of the data."""

    rows: int
    width: int
    blocks: int


def shape(data: DataFrame, queries: DataFrame) -> Shape:
    rows, wide = data.agg(F.count("*"), F.max(F.size("v"))).first()
    width = max(wide or 0, queries.agg(F.max(F.size("v"))).first()[0] or 0)
    most = max(1, min(BLOCK_ROWS, BLOCK_VALUES // max(1, width)))
    cores = data.sparkSession.sparkContext.defaultParallelism
    return Shape(rows, width, max(1, math.ceil(rows / most), min(cores, math.ceil(rows / LEAST_ROWS))))


def search(data: DataFrame, queries: DataFrame, width: int, blocks: int, build: Callable, score: str,
           k: int) -> DataFrame:
    """query_id, rank, vec_id and score of the k best data rows of each query.

    data: (block, vec_id, v), the same rows at each read; queries: (blocks, vec_id, v, least), with
    the numbers of the blocks to ask and any score known to be reached. build(ids, vectors) indexes
    a block and returns a function of query ids, vectors and reached scores, which returns positions
    of queries, positions of data rows and their scores, for at least the k best it finds.
    """
    kind = pa.int64() if score == "long" else pa.float64()
    names = ["query_id", "vec_id", "score"]
    left = data.select("block", F.lit(0).alias("side"), "vec_id", "v", F.lit(None).cast("double").alias("least"))
    right = queries.select(F.explode("blocks").alias("block"), F.lit(1).alias("side"), "vec_id", "v", "least")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, ids, parts, ask = None, [], [], None
        for batch in batches:
            own_block, side = (batch.column(c).to_numpy() for c in ("block", "side"))
            edges = np.flatnonzero(np.diff(own_block * 2 + side)) + 1
            for start, stop in zip([0, *edges], [*edges, batch.num_rows], strict=True):
                if start == stop:
                    continue
                if own_block[start] != block:
                    block, ids, parts, ask = own_block[start], [], [], None
                for at in range(start, stop, QUERY_ROWS):
                    part = batch.slice(at, min(QUERY_ROWS, stop - at))
                    own, vectors = part.column("vec_id").to_numpy(), matrix(part.column("v"), width)
                    if side[start] == 0:
                        ids.append(own)
                        parts.append(vectors)
                        continue
                    if ask is None and ids:
                        known = np.concatenate(ids)
                        ask, parts = build(known, np.concatenate(parts)), []
                    if ask is None:
                        continue
                    least = part.column("least").to_numpy(zero_copy_only=False).astype(float)
                    q, x, s = top(*ask(own, vectors, least), known, k)
                    yield pa.RecordBatch.from_arrays([pa.array(own[q]), pa.array(known[x]), pa.array(s, kind)], names=names)

    found = left.unionByName(right).repartitionById(blocks, F.col("block").cast("int")) \
        .sortWithinPartitions("block", "side").mapInArrow(run, f"query_id long, vec_id long, score {score}")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")


def asked_once(queries: DataFrame) -> DataFrame:
    return queries.groupBy("vec_id").agg(F.min("v").alias("v"))


def numbers(count: Column | int) -> Column:
    """The blocks 0 to count - 1, at least the first."""
    return F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(count) - 1, F.lit(0)).cast("long"))


def top(q: np.ndarray, x: np.ndarray, s: np.ndarray, ids: np.ndarray, k: int):
    """Of pairs with scores, the k best of each query; ties go to the smaller id."""
    order = np.lexsort((ids[x], -s, q))
    q, x, s = q[order], x[order], s[order]
    first = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))) if len(q) else q
    place = np.arange(len(q)) - np.repeat(first, np.diff(np.append(first, len(q))))
    keep = place < k
    return q[keep], x[keep], s[keep]
