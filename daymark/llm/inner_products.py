"""Exact top-k inner products: descending lengths, rotated partial sums, Cauchy-Schwarz bounds.

Components become floor(256 * x) and scores are exact integers. A rotation from the singular
vectors of a bounded sample brings most of the length of typical vectors into few coordinates. Rows
are dealt by descending length into blocks and visited in that order: a query is not sent to blocks,
and leaves a block, once its length times the next row's cannot reach its k-th best score; for the
other pairs the sum over the first
rotated coordinates plus the product of the remaining lengths bounds the score, and only pairs
whose bound reaches the k-th best are multiplied out. The first k-th best score comes from a
bounded number of the longest vectors. Any rotation and any first score give the same result; they
only decide how much is skipped. Bounds are widened by more than their rounding errors.

Products that are no exact longs stop the run; see vector_blocks for null, odd and repeated rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.functions.storage import pinned
from daymark.llm import vector_blocks

#: Sampled vectors for the rotation; longest vectors for the first scores; rows visited at a time.
SAMPLE_ROWS, LONGEST_ROWS, STEP_ROWS = 4096, 256, 512
#: Lengths of blocks, at most, that are known to the queries.
KNOWN_LENGTHS = 1024
SLACK = 1e-9


def largest(rows: DataFrame, asked: DataFrame, k: int = 5, scale: int = 256,
            vector_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the k rows with the largest products for each asked row."""
    def whole(df):
        return vector_blocks.usable(df, vector_id, vector).withColumn(
            "v", F.transform("v", lambda x: F.floor(x * scale).cast("double")))

    data, queries = whole(rows), vector_blocks.asked_once(whole(asked))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x))
    _, width, blocks = vector_blocks.shape(data, queries)
    # The row number parts equal lengths; the written block numbers fall with the length.
    data = pinned(data.withColumn("length", length).withColumn("row", F.monotonically_increasing_id())
                  .repartitionByRange(blocks, F.col("length").desc(), "row")
                  .withColumn("block", F.spark_partition_id()).drop("row"), "vectors")
    lengths = data.groupBy("block").agg(F.max("length").alias("longest"))
    blocks = (lengths.agg(F.max("block")).first()[0] or 0) + 1
    every = math.ceil(blocks / KNOWN_LENGTHS)
    found = {r.of: r.longest for r in lengths.groupBy((F.col("block") / every).cast("long").alias("of")).agg(
        F.max("longest").alias("longest")).collect()}
    # A number without rows counts as long as the one before it, so the list falls.
    known = [found.get(0, math.inf)]
    for of in range(1, math.ceil(blocks / every)):
        known.append(found.get(of, known[-1]))
    sample = data.orderBy(F.xxhash64("vec_id"), "v").limit(SAMPLE_ROWS).select("v").toArrow()
    longest = data.orderBy(F.col("length").desc(), "vec_id").limit(LONGEST_ROWS).select("vec_id", "v").toArrow()
    points, first = (vector_blocks.matrix(t.column("v").combine_chunks(), width) for t in (sample, longest))
    axes = np.linalg.svd(points.T @ points)[0]
    first_ids = longest.column("vec_id").to_numpy()

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = vector_blocks.matrix(batch.column("v"), width)
            least = np.full(len(q), -np.inf)
            if len(first) >= k + 1:
                products = first @ q.T
                products[first_ids[:, None] == batch.column("vec_id").to_numpy()] = -np.inf
                least = np.partition(products, -k, axis=0)[-k]
            least = np.where(np.isfinite(least), least, -np.inf)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least)], names=["vec_id", "v", "length", "least"])

    queries = queries.withColumn("length", length).mapInArrow(
        reached, "vec_id long, v array<double>, length double, least double")
    near = F.filter(F.array(*map(F.lit, known)).cast("array<double>"), lambda x: (
        x * F.col("length") * (1 + 2 * SLACK) + 2 >= F.col("least")))
    queries = queries.select(
        vector_blocks.numbers(F.least(F.size(near) * every, F.lit(blocks))).alias("blocks"), "vec_id", "v", "least")
    return vector_blocks.search(data, queries, width, blocks, lambda ids, x: Block(ids, x, axes, k), "long", k)


class Block:
    """One block of vectors, rotated, by descending length; called, it returns the best of queries."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, axes: np.ndarray, k: int):
        order = np.argsort(-(x * x).sum(axis=1), kind="stable")
        self.ids, self.axes, self.k = ids, axes, k
        self.order, self.rotated, self.exact = order, x[order] @ axes, x.astype(np.int64)
        self.lengths = np.sqrt((self.rotated * self.rotated).sum(axis=1))

    def __call__(self, own: np.ndarray, q: np.ndarray, least: np.ndarray):
        return pruned(self, own, q, least)


def pruned(block: Block, own: np.ndarray, q: np.ndarray, floor: np.ndarray):
    """The k largest products of each query in a block; floor: scores known to be reached."""
    ids, order, xr, lengths, exact, k = block.ids, block.order, block.rotated, block.lengths, block.exact, block.k
    qr = q @ block.axes
    head = max(1, q.shape[1] // 4)
    asked = np.sqrt((qr * qr).sum(axis=1))
    rest, rest_asked = [np.sqrt((m[:, head:] ** 2).sum(axis=1)) for m in (xr, qr)]
    slack = 1 + SLACK * asked * (lengths[0] if len(lengths) else 0)
    if len(xr) and len(q) and (lengths.max() * asked.max() >= 2.0 ** 62 or max(lengths.max(), asked.max()) >= 2.0 ** 52):
        raise ValueError("products of these vectors are no exact longs")
    wanted = q.astype(np.int64)
    least = np.where(np.isfinite(floor), floor, -np.inf)
    held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    for at in range(0, len(xr), STEP_ROWS):
        live = np.flatnonzero(asked * lengths[at] + slack >= least)
        if not len(live):
            break
        step = slice(at, at + STEP_ROWS)
        bound = qr[live, :head] @ xr[step, :head].T + np.outer(rest_asked[live], rest[step])
        a, b = np.nonzero(bound + slack[live, None] >= least[live, None])
        a, b = live[a], order[step][b]
        other = ids[b] != own[a]
        a, b = a[other], b[other]
        scores = np.einsum("ij,ij->i", wanted[a], exact[b])
        merged = [np.concatenate(p) for p in zip(held, (a, b, scores), strict=True)]
        held = vector_blocks.top(*merged, ids, k)
        count = np.bincount(held[0], minlength=len(q))
        low = np.full(len(q), np.inf)
        np.minimum.at(low, held[0], held[2].astype(float))
        least = np.maximum(least, np.where(count >= k, low, -np.inf))
    return held
