"""Approximate nearest neighbours by collision counting over single projections.

Every vector, scaled to length one, is projected on seeded random directions; a block keeps one
sorted array per direction, and the place of each vector in it, built once and asked by all queries.
A query looks at the window around its own projection in each array: the places from its first to
its last vector. Virtual rehashing widens all windows with the search radius, so no array is built
anew. Vectors that lie in the windows of at least a given share of the directions are verified by
their cosine. A search ends when the k best verified vectors lie within the radius, or the windows
span all; once k are verified, no radius goes beyond the k-th of them.

All rows are indexed and every vector over the threshold is verified, whatever their number.
Zero vectors take no part; see vector_blocks for null, odd and repeated rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.functions.storage import pinned
from daymark.llm import vector_blocks

DIRECTIONS, SEED = 64, 20240607
#: Windows reach this many radii to either side; a vector at the radius lies in one with
#: a chance of 0.683, of which a share of MARGIN deviations less is asked.
REACH, CHANCE, MARGIN = 1.0, 0.6827, 2.3
#: The first search radius and the factor from one to the next; distances are at most 2.
FIRST_RADIUS, FACTOR = 0.225, 2.0
#: Vectors whose collisions are counted at a time; error that any order of sums gives a cosine at most.
COUNTED_ROWS, SLACK = 16384, 1e-9


def nearest(rows: DataFrame, asked: DataFrame, k: int = 5, vector_id: str = "vec_id",
            vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score (cosine) of the k nearest rows found for each asked row."""
    def some(df):
        return vector_blocks.usable(df, vector_id, vector).where("exists(v, x -> x != 0)")

    data, queries = some(rows), vector_blocks.asked_once(some(asked))
    _, width, blocks = vector_blocks.shape(data, queries)
    # The written row number spreads copies of a row over blocks.
    block = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(blocks))
    data = pinned(data.withColumn("block", block), "vectors")
    queries = queries.select(vector_blocks.numbers(blocks).alias("blocks"), "vec_id", "v",
                             F.lit(None).cast("double").alias("least"))
    return vector_blocks.search(data, queries, width, blocks, lambda ids, x: Block(ids, x, k), "double", k)


def _scaled(m: np.ndarray) -> np.ndarray:
    """Powers of two change no cosine, and keep squares of very large and small entries in range."""
    return np.ldexp(m, -np.frexp(np.abs(m).max(axis=1))[1][:, None])


class Block:
    """The sorted arrays of one block of vectors; called, it returns verified pairs of queries."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int):
        self.ids, self.x, self.k = ids, _scaled(x), k
        self.lengths = np.sqrt((self.x * self.x).sum(axis=1))
        self.axes = np.random.default_rng(SEED).standard_normal((x.shape[1], DIRECTIONS))
        places = ((self.x / self.lengths[:, None]) @ self.axes).T
        order = np.argsort(places, axis=1, kind="stable")
        self.arrays = np.take_along_axis(places, order, axis=1)
        self.places = np.empty(order.shape, np.uint16 if len(x) < 1 << 16 else np.uint32)
        np.put_along_axis(self.places, order, np.arange(len(x), dtype=self.places.dtype)[None, :], axis=1)
        # Written anew by each query: counted places, whether they lie in the window, verified vectors.
        self.shifted = np.empty((DIRECTIONS, min(len(x), COUNTED_ROWS)), self.places.dtype)
        self.inside, self.taken = np.empty(self.shifted.shape, bool), np.empty(self.x.shape)

    def __call__(self, own: np.ndarray, q: np.ndarray, least: np.ndarray):
        q = _scaled(q)
        asked = np.sqrt((q * q).sum(axis=1))
        looked = ((q / asked[:, None]) @ self.axes).T
        return collisions(self, own, q, asked, looked)


def counted(block: Block, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """In how many windows each vector lies; a window is the places from lower to below upper."""
    lower, size = (m.astype(block.places.dtype)[:, None] for m in (lower, upper - lower))
    counts = np.empty(len(block.x), np.uint8)
    for at in range(0, len(counts), COUNTED_ROWS):
        places = block.places[:, at:at + COUNTED_ROWS]
        # Places below the window wrap around to numbers beyond its size.
        shifted = np.subtract(places, lower, out=block.shifted[:, :places.shape[1]])
        inside = np.less(shifted, size, out=block.inside[:, :places.shape[1]])
        np.add.reduce(inside.view(np.uint8), axis=0, dtype=np.uint8, out=counts[at:at + COUNTED_ROWS])
    return counts


def verified(block: Block, rows: np.ndarray, q: np.ndarray, asked: float) -> tuple[np.ndarray, float]:
    """The rows that can be among the k of largest cosine, and the k-th cosine, -inf with fewer rows."""
    taken = np.take(block.x, rows, axis=0, out=block.taken[:len(rows)], mode="clip")
    cosine = (taken @ q) / (block.lengths[rows] * asked)
    if len(rows) < block.k:
        return rows, -np.inf
    least = np.partition(cosine, -block.k)[-block.k]
    return rows[cosine >= least - SLACK], least


def collisions(block: Block, own: np.ndarray, q: np.ndarray, asked: np.ndarray, looked: np.ndarray):
    """Pairs (query, row, cosine) of one block, the k best verified ones; looked: projections of the queries."""
    ids, x, lengths, k = block.ids, block.x, block.lengths, block.k
    needed = DIRECTIONS * (CHANCE - MARGIN * np.sqrt(CHANCE * (1 - CHANCE) / DIRECTIONS))
    radius = np.full(len(q), FIRST_RADIUS)
    open_, found = np.arange(len(q)), [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    while len(open_):
        windows = radius[open_] * REACH
        around = [(np.searchsorted(a, p - windows), np.searchsorted(a, p + windows, side="right"))
                  for a, p in zip(block.arrays, looked[:, open_], strict=True)]
        lower, upper = (np.stack(ends) for ends in zip(*around, strict=True))
        done = (lower == 0).all(axis=0) & (upper == len(x)).all(axis=0)
        for n, i in enumerate(open_):
            rows = np.flatnonzero(counted(block, lower[:, n], upper[:, n]) >= needed)
            rows, least = verified(block, rows[ids[rows] != own[i]], q[i], asked[i])
            done[n] |= least >= 1 - radius[i] * radius[i] / 2
            if done[n]:
                # Sums in one order for all rows, so that copies of a vector tie.
                cosine = (x[rows] * q[i]).sum(axis=1) / (lengths[rows] * asked[i])
                found.append(vector_blocks.top(np.full(len(rows), i), rows, cosine, ids, k))
            # The distance of the k-th verified vector, widened by more than its rounding error.
            radius[i] = min(radius[i] * FACTOR, np.sqrt(max(0.0, 2 - 2 * least)) + SLACK)
        open_ = open_[~done]
    return tuple(np.concatenate(part) for part in zip(*found, strict=True))
