"""Cutting Arrow batches into slices of bounded bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc


def by_bytes(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, in slices of at most `most` bytes of a column.

    A longer value forms a slice of its own; nulls count as no bytes.
    """
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.concatenate(([0], np.cumsum(sizes.astype(np.int64))))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(ends, ends[first] + most, side="right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield batch.slice(first, last - first)
        first = last
