"""Token counts of whole texts with a public tokenizer file.

Texts reach the tokenizer in slices of bounded bytes. Each text is cut at safe boundaries, which
are single spaces between two visible characters: byte-level vocabularies start a new unit there
whatever stands around, so the counts of the parts add up to the count of the text. Of each slice
only the distinct parts are encoded, in one call, and only their lengths leave the function.

Null and empty texts have no tokens. A text without a safe boundary is encoded whole. Repeated
rows each get their count; other columns are kept as they are, except those named like the
results, which the results replace.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.llm.batches import by_bytes
from daymark.llm.names import others

SLICE_BYTES = 1 << 20
#: Parts whose lengths a task remembers between slices, the first ones it meets; the longest of them.
KEPT_PARTS, KEPT_CHARS = 500_000, 40

_BOUNDARY = re.compile(r"(?<=[!-~\w])(?= [!-~\w])")


class Counter:
    """Counts tokens of texts; remembers the lengths of short parts."""

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, int] = {}

    def counts(self, texts: list[str]) -> list[int]:
        parts = [_BOUNDARY.split(text) if text else [] for text in texts]
        fresh = list({part: None for own in parts for part in own if part not in self.known})
        found = self.tokenizer.encode_batch_fast(fresh, add_special_tokens=False)
        lengths = self.known
        lengths.update(zip(fresh, map(len, found), strict=True))
        totals = [sum(map(lengths.__getitem__, own)) for own in parts]
        room = KEPT_PARTS - len(lengths) + len(fresh)
        for i, part in enumerate(fresh):
            if i >= room or len(part) > KEPT_CHARS:
                del lengths[part]
        return totals


def token_counts(docs: DataFrame, path: str, text: str = "text", limit: int = 512) -> DataFrame:
    """The rows with n_bytes, n_tokens and over_limit (more than `limit` tokens).

    path: a file of the tokenizers library whose vocabulary is byte-level; executors read it.
    The text itself is not returned.
    """
    made = {"n_bytes": T.LongType(), "n_tokens": T.LongType(), "over_limit": T.BooleanType()}
    kept = others(docs, (*made, text))
    given = docs.select(*[F.col(f"`{c}`") for c in kept],
                        F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b"")).alias("n_bytes"))
    schema = T.StructType([*given.drop("n_bytes").schema.fields,
                           *[T.StructField(n, t, False) for n, t in made.items()]])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path)
        for batch in batches:
            for part in by_bytes(batch, "n_bytes", SLICE_BYTES):
                blobs = part.column("n_bytes").to_pylist()
                tokens = counter.counts([b.decode("utf-8", "replace") for b in blobs])
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in kept], pa.array(map(len, blobs), pa.int64()),
                     pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens])],
                    names=[*kept, *made])

    return given.mapInArrow(count, schema)
