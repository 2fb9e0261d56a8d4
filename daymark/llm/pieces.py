"""SentencePiece ids of whole texts, and texts of ids, by a table of distinct marked words.

A marked word is a run of white-space markers with the characters up to the next one. Where no
piece of a model has a marker behind another character, no merge can cross into the next marked
word, so a text's ids are the ids of its marked words in order. Each slice of texts is cut into
marked words; every distinct one is segmented once, and ids and decoded parts are joined back by
position. Models with pieces across words are refused, so results never differ from the library's.

Null texts count as empty; an empty text has the end id alone and decodes to an empty text.
Repeated rows each get their result. Columns named like a result are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.llm.batches import by_bytes
from daymark.llm.names import others

SLICE_BYTES = 1 << 20
#: Marked words that a task keeps between slices, the first ones it meets; the longest of them.
KEPT_WORDS, KEPT_CHARS = 500_000, 40
MARK = "▁"

_WORD = re.compile(f"{MARK}+[^{MARK}]*")


def _spread(table: np.ndarray, begin: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The entries of the named rows of a table, one row after the other, and where each row ends."""
    length = begin[rows + 1] - begin[rows]
    close = np.cumsum(length)
    shift = begin[rows] - (close - length)
    return table[np.repeat(shift, length) + np.arange(close[-1] if len(close) else 0)], close


class WordTable:
    """Ids of distinct marked words of one model; row 0 holds the end id."""

    def __init__(self, path: str):
        import sentencepiece

        model = self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        names = [model.id_to_piece(i) for i in range(size)]
        if any(MARK in n.lstrip(MARK) for i, n in enumerate(names) if not model.is_control(i)):
            raise ValueError("the model has pieces that cross white-space markers")
        self.codes: dict[str, int] = {"": 0}
        self.ids = np.array([model.eos_id()], np.int32)
        self.begin = np.array([0, 1])
        blobs = [b"" if model.is_control(i) else bytes([int(n[1:-1], 16)]) if model.is_byte(i)
                 else n.replace(MARK, " ").encode() for i, n in enumerate(names)]
        self.bytes = np.frombuffer(b"".join(blobs), np.uint8)
        self.bytes_begin = np.concatenate(([0], np.cumsum([len(b) for b in blobs])))

    def add(self, words: list[str]):
        """Segment new marked words, each as a text whose first marker the model adds by itself."""
        found = self.model.encode([word[1:] for word in words], num_threads=1)
        alone = [self.model.piece_to_id(MARK)]
        found = [ids if len(word) > 1 else alone for word, ids in zip(words, found, strict=True)]
        self.codes.update(zip(words, range(len(self.codes), len(self.codes) + len(words)), strict=True))
        ends = self.begin[-1] + np.cumsum([len(ids) for ids in found], dtype=np.int64)
        self.begin = np.concatenate((self.begin, ends))
        self.ids = np.concatenate((self.ids, np.fromiter(chain.from_iterable(found), np.int32)))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each closed by the end id, and their bounds."""
        words = [[*_WORD.findall(MARK + text.replace(" ", MARK)), ""] if text else [""]
                 for text in texts]
        flat = list(chain.from_iterable(words))
        held = len(self.codes)
        fresh = sorted({w for w in flat if w not in self.codes},
                       key=lambda w: len(w) > KEPT_CHARS)
        self.add(fresh)
        rows = np.fromiter(map(self.codes.__getitem__, flat), np.int64, len(flat))
        ids, close = _spread(self.ids, self.begin, rows)
        last = np.cumsum([len(own) for own in words], dtype=np.int64) - 1
        short = next((i for i, w in enumerate(fresh) if len(w) > KEPT_CHARS), len(fresh))
        kept = min(held + short, max(held, KEPT_WORDS))
        for word in fresh[kept - held:]:
            del self.codes[word]
        self.begin = self.begin[:kept + 1]
        self.ids = self.ids[:self.begin[-1]]
        return ids, np.concatenate(([0], close[last]))

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of the texts of lists of ids, without the space of the first marker."""
        data, close = _spread(self.bytes, self.bytes_begin, ids.astype(np.int64))
        ends = np.concatenate(([0], close))[bounds]
        filled = ends[1:] > ends[:-1]
        keep = np.ones(len(data), dtype=bool)
        first = ends[:-1][filled]
        keep[first[data[first] == 32]] = False
        return data[keep], np.concatenate(([0], np.cumsum(keep)))[ends]


def encode_decode(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """The rows with ids (array of int, closed by the end id) and decoded (string).

    path: a SentencePiece model; executors read it. The original text is not returned.
    """
    made = {"ids": T.ArrayType(T.IntegerType(), False), "decoded": T.StringType()}
    kept = others(docs, (*made, text))
    given = docs.select(*[F.col(f"`{c}`") for c in kept],
                        F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b"")).alias("ids"))
    schema = T.StructType([*given.drop("ids").schema.fields,
                           *[T.StructField(n, t, False) for n, t in made.items()]])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable(path)
        for batch in batches:
            for part in by_bytes(batch, "ids", SLICE_BYTES):
                texts = [b.decode("utf-8", "replace") for b in part.column("ids").to_pylist()]
                ids, bounds = table.encode(texts)
                data, ends = table.decode(ids, bounds)
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
                decoded = pa.Array.from_buffers(pa.string(), len(texts), [
                    None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], lists, decoded],
                                                 names=[*kept, *made])

    return given.mapInArrow(encode, schema)


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, the number of ids, and SHA-256 digests of ids and decoded text."""
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
