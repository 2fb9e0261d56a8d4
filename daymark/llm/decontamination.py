"""Benchmark decontamination: words of documents inside windows of benchmark items.

Words are runs of ASCII letters and digits and of all bytes beyond ASCII, A-Z lower-cased. An
item's windows are its runs of WINDOW words; a shorter item, if it has a word, is one window. The
distinct windows form a hash set that is broadcast; tasks roll over the windows of their documents,
look them up, and verify every hit word by word, byte by byte, so hashes decide nothing.

The set's size is checked: items are dealt into portions of PORTION_BYTES at most on average, by a
hash of text and id, so that a text shared by many items is spread as well. One portion is the
usual case; more of them are scanned one after the other, each in a pass of its own over a written
table that carries what was found so far. Documents are never shuffled.

Null and empty texts have no words. An item without words is never hit; an item without an id marks
words but is not listed; rows that repeat an id count as one item. Repeated documents are each
judged. Long texts are scanned in overlapping slices of SLICE_BYTES. Without items nothing is hit.
The caller's other columns are kept, except those named like a result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.functions.storage import pinned
from daymark.llm.names import ROW, others, packed
from daymark.llm.words import mix

WINDOW = 10
#: Bytes of item texts and ids in one broadcast set, and bytes of documents scanned at a time.
PORTION_BYTES, SLICE_BYTES = 16 << 20, 1 << 20
#: Bytes of a word that its hash looks at; verification looks at all.
HASHED = 32
#: Windows that are verified at a time.
CHECKED = 4096
#: Bits of the filter in front of the sorted hashes.
FILTER_BITS = 22
MADE = ("n_words", "n_hit", "spans", "items", "contaminated")
SPANS = "array<struct<first:int,last:int>>"

_LETTERS = np.zeros(256, dtype=bool)
_LETTERS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
with np.errstate(over="ignore"):
    _POWERS = np.cumprod(np.full(HASHED, _FACTOR), dtype=np.uint64)


class Words:
    """Words of neighbouring texts: where they start and stop, their hashes and bounds by text."""

    def __init__(self, data: np.ndarray, edges: np.ndarray):
        self.low = _LOWER[data]
        inside = np.concatenate((_LETTERS[data], [False]))
        fresh = np.concatenate(([True], ~inside[:-1]))
        fresh[edges] = True
        self.starts = np.flatnonzero(inside & fresh)
        over = ~inside
        over[edges] = True
        self.stops = np.flatnonzero(inside[:-1] & over[1:]) + 1
        self.bounds = np.searchsorted(self.starts, edges)
        lengths = self.stops - self.starts
        near = np.minimum(lengths, HASHED)
        first = np.cumsum(near) - near
        place = np.arange(near.sum()) - np.repeat(first, near)
        with np.errstate(over="ignore"):
            terms = (self.low[np.repeat(self.starts, near) + place].astype(np.uint64) + np.uint64(1)) * _POWERS[place]
            sums = np.add.reduceat(terms, first) if len(first) else np.zeros(0, np.uint64)
            self.hashes = mix(sums + lengths.astype(np.uint64) * _FACTOR)

    def windows(self, size: int) -> np.ndarray:
        """Hashes of the runs of `size` words that begin at each word, those across texts included."""
        count = max(0, len(self.hashes) - size + 1)
        total = np.full(count, size, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for i in range(size):
                total = total * _FACTOR + self.hashes[i:i + count]
        return mix(total)

    def within(self, size: int) -> np.ndarray:
        """Words at which a run of `size` words of one text begins."""
        text = np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))
        return np.flatnonzero(text[:len(text) - size + 1] == text[size - 1:]) if len(text) >= size \
            else np.zeros(0, np.int64)


def equal(a: Words, i: np.ndarray, b: Words, j: np.ndarray, size: int) -> np.ndarray:
    """Which windows of `size` words at i of a and at j of b hold the same words."""
    made = np.zeros(len(i), dtype=bool)
    step = np.arange(size)
    for at in range(0, len(i), CHECKED):
        left, right = i[at:at + CHECKED, None] + step, j[at:at + CHECKED, None] + step
        lengths = a.stops[left] - a.starts[left]
        like = np.flatnonzero((lengths == b.stops[right] - b.starts[right]).all(axis=1))
        if not len(like):
            continue
        lengths = lengths[like].ravel()
        first = np.cumsum(lengths) - lengths
        place = np.arange(lengths.sum()) - np.repeat(first, lengths)
        differ = a.low[np.repeat(a.starts[left[like].ravel()], lengths) + place] \
            != b.low[np.repeat(b.starts[right[like].ravel()], lengths) + place]
        wrong = np.logical_or.reduceat(differ, first).reshape(-1, size).any(axis=1)
        made[at + like[~wrong]] = True
    return made


class WindowSet:
    """The distinct windows of a portion of items, by number of words and hash.

    groups: size -> (hashes in order, first word of each window, number of each window);
    items of window w are held[bounds[w]:bounds[w + 1]], places in `names`, which are in order.
    """

    def __init__(self, items: pa.Table):
        blobs = items.column("blob").combine_chunks().cast(pa.large_binary())
        data = b"".join(b.as_py() for b in blobs)
        edges = np.concatenate(([0], np.cumsum([len(b.as_py()) for b in blobs]))).astype(np.int64)
        self.words = Words(np.frombuffer(data, dtype=np.uint8), edges)
        ids = items.column("item").to_pylist()
        self.names = sorted({n for n in ids if n is not None})
        rank = {n: i for i, n in enumerate(self.names)}
        owner = np.array([rank.get(n, -1) for n in ids], dtype=np.int64)
        counts = np.diff(self.words.bounds)
        self.groups, pairs, made = {}, [], 0
        for size in np.unique(np.minimum(counts[counts > 0], WINDOW)).tolist():
            text = np.flatnonzero(counts >= WINDOW if size == WINDOW else counts == size)
            each = counts[text] - size + 1
            start = np.repeat(self.words.bounds[text] - (np.cumsum(each) - each), each) + np.arange(each.sum())
            hashes = self.words.windows(size)[start]
            order = np.argsort(hashes, kind="stable")
            start, hashes, who = start[order], hashes[order], np.repeat(owner[text], each)[order]
            window, heads = np.full(len(start), -1), []
            # Windows of one hash are told apart by their words; one round but for collisions.
            while len(left := np.flatnonzero(window < 0)):
                head = left[np.concatenate(([True], hashes[left][1:] != hashes[left][:-1]))]
                mine = head[np.searchsorted(hashes[head], hashes[left])]
                same = equal(self.words, start[left], self.words, start[mine], size)
                window[left[same]] = made + np.searchsorted(head, mine[same])
                heads.append(np.stack((head, made + np.arange(len(head)))))
                made += len(head)
            head, number = np.concatenate(heads, axis=1)
            order = np.argsort(hashes[head], kind="stable")
            self.groups[size] = hashes[head][order], start[head][order], number[order]
            pairs.append(np.stack((window, who)))
        window, who = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), np.int64)
        window, who = window[who >= 0], who[who >= 0]
        keys = np.unique(window * max(1, len(self.names)) + who)
        self.held = keys % max(1, len(self.names))
        self.bounds = np.searchsorted(keys // max(1, len(self.names)), np.arange(made + 1))
        self.filter = np.zeros(1 << FILTER_BITS, dtype=bool)
        for hashes, _, _ in self.groups.values():
            self.filter[hashes & np.uint64((1 << FILTER_BITS) - 1)] = True

    def hits(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First words of the windows that occur, their sizes and numbers."""
        found = [np.zeros((3, 0), dtype=np.int64)]
        for size, (hashes, start, number) in self.groups.items():
            at = words.within(size)
            own = words.windows(size)[at]
            near = self.filter[own & np.uint64((1 << FILTER_BITS) - 1)]
            at, own = at[near], own[near]
            low, high = np.searchsorted(hashes, own), np.searchsorted(hashes, own, side="right")
            many = high - low
            entry = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(many.sum())
            at = np.repeat(at, many)
            same = equal(words, at, self.words, start[entry], size)
            found.append(np.stack((at[same], np.full(same.sum(), size), number[entry[same]])))
        at, size, number = np.concatenate(found, axis=1)
        return at, size, number

    def items(self, windows: np.ndarray) -> list[str]:
        held = [self.held[self.bounds[w]:self.bounds[w + 1]] for w in np.unique(windows)]
        return [self.names[i] for i in np.unique(np.concatenate(held))] if held else []


def covered(at: np.ndarray, size: np.ndarray, count: int) -> np.ndarray:
    """Which of `count` words lie in one of the runs."""
    steps = np.bincount(at, minlength=count + 1) - np.bincount(at + size, minlength=count + 1)
    return np.cumsum(steps[:count]) > 0


def runs(hit: np.ndarray) -> list[tuple[int, int]]:
    """First and last place of each run of true values."""
    steps = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    return list(zip(np.flatnonzero(steps == 1).tolist(), (np.flatnonzero(steps == -1) - 1).tolist(), strict=True))


def without(text: bytes, words_at: list[tuple[int, int]]) -> bytes:
    """The text without the given ranges of bytes."""
    kept, last = [], 0
    for start, stop in words_at:
        kept.append(text[last:start])
        last = stop
    return b"".join([*kept, text[last:]])


def judged_slice(known: WindowSet, data: np.ndarray, edges: np.ndarray) -> list[tuple]:
    """(words, spans, items, byte ranges of the spans) of whole texts of a slice."""
    words = Words(data, edges)
    at, size, number = known.hits(words)
    hit = covered(at, size, len(words.starts))
    text = np.searchsorted(words.bounds, at, side="right") - 1
    order = np.argsort(text, kind="stable")
    text, number = text[order], number[order]
    made = []
    for i in range(len(edges) - 1):
        first, last = words.bounds[i], words.bounds[i + 1]
        low, high = np.searchsorted(text, [i, i + 1])
        if low == high:
            made.append((int(last - first), [], [], []))
            continue
        spans = runs(hit[first:last])
        ranges = [(int(words.starts[first + a] - edges[i]), int(words.stops[first + b] - edges[i])) for a, b in spans]
        made.append((int(last - first), spans, known.items(number[low:high]), ranges))
    return made


def judged_long(known: WindowSet, data: np.ndarray) -> tuple:
    """As judged_slice for one text longer than a slice, cut between words into overlapping slices."""
    first = done = seen = count = 0
    starts, stops, found = [], [], []
    while done < len(data):
        last = min(done + SLICE_BYTES, len(data))
        while last < len(data):
            gaps = np.flatnonzero(~_LETTERS[data[done:last]])
            if len(gaps):
                last = done + int(gaps[-1]) + 1
                break
            last = min(last + SLICE_BYTES, len(data))
        words = Words(data[first:last], np.array([0, last - first]))
        at, size, number = known.hits(words)
        found.append(np.stack((at + count - seen, size, number)))
        starts.append(first + words.starts[seen:])
        stops.append(first + words.stops[seen:])
        count += len(words.starts) - seen
        # The last words come again at the head of the next slice, where windows may begin in them.
        seen, done = min(WINDOW - 1, len(words.starts)), last
        first = first + int(words.starts[-seen]) if seen else last
    starts, stops = np.concatenate(starts), np.concatenate(stops)
    at, size, number = np.concatenate(found, axis=1)
    spans = runs(covered(at, size, count))
    return count, spans, known.items(number), [(int(starts[a]), int(stops[b])) for a, b in spans]


def judged(known: WindowSet, blobs: pa.Array) -> Iterator[tuple]:
    """(words, spans, items, byte ranges) of every text, in order."""
    blobs = blobs.cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(blobs.buffers()[1], dtype=np.int64)[blobs.offset:][:len(blobs) + 1]
    held = blobs.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(blobs):
        last = int(np.searchsorted(ends, ends[first] + SLICE_BYTES, side="right")) - 1
        if last <= first:
            yield judged_long(known, data[ends[first]:ends[first + 1]])
            first += 1
        else:
            last = min(last, len(blobs))
            yield from judged_slice(known, data[ends[first]:ends[last]], ends[first:last + 1] - ends[first])
            first = last


def decontaminate(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", remove: str | None = None,
                  portion_bytes: int = PORTION_BYTES) -> DataFrame:
    """Documents with n_words, n_hit, spans, items and contaminated.

    spans: first and last of each run of hit words, counted from 0; items: ids, as strings and in
    their order, of the items with a window in the text. remove: None leaves the text column out
    unless it is another name's; "spans" returns texts without their hit runs, "documents" only
    documents without hits, whole.
    """
    if remove not in (None, "spans", "documents"):
        raise ValueError(f"remove: None, 'spans' or 'documents', not {remove!r}")
    spark = docs.sparkSession
    items = benchmark.select(F.col(f"`{item_text}`").cast("binary").alias("blob"),
                             F.col(f"`{item_id}`").cast("string").alias("item")).where("blob IS NOT NULL").distinct()
    size = items.agg(F.sum(F.octet_length("blob") + F.coalesce(F.octet_length("item"), F.lit(0)) + 16)).first()[0]
    portions = max(1, math.ceil((size or 0) / portion_bytes))
    if portions > 1:
        items = pinned(items.withColumn("portion", F.pmod(F.xxhash64("blob", "item"), F.lit(portions))), "items")
    made = [*MADE, text] if remove != "documents" else [*MADE]
    state = docs.select(packed(docs, made), F.col(f"`{text}`").cast("binary").alias("blob"),
                        F.expr(f"CAST(array() AS {SPANS})").alias("spans"),
                        F.expr("CAST(array() AS array<string>)").alias("items"))
    for portion in range(portions):
        mine = items.where(F.col("portion") == portion) if portions > 1 else items
        known = spark.sparkContext.broadcast(WindowSet(mine.select("blob", "item").toArrow()))
        last = portion == portions - 1
        state = scanned(state, known, cut=last and remove == "spans", keep=not last)
        if not last:
            state = pinned(state.drop("n_words"), "scanned")
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    found = state.withColumns({"n_hit": hit, "contaminated": F.size("spans") > 0})
    if remove == "documents":
        found = found.where("NOT contaminated")
    cleaned = [F.col("blob").cast("string").alias(text)] if remove == "spans" else []
    return found.select(*[F.col(f"{ROW}.`{c}`") for c in others(docs, made)], *cleaned, *MADE)


def scanned(state: DataFrame, known, cut: bool, keep: bool) -> DataFrame:
    """The state after one more portion; blob is the cut text, the text, or left out."""
    out = [f for f in state.schema.fields if f.name != "blob" or cut or keep]
    schema = state.select(*[f.name for f in out]).schema.add("n_words", "long")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = batch.column("blob")
            before = zip(batch.column("spans").to_pylist(), batch.column("items").to_pylist(), strict=True)
            counts, spans, items, texts = [], [], [], []
            for row, ((words, own, named, ranges), (old, listed)) in enumerate(
                    zip(judged(known.value, blobs), before, strict=True)):
                if old:
                    hit = np.zeros(words, dtype=bool)
                    for first, past in [*own, *((s["first"], s["last"]) for s in old)]:
                        hit[first:past + 1] = True
                    own = runs(hit)
                    if cut:
                        whole = blobs[row].as_py()
                        places = Words(np.frombuffer(whole, np.uint8), np.array([0, len(whole)]))
                        ranges = [(int(places.starts[a]), int(places.stops[b])) for a, b in own]
                counts.append(words)
                spans.append([{"first": a, "last": b} for a, b in own])
                items.append(sorted({*named, *listed}) if listed else named)
                if cut:
                    texts.append(without(blobs[row].as_py(), ranges) if ranges else blobs[row].as_py())
            columns = {
                "blob": pa.array(texts, pa.binary()) if cut else blobs, ROW: batch.column(ROW),
                "spans": pa.array(spans, pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))),
                "items": pa.array(items, pa.list_(pa.string())), "n_words": pa.array(counts, pa.int64())}
            yield pa.RecordBatch.from_arrays([columns[f.name] for f in schema.fields],
                                             names=[f.name for f in schema.fields])

    return state.mapInArrow(scan, schema)
