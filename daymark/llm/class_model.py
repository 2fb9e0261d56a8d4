"""Scores of a Brown class-based bigram model.

A text's tokens are its words and one end. Exchange clustering assigns words to classes, each word
to the class that raises the likelihood of the class bigrams most, in two steps that use the same
gain. First the frequent words, each at least UNIT_SHARE of the training tokens (so never more than
1 / UNIT_SHARE), are exchanged in rounds, together with one unit for the other words of each of TAILS
endings (last three bytes). Then every other word seen MIN_COUNT times or more leaves its ending and
is exchanged on its own, as a row with the classes around each of its occurrences. These rows are
dealt by word into partitions whose number grows with the vocabulary; no such word is hot, as the
frequent ones are not among them. Rarer words keep the class of their ending. In both steps all
partitions start from the same exact class counts and exchange their own words one step after the
other; the counts are then made anew from the texts, and the best assignment seen is kept.

The probability of a token is that of its class after the class of the token before (the end
before the first word) times that of the word within its class, both smoothed by constants, so the
known words and one unknown word of every class sum to one. Counts cover all training tokens of
all documents. Word counts and classes are joined, never broadcast: documents are dealt into blocks,
each block's distinct words meet the table of words, and come back to the block. A block writes the
classes of its texts, a byte a token; class bigrams and scores follow from these.

Words are 64-bit hashes (see words). Null and empty texts have the end as their only token. A null
id hashes like an empty one. Repeated rows each count and are each scored. Columns other than the id
and the text are not returned, whatever their names. Without training tokens every class and word
has its smoothed share alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.functions.storage import pinned
from daymark.llm.batches import by_bytes
from daymark.llm.words import Hasher

CLASSES, ROUNDS = 32, 5
UNIT_SHARE, TAILS = 5e-5, 1024
#: Occurrences from which a word is exchanged on its own; words that see the same class counts.
MIN_COUNT, STEP = 5, 64
SMOOTH_WORD, SMOOTH_CLASS = 0.1, 0.5
#: Text bytes in a block of documents, on average; tokens or words that a task counts at a time.
BLOCK_BYTES, HELD_ROWS = 8 << 20, 2_000_000
#: Distinct words in a partition of words, and pairs of units in a partition of units, on average.
PART_WORDS, PART_PAIRS = 50_000, 250_000


class Units:
    """Units of words: 0 for the end, then the frequent words by hash, then the tails."""

    def __init__(self, words: np.ndarray):
        self.words = np.sort(words.astype(np.uint64))
        self.count = 1 + len(words) + TAILS

    def of(self, words: np.ndarray, tails: np.ndarray) -> np.ndarray:
        unit = 1 + len(self.words) + (tails % np.uint64(TAILS)).astype(np.int64)
        if len(self.words):
            at = np.minimum(np.searchsorted(self.words, words), len(self.words) - 1)
            unit = np.where(self.words[at] == words, 1 + at, unit)
        return unit


def word_counts(docs: DataFrame) -> DataFrame:
    """word, tail and the number n of training tokens, the ends of texts left out."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(tails=True)
        waiting: list[tuple] = []

        def rows():
            words, tails, times = (np.concatenate(x) for x in zip(*waiting, strict=True))
            found, first, place = np.unique(words, return_index=True, return_inverse=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.array(tails[first].view(np.int64)),
                 pa.array(np.bincount(place, times, len(found)).astype(np.int64))], names=["word", "tail", "n"])

        for batch in batches:
            for part in hasher.slices(batch.column("blob")):
                words, first, times = np.unique(part.words, return_index=True, return_counts=True)
                waiting.append((words, part.tails[first], times))
                if sum(len(x[0]) for x in waiting) > HELD_ROWS:
                    yield rows()
                    waiting = []
        if waiting:
            yield rows()

    return docs.where("NOT held_out").select("blob").mapInArrow(count, "word long, tail long, n long") \
        .groupBy("word").agg(F.first("tail").alias("tail"), F.sum("n").alias("n"))


def unit_pairs(docs: DataFrame, units: Units) -> DataFrame:
    """Pairs of neighbouring units in training texts, with the end before and behind each text."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(tails=True)
        waiting: list[np.ndarray] = []

        def rows():
            keys, times = np.unique(np.concatenate(waiting), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys // units.count), pa.array(keys % units.count),
                                               pa.array(times)], names=["u", "v", "n"])

        for batch in batches:
            for part in hasher.slices(batch.column("blob")):
                unit = np.insert(units.of(part.words, part.tails), part.bounds[1:], 0)
                waiting.append(np.concatenate(([0], unit[:-1])) * units.count + unit)
                if sum(map(len, waiting)) > HELD_ROWS:
                    yield rows()
                    waiting = []
        if waiting:
            yield rows()

    return docs.where("NOT held_out").select("blob").mapInArrow(count, "u long, v long, n long") \
        .groupBy("u", "v").agg(F.sum("n").alias("n"))


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def likelihood(matrix: np.ndarray) -> float:
    """What of the log-likelihood of class bigrams depends on the classes."""
    return float(_xlogx(matrix).sum() - _xlogx(matrix.sum(axis=0)).sum() - _xlogx(matrix.sum(axis=1)).sum())


def best_classes(out: np.ndarray, into: np.ndarray, own: np.ndarray, now: np.ndarray,
                 matrix: np.ndarray) -> np.ndarray:
    """The best class of each of several words, each moved alone against the same class counts.

    out and into: a row per word with its counts before and behind each class, its own class's with
    its own repetitions `own`. Class 0 belongs to the end.
    """
    row = np.arange(len(now))
    rest = np.repeat(matrix[None], len(now), axis=0)
    rest[row, now] -= out
    rest[row, :, now] -= into
    rest[row, now, now] += own
    out, into = out.copy(), into.copy()
    out[row, now] -= own
    into[row, now] -= own
    base = _xlogx(rest)
    ahead, behind = _xlogx(rest + out[:, None, :]) - base, _xlogx(rest + into[:, :, None]) - base
    cell, still, late, early = (np.diagonal(x, axis1=1, axis2=2) for x in (rest, base, ahead, behind))
    gain = ahead.sum(axis=2) + behind.sum(axis=1) - late - early + _xlogx(cell + out + into + own[:, None]) - still
    rows, columns = rest.sum(axis=2) + into, rest.sum(axis=1) + out
    after, before = (out.sum(axis=1) + own)[:, None], (into.sum(axis=1) + own)[:, None]
    gain -= _xlogx(rows + after) - _xlogx(rows) + _xlogx(columns + before) - _xlogx(columns)
    gain[:, 0] = -np.inf
    return np.where(gain.max(axis=1) > gain[row, now] + 1e-9, gain.argmax(axis=1), now)


def _move(matrix: np.ndarray, out: np.ndarray, into: np.ndarray, own: float, now: int, new: int) -> None:
    """Moves one word's counts between classes in place."""
    matrix[now] -= out
    matrix[:, now] -= into
    matrix[now, now] += own
    out, into = out.copy(), into.copy()
    for side in (out, into):
        side[now] -= own
    matrix[new] += out
    matrix[:, new] += into
    matrix[new, new] += own


def exchanged(out: np.ndarray, into: np.ndarray, own: float, now: int, matrix: np.ndarray) -> int:
    """The best class of one word, as in best_classes; the matrix follows the move in place."""
    new = int(best_classes(out[None], into[None], np.array([own]), np.array([now]), matrix)[0])
    _move(matrix, out, into, own, now, new)
    return new


def cluster(pairs: DataFrame, units: Units) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all units, and the counts of class bigrams.

    The driver holds a class per unit and the class counts, both of fixed size.
    """
    sides = pairs.select(F.col("u").alias("unit"), F.col("v").alias("other"), F.col("n").alias("ahead"),
                         F.lit(0).cast("long").alias("behind")).unionByName(
        pairs.select(F.col("v").alias("unit"), F.col("u").alias("other"),
                     F.lit(0).cast("long").alias("ahead"), F.col("n").alias("behind")))
    parts = max(1, math.ceil(2 * pairs.count() / PART_PAIRS))
    part = F.pmod(F.xxhash64("unit"), F.lit(parts)).cast("int")
    table = pinned(sides.groupBy("unit", "other").agg(F.sum("ahead").alias("ahead"), F.sum("behind").alias("behind"))
                   .withColumn("part", part).repartition("part"), "units")
    classes = np.concatenate(([0], 1 + np.arange(units.count - 1) % (CLASSES - 1)))
    best, score = classes, -math.inf
    for turn in range(ROUNDS + 1):
        matrix = counted(pairs, classes)
        if likelihood(matrix) > score:
            best, score, kept = classes, likelihood(matrix), matrix
        if turn < ROUNDS:
            classes = proposals(table, classes, matrix)
    return best, kept


def counted(pairs: DataFrame, classes: np.ndarray) -> np.ndarray:
    """Counts of class bigrams."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES * CLASSES)
        for batch in batches:
            u, v, n = (c.to_numpy() for c in batch.columns)
            total += np.bincount(classes[u] * CLASSES + classes[v], n, CLASSES * CLASSES)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells].astype(np.int64))],
                                         names=["cell", "n"])

    found = pairs.select("u", "v", "n").mapInArrow(count, "cell long, n long") \
        .groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    matrix = np.zeros(CLASSES * CLASSES)
    matrix[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return matrix.reshape(CLASSES, CLASSES)


def proposals(table: DataFrame, classes: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """Classes after every partition has exchanged its own units, most frequent first."""
    def move(rows: pa.Table) -> pa.Table:
        unit, other, ahead, behind = (rows.column(c).to_numpy() for c in ("unit", "other", "ahead", "behind"))
        order = np.argsort(unit, kind="stable")
        unit, other, ahead, behind = (x[order] for x in (unit, other, ahead, behind))
        names, first = np.unique(unit, return_index=True)
        bounds = np.append(first, len(unit))
        mine, current = matrix.copy(), classes.copy()
        weight = np.add.reduceat(ahead, first) if len(names) else ahead
        for i in np.argsort(-weight, kind="stable"):
            if names[i] == 0:
                continue
            near = slice(bounds[i], bounds[i + 1])
            of = current[other[near]]
            out, into = (np.bincount(of, x[near], CLASSES) for x in (ahead, behind))
            own = float(ahead[near][other[near] == names[i]].sum())
            current[names[i]] = exchanged(out, into, own, int(current[names[i]]), mine)
        new = current[names]
        return pa.table({"unit": pa.array(names), "class": pa.array(new)})

    found = table.groupBy("part").applyInArrow(move, "unit long, class long").toArrow()
    made = classes.copy()
    made[found.column("unit").to_numpy()] = found.column("class").to_numpy()
    return made


def contexts(docs: DataFrame, units: Units, classes: np.ndarray) -> DataFrame:
    """word, class and cells: the classes around occurrences of words that are no units of their own.

    A cell is two bytes: the class behind the occurrence, plus 64 if the same word follows, and the
    class before it. A task gives a word once for about HELD_ROWS tokens.
    """
    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(tails=True)
        waiting: list[tuple] = []

        def rows():
            words, own, cells = (np.concatenate(x) for x in zip(*waiting, strict=True))
            order = np.argsort(words, kind="stable")
            found, first = np.unique(words[order], return_index=True)
            offsets = pa.array(2 * np.append(first, len(words)), pa.int32())
            packed = pa.Array.from_buffers(pa.binary(), len(found), [None, offsets.buffers()[1], pa.py_buffer(
                np.ascontiguousarray(cells[order]))])
            return pa.RecordBatch.from_arrays(
                [pa.array(found.view(np.int64)), pa.array(own[order][first]), packed], names=["word", "class", "cells"])

        for batch in batches:
            for part in hasher.slices(batch.column("blob")):
                unit = np.insert(units.of(part.words, part.tails), part.bounds[1:], 0)
                words = np.insert(part.words, part.bounds[1:], np.uint64(0))
                own = classes[unit].astype(np.int32)
                at = np.flatnonzero(unit > len(units.words))
                # An end follows every word, so there is a token behind each.
                again = (words[at] == words[at + 1]) & (unit[at + 1] > len(units.words))
                cells = np.empty((len(at), 2), np.uint8)
                cells[:, 0] = own[at + 1] + 64 * again
                cells[:, 1] = np.where(at > 0, own[at - 1], 0)
                waiting.append((words[at], own[at], cells))
                if sum(len(x[0]) for x in waiting) > HELD_ROWS:
                    yield rows()
                    waiting = []
        if waiting:
            yield rows()

    return docs.where("NOT held_out").select("blob").mapInArrow(gather, "word long, class int, cells binary")


_CODES = 2 * CLASSES + 1  # classes behind, classes before, the word itself behind


def _summed(words: np.ndarray, codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found, place = np.unique(words, return_inverse=True)
    cell, at = np.unique(place * (_CODES + CLASSES) + codes, return_inverse=True)
    return found[cell // (_CODES + CLASSES)], cell % (_CODES + CLASSES), np.bincount(at, times, len(cell))


def exchanged_words(cells: DataFrame, kinds: int, matrix: np.ndarray | None) -> DataFrame:
    """word, n and class of all words with contexts, after an exchange of those seen MIN_COUNT times.

    Without class counts none is exchanged. A partition holds sums by word and neighbouring class, never the occurrences.
    """
    def exchange(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        waiting = [held]
        for batch in batches:
            words, own, packed = (batch.column(c) for c in ("word", "class", "cells"))
            words, own = words.to_numpy(), own.to_numpy().astype(np.int64)
            ends = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset:][: len(packed) + 1]
            pair = np.frombuffer(packed.buffers()[2], np.uint8)[ends[0]:ends[-1]].reshape(-1, 2).astype(np.int64)
            each = np.repeat(words, np.diff(ends) // 2)
            again = each[pair[:, 0] >= 64]
            names = np.concatenate((each, each, again, words))
            codes = np.concatenate((pair[:, 0] % 64, CLASSES + pair[:, 1], np.full(len(again), 2 * CLASSES), _CODES + own))
            waiting.append(_summed(names, codes, np.ones(len(codes))))
            if sum(len(x[0]) for x in waiting[1:]) > HELD_ROWS:
                waiting = [_summed(*(np.concatenate(x) for x in zip(*waiting, strict=True)))]
        words, codes, times = _summed(*(np.concatenate(x) for x in zip(*waiting, strict=True)))
        names, place = np.unique(words, return_inverse=True)
        n = np.bincount(place, np.where(codes < CLASSES, times, 0), len(names)).astype(np.int64)
        now = np.zeros(len(names), np.int64)
        now[place[codes >= _CODES]] = codes[codes >= _CODES] - _CODES
        bounds = np.append(np.searchsorted(place, np.arange(len(names))), len(place))
        often = np.argsort(-n, kind="stable")[: int((n >= MIN_COUNT).sum()) if matrix is not None else 0]
        mine = matrix.copy() if matrix is not None else matrix
        for start in range(0, len(often), STEP):
            chosen = often[start:start + STEP]
            dense = np.zeros((len(chosen), _CODES + CLASSES))
            for i, w in enumerate(chosen):
                near = slice(bounds[w], bounds[w + 1])
                dense[i, codes[near]] = times[near]
            out, into, own = dense[:, :CLASSES], dense[:, CLASSES:2 * CLASSES], dense[:, 2 * CLASSES]
            new = best_classes(out, into, own, now[chosen], mine)
            for i in np.flatnonzero(new != now[chosen]):
                _move(mine, out[i], into[i], own[i], now[chosen[i]], new[i])
            now[chosen] = new
        for start in range(0, len(names), HELD_ROWS):
            part = slice(start, start + HELD_ROWS)
            yield pa.RecordBatch.from_arrays([pa.array(names[part]), pa.array(n[part]), pa.array(now[part])],
                                             names=["word", "n", "class"])

    return cells.repartition(max(1, math.ceil(kinds / PART_WORDS)), "word") \
        .mapInArrow(exchange, "word long, n long, class long")


@dataclass
class Model:
    """words: word, n and class of every training word; classes: those of units, for words not seen.

    matrix: counts of class bigrams; texts: the scored texts with the classes of their tokens.
    """

    words: DataFrame
    units: Units
    classes: np.ndarray
    matrix: np.ndarray
    texts: DataFrame


def learned(given: DataFrame) -> Model:
    """The model of the rows (doc_id, held_out, blob) that are not held out."""
    sizes = given.agg(F.sum(F.octet_length("blob")).alias("bytes"),
                      F.count(F.when(~F.col("held_out"), 1)).alias("texts")).first()
    table = pinned(word_counts(given), "words")
    totals = table.agg(F.sum("n"), F.count("*")).first()
    tokens, kinds = (totals[0] or 0) + sizes.texts, totals[1] + (sizes.texts > 0)
    frequent = table.where(F.col("n") >= F.greatest(F.lit(2), F.lit(UNIT_SHARE * tokens))) \
        .select("word", "n").toArrow()
    units = Units(frequent.column("word").to_numpy().view(np.uint64))
    pairs = pinned(unit_pairs(given, units), "pairs")
    classes, matrix = cluster(pairs, units)
    named = given.sparkSession.createDataFrame(pa.table({
        "word": frequent.column("word"), "n": frequent.column("n"),
        "class": pa.array(classes[units.of(frequent.column("word").to_numpy().view(np.uint64),
                                           np.zeros(frequent.num_rows, np.uint64))], pa.int64())})) \
        if frequent.num_rows else given.sparkSession.createDataFrame([], "word long, n long, class long")
    cells = contexts(given, units, classes)
    words = pinned(exchanged_words(cells, kinds, matrix).unionByName(named), "classes")
    texts = pinned(followed(given, words, units, classes, sizes, tokens, kinds), "paths")
    after = class_bigrams(texts)
    if likelihood(after) < likelihood(matrix):
        # Partitions that moved at once have spoiled each other: back to the classes of endings.
        words = pinned(exchanged_words(cells, kinds, None).unionByName(named), "classes")
        texts = pinned(followed(given, words, units, classes, sizes, tokens, kinds), "paths")
        after = class_bigrams(texts)
    return Model(words, units, classes, after, texts)


def followed(given: DataFrame, words: DataFrame, units: Units, classes: np.ndarray, sizes, tokens: int,
             kinds: int) -> DataFrame:
    """The classes of every text's tokens, and what of its score needs no class bigrams."""
    found = words.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).toArrow()
    mass, spread = np.zeros(CLASSES), np.zeros(CLASSES)
    mass[found.column("class").to_numpy()] = found.column("n").to_numpy()
    spread[found.column("class").to_numpy()] = found.column("kinds").to_numpy()
    ends = sizes.texts
    mass[0], spread[0] = ends, float(ends > 0)
    below = mass + SMOOTH_WORD * (spread + 1)
    all_below = tokens + SMOOTH_WORD * (kinds + 1)

    blocks = max(1, math.ceil((sizes.bytes or 0) / BLOCK_BYTES))
    dealt = given.withColumn("block", F.pmod(F.xxhash64("doc_id", "blob"), F.lit(blocks)))
    # Texts reach both the listing of words and the walk through them by one exchange.
    dealt = dealt.repartition("block")

    def listed(rows: pa.Table) -> pa.Table:
        hasher, held = Hasher(), np.zeros(0, np.uint64)
        for part in hasher.slices(rows.column("blob").combine_chunks()):
            held = np.union1d(held, part.words)
        return pa.table({"block": pa.array(np.full(len(held), rows.column("block")[0].as_py())),
                         "word": pa.array(held.view(np.int64))})

    def walked(rows: pa.Table, known: pa.Table) -> pa.Table:
        hasher = Hasher(tails=True)
        names = known.column("word").to_numpy().view(np.uint64)
        order = np.argsort(names)
        names = names[order]
        times, own_class = (known.column(c).to_numpy()[order] for c in ("n", "class"))
        columns = {name: [] for name in ("n_tokens", "n_known", "base_score", "word_score")}
        path = []
        for part in hasher.slices(rows.column("blob").combine_chunks()):
            own = classes[units.of(part.words, part.tails)]
            count = np.zeros(len(part.words))
            if len(names):
                at = np.minimum(np.searchsorted(names, part.words), len(names) - 1)
                same = names[at] == part.words
                count, own = np.where(same, times[at], 0.0), np.where(same, own_class[at], own)
            own = np.insert(own, part.bounds[1:], 0)
            count = np.insert(count, part.bounds[1:], float(ends))
            last = part.bounds[1:] + np.arange(part.rows)
            first = part.bounds[:-1] + np.arange(part.rows)
            base = np.log10((count + SMOOTH_WORD) / all_below)
            word = np.log10((count + SMOOTH_WORD) / below[own])
            for name, values in (("n_known", (count > 0).astype(np.int64)), ("base_score", base), ("word_score", word)):
                columns[name].append(np.add.reduceat(values, first) if part.rows else values[:0])
            columns["n_tokens"].append(last - first + 1)
            path.append(own.astype(np.uint8))
        made = {n: np.concatenate(v) if v else np.zeros(0) for n, v in columns.items()}
        bounds = pa.array(np.concatenate(([0], np.cumsum(made["n_tokens"]))), pa.int64())
        packed = pa.Array.from_buffers(pa.large_binary(), rows.num_rows, [None, bounds.buffers()[1], pa.py_buffer(
            np.concatenate(path) if path else np.zeros(0, np.uint8))])
        return pa.table({
            "doc_id": rows.column("doc_id"), "held_out": rows.column("held_out"),
            "n_tokens": pa.array(made["n_tokens"], pa.int64()), "n_known": pa.array(made["n_known"], pa.int64()),
            "train_tokens": pa.array(np.full(rows.num_rows, tokens), pa.int64()),
            "base_score": pa.array(made["base_score"], pa.float64()),
            "word_score": pa.array(made["word_score"], pa.float64()), "path": packed.cast(pa.binary())})

    near = dealt.groupBy("block").applyInArrow(listed, "block long, word long").join(words, "word")
    kind = dealt.schema["doc_id"].dataType.simpleString()
    return dealt.groupBy("block").cogroup(near.groupBy("block")).applyInArrow(
        walked, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                "base_score double, word_score double, path binary")


def _steps(paths: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Class bigrams of a column of paths, as cells of the matrix, and where each path begins."""
    ends = np.frombuffer(paths.buffers()[1], np.int32)[paths.offset:][: len(paths) + 1]
    own = np.frombuffer(paths.buffers()[2], np.uint8)[ends[0]:ends[-1]].astype(np.int64)
    # The last class of every path is the end's, 0, and so is the one before each path.
    return np.concatenate(([0], own[:-1])) * CLASSES + own, ends[:-1] - ends[0]


def class_bigrams(texts: DataFrame) -> np.ndarray:
    """Counts of class bigrams in the training texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CLASSES * CLASSES, np.int64)
        for batch in batches:
            for part in by_bytes(batch, "path", HELD_ROWS):
                total += np.bincount(_steps(part.column("path"))[0], minlength=len(total))
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(total[cells])], names=["cell", "n"])

    found = texts.where("NOT held_out").select("path").mapInArrow(count, "cell long, n long") \
        .groupBy("cell").agg(F.sum("n").alias("n")).toArrow()
    matrix = np.zeros(CLASSES * CLASSES)
    matrix[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return matrix.reshape(CLASSES, CLASSES)


def score_texts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document.

    Held out from learning are documents whose crc32 of the id as text is divisible by ten.
    base_score is the smoothed unigram log10 probability, score the class model's.
    """
    model = learned(prepared(docs, doc_id, text))
    matrix = model.matrix
    before = np.log10((matrix + SMOOTH_CLASS) / (matrix.sum(axis=1, keepdims=True) + SMOOTH_CLASS * CLASSES)).ravel()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "path", HELD_ROWS):
                steps, first = _steps(part.column("path"))
                made = np.add.reduceat(before[steps], first) + part.column("word_score").to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in kept), pa.array(made, pa.float64())], names=[*kept, "score"])

    kept = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score"]
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in model.texts.select(kept).schema)
    return model.texts.select(*kept, "word_score", "path").mapInArrow(score, f"{fields}, score double")


def prepared(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out and the bytes of each text."""
    key = F.crc32(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")))
    return docs.select(F.col(f"`{doc_id}`").alias("doc_id"), (key % 10 == 0).alias("held_out"),
                       F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b"")).alias("blob"))
