"""Operators on texts against the libraries, brute force and odd rows."""

import hashlib
import math
import os
import random
import re
import subprocess
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from public_tokenizers import path as tokenizer
from pyspark.sql import functions as F

from daymark.llm import (class_model, mixing, near_duplicates, pieces, pseudonyms, token_counts,
                         toxicity)
from daymark.llm.catalog import QUERIES
from daymark.llm.words import Hasher, shingles

WORD = re.compile("[^\x20\x09-\x0d]+")
PARTS = ["a", "b", " ", "  ", "\n", "\t", "<|endoftext|>", "'s", "1", "22", "▁", "é", "\u3000", "\xa0", "😀",
         "<s>", "</s>", ".", "\x00", "\x1c", "hello", "The", "\r\n", "日本", "\ufb01", "\ufeff", "<", "|", ">",
         "endoftext", "\u200b", "<0x0A>", "_"]


def odd_texts(count):
    rng = random.Random(5)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(count)]


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def test_words_and_shingles_follow_the_pattern():
    texts = [*odd_texts(500), "A b\x0bC\x0cd", "", None, "x" * 5000]
    found = list(Hasher(tails=True).slices(pa.array([t and t.encode() for t in texts], pa.binary())))
    assert sum(s.rows for s in found) == len(texts)
    by_hash, by_tail = {}, {}
    for s in found:
        for i in range(s.rows):
            own = words(texts[s.first + i])
            at = slice(s.bounds[i], s.bounds[i + 1])
            assert len(s.words[at]) == len(own)
            for w, h, t in zip(own, s.words[at], s.tails[at]):
                assert by_hash.setdefault(w, h) == h
                assert by_tail.setdefault(w.encode()[-3:], t) == t
        runs, bounds = shingles(s.words, s.bounds)
        for i in range(s.rows):
            own = words(texts[s.first + i])
            want = {tuple(own[j:j + 5]) for j in range(max(1, len(own) - 4))} if own else set()
            assert len(set(runs[bounds[i]:bounds[i + 1]].tolist())) == len(want)
    assert len(set(by_hash.values())) == len(by_hash)
    assert len(set(by_tail.values())) == len(by_tail)


def test_slices_hold_all_rows_of_long_columns():
    texts = [b"ab " * 100_000, b"", b"c d " * 500_000, None, b"e"]
    sizes = [n for s in Hasher().slices(pa.array(texts, pa.binary())) for n in np.diff(s.bounds)]
    assert sizes == [100_000, 0, 1_000_000, 0, 1]


def test_token_counts_equal_the_library():
    counter = token_counts.Counter(tokenizer("byte_bpe_50k.json"))
    texts = odd_texts(4000)
    want = [len(e) for e in counter.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert counter.counts(texts) == want
    assert counter.counts(texts) == want


def test_token_counts_of_documents(spark, docs, folder):
    counter = token_counts.Counter(tokenizer("byte_bpe_50k.json"))
    got = {r.doc_id: r for r in QUERIES["op6_token_counts"](spark, folder).collect()}
    for r in docs.collect():
        n = len(counter.tokenizer.encode(r.text or "", add_special_tokens=False))
        assert got[r.doc_id][1:] == (len((r.text or "").encode()), n, n > 512)


def test_pieces_equal_the_library():
    table = pieces.WordTable(tokenizer("piece_bpe_32k.model"))
    texts = odd_texts(4000)
    for _ in range(2):
        ids, bounds = table.encode(texts)
        data, ends = table.decode(ids, bounds)
        for i, text in enumerate(texts):
            want = [*table.model.encode(text), table.model.eos_id()]
            assert ids[bounds[i]:bounds[i + 1]].tolist() == want
            assert bytes(data[ends[i]:ends[i + 1]]).decode() == table.model.decode(want)


def test_pieces_of_documents(spark, docs, folder):
    model = pieces.WordTable(tokenizer("piece_bpe_32k.model")).model
    got = {r.doc_id: r for r in QUERIES["op9_pieces"](spark, folder).collect()}
    for r in docs.collect():
        ids = [*model.encode(r.text or ""), 2]
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), model.decode(ids))]
        assert got[r.doc_id][1:] == (len(ids), *digest)


def brute_force_components(rows):
    sets = {}
    for doc_id, text in rows:
        own = words(text)
        sets[doc_id] = {tuple(own[j:j + 5]) for j in range(max(1, len(own) - 4))} if own else set()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = [d for d in sorted(sets) if sets[d]]
    for i, a in enumerate(ids):
        for b in ids[:i]:
            shared = len(sets[a] & sets[b])
            if 100 * shared >= 75 * (len(sets[a]) + len(sets[b]) - shared):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


def test_near_duplicates_equal_brute_force(spark, docs, folder):
    got = {r[0]: tuple(r[1:]) for r in QUERIES["op4_near_duplicates"](spark, folder).collect()}
    assert got == brute_force_components([(r.doc_id, r.text) for r in docs.collect()])


def copies(count, length, edits, seed):
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 10**9)}" for _ in range(length)]
    for i in range(count):
        own = list(base)
        for _ in range(rng.randint(0, edits)):
            own[rng.randrange(length)] = f"e{rng.randint(0, 10**9)}"
        yield " ".join(own)


@pytest.mark.parametrize("short_list, block", [(64, 400_000), (4, 400_000), (4, 600)])
def test_groups_of_near_copies_lose_no_link(spark, monkeypatch, short_list, block):
    """Many copies near the threshold, in short lists, long lists and lists of several blocks."""
    monkeypatch.setattr(near_duplicates, "SHORT_LIST", short_list)
    monkeypatch.setattr(near_duplicates, "BLOCK_HASHES", block)
    texts = [*copies(90, 60, 5, 1), *copies(40, 12, 2, 2), *copies(30, 300, 14, 3), *copies(20, 6, 1, 4)]
    rows = list(enumerate(texts, 1))
    made = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: tuple(r[1:]) for r in near_duplicates.near_duplicates(made).collect()}
    assert got == brute_force_components(rows)


def test_groups_of_few_rows_lose_no_link(spark, monkeypatch):
    """Blocks bounded by rows, with and without a label that holds most of a list."""
    monkeypatch.setattr(near_duplicates, "SHORT_LIST", 4)
    monkeypatch.setattr(near_duplicates, "BLOCK_ROWS", 7, raising=False)
    monkeypatch.setattr(near_duplicates, "TILE", 3, raising=False)
    texts = [*copies(90, 60, 5, 1), *copies(40, 12, 2, 2), *copies(30, 300, 14, 3), *copies(20, 6, 1, 4)]
    rows = list(enumerate(texts, 1))
    made = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r[0]: tuple(r[1:]) for r in near_duplicates.near_duplicates(made).collect()}
    assert got == brute_force_components(rows)


def test_long_lists_of_short_sets_are_cut_by_rows(spark, monkeypatch):
    """20,000 texts of one template with one word that varies share a list and are never linked."""
    whole = near_duplicates.group_links

    def bounded(table):
        assert table.num_rows < 5000
        return whole(table)

    monkeypatch.setattr(near_duplicates, "group_links", bounded)
    made = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat_ws(
        " ", *[F.lit(f"w{i}") for i in range(12)], F.concat(F.lit("x"), "id"),
        *[F.lit(f"w{i}") for i in range(12, 23)]).alias("text"))
    got = near_duplicates.near_duplicates(made).agg(F.count("*"), F.sum(F.col("kept").cast("int"))).first()
    assert tuple(got) == (20_000, 20_000)


def test_near_duplicates_of_odd_rows(odd, empty):
    got = sorted(near_duplicates.near_duplicates(odd).collect(), key=lambda r: (r[0] is None, r[0] or 0))
    by_id = {r.doc_id: r for r in got}
    assert len(got) == 13
    assert [by_id[i].component_id for i in (1, 2, 3, 7, 8)] == [1, 1, 1, 7, 7]
    assert [by_id[i][1:] for i in (4, 5, 6)] == [(0, 4, True), (0, 5, True), (0, 6, True)]
    assert by_id[None][1:] == (3, None, True)
    assert near_duplicates.near_duplicates(empty).count() == 0


def test_rows_that_share_an_id_are_one_document(spark):
    rows = [(5, "a b c d e f"), (5, "g h i j k l"), (3, "g h i j k l"), (7, "a b c d e f"), (8, "other")]
    made = near_duplicates.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.doc_id, r.component_id, r.kept) for r in made.collect()) == [
        (3, 3, True), (5, 3, False), (5, 3, False), (7, 3, False), (8, 8, True)]


def test_class_model_counts_equal_brute_force(spark, docs, folder):
    rows = [(r.doc_id, words(r.text)) for r in docs.collect()]
    train = [w for d, w in rows if zlib.crc32(str(d).encode()) % 10]
    counts = {None: len(train)}
    for own in train:
        for w in own:
            counts[w] = counts.get(w, 0) + 1
    total = sum(counts.values())
    got = {r.doc_id: r for r in QUERIES["op5_class_model"](spark, folder).collect()}
    gain = 0.0
    for d, own in rows:
        c = np.array([counts.get(w, 0) for w in [*own, None]], float)
        r = got[d]
        base = np.log10((c + 0.1) / (total + 0.1 * (len(counts) + 1))).sum()
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            zlib.crc32(str(d).encode()) % 10 == 0, len(own) + 1, (c > 0).sum(), total)
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base))
        assert np.isfinite(r.score) and r.score < 0
        gain += r.held_out * (r.score - r.base_score)
    assert gain > 0


def test_exchange_reports_the_best_move():
    """The gain of a move equals the difference of likelihoods, whatever class is tried."""
    rng = np.random.default_rng(1)
    pairs = rng.integers(0, 30, (12, 12)) * (rng.random((12, 12)) < 0.5)
    size = class_model.CLASSES
    now = rng.integers(1, 5, 12)
    now[0] = 0

    def matrix(classes):
        made = np.zeros((size, size))
        np.add.at(made, (classes[:, None], classes[None, :]), pairs)
        return made

    for unit in range(1, 12):
        kept = matrix(now)
        out, into = (np.bincount(now, x, size) for x in (pairs[unit], pairs[:, unit]))
        new = class_model.exchanged(out, into, float(pairs[unit, unit]), int(now[unit]), kept)
        trials = []
        for target in range(1, size):
            tried = now.copy()
            tried[unit] = target
            trials.append(class_model.likelihood(matrix(tried)))
        tried = now.copy()
        tried[unit] = new
        assert class_model.likelihood(matrix(tried)) == pytest.approx(max(trials))
        assert np.allclose(kept, matrix(tried))


def test_best_classes_of_several_words_equal_one_by_one():
    rng = np.random.default_rng(2)
    size = class_model.CLASSES
    pairs = rng.integers(0, 40, (30, 30)) * (rng.random((30, 30)) < 0.4)
    now = rng.integers(1, 6, 30)
    now[0] = 0
    matrix = np.zeros((size, size))
    np.add.at(matrix, (now[:, None], now[None, :]), pairs)
    out, into = (np.array([np.bincount(now, x, size) for x in side]) for side in (pairs, pairs.T))
    got = class_model.best_classes(out[1:], into[1:], np.diagonal(pairs)[1:].astype(float), now[1:], matrix)
    for i in range(1, 30):
        assert got[i - 1] == class_model.exchanged(out[i], into[i], float(pairs[i, i]), int(now[i]), matrix.copy())


def test_class_model_scores_equal_a_plain_model(docs, monkeypatch):
    """Classes, counts of class bigrams and scores from dictionaries of words, without arrays."""
    monkeypatch.setattr(class_model, "UNIT_SHARE", 2e-3)
    given = class_model.prepared(docs)
    model = class_model.learned(given)
    hasher = Hasher(tails=True)
    rows = []
    for r in given.collect():
        part = list(hasher.slices(pa.array([bytes(r.blob)], pa.binary())))[0]
        rows.append((r, part.words.view(np.int64).tolist(), model.classes[model.units.of(part.words, part.tails)].tolist()))
    seen = Counter(w for r, own, _ in rows if not r.held_out for w in own)
    kept = {r.word: r for r in model.words.collect()}
    assert {w: r.n for w, r in kept.items()} == dict(seen)
    start = {w: c for _, own, classes in rows for w, c in zip(own, classes)}
    frequent = set(model.units.words.view(np.int64).tolist())
    moved = {w for w in seen if kept[w]["class"] != start[w]}
    assert moved and all(seen[w] >= class_model.MIN_COUNT and w not in frequent for w in moved)

    def path(own):
        return [(0, None)] + [(kept[w]["class"] if w in kept else start[w], w) for w in own] + [(0, None)]

    texts = sum(not r.held_out for r, _, _ in rows)
    after, mass, spread = Counter(), Counter({0: texts}), Counter({0: 1})
    for w, r in kept.items():
        mass[r["class"]] += r.n
        spread[r["class"]] += 1
    for r, own, _ in rows:
        if not r.held_out:
            after.update((a[0], b[0]) for a, b in zip(path(own), path(own)[1:]))
    ahead = Counter()
    for (a, _), n in after.items():
        ahead[a] += n
    got = {r.doc_id: r.score for r in class_model.score_texts(docs).collect()}
    for r, own, _ in rows:
        want = 0.0
        for (a, _), (b, w) in zip(path(own), path(own)[1:]):
            count = texts if w is None else seen[w]
            want += math.log10((after[a, b] + 0.5) / (ahead[a] + 0.5 * class_model.CLASSES))
            want += math.log10((count + 0.1) / (mass[b] + 0.1 * (spread[b] + 1)))
        assert got[r.doc_id] == pytest.approx(want, rel=1e-9, abs=1e-9)


def test_most_words_of_a_growing_corpus_are_exchanged_on_their_own(spark, folder):
    """The exchanged vocabulary grows with the corpus, and the held-out gain with it."""
    sizes, gains = [], []
    for sf in ("sf0.01", "sf0.1"):
        docs = spark.read.parquet(f"{folder.replace('sf0.001', sf)}/documents.parquet")
        words = class_model.learned(class_model.prepared(docs)).words
        sizes.append(words.agg(F.count(F.when(F.col("n") >= class_model.MIN_COUNT, 1)).alias("words"),
                               F.sum(F.when(F.col("n") >= class_model.MIN_COUNT, F.col("n"))) / F.sum("n")).first())
        got = class_model.score_texts(docs).where("held_out").agg(
            F.sum(F.col("score") - F.col("base_score")) / F.sum("n_tokens")).first()
        gains.append(got[0])
    assert sizes[1][0] > 3 * sizes[0][0] and sizes[1][1] > sizes[0][1] > 0.5
    assert gains[1] > gains[0] > 0


def test_class_model_of_odd_rows(odd, empty):
    clashing = odd.withColumn("block", F.lit(1)).withColumn("class", F.lit("x")).withColumn("Score", F.lit(2))
    assert sorted(map(str, class_model.score_texts(clashing).collect())) == \
        sorted(map(str, class_model.score_texts(odd).collect()))
    got = class_model.score_texts(odd).collect()
    assert len(got) == 13 and all(np.isfinite(r.score) for r in got)
    assert {r.n_tokens for r in got if r.doc_id in (4, 5, 6)} == {1}
    assert class_model.score_texts(empty).count() == 0


def test_toxicity_finds_held_out_documents(spark, folder):
    larger = folder.replace("sf0.001", "sf0.1")
    got = QUERIES["op7_toxicity"](spark, larger).join(
        spark.read.parquet(f"{larger}/labels.parquet"), "doc_id").where("held_out").collect()
    hit, missed, wrong = (sum(f(r) for r in got) for f in (
        lambda r: r.toxic == 1 and r.predicted == 1, lambda r: r.toxic == 1 and r.predicted == 0,
        lambda r: r.toxic == 0 and r.predicted == 1))
    assert hit > 2 * missed and wrong <= 2 and all(0 <= r.score <= 1 for r in got)


def test_toxicity_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (2, None), (7, 0), (7, 1), (None, 1), (9, 0)], "doc_id long, toxic int")
    clashing = odd.withColumn("Score", F.lit("x")).withColumn("at", F.lit(1)).withColumn("cells", F.lit(2))
    rows = toxicity.score(clashing, toxicity.train(clashing, labels, F.lit(True))).collect()
    assert len(rows) == 13 and rows[0].asDict().keys() == {"doc_id", "text", "source", "at", "cells", "score",
                                                           "predicted"}
    none = toxicity.train(odd, labels.where("false"), F.lit(True))
    assert {r.score for r in toxicity.score(odd, none).collect()} == {0.5}
    assert toxicity.score(empty, none).count() == 0


def test_poisson_rates_and_counts(spark):
    rows = [(i, "x" * (10 if i % 4 else 200), "big" if i % 4 else "small") for i in range(4000)]
    made = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = spark.createDataFrame([("big", 3.0), ("small", 1.0), ("absent", 5.0)], "source string, weight double")
    got = mixing.mix(made, weights, total=1_000_000.0).groupBy("source").agg(
        F.sum(F.length("text")).alias("size"), F.first("rate").alias("rate")).collect()
    shares = {r.source: r.size / sum(x.size for x in got) for r in got}
    rates = {r.source: r.rate for r in got}
    assert rates["big"] == pytest.approx(750_000 / 30_000) and set(rates) == {"big", "small"}
    assert shares["big"] == pytest.approx(0.75, rel=0.05)


def test_poisson_has_the_right_moments(spark):
    """Means below and above one part, against the distribution's mean and variance."""
    rows = [(i, "x", "a" if i % 2 else "b") for i in range(8000)]
    made = spark.createDataFrame(rows, "doc_id long, text string, source string")
    weights = spark.createDataFrame([("a", 1.0), ("b", 50.0)], "source string, weight double")
    counts = mixing.mix(made, weights, total=4000 * 51.0).where("copy = 1").groupBy("source") \
        .agg(F.sum("n_copies").alias("s"), F.sum(F.col("n_copies") * F.col("n_copies")).alias("q")).collect()
    for r in counts:
        mean = r.s / 4000
        want = {"a": 1.0, "b": 50.0}[r.source]
        assert mean == pytest.approx(want, rel=0.05) and r.q / 4000 - mean * mean == pytest.approx(want, rel=0.1)


def test_mixing_of_odd_rows(odd, empty):
    clashing = odd.withColumn("rate", F.lit("x")).withColumn("s", F.lit(1)).withColumn("key", F.lit(2))
    first = mixing.mix(clashing, total=20_000_000.0).collect()
    again = mixing.mix(clashing.repartition(5), total=20_000_000.0).collect()
    assert sorted(map(str, first)) == sorted(map(str, again))
    assert {r.source for r in first} == {"en", "fr", None, ""} and set(first[0].asDict()) == {
        "doc_id", "text", "source", "s", "key", "rate", "n_copies", "copy", "shuffle_key"}
    twice = [r.copy for r in first if r.doc_id == 9]
    assert len(twice) == 2 * max(twice)
    assert mixing.mix(empty).count() == 0


def test_mixing_with_many_sources_gives_the_same_rows(docs, monkeypatch):
    few = sorted(map(str, mixing.mix(docs).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(map(str, mixing.mix(docs).collect())) == few


LUHN = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]


def passes(digits):
    return sum(LUHN[int(c)] if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def pseudonyms_of(spark, values, key="k"):
    made = spark.createDataFrame([(i, f"see {v}, end") for i, v in enumerate(values)], "doc_id long, text string")
    rows = {r.doc_id: r for r in pseudonyms.pseudonymize(made, key).collect()}
    return [(rows[i].text.removeprefix("see ").removesuffix(", end"), rows[i].n_replaced)
            for i in range(len(values))]


def test_pseudonyms_keep_format_and_links(spark):
    values = ["4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111111", "4111111111111112", "1985-02-28",
              "1985/02/28", "1985-02-30", "2300-01-01", "10.0.0.1", "256.1.1.1", "123-45-6789", "666-45-6789",
              "(229) 555-4838", "+1 229-555-4838", "(129) 555-4838", "Ann.b9@mail1.example.com", "1.2.3", "378282246310005"]
    got = pseudonyms_of(spark, values)
    kept = {"4111111111111112", "1985-02-30", "2300-01-01", "256.1.1.1", "666-45-6789", "(129) 555-4838", "1.2.3"}
    for old, (new, count) in zip(values, got):
        assert (new == old) == (old in kept) == (count == 0), (old, new)
        shape = lambda t: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d", "9", t)))
        assert shape(new) == shape(old) or "." in old
    digits = [re.sub(r"\D", "", new) for new, _ in got]
    assert digits[0] == digits[1] == digits[2] and passes(digits[0]) and passes(digits[17])
    assert digits[4] == digits[5] and digits[12] == digits[13][1:]
    assert got == pseudonyms_of(spark, values) != pseudonyms_of(spark, values, "other key")
    assert got[15][0].endswith("@mail1.example.com")


def test_pseudonyms_of_numbers_that_touch_other_signs(spark):
    dates = ["1990-01-31", "1990-01-31T00:00:00Z", "dob_1990-01-31", "31.01.1990"]
    cards = ["4111111111111111", "Nr.4111111111111111", "4111111111111111_x"]
    amex = ["378282246310005", "3782 822463 10005", "3782-822463-10005"]
    phones = ["+44 20 7946 0958", "+442079460958", "+49 (30) 1234567", "+12295554838", "x229-555-4838"]
    ibans = ["DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32", "AT611904300234573201 THE"]
    kept = ["31.02.1990", "DE88370400440532013000", "+2101234567x", "9c4111111111111111ab3", "3782 822463 10006"]
    got = [new for new, _ in pseudonyms_of(spark, [*dates, *cards, *amex, *phones, *ibans])]
    assert not {*got} & {*dates, *cards, *amex, *phones, *ibans}
    day = got[0]
    assert got[1:4] == [day + "T00:00:00Z", "dob_" + day, ".".join(reversed(day.split("-")))]
    assert got[5:7] == ["Nr." + got[4], got[4] + "_x"] and passes(got[4])
    assert got[8].replace(" ", "") == got[9].replace("-", "") == got[7] and passes(got[7])
    assert got[10].replace(" ", "") == got[11] and got[11][:3] == "+44" and got[12][:5] == "+49 ("
    number = lambda t: int("".join(str(int(c, 36)) for c in t[4:] + t[:4]))
    plain = [t.removesuffix(" THE").replace(" ", "") for t in got[15:]]
    assert plain[0] == plain[1] and all(number(t) % 97 == 1 for t in plain) and plain[2][4:8] == "WEST"
    assert pseudonyms_of(spark, kept) == [(v, 0) for v in kept]


def test_pseudonyms_are_permutations(spark):
    ips = [f"10.{i // 250}.7.{i % 250}" for i in range(1500)]
    days = [f"{1900 + i // 336}-{1 + i // 28 % 12:02}-{1 + i % 28:02}" for i in range(1500)]
    ssns = [f"{1 + i % 600:03}-{1 + i % 99:02}-{1 + i:04}" for i in range(1500)]
    for values in (ips, days, ssns):
        got = [new for new, _ in pseudonyms_of(spark, values)]
        assert len(set(got)) == len(set(values))


def test_pseudonyms_leave_other_text_alone(spark, docs, folder):
    private = re.compile("|".join((pseudonyms.EMAIL, pseudonyms.IPV4, pseudonyms.DATE, pseudonyms.SSN,
                                   pseudonyms.PHONE, pseudonyms.CARD)), re.ASCII)
    got = {r.doc_id: r for r in QUERIES["op10_pii"](spark, folder).collect()}
    found = 0
    for r in docs.collect():
        assert private.split(r.text or "") == private.split(got[r.doc_id].text or "")
        found += got[r.doc_id].n_replaced
    assert found > 10


def test_pseudonyms_of_odd_rows(odd, empty):
    clashing = odd.withColumn("whole", F.lit("x")).withColumn("put", F.lit(1)).withColumn("N_Replaced", F.lit(1))
    rows = {(r.doc_id, r.source): r for r in pseudonyms.pseudonymize(clashing, "k").collect()}
    assert rows[(5, "de")].text is None and rows[(4, "en")].text == "" and rows[(9, "fr")].text == "wörd " * 3000
    assert rows[(11, "en")].n_replaced == 2 and rows[(1, "en")].whole == "x"
    assert pseudonyms.pseudonymize(empty, "k").count() == 0


def test_tokens_of_odd_rows(odd, empty):
    clashing = odd.withColumn("N_Tokens", F.lit("x")).withColumn("ids", F.lit("y"))
    counted = token_counts.token_counts(clashing, tokenizer("byte_bpe_50k.json")).collect()
    assert sorted(r.n_tokens for r in counted if r.doc_id in (4, 5)) == [0, 0] and len(counted) == 13
    encoded = pieces.encode_decode(clashing, tokenizer("piece_bpe_32k.model")).collect()
    assert {tuple(r.ids) for r in encoded if r.doc_id in (4, 5)} == {(2,)} and len(encoded) == 13
    assert token_counts.token_counts(empty, tokenizer("byte_bpe_50k.json")).count() == 0
    assert pieces.encode_decode(empty, tokenizer("piece_bpe_32k.model")).count() == 0


def test_toxicity_weights_equal_plain_ftrl():
    """The vectorised learner against one coordinate at a time, on features checked by their number."""
    rng = np.random.default_rng(9)
    vocabulary = [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choice(vocabulary, rng.integers(0, 30))) for _ in range(300)]
    labels = [int("w1 " in t or "w2 w3" in t) for t in texts]
    rows = []
    for part in Hasher(punctuation=True).slices(pa.array([t.encode() for t in texts], pa.binary())):
        row, cells = toxicity.features(part)
        rows += [cells[row == i] for i in range(part.rows)]
    for text, cells in zip(texts, rows):
        words = text.split()
        grams = {(g, *pair) for g in (1, 2) for pair in zip(words, words[g:])} | {(0, w) for w in words} | {()}
        assert len(cells) == len(set(cells.tolist())) == len(grams)
    z, n = {}, {}

    def weight(c):
        if abs(z.get(c, 0.0)) <= toxicity.L1:
            return 0.0
        sign = 1 if z[c] > 0 else -1
        return -(z[c] - sign * toxicity.L1) / ((toxicity.BETA + n[c] ** 0.5) / toxicity.RATE + toxicity.L2)

    for _ in range(toxicity.PASSES):
        for cells, label in zip(rows, labels):
            total = sum(weight(c) for c in cells.tolist())
            gap = 1 / (1 + math.exp(-max(-35, min(35, total)))) - label
            for c in cells.tolist():
                w, before = weight(c), n.get(c, 0.0)
                n[c] = before + gap * gap
                z[c] = z.get(c, 0.0) + gap - (n[c] ** 0.5 - before ** 0.5) / toxicity.RATE * w
    expected = {c: weight(c) for c in z if weight(c)}
    found = dict(zip(*(x.tolist() for x in toxicity.learn(rows, np.array(labels)))))
    assert expected.keys() == found.keys() and len(found) > 0
    assert all(abs(found[c] - w) < 1e-9 for c, w in expected.items())


def test_toxicity_sample_is_bounded(spark, monkeypatch):
    """One text per id, and no more bytes than the bound; scores keep the asked columns only."""
    rows = [(i, ("bad " if i % 2 else "good ") * 50 + str(i)) for i in range(40)] + [(0, "other")] * 200 + [(1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity, "L1", 0.5)
    seen = []
    learn = toxicity.learn
    monkeypatch.setattr(toxicity, "learn", lambda r, y: seen.append(len(r)) or learn(r, y))
    model = toxicity.train(docs, labels, F.lit(True))
    scored = toxicity.score(docs, model, keep=["doc_id"])
    assert scored.columns == ["doc_id", "score", "predicted"]
    assert {r.predicted for r in scored.where("doc_id > 1 AND doc_id % 2 = 1").collect()} == {1}
    monkeypatch.setattr(toxicity, "MAX_BYTES", 0)
    assert len(toxicity.train(docs, labels, F.lit(True))[0]) == 0


def test_long_text_is_hashed_in_bounded_memory():
    """A text of 40 MB costs the words' hashes and little more; pieces give the hashes of the whole."""
    code = """
import resource, numpy as np, pyarrow as pa
from daymark.llm import toxicity, words
text = pa.array([("lorem ipsum dolor sit amet, consetetur " * 1_000_000).encode()], pa.binary())
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
part, = words.Hasher(punctuation=True).slices(text)
few = np.zeros(toxicity.CELLS, bool); few[::1000] = True
toxicity.features(part, lambda cells: few[cells])
assert len(part.words) == 6_000_000 and len(set(part.words.tolist())) == 6
print((resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) // 1024)
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    made = subprocess.run([sys.executable, "-c", code], cwd=root, check=True, capture_output=True, text=True)
    assert int(made.stdout) < 500


def test_pieces_of_a_long_text(monkeypatch):
    from daymark.llm import words
    text = ("ab  cde f\t" * 50 + "x" * 300 + " yz").encode()
    whole, = Hasher(tails=True).slices(pa.array([text], pa.binary()))
    for size in (1, 7, 64, 301):
        monkeypatch.setattr(words, "SLICE_BYTES", size)
        parts = list(Hasher(tails=True).slices(pa.array([b"one", text, b""], pa.binary())))
        long = next(p for p in parts if len(p.words) > 100)
        assert (long.words == whole.words).all() and (long.tails == whole.tails).all() and long.rows == 1
        assert sum(p.rows for p in parts) == 3
