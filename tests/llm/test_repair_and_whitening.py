"""Conversation repair, whitening and decontamination against brute force and SQL."""

import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from daymark.llm import conversations, decontamination, whitening
from daymark.llm.catalog import QUERIES

BLANK = " \t\n\x0b\x0c\r"
CONVERSATION = "conv_id long, turn long, role string, text string"


# --- conversations -------------------------------------------------------------------------------

def cheapest(kinds):
    """Least (cost, audit) over all repairs: rows left to right, a table of places in the pattern."""
    best = {"": (0, "")}

    def inserted(table):
        made = dict(table)
        for _ in range(3):
            for place, (cost, audit) in list(made.items()):
                new = {"": "u", "s": "u", "u": "a", "a": "u"}[place]
                option = (cost + 2, audit + "I")
                if new not in made or option < made[new]:
                    made[new] = option
        return made

    for kind in kinds:
        table = {}
        for place, (cost, audit) in inserted(best).items():
            options = [(place, cost + 3, "D")]
            if kind != "x":
                more = kind.isupper()
                new = "a" if place == "u" else "u"
                options.append((new, cost + 2 + more, "R"))
                if (place, kind.lower()) in [("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")]:
                    options.append((kind.lower(), cost + more, "K"))
            for new, total, letter in options:
                if new not in table or (total, audit + letter) < table[new]:
                    table[new] = (total, audit + letter)
        best = table
    return min(v for k, v in inserted(best).items() if k in ("", "a"))


def every_repair(kinds, most):
    """All (cost, audit) that give the pattern, with up to `most` insertions, nothing pruned."""
    found = []
    for edits in itertools.product("DKR", repeat=len(kinds)):
        for places in itertools.product(range(most + 1), repeat=len(kinds) + 1):
            if sum(places) > most:
                continue
            audit = "".join("I" * n + e for n, e in zip(places, edits)) + "I" * places[-1]
            cost, roles, rows = 0, "", iter(kinds)
            for letter in audit:
                kind = next(rows) if letter != "I" else ""
                cost += {"I": 2, "D": 3, "R": 2, "K": 0}[letter] + (letter in "KR" and kind.isupper())
                if letter in "KR" and kind == "x":
                    cost += 10 ** 6
                # Reroled and inserted rows take the role that the pattern asks for next.
                roles += "" if letter == "D" else kind.lower() if letter == "K" else "a" if roles[-1:] == "u" else "u"
            if re.fullmatch("(s?(ua)+)?", roles):
                found.append((cost, audit))
    return min(found)


def test_cells_equal_every_repair():
    rng = np.random.default_rng(5)
    for _ in range(60):
        kinds = "".join(rng.choice(list("suaoSUAOx"), rng.integers(1, 4)))
        expected = every_repair(kinds, 4)
        assert conversations.parsed([conversations.Chart().block(kinds)]) == expected == cheapest(kinds), kinds


def test_blocks_join_to_the_whole():
    rng = np.random.default_rng(6)
    for size in (1, 5, 12, 13, 40, 200):
        kinds = "".join(rng.choice(list("suaoSUAOx"), size, p=[.05, .3, .3, .05, .05, .08, .08, .04, .05]))
        chart = conversations.Chart()
        cells = [chart.block(kinds[i:i + 12]) for i in range(0, size, 12)]
        assert conversations.parsed(cells) == cheapest(kinds)


def plain_repair(rows):
    """What the query returns for one conversation's damaged rows (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, kinds, counts = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
    for _, role, text in rows:
        body = text.rstrip(BLANK)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else \
            "truncated" if body[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
        kinds += "x" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
    cost, audit = cheapest(kinds)
    turns = {r[0] for r in rows if r[0] is not None}
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    made, left = [], iter(rows)
    for letter in audit:
        _, role, text = next(left) if letter != "I" else (None, None, "")
        if letter == "D":
            continue
        if letter != "K":
            role = "assistant" if made and made[-1][0][:1] == "u" else "user"
        made.append((role, text))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, counts["blank"], counts["duplicate"],
            counts["truncated"], illegal, cost, audit, digest)


def plain_damage(rows):
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        yield from [(conv, turn, role, text)] * (2 if kind == 3 else 1)


def check_conversations(rows, got):
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    by = {r[0]: [] for r in rows}
    for conv, *rest in plain_damage(rows):
        by[conv].append(tuple(rest))
    expected = {c: plain_repair(r) if r else empty for c, r in by.items()}
    assert {r.conv_id: tuple(r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
                                           "repaired_sha256")) for r in got} == expected
    assert len(got) == len(expected)


def test_conversations_against_brute_force(spark, folder):
    for sf in ("sf0.001", "sf0.01"):
        path = folder.replace("sf0.001", sf)
        rows = spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
        check_conversations([tuple(r) for r in rows], QUERIES["op11_conversations"](spark, path).collect())


def test_odd_conversations(spark):
    rng = np.random.default_rng(1)
    texts = ["Yes.", "No", " ", "", None, "why?\n", "é. ", "a" * 5000 + "!", "x ", "."]
    roles = ["system", "user", "assistant", "tool", "", None, "User"]
    rows = [(int(c), int(t), str(roles[r]) if roles[r] is not None else None, texts[x])
            for c, t, r, x in zip(rng.integers(0, 30, 400), rng.integers(-3, 12, 400), rng.integers(0, 7, 400),
                                  rng.integers(0, 10, 400))]
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (40, None, "user", "b."), (40, None, "user", "a."),
             (40, 7, "assistant", "z")]
    # A conversation longer than many blocks, and one row a thousand times.
    rows += [(50, t, ("user", "assistant")[t % 3 == 1], f"turn {t}.") for t in range(300)]
    rows += [(51, 5, "user", "again.")] * 1000 + [(51, 6, "assistant", "yes.")]
    given = spark.createDataFrame(rows, CONVERSATION).withColumn("extra", F.lit(1)).repartition(5)
    check_conversations(rows, conversations.repaired_digests(conversations.damaged(given), given).collect())


def test_no_conversations(spark):
    none = spark.createDataFrame([], CONVERSATION)
    assert conversations.repaired_digests(conversations.damaged(none), none).collect() == []


def test_repaired_turns(spark):
    rows = [(1, 1, "user", "Hi."), (1, 2, "user", "More"), (2, 1, "tool", " ")]
    summary, turns = conversations.repair(spark.createDataFrame(rows, CONVERSATION))
    assert sorted((r.conv_id, r.cost, r.audit) for r in summary.collect()) == [(1, 3, "KR"), (2, 3, "D")]
    assert [tuple(r) for r in turns.collect()] == [(1, 1, "K", "user", "Hi."), (1, 2, "R", "assistant", "More")]


# --- whitening -----------------------------------------------------------------------------------

def check_whitening(vectors, got, components=8):
    """All rows against numpy's eigenvectors of the exact covariance."""
    x = np.floor(1024 * np.array([v for _, v in vectors], dtype=float)).astype(np.int64) + 100_000
    n, total = len(x), x.sum(axis=0)
    centred = (n * x - total) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    held = int((values[:components] > values[0] * 1e-12).sum())
    expected = centred @ axes[:, :held] / np.sqrt(values[:held])
    by_component = {}
    for r in got:
        by_component.setdefault(r.component, []).append(r)
    assert sorted(by_component) == list(range(1, held + 1))
    deviations = {}
    for (i, _), row in zip(vectors, x.tolist()):
        deviations.setdefault(i, []).append(sum((n * v - int(t)) ** 2 for v, t in zip(row, total)))
    for c, rows in by_component.items():
        assert len(rows) == n and {r.n for r in rows} == {n}
        ids = np.array([-1 if r.vec_id is None else r.vec_id for r in rows])
        made = np.array([r.whitened for r in rows])
        own = np.array([-1 if i is None else i for i, _ in vectors])
        a = made[np.lexsort((made, ids))]
        b = expected[:, c - 1]
        tops = [np.abs(a - (s * b)[np.lexsort((s * b, own))]).max() for s in (1, -1)]
        assert min(tops) < 1e-6
        assert abs(rows[0].explained - values[c - 1] / values.sum()) < 1e-8
        for r in rows:
            assert int(r.deviation) in deviations[r.vec_id]
            assert r.identity_error < 1e-8


def test_whitening_query(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    got = QUERIES["op12_whitening"](spark, folder)
    assert dict(got.dtypes)["deviation"] == "bigint"
    check_whitening([(r.vec_id, r.embedding) for r in rows], got.collect())


def test_odd_vectors(spark):
    rng = np.random.default_rng(2)
    good = [(i, rng.normal(size=5).tolist()) for i in range(60)]
    good += [good[0]] * 40 + [(None, [1.0, 2.0, 3.0, 4.0, 5.0]), (7, [0.5] * 5), (90, [1e3, -1e3, 0.0, 0.0, 1.0])]
    bad = [(100, None), (101, [1.0, None, 1.0, 1.0, 1.0]), (102, [float("nan")] * 5), (103, [float("inf")] + [0.0] * 4)]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").withColumn("whitened", F.lit("mine"))
    check_whitening(good, whitening.whiten(df.repartition(7)).collect())
    short = [(1, [1.0]), (2, [0.0, 1.0]), (3, []), (4, [2.0, 2.0])]
    padded = [(i, v + [0.0] * (2 - len(v))) for i, v in short]
    check_whitening(padded, whitening.whiten(spark.createDataFrame(short, "vec_id long, embedding array<double>"))
                    .collect())


def test_nothing_to_whiten(spark):
    kind = "vec_id long, embedding array<float>"
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]):
        assert whitening.whiten(spark.createDataFrame(rows, kind)).collect() == []
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(spark.createDataFrame([(1, [1e30])], kind)).collect()


def test_updates_equal_eigenvalues():
    """Rank-one updates with equal, zero and close eigenvalues stay orthogonal and exact."""
    rng = np.random.default_rng(3)
    for kind in range(6):
        size = 12
        x = rng.integers(-500, 500, (80, size))
        if kind == 1:
            x[:, 6:] = 0
        elif kind == 2:
            x = np.repeat(np.eye(size, dtype=int) * 7, 3, axis=0)
        elif kind == 3:
            x[:, 1] = x[:, 0]
        elif kind == 4:
            x = x % 2
        elif kind == 5:
            x[40:] *= 10 ** 6
        halves = [whitening.Spectrum.none(size) for _ in range(2)]
        for i, row in enumerate(x):
            halves[i % 2].add(row.astype(np.int64), 1 + i % 3)
        both = halves[0]
        both.join(halves[1])
        weights = 1 + np.arange(len(x)) % 3
        apart = x - (weights @ x) / weights.sum()
        scatter = (apart * weights[:, None]).T @ apart
        assert np.abs(both.basis.T @ both.basis - np.eye(size)).max() < 1e-12
        assert np.abs(both.basis @ np.diag(both.values) @ both.basis.T - scatter).max() < 1e-12 * np.abs(scatter).max()


# --- decontamination -----------------------------------------------------------------------------

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def plain_words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_hits(docs, items):
    windows = {}
    for item, text in items:
        words = plain_words(text)
        for i in range(len(words) - 9 if len(words) >= 10 else bool(words)):
            windows.setdefault(tuple(words[i:i + 10]), set()).add(item)
    sizes = {len(w) for w in windows}
    for doc, text in docs:
        words, hit, found = plain_words(text), set(), set()
        for k in sizes:
            for i in range(len(words) - k + 1):
                if (own := tuple(words[i:i + k])) in windows:
                    hit |= set(range(i, i + k))
                    found |= windows[own]
        yield doc, len(words), len(hit), sorted(x for x in map(str, found - {None}))


DOC_TEXTS = ["one two three four five six seven eight nine ten eleven", "One-two THREE, four five six seven eight nine ten",
             "zero one two three four five six seven eight nine ten eleven twelve", "", None, "short  item!", "a short item b",
             "ÉTÉ été 42", " \n", "eleven " * 3, "one two three four five six seven eight nine tex"]
ITEM_ROWS = [(1, DOC_TEXTS[0]), (2, "short item"), (10, "one two three four five six seven eight nine ten"), (2, "été 42"),
             (None, "eleven"), (5, None), (6, "..."), (7, DOC_TEXTS[0]), (7, DOC_TEXTS[0])]


@pytest.mark.parametrize("portion", [1 << 20, 60])
def test_hits_against_brute_force(spark, portion):
    docs = [(i, t) for i, t in enumerate(DOC_TEXTS)] + [(0, DOC_TEXTS[0]), (None, DOC_TEXTS[2])]
    given = spark.createDataFrame(docs, "doc_id long, text string").withColumns(
        {"n_words": F.lit("mine"), "lang": F.lit("en"), "blob": F.lit(1)}).repartition(3)
    items = spark.createDataFrame(ITEM_ROWS, "item_id long, text string")
    got = decontamination.decontaminate(given, items, portion_bytes=portion)
    assert got.columns == ["doc_id", "lang", "blob", "n_words", "n_hit", "spans", "items", "contaminated"]
    made = sorted(((r.doc_id is None, r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got.collect()), key=str)
    assert made == sorted(((d is None, d, *r) for d, *r in plain_hits(docs, ITEM_ROWS)), key=str)


@pytest.mark.parametrize("portion", [1 << 20, 60])
def test_removal(spark, portion):
    docs = spark.createDataFrame([(1, "See: One-two three four five six seven eight nine TEN! End, a short item."), (2, "clean"),
                                  (3, None)], "doc_id long, text string")
    items = spark.createDataFrame(ITEM_ROWS, "item_id long, text string")
    cut = {r.doc_id: r.text for r in decontamination.decontaminate(docs, items, remove="spans", portion_bytes=portion)
           .collect()}
    assert cut == {1: "See: ! End, a .", 2: "clean", 3: None}
    left = decontamination.decontaminate(docs, items, remove="documents", portion_bytes=portion)
    assert {(r.doc_id, r.text) for r in left.collect()} == {(2, "clean"), (3, None)}


def test_long_texts(monkeypatch):
    """Slices of a long text find what the whole text holds, wherever they are cut."""
    rng = np.random.default_rng(4)
    words = rng.choice(["a", "bb", "ccc", "d" * 90, "é"], 400).tolist()
    items = [(str(i), " ".join(words[a:a + n]).encode()) for i, (a, n) in enumerate([(0, 10), (95, 30), (390, 10), (7, 2)])]
    known = decontamination.WindowSet(decontamination.pa.table(
        {"blob": decontamination.pa.array([t for _, t in items]), "item": decontamination.pa.array([i for i, _ in items])}))
    text = " , ".join(words).encode()
    whole = decontamination.judged_slice(known, np.frombuffer(text, np.uint8), np.array([0, len(text)]))[0]
    for size in (1, 7, 50, 300, 5000):
        monkeypatch.setattr(decontamination, "SLICE_BYTES", size)
        assert decontamination.judged_long(known, np.frombuffer(text, np.uint8)) == whole


def test_windows_of_one_hash_are_told_apart():
    """Words that agree in their hashed part and length differ in their last bytes."""
    long = "w" * 40
    pa = decontamination.pa
    known = decontamination.WindowSet(pa.table({"blob": pa.array([f"{long}x".encode(), f"{long}y".encode()]),
                                                "item": pa.array(["x", "y"])}))
    texts = pa.array([f"{long}y".encode(), f"{long}z".encode(), f"{long}x {long}y".encode()])
    assert [r[2] for r in decontamination.judged(known, texts)] == [["y"], [], ["x", "y"]]


def test_nothing_to_decontaminate(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame(ITEM_ROWS, "item_id long, text string")
    assert decontamination.decontaminate(none, items).collect() == []
    docs = spark.createDataFrame([(1, "one two")], "doc_id long, text string")
    got = decontamination.decontaminate(docs, items.limit(0)).collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in got] == [(2, 0, False)]
    with pytest.raises(ValueError, match="remove"):
        decontamination.decontaminate(docs, items, remove="all")
