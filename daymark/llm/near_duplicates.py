"""Near-duplicates by bottom-k sketches from one hash function, confirmed on full shingle sets.

A document's set holds its distinct shingles of five words. Documents with equal sets form a class,
which is handled once. A class is sketched by the K smallest hashes of its set. Two sets with a
Jaccard similarity of 0.75 share at least LEAST of their retained values, but for a chance below
1e-7 (the share of the K smallest values of the union that lie in both estimates the similarity
with a deviation of 0.0625); sets that fit into a sketch share three quarters of the smaller one
for certain. So each sketch, ordered by how many classes hold a value, needs inverted lists for a
prefix only: two classes over the threshold meet in one of them, and values that very many classes
hold stand last and seldom get a list.

Lists are used twice. First the class with the smallest id in a list meets the others, which joins
most groups of copies. Then what is left, pairs of a list in different components, is compared:
short lists by a join whose pairs pass the estimate on the union sketch before full sets are
compared; long lists group by group, cut into pairs of blocks of bounded size, where a pair belongs
to the first list it shares and only links that join components leave the group.

Rows without a word have an empty set, are linked with nothing and are kept. Rows with a null id
get their n_shingles, a null component and are kept. Rows that share an id are one document: they
lie in one component, and each of them is kept if the id is its component's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.functions.storage import pinned
from daymark.llm.components import components
from daymark.llm.words import Hasher, mix, shingles

K, LEAST = 48, 19
#: Lists with more classes are compared in groups; hashes and rows in a block of such a group, on average.
SHORT_LIST, BLOCK_HASHES, BLOCK_ROWS = 64, 400_000, 2000
#: Rows of a block that are compared with all of its group at a time.
TILE = 256
NUMERATOR, DENOMINATOR = 75, 100


def _signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def profiles(docs: DataFrame, sets: bool) -> DataFrame:
    """id, cid (a digest of the set), n (its size), and the sorted sketch or set."""
    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for part in hasher.slices(batch.column("blob")):
                hashes, bounds = shingles(part.words, part.bounds)
                keys, sizes, found = [], [], []
                with np.errstate(over="ignore"):
                    for i in range(part.rows):
                        own = np.unique(_signed(hashes[bounds[i]:bounds[i + 1]]))
                        raw = own.view(np.uint64)
                        keys.append((raw.sum(), mix(raw + np.uint64(1)).sum()))
                        sizes.append(len(own))
                        found.append(own if sets else own[:K])
                    keys = np.array(keys, np.uint64).reshape(-1, 2)
                    cid = mix(mix(keys[:, 0] + np.array(sizes, np.uint64)) + keys[:, 1])
                ends = np.concatenate(([0], np.cumsum([len(x) for x in found]))).astype(np.int32)
                flat = np.concatenate(found) if found else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(part.first, part.rows), pa.array(_signed(cid)),
                     pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))],
                    names=["id", "cid", "n", "hashes"])

    return docs.select("id", F.col("blob")).mapInArrow(
        profile, "id long, cid long, n long, hashes array<long>")


def _similar(shared: Column, a: Column, b: Column) -> Column:
    return shared * DENOMINATOR >= (a + b - shared) * NUMERATOR


def _near_size(a: Column, b: Column) -> Column:
    return F.least(a, b) * DENOMINATOR >= F.greatest(a, b) * NUMERATOR


def prefixes(classes: DataFrame) -> DataFrame:
    """cid, node, n and prefix: the rarest values of the sketch that other classes hold too."""
    held = F.least(F.col("n"), F.lit(K))
    least = F.when(F.col("n") <= K * NUMERATOR / DENOMINATOR,
                   F.ceil(F.col("n") * NUMERATOR / DENOMINATOR)).otherwise(LEAST)
    values = classes.select("cid", "node", "n", F.explode("hashes").alias("value"))
    common = values.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    listed = values.join(common, "value").groupBy("cid", "node", "n").agg(
        F.sort_array(F.collect_list(F.struct("df", "value"))).alias("ranked"))
    room = (held - least + 1 - (held - F.size("ranked"))).cast("int")
    return listed.withColumn("room", room).where("room > 0") \
        .select("cid", "node", "n", F.slice("ranked", F.lit(1), F.col("room")).alias("prefix"))


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b: cid; node_a, node_b) that pass the estimate and then the full comparison."""
    def both(df, column):
        for side in "ab":
            df = df.join(sets.select(F.col("cid").alias(side), F.col(column).alias(f"{column}_{side}")), side)
        return df

    sketched = both(pairs, "sketch")
    shared = F.array_intersect("sketch_a", "sketch_b")
    union = F.slice(F.array_sort(F.array_union("sketch_a", "sketch_b")), 1, K)
    passed = sketched.where(F.size(F.array_intersect(shared, union)) * K >= F.size(union) * LEAST) \
        .select("a", "b", "node_a", "node_b")
    whole = both(passed, "hashes")
    return whole.where(_similar(F.size(F.array_intersect("hashes_a", "hashes_b")).cast("long"),
                                F.size("hashes_a"), F.size("hashes_b"))) \
        .select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def _first_pairs(entries: DataFrame) -> DataFrame:
    """In every list the class with the smallest id with all others of near size."""
    first = entries.groupBy("value").agg(F.min(F.struct("node", "cid", "n")).alias("p"))
    return entries.join(first, "value").where(
        (F.col("cid") != F.col("p.cid")) & _near_size(F.col("n"), F.col("p.n"))) \
        .select(F.col("p.cid").alias("a"), F.col("cid").alias("b"), F.col("p.node").alias("node_a"),
                F.col("node").alias("node_b")).distinct()


def _short_pairs(entries: DataFrame) -> DataFrame:
    """Pairs of different components and near size within lists."""
    left, right = [entries.select(F.col("value"), *[F.col(c).alias(f"{c}_{s}") for c in ("cid", "node", "n", "label")])
                   for s in "ab"]
    return left.join(right, "value").where(
        (F.col("cid_a") < F.col("cid_b")) & (F.col("label_a") != F.col("label_b"))
        & _near_size(F.col("n_a"), F.col("n_b"))) \
        .select(F.col("cid_a").alias("a"), F.col("cid_b").alias("b"), "node_a", "node_b").distinct()


def _long_links(entries: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between components from lists with many classes, by pairs of blocks.

    Rows of a list's most frequent label have blocks of their own, which meet those of other labels only.
    """
    held = entries.groupBy("value", "label").agg(F.count("*").alias("m"), F.sum("n").alias("hashes"))
    blocks = lambda main: F.ceil(F.greatest(
        F.sum(F.when(main, F.col("hashes")).otherwise(0)) / BLOCK_HASHES,
        F.sum(F.when(main, F.col("m")).otherwise(0)) / BLOCK_ROWS)).cast("int")
    most = held.groupBy("value").agg(F.max(F.struct("m", "label"))["label"].alias("most"))
    sizes = held.join(most, "value").groupBy("value", "most").agg(
        blocks(F.col("label") == F.col("most")).alias("main"), blocks(F.col("label") != F.col("most")).alias("rest"))
    place = lambda count: F.pmod(F.xxhash64("cid"), F.col(count)).cast("int")
    same = F.col("label") == F.col("most")
    dealt = entries.join(sizes, "value").where("rest > 0").withColumn(
        "block", F.when(same, place("main")).otherwise(F.col("main") + place("rest")))
    pairs = F.transform(F.sequence(F.when(same, F.col("main")).otherwise(0), F.col("main") + F.col("rest") - 1),
                        lambda other: F.struct(F.least("block", other).alias("i"), F.greatest("block", other).alias("j")))
    dealt = dealt.withColumn("p", F.explode(pairs)).select(
        "value", "df", "p.i", "p.j", "block", "cid", "node", "label", "n",
        F.transform("prefix", lambda x: x["df"]).alias("ranks"),
        F.transform("prefix", lambda x: x["value"]).alias("values"))
    return dealt.join(sets.select("cid", "hashes"), "cid") \
        .groupBy("value", "i", "j").applyInArrow(group_links, "a long, b long")


def _incidence(rows: np.ndarray, keys: np.ndarray, count: int) -> Iterator[np.ndarray]:
    """Which rows hold each key that at least two rows hold, a bounded number of keys at a time."""
    _, place, times = np.unique(keys, return_inverse=True, return_counts=True)
    often = times > 1
    new = np.cumsum(often) - 1
    keep = often[place]
    rows, place = rows[keep], new[place[keep]]
    order = np.argsort(place, kind="stable")
    rows, place = rows[order], place[order]
    step = max(256, 8_000_000 // max(1, count))
    for low in range(0, int(often.sum()), step):
        part = slice(*np.searchsorted(place, (low, low + step)))
        made = np.zeros((count, min(step, int(often.sum()) - low)), np.float32)
        made[rows[part], place[part] - low] = 1
        yield made


def group_links(table: pa.Table) -> pa.Table:
    """Links that join components among the classes of one pair of blocks of a list."""
    table = table.combine_chunks()
    column = lambda name: table.column(name).to_numpy()
    m, labels, n, block = table.num_rows, column("label"), column("n").astype(np.float64), column("block")
    at, rank = table.column("value")[0].as_py(), table.column("df")[0].as_py()

    def flat(name):
        lists = table.column(name).combine_chunks()
        return lists.flatten().to_numpy(), np.repeat(np.arange(m), np.diff(lists.offsets.to_numpy()))

    tiles = lambda count: (slice(low, low + TILE) for low in range(0, count, TILE))
    (values, holder), (ranks, _) = flat("values"), flat("ranks")
    earlier = (ranks < rank) | ((ranks == rank) & (values < at))
    wanted = np.zeros((m, m), bool)
    for t in tiles(m):
        wanted[t] = (labels[t, None] < labels) & (np.minimum(n[t, None], n) * DENOMINATOR
                                                  >= np.maximum(n[t, None], n) * NUMERATOR)
    if table.column("i")[0].as_py() != table.column("j")[0].as_py():
        wanted &= block[:, None] != block
    if wanted.any():
        for held in _incidence(holder[earlier], values[earlier], m):
            for t in tiles(m):
                wanted[t] &= held[t] @ held.T == 0
    rows = np.flatnonzero(wanted.any(axis=1) | wanted.any(axis=0))
    links: list[tuple[int, int]] = []
    if len(rows):
        hashes, of = flat("hashes")
        shared = np.zeros((len(rows), len(rows)), np.float32)
        new = np.full(m, -1)
        new[rows] = np.arange(len(rows))
        keep = new[of] >= 0
        for held in _incidence(new[of[keep]], hashes[keep], len(rows)):
            for t in tiles(len(rows)):
                shared[t] += held[t] @ held.T
        near = wanted[np.ix_(rows, rows)]
        for t in tiles(len(rows)):
            total = n[rows[t]][:, None] + n[rows]
            near[t] &= shared[t] * float(DENOMINATOR) >= (total - shared[t]) * NUMERATOR
        own = labels[rows]
        joined = {int(x): int(x) for x in own}

        def root(x):
            while joined[x] != x:
                joined[x] = x = joined[joined[x]]
            return x

        for a, b in np.unique(np.stack([own[i] for i in np.nonzero(near)], axis=1), axis=0).tolist():
            if (x := root(a)) != (y := root(b)):
                joined[max(x, y)] = min(x, y)
                links.append((a, b))
    return pa.table({"a": pa.array([x for x, _ in links], pa.int64()),
                     "b": pa.array([x for _, x in links], pa.int64())})


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each document: its id, n_shingles, component_id and kept."""
    given = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").cast("binary").alias("blob"))
    profiled = pinned(profiles(given, sets=False), "profiles")
    classes = pinned(profiled.where("n > 0 AND id IS NOT NULL").groupBy("cid").agg(
        F.min("id").alias("node"), F.first("n").alias("n"), F.first("hashes").alias("hashes")), "classes")
    listed = pinned(prefixes(classes), "prefixes")
    again = given.join(listed.select(F.col("node").alias("id")).distinct(), "id", "left_semi")
    sets = pinned(profiles(again, sets=True).select(
        "cid", "hashes", F.slice("hashes", 1, K).alias("sketch")).join(
            listed.select("cid"), "cid", "left_semi").dropDuplicates(["cid"]), "sets")

    def entries(rows):
        return rows.select("*", F.explode("prefix").alias("e")).select(
            *rows.columns, F.col("e.df").alias("df"), F.col("e.value").alias("value"))

    first = pinned(confirmed(_first_pairs(entries(listed).drop("prefix")), sets), "links")
    shared = classes.join(profiled.select("id", "cid").distinct(), "cid").where("id <> node") \
        .select(F.col("node").alias("a"), F.col("id").alias("b"))
    repeated = profiled.where("n > 0 AND id IS NOT NULL").select("id", "cid").distinct() \
        .groupBy("id").agg(F.count("*").alias("sets")).where("sets > 1").select("id")
    shared = shared.join(repeated, F.col("b") == F.col("id"), "left_semi")
    first = first.unionByName(shared)
    labels = components(first)
    open_ = pinned(entries(listed.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))),
                   "entries")
    live = pinned(open_.groupBy("value").agg(F.count("*").alias("m"), F.min("label").alias("low"),
                                             F.max("label").alias("high")).where("low < high"), "lists")
    short = open_.join(live.where(F.col("m") <= SHORT_LIST).select("value"), "value", "left_semi")
    long = open_.join(live.where(F.col("m") > SHORT_LIST).select("value"), "value", "left_semi")
    more = pinned(confirmed(_short_pairs(short), sets).unionByName(_long_links(long, sets)), "links")
    labels = pinned(components(labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
                               .unionByName(more)), "labels")
    places = classes.select("cid", "node").join(labels, "node", "left") \
        .select("cid", F.coalesce("label", "node").alias("component_id"))
    placed = profiled.join(places, "cid", "left").select(
        F.col("id").alias(doc_id), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.when(F.col("id").isNotNull(), F.col("component_id")))
        .otherwise(F.col("id")).alias("component_id"))
    return placed.withColumn("kept", F.coalesce(F.col(doc_id) == F.col("component_id"), F.lit(True)))
