"""Searches over vectors and URL rules against brute force and SQL."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from daymark.llm import collision_search, inner_products, url_rules, vector_blocks
from daymark.llm.catalog import QUERIES, SQL
from tests.oracle import connect, normal

NAN, INF = float("nan"), float("inf")


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, folder, name):
    df = QUERIES[name](spark, folder)
    result = connect(folder).execute(SQL[name])
    assert normal(df.columns, [tuple(r) for r in df.collect()]) == \
        normal([d[0] for d in result.description], result.fetchall())


def test_collision_search_recall(spark, folder):
    larger = folder.replace("sf0.001", "sf0.1")
    rows = spark.read.parquet(f"{larger}/embeddings.parquet").toPandas()
    x = np.stack(rows.embedding).astype(float)
    ids = rows.vec_id.to_numpy()
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    got = {}
    for r in QUERIES["op1_nearest"](spark, larger).collect():
        got.setdefault(r.query_id, []).append(r)
    hits = 0
    asked = np.flatnonzero(ids % 50 == 0)
    assert set(got) == set(ids[asked].tolist())
    for i in asked:
        cosines = np.where(ids == ids[i], -9, unit @ unit[i])
        own = sorted(got[ids[i]], key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == [1, 2, 3, 4, 5]
        assert own == sorted(own, key=lambda r: (-r.score, r.vec_id))
        for r in own:
            assert r.score == pytest.approx(cosines[ids == r.vec_id][0], abs=1e-12)
        hits += len({r.vec_id for r in own} & set(ids[np.argsort(-cosines)[:5]].tolist()))
    assert hits >= 0.9 * 5 * len(asked)


def test_blocks_of_any_size_give_the_same_products(spark, folder, monkeypatch):
    whole = sorted(map(str, QUERIES["op8_inner_products"](spark, folder).collect()))
    for name, size in (("BLOCK_ROWS", 60), ("LEAST_ROWS", 20), ("QUERY_ROWS", 3)):
        monkeypatch.setattr(vector_blocks, name, size)
    monkeypatch.setattr(inner_products, "STEP_ROWS", 7)
    assert sorted(map(str, QUERIES["op8_inner_products"](spark, folder).collect())) == whole


VECTORS = [(0, [1.0, 0.0]), (50, [0.0, 0.0]), (100, None), (150, [1.0, None]), (200, [NAN, 1.0]), (1, [1.0, 0.0]),
           (2, [1.0, 0.0]), (3, [0.5]), (4, [0.0, -1.0]), (5, [INF, 0.0]), (6, []), (None, [1.0, 1.0]),
           (7, [1.0, 1.0]), (7, [1.0, 1.0])]


def test_searches_on_odd_vectors(spark):
    rows = spark.createDataFrame(VECTORS, "vec_id long, embedding array<double>") \
        .withColumn("v", F.lit(1)).withColumn("b", F.lit(2))
    asked = rows.where("vec_id % 50 = 0")
    near = collision_search.nearest(rows, asked).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id) for r in near] == [(0, 1), (0, 2), (0, 3), (0, 7), (0, 7)]
    large = inner_products.largest(rows, asked).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id, r.score) for r in large] == [
        (0, 1, 65536), (0, 2, 65536), (0, 7, 65536), (0, 7, 65536), (0, 3, 32768),
        (50, 0, 0), (50, 1, 0), (50, 2, 0), (50, 3, 0), (50, 4, 0)]
    for search in (collision_search.nearest, inner_products.largest):
        assert search(rows.where("false"), asked).count() == 0
        assert search(rows, asked.where("false")).count() == 0


def test_rules_for_odd_urls(spark):
    rules = spark.createDataFrame(
        [("b.com", "/x", "block"), ("b.com", "/x/y", "allow"), ("a.b.com", "", "allow"), ("c", "/", "block"),
         ("c", "/", "block"), ("c", "/", "allow"), (None, "/", "block"), ("d", None, "block"), ("e", "/", None)],
        "host string, path string, verdict string")
    urls = ["http://b.com/x", "http://B.com/xyz?q", "http://z.b.com/x/yy#f", "http://bb.com/x", "https://a.b.com",
            "http://a.b.com/x/y", "c/", "http://c?x", "http://c/", None, "", "://c/#", "http://d/", "http://e/",
            "x://c/\n/é", "http://u:p@b.com/x", "http://b.com//x"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)] * 2, "page_id long, url string") \
        .withColumn("best", F.lit(1)).withColumn("RULE", F.lit("r")).withColumn("prefix", F.lit("p"))
    rows = url_rules.judge(pages, rules).collect()
    assert len(rows) == 2 * len(urls)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}
    assert [got[i] for i in range(len(urls))] == [
        ("b.com", "/x", "b.com/x", "block"), ("b.com", "/xyz", "b.com/x", "block"),
        ("z.b.com", "/x/yy", "b.com/x/y", "allow"), ("bb.com", "/x", None, "allow"),
        ("a.b.com", "", "a.b.com", "allow"), ("a.b.com", "/x/y", "b.com/x/y", "allow"), ("", "", None, "allow"),
        ("c", "", None, "allow"), ("c", "/", "c/", "block"), ("", "", None, "allow"), ("", "", None, "allow"),
        ("c", "/", "c/", "block"), ("d", "/", None, "allow"), ("e", "/", None, "allow"),
        ("c", "/\n/é", "c/", "block"), ("u:p@b.com", "/x", None, "allow"), ("b.com", "//x", None, "allow")]
    assert url_rules.judge(pages.where("false"), rules).count() == 0
    assert {r.verdict for r in url_rules.judge(pages, rules.where("false")).collect()} == {"allow"}


def test_queries_skip_blocks_of_short_vectors(spark, monkeypatch):
    """One id on a third of the rows; queries meet all blocks that can hold a best row and few others."""
    monkeypatch.setattr(vector_blocks, "BLOCK_ROWS", 100)
    rng = np.random.default_rng(3)
    lengths = np.exp(rng.normal(0, 2, 3000))
    points = rng.normal(size=(3000, 8)) * lengths[:, None] / 8
    ids = np.where(np.arange(3000) % 3 == 1, 7, np.arange(3000))
    rows = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, points)], "vec_id long, embedding array<double>")
    sent = []
    whole_search = vector_blocks.search

    def counted(data, queries, width, blocks, *rest):
        sent.append((queries.select(F.sum(F.size("blocks")), F.count("*")).first(), blocks))
        sent.append(data.groupBy("block").count().agg(F.max("count")).first()[0])
        return whole_search(data, queries, width, blocks, *rest)

    monkeypatch.setattr(vector_blocks, "search", counted)
    asked = rows.where("vec_id % 50 = 0")
    got = {}
    for r in inner_products.largest(rows, asked).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    (pairs, queries), blocks = sent[0]
    assert blocks >= 20 and pairs < 0.3 * queries * blocks and sent[1] < 300
    x = np.floor(256 * points).astype(np.int64)
    for i in np.flatnonzero(ids % 50 == 0):
        others = np.flatnonzero(ids != ids[i])
        scores = x[others] @ x[i]
        order = np.lexsort((ids[others], -scores))[:5]
        assert sorted(got[ids[i]]) == [(n + 1, ids[others[o]], scores[o]) for n, o in enumerate(order)]
    near = collision_search.nearest(rows, asked).collect()
    assert sent[3] < 300 and {r.query_id for r in near} == set(got)


def test_very_large_and_small_vectors(spark):
    """Cosines of finite vectors of any size; products beyond exact longs are refused."""
    rng = np.random.default_rng(12)
    plain = rng.normal(size=(40, 6))
    sizes = 10.0 ** rng.choice([-200, -3, 0, 5, 200], 40)
    kind = "vec_id long, embedding array<double>"
    rows = [spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], kind)
            for m in (plain, plain * sizes[:, None])]
    got = [sorted((r.query_id, r.vec_id, round(r.score, 9)) for r in
                  collision_search.nearest(df, df.where("vec_id % 10 = 0")).collect()) for df in rows]
    assert got[0] == got[1] and len(got[0]) == 20
    with pytest.raises(Exception, match="no exact longs"):
        inner_products.largest(rows[1], rows[1].where("vec_id % 10 = 0")).collect()


def test_block_of_vectors_returns_its_best_only(monkeypatch):
    """A search widens its windows no further than the k-th verified vector, and keeps k pairs a query."""
    rng = np.random.default_rng(5)
    x, ids = rng.normal(size=(6000, 24)), np.arange(6000)
    x[4000:4040] = x[7]
    asked = ids[:4000:50]
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    counts = []
    monkeypatch.setattr(collision_search, "verified", lambda block, rows, *rest, whole=collision_search.verified:
                        counts.append(len(rows)) or whole(block, rows, *rest))
    q, r, s = collision_search.Block(ids, x, 5)(asked, x[asked], np.full(len(asked), -np.inf))
    assert len(q) == 5 * len(asked) and 0 < sum(counts) < 0.5 * len(asked) * len(x)
    hits = 0
    for i, own in enumerate(asked):
        cosines = np.where(ids == own, -9, unit @ unit[own])
        assert s[q == i] == pytest.approx(cosines[r[q == i]], abs=1e-12)
        hits += len(set(r[q == i]) & set(np.argsort(-cosines)[:5]))
    assert hits >= 0.95 * len(q)
    q, r, s = collision_search.Block(ids, x, 5)(np.array([4001]), x[[7]], np.full(1, -np.inf))
    assert r.tolist() == [7, 4000, 4002, 4003, 4004] and len(set(s.tolist())) == 1


@pytest.mark.parametrize("size", [1, 4, 70_000])
def test_blocks_of_few_and_many_vectors(size):
    """All of fewer than k rows are found, and places beyond two bytes."""
    rng = np.random.default_rng(6)
    x, ids = rng.normal(size=(size, 3)), np.arange(1, size + 1)
    x[size // 2:] *= -1
    asked = np.concatenate([x[:1], -x[:1], x[-1:]])
    q, r, s = collision_search.Block(ids, x, 5)(np.zeros(3, np.int64), asked, np.full(3, -np.inf))
    assert len(q) == 3 * min(size, 5)
    unit = [m / np.linalg.norm(m, axis=1)[:, None] for m in (asked, x)]
    best = -np.sort(-unit[0] @ unit[1].T, axis=1)[:, :min(size, 5)]
    got = np.stack([-np.sort(-s[q == i]) for i in range(3)])
    assert got[:, 0] == pytest.approx(best[:, 0], abs=1e-12) and (got > best - 0.001).all()
