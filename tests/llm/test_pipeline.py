"""The pipeline against its stages' brute-force versions."""

import corpus_pipeline
from daymark.llm.catalog import PSEUDONYM_KEY, held_out
from daymark.llm import mixing, pseudonyms, toxicity
from tests.llm.test_texts import brute_force_components


def test_pipeline_equals_its_stages(spark, docs, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = toxicity.score(docs, toxicity.train(docs, labels, ~held_out())).where("predicted = 0").collect()
    groups = brute_force_components([(r.doc_id, r.text) for r in scored])
    kept = docs.where(docs.doc_id.isin([d for d, (_, _, keep) in groups.items() if keep]))
    want = mixing.mix(pseudonyms.pseudonymize(kept, PSEUDONYM_KEY)).select("doc_id", "text").collect()
    got = corpus_pipeline.run(spark, folder)
    assert {"doc_id", "lang", "source", "n_chars", "ids", "decoded", "n_tokens"} == set(got.columns)
    rows = got.collect()
    assert sorted((r.doc_id, r.decoded) for r in rows) == sorted((r.doc_id, r.text.replace("▁", " ")) for r in want)
    assert len(rows) < docs.count() * 1.5


def test_stages_return_the_columns_of_documents(spark, odd, folder):
    docs = odd.selectExpr("doc_id", "text", "'en' AS lang", "source", "length(text) AS n_chars", "1 AS extra")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert tuple(stage(spark, docs, folder).columns) == corpus_pipeline.COLUMNS
    gone = corpus_pipeline.one_of_each_group(spark, docs, folder)
    assert sorted(r.doc_id or 0 for r in gone.collect()) == [1, 4, 5, 6, 7, 9, 10, 11]
    # Rows without an id: of equal texts one stays, and none that a row with an id has.
    more = spark.createDataFrame([(None, t, "en", "s", 1) for t in ("new one", "new one", None, "short text")]
                                 + [(20, "twice", "en", "s", 1), (20, "twice over", "en", "s", 1)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    both = docs.select(*corpus_pipeline.COLUMNS).unionByName(more)
    rows = corpus_pipeline.one_of_each_group(spark, both, folder).collect()
    assert [r.text for r in rows if r.doc_id is None] == ["new one"]
    assert sorted(r.doc_id for r in rows if r.doc_id) == [1, 4, 5, 6, 7, 9, 10, 11, 20]


def test_stages_of_an_empty_table(spark, empty, folder):
    docs = empty.selectExpr("doc_id", "text", "'en' AS lang", "source", "CAST(0 AS long) AS n_chars")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0
