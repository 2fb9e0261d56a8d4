"""A corpus pipeline: toxicity, near-duplicates, personal data, mixture, SentencePiece ids.

Each stage takes (spark, docs, sf_dir), works on all rows that it is given and, but for the last,
returns the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from public_tokenizers import path as tokenizer

from daymark.functions.storage import pinned
from daymark.llm import mixing, near_duplicates, pieces, pseudonyms, toxicity
from daymark.llm.catalog import held_out, pseudonym_key, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out())
    return toxicity.score(docs.select(*COLUMNS), model).where("predicted = 0").select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are the smallest id of their group of near-duplicates.

    Of rows that repeat a kept id one stays, that with the smallest hash of its text. Rows without an
    id are no near-duplicates of others: of equal texts one stays, and none that a row with an id has.
    """
    gone = near_duplicates.near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    left = docs.select(*COLUMNS).join(gone, "doc_id", "left_anti")
    named = left.where("doc_id IS NOT NULL")
    again = named.groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1").select("doc_id")
    kept = named
    if not again.isEmpty():
        one = named.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(
            F.min_by(F.struct(*COLUMNS[1:]), F.struct(F.xxhash64("text"), *COLUMNS[1:])).alias("row"))
        kept = named.join(again, "doc_id", "left_anti").unionByName(one.select("doc_id", "row.*"))
    if not docs.where("doc_id IS NULL").isEmpty():
        digest = F.sha2(F.coalesce(F.col("text").cast("binary"), F.lit(b"")), 256).alias("digest")
        one = left.where("doc_id IS NULL").groupBy(digest).agg(
            F.min(F.struct(*COLUMNS[1:])).alias("row"))
        known = docs.where("doc_id IS NOT NULL").select(digest)
        kept = kept.unionByName(one.join(known, "digest", "left_anti").select(
            F.lit(None).cast(docs.schema["doc_id"].dataType).alias("doc_id"), "row.*"))
    return kept.select(*COLUMNS)


def with_pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms in place of personal numbers, dates and addresses."""
    found = pseudonyms.pseudonymize(docs.select(*COLUMNS), pseudonym_key(spark))
    return found.withColumn("n_chars", F.when(F.col("n_replaced") > 0, F.length("text").cast("long"))
                            .otherwise(F.col("n_chars"))).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target weights of their sources, in a global shuffle."""
    return mixing.mix(docs.select(*COLUMNS)).select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their texts and the texts decoded from them."""
    return pieces.encode_decode(docs.select(*COLUMNS), tokenizer("piece_bpe_32k.model")) \
        .withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [("toxicity", without_toxic), ("near_duplicates", one_of_each_group),
          ("pseudonyms", with_pseudonyms), ("mixing", mixed), ("pieces", encoded)]

#: Near-duplicate groups, learned weights and pieces have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = pinned(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
