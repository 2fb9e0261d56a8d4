"""Mixing sources to target weights by Poisson replication.

A source of size s (UTF-8 bytes of its texts) that is to make up the share w of a mixture of size t
has the target repetition rate t * w / s. Every document is repeated as often as a Poisson variable
with that mean says; the variable is the inverse of the distribution at a number in [0, 1) hashed
from seed and document id, so it is the same in every run. Means above 16 are split into equal
parts with a number each, whose counts are added. Copies are dealt out by a hash of seed, id and
copy, and ordered by it within partitions, which is a global shuffle.

A null source is a source of its own. A null id hashes like an empty one; rows with the same id get
the same count. Null and empty texts have size 0 and take part; sources of size 0, and sources
without a weight, get the rate 0. Weights are
added with twelve decimals. Columns named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.functions.storage import pinned
from daymark.llm.names import ROW, packed

#: Largest mean of one Poisson variable, and how many values its table has (more than that has a
#: chance below 1e-17).
PART_MEAN, TERMS = 16.0, 64
#: Sources whose rates are broadcast at most; each has a table of about 0.5 KB.
BROADCAST_SOURCES = 10_000
MADE = ("rate", "n_copies", "copy", "shuffle_key")


def _name(column: str) -> Column:
    return F.col(f"`{column}`")


def hashed(seed: int, *parts: Column) -> Column:
    """52 bits of a digest of seed and parts."""
    text = F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def source_rates(docs: DataFrame, weights: DataFrame | None, power: float = 0.5,
                 total: float | None = None, source: str = "source", text: str = "text") -> DataFrame:
    """A row per source: its target repetition rate and the table of its Poisson distribution.

    weights: (source, weight), of any scale; without it a source weighs its size to the given
    power. total: bytes of the mixture, by default the bytes of the documents.
    """
    sizes = docs.groupBy(_name(source).alias("s")).agg(
        F.sum(F.coalesce(F.octet_length(_name(text)), F.lit(0)).cast("long")).alias("size"))
    if weights is None:
        weighed = sizes.withColumn("w", F.pow(F.col("size").cast("double"), F.lit(power)))
    else:
        given = weights.groupBy(F.col("source").alias("of")).agg(F.sum("weight").cast("double").alias("w"))
        weighed = sizes.join(given, F.col("s").eqNullSafe(F.col("of")), "left") \
            .select("s", "size", F.greatest(F.coalesce("w", F.lit(0.0)), F.lit(0.0)).alias("w"))
    weighed = weighed.where("size > 0 AND w > 0")
    # A sum of decimals, unlike one of doubles, does not depend on the order of its terms.
    whole = weighed.agg(F.sum(F.col("w").cast("decimal(38,12)")).cast("double").alias("all_w"),
                        F.sum("size").alias("all_size"))
    goal = F.lit(float(total)) if total is not None else F.col("all_size").cast("double")
    rates = weighed.crossJoin(F.broadcast(whole)).select(
        "s", (goal * F.col("w") / F.col("all_w") / F.col("size")).alias("rate"))
    rates = rates.withColumn("parts", F.greatest(F.lit(1), F.ceil(F.col("rate") / PART_MEAN)).cast("int"))
    mean = F.col("rate") / F.col("parts")
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("sums"))
    table = F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, lambda state, k: F.struct(
        (state["p"] * mean / k).alias("p"),
        F.concat(state["sums"], F.array(F.element_at(state["sums"], -1) + state["p"] * mean / k))
        .alias("sums")))
    return rates.withColumn("sums", table["sums"])


def mix(docs: DataFrame, weights: DataFrame | None = None, power: float = 0.5,
        total: float | None = None, seed: int = 7, doc_id: str = "doc_id",
        source: str = "source", text: str = "text") -> DataFrame:
    """Every document as often as drawn, with rate, n_copies, copy (from 1) and shuffle_key."""
    rates = pinned(source_rates(docs, weights, power, total, source, text), "rates")
    # With few sources their tables go to all tasks and texts need no exchange for the join; with
    # more, rows and sources are brought together by an exchange.
    rates = F.broadcast(rates) if rates.count() <= BROADCAST_SOURCES else rates
    given = docs.select(packed(docs, MADE), _name(source).alias("of"),
                        F.coalesce(_name(doc_id).cast("string"), F.lit("")).alias("key"))
    drawn = F.transform(F.sequence(F.lit(1), F.col("parts")), lambda part: F.size(F.filter(
        "sums", lambda s: s <= hashed(seed, F.col("key"), part) / F.lit(float(1 << 52)))))
    count = F.aggregate(drawn, F.lit(0), lambda a, b: a + b)
    counted = given.join(rates, F.col("of").eqNullSafe(F.col("s"))) \
        .select(ROW, "key", "rate", count.alias("n_copies")).where("n_copies > 0")
    copies = counted.select("*", F.explode(F.sequence(F.lit(1), F.col("n_copies"))).alias("copy"))
    copies = copies.withColumn("shuffle_key", hashed(seed, F.col("key"), F.lit("copy"), F.col("copy")))
    return copies.repartition("shuffle_key").sortWithinPartitions("shuffle_key") \
        .select(f"{ROW}.*", *MADE)
