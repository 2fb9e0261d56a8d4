"""URL rules by host and path: the longest rule that fits decides.

Each distinct (host, path) is expanded into expressions, one for every host suffix with every path
prefix that ends at a slash; the expressions meet the rules in an equi-join on the first hex digits
of a digest. What the join proposes is confirmed on full digests: of the expression, and of the
host suffix with as much of the path as the rule names, so a rule's path may end anywhere.

A null url, or one without "://", has an empty host and path and fits no rule. Rules with a null
or empty host, a null path or a null verdict are left out. Of rules of equal length the one with
the longer host wins, then a block before an allow. Repeated pages each get their verdict.
Columns of the pages named like a result are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.llm.names import ROW, packed

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Hex digits of the digests that are joined on.
PREFIX_DIGITS = 8
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    """What follows the first "://" up to "/", "?", "#" or the end, with A-Z lower-cased."""
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host up to "?", "#" or the end."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def _digest(text: Column) -> Column:
    return F.sha2(text, 256)


def _slashes(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit("/"), F.lit("")))


def _folder(text: Column) -> Column:
    """A path up to its last slash."""
    return F.regexp_extract(text, r"(?s)^.*/", 0)


def prepared(rules: DataFrame) -> DataFrame:
    """Rules (host, path, verdict) with their digests."""
    known = rules.select(F.translate("host", UPPER, LOWER).alias("rule_host"),
                         F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict"))
    known = known.where((F.col("rule_host") != "") & F.col("rule_path").isNotNull()
                        & F.col("rule_verdict").isNotNull()).distinct()
    step = _digest(F.concat("rule_host", _folder(F.col("rule_path"))))
    return known.select("*", F.concat("rule_host", "rule_path").alias("rule"),
                        step.alias("rule_step"), F.substring(step, 1, PREFIX_DIGITS).alias("prefix"),
                        _digest(F.concat("rule_host", "rule_path")).alias("rule_digest"))


def expressions(places: DataFrame, labels: int, depth: int) -> DataFrame:
    """A row for each host suffix of at most `labels` labels and path prefix of `depth` slashes."""
    parts = F.split("host", r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.greatest(F.lit(1), F.size(parts) - (labels - 1)), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    steps = F.transform(
        F.sequence(F.lit(0), F.least(_slashes(F.col("path")), F.lit(depth))),
        lambda n: F.when(n == 0, "").otherwise(
            F.concat(F.array_join(F.slice(F.split("path", "/", -1), 1, n), "/"), F.lit("/"))))
    each = places.where("host <> ''").select("host", "path", F.explode(suffixes).alias("suffix"))
    each = each.select("*", F.explode(steps).alias("step"))
    return each.select("host", "path", "suffix",
                       _digest(F.concat("suffix", "step")).alias("digest")) \
        .withColumn("prefix", F.substring("digest", 1, PREFIX_DIGITS))


def judge(pages: DataFrame, rules: DataFrame, url: str = "url", otherwise: str = "allow") -> DataFrame:
    """The pages with host, path, rule (null where none fits) and verdict.

    Only as many labels and slashes as the longest rule has are expanded; those two numbers are
    all that the driver reads.
    """
    made = ("host", "path", "rule", "verdict")
    known = prepared(rules)
    most = known.agg(F.max(F.size(F.split("rule_host", r"\.", -1))).alias("labels"),
                     F.max(_slashes(F.col("rule_path"))).alias("depth")).first()
    given = pages.select(host(F.col(f"`{url}`")).alias("host"), path(F.col(f"`{url}`")).alias("path"),
                         packed(pages, made))
    found = expressions(given.select("host", "path").distinct(), most.labels or 1, most.depth or 0) \
        .join(known, "prefix") \
        .where((F.col("digest") == F.col("rule_step"))
               & (_digest(F.concat("suffix", F.expr("left(path, length(rule_path))")))
                  == F.col("rule_digest")))
    best = found.groupBy("host", "path").agg(F.max_by(
        F.struct("rule", "rule_verdict"),
        F.struct(F.length("rule"), F.length("rule_host"), F.col("rule_verdict") == "block",
                 "rule_verdict")).alias("best"))
    return given.join(best, ["host", "path"], "left").select(
        f"{ROW}.*", "host", "path",
        F.col("best.rule").alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(otherwise)).alias("verdict"))
