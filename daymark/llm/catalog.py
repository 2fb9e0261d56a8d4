"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from public_tokenizers import path as tokenizer

from daymark.llm import (class_model, collision_search, conversations, decontamination, inner_products, mixing,
                         near_duplicates, pieces, pseudonyms, token_counts, toxicity, url_rules, whitening)

#: The session setting that names the secret key of pseudonyms, and the key of sessions without it, as in tests.
KEY_SETTING, PSEUDONYM_KEY = "spark.daymark.pseudonym.key", "pseudonyms of round two"
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
         ("org", "/fr/", "allow")]
_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_nearest(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return collision_search.nearest(rows, rows.where("vec_id % 50 = 0"))


def op2_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {_RULES_SQL} AS rules(host, path, verdict)")
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_rules.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).selectExpr(
        *DOCUMENT, "round(rate, 6) AS rate", "n_copies", "copy", "shuffle_key")


def op4_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


def op5_class_model(spark: SparkSession, folder: str) -> DataFrame:
    return class_model.score_texts(table(spark, folder, "documents").select("doc_id", "text"))


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, tokenizer("byte_bpe_50k.json"))


def held_out(third: int = 1):
    """Rows whose crc32 of the id as text leaves this remainder by three; a null id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == third, F.lit(False))


def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, folder, "labels"), ~held_out())
    return toxicity.score(docs, model, keep=["doc_id"]).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op8_inner_products(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return inner_products.largest(rows, rows.where("vec_id % 50 = 0"))


def op9_pieces(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pieces.digests(pieces.encode_decode(docs, tokenizer("piece_bpe_32k.model")))


def pseudonym_key(spark: SparkSession) -> str:
    """The key of the session; who knows it can reverse every pseudonym."""
    return spark.conf.get(KEY_SETTING, PSEUDONYM_KEY)


def op10_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return pseudonyms.pseudonymize(docs, pseudonym_key(spark))


def op11_conversations(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    return conversations.repaired_digests(conversations.damaged(rows), rows)


def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return whitening.whiten(rows).withColumn("deviation", F.col("deviation").cast("long"))


def op13_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontamination.decontaminate(docs, table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), "contaminated")


OP2_SQL = f"""
WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {_RULES_SQL}),
places AS (SELECT page_id,
  coalesce(translate(regexp_extract(url, '{url_rules._URL}', 1), '{url_rules.UPPER}', '{url_rules.LOWER}'), '') AS host,
  coalesce(regexp_extract(url, '{url_rules._URL}', 2), '') AS path FROM pages),
best AS (SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
  arg_max(rule_verdict, length(rule_host || rule_path)) AS rule_verdict
 FROM (SELECT DISTINCT host, path FROM places) JOIN rules
 ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
 GROUP BY host, path)
SELECT page_id, p.host, p.path, rule, coalesce(rule_verdict, 'allow') AS verdict
FROM places p LEFT JOIN best b ON p.host = b.host AND p.path = b.path"""

OP3_SQL = f"""
WITH RECURSIVE sizes AS (SELECT source AS s, sum(coalesce(strlen(text), 0)) AS size
 FROM documents GROUP BY source),
weighed AS (SELECT s, size, sqrt(CAST(size AS DOUBLE)) AS w FROM sizes WHERE size > 0),
rates AS (SELECT s, CAST((SELECT sum(size) FROM weighed) AS DOUBLE) * w / (SELECT CAST(sum(CAST(w AS DECIMAL(38,12))) AS DOUBLE) FROM weighed)
 / size AS rate FROM weighed),
parted AS (SELECT s, rate, greatest(1, CAST(ceil(rate / 16.0) AS INTEGER)) AS parts FROM rates),
term(s, k, p, total) AS (SELECT s, 0, exp(-rate / parts), exp(-rate / parts) FROM parted
 UNION ALL SELECT t.s, k + 1, p * (rate / parts) / (k + 1), total + p * (rate / parts) / (k + 1)
 FROM term t JOIN parted r ON t.s IS NOT DISTINCT FROM r.s WHERE k < {mixing.TERMS}),
drawn AS (SELECT d.*, rate, unnest(range(1, parts + 1)) AS part FROM documents d
 JOIN parted r ON d.source IS NOT DISTINCT FROM r.s),
counted AS (SELECT doc_id, text, d.lang, d.source, n_chars, rate, CAST(count(*) AS INTEGER) AS n_copies
 FROM drawn d JOIN term t ON d.source IS NOT DISTINCT FROM t.s AND total <=
  CAST('0x' || substr(md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || part), 1, 13) AS BIGINT)
  / 4503599627370496.0 GROUP BY ALL),
copies AS (SELECT *, CAST(unnest(range(1, n_copies + 1)) AS INTEGER) AS copy FROM counted)
SELECT doc_id, text, lang, source, n_chars, round(rate, 6) AS rate, n_copies, copy,
 CAST('0x' || substr(md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':copy:' || copy), 1, 13)
 AS BIGINT) AS shuffle_key FROM copies"""

OP8_SQL = """
WITH whole AS (SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
 WHERE embedding IS NOT NULL AND len(embedding) > 0
 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (SELECT q.vec_id AS query_id, d.vec_id, CAST(list_dot_product(q.v, d.v) AS BIGINT) AS score
 FROM whole q JOIN whole d ON q.vec_id % 50 = 0 AND q.vec_id <> d.vec_id)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (
 PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored) WHERE place <= 5"""

OP13_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
bw AS (SELECT item, w, least(len(w), 10) AS k, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS t FROM bw),
sizes AS (SELECT DISTINCT k FROM windows),
dw AS (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k),
hits AS (SELECT r, i, x.k, item FROM (SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS t FROM dw) x
 JOIN windows y ON x.k = y.k AND x.t = y.t),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + k)) AS p
 FROM (SELECT DISTINCT r, i, k FROM hits)) GROUP BY r),
listed AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS ids
 FROM hits GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
 sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN listed USING (r)"""

def _op11_sql() -> str:
    """Repairs as a recursion over rows: per place in the pattern the least text of eight digits of cost and audit."""
    def plus(state: str, cost: str, letters: str) -> str:
        return f"lpad(CAST(CAST(left({state}, 8) AS INTEGER) + {cost} AS VARCHAR), 8, '0') || substr({state}, 9) || '{letters}'"

    def least(*options: str) -> str:
        return f"least({', '.join(options)})"

    closed_a = least("pa", plus("pu", "2", "I"), plus("p0", "4", "II"), plus("ps", "4", "II"))
    closed_u = least("pu", *[plus(p, "2", "I") for p in ("p0", "ps", "pa")])

    def kept(initial: str, *states: str) -> list[str]:
        return [f"CASE WHEN kind = '{initial}' THEN {plus(x, 'more', 'K')} END" for x in states]

    def reroled(*states: str) -> list[str]:
        return [f"CASE WHEN kind <> 'x' THEN {plus(x, '(2 + more)', 'R')} END" for x in states]

    before_u = ("i0", "is_", "ia")
    return f"""
WITH RECURSIVE crc AS (SELECT list(v ORDER BY n) AS t FROM (SELECT n, list_reduce(range(8),
  lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, n) AS v FROM range(256) r(n))),
given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
kinds AS (SELECT given.*, xor(4294967295, list_reduce(list_transform(string_split(key, ''), lambda b: CAST(ascii(b) AS BIGINT)),
  lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295)) % 20 AS k FROM given, crc),
damaged AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
  CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  unnest(range(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM kinds),
placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
  row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS times,
  rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM damaged),
faulty AS (SELECT *, CASE WHEN body = '' THEN 'blank' WHEN times > 1 THEN 'duplicate'
  WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault FROM placed),
ready AS (SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 'x' WHEN left(role, 1) IN ('s', 'u', 'a')
  THEN left(role, 1) ELSE 'o' END AS kind, CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END AS more,
  lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM faulty),
counts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
  count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated,
  count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal FROM ready GROUP BY conv_id),
cells(conv_id, n, i, p0, ps, pu, pa) AS (
 SELECT conv_id, n, 0::BIGINT, '00000000', NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR FROM counts
 UNION ALL SELECT conv_id, n, i, {plus('i0', '3', 'D')}, {least(plus('is_', '3', 'D'), *kept('s', 'i0'))},
  {least(plus('iu', '3', 'D'), *reroled(*before_u), *kept('u', *before_u))},
  {least(plus('ia', '3', 'D'), *reroled('iu'), *kept('a', 'iu'))}
 FROM (SELECT c.conv_id, n, r.i, kind, more, p0 AS i0, ps AS is_, {closed_u} AS iu, {closed_a} AS ia
  FROM cells c JOIN ready r ON c.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = c.i + 1)),
ended AS (SELECT conv_id, least(p0, {closed_a}) AS best FROM cells WHERE i = n),
audits AS (SELECT conv_id, CAST(left(best, 8) AS BIGINT) AS cost, substr(best, 9) AS audit FROM ended),
edits AS (SELECT conv_id, p, substr(audit, p, 1) AS edit, length(replace(substr(audit, 1, p), 'I', '')) AS i
 FROM (SELECT *, unnest(range(1, length(audit) + 1)) AS p FROM audits)),
stay AS (SELECT e.conv_id, edit, CASE WHEN edit <> 'I' THEN role END AS role,
  CASE WHEN edit = 'I' THEN '' ELSE text END AS text, row_number() OVER (PARTITION BY e.conv_id ORDER BY p) AS place
 FROM edits e LEFT JOIN ready r ON e.conv_id IS NOT DISTINCT FROM r.conv_id AND e.i = r.i WHERE edit <> 'D'),
led AS (SELECT *, max(CASE WHEN place = 1 AND edit = 'K' AND left(role, 1) = 's' THEN 1 ELSE 0 END)
  OVER (PARTITION BY conv_id) AS lead FROM stay),
digests AS (SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (place - lead) % 2 = 1 THEN 'user'
  ELSE 'assistant' END || ':' || text, chr(10) ORDER BY place)) AS repaired_sha256 FROM led GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
 coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
 coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON o.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN audits a ON o.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN digests d ON o.conv_id IS NOT DISTINCT FROM d.conv_id"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_nearest, op2_url_filters, op3_mixing, op4_near_duplicates, op5_class_model,
                            op6_token_counts, op7_toxicity, op8_inner_products, op9_pieces, op10_pii,
                            op11_conversations, op12_whitening, op13_decontamination)}
SQL: dict[str, str] = {"op2_url_filters": OP2_SQL, "op3_mixing": OP3_SQL, "op8_inner_products": OP8_SQL,
                       "op11_conversations": _op11_sql(), "op13_decontamination": OP13_SQL}
