"""One query per numbered operator, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .audit import ORDERS, filter_audit
from .bpe import decode_documents, encode_documents
from .common import read
from .counts import token_budget
from .exact import exact_dedup
from .html import extract
from .lexical import ranked_search
from .lines import line_report
from .packing import pack
from .pii import BASE, personal_data, span_list
from .quality import quality
from .simhash import near_duplicates
from .urls import SITE_RULES, TOPIC_RULES, filter_urls
from .vectors import exact_top_k

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(func: Query) -> Query:
    QUERIES[func.__name__] = func
    return func


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


@query
def op1_simhash(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents"), shingle=4, radius=4)


@query
def op2_quality(spark, sf_dir):
    facts = quality(read(spark, sf_dir, "documents"))
    return facts.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


@query
def op3_url_filter(spark, sf_dir):
    pages = filter_urls(read(spark, sf_dir, "pages").select("page_id", "url"))
    return pages.select(
        "page_id", *[F.col("url_filter").getField(c).alias(c) for c in ("host", "path", "rule", "verdict")]
    )


def _rule_rows(rules) -> str:
    return ",\n".join(
        f"({sql_text(r.name)}, {sql_text(r.verdict)}, {sql_text(r.pattern)}, {r.rank})" for r in rules
    )


ORACLES["op3_url_filter"] = rf"""
WITH parts AS (
  SELECT page_id,
    CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
keyed AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts),
rules(name, verdict, pattern, rank) AS (VALUES
{_rule_rows((*SITE_RULES, *TOPIC_RULES))}),
fits AS (
  SELECT DISTINCT ON (host, path) host, path, name, verdict, rank
  FROM (SELECT DISTINCT host, path FROM keyed), rules
  WHERE regexp_matches(concat(host, path), pattern)
  ORDER BY host, path, rank DESC, name DESC)
SELECT page_id, k.host, k.path,
  CASE WHEN rank >= 1000000 THEN name END AS rule,
  coalesce(verdict, 'allow') AS verdict
FROM keyed k LEFT JOIN fits f ON k.host = f.host AND k.path = f.path
"""


@query
def op4_bpe_codec(spark, sf_dir):
    coded = decode_documents(encode_documents(read(spark, sf_dir, "documents")))
    return coded.select(
        "doc_id",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("token_ids", ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


@query
def op5_exact_dedup(spark, sf_dir):
    return exact_dedup(read(spark, sf_dir, "documents"), keep="max")


ORACLES["op5_exact_dedup"] = """
SELECT doc_id,
  max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
  count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
  sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""


@query
def op6_token_counts(spark, sf_dir):
    return token_budget(read(spark, sf_dir, "documents"), 512)


@query
def op7_personal_data(spark, sf_dir):
    found = personal_data(read(spark, sf_dir, "documents"))
    counts = [
        F.size(F.filter("base", lambda x: x["kind"] == k.name)).cast("long").alias(f"n_{k.name}")
        for k in BASE
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(span_list(F.col("base")), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
    )


@query
def op8_line_dedup(spark, sf_dir):
    found = line_report(read(spark, sf_dir, "documents"), min_words=5, max_edits=1, exact_words=1)
    return found.select(
        "doc_id",
        "n_lines",
        F.size("dropped").cast("long").alias("n_dropped"),
        F.array_join("dropped", ",").alias("dropped"),
    )


ORACLES["op8_line_dedup"] = r"""
WITH cut AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
split AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS line_no FROM cut),
worded AS (
  SELECT doc_id, line_no, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS w FROM split),
occ AS (
  SELECT doc_id, line_no, w, array_to_string(w, ' ') AS line FROM worded WHERE len(w) >= 1),
texts AS (
  SELECT line, any_value(w) AS w, min({'d': doc_id, 'n': line_no}) AS first FROM occ GROUP BY line),
long AS (SELECT * FROM texts WHERE len(w) >= 5),
variants AS (
  SELECT line, first, i AS place,
    array_to_string(list_concat(w[1:i - 1], w[i + 1:]), ' ') AS v
  FROM (SELECT line, first, w, unnest(range(1, len(w) + 1)) AS i FROM long)),
near AS (
  SELECT a.line FROM variants a JOIN variants b
    ON a.v = b.v AND a.place = b.place AND b.first < a.first
  UNION SELECT a.line FROM variants a JOIN long b ON a.v = b.line AND b.first < a.first
  UNION SELECT b.line FROM variants a JOIN long b ON a.v = b.line AND a.first < b.first),
dropped AS (
  SELECT doc_id, line_no FROM occ JOIN texts USING (line)
  WHERE {'d': doc_id, 'n': line_no} > first OR line IN (SELECT line FROM near)),
per_doc AS (
  SELECT doc_id, count(*) AS n_dropped,
    string_agg(line_no::VARCHAR, ',' ORDER BY line_no) AS dropped
  FROM dropped GROUP BY doc_id)
SELECT c.doc_id, len(lines) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
  coalesce(dropped, '') AS dropped
FROM cut c LEFT JOIN per_doc p ON c.doc_id = p.doc_id
"""


@query
def op9_best_fit_packing(spark, sf_dir):
    found = pack(read(spark, sf_dir, "documents"), 4096)
    return found.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


@query
def op10_html_text(spark, sf_dir):
    pages = extract(read(spark, sf_dir, "pages"), text_col="text")
    return pages.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op11_top_k_search(spark, sf_dir):
    return exact_top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


ORACLES["op11_top_k_search"] = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding))
SELECT q.vec_id AS query_id,
  row_number() OVER (PARTITION BY q.r ORDER BY list_dot_product(q.e, c.e) DESC, c.vec_id)::INTEGER AS rank,
  c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
FROM v q JOIN v c ON q.r <> c.r
WHERE q.vec_id % 20 = 0
QUALIFY rank <= 20
"""


@query
def op12_filter_audit(spark, sf_dir):
    return filter_audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


ORACLES["op12_filter_audit"] = rf"""
WITH orders(filter_order) AS (VALUES {", ".join(f"('{o}')" for o in ORDERS)}),
docs AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
worded AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
    min(doc_id) OVER (PARTITION BY text) AS first
  FROM docs),
flags AS (
  SELECT doc_id, part,
    concat(
      CASE WHEN len(w) < 100 THEN 'A' ELSE '' END,
      CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END,
      CASE WHEN 100 * len(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * len(text) THEN 'C' ELSE '' END,
      CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END,
      CASE WHEN first < doc_id THEN 'E' ELSE '' END) AS fails
  FROM worded),
judged AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
sets AS (
  SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM flags LEFT JOIN judged USING (doc_id) GROUP BY part, fails),
steps AS (
  SELECT filter_order, step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS before
  FROM orders, (SELECT unnest(range(1, 6))::INTEGER AS step)),
met AS (
  SELECT part, filter_order, step, f, n, good, toxic, contains(fails, f) AS hit,
    before <> '' AND regexp_matches(fails, '[' || before || '_]') AS gone, fails = f AS only_this
  FROM sets, steps),
summed AS (
  SELECT part, filter_order, step, f,
    coalesce(sum(n) FILTER (NOT hit AND NOT gone), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (hit AND NOT gone), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (hit AND gone), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (only_this), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (hit AND NOT gone), 0)::BIGINT AS good_lost,
    coalesce(sum(toxic) FILTER (hit AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM met GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM summed
"""


@query
def op13_lexical_search(spark, sf_dir):
    return ranked_search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), k=10)


ORACLES["op13_lexical_search"] = r"""
WITH occ AS (
  SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
post AS (SELECT doc_id, term, count(*) AS tf FROM occ GROUP BY ALL),
sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM post GROUP BY doc_id),
corpus AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
norms AS (SELECT doc_id, 100 - 90 + (90 * n * n_docs) // n_terms AS m FROM sizes, corpus),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w
  FROM post, corpus GROUP BY term),
scored AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN post USING (term) JOIN norms USING (doc_id)
  GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank,
  doc_id, score
FROM scored WHERE score > 0
QUALIFY rank <= 10
"""
