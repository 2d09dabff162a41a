"""The registered queries of the corpus operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import divergence, exact_dedup, jaccard, katz, langid, license_scan, mixing, packing, periodic, substring, topk, toxicity, url_filter
from tidemark.llm.common import SPACE, dealt_out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).drop("locator")


OP1_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS n FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY n) AS group_size,
       row_number() OVER w = 1 AS kept,
       sha256(n) AS text_sha256
FROM d
WINDOW w AS (PARTITION BY n ORDER BY length(t) DESC, doc_id NULLS LAST)
"""

def op2_katz_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 != 1, F.lit(True))
    return katz.Katz(table(spark, sf_dir, "documents"), train).scores()


def op3_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", topk.quantised(F.col("embedding")).alias("vector"))
    return topk.top_k(vectors, F.col("vec_id") % 20 == 0, k=20)


OP3_SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
n AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY q) AS copy FROM v),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i])) AS BIGINT) AS score
  FROM n a JOIN n b ON a.vec_id % 20 = 0 AND a.copy = 1 AND len(a.q) = len(b.q) AND (a.vec_id <> b.vec_id OR b.copy > 1)
),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.filter_urls(pages, url_filter.repeated(pages))


OP4_SQL = r"""
WITH p AS (
  SELECT page_id, url,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
         regexp_extract(url, '(?s)^.*?://[^/?#]*[^?#]*\?([^#]*)', 1) AS query
  FROM pages
),
c AS (
  SELECT *, CASE WHEN contains(url, '://') THEN regexp_replace(host, '^www\.', '') || regexp_replace(path, '/+$', '') ||
    CASE WHEN len(k) > 0 THEN '?' || array_to_string(k, '&') ELSE '' END END AS canonical
  FROM (SELECT *, list_sort(list_filter(string_split(query, '&'), lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref)='))) AS k FROM p)
),
l AS (SELECT canonical, min(page_id) AS spared FROM c WHERE canonical IS NOT NULL GROUP BY canonical HAVING count(*) > 1),
r AS (
  SELECT c.page_id, c.host, c.path, l.canonical IS NOT NULL AS listed, coalesce(l.spared = c.page_id, false) AS spared,
         CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
              WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
              WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
              WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM c LEFT JOIN l ON c.canonical = l.canonical
)
SELECT page_id, host, path, rule, listed,
       CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN listed AND NOT spared THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.JaccardJoin(table(spark, sf_dir, "documents")).result().drop("place")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("place")


def _fill_sql(children: str, parent: str, name: str) -> str:
    """SQL for one level of the tree: children(parent, name, supply, weight, budget) with what each is given."""
    return f"""
  SELECT *, CASE WHEN capped THEN supply
                 ELSE ((budget - sum(CASE WHEN capped THEN supply ELSE 0 END) OVER (PARTITION BY {parent})) * weight)
                      // sum(CASE WHEN capped THEN 0 ELSE weight END) OVER (PARTITION BY {parent}) END AS given
  FROM (SELECT *, supply * sum(weight) OVER (PARTITION BY {parent} ORDER BY supply / weight, {name} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
               <= weight * (budget - coalesce(sum(supply) OVER (PARTITION BY {parent} ORDER BY supply / weight, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS capped
        FROM {children})"""


OP7_SQL = rf"""
WITH c AS (  -- CRC-32 by its table, one byte at a time
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda a, b: CASE WHEN a % 2 = 1 THEN xor(3988292384, a // 2) ELSE a // 2 END)) AS t
),
k AS (
  SELECT source, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, strlen(source) + 1), lambda i: CAST(ascii(source[i]) AS BIGINT))),
         lambda a, b: xor(CAST(t[1 + xor(a % 256, b)] AS BIGINT), a // 256)) AS h
  FROM (SELECT DISTINCT coalesce(source, '') AS source FROM documents), c
),
d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(d.source, '') AS source, 'domain' || (xor(4294967295, k.h) % 4) AS domain,
         len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS tokens
  FROM documents d JOIN k ON k.source = coalesce(d.source, '')
),
l3 AS (SELECT domain, lang, source, CAST(sum(tokens) AS BIGINT) AS tokens, CAST(2 * sum(tokens) AS BIGINT) AS supply, 1 AS weight FROM d GROUP BY ALL),
l2 AS (SELECT domain, lang, CAST(sum(supply) AS BIGINT) AS supply, CASE lang WHEN 'en' THEN 8 WHEN 'de' THEN 4 WHEN 'fr' THEN 2 WHEN 'es' THEN 2 ELSE 1 END AS weight FROM l3 GROUP BY ALL),
l1 AS (SELECT domain, CAST(sum(supply) AS BIGINT) AS supply, CASE domain WHEN 'domain0' THEN 4 WHEN 'domain1' THEN 2 ELSE 1 END AS weight,
              (SELECT coalesce(CAST(sum(tokens) AS BIGINT), 0) * 3 // 4 FROM l3) AS budget, 0 AS root FROM l2 GROUP BY ALL),
g1 AS ({_fill_sql("l1", "root", "domain")}),
b2 AS (SELECT l2.*, g1.given AS budget FROM l2 JOIN g1 USING (domain)),
g2 AS ({_fill_sql("b2", "domain", "lang")}),
b3 AS (SELECT l3.*, g2.given AS budget FROM l3 JOIN g2 USING (domain, lang)),
g3 AS ({_fill_sql("b3", "domain, lang", "source")}),
leaf AS (SELECT domain, lang, source, CASE WHEN tokens = 0 THEN 0 ELSE given // tokens END AS whole, CASE WHEN tokens = 0 THEN 0 ELSE given % tokens END AS part FROM g3),
o AS (SELECT d.*, whole, part, md5('17:' || CAST(whole AS BIGINT) || ':' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key FROM d JOIN leaf USING (domain, lang, source))
SELECT doc_id, domain, lang, source, tokens,
       CAST(whole + CASE WHEN sum(tokens) OVER (PARTITION BY domain, lang, source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) <= part THEN 1 ELSE 0 END AS BIGINT) AS copies
FROM o
"""


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.dedup_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out("doc_id")))
    judged = dealt_out(docs).select("doc_id", langid.held_out("doc_id").alias("held_out"), langid.predict(docs, model, F.col("text")).alias("of"))
    return judged.select("doc_id", "held_out", F.col("of.lang").alias("lang_pred"), F.col("of.score").alias("score"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.judged(table(spark, sf_dir, "documents"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    judge = toxicity.train(dealt_out(docs), labels.where(~toxicity.held_out("doc_id")))
    judged = dealt_out(docs).select("doc_id", toxicity.held_out("doc_id").alias("held_out"), toxicity.score(docs, judge, F.col("text")).alias("of"))
    evidence = F.slice("of.evidence", 1, 3).alias("evidence")
    return judged.select("doc_id", "held_out", F.col("of.score").alias("score"), F.when(F.col("of.score") >= 0.5, 1).otherwise(0).alias("predicted"), evidence)


def planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in every tenth document, by the CRC-32 of its id, all words from some place on repeat with some period;
    the others, and rows without an id, are as they were."""
    h, words = F.crc32(F.col("doc_id").cast("string")), F.array_remove(F.split("text", SPACE + "+"), "")
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), h.alias("h"))
    rows = rows.selectExpr("*", "h div 10 AS g").withColumn("w", F.when((F.col("h") % 10 == 0) & (F.size(words) > 0), words)).selectExpr("*", "IF(w IS NULL, NULL, size(w)) AS n")
    rows = rows.selectExpr("*", "CAST(g % n AS int) AS a").selectExpr("*", "CAST(1 + (n - a) div (3 + g % 8) AS int) AS p")
    again = "slice(flatten(array_repeat(slice(w, a + 1, p), CAST((n - a + p - 1) div p AS int))), 1, n - a)"
    return rows.selectExpr("doc_id", f"coalesce(array_join(concat(slice(w, 1, a), {again}), ' '), text) AS text")


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = planted(dealt_out(table(spark, sf_dir, "documents"))).select("doc_id", periodic.periodic_runs(F.col("text")).alias("of"))
    lines = F.array_join(F.transform("of.runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    best = [F.col(f"of.best.{c}").alias(c) for c in ("start", "length", "period")]
    return found.select(
        "doc_id", F.size("of.runs").cast("long").alias("n_runs"), *best, F.expr("1000 * of.best.length div of.best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("of.collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
),
o AS (SELECT id, lang, source, unnest(words) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM o GROUP BY ALL),
k AS (SELECT lang, term, count(*) AS n FROM o GROUP BY ALL HAVING count(DISTINCT id) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
f AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS n_lang
      FROM g JOIN k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS (SELECT *, 1 + 1000000000::HUGEINT * (n + 5) // (sum(n) OVER w + 5 * count(*) OVER w) AS p,
             1 + 1000000000::HUGEINT * (n_lang + 5) // (sum(n_lang) OVER w + 5 * count(*) OVER w) AS q
      FROM f WINDOW w AS (PARTITION BY lang, source)),
s AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE n > 0 AND p > q
)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM r
QUALIFY part = 'pair' OR rank <= 50
"""


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_katz_score": op2_katz_score,
    "op3_topk_search": op3_topk_search,
    "op4_url_filter": op4_url_filter,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_packing": op6_packing,
    "op7_mixing": op7_mixing,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_language_id": op9_language_id,
    "op10_license_scan": op10_license_scan,
    "op11_toxicity": op11_toxicity,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_source_divergence": op13_source_divergence,
}
ORACLE_SQL = {
    "op1_exact_dedup": OP1_SQL,
    "op3_topk_search": OP3_SQL,
    "op4_url_filter": OP4_SQL,
    "op7_mixing": OP7_SQL,
    "op13_source_divergence": OP13_SQL,
}
