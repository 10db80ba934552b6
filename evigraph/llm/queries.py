"""The operators of this subpackage on the driver's tables, with the agreed result columns."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, collocations, decontamination, exact_topk, jaccard_join, kneser_ney, language_id, periodic_runs, pii, sharding, token_counts, toxicity, url_filter
from .common import persist_table, shared_dir, table

BYTE_BPE = "byte_bpe_50k.tiktoken"
WORD_BPE = "word_bpe_49k.json"
SHARDS = 40
#: Host, path, verdict.
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_digests(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link(table(spark, sf_dir, "documents"), shingle=3, similarity=(9, 10))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").filter(~toxicity.held_out())
    model = toxicity.fit(docs, labels, "toxic")
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    trusted = labels.filter("quality = 1").filter(~toxicity.held_out())
    return kneser_ney.judge(table(spark, sf_dir, "documents"), trusted, labelled=labels.filter(toxicity.held_out()))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # texts are read once: sizes and checksums are kept
    known = persist_table(docs.select("doc_id", F.octet_length("text").alias("bytes"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32")), "sizes")
    map_path = f"{shared_dir(spark)}/slot-maps/documents-{hashlib.sha256(sf_dir.encode()).hexdigest()[:16]}"
    assigned, _ = sharding.assign(known, SHARDS, ["doc_id", "text_crc32"], bytes_col="bytes", map_path=map_path)
    placed = sharding.positions(assigned, ["doc_id", "text_crc32"])
    return placed.select(
        "doc_id", F.col("_size").alias("size"), "text_crc32", F.lit("bytes").alias("law"), F.col("_shard").alias("shard"),
        F.col("_position").cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), F.col("_virtual_slot").alias("virtual_slot"),
    )


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES) + " AS rules(host, path, verdict)")
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules)
    return judged.select("page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"), F.col("_verdict").alias("verdict"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256)


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents")).drop("base")


def looped(docs: DataFrame) -> DataFrame:
    """Documents in one of ten of which (by a checksum of the id) a stretch of the words repeats to the end, so that there are runs to find.

    Without an id or words a text stays as it is.
    """
    words, a, p = F.col("_words"), F.col("_a"), F.col("_p")
    h = F.crc32(F.col("doc_id").cast("string"))
    some = docs.select("doc_id", "text", h.alias("_h"), F.when(h % 10 == 0, F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")).alias("_words"))
    g, n = F.floor(F.col("_h") / 10).cast("bigint"), F.size("_words").cast("bigint")
    some = some.withColumn("_a", F.when(n > 0, g % n)).withColumn("_p", 1 + F.floor((n - a) / (3 + g % 8)).cast("bigint"))
    cycled = F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, (a + (i - a) % p).cast("int"))))
    return some.select("doc_id", F.when(a.isNotNull(), F.array_join(cycled, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.runs_of(looped(table(spark, sf_dir, "documents")))
    best = F.col("strongest")
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period)), "\n", "")
    return found.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), best["start"].alias("start"), best["length"].alias("length"), best["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"), F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.filter(~toxicity.held_out()))
    found = language_id.identify(docs, model)
    return found.select("doc_id", F.coalesce(toxicity.held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score", "languages")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (op1_byte_bpe, op2_decontamination, op3_jaccard_join, op4_toxicity, op5_kneser_ney, op6_sharding, op7_url_filter, op8_token_counts, op9_exact_topk, op10_pii, op11_periodic_runs, op12_collocations, op13_language_id)
    return {f.__name__: f for f in found}


OP2_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[i : i + least(len(words), 10) - 1], ' ') AS phrase
  FROM (SELECT item_id, words, unnest(generate_series(1, greatest(len(words) - 9, 1))) AS i FROM items WHERE len(words) > 0)),
sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, n, i, array_to_string(words[i : i + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, words, n, unnest(generate_series(1, len(words) - n + 1)) AS i FROM w, sizes WHERE len(words) >= n)),
found AS (SELECT g.doc_id, g.i, g.n, v.item_id FROM grams g JOIN windows v ON g.n = v.n AND g.phrase = v.phrase),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT w.doc_id, len(w.words) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(m.n_items, 0) AS n_items,
       sha256(coalesce(m.ids, '')) AS items_sha256, h.n_hit IS NOT NULL AS contaminated
FROM w LEFT JOIN hits h ON w.doc_id = h.doc_id LEFT JOIN named m ON w.doc_id = m.doc_id
"""

OP7_SQL = """
WITH rules(host, path, verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
rest AS (
  SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1, 's') AS path FROM rest),
fits AS (
  SELECT p.host, p.path, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM (SELECT DISTINCT host, path FROM parts) p
  JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
  GROUP BY ALL)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON p.host = f.host AND p.path = f.path
"""


OP9_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(generate_series(1, len(q.e)), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

OP12_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
n AS (SELECT lang, CAST(sum(len(words)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (
  SELECT lang, k, phrase, count(*) AS f, string_split(phrase, ' ') AS ws
  FROM (SELECT lang, k, array_to_string(words[i : i + k - 1], ' ') AS phrase
        FROM (SELECT lang, words, k, unnest(generate_series(1, len(words) - k + 1)) AS i FROM w, (VALUES (1), (2), (3), (4)) t(k) WHERE len(words) >= k))
  GROUP BY lang, k, phrase HAVING count(*) >= 30),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, j, x.f AS l, y.f AS r, CAST((CAST(2000000 AS HUGEINT) * c.f) // (x.f + y.f) AS BIGINT) AS score
  FROM (SELECT lang, phrase, f, k, ws, unnest(generate_series(1, k - 1)) AS j FROM g WHERE k > 1) c
  JOIN g x ON x.lang = c.lang AND x.phrase = array_to_string(c.ws[1 : j], ' ') JOIN g y ON y.lang = c.lang AND y.phrase = array_to_string(c.ws[j + 1 : c.k], ' ')),
weakest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) AS o FROM cuts) WHERE o = 1),
longer AS (
  SELECT lang, array_to_string(ws[i : i + m - 1], ' ') AS phrase, max(f) AS f
  FROM (SELECT lang, f, ws, k, m, unnest(generate_series(1, k - m + 1)) AS i FROM g, (VALUES (2), (3)) t(m) WHERE k > m) GROUP BY 1, 2),
kept AS (SELECT s.* FROM weakest s LEFT JOIN longer b ON s.lang = b.lang AND s.phrase = b.phrase WHERE b.f IS NULL OR 100 * b.f < 80 * s.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_decontamination": OP2_SQL, "op7_url_filter": OP7_SQL, "op9_exact_topk": OP9_SQL, "op12_collocations": OP12_SQL}
