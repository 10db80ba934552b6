"""Scans, lookups and entity lists (S rows), counts over papers (R rows)."""

from pyspark.sql import functions as F

from ..sources import articles
from ..sources.tables import canonical, edges, papers, raw
from .registry import CANONICAL, EDGES, PAPERS, query, r6


@query("s1_table_scan", "SELECT * FROM papers", (PAPERS,))
def s1(spark, d):
    return papers(spark, d)


@query("s2_point_lookup", "SELECT * FROM papers WHERE pmid = 33", (PAPERS,))
def s2(spark, d):
    return papers(spark, d).filter(F.col("pmid") == 33).limit(1)


@query("x12_page_extraction", "SELECT page_id, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title, length(html) AS n_chars FROM pages")
def x12_page(spark, d):
    return raw(spark, d, "pages").select("page_id", F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1).alias("title"), F.length("html").alias("n_chars"))


@query("s12_distinct_entities", "SELECT DISTINCT mechanism AS name FROM edges WHERE mechanism IS NOT NULL AND mechanism <> ''", (EDGES,))
def s12(spark, d):
    return edges(spark, d).select(F.col("mechanism").alias("name")).filter("name IS NOT NULL AND name <> ''").distinct().orderBy("name")


@query("s11_vector_lookup", "SELECT DISTINCT e.vec_id, sha256(CAST(e.label AS VARCHAR)) AS text_hash, len(e.embedding) AS dimension FROM embeddings e")
def s11(spark, d):
    vectors = raw(spark, d, "embeddings")
    cache = vectors.select(F.sha2(F.col("label").cast("string"), 256).alias("text_hash"), "vec_id", F.size("embedding").alias("dimension"))
    asked = vectors.select(F.sha2(F.col("label").cast("string"), 256).alias("text_hash")).distinct()
    return asked.join(cache, "text_hash", "left").select("vec_id", "text_hash", "dimension").distinct()


@query("s9_search_query", "SELECT DISTINCT canonical_name, '(\"' || canonical_name || '\"[Title/Abstract]) AND (\"2010\"[PDAT] : \"2024\"[PDAT])' AS q FROM canonical WHERE entity_type = 'condition'", (CANONICAL,))
def s9(spark, d):
    names = canonical(spark, d).filter("entity_type = 'condition'").select("canonical_name").distinct()
    return names.withColumn("q", articles.boolean_query(F.col("canonical_name"), 2010, 2024))


@query("c2_records_of_paper", "SELECT study_id, source, target FROM edges WHERE paper_id = 7", (EDGES,))
def c2(spark, d):
    return edges(spark, d).filter("paper_id = 7").select("study_id", "source", "target")


@query("r1_fulltext_statistics", """SELECT count(*) AS total, count(CASE WHEN has_fulltext THEN 1 END) AS with_fulltext, count(CASE WHEN fulltext_source = 'pmc' THEN 1 END) AS from_pmc,
  count(doi) AS with_doi, round(100.0 * count(CASE WHEN has_fulltext THEN 1 END) / count(*), 6) AS coverage FROM papers""", (PAPERS,))
def r1(spark, d):
    full = F.count_if(F.col("has_fulltext"))
    return papers(spark, d).agg(F.count("*").alias("total"), full.alias("with_fulltext"), F.count_if(F.col("fulltext_source") == "pmc").alias("from_pmc"), F.count("doi").alias("with_doi"), r6(100.0 * full / F.count("*")).alias("coverage"))


@query("r3_processing_statistics", "SELECT processing_status, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM papers GROUP BY processing_status", (PAPERS,))
def r3(spark, d):
    p = papers(spark, d)
    total = p.agg(F.count("*").alias("total"))
    return p.groupBy("processing_status").agg(F.count("*").alias("n")).crossJoin(F.broadcast(total)).select("processing_status", "n", r6(F.when(F.col("total") > 0, 100.0 * F.col("n") / F.col("total")).otherwise(0.0)).alias("pct"))


@query("r25_normalisation_rate", """SELECT entity_type, count(*) AS names, count(DISTINCT canonical_name) AS groups,
  round((1 - count(DISTINCT canonical_name) / CAST(count(DISTINCT entity_name) AS DOUBLE)) * 100, 6) AS reduction FROM canonical GROUP BY entity_type""", (CANONICAL,))
def r25(spark, d):
    groups, names = F.countDistinct("canonical_name"), F.countDistinct("entity_name")
    return canonical(spark, d).groupBy("entity_type").agg(F.count("*").alias("names"), groups.alias("groups"), r6((1 - groups / names) * 100).alias("reduction"))


@query("c37_latest_session", "SELECT ts, event_type, user_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def c37(spark, d):
    return raw(spark, d, "events").orderBy(F.desc("ts"), F.desc("event_id")).limit(1).select("ts", "event_type", "user_id")


@query("stream_windows", "SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n, round(avg(value), 6) AS mean FROM events GROUP BY ALL")
def stream_windows(spark, d):
    """The streaming aggregate in its batch form; tests run it as a stream."""
    from ..streaming import outcome_windows

    return outcome_windows(raw(spark, d, "events")).withColumn("mean", r6("mean"))
