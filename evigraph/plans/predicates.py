"""Projections, filters, relabelling (F rows)."""

from pyspark.sql import functions as F

from ..functions import labels
from ..functions import text as tx
from ..functions.text import PLACEHOLDERS, is_placeholder
from ..operators import evidence as ev
from ..sources.tables import edges, papers, raw
from .registry import EDGES, PAPERS, query, r6


@query("f1_status_filter", "SELECT pmid, journal FROM papers WHERE processing_status = 'failed' ORDER BY pmid LIMIT 50", (PAPERS,))
def f1(spark, d):
    return papers(spark, d).filter("processing_status = 'failed'").select("pmid", "journal").orderBy("pmid").limit(50)


@query("f2_work_queue", """SELECT pmid, influence_score, citation_count, publication_date FROM papers
  WHERE processing_status = 'pending' AND abstract IS NOT NULL AND abstract <> ''
  ORDER BY coalesce(influence_score, 0) DESC, coalesce(citation_count, 0) DESC, publication_date DESC, pmid LIMIT 100""", (PAPERS,))
def f2(spark, d):
    open_ = papers(spark, d).filter("processing_status = 'pending' AND abstract IS NOT NULL AND abstract <> ''")
    order = [F.coalesce("influence_score", F.lit(0)).desc(), F.coalesce("citation_count", F.lit(0)).desc(), F.desc("publication_date"), F.asc("pmid")]
    return open_.orderBy(*order).limit(100).select("pmid", "influence_score", "citation_count", "publication_date")


@query("f3_substring_search", "SELECT doc_id, lang FROM documents WHERE contains(lower(text), 'license') OR contains(lower(source), 'license')")
def f3(spark, d):
    return raw(spark, d, "documents").filter("contains(lower(text), 'license') OR contains(lower(source), 'license')").select("doc_id", "lang")


_IN = ", ".join(f"'{p}'" for p in PLACEHOLDERS)


@query("f4_placeholder_rows", f"""SELECT page_id, split_part(url, '/', 4) AS name FROM pages WHERE split_part(url, '/', 4) IN ({_IN}) OR length(trim(split_part(url, '/', 4))) < 3
  OR starts_with(lower(split_part(url, '/', 4)), 'unknown') OR starts_with(lower(split_part(url, '/', 4)), 'various')""")
def f4(spark, d):
    name = F.coalesce(F.try_element_at(F.split("url", "/"), F.lit(4)), F.lit(""))
    return raw(spark, d, "pages").select("page_id", name.alias("name")).filter(F.col("name").isin(*PLACEHOLDERS) | (F.length(F.trim("name")) < 3) | F.lower("name").startswith("unknown") | F.lower("name").startswith("various"))


_NAMES = ("unknown", "multiple drug therapy", "multiple", "...", "Therapy", "....", "various x...", "cognitive therapy", " TBD ", "None", "Severalfold")


@query("f5_placeholder_names", f"""WITH n AS (SELECT p_partkey, CASE WHEN p_partkey % 12 < 11 THEN {list(_NAMES)!r}[1 + CAST(p_partkey % 12 AS INT)] ELSE p_name END AS name FROM part), t AS (SELECT *, trim(lower(name)) AS x FROM n)
  SELECT p_partkey, x IN {tuple(sorted({*tx.PLACEHOLDERS, *tx.GENERIC_TERMS}))!r} OR (NOT regexp_matches(x, '\\s') AND regexp_matches(x, '^(unknown|placeholder|various|multiple|several)')) OR contains(name, '...') OR replace(x, '.', '') = '' AS placeholder FROM t""")
def f5(spark, d):
    """Names of parts, eleven of twelve replaced by ones that are, or look like, placeholders."""
    k = (F.col("p_partkey") % 12).cast("int")
    name = F.when(k < 11, F.element_at(F.array(*[F.lit(x) for x in _NAMES]), F.least(k, F.lit(10)) + 1)).otherwise(F.col("p_name"))
    return raw(spark, d, "part").select("p_partkey", is_placeholder(name).alias("placeholder"))


@query("f6_tri_state", "SELECT pmid, coalesce(doi, '') = '' AS unset FROM papers", (PAPERS,))
def f6(spark, d):
    return papers(spark, d).select("pmid", (F.coalesce("doi", F.lit("")) == "").alias("unset"))


@query("f7_new_ids", "SELECT o_orderkey AS pmid FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'A')")
def f7(spark, d):
    known = raw(spark, d, "lineitem").filter("l_returnflag = 'A'").select(F.col("l_orderkey").alias("pmid"))
    return raw(spark, d, "orders").select(F.col("o_orderkey").alias("pmid")).join(known, "pmid", "left_anti")


@query("f8_edge_filter", "SELECT study_id, source, target FROM edges WHERE confidence >= 0.9 AND outcome IN ('improves', 'worsens')", (EDGES,))
def f8(spark, d):
    return edges(spark, d).filter((F.col("confidence") >= 0.9) & F.col("outcome").isin("improves", "worsens")).select("study_id", "source", "target")


@query("f9_result_filters", "SELECT study_id, mechanism, confidence FROM edges WHERE contains(lower(mechanism), 'economy') AND confidence >= 0.7 AND target = 'Brand#11'", (EDGES,))
def f9(spark, d):
    return edges(spark, d).filter(F.lower("mechanism").contains("economy") & (F.col("confidence") >= 0.7) & (F.col("target") == "Brand#11")).select("study_id", "mechanism", "confidence")


@query("f10_facets", """SELECT study_id, study_design, outcome FROM edges WHERE list_contains([study_design, mechanism], '1-URGENT') AND outcome = 'improves'
  AND coalesce(confidence, 0) >= 0.8 AND target IN ('Brand#12', 'Brand#13')""", (EDGES,))
def f10(spark, d):
    return facets(edges(spark, d, design=True), "1-URGENT", "improves", 0.8, ["Brand#12", "Brand#13"])


def facets(rows, category, outcome, confidence, targets):
    return rows.filter(F.array_contains(F.array("study_design", "mechanism"), category) & (F.col("outcome") == outcome) & (F.coalesce("confidence", F.lit(0)) >= confidence) & F.col("target").isin(*targets)).select("study_id", "study_design", "outcome")


@query("f11_network_filter", """, kept AS (SELECT * FROM edges WHERE outcome = 'worsens' AND confidence >= 0.95),
  nodes AS (SELECT source AS node FROM kept UNION SELECT target FROM kept)
  SELECT k.study_id, k.source, k.target FROM kept k WHERE k.source IN (SELECT node FROM nodes) AND k.target IN (SELECT node FROM nodes WHERE node <> 'Brand#11')""", (EDGES,))
def f11(spark, d):
    kept = edges(spark, d).filter("outcome = 'worsens' AND confidence >= 0.95")
    nodes = kept.select(F.col("source").alias("node")).union(kept.select("target")).distinct()
    shown = nodes.filter("node <> 'Brand#11'")
    return kept.join(nodes.withColumnRenamed("node", "source"), "source", "left_semi").join(shown.withColumnRenamed("node", "target"), "target", "left_semi").select("study_id", "source", "target")


@query("f12_relabel", "SELECT study_id, CASE WHEN outcome = 'inconclusive' THEN 'unsure' ELSE outcome END AS shown FROM edges", (EDGES,))
def f12(spark, d):
    return edges(spark, d).select("study_id", labels.display_outcome(F.col("outcome")).alias("shown"))


@query("q8_outcome_migration", """SELECT l_returnflag, CASE l_returnflag WHEN 'A' THEN 'improves' WHEN 'R' THEN 'worsens' ELSE 'no_effect' END AS outcome, count(*) AS n FROM lineitem GROUP BY ALL""")
def q8(spark, d):
    old = labels.lookup(F.col("l_returnflag"), {"A": "positive", "R": "Negative ", "N": ""})
    return raw(spark, d, "lineitem").select("l_returnflag", labels.canonical_outcome(old).alias("outcome")).groupBy("l_returnflag", "outcome").agg(F.count("*").alias("n"))


@query("f13_tiers", """, p AS (SELECT source, target, count(*) AS n, avg(confidence) AS c FROM edges GROUP BY ALL)
  SELECT source, target, CASE WHEN n >= 10 AND c >= 0.75 THEN 'strong' WHEN n >= 5 AND c >= 0.6 THEN 'moderate' WHEN n >= 2 AND c >= 0.4 THEN 'weak' ELSE 'insufficient' END AS level,
  CASE WHEN n > 50 THEN 'established' WHEN n * 100 > 1825 THEN 'mature' ELSE 'emerging' END AS stage,
  CASE WHEN round(c, 6) >= 0.8 THEN 'high (>=0.8)' WHEN round(c, 6) >= 0.6 THEN 'medium (0.6-0.8)' WHEN c > 0 THEN 'low (0.1-0.6)' ELSE 'none (0)' END AS bucket FROM p""", (EDGES,))
def f13(spark, d):
    e = edges(spark, d, place=True)
    p = e.groupBy("source", "target").agg(F.count("*").alias("n"), F.avg("confidence").alias("c"))
    p = ev.in_table_order(e, p, ["source", "target"], {"c": (F.col("confidence"), F.count("confidence"))}, ev.near(F.col("c"), 0.75, 0.6, 0.4))
    return p.select("source", "target", labels.evidence_level(F.col("n"), F.col("c"), labels.as_is).alias("level"), labels.innovation_stage(F.greatest(F.col("n") * 100, F.lit(730)), F.lit(0.0), F.col("n")).alias("stage"), labels.confidence_bucket(r6("c")).alias("bucket"))


@query("f14_year_of_partial_date", "SELECT pmid, TRY_CAST(substr(CASE WHEN pmid % 5 = 0 THEN 'Spring' ELSE publication_date END, 1, 4) AS INT) AS year FROM papers", (PAPERS,))
def f14(spark, d):
    date = F.when(F.col("pmid") % 5 == 0, "Spring").otherwise(F.col("publication_date"))
    return papers(spark, d).select("pmid", F.substring(date, 1, 4).try_cast("int").alias("year"))
