"""The remaining units of the survey: file readers and sinks by round trip, profiles, reports, checks."""

import uuid

from pyspark.sql import functions as F

from ..functions import labels
from ..functions import text as tx
from ..functions.labels import ladder
from ..operators import bayes, clusters as cl, evidence as ev, hierarchies as hi, mining as mn, resolution as rs, validation as va
from ..operators.components import cut_lineage
from ..operators.conditions import feasibility
from ..session import shared_folder
from ..sources import articles, content_cache, documents, sessions, sinks
from ..sources.tables import canonical, clusters, edges, edges_sparse, papers, raw
from .aggregates import classification_report
from .mining import _GAPS, brand_clusters
from .registry import CANONICAL, CLUSTERS, EDGES, PAPERS, SPARSE, query, r6
from .vectors import _CENTROIDS, _COS, hierarchy


def _scratch(spark, label):
    """A new folder among those that all executors share."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _escape(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


# -- readers ---------------------------------------------------------------------
ARTICLE = ("pmid", "title", "abstract", "journal", "publication_date", "doi")


def article_xml(p):
    """Papers spelled as article XML, one row each."""
    day = F.to_date("publication_date")
    tag = lambda name, value: F.coalesce(F.concat(F.lit(f"<{name}>"), _escape(value), F.lit(f"</{name.split(' ')[0]}>")), F.lit(""))
    x = F.concat(
        F.lit("<PubmedArticle><MedlineCitation>"), tag("PMID", F.col("pmid").cast("string")), F.lit("<Article><Journal><JournalIssue><PubDate>"), tag("Year", F.date_format(day, "yyyy")), tag("Month", F.date_format(day, "MMM")),
        F.lit("</PubDate></JournalIssue>"), tag("Title", F.col("journal")), F.lit("</Journal>"), tag("ArticleTitle", F.col("title")), F.lit("<Abstract>"), tag('AbstractText Label="AIM"', F.col("abstract")),
        F.lit("</Abstract></Article></MedlineCitation><PubmedData><ArticleIdList>"), tag('ArticleId IdType="doi"', F.col("doi")), F.lit("</ArticleIdList></PubmedData></PubmedArticle>"),
    )
    return p.select(x.alias("x"))


_FIELDS = "SELECT CAST(pmid AS VARCHAR) AS pmid, title, coalesce('AIM: ' || abstract, NULL) AS abstract, journal, substr(publication_date, 1, 7) AS publication_date, doi FROM papers"


@query("s3_article_set", _FIELDS, (PAPERS,))
def s3(spark, d):
    """One folder of article files, several articles each, read back."""
    path = _scratch(spark, "articles")
    article_xml(papers(spark, d)).repartition(8).write.text(path)
    return articles.read_articles(spark, path).select(*ARTICLE)


@query("s4_glob_reader", "SELECT CAST(pmid AS VARCHAR) AS pmid, journal FROM papers", (PAPERS,))
def s4(spark, d):
    """Article files of several folders by one pattern."""
    path = _scratch(spark, "glob")
    p = papers(spark, d)
    for k in range(3):
        article_xml(p.filter(F.col("pmid") % 3 == k)).repartition(3).write.text(f"{path}/set-{k}")
    return articles.read_articles(spark, f"{path}/set-*/part-*").select("pmid", "journal")


@query("s5_body_text", r"""SELECT page_id, CASE WHEN body <> '' THEN body ELSE trim(regexp_replace(html, '(?s)<[^>]+>', ' ', 'g')) END AS body
  FROM (SELECT *, array_to_string(list_transform(regexp_extract_all(regexp_extract(html, '(?s)<body[^>]*>(.*?)</body>', 1), '(?s)<p[^>]*>(.*?)</p>', 1), lambda p: trim(regexp_replace(p, '<[^>]+>', '', 'g'))), chr(10)) AS body FROM pages)""")
def s5(spark, d):
    return raw(spark, d, "pages").select("page_id", articles.body_text(F.col("html")).alias("body"))


@query("s7_suggestions_csv", "SELECT DISTINCT mechanism AS term, 'kind ' || mechanism AS canonical, 0.75::DOUBLE AS confidence FROM edges", (EDGES,))
def s7(spark, d):
    path = _scratch(spark, "csv")
    edges(spark, d).select(F.col("mechanism").alias("term"), F.concat(F.lit("kind "), "mechanism").alias("canonical"), F.lit(0.75).alias("confidence"), F.lit("a, b").alias("reason")).distinct().write.csv(path, header=True)
    return articles.read_suggestions(spark, path).select("term", "canonical", "confidence")


@query("s8_review_files", "SELECT o_orderkey AS id, 'm' || o_custkey % 3 AS model FROM orders")
def s8(spark, d):
    path = _scratch(spark, "reviews")
    raw(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.concat(F.lit("m"), F.col("o_custkey") % 3).alias("model")).write.json(path)
    return spark.read.schema("id long, model string, verdict string").json(path).select("id", "model")


@query("x12_article_fields", _FIELDS, (PAPERS,))
def x12(spark, d):
    """Papers spelled as article XML and parsed again, dealt evenly, as a file of papers may be a task or two."""
    p = papers(spark, d).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "pmid")
    return articles.parse_articles(article_xml(p)).select(*ARTICLE)


# -- sinks -------------------------------------------------------------------------
@query("k5_refresh_snapshot", "SELECT pmid, journal FROM papers WHERE pmid % 2 = 0", (PAPERS,))
def k5(spark, d):
    s = sinks.Snapshots(spark, _scratch(spark, "table"))
    p = papers(spark, d).select("pmid", "journal")
    sinks.refresh(s, p)
    sinks.refresh(s, p.filter("pmid % 2 = 0"))
    return s.read()


@query("k7_json_document", "SELECT source, count(*) AS n FROM edges GROUP BY source UNION ALL SELECT source, 0 FROM edges GROUP BY source", (EDGES,))
def k7(spark, d):
    """A document written twice: the second one, and the first from its backup."""
    path = _scratch(spark, "document") + ".json"
    counts = edges(spark, d).groupBy("source").agg(F.count("*").alias("n"))
    sinks.write_json_document(counts.withColumn("n", F.lit(0)), path, ["source"])
    sinks.write_json_document(counts, path, ["source"])
    read = spark.read.schema("source string, n bigint")
    return read.json(path, multiLine=True).union(read.json(f"{path}.bak", multiLine=True))


@query("k12_csv_round_trip", "SELECT source, target, count(*) AS n FROM sparse GROUP BY ALL", (SPARSE,))
def k12(spark, d, sparse=edges_sparse):
    path = _scratch(spark, "csv")
    sinks.write_csv(sparse(spark, d).groupBy("source", "target").agg(F.count("*").alias("n")), path)
    return spark.read.csv(path, header=True, schema="source string, target string, n bigint")


_BATCHES = "SELECT CAST(substr(o_orderpriority, 1, 1) AS INT) AS batch, count(*) AS rows FROM orders GROUP BY 1"


def _by_priority(spark, d):
    return raw(spark, d, "orders").select("o_orderkey", "o_totalprice", F.substring("o_orderpriority", 1, 1).cast("int").alias("batch"))


@query("k13_run_log", _BATCHES)
def k13(spark, d):
    """A session's log after its run, read back: rows of each batch that counts."""
    session = sessions.Session(spark, _scratch(spark, "session"))
    session.run(_by_priority(spark, d), "batch", lambda df: df.withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("bigint")))
    return session.log().filter("record = 'done'").select("batch", "rows")


@query("k7_document_parts", "SELECT pmid, title, journal FROM papers", (PAPERS,))
def k7_parts(spark, d):
    """All papers as a document in ordered parts, read back by its manifest."""
    at = _scratch(spark, "document")
    documents.write_parts(papers(spark, d).select("pmid", "title", "journal"), at, ["pmid"], 5000)
    return documents.read_parts(spark, at, "pmid bigint, title string, journal string")


@query("k14_rollback", "SELECT pmid FROM papers WHERE pmid < 500", (PAPERS,))
def k14(spark, d):
    s = sinks.Snapshots(spark, _scratch(spark, "table"))
    p = papers(spark, d).select("pmid")
    s.publish(p.filter("pmid < 500"))
    s.publish(p)
    s.rollback()
    return s.read()


# -- graph and scores under their own names -----------------------------------------
@query("g6_fundamental_interventions", ", p AS (SELECT source, target, round(sum(weight * confidence) / count(*) * avg(confidence), 3) AS s FROM sparse GROUP BY ALL) SELECT source, count(CASE WHEN s > 0 THEN 1 END) AS positive_conditions FROM p GROUP BY source HAVING count(CASE WHEN s > 0 THEN 1 END) >= 5", (SPARSE,))
def g6(spark, d, sparse=edges_sparse):
    return ev.fundamental(sparse(spark, d), 5).select("source", "positive_conditions")


@query("x22_outcome_weights", "SELECT outcome, weight, count(*) AS n FROM edges GROUP BY ALL", (EDGES,))
def x22(spark, d):
    return edges(spark, d).groupBy("outcome", labels.outcome_weight(F.col("outcome")).alias("weight")).agg(F.count("*").alias("n"))


@query("x23_advice_labels", """, g AS (SELECT source, mechanism, month, round(avg(weight), 6) AS score, round(avg(confidence), 6) AS confidence, count(*) AS n FROM edges GROUP BY ALL)
  SELECT source, mechanism, month, score, CASE WHEN score > 0.5 AND confidence > 0.7 AND n >= 3 THEN 'Strongly recommended - robust positive evidence' WHEN score > 0.3 AND confidence > 0.5 THEN 'Recommended - moderate positive evidence' WHEN score < -0.3 THEN 'Not recommended - evidence suggests ineffective'
  WHEN n < 2 THEN 'Insufficient evidence - more research needed' ELSE 'Neutral - mixed or weak evidence' END AS advice FROM g""", (EDGES,))
def x23(spark, d):
    g = edges(spark, d).groupBy("source", "mechanism", "month").agg(r6(F.avg("weight")).alias("score"), r6(F.avg("confidence")).alias("confidence"), F.count("*").alias("n"))
    return g.select("source", "mechanism", "month", "score", labels.advice(F.col("score"), F.col("confidence"), F.col("n")).alias("advice"))


@query("m3_posterior_confidence", """, k AS (SELECT source, CAST(count(CASE WHEN outcome = 'improves' THEN 1 END) AS DOUBLE) AS p, CAST(count(CASE WHEN outcome = 'worsens' THEN 1 END) AS DOUBLE) AS q FROM edges GROUP BY source)
  SELECT source, round(sqrt(least(1, ln(1 + p + q) / ln(101)) * (1 - least(1, 10 * (p + 1) * (q + 1) / (power(p + q + 2, 2) * (p + q + 3))))), 6) AS confidence FROM k""", (EDGES,))
def m3(spark, d):
    from ..functions import scoring as sc

    c = ev.outcome_counts(edges(spark, d), ["source"])
    return c.select("source", r6(sc.posterior_confidence(F.col("pos"), F.col("neg"))).alias("confidence"))


@query("m4_variance_and_bayes_factor", """, k AS (SELECT target, CAST(count(CASE WHEN outcome = 'improves' THEN 1 END) AS DOUBLE) AS p, CAST(count(CASE WHEN outcome = 'worsens' THEN 1 END) AS DOUBLE) AS q FROM edges GROUP BY target)
  SELECT target, round(1000 * (p + 1) * (q + 1) / (power(p + q + 2, 2) * (p + q + 3)), 6) AS variance_thousandths, round(least(100, (p + 1) / (q + 1)), 6) AS bayes_factor FROM k""", (EDGES,))
def m4(spark, d):
    from ..functions import scoring as sc

    c = ev.outcome_counts(edges(spark, d), ["target"])
    return c.select("target", r6(1000 * sc.posterior_variance(F.col("pos"), F.col("neg"))).alias("variance_thousandths"), r6(sc.bayes_factor(F.col("pos"), F.col("neg"))).alias("bayes_factor"))


@query("m24_innovation_boost", """, s AS (SELECT source, round(avg(confidence), 6) AS score FROM edges GROUP BY source), i AS (SELECT source, round(avg(power(0.5, greatest(0, least(100, 2001 - year)) / 3.0)), 6) AS recency FROM edges WHERE year >= 1997 GROUP BY source)
  SELECT s.source, round(least(1, score + 0.2 * coalesce(recency, 0)), 6) AS boosted FROM s LEFT JOIN i USING (source)""", (EDGES,))
def m24(spark, d):
    e = edges(spark, d, design=True)
    index = mn.innovation(e.filter("year >= 1997"), 2001).select("source", r6("recency").alias("recency"))
    score = e.groupBy("source").agg(r6(F.avg("confidence")).alias("score"))
    return score.join(index, "source", "left").select("source", r6(F.least(F.lit(1.0), F.col("score") + 0.2 * F.coalesce("recency", F.lit(0.0)))).alias("boosted"))


@query("m22_lifecycle_stage", """, g AS (SELECT source, month, mechanism, round(2 * avg(confidence) - 1, 6) AS i FROM edges GROUP BY ALL)
  SELECT *, CASE WHEN i >= 0.8 THEN 'discovery' WHEN i >= 0.7 THEN 'breakthrough' WHEN i >= 0.6 THEN 'rising_star' WHEN i >= 0.4 THEN 'established' WHEN i >= 0.2 THEN 'mature' WHEN i >= 0 THEN 'legacy' ELSE 'unknown' END AS stage FROM g""", (EDGES,))
def lifecycle(spark, d):
    """An index from the mean confidence by source, month and mechanism, so that all stages come up."""
    g = edges(spark, d).groupBy("source", "month", "mechanism").agg(r6(2 * F.avg("confidence") - 1).alias("i"))
    return g.withColumn("stage", stage(F.col("i")))


#: Life-cycle stages and the range of the index that each spans; the first that contains it holds.
LIFECYCLE = (("discovery", 0.8, 1.0), ("breakthrough", 0.7, 0.95), ("rising_star", 0.6, 0.85), ("established", 0.4, 0.7), ("mature", 0.2, 0.5), ("legacy", 0.0, 0.3))


def stage(index):
    return ladder(*[(index.between(low, high), name) for name, low, high in LIFECYCLE], otherwise="unknown")


# -- vectors ---------------------------------------------------------------------------
@query("v1_hashing_embedding")
def v1(spark, d):
    """A deterministic stand-in for a model's vectors: signed feature hashing of words, unit norm."""
    from ..functions.vectors import l2_normalise

    words = raw(spark, d, "documents").select("doc_id", F.explode(F.split(tx.squeeze(F.lower("text")), " ")).alias("w"))
    sign = F.when(F.pmod(F.xxhash64("w", F.lit(1)), F.lit(2)) == 0, 1.0).otherwise(-1.0)
    cells = words.groupBy("doc_id", F.pmod(F.xxhash64("w"), F.lit(32)).alias("i")).agg(F.sum(sign).alias("x"))
    dense = cells.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("i", "x"))).alias("m"))
    v = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.coalesce(F.try_element_at("m", i.cast("bigint")), F.lit(0.0)))
    return dense.select("doc_id", l2_normalise(v).alias("vector"))


_POINTS = """CASE WHEN reduction_ratio BETWEEN 0.4 AND 0.6 THEN 25 WHEN reduction_ratio BETWEEN 0.3 AND 0.7 THEN 20 WHEN reduction_ratio BETWEEN 0.2 AND 0.8 THEN 15 ELSE 10 END::DOUBLE AS reduction_score, 15.0::DOUBLE AS depth_score,
  (20 - CASE WHEN singleton_ratio > 0.5 THEN 5 ELSE 0 END - CASE WHEN singleton_ratio > 0.6 THEN 3 ELSE 0 END - CASE WHEN median_size < 2 OR median_size > 10 THEN 5 ELSE 0 END - CASE WHEN max_size > 100 THEN 5 WHEN max_size > 50 THEN 2 ELSE 0 END)::DOUBLE AS size_score,
  CASE WHEN coherence >= 0.7 THEN 25 WHEN coherence >= 0.65 THEN 22 WHEN coherence >= 0.6 THEN 20 WHEN coherence >= 0.5 THEN 15 ELSE 10 END::DOUBLE AS coherence_score, CASE WHEN separation >= 0.4 THEN 15 WHEN separation >= 0.35 THEN 13 WHEN separation >= 0.3 THEN 12 ELSE 8 END::DOUBLE AS separation_score"""


@query("v14_hierarchy_scores", f""", z AS (SELECT cluster_id, count(*) AS n FROM clusters GROUP BY cluster_id), p AS (SELECT {_COS.format(a='a.centroid', b='b.centroid')} AS s FROM centroids a JOIN centroids b ON a.cluster_id < b.cluster_id),
  i AS (SELECT a.cluster_id, avg({_COS.format(a='a.vector', b='b.vector')}) AS c FROM clusters a JOIN clusters b ON a.cluster_id = b.cluster_id AND a.member < b.member GROUP BY a.cluster_id),
  m AS (SELECT (SELECT count(*) FROM clusters) AS initial_count, count(*) AS final_count, avg(CASE WHEN n = 1 THEN 1.0 ELSE 0 END)::DOUBLE AS singleton_ratio, median(n)::DOUBLE AS median_size, max(n) AS max_size, (SELECT avg(c) FROM i) AS coherence, 1 - (SELECT avg(s) FROM p) AS separation FROM z),
  r AS (SELECT *, 1 - final_count / initial_count::DOUBLE AS reduction_ratio FROM m), t AS (SELECT *, {_POINTS} FROM r)
  SELECT initial_count, final_count, round(reduction_ratio, 6) AS reduction_ratio, singleton_ratio, median_size, max_size, round(coherence, 6) AS coherence, round(separation, 6) AS separation, reduction_score, depth_score, size_score, coherence_score, separation_score, reduction_score + depth_score + size_score + coherence_score + separation_score AS composite_score FROM t""", (CLUSTERS, _CENTROIDS))
def v14(spark, d):
    """Labelled clusters as the top level over one cluster a vector."""
    m = clusters(spark, d)
    out = hi.hierarchy_quality(m, cl.merge_candidates(cl.centroids(m), 0.0, None), m.select("member"), 3)
    return out.drop("depth").withColumns({c: r6(c) for c in ("reduction_ratio", "coherence", "separation")})


@query("v16_hierarchy_search")
def v16_search(spark, d):
    """All 64 combinations of thresholds, lower than for names, as the test tables' vectors lie far apart."""
    steps = tuple(tuple(round(low + 0.02 * k, 2) for k in range(4)) for low in (0.08, 0.06, 0.04))
    out = hi.threshold_search(clusters(spark, d), steps)
    return out.withColumns({c: r6(c) for c in ("reduction_ratio", "singleton_ratio", "coherence", "separation")})


# -- resolution and curation ---------------------------------------------------------------
@query("e4_batch_resolution", "SELECT e.study_id, i.canonical_name AS intervention, c.canonical_name AS condition FROM sparse e LEFT JOIN canonical i ON e.source = i.entity_name AND i.entity_type = 'intervention' LEFT JOIN canonical c ON e.target = c.entity_name AND c.entity_type = 'condition'", (SPARSE, CANONICAL))
def e4(spark, d, sparse=edges_sparse):
    names = canonical(spark, d)
    of = lambda kind, end, out: names.filter(F.col("entity_type") == kind).select(F.col("entity_name").alias(end), F.col("canonical_name").alias(out))
    return sparse(spark, d).select("study_id", "source", "target").join(of("intervention", "source", "intervention"), "source", "left").join(of("condition", "target", "condition"), "target", "left").select("study_id", "intervention", "condition")


@query("e9_rule_based_duplicates", "SELECT a.source AS a, b.source AS b, a.paper_id FROM (SELECT DISTINCT source, paper_id FROM edges) a JOIN (SELECT DISTINCT source, paper_id FROM edges) b ON a.paper_id = b.paper_id AND right(a.source, 1) = right(b.source, 1) AND a.source < b.source", (EDGES,))
def e9(spark, d):
    """Mentions in one paper whose names end alike: a rule in place of a model's judgement."""
    m = edges(spark, d).select("paper_id", "source", F.right("source", F.lit(1)).alias("k")).distinct()
    return m.withColumnRenamed("source", "a").join(m.withColumnRenamed("source", "b"), ["paper_id", "k"]).filter("a < b").select("a", "b", "paper_id")


@query("q3_search_request", "SELECT pmid, trim(coalesce(abstract, '')) <> '' AND length(abstract) <= 500 AND 20 * citation_count BETWEEN 1 AND 1000 AS valid FROM papers", (PAPERS,))
def q3(spark, d):
    return papers(spark, d).select("pmid", va.valid_request(F.coalesce("abstract", F.lit("")), 20 * F.col("citation_count")).alias("valid"))


@query("q4_category_rules", "SELECT mechanism, count(*) AS n, CASE WHEN mechanism IN ('SMALL', 'MEDIUM') THEN 'thrift' WHEN length(mechanism) < 6 THEN 'short' ELSE 'ok' END AS verdict FROM edges GROUP BY mechanism", (EDGES,))
def q4(spark, d):
    m = F.col("mechanism")
    return edges(spark, d).groupBy("mechanism").agg(F.count("*").alias("n")).withColumn("verdict", ladder((m.isin("SMALL", "MEDIUM"), "thrift"), (F.length(m) < 6, "short"), otherwise="ok"))


@query("r5_insert_normalised", "SELECT DISTINCT coalesce(c.canonical_name, e.source) AS source, e.target FROM sparse e LEFT JOIN canonical c ON e.source = c.entity_name AND c.category = 'ASIA'", (SPARSE, CANONICAL))
def r5(spark, d, sparse=edges_sparse):
    names = canonical(spark, d).filter("category = 'ASIA'").select(F.col("entity_name").alias("source"), "canonical_name")
    rows = sparse(spark, d).join(names, "source", "left").select(F.coalesce("canonical_name", "source").alias("source"), "target")
    return sinks.insert_ignore(rows.limit(0), rows, ["source", "target"])


@query("r7_summary_export", "SELECT count(DISTINCT source) AS names, count(DISTINCT CASE WHEN canonical_name IS NOT NULL THEN source END) AS normalised, round(count(canonical_name) / CAST(count(*) AS DOUBLE), 6) AS rate FROM sparse LEFT JOIN canonical ON source = entity_name AND category <> 'EUROPE'", (SPARSE, CANONICAL))
def r7(spark, d, sparse=edges_sparse):
    names = canonical(spark, d).filter("category <> 'EUROPE'").select(F.col("entity_name").alias("source"), "canonical_name")
    rows = sparse(spark, d).join(names, "source", "left")
    return rows.agg(F.countDistinct("source").alias("names"), F.countDistinct(F.when(F.col("canonical_name").isNotNull(), F.col("source"))).alias("normalised"), r6(F.count("canonical_name") / F.count("*")).alias("rate"))


@query("r9_consensus_validation", ", g AS (SELECT source, target, outcome, count(DISTINCT paper_id) AS papers, round(avg(confidence), 6) AS c FROM sparse GROUP BY ALL) SELECT source, target, outcome, papers >= 2 AND c >= 0.7 AS accepted FROM g", (SPARSE,))
def r9(spark, d, sparse=edges_sparse):
    c = ev.consensus(sparse(spark, d), ["source", "target"])
    return c.select("source", "target", "outcome", ((F.col("papers") >= 2) & (r6("mean") >= 0.7)).alias("accepted"))


@query("r10_consensus_ratios", ", g AS (SELECT source, target, count(DISTINCT outcome) AS k, count(*) AS n FROM sparse GROUP BY ALL) SELECT count(*) AS pairs, round(count(CASE WHEN k = 1 THEN 1 END) / CAST(count(*) AS DOUBLE), 6) AS agreed, round(avg(n), 6) AS studies FROM g", (SPARSE,))
def r10(spark, d, sparse=edges_sparse):
    g = sparse(spark, d).groupBy("source", "target").agg(F.countDistinct("outcome").alias("k"), F.count("*").alias("n"))
    return g.agg(F.count("*").alias("pairs"), r6(F.count_if(F.col("k") == 1) / F.count("*")).alias("agreed"), r6(F.avg("n")).alias("studies"))


@query("r12_function_targets", "SELECT mechanism, count(DISTINCT source) AS members FROM sparse WHERE outcome = 'improves' GROUP BY mechanism", (SPARSE,))
def r12(spark, d, sparse=edges_sparse):
    m = sparse(spark, d).filter("outcome = 'improves'").groupBy("source").agg(F.collect_set("mechanism").alias("functions"))
    return m.select(F.explode("functions").alias("mechanism")).groupBy("mechanism").agg(F.count("*").alias("members"))


@query("r13_map_insights", ", t AS (SELECT target, count(DISTINCT source) AS n FROM sparse GROUP BY target) SELECT count(*) AS conditions, min(n) AS least, max(n) AS most, round(avg(n), 6) AS mean FROM t", (SPARSE,))
def r13(spark, d, sparse=edges_sparse):
    t = sparse(spark, d).groupBy("target").agg(F.countDistinct("source").alias("n"))
    return t.agg(F.count("*").alias("conditions"), F.min("n").alias("least"), F.max("n").alias("most"), r6(F.avg("n")).alias("mean"))


@query("r14_category_report", "SELECT category, entity_type, count(*) AS members, count(DISTINCT canonical_name) AS groups FROM canonical GROUP BY ALL", (CANONICAL,))
def r14(spark, d):
    return canonical(spark, d).groupBy("category", "entity_type").agg(F.count("*").alias("members"), F.countDistinct("canonical_name").alias("groups"))


@query("r15_apply_categories", "SELECT entity_name, 'functional' AS category_type, CASE WHEN category IN ('ASIA', 'EUROPE') THEN 'old world' ELSE 'other' END AS category_name FROM canonical WHERE entity_type = 'intervention' UNION SELECT entity_name, 'primary', category FROM canonical WHERE entity_type = 'intervention'", (CANONICAL,))
def r15(spark, d):
    c = canonical(spark, d).filter("entity_type = 'intervention'")
    have = c.select("entity_name", F.lit("primary").alias("category_type"), F.col("category").alias("category_name"))
    new = c.select("entity_name", F.lit("functional").alias("category_type"), F.when(F.col("category").isin("ASIA", "EUROPE"), "old world").otherwise("other").alias("category_name"))
    return sinks.insert_ignore(have, new, ["entity_name", "category_type"])


@query("r16_naming_cache", "SELECT cluster_id, md5(string_agg(CAST(member AS VARCHAR), '|' ORDER BY member)) AS k FROM clusters GROUP BY cluster_id", (CLUSTERS,))
def r16(spark, d):
    return clusters(spark, d).groupBy("cluster_id").agg(F.md5(F.array_join(F.array_sort(F.collect_list("member")), "|")).alias("k"))


@query("r17_evaluation_report", """WITH x AS (SELECT CASE WHEN toxic = 1 THEN 'toxic' ELSE 'clean' END AS truth, CASE WHEN quality = 0 THEN 'toxic' ELSE 'clean' END AS guess FROM labels), k AS (SELECT * FROM (VALUES ('toxic'), ('clean')) t(label)),
  c AS (SELECT label, count(CASE WHEN truth = label AND guess = label THEN 1 END) AS tp, count(CASE WHEN truth <> label AND guess = label THEN 1 END) AS fp, count(CASE WHEN truth = label AND guess <> label THEN 1 END) AS fn FROM x, k GROUP BY label)
  SELECT label, tp, fp, fn, round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / CAST(tp + fp AS DOUBLE) END, 6) AS precision, round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / CAST(tp + fn AS DOUBLE) END, 6) AS recall, round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) END, 6) AS f1 FROM c""")
def r17(spark, d):
    """Low quality as a guess at toxicity."""
    word = lambda c, v: F.when(F.col(c) == v, "toxic").otherwise("clean")
    return classification_report(raw(spark, d, "labels").select(word("toxic", 1).alias("truth"), word("quality", 0).alias("guess")))


@query("r18_taxonomy", "SELECT c.category, count(e.study_id) AS n FROM (VALUES ('ECONOMY'), ('PROMO'), ('LARGE')) c(category) LEFT JOIN edges e ON e.mechanism = c.category GROUP BY c.category", (EDGES,))
def r18(spark, d):
    known = spark.sql("SELECT explode(array('ECONOMY', 'PROMO', 'LARGE')) AS category")
    n = edges(spark, d).groupBy(F.col("mechanism").alias("category")).agg(F.count("*").alias("n"))
    return known.join(n, "category", "left").select("category", F.coalesce("n", F.lit(0)).alias("n"))


@query("r19_resume_log", "SELECT CAST(substr(o_orderpriority, 1, 1) AS INT) AS batch, count(*) AS rows, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY 1")
def r19(spark, d):
    """A session whose first run dies before its second batch counts; the next run goes on from there."""
    at, steps = _scratch(spark, "session"), []

    def dies(step: str) -> None:
        steps.append(step)
        if len(steps) == 6:
            raise InterruptedError(step)

    work = lambda df: df.withColumn("cents", F.round(F.col("o_totalprice") * 100).cast("bigint"))
    rows = _by_priority(spark, d).withColumn("of", F.col("batch"))
    first = sessions.Session(spark, at)
    try:
        first.run(rows, "batch", work, dies)
    except InterruptedError:
        later = sessions.Session(spark, at, clock=lambda: first.clock() + 2 * sessions.LEASE)
        later.run(rows, "batch", work)
    return first.output().groupBy(F.col("of").alias("batch")).agg(F.count("*").alias("rows"), F.sum("cents").alias("cents"))


@query("s11_content_cache", """, t AS (SELECT DISTINCT mechanism AS text FROM edges UNION SELECT DISTINCT source FROM edges UNION SELECT DISTINCT target FROM edges), h AS (SELECT DISTINCT lower(mechanism) AS text FROM edges)
  SELECT text, sha256('words|8|' || lower(text)) AS key, lower(text) IN (SELECT text FROM h) AS hit, 8 AS dimension FROM t""", (EDGES,))
def s11_cache(spark, d):
    """Names asked of a store that has seen the mechanisms: what is stored is not computed again."""
    e = edges(spark, d)
    cache = content_cache.ContentCache(spark, _scratch(spark, "cache"), "words", 8)
    hashed = lambda df: df.select("key", F.transform(F.sequence(F.lit(1), F.lit(8)), lambda i: F.pmod(F.xxhash64("text", i), F.lit(1000)) + 1.0).alias("vector"))
    cache.vectors(e.select("mechanism").distinct(), "mechanism", hashed)
    seen = cut_lineage(cache.entries().select("key", F.lit(True).alias("hit")), "seen")
    texts = e.select(F.explode(F.array("mechanism", "source", "target")).alias("text")).distinct()
    found, _ = cache.vectors(texts, "text", hashed)
    return found.join(seen, "key", "left").select("text", "key", F.coalesce("hit", F.lit(False)).alias("hit"), F.size("vector").alias("dimension"))


@query("r23_snapshot_rewrite", "SELECT pmid, title, journal FROM papers", (PAPERS,))
def r23(spark, d):
    """Columns dropped by writing a new snapshot."""
    s = sinks.Snapshots(spark, _scratch(spark, "table"))
    s.publish(papers(spark, d))
    s.publish(s.read().select("pmid", "title", "journal"))
    return s.read()


@query("r24_condition_status", "SELECT target, count(*) AS n, count(CASE WHEN source IN (SELECT entity_name FROM canonical WHERE category = 'ASIA') THEN 1 END) AS normalised FROM sparse GROUP BY target", (SPARSE, CANONICAL))
def r24(spark, d, sparse=edges_sparse):
    done = canonical(spark, d).filter("category = 'ASIA'").select(F.col("entity_name").alias("source"), F.lit(True).alias("done")).distinct()
    return sparse(spark, d).join(done, "source", "left").groupBy("target").agg(F.count("*").alias("n"), F.count("done").alias("normalised"))


# -- drivers and lookups -----------------------------------------------------------------
@query("c4_add_missing_column", "SELECT pmid, CAST(NULL AS VARCHAR) AS tldr FROM papers", (PAPERS,))
def c4(spark, d):
    p = papers(spark, d)
    return (p if "tldr" in p.columns else p.withColumn("tldr", F.lit(None).cast("string"))).select("pmid", "tldr")


@query("c6_category_dimension", "SELECT category, list_sort(list(DISTINCT canonical_name))[1] AS first, count(DISTINCT canonical_name) AS terms FROM canonical GROUP BY category", (CANONICAL,))
def c6(spark, d):
    return canonical(spark, d).groupBy("category").agg(F.min("canonical_name").alias("first"), F.countDistinct("canonical_name").alias("terms"))


@query("c8_migration_check", """WITH w AS (SELECT ['positive', 'Negative ', 'neutral', 'mixed', 'improves', '', 'other'][1 + CAST(o_custkey % 7 AS INT)] AS word FROM orders)
  SELECT word, CASE lower(trim(word)) WHEN 'positive' THEN 'improves' WHEN 'negative' THEN 'worsens' WHEN 'mixed' THEN 'inconclusive' WHEN 'improves' THEN 'improves' ELSE 'no_effect' END AS stored, lower(trim(word)) NOT IN ('positive', 'negative', 'neutral', 'mixed', 'improves', 'worsens', 'no_effect', 'inconclusive') AS unknown, count(*) AS rows FROM w GROUP BY ALL""")
def c8(spark, d):
    """What the migration makes of each word, and which words it does not know."""
    words = F.array(*[F.lit(w) for w in ("positive", "Negative ", "neutral", "mixed", "improves", "", "other")])
    w = raw(spark, d, "orders").select(F.element_at(words, (F.col("o_custkey") % 7 + 1).cast("int")).alias("word"))
    unknown = ~F.lower(F.trim("word")).isin(*va.OUTCOMES, *labels.OUTCOME_ALIASES)
    return w.groupBy("word", labels.canonical_outcome(F.col("word")).alias("stored"), unknown.alias("unknown")).agg(F.count("*").alias("rows"))


@query("c9_tested_pairs", "SELECT DISTINCT source, target FROM sparse", (SPARSE,))
def c9(spark, d, sparse=edges_sparse):
    return sparse(spark, d).select("source", "target").distinct()


@query("c9_gap_predictions", _GAPS.replace("SELECT source, target, score, sources, CASE WHEN", "SELECT source, score, CASE WHEN").replace("FROM z WHERE", "FROM z WHERE target = 'Brand#11' AND"), (SPARSE,), whole=False)
def c9_stored(spark, d, sparse=edges_sparse):
    """One condition's predictions from the stored ones."""
    s = sinks.Snapshots(spark, _scratch(spark, "gaps"))
    s.publish(mn.gaps(sparse(spark, d), brand_clusters(spark, d), {"Supplier#000000003": 0.9}, cap=None).withColumns({"score": r6("score"), "feasibility": feasibility(F.col("source"))}))
    return s.read().filter("target = 'Brand#11'").drop("target", "sources")


@query("c10_failure_status", """, f AS (SELECT source, count(CASE WHEN outcome <> 'improves' THEN 1 END) / CAST(count(*) AS DOUBLE) AS r, count(*) AS n FROM sparse GROUP BY source), c AS (SELECT source, r FROM f WHERE r >= 0.36 AND n >= 3)
  SELECT s_name AS source, CASE WHEN r IS NOT NULL THEN 'FAILED' ELSE 'NOT_IN_CATALOG' END AS status, round(r, 6) AS failure_rate, CASE WHEN r IS NULL THEN NULL WHEN s_name = 'Supplier#000000000' THEN 'walking,sleep' ELSE 'consult_healthcare_provider' END AS alternatives FROM supplier LEFT JOIN c ON s_name = source""", (SPARSE,))
def c10(spark, d, sparse=edges_sparse):
    known = {"Supplier#000000000": ("walking", "sleep")}
    out = mn.failure_status(raw(spark, d, "supplier").select(F.col("s_name").alias("source")), mn.failures(sparse(spark, d), 0.36), known)
    return out.select("source", "status", r6("failure_rate").alias("failure_rate"), F.array_join("alternatives", ",").alias("alternatives"))


#: Keywords of a condition's name and the mechanism loadings they stand for.
FALLBACK_PROFILES = (
    (("depression", "anxiety", "ptsd", "panic", "ocd"), {"neuropsych": 0.8, "neurotransmitter": 0.7, "stress_response": 0.6}),
    (("ibs", "sibo", "crohn", "colitis", "gut"), {"gut_microbiome": 0.8, "inflammation": 0.5}),
    (("diabetes", "pcos", "metabolic", "obesity"), {"metabolic": 0.8, "hormonal": 0.6, "inflammation": 0.4}),
    (("arthritis", "lupus", "psoriasis", "autoimmune"), {"inflammation": 0.9, "pain_management": 0.6}),
    (("pain", "fibromyalgia", "fatigue", "migraine"), {"pain_management": 0.8, "stress_response": 0.5, "inflammation": 0.4}),
)
DEFAULT_PROFILE = {"inflammation": 0.5, "stress_response": 0.3}


def fallback_profile(condition):
    """Loadings by keywords; a later match replaces an earlier one's loading of the same mechanism."""
    name = F.lower(condition)
    out = F.create_map().cast("map<string,double>")
    without = lambda names: lambda k, _: ~k.isin(*names)
    for words, profile in FALLBACK_PROFILES:
        hit = F.exists(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(name, w))
        more = F.create_map(*[F.lit(x) for p in profile.items() for x in p])
        out = F.when(hit, F.map_concat(F.map_filter(out, without(list(profile))), more)).otherwise(out)
    default = F.create_map(*[F.lit(x) for p in DEFAULT_PROFILE.items() for x in p])
    return F.when(F.size(out) == 0, default).otherwise(out)


@query("c11_fallback_profiles", """WITH k AS (SELECT p_partkey, ['Chronic pain and ', 'gut', 'Anxiety with IBS ', '', 'PCOS / lupus', 'migraine of the gut '][1 + CAST(p_partkey % 6 AS INT)] || p_name AS condition FROM part),
  rule(i, words, mechanism, x) AS (VALUES """ + ", ".join(f"({i}, {list(words)!r}, '{m}', {x!r}::DOUBLE)" for i, (words, profile) in enumerate(FALLBACK_PROFILES) for m, x in profile.items()) + """),
  f AS (SELECT p_partkey, mechanism, arg_max(x, i) AS x FROM k, rule WHERE len(list_filter(words, lambda w: contains(lower(condition), w))) > 0 GROUP BY ALL), g AS (SELECT p_partkey, string_agg(mechanism || '=' || x, ',' ORDER BY mechanism) AS profile FROM f GROUP BY p_partkey)
  SELECT p_partkey, coalesce(profile, '""" + ",".join(f"{m}={x}" for m, x in sorted(DEFAULT_PROFILE.items())) + """') AS profile FROM k LEFT JOIN g USING (p_partkey)""")
def c11(spark, d):
    made = F.array(*[F.lit(w) for w in ("Chronic pain and ", "gut", "Anxiety with IBS ", "", "PCOS / lupus", "migraine of the gut ")])
    rows = raw(spark, d, "part").select("p_partkey", F.concat(F.element_at(made, (F.col("p_partkey") % 6 + 1).cast("int")), "p_name").alias("condition"))
    entries = F.array_sort(F.transform(F.map_entries(fallback_profile(F.col("condition"))), lambda e: F.concat(e.key, F.lit("="), e.value.cast("string"))))
    return rows.select("p_partkey", F.array_join(entries, ",").alias("profile"))


@query("c12_evidence_by_treatment", "SELECT source, count(*) AS n, min(year) AS first, max(year) AS last, count(DISTINCT study_design) AS designs FROM edges GROUP BY source", (EDGES,))
def c12(spark, d):
    return edges(spark, d, design=True).groupBy("source").agg(F.count("*").alias("n"), F.min("year").alias("first"), F.max("year").alias("last"), F.countDistinct("study_design").alias("designs"))


@query("c13_single_source_branch", ", g AS (SELECT source, target, mechanism, count(*) AS n, round(avg(confidence), 6) AS c FROM sparse GROUP BY ALL) SELECT source, target, mechanism, CASE WHEN n = 1 THEN 'single' ELSE 'consensus' END AS kind, c AS confidence FROM g", (SPARSE,))
def c13(spark, d, sparse=edges_sparse):
    g = sparse(spark, d).groupBy("source", "target", "mechanism").agg(F.count("*").alias("n"), r6(F.avg("confidence")).alias("confidence"))
    return g.select("source", "target", "mechanism", F.when(F.col("n") == 1, "single").otherwise("consensus").alias("kind"), "confidence")


@query("c14_permissive_json", "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN NULL ELSE TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events")
def c14(spark, d):
    body = F.when(F.col("event_id") % 4 == 0, "{broken").otherwise(F.col("props"))
    return raw(spark, d, "events").select("event_id", F.from_json(body, "k string").getField("k").try_cast("bigint").alias("k"))


@query("c15_repair_suggestions", "SELECT study_id, 'worsens' AS suggested FROM edges WHERE outcome = 'improves' AND mechanism LIKE '%MEDIUM%' AND confidence < 0.6", (EDGES,))
def c15(spark, d):
    return edges(spark, d).filter("outcome = 'improves' AND mechanism LIKE '%MEDIUM%' AND confidence < 0.6").select("study_id", F.lit("worsens").alias("suggested"))


@query("c16_combinations_of_condition", ", s AS (SELECT source, list(DISTINCT target) AS t FROM sparse GROUP BY source) SELECT source FROM s WHERE list_contains(t, 'Brand#11')", (SPARSE,))
def c16(spark, d, sparse=edges_sparse):
    s = sparse(spark, d).groupBy("source").agg(F.collect_set("target").alias("t"))
    return s.filter(F.array_contains("t", "Brand#11")).select("source")


@query("c19_entity_validators", "SELECT entity_name, entity_type IN ('intervention', 'condition', 'mechanism') AND length(entity_name) BETWEEN 1 AND 1000 AS valid FROM canonical", (CANONICAL,))
def c19(spark, d):
    ok = F.col("entity_type").isin("intervention", "condition", "mechanism") & F.length("entity_name").between(1, 1000)
    return canonical(spark, d).select("entity_name", ok.alias("valid"))


@query("c20_mean_of_present", ", e AS (SELECT paper_id, CASE WHEN sample_size > 25 THEN confidence END AS c FROM edges) SELECT paper_id, round(avg(c), 6) AS merged FROM e GROUP BY paper_id", (EDGES,))
def c20(spark, d):
    return edges(spark, d).groupBy("paper_id").agg(r6(F.avg(F.when(F.col("sample_size") > 25, F.col("confidence")))).alias("merged"))


@query("c23_enrichment", "SELECT pmid, coalesce(influence_score, 0) + citation_count AS influence, influence_score IS NOT NULL AS processed FROM papers", (PAPERS,))
def c23(spark, d):
    p = papers(spark, d)
    found = p.filter("influence_score IS NOT NULL").select("pmid", F.lit(True).alias("processed"))
    return sinks.update_by_key(p.withColumn("processed", F.lit(False)), found, "pmid").select("pmid", (F.coalesce("influence_score", F.lit(0)) + F.col("citation_count")).alias("influence"), "processed")


@query("c26_name_templates", "SELECT DISTINCT source, 'intervention: ' || source || ' (' || mechanism || ')' AS text FROM sparse", (SPARSE,))
def c26(spark, d, sparse=edges_sparse):
    return sparse(spark, d).select("source", F.format_string("intervention: %s (%s)", "source", "mechanism").alias("text")).distinct()


@query("c28_cluster_loader", "SELECT c.cluster_id, count(*) AS members, count(DISTINCT e.label) AS labels FROM clusters c JOIN embeddings e ON c.member = e.vec_id GROUP BY c.cluster_id", (CLUSTERS,))
def c28(spark, d):
    e = raw(spark, d, "embeddings").select(F.col("vec_id").alias("member"), "label")
    return clusters(spark, d).select("member", "cluster_id").join(e, "member").groupBy("cluster_id").agg(F.count("*").alias("members"), F.countDistinct("label").alias("labels"))


@query("c31_merge_transaction", """, h AS (SELECT vec_id AS cluster_id, CASE WHEN vec_id > 0 THEN (vec_id - 1) // 2 END AS parent_id, CAST(floor(log2(vec_id + 1)) AS INT) AS level FROM embeddings), top AS (SELECT max(cluster_id) AS t FROM h)
  SELECT h.cluster_id, CASE WHEN h.cluster_id IN (7, 8) THEN t + 1 WHEN h.parent_id = 6 THEN 5 ELSE h.parent_id END AS parent_id, CASE WHEN h.cluster_id IN (7, 8) THEN 1 ELSE h.level END AS level, (SELECT count(*) FROM clusters c WHERE CASE WHEN c.member = 6 THEN 5 ELSE c.member END = h.cluster_id) AS members
  FROM h, top WHERE h.cluster_id <> 6 UNION ALL SELECT t + 1, NULL, 0, 0 FROM top""", (CLUSTERS,))
def c31(spark, d):
    """Merges that validate are published; a set that would leave orphans is rolled back."""
    tree, junction = (sinks.Snapshots(spark, _scratch(spark, n)) for n in ("hierarchy", "junction"))
    h = hierarchy(spark, d)
    tree.publish(h)
    junction.publish(clusters(spark, d).select("member", F.col("member").alias("cluster_id")))
    good = spark.sql("SELECT * FROM VALUES (5L, 6L, 'identical'), (7L, 8L, 'variant') AS t(a, b, relation)")
    bad = spark.sql("SELECT * FROM VALUES (1000000L, 2L, 'identical') AS t(a, b, relation)")  # children would go to a cluster that is not there
    if not cl.merge_transaction(tree, junction, good) or cl.merge_transaction(tree, junction, bad):
        raise ValueError("the transactions should end in a commit and a rollback")
    n = junction.read().groupBy("cluster_id").agg(F.count("*").alias("members"))
    return tree.read().join(n, "cluster_id", "left").withColumn("members", F.coalesce("members", F.lit(0)))


@query("c33_category_lookup", "SELECT entity_name, CASE WHEN category IN ('ASIA', 'EUROPE') THEN 'consider merging across ' || category ELSE 'keep' END AS suggestion FROM canonical WHERE entity_type = 'intervention'", (CANONICAL,))
def c33(spark, d):
    c = canonical(spark, d).filter("entity_type = 'intervention'")
    return c.select("entity_name", F.when(F.col("category").isin("ASIA", "EUROPE"), F.concat(F.lit("consider merging across "), "category")).otherwise("keep").alias("suggestion"))


@query("c34_condition_hierarchy", "SELECT canonical_name AS parent, count(*) AS children FROM canonical WHERE entity_type = 'condition' GROUP BY canonical_name", (CANONICAL,))
def c34(spark, d):
    rows = canonical(spark, d).filter("entity_type = 'condition'").groupBy(F.col("canonical_name").alias("parent")).agg(F.count("*").alias("children"))
    return cut_lineage(rows, "hierarchy")


@query("c35_pair_evaluation", "SELECT l.quality = (CASE WHEN d.n_chars > 200 THEN 1 ELSE 0 END) AS agrees, count(*) AS n FROM labels l JOIN documents d USING (doc_id) GROUP BY 1")
def c35(spark, d):
    guess = raw(spark, d, "documents").select("doc_id", (F.col("n_chars") > 200).cast("int").alias("guess"))
    return raw(spark, d, "labels").join(guess, "doc_id").groupBy((F.col("quality") == F.col("guess")).alias("agrees")).agg(F.count("*").alias("n"))


@query("c38_export_coercion", "SELECT pmid, CAST(coalesce(influence_score, 0) AS VARCHAR) <> '0.0' AS scored, CAST(has_fulltext AS INT) AS fulltext FROM papers", (PAPERS,))
def c38(spark, d):
    return papers(spark, d).select("pmid", (F.coalesce("influence_score", F.lit(0.0)) != 0).alias("scored"), F.col("has_fulltext").cast("int").alias("fulltext"))


@query("c40_all_checks", ", g AS (SELECT category, count(*) AS n, count(CASE WHEN entity_name NOT LIKE '%7' THEN canonical_name END) AS m FROM canonical GROUP BY category) SELECT category, m >= 0.9 * n AS coverage, n >= 25 AS volume, m >= 0.9 * n AND n >= 25 AS passed FROM g", (CANONICAL,))
def c40(spark, d):
    """Checks by category; names that end in 7 count as not yet mapped."""
    g = canonical(spark, d).groupBy("category").agg(F.count("*").alias("n"), F.count(F.when(~F.col("entity_name").like("%7"), F.col("canonical_name"))).alias("m"))
    coverage, volume = F.col("m") >= 0.9 * F.col("n"), F.col("n") >= 25
    return g.select("category", coverage.alias("coverage"), volume.alias("volume"), (coverage & volume).alias("passed"))


@query("m6_min_evidence", ", k AS (SELECT source, target, count(CASE WHEN outcome <> 'inconclusive' THEN 1 END) AS evidence_count FROM sparse GROUP BY ALL) SELECT source, target, evidence_count FROM k WHERE evidence_count >= 3", (SPARSE,))
def m6_min(spark, d, sparse=edges_sparse):
    return bayes.score_pairs(sparse(spark, d), 3, quantiles=False).select("source", "target", "evidence_count")


@query("e5_group_local_candidates", "SELECT a.n_name AS a, b.n_name AS b FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_name < b.n_name AND length(a.n_name) = length(b.n_name)")
def e5_local(spark, d):
    n = raw(spark, d, "nation").select("n_regionkey", F.col("n_name").alias("name"))
    pairs = rs.candidate_pairs(n, "n_regionkey", 0.0)
    return pairs.filter(F.length("a") == F.length("b")).select("a", "b")
