"""Sinks, entity resolution, validation, exports (K, E, Q, R and C rows)."""

from pyspark.sql import functions as F

from ..operators import exports as ex
from ..operators import resolution as rs
from ..operators import validation as va
from ..operators.evidence import fold_pairs
from ..sources import sinks
from ..sources.tables import canonical, edges, edges_sparse, papers, raw
from .registry import CANONICAL, EDGES, PAPERS, SPARSE, query, r6


@query("k1_insert_ignore", "SELECT pmid, journal FROM papers WHERE pmid % 2 = 0 UNION ALL SELECT pmid, 'new' FROM papers WHERE pmid % 2 = 1 AND pmid % 3 = 0", (PAPERS,))
def k1(spark, d):
    p = papers(spark, d).select("pmid", "journal")
    incoming = p.filter("pmid % 3 = 0").withColumn("journal", F.lit("new"))
    return sinks.insert_ignore(p.filter("pmid % 2 = 0"), incoming.union(incoming), ["pmid"])


@query("k2_insert_replace", "SELECT pmid, CASE WHEN pmid % 3 = 0 THEN 'new' ELSE journal END AS journal FROM papers WHERE pmid % 2 = 0 OR pmid % 3 = 0", (PAPERS,))
def k2(spark, d):
    p = papers(spark, d).select("pmid", "journal")
    return sinks.insert_replace(p.filter("pmid % 2 = 0"), p.filter("pmid % 3 = 0").withColumn("journal", F.lit("new")), ["pmid"])


@query("k3_update_by_key", "SELECT pmid, journal, CASE WHEN citation_count > 50 THEN 'needs_review' ELSE processing_status END AS processing_status FROM papers", (PAPERS,))
def k3(spark, d):
    p = papers(spark, d)
    changes = p.filter("citation_count > 50").select("pmid", F.lit("needs_review").alias("processing_status"))
    return sinks.update_by_key(p.select("pmid", "journal", "processing_status"), changes, "pmid")


@query("k4_delete_where", "SELECT pmid, doi FROM papers WHERE NOT coalesce(doi LIKE '%7', FALSE)", (PAPERS,))
def k4(spark, d):
    return sinks.delete_where(papers(spark, d).select("pmid", "doi"), F.col("doi").like("%7"))


@query("k6_junction", "SELECT DISTINCT e.mechanism, c.canonical_name FROM sparse e JOIN canonical c ON e.source = c.entity_name", (SPARSE, CANONICAL))
def k6(spark, d, sparse=edges_sparse):
    names = canonical(spark, d).select(F.col("entity_name").alias("source"), "canonical_name")
    return sinks.junction(sparse(spark, d).select("source", "mechanism"), names, "source").select("mechanism", "canonical_name").distinct()


@query("k8_table_export", """SELECT source, count(*) AS studies, count(DISTINCT target) AS conditions, round(avg(confidence), 6) AS confidence FROM sparse GROUP BY source""", (SPARSE,))
def k8(spark, d, sparse=edges_sparse):
    """The nested table view (one document a row), read back from its JSON."""
    doc = sparse(spark, d).groupBy("source").agg(F.to_json(F.struct(F.count("*").alias("studies"), F.array_sort(F.collect_set("target")).alias("conditions"), F.avg("confidence").alias("confidence"))).alias("doc"))
    x = F.from_json("doc", "studies bigint, conditions array<string>, confidence double")
    return doc.select("source", x.alias("x")).select("source", "x.studies", F.size("x.conditions").cast("bigint").alias("conditions"), r6("x.confidence").alias("confidence"))


@query("k10_minimal_export", "SELECT source, target, mechanism, CASE WHEN outcome = 'inconclusive' THEN 'unsure' ELSE outcome END AS outcome, year FROM sparse", (SPARSE,))
def k10(spark, d, sparse=edges_sparse):
    from ..functions.labels import display_outcome

    return sparse(spark, d).select("source", "target", "mechanism", display_outcome(F.col("outcome")).alias("outcome"), "year")


@query("k10_basic_export", "SELECT study_id, target AS condition, source AS intervention, CASE WHEN outcome = 'inconclusive' THEN 'unsure' ELSE outcome END AS correlation, confidence AS confidence_score, title, journal, TRY_CAST(substr(publication_date, 1, 4) AS INT) AS publication_year FROM edges LEFT JOIN papers ON paper_id = pmid", (EDGES, PAPERS))
def k10_basic(spark, d):
    return ex.basic_export(edges(spark, d), papers(spark, d))


@query("k10_enhanced_export", """SELECT study_id, target AS condition, source AS intervention, CASE WHEN outcome = 'inconclusive' THEN 'unsure' ELSE outcome END AS correlation, sample_size AS study_size, TRY_CAST(substr(publication_date, 1, 4) AS INT) AS publication_year, confidence AS confidence_score,
  study_design AS study_type, mechanism, title, doi, 'https://pubmed.ncbi.nlm.nih.gov/' || pmid || '/' AS pubmed_url FROM edges LEFT JOIN papers ON paper_id = pmid""", (EDGES, PAPERS))
def k10_enhanced(spark, d):
    return ex.enhanced_export(edges(spark, d, design=True), papers(spark, d)).select("*", "paper.title", "paper.doi", "paper.pubmed_url").drop("paper")


@query("k10_export_summary", """, i AS (SELECT source, row_number() OVER (ORDER BY count(*) DESC, source) AS r FROM edges GROUP BY source), c AS (SELECT target, row_number() OVER (ORDER BY count(*) DESC, target) AS r FROM edges GROUP BY target)
  SELECT count(*) AS total, count(DISTINCT source) AS interventions, count(DISTINCT target) AS conditions, count(DISTINCT paper_id) AS papers, count(CASE WHEN outcome = 'improves' THEN 1 END) AS improves, count(CASE WHEN outcome = 'worsens' THEN 1 END) AS worsens, count(CASE WHEN outcome = 'no_effect' THEN 1 END) AS no_effect,
  count(CASE WHEN outcome = 'inconclusive' THEN 1 END) AS inconclusive, round(avg(confidence) + 1e-9, 3) AS mean_confidence, (SELECT string_agg(source, ',' ORDER BY r) FROM i WHERE r <= 10) AS top_interventions, (SELECT string_agg(target, ',' ORDER BY r) FROM c WHERE r <= 10) AS top_conditions FROM edges""", (EDGES,))
def k10_summary(spark, d):
    return ex.export_summary(edges(spark, d)).withColumns({c: F.array_join(c, ",") for c in ("top_interventions", "top_conditions")})


@query("c25_extraction_chain", """, v AS (SELECT paper_id, study_id, source, target, mechanism, outcome, confidence, sample_size FROM edges WHERE paper_id % 7 <> 5 AND NOT (sample_size < 3 AND paper_id % 2 = 0)),
  n AS (SELECT * FROM v WHERE paper_id % 3 <> 0 QUALIFY row_number() OVER (PARTITION BY paper_id, source, target ORDER BY confidence DESC, study_id) = 1),
  o AS (SELECT paper_id, min(study_id) AS study_id, source, target FROM edges WHERE paper_id % 3 <> 1 GROUP BY paper_id, source, target)
  SELECT paper_id, study_id, source, target, outcome, confidence FROM n UNION ALL SELECT o.paper_id, o.study_id, o.source, o.target, 'unknown', 0.0 FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.paper_id = o.paper_id AND n.source = o.source AND n.target = o.target)""", (EDGES,))
def c25(spark, d):
    """Answers for two thirds of the papers, some broken, some that hold nothing, some with an outcome that is no word, saved over older records."""
    e = edges(spark, d)
    record = F.struct("study_id", "source", "target", "mechanism", F.when((F.col("sample_size") < 3) & (F.col("paper_id") % 2 == 0), "better").otherwise(F.col("outcome")).alias("outcome"), "confidence", "sample_size")
    told = e.filter("paper_id % 3 <> 0").groupBy("paper_id").agg(F.to_json(F.collect_list(record)).alias("json"))
    k = F.col("paper_id") % 7
    answer = F.when(k == 5, "I can not say.").when(k == 6, F.replace("json", F.lit("]"), F.lit(",]"))).otherwise(F.concat(F.lit("<think>so</think>```json\n"), "json", F.lit("\n```")))
    old = e.filter("paper_id % 3 <> 1").groupBy("paper_id", "source", "target").agg(F.min("study_id").alias("study_id"))
    old = old.select("paper_id", "study_id", "source", "target", F.lit("unknown").alias("outcome"), F.lit(0.0).alias("confidence"))
    return ex.save_extracted(old, told.select("paper_id", answer.alias("answer")), "paper_id", "answer", ["paper_id", "source", "target"])


@query("k11_training_export", "SELECT study_id, 'What does ' || source || ' do for ' || target || '?' AS prompt, outcome AS answer FROM sparse WHERE confidence >= 0.9", (SPARSE,))
def k11(spark, d, sparse=edges_sparse):
    ask = F.concat(F.lit("What does "), "source", F.lit(" do for "), "target", F.lit("?"))
    return sparse(spark, d).filter("confidence >= 0.9").select("study_id", ask.alias("prompt"), F.col("outcome").alias("answer"))


@query("e1_normalised_terms", "SELECT DISTINCT entity_name, trim(regexp_replace(lower(entity_name), '[#]', '', 'g')) AS normal FROM canonical", (CANONICAL,))
def e1(spark, d):
    from ..functions.text import normalize_term

    return canonical(spark, d).select("entity_name", normalize_term(F.col("entity_name")).alias("normal")).distinct()


@query("e2_best_mapping", """, m AS (SELECT source AS term, mechanism AS canonical_name, max(confidence) AS confidence FROM sparse GROUP BY ALL) SELECT t.term, (SELECT arg_max(canonical_name, (confidence, canonical_name)) FROM m WHERE m.term = t.term) AS canonical_name, (SELECT max(confidence) FROM m WHERE m.term = t.term) AS confidence
  FROM (SELECT s_name AS term FROM supplier) t""", (SPARSE,))
def e2(spark, d, sparse=edges_sparse):
    m = sparse(spark, d).groupBy(F.col("source").alias("term"), F.col("mechanism").alias("canonical_name")).agg(F.max("confidence").alias("confidence"))
    return rs.best_mapping(raw(spark, d, "supplier").select(F.col("s_name").alias("term")), m)


@query("e2_find_or_create", """SELECT n_name AS term, CASE WHEN n_nationkey < 10 THEN n_nationkey ELSE 9 + row_number() OVER (PARTITION BY n_nationkey < 10 ORDER BY lower(replace(n_name, '_', '_'))) END AS id FROM nation""")
def e2_create(spark, d):
    n = raw(spark, d, "nation")
    known = n.filter("n_nationkey < 10").select(F.upper("n_name").alias("name"), F.col("n_nationkey").cast("bigint").alias("id"))
    return rs.find_or_create(n.select(F.col("n_name").alias("term")), known)


@query("e3_group_names", """, n AS (SELECT CASE WHEN paper_id % 3 = 0 THEN upper(mechanism) ELSE mechanism END AS name, confidence FROM sparse), s AS (SELECT lower(trim(name)) AS k, name, count(*) AS n, max(confidence) AS c FROM n GROUP BY ALL),
  p AS (SELECT k, arg_min(name, (-n, -c, name)) AS canonical_name, sum(n) AS members, avg(c) AS mean FROM s GROUP BY k) SELECT n.name, p.canonical_name, CAST(p.members AS BIGINT) AS members, CASE WHEN n.name = p.canonical_name THEN 1.0 ELSE 0.9 END::DOUBLE AS mapping_confidence, round(least(0.98, p.mean + 0.1), 6) AS consensus, count(*) AS n
  FROM n JOIN p ON lower(trim(n.name)) = p.k GROUP BY ALL""", (SPARSE,))
def e3(spark, d, sparse=edges_sparse):
    n = sparse(spark, d).select(F.when(F.col("paper_id") % 3 == 0, F.upper("mechanism")).otherwise(F.col("mechanism")).alias("name"), "confidence")
    g = rs.group_names(n).withColumn("consensus", r6("consensus"))
    return g.groupBy("name", "canonical_name", "members", "mapping_confidence", "consensus").agg(F.count("*").alias("n"))


@query("e5_candidate_pairs")
def e5(spark, d):
    n = raw(spark, d, "supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("block"))
    return rs.candidate_pairs(n, "block", 0.9).select("a", "b", r6("similarity").alias("similarity"))


@query("e6_categories", """, m AS (SELECT DISTINCT source AS entity, mechanism AS category_name, study_design AS category_type, confidence FROM sparse) SELECT entity, count(DISTINCT category_type) AS types, arg_min(category_name, (-confidence, category_name)) AS primary FROM m GROUP BY entity""".replace(" AS primary", ' AS "primary"'), (SPARSE,))
def e6(spark, d, sparse=edges_sparse):
    m = sparse(spark, d, design=True).select(F.col("source").alias("entity"), F.col("mechanism").alias("category_name"), F.col("study_design").alias("category_type"), "confidence").distinct()
    return rs.categories_of(m).select("entity", F.size("categories").cast("bigint").alias("types"), "primary")


@query("e8_reextraction_queue", "SELECT pmid, count(*) AS records FROM papers JOIN edges ON pmid = paper_id WHERE abstract IS NOT NULL AND length(mechanism) < 6 GROUP BY pmid", (EDGES, PAPERS))
def e8(spark, d):
    open_ = edges(spark, d).filter(F.length("mechanism") < 6).groupBy(F.col("paper_id").alias("pmid")).agg(F.count("*").alias("records"))
    return papers(spark, d).filter("abstract IS NOT NULL").select("pmid").join(open_, "pmid")


@query("q1_paper_rules", """, p AS (SELECT CASE WHEN pmid % 5 = 0 THEN pmid ELSE pmid + 10000000 END AS pmid, title, CASE WHEN citation_count < 90 THEN repeat(abstract || ' ', 4) ELSE abstract END AS abstract, publication_date FROM papers)
  SELECT pmid, CAST((CASE WHEN NOT regexp_matches(CAST(pmid AS VARCHAR), '^[0-9]{7,8}$') THEN 1 ELSE 0 END) + (CASE WHEN length(trim(abstract)) < 50 THEN 1 ELSE 0 END) AS BIGINT) AS issues, regexp_matches(CAST(pmid AS VARCHAR), '^[0-9]{7,8}$') AND coalesce(length(trim(abstract)) >= 50, TRUE) AS valid FROM p""", (PAPERS,))
def q1(spark, d):
    """Four ids of five are made long enough, and most abstracts."""
    p = papers(spark, d).withColumn("pmid", F.when(F.col("pmid") % 5 == 0, F.col("pmid")).otherwise(F.col("pmid") + 10000000))
    p = p.withColumn("abstract", F.when(F.col("citation_count") < 90, F.repeat(F.concat("abstract", F.lit(" ")), F.lit(4))).otherwise(F.col("abstract")))
    return va.validate_papers(p).select("pmid", F.size("issues").cast("bigint").alias("issues"), "valid")


@query("q2_record_rules", """, r AS (SELECT study_id, sample_size < 3 AS small, month = 1 AND confidence > 0.8 AS high, mechanism = 'SMALL' AS named, outcome = 'inconclusive' AS odd, mechanism = 'LARGE' AS told FROM edges)
  SELECT study_id, NOT (small OR high OR named OR odd) AS valid, CAST(small::INT + high::INT + named::INT + odd::INT + (NOT told)::INT AS BIGINT) AS issues FROM r""", (EDGES,))
def q2(spark, d):
    """Records spoilt by rule: too few people, too sure, a name that is none, a word that is no outcome; one mechanism is told in words."""
    e, m = edges(spark, d), F.col("mechanism")
    spoilt = e.withColumns({
        "sample_size": F.when(F.col("sample_size") < 3, 0.0).otherwise(F.col("sample_size")), "confidence": F.when((F.col("month") == 1) & (F.col("confidence") > 0.8), 1.2).otherwise(F.col("confidence")),
        "source": F.when(m == "SMALL", "unknown").otherwise(F.col("source")), "outcome": F.when(F.col("outcome") == "inconclusive", "perhaps").otherwise(F.col("outcome")),
        "mechanism": F.when(m == "LARGE", "lowers inflammation slowly").otherwise(m),
    })
    return va.validate_records(spoilt).select("study_id", "valid", F.size("issues").cast("bigint").alias("issues"))


@query("q5_export_verdict", ", e AS (SELECT mechanism, CASE WHEN mechanism <> 'SMALL' OR sample_size > 1 THEN source END AS source, target FROM sparse) SELECT mechanism, count(*) AS rows, count(DISTINCT source) AS sources, count(CASE WHEN source IS NULL THEN 1 END) AS incomplete, count(*) < 10 AS few, count(source) = count(*) AS valid FROM e GROUP BY mechanism", (SPARSE,))
def q5(spark, d, sparse=edges_sparse):
    """An export for each mechanism; small studies of one of them come without an intervention."""
    e = sparse(spark, d).withColumn("source", F.when((F.col("mechanism") != "SMALL") | (F.col("sample_size") > 1), F.col("source")))
    return va.export_verdict(e, by=["mechanism"])


@query("q6_order_breaks", ", p AS (SELECT target, source, round(avg(confidence), 6) AS v FROM sparse GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY target ORDER BY source) AS rank FROM p) SELECT target, source, rank, v FROM (SELECT *, lag(v) OVER (PARTITION BY target ORDER BY rank) AS b FROM r) WHERE v > b", (SPARSE,))
def q6(spark, d, sparse=edges_sparse):
    from pyspark.sql.window import Window

    p = sparse(spark, d).groupBy("target", "source").agg(r6(F.avg("confidence")).alias("v"))
    return va.order_breaks(p.withColumn("rank", F.row_number().over(Window.partitionBy("target").orderBy("source"))), "target", "rank", "v")


@query("q7_collection_summary", "SELECT source, count(*) AS papers, min(n_chars) AS shortest, max(n_chars) AS longest, count(CASE WHEN n_chars < 50 THEN 1 END) AS too_short FROM documents GROUP BY source")
def q7(spark, d):
    n = F.col("n_chars")
    return raw(spark, d, "documents").groupBy("source").agg(F.count("*").alias("papers"), F.min(n).alias("shortest"), F.max(n).alias("longest"), F.count_if(n < 50).alias("too_short"))


@query("r4_normalise_batch", ", b AS (SELECT DISTINCT source FROM sparse ORDER BY source LIMIT 25) SELECT b.source, c.canonical_name FROM b LEFT JOIN canonical c ON b.source = c.entity_name", (SPARSE, CANONICAL))
def r4(spark, d, sparse=edges_sparse):
    names = canonical(spark, d).select(F.col("entity_name").alias("source"), "canonical_name")
    return sparse(spark, d).select("source").distinct().orderBy("source").limit(25).join(names, "source", "left")


@query("r6_display_info", "SELECT canonical_name, min(entity_name) AS shown, count(*) - 1 AS alternatives FROM canonical GROUP BY canonical_name", (CANONICAL,))
def r6_display(spark, d):
    return canonical(spark, d).groupBy("canonical_name").agg(F.min("entity_name").alias("shown"), (F.count("*") - 1).alias("alternatives"))


@query("r8_review_flags", """SELECT mechanism, count(CASE WHEN confidence < 0.6 THEN 1 END) AS unsure, count(CASE WHEN outcome = 'inconclusive' THEN 1 END) AS open, count(CASE WHEN confidence < 0.6 AND outcome = 'inconclusive' THEN 1 END) AS both FROM edges GROUP BY mechanism""".replace(" AS both", ' AS "both"').replace(" AS open", ' AS "open"'), (EDGES,))
def r8(spark, d):
    flags = F.array_compact(F.array(F.when(F.col("confidence") < 0.6, "unsure"), F.when(F.col("outcome") == "inconclusive", "open")))
    e = edges(spark, d).withColumn("flags", flags)
    return e.groupBy("mechanism").agg(F.count_if(F.array_contains("flags", "unsure")).alias("unsure"), F.count_if(F.array_contains("flags", "open")).alias("open"), F.count_if(F.size("flags") == 2).alias("both"))


@query("r11_band_report", """, p AS (SELECT source, target, round(avg(confidence), 6) AS c FROM sparse GROUP BY ALL), b AS (SELECT *, CASE WHEN c > 0.75 THEN 'high' WHEN c >= 0.7 THEN 'middle' ELSE 'low' END AS band FROM p)
  SELECT band, count(*) AS n, array_to_string((list(source || ' ' || target ORDER BY c DESC, source, target))[1:3], ',') AS best FROM b GROUP BY band""", (SPARSE,))
def r11(spark, d, sparse=edges_sparse):
    """Bands with their three best members, at bounds that part the test tables' means."""
    p = sparse(spark, d).groupBy("source", "target").agg(r6(F.avg("confidence")).alias("c"))
    return va.band_report(p, F.concat_ws(" ", "source", "target"), 0.75, 0.7)


@query("c7_category_backfill", "SELECT DISTINCT entity_name AS entity, 'primary' AS category_type, category AS category_name FROM canonical WHERE category IS NOT NULL", (CANONICAL,))
def c7(spark, d):
    return canonical(spark, d).filter("category IS NOT NULL").select(F.col("entity_name").alias("entity"), F.lit("primary").alias("category_type"), F.col("category").alias("category_name")).distinct()


@query("c17_edge_ids", "SELECT source || '_' || target || '_' || study_id || '_improves_' || mechanism AS edge_id FROM sparse WHERE outcome = 'improves'", (SPARSE,))
def c17(spark, d, sparse=edges_sparse):
    return sparse(spark, d).filter("outcome = 'improves'").select(F.concat_ws("_", "source", "target", "study_id", "outcome", "mechanism").alias("edge_id"))


@query("c21_latest_answer", "SELECT user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1")
def c21(spark, d):
    e = raw(spark, d, "events")
    return e.groupBy("user_id", "event_type").agg(F.max_by("value", F.struct("ts", "event_id")).alias("value"))


@query("c39_threshold_comparison", ", p AS (SELECT source, target, avg(confidence) AS c FROM sparse GROUP BY ALL) SELECT t AS threshold, count(*) AS kept, count(DISTINCT source) AS sources FROM p, (VALUES (0.6::DOUBLE), (0.65::DOUBLE), (0.7::DOUBLE)) g(t) WHERE round(c, 6) >= t GROUP BY t", (SPARSE,))
def c39(spark, d, sparse=edges_sparse):
    p = sparse(spark, d).groupBy("source", "target").agg(r6(F.avg("confidence")).alias("c"))
    grid = F.explode(F.array(*[F.lit(x) for x in (0.6, 0.65, 0.7)])).alias("threshold")
    return p.select("source", "c", grid).filter("c >= threshold").groupBy("threshold").agg(F.count("*").alias("kept"), F.countDistinct("source").alias("sources"))


@query("k9_graph_statistics", ", p AS (SELECT source, target, count(*) AS n FROM sparse GROUP BY ALL) SELECT count(*) AS links, sum(n) AS studies, max(n) AS most FROM p", (SPARSE,))
def k9(spark, d, sparse=edges_sparse):
    return fold_pairs(sparse(spark, d)).agg(F.count("*").alias("links"), F.sum("edge_count").alias("studies"), F.max("edge_count").alias("most"))
