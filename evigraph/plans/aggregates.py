"""Aggregations (A rows)."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import evidence as ev
from ..operators import graph
from ..operators.quantiles import quantiles
from ..sources.tables import canonical, edges, edges_sparse, papers, raw
from .registry import CANONICAL, EDGES, PAPERS, SPARSE, query, r6

FOLD = """count(*) AS edge_count, sum(weight * confidence) / count(*) AS raw_score, avg(confidence) AS avg_confidence,
  count(CASE WHEN outcome = 'improves' THEN 1 END) AS n_improves, count(CASE WHEN outcome = 'worsens' THEN 1 END) AS n_worsens,
  count(CASE WHEN outcome = 'no_effect' THEN 1 END) AS n_no_effect, count(CASE WHEN outcome = 'inconclusive' THEN 1 END) AS n_inconclusive"""
ADVICE = """CASE WHEN raw_score * avg_confidence > 0.5 AND avg_confidence > 0.7 AND edge_count >= 3 THEN 'Strongly recommended - robust positive evidence'
  WHEN raw_score * avg_confidence > 0.3 AND avg_confidence > 0.5 THEN 'Recommended - moderate positive evidence'
  WHEN raw_score * avg_confidence < -0.3 THEN 'Not recommended - evidence suggests ineffective'
  WHEN edge_count < 2 THEN 'Insufficient evidence - more research needed' ELSE 'Neutral - mixed or weak evidence' END"""


@query("a1_scalar_counts", "SELECT count(*) AS edges, count(DISTINCT source) AS sources, count(DISTINCT target) AS targets, count(DISTINCT paper_id) AS papers FROM edges", (EDGES,))
def a1(spark, d):
    return edges(spark, d).agg(F.count("*").alias("edges"), *[F.countDistinct(c).alias(n) for c, n in (("source", "sources"), ("target", "targets"), ("paper_id", "papers"))])


@query("a2_group_counts", "SELECT journal, processing_status, count(*) AS n FROM papers GROUP BY ALL ORDER BY n DESC, journal, processing_status LIMIT 10", (PAPERS,))
def a2(spark, d):
    return papers(spark, d).groupBy("journal", "processing_status").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "journal", "processing_status").limit(10)


@query("a3_conditional_counts", "SELECT count(CASE WHEN outcome ILIKE '%IMPRO%' THEN 1 END) AS good, sum(CASE WHEN confidence >= 0.9 THEN 1 ELSE 0 END) AS sure FROM edges", (EDGES,))
def a3(spark, d):
    return edges(spark, d).agg(F.count_if(F.ilike("outcome", F.lit("%IMPRO%"))).alias("good"), F.sum(F.when(F.col("confidence") >= 0.9, 1).otherwise(0)).alias("sure"))


@query("a4_conditional_distinct", "SELECT count(DISTINCT CASE WHEN outcome = 'improves' THEN source END) AS improving, count(DISTINCT CASE WHEN confidence > 0.95 THEN paper_id END) AS sure_papers FROM sparse", (SPARSE,))
def a4(spark, d, sparse=edges_sparse):
    return sparse(spark, d).agg(F.countDistinct(F.when(F.col("outcome") == "improves", F.col("source"))).alias("improving"), F.countDistinct(F.when(F.col("confidence") > 0.95, F.col("paper_id"))).alias("sure_papers"))


@query("a5_distinct_pairs", "SELECT count(DISTINCT source || '|' || target) AS pairs FROM sparse", (SPARSE,))
def a5(spark, d, sparse=edges_sparse):
    return sparse(spark, d).agg(F.countDistinct("source", "target").alias("pairs"))


@query("a6_coalesced_key", """SELECT coalesce(c.canonical_name, e.source) AS name, count(*) AS n, count(DISTINCT paper_id) AS papers FROM edges e
  LEFT JOIN canonical c ON e.source = c.entity_name AND c.category <> 'ASIA' GROUP BY 1 ORDER BY n DESC, name LIMIT 10""", (EDGES, CANONICAL))
def a6(spark, d):
    c = canonical(spark, d).filter("category <> 'ASIA'").select(F.col("entity_name").alias("source"), "canonical_name")
    named = edges(spark, d).join(c, "source", "left").withColumn("name", F.coalesce("canonical_name", "source"))
    return named.groupBy("name").agg(F.count("*").alias("n"), F.countDistinct("paper_id").alias("papers")).orderBy(F.desc("n"), "name").limit(10)


@query("a7_having", "SELECT source, target, count(*) AS n FROM edges GROUP BY ALL HAVING count(*) > 30", (EDGES,))
def a7(spark, d):
    return edges(spark, d).groupBy("source", "target").agg(F.count("*").alias("n")).filter("n > 30")


@query("a8_string_aggregate", "SELECT canonical_name, string_agg(DISTINCT entity_name, ',' ORDER BY entity_name) AS members FROM canonical GROUP BY canonical_name", (CANONICAL,))
def a8(spark, d):
    canonical(spark, d).createOrReplaceTempView("a8_names")
    return spark.sql("SELECT canonical_name, listagg(DISTINCT entity_name, ',') WITHIN GROUP (ORDER BY entity_name) AS members FROM a8_names GROUP BY canonical_name")


@query("a9_date_range", "SELECT min(publication_date) AS first, max(publication_date) AS last, round(avg(citation_count), 6) AS citations FROM papers", (PAPERS,))
def a9(spark, d):
    return papers(spark, d).agg(F.min("publication_date").alias("first"), F.max("publication_date").alias("last"), r6(F.avg("citation_count")).alias("citations"))


@query("a10_named_row", "SELECT source, arg_max(study_id, (confidence, study_id)) AS study_id, max(confidence) AS confidence, count(*) AS n FROM edges GROUP BY source", (EDGES,))
def a10(spark, d):
    return edges(spark, d).groupBy("source").agg(F.max_by("study_id", F.struct("confidence", "study_id")).alias("study_id"), F.max("confidence").alias("confidence"), F.count("*").alias("n"))


@query("a11_pair_evidence", f""", p AS (SELECT source, target, {FOLD}, arg_max(study_id, (confidence, study_id)) AS strongest_study FROM edges GROUP BY ALL)
  SELECT source, target, edge_count, round(raw_score, 6) AS raw_score, round(avg_confidence, 6) AS avg_confidence, round(raw_score * avg_confidence, 6) AS aggregate_score,
  n_improves, n_worsens, n_no_effect, n_inconclusive, strongest_study, {ADVICE} AS recommendation FROM p""", (EDGES,))
def a11(spark, d):
    out = ev.fold_pairs(edges(spark, d, place=True), None)
    return out.withColumns({c: r6(c) for c in ("raw_score", "avg_confidence", "aggregate_score")})


@query("a12_mechanism_evidence", f"""SELECT mechanism, {FOLD.replace('sum(weight * confidence) / count(*) AS raw_score', 'round(sum(weight * confidence) / count(*), 6) AS aggregate_score').replace('avg(confidence) AS', 'round(avg(confidence), 6) AS')},
  count(DISTINCT source) AS source_count, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM edges GROUP BY mechanism""", (EDGES,))
def a12(spark, d):
    out = ev.fold_mechanisms(edges(spark, d), ["mechanism"], "source")
    return out.withColumns({c: r6(c) for c in ("aggregate_score", "avg_confidence")})


_COUNTS = "count(CASE WHEN outcome = 'improves' THEN 1 END) AS pos, count(CASE WHEN outcome = 'worsens' THEN 1 END) AS neg"


@query("a13_outcome_counts", f"SELECT source, target, {_COUNTS}, count(CASE WHEN outcome = 'no_effect' THEN 1 END) AS neutral FROM edges GROUP BY ALL", (EDGES,))
def a13(spark, d):
    return ev.outcome_counts(edges(spark, d), ["source", "target"])


@query("a13_table_counts", f"SELECT source, target, {_COUNTS}, count(CASE WHEN outcome IN ('no_effect', 'inconclusive') THEN 1 END) AS neutral FROM edges GROUP BY ALL", (EDGES,))
def a13_table(spark, d):
    return ev.outcome_counts(edges(spark, d), ["source", "target"], inconclusive_is_neutral=True)


POOLED = """
pooled AS (SELECT e.* EXCLUDE (source, target), coalesce(i.canonical_name, e.source) AS source, coalesce(c.canonical_name, e.target) AS target FROM edges e
  LEFT JOIN canonical i ON e.source = i.entity_name AND i.entity_type = 'intervention' LEFT JOIN canonical c ON e.target = c.entity_name AND c.entity_type = 'condition')"""


@query("a14_pooled_counts", f"SELECT source, target, {_COUNTS}, count(CASE WHEN outcome = 'no_effect' THEN 1 END) AS neutral FROM pooled GROUP BY ALL", (EDGES, CANONICAL, POOLED))
def a14(spark, d):
    return ev.outcome_counts(ev.pool(edges(spark, d), canonical(spark, d)), ["source", "target"])


@query("a15_graph_statistics", """SELECT count(DISTINCT source) AS n_sources, count(DISTINCT target) AS n_targets, count(DISTINCT mechanism) AS n_mechanisms, count(*) AS n_edges,
  count(*) / CAST(count(DISTINCT source) + count(DISTINCT target) AS DOUBLE) AS edges_per_node FROM edges""", (EDGES,))
def a15(spark, d):
    return ev.graph_statistics(edges(spark, d))


@query("a16_failure_profile", """SELECT source, count(*) AS total, count(CASE WHEN outcome = 'worsens' THEN 1 END) AS negative, count(CASE WHEN outcome IN ('no_effect', 'inconclusive') THEN 1 END) AS neutral,
  count(CASE WHEN outcome = 'improves' THEN 1 END) AS positive, round(avg(confidence), 6) AS mean_confidence, count(DISTINCT CASE WHEN outcome = 'worsens' THEN target END) AS failed_conditions FROM edges GROUP BY source""", (EDGES,))
def a16(spark, d):
    o = F.col("outcome")
    return edges(spark, d).groupBy("source").agg(
        F.count("*").alias("total"), F.count_if(o == "worsens").alias("negative"), F.count_if(o.isin("no_effect", "inconclusive")).alias("neutral"), F.count_if(o == "improves").alias("positive"),
        r6(F.avg("confidence")).alias("mean_confidence"), F.countDistinct(F.when(o == "worsens", F.col("target"))).alias("failed_conditions"),
    )


@query("a17_track_record", """, c AS (SELECT source, target, avg(weight * confidence) AS m FROM sparse GROUP BY ALL)
  SELECT source, round(greatest(0, least(1, avg(m) + least(0.3, count(*) / 10.0))), 6) AS track_record FROM c GROUP BY source""", (SPARSE,))
def a17(spark, d, sparse=edges_sparse):
    return track_record(sparse(spark, d)).withColumn("track_record", r6("track_record"))


def track_record(e):
    """Mean over conditions of mean effectiveness, plus a bonus for breadth, held to 0 to 1."""
    per = e.groupBy("source", "target").agg(F.avg(F.col("weight") * F.col("confidence")).alias("m"))
    score = F.avg("m") + F.least(F.lit(0.3), F.count("*") / 10.0)
    return per.groupBy("source").agg(F.greatest(F.lit(0.0), F.least(F.lit(1.0), score)).alias("track_record"))


@query("a18_fundamental_scores", """, p AS (SELECT source, target, round(sum(weight * confidence) / count(*) * avg(confidence), 3) AS s FROM sparse GROUP BY ALL)
  SELECT source, count(CASE WHEN s > 0 THEN 1 END) AS positive_conditions, count(*) AS total_conditions, round(sum(CASE WHEN s > 0 THEN s ELSE 0 END), 6) AS breadth_score,
  round(sum(CASE WHEN s > 0 THEN s ELSE 0 END) / count(CASE WHEN s > 0 THEN 1 END), 6) AS avg_effectiveness FROM p GROUP BY source HAVING count(CASE WHEN s > 0 THEN 1 END) >= 3""", (SPARSE,))
def a18(spark, d, sparse=edges_sparse):
    return ev.fundamental(sparse(spark, d)).withColumns({c: r6(c) for c in ("breadth_score", "avg_effectiveness")})


@query("a19_mode_with_tie_break", """, n AS (SELECT target, mechanism, count(*) AS n, max(confidence) AS c FROM sparse GROUP BY ALL)
  SELECT target, mechanism FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY n DESC, c DESC, mechanism) AS r FROM n) WHERE r = 1""", (SPARSE,))
def a19(spark, d, sparse=edges_sparse):
    n = sparse(spark, d).groupBy("target", "mechanism").agg(F.count("*").alias("n"), F.max("confidence").alias("c"))
    w = Window.partitionBy("target").orderBy(F.desc("n"), F.desc("c"), "mechanism")
    return n.withColumn("r", F.row_number().over(w)).filter("r = 1").select("target", "mechanism")


@query("a20_category_of_members", """, m AS (SELECT e.target, c.category, row_number() OVER (PARTITION BY e.target ORDER BY e.source) AS r FROM (SELECT DISTINCT source, target FROM sparse) e JOIN canonical c ON e.source = c.entity_name),
  n AS (SELECT target, category, count(*) AS n FROM m WHERE r <= 10 GROUP BY ALL) SELECT target, category FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY n DESC, category) AS k FROM n) WHERE k = 1""", (SPARSE, CANONICAL))
def a20(spark, d, sparse=edges_sparse):
    names = canonical(spark, d).select(F.col("entity_name").alias("source"), "category")
    ten = sparse(spark, d).select("source", "target").distinct().join(names, "source").withColumn("r", F.row_number().over(Window.partitionBy("target").orderBy("source"))).filter("r <= 10")
    n = ten.groupBy("target", "category").agg(F.count("*").alias("n"))
    return n.withColumn("k", F.row_number().over(Window.partitionBy("target").orderBy(F.desc("n"), "category"))).filter("k = 1").select("target", "category")


@query("a21_duplicate_merge", """SELECT paper_id, target, outcome, arg_max(study_id, (confidence, study_id)) AS base, string_agg(DISTINCT study_design, '; ' ORDER BY study_design) AS models,
  round(CASE WHEN count(*) > 1 THEN least(0.98, avg(confidence) + 0.12) ELSE avg(confidence) END, 6) AS confidence, count(*) AS n FROM edges GROUP BY paper_id, target, outcome""", (EDGES,))
def a21(spark, d):
    merged = F.when(F.count("*") > 1, F.least(F.lit(0.98), F.avg("confidence") + 0.12)).otherwise(F.avg("confidence"))
    return edges(spark, d, design=True).groupBy("paper_id", "target", "outcome").agg(F.max_by("study_id", F.struct("confidence", "study_id")).alias("base"), F.array_join(F.array_sort(F.collect_set("study_design")), "; ").alias("models"), r6(merged).alias("confidence"), F.count("*").alias("n"))


@query("a22_cross_paper_consensus", """, g AS (SELECT source, target, outcome, count(DISTINCT paper_id) AS papers, count(*) AS studies, avg(confidence) AS mean, var_pop(confidence) AS v, arg_max(study_id, (confidence, study_id)) AS base_study FROM edges GROUP BY ALL)
  SELECT source, target, outcome, papers, studies, base_study, round(mean, 6) AS mean, round(greatest(0, 1 - v * 4), 6) AS consistency,
  round(least(0.98, mean + least(0.2, 0.05 * (papers - 1)) * greatest(0, 1 - v * 4)), 6) AS confidence FROM g""", (EDGES,))
def a22(spark, d):
    out = ev.consensus(edges(spark, d), ["source", "target"])
    return out.drop("variance").withColumns({c: r6(c) for c in ("mean", "consistency", "confidence")})


@query("a23_parallel_edges", """SELECT source, target, round(sum(confidence * sample_size) / sum(sample_size), 6) AS weighted_mean, max(confidence) AS greatest, least(1.0, round(sum(confidence), 6)) AS capped_sum,
  round(count(*) / sum(1 / confidence), 6) AS harmonic FROM edges GROUP BY ALL""", (EDGES,))
def a23(spark, d):
    out = ev.merge_parallel(edges(spark, d), ["source", "target"])
    return out.withColumns({c: r6(c) for c in ("weighted_mean", "capped_sum", "harmonic")})


@query("a24_type_blend", """, t AS (SELECT source, target, mechanism, avg(confidence) AS c FROM sparse GROUP BY ALL)
  SELECT source, target, round(sum(c * CASE WHEN mechanism LIKE 'S%' THEN 1.0 ELSE 0.5 END) / sum(CASE WHEN mechanism LIKE 'S%' THEN 1.0 ELSE 0.5 END), 6) AS blended FROM t GROUP BY ALL""", (SPARSE,))
def a24(spark, d, sparse=edges_sparse):
    w = F.when(F.col("mechanism").like("S%"), 1.0).otherwise(0.5)
    t = sparse(spark, d).groupBy("source", "target", "mechanism").agg(F.avg("confidence").alias("c"))
    return t.groupBy("source", "target").agg(r6(F.sum(F.col("c") * w) / F.sum(w)).alias("blended"))


@query("a25_summary_statistics", """SELECT mechanism, min(confidence) AS low, max(confidence) AS high, round(avg(confidence), 6) AS mean, round(quantile_cont(confidence, 0.5), 6) AS median,
  round(stddev_pop(confidence), 6) AS std, round(100.0 * count(CASE WHEN confidence > 0.7 THEN 1 END) / count(*), 6) AS above FROM edges GROUP BY mechanism""", (EDGES,))
def a25(spark, d):
    c, e = F.col("confidence"), edges(spark, d)
    middle = quantiles(e, ["mechanism"], "confidence", [0.5]).select("mechanism", r6("x").alias("median"))
    return middle.join(e.groupBy("mechanism").agg(F.min(c).alias("low"), F.max(c).alias("high"), r6(F.avg(c)).alias("mean"), r6(F.stddev_pop(c)).alias("std"), r6(100.0 * F.count_if(c > 0.7) / F.count("*")).alias("above")), "mechanism")


@query("a26_classification_report", """, x AS (SELECT CAST(quality AS VARCHAR) AS truth, CASE WHEN n_chars > 200 THEN '1' ELSE '0' END AS guess FROM labels JOIN documents USING (doc_id)),
  k AS (SELECT truth AS label FROM x UNION SELECT guess FROM x), c AS (SELECT k.label, count(CASE WHEN x.truth = k.label AND x.guess = k.label THEN 1 END) AS tp, count(CASE WHEN x.truth <> k.label AND x.guess = k.label THEN 1 END) AS fp,
  count(CASE WHEN x.truth = k.label AND x.guess <> k.label THEN 1 END) AS fn FROM k, x GROUP BY k.label)
  SELECT label, tp, fp, fn, round(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / CAST(tp + fp AS DOUBLE) END, 6) AS precision, round(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / CAST(tp + fn AS DOUBLE) END, 6) AS recall,
  round(CASE WHEN 2 * tp + fp + fn = 0 THEN 0 ELSE 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) END, 6) AS f1 FROM c""".replace(", x AS", "WITH x AS", 1))
def a26(spark, d):
    rows = raw(spark, d, "labels").join(raw(spark, d, "documents").select("doc_id", "n_chars"), "doc_id")
    return classification_report(rows.select(F.col("quality").cast("string").alias("truth"), F.when(F.col("n_chars") > 200, "1").otherwise("0").alias("guess")))


def classification_report(rows):
    """Counts and ratios for each class, from the confusion matrix: one pass over the rows."""
    cells = rows.groupBy("truth", "guess").agg(F.count("*").alias("n"))
    right = F.when(F.col("truth") == F.col("guess"), F.col("n")).otherwise(0)
    wrong = F.col("n") - right
    as_guess = cells.select(F.col("guess").alias("label"), right.alias("tp"), wrong.alias("fp"), F.lit(0).alias("fn"))
    as_truth = cells.select(F.col("truth").alias("label"), F.lit(0).alias("tp"), F.lit(0).alias("fp"), wrong.alias("fn"))
    t = as_guess.union(as_truth).groupBy("label").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    share = lambda a, b: r6(F.when(b == 0, 0.0).otherwise(a / b))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return t.withColumns({"precision": share(tp, tp + fp), "recall": share(tp, tp + fn), "f1": share(2 * tp, 2 * tp + fp + fn)})


@query("a27_group_checks", """, g AS (SELECT canonical_name, count(*) AS members, count(DISTINCT category) AS categories FROM canonical GROUP BY canonical_name)
  SELECT count(*) AS groups, sum(members) AS members, round(count(CASE WHEN categories > 1 THEN 1 END) / CAST(count(*) AS DOUBLE), 6) AS mixed, count(CASE WHEN categories > 1 THEN 1 END) < 0.1 * count(*) AS pure FROM g""", (CANONICAL,))
def a27(spark, d):
    g = canonical(spark, d).groupBy("canonical_name").agg(F.count("*").alias("members"), F.countDistinct("category").alias("categories"))
    mixed = F.count_if(F.col("categories") > 1)
    return g.agg(F.count("*").alias("groups"), F.sum("members").alias("members"), r6(mixed / F.count("*")).alias("mixed"), (mixed < 0.1 * F.count("*")).alias("pure"))


@query("a28_degrees", "SELECT node, count(*) AS degree, round(sum(c), 6) AS weighted_degree FROM (SELECT source AS node, confidence AS c FROM edges UNION ALL SELECT target, confidence FROM edges) GROUP BY node", (EDGES,))
def a28(spark, d):
    e = edges(spark, d).select("source", "target", F.col("confidence").alias("weight"))
    return graph.degrees(e).withColumn("weighted_degree", r6("weighted_degree"))


@query("a29_keywords", """, w AS (SELECT unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) AS word FROM documents)
  SELECT word, count(*) AS n FROM w WHERE word NOT IN ('with', 'that', 'this', 'from') GROUP BY word ORDER BY n DESC, word LIMIT 20""".replace(", w AS", "WITH w AS", 1))
def a29(spark, d):
    words = raw(spark, d, "documents").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]{4,})"), 1)).alias("word"))
    return words.filter(~F.col("word").isin("with", "that", "this", "from")).groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").limit(20)
