"""Graph queries (G rows)."""

from pyspark.sql import functions as F

from ..functions.labels import as_is
from ..operators import evidence as ev
from ..operators import graph as gr
from ..operators.components import weak_components
from ..sources.sinks import node_link
from ..sources.tables import canonical, edges, edges_sparse
from .aggregates import ADVICE, FOLD, POOLED
from .registry import CANONICAL, EDGES, SPARSE, WHOLE, query, r6

_PAIRS = f", p AS (SELECT source, target, {FOLD}, arg_max(study_id, (confidence, study_id)) AS strongest_study FROM edges GROUP BY ALL)"
_SHOWN = f"""source, target, edge_count, round(raw_score, 6) AS raw_score, round(avg_confidence, 6) AS avg_confidence, round(raw_score * avg_confidence, 6) AS aggregate_score,
  n_improves, n_worsens, n_no_effect, n_inconclusive, strongest_study, {ADVICE} AS recommendation"""
_LINKS = ", links AS (SELECT source, target, avg(confidence) AS weight FROM sparse WHERE outcome = 'improves' GROUP BY ALL UNION ALL SELECT target, source, 0.5::DOUBLE * avg(confidence) FROM sparse WHERE outcome = 'worsens' GROUP BY ALL)"


def links(spark, d, sparse=edges_sparse):
    """A directed graph that has cycles: improvements lead one way, harms the other."""
    e = sparse(spark, d)
    good = e.filter("outcome = 'improves'").groupBy("source", "target").agg(F.avg("confidence").alias("weight"))
    bad = e.filter("outcome = 'worsens'").groupBy(F.col("target").alias("source"), F.col("source").alias("target")).agg((0.5 * F.avg("confidence")).alias("weight"))
    return good.union(bad)


def _folded(rows):
    return ev.fold_pairs(rows, None).withColumns({c: r6(c) for c in ("raw_score", "avg_confidence", "aggregate_score")})


@query("g1_build_graph", "SELECT source, target, mechanism, outcome, count(*) AS n, round(sum(least(1.0, CASE WHEN confidence = 0 THEN 0.5 ELSE confidence END)), 6) AS total FROM pooled WHERE mechanism <> '' GROUP BY ALL", (EDGES, CANONICAL, POOLED))
def g1(spark, d):
    from ..functions.labels import default_confidence

    pooled = ev.pool(edges(spark, d).filter("mechanism <> ''"), canonical(spark, d))
    return pooled.groupBy("source", "target", "mechanism", "outcome").agg(F.count("*").alias("n"), r6(F.sum(default_confidence(F.col("confidence")))).alias("total"))


@query("g2_validated_evidence", "SELECT outcome IN ('improves', 'worsens', 'no_effect') AND confidence BETWEEN 0 AND 0.9 AS valid, count(*) AS n FROM edges GROUP BY 1", (EDGES,))
def g2(spark, d):
    ok = F.col("outcome").isin("improves", "worsens", "no_effect") & F.col("confidence").between(0, 0.9)
    return edges(spark, d).groupBy(ok.alias("valid")).agg(F.count("*").alias("n"))


@query("g3_treatments_for_condition", _PAIRS + f" SELECT {_SHOWN} FROM p WHERE target = 'Brand#11'", (EDGES,))
def g3(spark, d):
    return _folded(edges(spark, d, place=True).filter("target = 'Brand#11'")).orderBy(F.desc("aggregate_score"), "source")


@query("g4_conditions_for_intervention", _PAIRS + f" SELECT {_SHOWN} FROM p WHERE source = 'Supplier#000000007'", (EDGES,))
def g4(spark, d):
    return _folded(edges(spark, d).filter("source = 'Supplier#000000007'")).orderBy(F.desc("aggregate_score"), "target")


_MECH = FOLD.replace("sum(weight * confidence) / count(*) AS raw_score", "round(sum(weight * confidence) / count(*), 6) AS aggregate_score").replace("avg(confidence) AS", "round(avg(confidence), 6) AS")


def _mechanisms(rows, keys, distinct=None):
    return ev.fold_mechanisms(rows, keys, distinct).withColumns({c: r6(c) for c in ("aggregate_score", "avg_confidence")})


@query("g5_mechanisms_for_pair", f"SELECT mechanism, source, target, {_MECH} FROM edges WHERE source = 'Supplier#000000007' AND target = 'Brand#11' GROUP BY ALL", (EDGES,))
def g5_pair(spark, d):
    return _mechanisms(edges(spark, d).filter("source = 'Supplier#000000007' AND target = 'Brand#11'"), ["mechanism", "source", "target"])


@query("g5_interventions_by_mechanism", f"SELECT mechanism, source, target, {_MECH} FROM edges WHERE mechanism = 'ECONOMY' AND confidence >= 0.6 GROUP BY ALL", (EDGES,))
def g5_by(spark, d):
    return _mechanisms(edges(spark, d).filter("mechanism = 'ECONOMY' AND confidence >= 0.6"), ["mechanism", "source", "target"])


@query("g5_mechanisms_for_condition", f"SELECT mechanism, target, {_MECH}, count(DISTINCT source) AS source_count, string_agg(DISTINCT source, ',' ORDER BY source) AS sources FROM edges WHERE target = 'Brand#11' GROUP BY ALL", (EDGES,))
def g5_condition(spark, d):
    return _mechanisms(edges(spark, d).filter("target = 'Brand#11'"), ["mechanism", "target"], "source")


@query("g5_mechanisms_for_intervention", f"SELECT mechanism, source, {_MECH}, count(DISTINCT target) AS target_count, string_agg(DISTINCT target, ',' ORDER BY target) AS targets FROM edges WHERE source = 'Supplier#000000007' GROUP BY ALL", (EDGES,))
def g5_intervention(spark, d):
    return _mechanisms(edges(spark, d).filter("source = 'Supplier#000000007'"), ["mechanism", "source"], "target")


@query("g7_node_lists", "SELECT DISTINCT source AS node, 'intervention' AS type FROM sparse UNION ALL SELECT DISTINCT target, 'condition' FROM sparse", (SPARSE,))
def g7(spark, d, sparse=edges_sparse):
    e = sparse(spark, d)
    return e.select(F.col("source").alias("node"), F.lit("intervention").alias("type")).distinct().union(e.select("target", F.lit("condition")).distinct())


@query("g8_canonical_lookup", "SELECT DISTINCT e.source, c.canonical_name FROM sparse e LEFT JOIN canonical c ON e.source = c.entity_name", (SPARSE, CANONICAL))
def g8(spark, d, sparse=edges_sparse):
    names = canonical(spark, d).select(F.col("entity_name").alias("source"), "canonical_name")
    return sparse(spark, d).select("source").distinct().join(names, "source", "left")


@query("g9_neighbours", _LINKS + " SELECT DISTINCT target AS neighbour, 'out' AS side FROM links WHERE source = 'Brand#11' UNION SELECT DISTINCT source, 'in' FROM links WHERE target = 'Brand#11' AND source <> 'Brand#11'", (SPARSE,))
def g9(spark, d, sparse=edges_sparse):
    return gr.neighbours(links(spark, d, sparse), "Brand#11")


@query("g10_simple_paths", "WITH" + SPARSE + _LINKS + """, s AS (SELECT * FROM links WHERE weight >= 0.35),
  p1 AS (SELECT [source, target] AS path, weight AS total FROM s WHERE source = 'Brand#11'),
  p2 AS (SELECT list_append(path, target) AS path, total + weight AS total FROM p1 JOIN s ON path[-1] = s.source WHERE path[-1] <> 'Brand#12' AND NOT list_contains(path, target)),
  p3 AS (SELECT list_append(path, target) AS path, total + weight AS total FROM p2 JOIN s ON path[-1] = s.source WHERE path[-1] <> 'Brand#12' AND NOT list_contains(path, target))
  SELECT array_to_string(path, '>') AS path, len(path) - 1 AS steps, round(total, 6) AS total, len(path) = 2 AS direct FROM (SELECT * FROM p1 UNION ALL SELECT * FROM p2 UNION ALL SELECT * FROM p3) WHERE path[-1] = 'Brand#12'""")
def g10(spark, d, sparse=edges_sparse):
    e = sparse(spark, d, place=True)
    of = [("improves", e, 1.0), ("worsens", e.withColumns({"source": F.col("target"), "target": F.col("source")}), 0.5)]
    kinds = []
    for outcome, rows, share in of:
        rows = rows.filter(F.col("outcome") == outcome)
        means = rows.groupBy("source", "target").agg(F.avg("confidence").alias("mean"))
        means = ev.in_table_order(rows, means, ["source", "target"], {"mean": (F.col("confidence"), F.count("confidence"))}, ev.near(share * F.col("mean"), 0.35))
        kinds.append(means.select("source", "target", (share * F.col("mean")).alias("weight")))
    return gr.simple_paths(kinds[0].union(kinds[1]), "Brand#11", "Brand#12", 3, 0.35, as_is).withColumn("total", r6("total"))


@query("g11_weak_components", "WITH RECURSIVE" + WHOLE + """, l AS (SELECT source AS a, target AS b FROM sparse UNION SELECT target, source FROM sparse),
  w(n, r) AS (SELECT DISTINCT a, a FROM l UNION SELECT l.b, w.r FROM w JOIN l ON w.n = l.a) SELECT n AS node, min(r) AS component FROM w GROUP BY n""")
def g11(spark, d):
    return weak_components(edges(spark, d).select("source", "target"), "source", "target")


@query("g12_local_clustering", _LINKS + """, n AS (SELECT DISTINCT source, target FROM links WHERE source <> target), k AS (SELECT source, count(*) AS k FROM n GROUP BY source),
  t AS (SELECT a.source, count(*) AS c FROM n a JOIN links l ON a.target = l.source JOIN n b ON b.source = a.source AND b.target = l.target WHERE a.target <> l.target GROUP BY a.source)
  SELECT k.source AS node, k.k, round(CASE WHEN k.k < 2 THEN 0 ELSE coalesce(t.c, 0) / CAST(k.k * (k.k - 1) AS DOUBLE) END, 6) AS coefficient FROM k LEFT JOIN t ON k.source = t.source""", (SPARSE,))
def g12(spark, d, sparse=edges_sparse):
    return gr.clustering(links(spark, d, sparse)).withColumn("coefficient", r6("coefficient"))


@query("g13_node_summary", """SELECT target AS node, count(*) AS studies, count(DISTINCT source) AS partners, count(DISTINCT mechanism) AS mechanisms, round(avg(confidence), 6) AS mean, min(year) AS first, max(year) AS last FROM edges GROUP BY target""", (EDGES,))
def g13(spark, d):
    return edges(spark, d).groupBy(F.col("target").alias("node")).agg(F.count("*").alias("studies"), F.countDistinct("source").alias("partners"), F.countDistinct("mechanism").alias("mechanisms"), r6(F.avg("confidence")).alias("mean"), F.min("year").alias("first"), F.max("year").alias("last"))


@query("g14_node_link_export", ", p AS (SELECT source, target FROM sparse GROUP BY ALL) SELECT count(*) + (SELECT count(DISTINCT target) FROM p) AS nodes, (SELECT count(*) FROM p) AS links FROM (SELECT DISTINCT source FROM p)", (SPARSE,))
def g14(spark, d, sparse=edges_sparse):
    return node_link(ev.fold_pairs(sparse(spark, d))).select(F.size("nodes").cast("bigint").alias("nodes"), F.size("links").cast("bigint").alias("links"))
