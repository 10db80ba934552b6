"""Joins (J rows) and set operations (U rows)."""

from pyspark.sql import functions as F

from ..operators import mining as mn
from ..operators.clusters import ancestor_depth
from ..operators.cooccurrence import shared_keys
from ..sources.tables import canonical, edges, edges_sparse, papers, raw
from .registry import CANONICAL, EDGES, PAPERS, SPARSE, query, r6


@query("j1_fact_papers", "SELECT study_id, journal FROM edges JOIN papers ON paper_id = pmid WHERE confidence > 0.95", (EDGES, PAPERS))
def j1(spark, d):
    return edges(spark, d).filter("confidence > 0.95").join(papers(spark, d), F.col("paper_id") == F.col("pmid")).select("study_id", "journal")


@query("j2_left_chain", """, m AS (SELECT DISTINCT p_type AS mechanism, p_type[1] AS membership FROM part WHERE p_type[1] <> 'S'), c AS (SELECT DISTINCT p_type[1] AS membership, 'cluster ' || p_type[1] AS cluster FROM part WHERE p_type[1] <> 'L')
  SELECT study_id, m.membership, cluster FROM edges LEFT JOIN m ON edges.mechanism = m.mechanism LEFT JOIN c ON m.membership = c.membership""", (EDGES,))
def j2(spark, d):
    types = raw(spark, d, "part").select(F.col("p_type").alias("mechanism"), F.substring("p_type", 1, 1).alias("membership")).distinct()
    clusters = types.filter("membership <> 'L'").select("membership", F.concat(F.lit("cluster "), "membership").alias("cluster")).distinct()
    return edges(spark, d).select("study_id", "mechanism").join(types.filter("membership <> 'S'"), "mechanism", "left").join(clusters, "membership", "left").select("study_id", "membership", "cluster")


@query("j3_left_star", """, s AS (SELECT source, target, count(*) AS n FROM sparse GROUP BY ALL)
  SELECT e.study_id, p.journal, i.canonical_name AS intervention, c.canonical_name AS condition, s.n FROM edges e LEFT JOIN papers p ON e.paper_id = p.pmid
  LEFT JOIN canonical i ON e.source = i.entity_name AND i.entity_type = 'intervention' LEFT JOIN canonical c ON e.target = c.entity_name AND c.entity_type = 'condition'
  LEFT JOIN s ON e.source = s.source AND e.target = s.target""", (SPARSE, PAPERS, CANONICAL))
def j3(spark, d, sparse=edges_sparse):
    e, names = edges(spark, d).select("study_id", "paper_id", "source", "target"), canonical(spark, d)
    scores = sparse(spark, d).groupBy("source", "target").agg(F.count("*").alias("n"))
    kind = lambda t, end, out: names.filter(F.col("entity_type") == t).select(F.col("entity_name").alias(end), F.col("canonical_name").alias(out))
    out = e.join(papers(spark, d).select(F.col("pmid").alias("paper_id"), "journal"), "paper_id", "left")
    out = out.join(kind("intervention", "source", "intervention"), "source", "left").join(kind("condition", "target", "condition"), "target", "left")
    return out.join(scores, ["source", "target"], "left").select("study_id", "journal", "intervention", "condition", "n")


@query("j4_json_path_join", """SELECT e.event_type, count(c.c_custkey) AS n, round(avg(c.c_acctbal), 6) AS balance FROM events e
  LEFT JOIN customer c ON TRY_CAST(json_extract_string(e.props, '$.k') AS BIGINT) = c.c_custkey GROUP BY e.event_type""")
def j4(spark, d):
    c = raw(spark, d, "customer").select("c_custkey", "c_acctbal")
    e = raw(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").try_cast("bigint"))
    return e.join(c, F.col("k") == F.col("c_custkey"), "left").groupBy("event_type").agg(F.count("c_custkey").alias("n"), F.round(F.avg("c_acctbal"), 6).alias("balance"))


@query("j5_left_or_filter", "SELECT p.pmid, a.l_linenumber FROM papers p LEFT JOIN (SELECT * FROM lineitem WHERE l_linenumber > 3) a ON p.pmid = a.l_orderkey WHERE p.citation_count > 90 OR a.l_linenumber = 7", (PAPERS,))
def j5(spark, d):
    lines = raw(spark, d, "lineitem").filter("l_linenumber > 3").select(F.col("l_orderkey").alias("pmid"), "l_linenumber")
    return papers(spark, d).join(lines, "pmid", "left").filter("citation_count > 90 OR l_linenumber = 7").select("pmid", "l_linenumber")


@query("j6_semi_join", "SELECT s_name FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_discount >= 0.1 AND l_quantity = 50)")
def j6(spark, d):
    lines = raw(spark, d, "lineitem").filter("l_discount >= 0.1 AND l_quantity = 50").select(F.col("l_suppkey").alias("s_suppkey"))
    return raw(spark, d, "supplier").join(lines, "s_suppkey", "left_semi").select("s_name")


@query("j7_not_in", "SELECT entity_name FROM canonical WHERE entity_type = 'intervention' AND entity_name NOT IN (SELECT source FROM sparse WHERE target = 'Brand#11' AND outcome = 'worsens')", (SPARSE, CANONICAL))
def j7(spark, d, sparse=edges_sparse):
    used = sparse(spark, d).filter("target = 'Brand#11' AND outcome = 'worsens'").select(F.col("source").alias("entity_name"))
    return canonical(spark, d).filter("entity_type = 'intervention'").select("entity_name").join(used, "entity_name", "left_anti")


@query("j8_left_is_null", "SELECT c_custkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'P' WHERE o_orderkey IS NULL")
def j8(spark, d):
    return raw(spark, d, "customer").join(raw(spark, d, "orders").filter("o_orderstatus = 'P'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


_TREE = "tree AS (SELECT vec_id AS id, CASE WHEN vec_id % 9 = 0 THEN NULL WHEN vec_id % 13 = 0 THEN vec_id + 1000000 ELSE vec_id // 2 END AS parent, CAST(floor(log2(vec_id + 1)) AS INT) AS level FROM embeddings)"


def tree(spark, d):
    """A hierarchy with some missing parents, over vector ids."""
    parent = F.when(F.col("vec_id") % 9 == 0, F.lit(None)).when(F.col("vec_id") % 13 == 0, F.col("vec_id") + 1000000).otherwise(F.floor(F.col("vec_id") / 2))
    return raw(spark, d, "embeddings").select(F.col("vec_id").alias("id"), parent.cast("bigint").alias("parent"), F.floor(F.log2(F.col("vec_id") + 1)).cast("int").alias("level"))


@query("j9_orphan_parents", "SELECT t.id, t.parent FROM tree t WHERE t.parent IS NOT NULL AND NOT EXISTS (SELECT 1 FROM tree p WHERE p.id = t.parent)", (_TREE,))
def j9(spark, d):
    t = tree(spark, d)
    return t.filter("parent IS NOT NULL").join(t.select(F.col("id").alias("parent")), "parent", "left_anti").select("id", "parent")


@query("j10_level_order", "SELECT c.id, c.level, p.level AS parent_level FROM tree c JOIN tree p ON c.parent = p.id AND c.level <= p.level + 0", (_TREE,))
def j10(spark, d):
    t = tree(spark, d)
    up = t.select(F.col("id").alias("parent"), F.col("level").alias("parent_level"))
    return t.join(up, "parent").filter("level <= parent_level").select("id", "level", "parent_level")


@query("j11_normalised_key", "SELECT c_custkey, e.n FROM customer JOIN (SELECT lower(trim('  ' || n_name || ' ')) AS k, n_nationkey, length(n_name) AS n FROM nation) e ON lower(trim('Nation_' || c_nationkey)) = e.k OR e.n_nationkey = -1")
def j11(spark, d):
    names = raw(spark, d, "nation").select(F.lower(F.trim(F.concat(F.lit("  "), "n_name", F.lit(" ")))).alias("k"), F.length("n_name").alias("n"))
    people = raw(spark, d, "customer").select("c_custkey", F.lower(F.trim(F.concat(F.lit("Nation_"), "c_nationkey"))).alias("k"))
    return people.join(names, "k").select("c_custkey", "n")


@query("j12_exact_then_normalised", """, asked AS (SELECT DISTINCT CASE WHEN l_suppkey % 2 = 0 THEN s_name ELSE upper(s_name) END AS asked FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
  SELECT a.asked, coalesce(x.canonical_name, y.canonical_name) AS canonical_name FROM asked a LEFT JOIN canonical x ON a.asked = x.entity_name LEFT JOIN canonical y ON lower(a.asked) = lower(y.entity_name)""", (CANONICAL,))
def j12(spark, d):
    s = raw(spark, d, "supplier")
    asked = raw(spark, d, "lineitem").select(F.col("l_suppkey").alias("s_suppkey")).distinct().join(s, "s_suppkey").select(F.when(F.col("s_suppkey") % 2 == 0, F.col("s_name")).otherwise(F.upper("s_name")).alias("asked"))
    names = canonical(spark, d)
    exact = names.select(F.col("entity_name").alias("asked"), F.col("canonical_name").alias("e"))
    loose = names.select(F.lower("entity_name").alias("k"), F.col("canonical_name").alias("n"))
    return asked.join(exact, "asked", "left").join(loose, F.lower("asked") == F.col("k"), "left").select("asked", F.coalesce("e", "n").alias("canonical_name"))


@query("j13_first_per_key", "SELECT c_custkey, (SELECT min(o_orderpriority) FROM orders WHERE o_custkey = c_custkey) AS category FROM customer")
def j13(spark, d):
    least = raw(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.min("o_orderpriority").alias("category"))
    return raw(spark, d, "customer").select("c_custkey").join(least, "c_custkey", "left")


@query("j14_grouped_lookup", "SELECT c_custkey, string_agg(DISTINCT o_orderpriority, '|' ORDER BY o_orderpriority) AS priorities FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey")
def j14(spark, d):
    sets = raw(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.array_join(F.array_sort(F.collect_set("o_orderpriority")), "|").alias("priorities"))
    return raw(spark, d, "customer").select("c_custkey").join(sets, "c_custkey", "left")


def untested(e):
    """Pairs of known ends without an edge: the ends are dimensions, their product minus the tested pairs."""
    return e.select("source").distinct().crossJoin(e.select("target").distinct()).join(e.select("source", "target").distinct(), ["source", "target"], "left_anti")


@query("j15_untested_pairs", "SELECT s.source, t.target FROM (SELECT DISTINCT source FROM sparse) s, (SELECT DISTINCT target FROM sparse) t WHERE NOT EXISTS (SELECT 1 FROM sparse x WHERE x.source = s.source AND x.target = t.target)", (SPARSE,), whole=False)
def j15(spark, d, sparse=edges_sparse):
    return untested(sparse(spark, d))


@query("j16_unordered_pairs", "SELECT a.n_name AS a, b.n_name AS b FROM nation a JOIN nation b ON a.n_name < b.n_name")
def j16(spark, d):
    n = raw(spark, d, "nation")
    return n.select(F.col("n_name").alias("a")).join(n.select(F.col("n_name").alias("b")), F.col("a") < F.col("b"))


@query("j17_shared_neighbour", ", t AS (SELECT DISTINCT source, target FROM sparse) SELECT a.target AS a, b.target AS b, count(*) AS shared FROM t a JOIN t b ON a.source = b.source AND a.target < b.target GROUP BY ALL", (SPARSE,))
def j17(spark, d, sparse=edges_sparse):
    return shared_keys(sparse(spark, d).select("source", "target").distinct(), "target", "source").drop("total")


@query("j18_category_pairs", "SELECT a.category, a.canonical_name AS a, b.canonical_name AS b FROM (SELECT DISTINCT category, canonical_name FROM canonical) a JOIN (SELECT DISTINCT category, canonical_name FROM canonical) b ON a.category = b.category AND a.canonical_name < b.canonical_name", (CANONICAL,))
def j18(spark, d):
    c = canonical(spark, d).select("category", "canonical_name").distinct()
    return c.withColumnRenamed("canonical_name", "a").join(c.withColumnRenamed("canonical_name", "b"), "category").filter("a < b")


@query("j19_opposite_pairs", """SELECT a.paper_id, a.study_id AS a, b.study_id AS b FROM edges a JOIN edges b ON a.paper_id = b.paper_id AND lower(trim(a.target)) = lower(trim(b.target))
  WHERE a.outcome = 'improves' AND b.outcome = 'worsens'""", (EDGES,))
def j19(spark, d):
    e = edges(spark, d).withColumn("k", F.lower(F.trim("target")))
    return e.filter("outcome = 'improves'").select("paper_id", "k", F.col("study_id").alias("a")).join(e.filter("outcome = 'worsens'").select("paper_id", "k", F.col("study_id").alias("b")), ["paper_id", "k"]).select("paper_id", "a", "b")


@query("j20_priority_match", """, asked AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey END AS ext, CASE WHEN o_orderkey % 3 = 1 THEN '10.1000/' || o_orderkey END AS doi, 'Study of customer ' || o_custkey AS title FROM orders),
  titles AS (SELECT title, min(pmid) AS pmid FROM papers GROUP BY title)
  SELECT a.id, coalesce(x.pmid, y.pmid, t.pmid) AS pmid, CASE WHEN x.pmid IS NOT NULL THEN 'id' WHEN y.pmid IS NOT NULL THEN 'doi' WHEN t.pmid IS NOT NULL THEN 'title' END AS matched
  FROM asked a LEFT JOIN papers x ON a.ext = x.pmid LEFT JOIN papers y ON a.doi = y.doi LEFT JOIN titles t ON a.title = t.title""", (PAPERS,))
def j20(spark, d):
    key = F.col("o_orderkey")
    asked = raw(spark, d, "orders").select(key.alias("id"), F.when(key % 3 == 0, key).alias("ext"), F.when(key % 3 == 1, F.concat(F.lit("10.1000/"), key)).alias("doi"), F.concat(F.lit("Study of customer "), "o_custkey").alias("title"))
    p = papers(spark, d)
    out = asked.join(p.select(F.col("pmid").alias("ext"), F.col("pmid").alias("m1")), "ext", "left").join(p.filter("doi IS NOT NULL").select("doi", F.col("pmid").alias("m2")), "doi", "left")
    out = out.join(p.groupBy("title").agg(F.min("pmid").alias("m3")), "title", "left")
    return out.select("id", F.coalesce("m1", "m2", "m3").alias("pmid"), F.when(F.col("m1").isNotNull(), "id").when(F.col("m2").isNotNull(), "doi").when(F.col("m3").isNotNull(), "title").alias("matched"))


@query("u1_recursive_depth", """WITH RECURSIVE tree AS (SELECT vec_id AS id, CASE WHEN vec_id % 9 = 0 THEN NULL ELSE vec_id // 2 END AS parent FROM embeddings),
  walk AS (SELECT id, parent, 0 AS depth FROM tree UNION ALL SELECT w.id, t.parent, w.depth + 1 FROM walk w JOIN tree t ON w.parent = t.id WHERE w.depth < 10)
  SELECT id, max(depth) AS depth FROM walk GROUP BY id""")
def u1(spark, d):
    t = raw(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.when(F.col("vec_id") % 9 != 0, F.floor(F.col("vec_id") / 2)).alias("parent"))
    return ancestor_depth(t)


@query("u2_distinct_projection", "SELECT DISTINCT canonical_name, entity_type FROM canonical", (CANONICAL,))
def u2(spark, d):
    return canonical(spark, d).select("canonical_name", "entity_type").distinct()


@query("u3_candidate_union", "SELECT DISTINCT target AS condition FROM sparse UNION SELECT DISTINCT entity_name FROM canonical WHERE entity_type = 'condition' UNION SELECT * FROM (VALUES ('long_covid'), ('climate_anxiety')) t(condition)", (SPARSE, CANONICAL))
def u3(spark, d, sparse=edges_sparse):
    extra = spark.sql("SELECT explode(array('long_covid', 'climate_anxiety')) AS condition")
    return sparse(spark, d).select(F.col("target").alias("condition")).union(canonical(spark, d).filter("entity_type = 'condition'").select("entity_name")).union(extra).distinct()


@query("u4_set_overlap", """, w AS (SELECT source, target FROM edges GROUP BY ALL HAVING round(avg(weight * confidence), 6) > 0.4), s AS (SELECT x.source, list(target) FILTER (WHERE target IS NOT NULL) AS t FROM (SELECT DISTINCT source FROM edges) x LEFT JOIN w ON w.source = x.source GROUP BY x.source)
  SELECT a.source AS a, b.source AS b, len(list_intersect(a.t, b.t)) AS shared, len(a.t) + len(b.t) - 2 * len(list_intersect(a.t, b.t)) AS differ FROM s a JOIN s b ON a.source < b.source WHERE len(list_intersect(a.t, b.t)) > 0""", (EDGES,))
def u4(spark, d):
    """What two sources both work on and what only one does; counts from a join on what is shared carry no sets."""
    w = edges(spark, d).groupBy("source", "target").agg(r6(F.avg(F.col("weight") * F.col("confidence"))).alias("m")).filter("m > 0.4").select("source", "target")
    p = mn.shared_conditions(w, 1)
    return p.select("a", "b", "shared", (F.col("n_a") + F.col("n_b") - 2 * F.col("shared")).alias("differ"))


@query("u5_new_conditions", """, p AS (SELECT source, target || ' ' || mechanism AS t, max(year) >= 2001 AS late, min(year) < 2001 AS early FROM edges GROUP BY ALL) SELECT source, count(CASE WHEN late AND NOT early THEN 1 END) AS fresh FROM p GROUP BY source""", (EDGES,))
def u5(spark, d):
    """Conditions by mechanism that only the last year has."""
    t = F.concat_ws(" ", "target", "mechanism")
    sets = edges(spark, d).groupBy("source").agg(F.collect_set(F.when(F.col("year") >= 2001, t)).alias("recent"), F.collect_set(F.when(F.col("year") < 2001, t)).alias("old"))
    return sets.select("source", F.size(F.array_except("recent", "old")).cast("bigint").alias("fresh"))


@query("u6_unordered_dedupe", "SELECT least(source, target) AS a, greatest(source, target) AS b, min(study_id) AS study_id FROM edges GROUP BY ALL", (EDGES,))
def u6(spark, d):
    e = edges(spark, d)
    return e.groupBy(F.least("source", "target").alias("a"), F.greatest("source", "target").alias("b")).agg(F.min("study_id").alias("study_id"))
