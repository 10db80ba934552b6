"""Vectors, clusters, hierarchies (V rows)."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import vectors as vx
from ..functions.labels import auto_approval, diversity_severity
from ..operators import agglomeration as ag, clusters as cl, density as de
from ..sources.tables import canonical, clusters, edges, edges_sparse, raw
from .registry import CANONICAL, CLUSTERS, EDGES, SPARSE, query, r6

_DOT = "list_sum(list_transform(generate_series(1, len({a})), lambda i: {a}[i] * {b}[i]))"
_COS = f"greatest(0, least(1, {_DOT} / (sqrt({_DOT.format(a='{a}', b='{a}')}) * sqrt({_DOT.format(a='{b}', b='{b}')}))))"
_CENTROIDS = """
parts AS (SELECT cluster_id, i, avg(vector[i]) AS x FROM clusters, generate_series(1, 64) g(i) GROUP BY ALL),
means AS (SELECT cluster_id, list(x ORDER BY i) AS v, sqrt(sum(x * x)) + 1e-9 AS n FROM parts GROUP BY cluster_id),
centroids AS (SELECT m.cluster_id, list_transform(v, lambda x: x / n) AS centroid, (SELECT count(*) FROM clusters c WHERE c.cluster_id = m.cluster_id) AS members FROM means m)"""


@query("v2_l2_normalise", f"SELECT member, round({_DOT.format(a='vector', b='vector')} / power(sqrt({_DOT.format(a='vector', b='vector')}) + 1e-9, 2), 6) AS norm2, round(vector[1] / (sqrt({_DOT.format(a='vector', b='vector')}) + 1e-9), 6) AS first FROM clusters", (CLUSTERS,))
def v2(spark, d):
    u = vx.l2_normalise(F.col("vector"))
    return clusters(spark, d).select("member", u.alias("u")).select("member", r6(vx.dot(F.col("u"), F.col("u"))).alias("norm2"), r6(F.element_at("u", 1)).alias("first"))


@query("v3_cosine", f"SELECT a.member AS a, b.member AS b, round({_COS.format(a='a.vector', b='b.vector')}, 6) AS similarity FROM clusters a JOIN clusters b ON b.member = a.member + 1", (CLUSTERS,))
def v3(spark, d):
    c = clusters(spark, d)
    a, b = c.select(F.col("member").alias("a"), F.col("vector").alias("va")), c.select(F.col("member").alias("b"), F.col("vector").alias("vb"))
    return a.join(b, F.col("b") == F.col("a") + 1).select("a", "b", r6(vx.cosine(F.col("va"), F.col("vb"))).alias("similarity"))


@query("v4_similar_top_k", f""", s AS (SELECT a.member AS a, b.member AS b, round({_COS.format(a='a.vector', b='b.vector')}, 6) AS similarity FROM clusters a JOIN clusters b ON a.member <> b.member WHERE a.member % 50 = 0)
  SELECT a, b, similarity FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY similarity DESC, b) AS r FROM s WHERE similarity >= 0.2) WHERE r <= 5""", (CLUSTERS,))
def v4(spark, d):
    """A stated query set against all vectors."""
    c = clusters(spark, d)
    asked = c.filter("member % 50 = 0").select(F.col("member").alias("a"), F.col("vector").alias("va"))
    return cl.most_similar(asked, c.select(F.col("member").alias("b"), F.col("vector").alias("vb")), 5, 0.2)


@query("v5_centroids", "SELECT cluster_id, members, 0 AS missing, round(centroid[1], 6) AS x1, round(centroid[64], 6) AS x64 FROM centroids", (CLUSTERS, _CENTROIDS))
def v5(spark, d):
    return cl.centroids(clusters(spark, d)).select("cluster_id", "members", F.col("missing").cast("int").alias("missing"), r6(F.element_at("centroid", 1)).alias("x1"), r6(F.element_at("centroid", 64)).alias("x64"))


@query("v6_centroid_validation", "SELECT cluster_id, cluster_id % 4 = 3 AS valid FROM centroids", (CLUSTERS, _CENTROIDS))
def v6(spark, d):
    """Three of four centroids are spoilt: too long, too few numbers, one that is no number."""
    c, k = F.col("centroid"), F.col("cluster_id") % 4
    spoilt = F.when(k == 0, F.transform(c, lambda x: 1.1 * x)).when(k == 1, F.slice(c, 1, 63)).when(k == 2, F.concat(F.slice(c, 1, 63), F.array(F.lit(float("nan"))))).otherwise(c)
    return cl.centroids(clusters(spark, d)).select("cluster_id", vx.is_valid(spoilt, 64).alias("valid"))


@query("v7_merge_candidates", f""", p AS (SELECT a.cluster_id AS a, b.cluster_id AS b, round({_COS.format(a='a.centroid', b='b.centroid')}, 6) AS similarity, a.members AS size_a, b.members AS size_b FROM centroids a JOIN centroids b ON a.cluster_id < b.cluster_id)
  SELECT *, CASE WHEN similarity >= 0.9 THEN 'HIGH' WHEN similarity >= 0.85 THEN 'MEDIUM' ELSE 'LOW' END AS tier FROM p WHERE similarity >= 0.05""", (CLUSTERS, _CENTROIDS))
def v7(spark, d):
    return cl.merge_candidates(cl.centroids(clusters(spark, d)), 0.05, None).withColumn("similarity", r6("similarity"))


@query("v8_candidate_network", f""", p AS (SELECT a.cluster_id AS a, b.cluster_id AS b, {_COS.format(a='a.centroid', b='b.centroid')} AS s FROM centroids a JOIN centroids b ON a.cluster_id < b.cluster_id WHERE greatest(a.members, b.members) <= 10 * least(a.members, b.members))
  SELECT c AS cluster_id, count(*) AS n, round(max(s), 6) AS best FROM (SELECT a AS c, s FROM p WHERE s >= 0.05 UNION ALL SELECT b, s FROM p WHERE s >= 0.05) GROUP BY c""", (CLUSTERS, _CENTROIDS))
def v8(spark, d):
    kept = cl.filter_candidates(cl.merge_candidates(cl.centroids(clusters(spark, d)), 0.05, None), "LOW")
    ends = kept.select(F.explode(F.array("a", "b")).alias("cluster_id"), "similarity")
    return ends.groupBy("cluster_id").agg(F.count("*").alias("n"), r6(F.max("similarity")).alias("best"))


@query("v9_agglomeration")
def v9(spark, d):
    """Average linkage of each label's vectors, cut at 1.2."""
    return ag.agglomerate(clusters(spark, d), "cluster_id", "member", "vector", "average", 1.2)[0]


@query("c27_dendrogram")
def c27_dendrogram(spark, d):
    """Ward merges of each label's vectors, as rows of left, right, distance and size."""
    merges = ag.agglomerate(clusters(spark, d), "cluster_id", "member", "vector", "ward")[1]
    return merges.withColumn("distance", r6("distance"))


@query("v10_density_clusters")
def v10(spark, d):
    """Density clusters of all vectors, by the usual two members and one neighbour."""
    return de.density_clusters(clusters(spark, d), "member", "vector")[0].withColumn("probability", r6("probability"))


@query("c27_condensed_tree")
def c27_condensed(spark, d):
    """The condensed tree of clusters of five members, by cores of three neighbours."""
    return de.density_clusters(clusters(spark, d), "member", "vector", 5, 3)[1].withColumn("strength", r6("strength"))


@query("v12_single_linkage", f""", l AS (SELECT a.member AS a, b.member AS b FROM clusters a JOIN clusters b ON a.member <> b.member WHERE {_COS.format(a='a.vector', b='b.vector')} >= 0.3),
  r AS (SELECT member, member AS seen FROM clusters UNION SELECT r.member, l.b FROM r JOIN l ON r.seen = l.a) SELECT member, min(seen) AS label FROM r GROUP BY member""", (CLUSTERS,))
def v12(spark, d):
    return cl.single_linkage(clusters(spark, d), "member", "vector", 0.3)


@query("v11_singleton_labels", """, x AS (SELECT member AS id, CASE WHEN member % 7 = 0 THEN -1 ELSE cluster_id END AS label FROM clusters)
  SELECT id, CASE WHEN label = -1 THEN (SELECT max(label) FROM x) + row_number() OVER (PARTITION BY label ORDER BY id) ELSE label END AS label FROM x""", (CLUSTERS,))
def v11(spark, d):
    x = clusters(spark, d).select(F.col("member").alias("id"), F.when(F.col("member") % 7 == 0, -1).otherwise(F.col("cluster_id")).cast("bigint").alias("label"))
    return cl.complete_singletons(x, "id")


@query("v13_cluster_quality", """, s AS (SELECT c.cluster_id, avg(sqrt(list_sum(list_transform(generate_series(1, 64), lambda i: (c.vector[i] - m.v[i]) ** 2)))) AS s, count(*) AS n FROM clusters c JOIN means m USING (cluster_id) GROUP BY c.cluster_id),
  r AS (SELECT a.cluster_id, max((x.s + y.s) / sqrt(list_sum(list_transform(generate_series(1, 64), lambda i: (a.v[i] - b.v[i]) ** 2)))) AS r FROM means a JOIN means b ON a.cluster_id <> b.cluster_id JOIN s x ON x.cluster_id = a.cluster_id JOIN s y ON y.cluster_id = b.cluster_id GROUP BY a.cluster_id),
  q AS (SELECT c.cluster_id, avg(list_sum(list_transform(c.vector, lambda x: x * x))) AS sq FROM clusters c GROUP BY c.cluster_id),
  f AS (SELECT c.member, c.cluster_id = m.cluster_id AS same, s.n, list_sum(list_transform(generate_series(1, 64), lambda i: c.vector[i] * c.vector[i])) - 2 * list_sum(list_transform(generate_series(1, 64), lambda i: c.vector[i] * m.v[i])) + q.sq AS far FROM clusters c, means m JOIN s USING (cluster_id) JOIN q USING (cluster_id)),
  p AS (SELECT member, max(CASE WHEN same AND n > 1 THEN far * n / (n - 1) END) AS a, min(CASE WHEN NOT same THEN far END) AS b FROM f GROUP BY member)
  SELECT (SELECT count(*) FROM s) AS n_clusters, (SELECT sum(n) FROM s) AS n_members, (SELECT min(n) FROM s) AS smallest, (SELECT max(n) FROM s) AS largest, round((SELECT avg(n) FROM s), 6) AS mean_size, 1.0::DOUBLE AS assignment_rate, round((SELECT avg(CASE WHEN a IS NULL OR b IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END) FROM p), 6) AS silhouette, round((SELECT avg(r) FROM r), 6) AS davies_bouldin""", (CLUSTERS, _CENTROIDS))
def v13(spark, d):
    return cl.quality(clusters(spark, d)).withColumns({c: r6(c) for c in ("mean_size", "davies_bouldin", "silhouette")})


@query("v15_greedy_merges", f""", p AS (SELECT a.cluster_id AS a, b.cluster_id AS b, {_COS.format(a='a.centroid', b='b.centroid')} AS s FROM centroids a JOIN centroids b ON a.cluster_id < b.cluster_id),
  l AS (SELECT list_reduce(list([a, b] ORDER BY s DESC, a, b), lambda got, x: CASE WHEN list_has_any(got, x) THEN got ELSE got || x END) AS flat FROM p), u AS (SELECT unnest(generate_series(1, len(flat), 2)) AS i, flat FROM l)
  SELECT flat[i] AS a, flat[i + 1] AS b, round(s, 6) AS similarity FROM u JOIN p ON p.a = flat[i] AND p.b = flat[i + 1]""", (CLUSTERS, _CENTROIDS))
def v15(spark, d):
    return cl.greedy_merges(cl.merge_candidates(cl.centroids(clusters(spark, d)), 0.0, None)).select("a", "b", r6("similarity").alias("similarity"))


@query("v16_threshold_grid", f""", p AS (SELECT {_COS.format(a='a.centroid', b='b.centroid')} AS s FROM centroids a JOIN centroids b ON a.cluster_id < b.cluster_id)
  SELECT t AS threshold, count(*) AS candidates, round(avg(s), 6) AS mean_similarity FROM p, (VALUES (0.02::DOUBLE), (0.05::DOUBLE), (0.1::DOUBLE)) g(t) WHERE s >= t GROUP BY t""", (CLUSTERS, _CENTROIDS))
def v16(spark, d):
    return cl.threshold_grid(cl.centroids(clusters(spark, d)), (0.02, 0.05, 0.1)).withColumn("mean_similarity", r6("mean_similarity"))


@query("v17_diversity_check", f""", f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY member) AS r FROM clusters) WHERE r <= 5)
  SELECT a.cluster_id AS a, b.cluster_id AS b, round(avg({_COS.format(a='a.vector', b='b.vector')}), 6) AS mean, CASE WHEN avg({_COS.format(a='a.vector', b='b.vector')}) >= 0.4 THEN 'NONE' WHEN avg({_COS.format(a='a.vector', b='b.vector')}) >= 0.3 THEN 'MODERATE' ELSE 'SEVERE' END AS severity FROM f a JOIN f b ON a.cluster_id < b.cluster_id GROUP BY ALL""", (CLUSTERS,))
def v17(spark, d):
    """Five members stand for a cluster: that bound is the check's own."""
    five = clusters(spark, d).withColumn("r", F.row_number().over(Window.partitionBy("cluster_id").orderBy("member"))).filter("r <= 5")
    a, b = five.select(F.col("cluster_id").alias("a"), F.col("vector").alias("va")), five.select(F.col("cluster_id").alias("b"), F.col("vector").alias("vb"))
    m = a.join(b, F.col("a") < F.col("b")).groupBy("a", "b").agg(F.avg(vx.cosine(F.col("va"), F.col("vb"))).alias("m"))
    return m.select("a", "b", r6("m").alias("mean"), diversity_severity(F.col("m")).alias("severity"))


@query("v18_auto_approval", """SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'P' THEN 'classified as different' WHEN o_orderpriority NOT LIKE '1%' THEN 'low confidence' WHEN o_custkey % 2 = 0 THEN 'poor name quality' WHEN o_custkey % 3 = 0 THEN 'severe diversity warning' END AS reason FROM orders""")
def v18(spark, d):
    o = raw(spark, d, "orders")
    relation = F.when(F.col("o_orderstatus") == "P", "DIFFERENT").otherwise("EXACT_MATCH")
    sure = F.when(F.col("o_orderpriority").like("1%"), "HIGH").otherwise("LOW")
    return o.select(F.col("o_orderkey").alias("id"), auto_approval(relation, sure, F.col("o_custkey") % 2 != 0, F.when(F.col("o_custkey") % 3 == 0, "SEVERE").otherwise("NONE")).alias("reason"))


_H = "h AS (SELECT vec_id AS cluster_id, CASE WHEN vec_id > 0 THEN (vec_id - 1) // 2 END AS parent_id, CAST(floor(log2(vec_id + 1)) AS INT) AS level FROM embeddings)"


def hierarchy(spark, d):
    v = F.col("vec_id")
    return raw(spark, d, "embeddings").select(v.alias("cluster_id"), F.when(v > 0, F.floor((v - 1) / 2)).cast("bigint").alias("parent_id"), F.floor(F.log2(v + 1)).cast("int").alias("level"))


@query("v19_apply_merges", """, m AS (SELECT * FROM (VALUES (5, 6, 'identical'), (7, 8, 'variant')) t(a, b, relation)), top AS (SELECT max(cluster_id) AS t FROM h)
  SELECT h.cluster_id, CASE WHEN h.cluster_id IN (7, 8) THEN t + 1 WHEN h.parent_id = 6 THEN 5 ELSE h.parent_id END AS parent_id, CASE WHEN h.cluster_id IN (7, 8) THEN 1 ELSE h.level END AS level FROM h, top WHERE h.cluster_id <> 6 UNION ALL SELECT t + 1, NULL, 0 FROM top""", (_H,))
def v19(spark, d):
    m = spark.sql("SELECT * FROM VALUES (5L, 6L, 'identical'), (7L, 8L, 'variant') AS t(a, b, relation)")
    return cl.apply_merges(hierarchy(spark, d), m)


@query("v20_hierarchy_problems", """, b AS (SELECT cluster_id, CASE WHEN cluster_id % 40 = 9 THEN 999999 WHEN cluster_id % 60 = 7 THEN 2 * cluster_id + 1 ELSE parent_id END AS parent_id, CASE WHEN cluster_id % 50 = 3 THEN 0 ELSE level END AS level FROM h),
  w AS (SELECT cluster_id AS id, parent_id AS seen FROM b WHERE parent_id IS NOT NULL UNION SELECT w.id, b.parent_id FROM w JOIN b ON w.seen = b.cluster_id WHERE b.parent_id IS NOT NULL),
  e AS (SELECT w.id FROM w LEFT JOIN b ON w.seen = b.cluster_id GROUP BY w.id HAVING count(*) FILTER (WHERE b.parent_id IS NULL) = 0), o AS (SELECT id FROM w WHERE id = seen)
  SELECT c.cluster_id, CASE WHEN p.cluster_id IS NULL THEN 'orphan' ELSE 'level' END AS problem FROM b c LEFT JOIN b p ON c.parent_id = p.cluster_id WHERE c.parent_id IS NOT NULL AND (p.cluster_id IS NULL OR c.level <= p.level)
  UNION ALL SELECT id, 'cycle' FROM o UNION ALL SELECT id, 'leads to cycle' FROM e WHERE id NOT IN (SELECT id FROM o)""", (_H,))
def v20(spark, d):
    """Parents that are missing, clusters above their parents, and some whose parent is their own first child."""
    c = F.col("cluster_id")
    wrong = F.when(c % 40 == 9, 999999).when(c % 60 == 7, 2 * c + 1).otherwise(F.col("parent_id")).cast("bigint")
    bad = hierarchy(spark, d).select(c, wrong.alias("parent_id"), F.when(c % 50 == 3, 0).otherwise(F.col("level")).alias("level"))
    return cl.hierarchy_problems(bad)


@query("v21_hierarchy_path", "SELECT h.cluster_id, (CASE WHEN h.parent_id IS NULL THEN 0 ELSE 1 END) + (CASE WHEN p.parent_id IS NULL THEN 0 ELSE 1 END) AS ancestors, coalesce(p.parent_id, h.parent_id, h.cluster_id) AS root FROM h LEFT JOIN h p ON h.parent_id = p.cluster_id", (_H,))
def v21(spark, d):
    h = hierarchy(spark, d)
    out = h.join(h.select(F.col("cluster_id").alias("parent_id"), F.col("parent_id").alias("grand")), "parent_id", "left")
    return out.select("cluster_id", (F.col("parent_id").isNotNull().cast("int") + F.col("grand").isNotNull().cast("int")).alias("ancestors"), F.coalesce("grand", "parent_id", "cluster_id").alias("root"))


@query("v22_cross_category", """, m AS (SELECT DISTINCT e.target, c.category FROM sparse e JOIN canonical c ON e.source = c.entity_name) SELECT target, count(*) AS categories, string_agg(category, ',' ORDER BY category) AS spans FROM m GROUP BY target HAVING count(*) > 1""", (SPARSE, CANONICAL))
def v22(spark, d, sparse=edges_sparse):
    names = canonical(spark, d).select(F.col("entity_name").alias("source"), "category")
    m = sparse(spark, d).select("source", "target").join(names, "source").groupBy("target").agg(F.array_sort(F.collect_set("category")).alias("c"))
    return m.filter(F.size("c") > 1).select("target", F.size("c").cast("bigint").alias("categories"), F.array_join("c", ",").alias("spans"))


@query("v23_consolidation_guard", """, u AS (SELECT mechanism AS name, count(*) AS n FROM edges WHERE month <> 12 OR mechanism <> 'PROMO' GROUP BY mechanism UNION ALL SELECT 'rare ' || mechanism, count(*) FROM edges WHERE month = 1 GROUP BY mechanism),
  m AS (SELECT name AS old, CASE WHEN name LIKE 'rare %' THEN substr(name, 6) WHEN name = 'SMALL' THEN 'SMALL' WHEN name < 'M' THEN 'rare ' || name END AS new FROM u), ok AS (SELECT old, new FROM m JOIN u a ON a.name = old JOIN u b ON b.name = new WHERE old <> new AND a.n <= 2 * b.n)
  SELECT coalesce(ok.new, u.name) AS name, CAST(sum(u.n) AS BIGINT) AS n, count(*) AS merged FROM u LEFT JOIN ok ON ok.old = u.name GROUP BY 1""", (EDGES,))
def v23(spark, d):
    """Rare names ask to join their common ones, which is allowed; some common ones ask for the reverse, which is not."""
    e, m = edges(spark, d), F.col("mechanism")
    usage = e.filter((F.col("month") != 12) | (m != "PROMO")).groupBy(m.alias("name")).agg(F.count("*").alias("n"))
    usage = usage.union(e.filter("month = 1").groupBy(F.concat(F.lit("rare "), m).alias("name")).agg(F.count("*").alias("n")))
    name = F.col("name")
    asked = usage.select(name.alias("old"), F.when(name.startswith("rare "), F.substr(name, F.lit(6))).when(name == "SMALL", name).when(name < "M", F.concat(F.lit("rare "), name)).alias("new"))
    allowed = consolidation(usage, asked)
    joined = usage.join(allowed, name == F.col("old"), "left").select(F.coalesce("new", "name").alias("name"), "n")
    return joined.groupBy("name").agg(F.sum("n").alias("n"), F.count("*").alias("merged"))


def consolidation(usage, asked):
    """Renamings that are allowed: not of a name to itself, not of one over twice as popular as its goal."""
    old, new = usage.select(F.col("name").alias("old"), F.col("n").alias("n_old")), usage.select(F.col("name").alias("new"), F.col("n").alias("n_new"))
    return asked.join(old, "old").join(new, "new").filter("old <> new AND n_old <= 2 * n_new").select("old", "new")


@query("v24_category_discovery", "SELECT mechanism AS category, count(*) AS usage, round(avg(confidence), 6) AS mean, array_to_string((list(DISTINCT source ORDER BY source))[1:5], ',') AS examples FROM sparse GROUP BY mechanism", (SPARSE,))
def v24(spark, d, sparse=edges_sparse):
    return sparse(spark, d).groupBy(F.col("mechanism").alias("category")).agg(F.count("*").alias("usage"), r6(F.avg("confidence")).alias("mean"), F.array_join(F.slice(F.array_sort(F.collect_set("source")), 1, 5), ",").alias("examples"))


@query("v25_clusters_from_labels", "SELECT cluster_id, string_agg(CAST(member AS VARCHAR), ',' ORDER BY member) AS members FROM clusters GROUP BY cluster_id", (CLUSTERS,))
def v25(spark, d):
    return clusters(spark, d).groupBy("cluster_id").agg(F.array_join(F.array_sort(F.collect_list("member")), ",").alias("members"))


@query("v26_fallback_names", ", n AS (SELECT target, source, count(*) AS n FROM sparse GROUP BY ALL) SELECT target, source AS name FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY n DESC, source) AS r FROM n) WHERE r = 1", (SPARSE,))
def v26(spark, d, sparse=edges_sparse):
    n = sparse(spark, d).groupBy("target", "source").agg(F.count("*").alias("n"))
    return n.groupBy("target").agg(F.min_by("source", F.struct(-F.col("n"), F.col("source"))).alias("name"))
