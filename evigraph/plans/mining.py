"""Mining (M8 to M29)."""

from pyspark.sql import functions as F

from ..operators import conditions as cn, mining as mn, recommend as rc
from ..operators.cooccurrence import shared_keys
from ..sources.tables import edges, edges_sparse, raw
from .bayes import COUNTS
from .registry import EDGES, SPARSE, query, r6

_CLUSTERS = ", cl AS (SELECT DISTINCT p_brand AS target, substr(p_brand, 1, 7) AS cluster FROM part)"


def brand_clusters(spark, d):
    return raw(spark, d, "part").select(F.col("p_brand").alias("target"), F.substring("p_brand", 1, 7).alias("cluster")).distinct()


@query("m8_effectiveness_matrix", """, v AS (SELECT source, target, avg(weight * confidence) * avg(confidence) AS v FROM sparse GROUP BY ALL)
  SELECT s.source, t.target, round(coalesce(v.v, 0), 6) AS v FROM (SELECT DISTINCT source FROM sparse) s CROSS JOIN (SELECT DISTINCT target FROM sparse) t LEFT JOIN v ON v.source = s.source AND v.target = t.target""", (SPARSE,))
def m8(spark, d, sparse=edges_sparse):
    """The dense matrix over the ends: every cell is the result."""
    e = sparse(spark, d)
    ends = e.select("source").distinct().crossJoin(e.select("target").distinct())
    return ends.join(mn.effectiveness(e), ["source", "target"], "left").select("source", "target", r6(F.coalesce("v", F.lit(0.0))).alias("v"))


#: Of the factorisation in registered queries; its own bound is 500.
ROUNDS = 10


@query("m9_patterns")
def m9(spark, d, sparse=edges_sparse):
    return mn.patterns(sparse(spark, d), rounds=ROUNDS).withColumn("loading", r6("loading"))


@query("m9_pattern_report")
def m9_report(spark, d, sparse=edges_sparse):
    return mn.pattern_report(sparse(spark, d), rounds=ROUNDS).withColumns({c: r6(c) for c in ("strength", "confidence")})


@query("m10_cross_talk", "SELECT target, count(DISTINCT mechanism) AS mechanisms, string_agg(DISTINCT mechanism, ',' ORDER BY mechanism) AS names FROM sparse WHERE outcome = 'improves' GROUP BY target HAVING count(DISTINCT mechanism) > 1", (SPARSE,))
def m10(spark, d, sparse=edges_sparse):
    m = sparse(spark, d).filter("outcome = 'improves'").groupBy("target").agg(F.array_sort(F.collect_set("mechanism")).alias("m"))
    return m.filter(F.size("m") > 1).select("target", F.size("m").cast("bigint").alias("mechanisms"), F.array_join("m", ",").alias("names"))


SIMILAR = COUNTS.format(t="sparse") + """, sh AS (SELECT a.target AS a, b.target AS b, count(*) AS shared, avg((1 - abs(a.score - b.score)) * least(a.confidence, b.confidence)) AS evidence FROM s a JOIN s b ON a.source = b.source AND a.target < b.target GROUP BY ALL),
sz AS (SELECT target, count(*) AS n FROM s GROUP BY target), pr AS (SELECT target, mechanism, avg(confidence) AS l FROM sparse GROUP BY ALL),
nm AS (SELECT target, sqrt(sum(l * l)) AS z FROM pr GROUP BY target), dt AS (SELECT x.target AS a, y.target AS b, sum(x.l * y.l) AS dot FROM pr x JOIN pr y ON x.mechanism = y.mechanism AND x.target < y.target GROUP BY ALL),
sim AS (SELECT sh.a, sh.b, shared, shared / CAST(za.n + zb.n - shared AS DOUBLE) AS overlap, evidence, coalesce(dot, 0) / (na.z * nb.z) AS mechanism FROM sh JOIN sz za ON za.target = sh.a JOIN sz zb ON zb.target = sh.b JOIN nm na ON na.target = sh.a JOIN nm nb ON nb.target = sh.b LEFT JOIN dt ON dt.a = sh.a AND dt.b = sh.b)"""


@query("m11_condition_similarity", SIMILAR + " SELECT a, b, shared, round(overlap, 6) AS overlap, round(evidence, 6) AS evidence, round(mechanism, 6) AS mechanism, round(0.4 * overlap + 0.35 * evidence + 0.25 * mechanism, 6) AS similarity FROM sim", (SPARSE,))
def m11(spark, d, sparse=edges_sparse):
    return mn.condition_similarity(sparse(spark, d)).withColumns({c: r6(c) for c in ("overlap", "evidence", "mechanism", "similarity")})


@query("m12_condition_clusters")
def m12(spark, d, sparse=edges_sparse):
    """Ward clusters of conditions over their similarity."""
    e = sparse(spark, d)
    return cn.condition_clusters(mn.condition_similarity(e).withColumn("similarity", r6("similarity")), e.select("target").distinct())


@query("m13_cluster_description", COUNTS.format(t="sparse") + _CLUSTERS + """, sz AS (SELECT cluster, count(*) AS conditions FROM cl GROUP BY cluster), sc AS (SELECT s.*, cluster FROM s JOIN cl USING (target)),
  per AS (SELECT cluster, source, count(*) AS k, sum(score) AS total, conditions FROM sc JOIN sz USING (cluster) GROUP BY cluster, source, conditions), common AS (SELECT * FROM per WHERE k >= greatest(2, conditions // 2)),
  sh AS (SELECT cluster, array_to_string((list(source ORDER BY k DESC, source))[1:10], ',') AS common, count(*) AS n_common, sum(total + 0.5 * (conditions - k)) / sum(conditions) AS success FROM common GROUP BY cluster), st AS (SELECT cluster, avg(confidence) AS evidence_strength FROM sc GROUP BY cluster),
  ld AS (SELECT cluster, mechanism, round(sum(l) / conditions, 6) AS l FROM (SELECT target, mechanism, avg(confidence) AS l FROM sparse GROUP BY ALL) JOIN cl USING (target) JOIN sz USING (cluster) GROUP BY cluster, mechanism, conditions),
  pf AS (SELECT cluster, mechanism, l, l / sum(l) OVER (PARTITION BY cluster) AS share FROM ld WHERE l > 0.2), pr AS (SELECT cluster, string_agg(mechanism, ',' ORDER BY l DESC, mechanism) AS profile, (list(mechanism ORDER BY l DESC, mechanism))[1] AS dominant, max(share) AS share FROM pf GROUP BY cluster)
  SELECT cluster, conditions, coalesce(n_common, 0) AS n_common, common, profile, coalesce(dominant, 'unknown') AS dominant, 'Mixed' AS name, round(share, 6) AS share, round(coalesce(success, 0), 6) AS success, round(evidence_strength, 6) AS evidence_strength FROM sz LEFT JOIN sh USING (cluster) LEFT JOIN st USING (cluster) LEFT JOIN pr USING (cluster)""", (SPARSE,))
def m13(spark, d, sparse=edges_sparse):
    out = cn.describe_clusters(sparse(spark, d), brand_clusters(spark, d))
    return out.select(
        "cluster", "conditions", "n_common", F.array_join("common", ",").alias("common"), F.array_join(F.transform("profile", lambda e: e.mechanism), ",").alias("profile"), "dominant", "name",
        r6(F.try_element_at("profile", F.lit(1)).getField("share")).alias("share"), r6("success").alias("success"), r6("evidence_strength").alias("evidence_strength"),
    )


_SPELT = ("chronic depression", "gut pain", "arthritis", "diabetes", "mood and anxiety", "fatigue", "ibs")


@query("m14_unexpected_links", SIMILAR + _CLUSTERS + f""", o AS (SELECT sim.a, sim.b, x.cluster AS ca, y.cluster AS cb, round(0.4 * overlap + 0.35 * evidence + 0.25 * mechanism, 6) AS similarity FROM sim JOIN cl x ON x.target = sim.a JOIN cl y ON y.target = sim.b),
  t AS (SELECT *, {list(_SPELT)!r}[1 + CAST(substr(a, 7) AS INT) % 7] AS na, {list(_SPELT)!r}[1 + CAST(substr(b, 7) AS INT) % 7] AS nb FROM o WHERE ca <> cb AND similarity >= 0.5),
  f AS (SELECT *, [regexp_matches(x, 'depression|anxiety|mood|stress') FOR x IN [na, nb]] AS m, [regexp_matches(x, 'ibs|gut|digestive|microbiome|sibo') FOR x IN [na, nb]] AS g, [regexp_matches(x, 'arthritis|inflammation|autoimmune|psoriasis') FOR x IN [na, nb]] AS i, [regexp_matches(x, 'diabetes|metabolic|insulin|pcos') FOR x IN [na, nb]] AS e FROM t)
  SELECT a, b, similarity, CASE WHEN (m[1] AND g[2]) OR (m[2] AND g[1]) THEN 'gut_brain_axis' WHEN (m[1] AND i[2]) OR (m[2] AND i[1]) THEN 'inflammation_mood_connection' WHEN (m[1] AND e[2]) OR (m[2] AND e[1]) THEN 'metabolic_mental_health' ELSE 'novel_biological_connection' END AS discovery FROM f""", (SPARSE,))
def m14(spark, d, sparse=edges_sparse):
    """Conditions go by names that tell a field, chosen by the brand's number."""
    similar = mn.condition_similarity(sparse(spark, d)).withColumn("similarity", r6("similarity"))
    spelt = lambda c: F.element_at(F.array(*[F.lit(x) for x in _SPELT]), F.substring(c, 7, 9).cast("int") % 7 + 1)
    found = mn.unexpected(similar, brand_clusters(spark, d).withColumnRenamed("cluster", "category"), 0.5)
    return found.select("a", "b", "similarity", cn.discovery_type(spelt("a"), spelt("b"), F.array().cast("array<string>")).alias("discovery"))


@query("m15_peer_suggestions", _CLUSTERS + """, per AS (SELECT source, target, avg(weight * confidence) AS m FROM sparse GROUP BY ALL HAVING avg(weight * confidence) > 0), y AS (SELECT source, cluster, round(avg(m), 6) AS score, count(*) AS peers FROM per JOIN cl USING (target) GROUP BY ALL),
  o AS (SELECT cl.target, y.source, y.score, y.peers FROM cl JOIN y USING (cluster) WHERE NOT EXISTS (SELECT 1 FROM sparse x WHERE x.source = y.source AND x.target = cl.target))
  SELECT target, source, score, peers, row_number() OVER (PARTITION BY target ORDER BY score DESC, source) AS rank FROM o QUALIFY rank <= 10""", (SPARSE,), whole=False)
def m15(spark, d, sparse=edges_sparse):
    return mn.suggestions(sparse(spark, d), brand_clusters(spark, d), digits=6)


@query("m16_similarity_kit", """, t AS (SELECT source, target FROM sparse GROUP BY ALL HAVING round(avg(weight * confidence), 6) > 0.4), n AS (SELECT source, count(*) AS n FROM t GROUP BY source), j AS (SELECT a.source AS a, b.source AS b, count(*) AS i FROM t a JOIN t b ON a.target = b.target AND a.source < b.source GROUP BY ALL), k AS (SELECT j.*, x.n AS na, y.n AS nb FROM j JOIN n x ON x.source = a JOIN n y ON y.source = b)
  SELECT a, b, round(i / CAST(na + nb - i AS DOUBLE), 6) AS jaccard, round(2.0 * i / (na + nb), 6) AS dice, round(0.5 * (i / CAST(na + nb - i AS DOUBLE)) + 0.3 * (2.0 * i / (na + nb)) + 0.2 * least(1, ln(1 + i) / ln(100)), 6) AS composite FROM k""", (SPARSE,))
def m16(spark, d, sparse=edges_sparse):
    """Every pair of sources that work on a condition in common, from counts: sets are not carried to the pairs."""
    from ..functions import similarity as sm

    p = mn.shared_conditions(works(sparse(spark, d)), 1)
    both = F.col("n_a") + F.col("n_b")
    jaccard, dice = F.col("shared") / (both - F.col("shared")), 2.0 * F.col("shared") / both
    return p.select("a", "b", r6(jaccard).alias("jaccard"), r6(dice).alias("dice"), r6(sm.composite(jaccard, dice, F.col("shared"))).alias("composite"))


_COMBINED = """, per AS (SELECT source, count(DISTINCT target) AS n, avg(weight * confidence) AS e, count(*) AS k, list(DISTINCT mechanism) AS m FROM sparse GROUP BY source HAVING count(DISTINCT target) >= 2),
  t AS (SELECT DISTINCT source, target FROM sparse), sh AS (SELECT a.source AS a, b.source AS b, count(*) AS shared FROM t a JOIN t b ON a.target = b.target AND a.source < b.source GROUP BY ALL HAVING count(*) >= 3),
  x AS (SELECT sh.*, p.e AS ea, q.e AS eb, p.k AS ka, q.k AS kb, shared / CAST(p.n AS DOUBLE) AS confidence, (shared / CAST(p.n AS DOUBLE)) / (q.n / CAST(p.n + q.n - shared AS DOUBLE)) AS lift, (p.e + q.e) / 2 AS base, len(p.m) + len(q.m) - 2 * len(list_intersect(p.m, q.m)) AS d, len(p.m) + len(q.m) AS mm FROM sh JOIN per p ON p.source = sh.a JOIN per q ON q.source = sh.b),
  y AS (SELECT *, least(1, base) AS combined, least(1, 0.3 * confidence + 0.3 * least(1, (lift - 1) / 4) + 0.2 * least(1, least(1, base) / greatest(base, 0.1) - 1) + 0.2 * d / mm::DOUBLE) AS synergy FROM x)
  SELECT a, b, shared, round(confidence, 6) AS confidence, round(lift, 6) AS lift, round(combined, 6) AS combined, round(synergy, 6) AS synergy, least(ka, kb) / 10.0::DOUBLE AS evidence_strength FROM y WHERE confidence >= 0.6 AND lift >= 0.9 AND synergy >= 0.1"""


@query("m17_power_combinations", _COMBINED, (SPARSE,))
def m17(spark, d, sparse=edges_sparse, member=None):
    out = mn.combinations(sparse(spark, d), 0.6, 0.9, 3, 0.1, member=member)
    return out.withColumns({c: r6(c) for c in ("confidence", "lift", "combined", "synergy")})


_ROLES = """, sn AS (SELECT s_name AS name, n_name AS role, r_name AS domain FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
_BONUS = """least(0.5, CASE WHEN u.domain = w.domain AND u.role <> w.role THEN 0.2 ELSE 0 END + CASE WHEN CAST(substr(y.b, 10) AS INT) = CAST(substr(y.a, 10) AS INT) + 1 THEN 0.3 ELSE 0 END)"""


@query("m17_role_bonus", _COMBINED[: _COMBINED.index("\n  y AS")] + _ROLES.replace(", sn AS", "\n  sn AS") + f""",
  y AS (SELECT *, base * 1.0 AS bb FROM x), z AS (SELECT y.*, CASE WHEN CAST(substr(y.b, 10) AS INT) = CAST(substr(y.a, 10) AS INT) + 2 THEN 0.3 ELSE {_BONUS} END AS bonus FROM y JOIN sn u ON u.name = y.a JOIN sn w ON w.name = y.b),
  q AS (SELECT *, least(1, base * (1 + bonus)) AS combined FROM z), v AS (SELECT *, least(1, 0.3 * confidence + 0.3 * least(1, (lift - 1) / 4) + 0.2 * least(1, combined / greatest(base, 0.1) - 1) + 0.2 * d / mm::DOUBLE) AS synergy FROM q)
  SELECT a, b, shared, round(confidence, 6) AS confidence, round(lift, 6) AS lift, round(combined, 6) AS combined, round(synergy, 6) AS synergy, least(ka, kb) / 10.0::DOUBLE AS evidence_strength FROM v WHERE confidence >= 0.6 AND lift >= 0.9 AND round(synergy, 6) >= 0.3""", (SPARSE,))
def m17_bonus(spark, d, sparse=edges_sparse):
    """Combinations over all edges, with a bonus for other roles (nations) in one domain (region), for pairs of neighbours, and for known pairs (two apart)."""
    names = raw(spark, d, "supplier").join(raw(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(raw(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    roles = names.select(F.col("r_name").alias("domain"), F.col("s_name").alias("name"), F.col("n_name").alias("role"))
    at = F.substr("name", F.lit(10)).cast("int")
    apart = lambda k: roles.select(F.col("name").alias("a"), at.alias("k")).join(roles.select(F.col("name").alias("b"), (at - k).alias("k")), "k").select("a", "b")
    out = mn.combinations(sparse(spark, d), 0.6, 0.9, 3, -9, ties=mn.bonus_ties(roles, apart(1), apart(2)))
    return out.withColumns({c: r6(c) for c in ("confidence", "lift", "combined", "synergy")}).filter("synergy >= 0.3")


@query("m18_combination_trends", """, t AS (SELECT DISTINCT source, target FROM sparse), sh AS (SELECT a.source AS a, b.source AS b FROM t a JOIN t b ON a.target = b.target AND a.source < b.source GROUP BY ALL HAVING count(*) >= 10)
  SELECT s AS source, count(*) AS n FROM (SELECT a AS s FROM sh UNION ALL SELECT b FROM sh) GROUP BY s ORDER BY n DESC, s LIMIT 5""", (SPARSE,))
def m18(spark, d, sparse=edges_sparse):
    return mn.partners(sparse(spark, d).select("source", "target").distinct(), 10).orderBy(F.desc("n"), "source").limit(5)


@query("m18_combinations_of_member", "WITH " + SPARSE.lstrip() + ", c AS (SELECT * FROM (" + "WITH one AS (SELECT 1)" + _COMBINED + ")) SELECT * FROM c WHERE a = 'Supplier#000000007' OR b = 'Supplier#000000007'")
def m18_member(spark, d):
    return mn.combinations_of(m17(spark, d, member="Supplier#000000007"), "Supplier#000000007")


@query("m18_combination_summary", "WITH " + SPARSE.lstrip() + ", c AS (SELECT * FROM (" + "WITH one AS (SELECT 1)" + _COMBINED + """)), t AS (SELECT m, row_number() OVER (ORDER BY count(*) DESC, m) AS r FROM (SELECT a AS m FROM c UNION ALL SELECT b FROM c) GROUP BY m)
  SELECT count(*) AS total, round(avg(confidence) + 1e-9, 3) AS mean_confidence, round(avg(lift) + 1e-9, 1) AS mean_lift, round(avg(synergy) + 1e-9, 2) AS mean_synergy, (SELECT string_agg(m, ',' ORDER BY r) FROM t WHERE r <= 5) AS members FROM c""")
def m18_summary(spark, d):
    return mn.combination_summary(edges_sparse(spark, d), 0.6, 0.9, 3, 0.1).withColumn("members", F.array_join("members", ","))


_GAPS = _CLUSTERS + """, pairs AS (SELECT source, target, sum(weight * confidence) AS total, count(*) AS n FROM sparse GROUP BY ALL), o AS (SELECT s.source, t.target FROM (SELECT DISTINCT source FROM sparse) s CROSS JOIN (SELECT DISTINCT target FROM sparse) t WHERE NOT EXISTS (SELECT 1 FROM pairs p WHERE p.source = s.source AND p.target = t.target)),
  size AS (SELECT cluster, count(*) - 1 AS peers FROM cl GROUP BY cluster), near AS (SELECT source, cluster, sum(total) / sum(n) AS mean, count(DISTINCT target) AS overlap FROM pairs JOIN cl USING (target) GROUP BY ALL),
  alike AS (SELECT o.source, o.target, greatest(0, least(1, mean * (1 + overlap / CAST(peers AS DOUBLE)))) AS sm FROM o JOIN cl USING (target) JOIN size USING (cluster) JOIN near ON near.source = o.source AND near.cluster = cl.cluster),
  ws AS (SELECT source, list(DISTINCT mechanism) AS m FROM sparse GROUP BY source), wt AS (SELECT target, list(DISTINCT mechanism) AS m FROM sparse WHERE outcome = 'improves' GROUP BY target),
  tr AS (SELECT source, greatest(0, least(1, avg(m) + least(0.3, count(*) / 10.0))) AS track FROM (SELECT source, target, avg(weight * confidence) AS m FROM sparse GROUP BY ALL) GROUP BY source),
  r AS (SELECT o.source, o.target, sm, least(1, 0.3 * len(list_intersect(ws.m, wt.m))) AS mech, track, CASE WHEN o.source = 'Supplier#000000003' THEN 0.9 ELSE 0.3 END AS novelty FROM o LEFT JOIN alike ON alike.source = o.source AND alike.target = o.target LEFT JOIN ws ON ws.source = o.source LEFT JOIN wt ON wt.target = o.target LEFT JOIN tr ON tr.source = o.source),
  q AS (SELECT source, target, novelty, (CASE WHEN sm > 0 THEN 1 ELSE 0 END) + (CASE WHEN mech > 0 THEN 1 ELSE 0 END) + (CASE WHEN track > 0 THEN 1 ELSE 0 END) + (CASE WHEN novelty > 0.6 THEN 1 ELSE 0 END) AS sources,
    (CASE WHEN sm > 0 THEN sm ELSE 0 END) + (CASE WHEN mech > 0 THEN mech ELSE 0 END) + (CASE WHEN track > 0 THEN track ELSE 0 END) + (CASE WHEN novelty > 0.6 THEN novelty ELSE 0 END) AS total,
    (CASE WHEN sm > 0 THEN 0.4 * sm ELSE 0 END) + (CASE WHEN mech > 0 THEN 0.3 * mech ELSE 0 END) + (CASE WHEN track > 0 THEN 0.2 * track ELSE 0 END) + (CASE WHEN novelty > 0.6 THEN 0.1 * novelty ELSE 0 END) AS top,
    (CASE WHEN sm > 0 THEN 0.4 ELSE 0 END) + (CASE WHEN mech > 0 THEN 0.3 ELSE 0 END) + (CASE WHEN track > 0 THEN 0.2 ELSE 0 END) + (CASE WHEN novelty > 0.6 THEN 0.1 ELSE 0 END) AS w FROM r),
  z AS (SELECT source, target, novelty, sources, round(least(1, top / w), 6) AS score, total / sources AS strength FROM q WHERE sources > 0)
  SELECT source, target, score, sources, CASE WHEN score >= 0.8 AND novelty >= 0.7 THEN 'HIGH' WHEN score >= 0.7 AND sources >= 2 THEN 'HIGH' WHEN score >= 0.6 THEN 'NORMAL' ELSE 'LOW' END AS priority,
  CASE WHEN sources >= 3 AND strength >= 0.7 THEN 'VERY HIGH - Multiple strong indicators' WHEN sources >= 2 AND strength >= 0.6 THEN 'HIGH - Strong evidence from similar conditions' WHEN sources >= 2 OR strength >= 0.5 THEN 'MODERATE - Some supporting evidence' ELSE 'LOW - Limited evidence available' END AS confidence_level, 0.6::DOUBLE AS feasibility FROM z WHERE score >= 0.5"""


@query("m19_research_gaps", _GAPS, (SPARSE,), whole=False)
def m19(spark, d, sparse=edges_sparse):
    return mn.gaps(sparse(spark, d), brand_clusters(spark, d), {"Supplier#000000003": 0.9}, cap=None).withColumns({"score": r6("score"), "feasibility": cn.feasibility(F.col("source"))})


_FAILED = """, per AS (SELECT source, count(*) AS n, count(CASE WHEN outcome = 'worsens' THEN 1 END) AS negative, count(CASE WHEN outcome IN ('no_effect', 'inconclusive') THEN 1 END) AS neutral, count(CASE WHEN outcome = 'improves' THEN 1 END) AS positive, avg(confidence) AS q,
  count(DISTINCT CASE WHEN outcome = 'worsens' THEN target END) AS failed FROM edges GROUP BY source HAVING count(*) >= 3),
  r AS (SELECT *, (negative + neutral) / CAST(n AS DOUBLE) AS f FROM per), c AS (SELECT *, least(1, 0.4 * q + 0.3 * least(1, n / 20.0) + 0.2 * CASE WHEN n > 1 THEN f * (1 - positive / CAST(n AS DOUBLE)) ELSE 0.5 END) AS c FROM r WHERE f >= 0.36)
  SELECT source, n, round(f, 6) AS failure_rate, round(c, 6) AS confidence, round(n * f * (1 + c), 6) AS waste, failed, CASE WHEN c >= 0.8 THEN 'AVOID' WHEN f >= 0.7 THEN 'UNLIKELY TO HELP' ELSE 'INCONCLUSIVE' END AS advice FROM c"""


@query("m20_failed_interventions", _FAILED, (EDGES,))
def m20(spark, d):
    out = mn.failures(edges(spark, d), 0.36)
    return out.select("source", "n", r6("failure_rate").alias("failure_rate"), r6("confidence").alias("confidence"), r6("waste").alias("waste"), F.size("failed_conditions").cast("bigint").alias("failed"), "advice")


@query("m21_fundamental_functions", """, b AS (SELECT source, mechanism, avg(weight * confidence) AS m, count(*) AS n FROM sparse GROUP BY ALL), p AS (SELECT source, count(*) AS mechanisms, avg(m) AS effect, sum(n) AS evidence FROM b GROUP BY source),
  c AS (SELECT source, count(DISTINCT target) AS conditions FROM sparse GROUP BY source), x AS (SELECT *, CASE WHEN evidence < 5 THEN 0.9 WHEN evidence < 15 THEN 0.6 WHEN evidence < 30 THEN 0.3 ELSE 0.1 END AS vol FROM p JOIN c USING (source) WHERE mechanisms >= 3 AND conditions >= 4 AND effect > 0.3 AND evidence >= 3),
  y AS (SELECT *, least(1, (vol + least(1, mechanisms / 5.0)) / 2)::DOUBLE AS i FROM x)
  SELECT source, mechanisms, conditions, round(mechanisms * conditions * effect * least(2.0, 1 + log10(evidence)), 6) AS fundamentality, round(i, 6) AS innovation_index, CASE WHEN evidence >= 10 AND i <= 0.6 THEN 'established' WHEN evidence >= 5 AND i >= 0.6 AND i <= 0.9 THEN 'emerging' ELSE 'experimental' END AS classification FROM y""", (SPARSE,))
def m21(spark, d, sparse=edges_sparse):
    out = mn.fundamentals(sparse(spark, d))
    return out.select("source", "mechanisms", "conditions", r6("fundamentality").alias("fundamentality"), r6("innovation_index").alias("innovation_index"), "classification")


#: For the test tables, whose names tell no function.
_FUNCTIONS = {"breath": (("Brand#11", "Brand#12", "Brand#2"), ("supplier#000000003",), ("eco",)), "rhythm": (("Brand#5",), ("supplier#000000004", "supplier#000000005"), ("small", "m")), "warmth": ((), ("Supplier#000000003",), ("zinc",))}


@query("m21_body_functions", """, t AS (SELECT source, target, mechanism FROM sparse GROUP BY ALL HAVING round(avg(weight * confidence), 6) > 0.7), s AS (SELECT source, list(DISTINCT target) AS c, list(DISTINCT lower(mechanism)) AS m FROM t GROUP BY source),
  p(f, conditions, names, words) AS (VALUES ('breath', ['Brand#11', 'Brand#12', 'Brand#2'], ['supplier#000000003'], ['eco']), ('rhythm', ['Brand#5'], ['supplier#000000004', 'supplier#000000005'], ['small', 'm']), ('warmth', []::VARCHAR[], ['supplier#000000003'], ['zinc'])),
  x AS (SELECT source, f, 2 * len(list_intersect(c, conditions)) + CASE WHEN list_contains(names, lower(source)) THEN 3 ELSE 0 END + coalesce(list_sum(list_transform(words, lambda w: len(list_filter(m, lambda y: contains(y, w))))), 0) AS score FROM s, p)
  SELECT source, coalesce(string_agg(f, ',' ORDER BY f) FILTER (WHERE score >= 3), '') AS functions FROM x GROUP BY source""", (SPARSE,))
def m21_functions(spark, d, sparse=edges_sparse):
    """Body functions by what a source works on, and by which mechanisms."""
    e = sparse(spark, d).groupBy("source", "target", "mechanism").agg(r6(F.avg(F.col("weight") * F.col("confidence"))).alias("m")).filter("m > 0.7")
    sets = e.groupBy("source").agg(F.collect_set("target").alias("conditions"), F.collect_set("mechanism").alias("mechanisms"))
    return cn.body_functions(sets, _FUNCTIONS).select("source", F.array_join("functions", ",").alias("functions"))


_INNOVATION = """, axis AS (SELECT source, y FROM (SELECT DISTINCT source FROM edges), generate_series(1996, 2001) t(y)), n AS (SELECT a.source, a.y, count(e.study_id) AS n FROM axis a LEFT JOIN edges e ON e.source = a.source AND e.year = a.y GROUP BY ALL),
  g0 AS (SELECT source, n, lag(n) OVER (PARTITION BY source ORDER BY y) AS b FROM n), g AS (SELECT source, coalesce(least(1, greatest(0, (avg(CASE WHEN b > 0 THEN (n - b) / CAST(b AS DOUBLE) END) + 0.5) / 1.5)), 0) AS growth, least(1, avg(n) / 10.0) AS velocity FROM g0 GROUP BY source),
  p AS (SELECT source, avg(power(0.5, greatest(0, least(100, 2001 - year)) / 3.0)) AS recency, avg(CASE WHEN 2001 - year <= 3 THEN confidence END) AS cn, avg(CASE WHEN 2001 - year > 3 THEN confidence END) AS co,
    0.5 * least(1, count(DISTINCT target) / 10.0) + 0.3 * least(1, count(DISTINCT outcome) / 3.0) + 0.2 * least(1, count(DISTINCT study_design) / 4.0) AS diversity FROM edges GROUP BY source),
  x AS (SELECT source, recency, growth, CASE WHEN cn IS NULL THEN 0 ELSE least(1, greatest(0, (cn - coalesce(co, 0.5)) / 0.4)) END AS breakthrough, diversity::DOUBLE AS diversity, velocity FROM p JOIN g USING (source))
  SELECT source, round(recency, 6) AS recency, round(growth, 6) AS growth, round(breakthrough, 6) AS breakthrough, round(diversity, 6) AS diversity, round(velocity, 6) AS velocity FROM x"""


@query("m22_innovation_metrics", _INNOVATION, (EDGES,))
def m22(spark, d):
    names = ("recency", "growth", "breakthrough", "diversity", "velocity")
    return mn.innovation(edges(spark, d, design=True), 2001).select("source", *[r6(c).alias(c) for c in names])


@query("m22_innovation_index")
def m22_index(spark, d):
    out = mn.innovation(edges(spark, d, design=True), 2001)
    return out.select("source", r6("innovation_index").alias("innovation_index"), r6("novelty").alias("novelty"), r6("momentum").alias("momentum"), "classification")


@query("m23_revivals", """, e AS (SELECT source, target || '/' || mechanism AS target, confidence, CASE WHEN year <= 2000 THEN year - 20 ELSE year END AS y FROM edges), p AS (SELECT source, count(*) AS n, min(y) AS f, max(y) AS l, count(CASE WHEN y >= 1996 THEN 1 END) AS recent, count(CASE WHEN y < 1991 THEN 1 END) AS old, count(CASE WHEN y >= 1991 AND y < 1996 THEN 1 END) AS mid,
    list(DISTINCT target) FILTER (WHERE y >= 1996) AS tn, list(DISTINCT target) FILTER (WHERE y <= 1991) AS t_o, avg(CASE WHEN y >= 1996 THEN confidence END) AS quality FROM e GROUP BY source),
  k AS (SELECT *, len(list_filter(tn, lambda x: NOT list_contains(t_o, x))) AS fresh, least(1, recent / (old + 1)::DOUBLE) AS strength FROM p WHERE n >= 5 AND l - f >= 10 AND old >= 2 AND recent >= 3 AND recent > 2 * mid)
  SELECT source, round(strength, 6) AS strength, round(quality, 6) AS quality, round(fresh / len(tn)::DOUBLE, 6) AS novelty, round(least(1, recent / 5.0)::DOUBLE, 6) AS adoption FROM k WHERE fresh > 0 AND strength > 0.1""", (EDGES,))
def m23(spark, d):
    """On a stretched time axis, as the driver's dates span seven years: those up to 2000 count as twenty years older, and an application is a condition by one mechanism."""
    stretched = edges(spark, d).withColumn("year", F.when(F.col("year") <= 2000, F.col("year") - 20).otherwise(F.col("year"))).withColumn("target", F.concat_ws("/", "target", "mechanism"))
    return mn.revivals(stretched, 2001, strength=0.1).withColumns({c: r6(c) for c in ("strength", "quality", "novelty", "adoption")})


_RECOMMENDED = SIMILAR + """, alike AS (SELECT a, b FROM sim WHERE round(0.4 * overlap + 0.35 * evidence + 0.25 * mechanism, 6) >= 0.55), both_ AS (SELECT a AS target, b AS peer FROM alike UNION SELECT b, a FROM alike),
  cnt AS (SELECT target, source, count(*) AS n FROM sparse GROUP BY ALL), dir AS (SELECT s.target, s.source, s.score AS sd, s.confidence AS cd, n FROM s JOIN cnt USING (target, source)),
  pe AS (SELECT x.target, s.source, avg(0.8::DOUBLE * s.score) AS ss, list(DISTINCT x.peer ORDER BY x.peer) AS peers FROM both_ x JOIN s ON s.target = x.peer GROUP BY ALL),
  ws AS (SELECT source, list(DISTINCT mechanism) AS m FROM sparse GROUP BY source), wt AS (SELECT target, list(DISTINCT mechanism) AS m FROM sparse WHERE outcome = 'improves' GROUP BY target),
  fb AS (SELECT source, mechanism, avg(weight * confidence) AS m, count(*) AS n FROM sparse GROUP BY ALL), fu AS (SELECT source, least(0.7, 0.1 * count(*) + 0.5 * avg(m))::DOUBLE AS sf FROM fb JOIN (SELECT source, count(DISTINCT target) AS conditions FROM sparse GROUP BY source) USING (source) GROUP BY source, conditions HAVING count(*) >= 3 AND conditions >= 4 AND avg(m) > 0.3 AND sum(fb.n) >= 3),
  gp AS (SELECT source, target FROM sparse GROUP BY ALL HAVING round(avg(weight * confidence), 6) > 0.4), gn AS (SELECT source, count(*) AS n FROM gp GROUP BY source HAVING count(*) >= 2), gs AS (SELECT a.source AS a, b.source AS b, count(*) AS k FROM gp a JOIN gp b ON a.target = b.target AND a.source < b.source GROUP BY ALL HAVING count(*) >= 3),
  co AS (SELECT a, b, (k / p.n::DOUBLE) / (q.n / (p.n + q.n - k)::DOUBLE) AS lift FROM gs JOIN gn p ON p.source = a JOIN gn q ON q.source = b), cp AS (SELECT a AS source, b AS other, lift FROM co WHERE lift > 1.2 UNION ALL SELECT b, a, lift FROM co WHERE lift > 1.2),
  tg AS (SELECT x.target, x.source, least(0.6, (max(lift) - 1) * 0.5)::DOUBLE AS sc FROM cnt x JOIN cp ON cp.source = x.source JOIN cnt y ON y.target = x.target AND y.source = cp.other GROUP BY ALL),
  bad AS (SELECT source FROM sparse GROUP BY source HAVING count(CASE WHEN outcome <> 'improves' THEN 1 END) / count(*)::DOUBLE >= 0.37 AND count(*) >= 3),
  j AS (SELECT coalesce(dir.target, pe.target) AS target, coalesce(dir.source, pe.source) AS source, sd, cd, n, ss, coalesce(peers, []) AS peers FROM dir FULL JOIN pe ON pe.target = dir.target AND pe.source = dir.source),
  j2 AS (SELECT j.*, coalesce(list_sort(list_intersect(ws.m, wt.m)), []) AS ms, len(wt.m) AS need, sf, sc FROM j LEFT JOIN ws ON ws.source = j.source LEFT JOIN wt ON wt.target = j.target LEFT JOIN fu ON fu.source = j.source LEFT JOIN tg ON tg.target = j.target AND tg.source = j.source WHERE j.source NOT IN (SELECT source FROM bad)),
  j3 AS (SELECT *, CASE WHEN len(ms) > 0 THEN least(0.8::DOUBLE, len(ms) / need::DOUBLE) END AS sm FROM j2),
  j4 AS (SELECT *, [CASE WHEN sd > 0 THEN sd END, CASE WHEN sm > 0 THEN sm END, CASE WHEN ss > 0 THEN ss END, CASE WHEN sf > 0 THEN sf END, CASE WHEN sc > 0 THEN sc END]::DOUBLE[] AS v, [1.0, 0.7, 0.6, 0.9, 0.8]::DOUBLE[] AS w, [CASE WHEN cd > 0 THEN cd END, 0.6, 0.5, 0.65, 0.55]::DOUBLE[] AS c FROM j3),
  j5 AS (SELECT *, list_filter(generate_series(1, 5), lambda i: v[i] IS NOT NULL) AS ix FROM j4),
  j6 AS (SELECT *, round(list_sum(list_transform(ix, lambda i: v[i] * w[i])) / list_sum(list_transform(ix, lambda i: w[i])), 6) AS base_score, round(list_avg(list_filter(list_transform(ix, lambda i: c[i]), lambda x: x IS NOT NULL)), 6) AS confidence, list_transform(v, lambda x: round(x, 6)) AS r, coalesce(n, 0) + len(ms) + len(peers) AS evidence_count FROM j5),
  j7 AS (SELECT *, ['direct', 'mechanism', 'similar_condition', 'fundamental', 'combination'][list_position(r, list_max(r))] AS evidence_type, CASE WHEN evidence_count >= 8 AND confidence >= 0.7 THEN 'established' WHEN evidence_count >= 2 AND confidence >= 0.4 THEN 'emerging_promising' WHEN evidence_count >= 4 AND confidence >= 0.5 THEN 'moderate_evidence' ELSE 'experimental' END AS classification FROM j6 WHERE confidence >= 0.3),
  j8 AS (SELECT *, CASE classification WHEN 'emerging_promising' THEN 0.2 WHEN 'experimental' THEN 0.1 ELSE 0 END::DOUBLE + CASE WHEN evidence_type = 'mechanism' AND len(ms) > 1 THEN 0.05 ELSE 0 END::DOUBLE AS exploration_bonus FROM j7),
  rec AS (SELECT *, round(least(1, base_score + exploration_bonus), 6) AS final_score, row_number() OVER (PARTITION BY target ORDER BY round(least(1, base_score + exploration_bonus), 6) DESC, source) AS rank FROM j8 QUALIFY rank <= 10)"""


def works(e, bar=0.4):
    """Distinct (source, target) whose mean effect is over the bar."""
    return e.groupBy("source", "target").agg(r6(F.avg(F.col("weight") * F.col("confidence"))).alias("m")).filter(F.col("m") > bar).select("source", "target")


def _recommended(e):
    """Alike from 0.55 up, failed from 0.37 up, combinations of what has an effect over 0.4, whose lift is 1 at most: that channel stays empty here."""
    alike = mn.condition_similarity(e).filter(r6("similarity") >= 0.55)
    return rc.recommendations(e, alike, mn.failures(e, 0.37), mn.fundamentals(e), mn.shared_conditions(works(e), above=1.2))


@query("m25_recommendations", _RECOMMENDED + """ SELECT target, source, rank, final_score, base_score, round(exploration_bonus, 6) AS exploration_bonus, confidence, evidence_type, evidence_count, classification, array_to_string(ms, ',') AS mechanisms,
  concat_ws(' | ', CASE classification WHEN 'established' THEN 'Well-established treatment with strong evidence' WHEN 'emerging_promising' THEN 'Promising emerging treatment with positive early results' WHEN 'moderate_evidence' THEN 'Moderate evidence base, worth considering' ELSE 'Experimental treatment, limited evidence' END,
    'Confidence: ' || CAST(CAST(round(100 * confidence + 1e-9) AS INT) AS VARCHAR) || '%', 'Evidence count: ' || evidence_count, CASE WHEN len(ms) > 0 THEN 'Targets: ' || array_to_string(ms[1:2], ', ') END, CASE WHEN len(peers) > 0 THEN 'Also effective for: ' || array_to_string(peers[1:2], ', ') END,
    CASE WHEN exploration_bonus > 0 THEN 'Exploration bonus: +' || CAST(CAST(round(100 * exploration_bonus + 1e-9) AS INT) AS VARCHAR) || '%' END) AS explanation FROM rec""", (SPARSE,))
def m25(spark, d, sparse=edges_sparse):
    out = _recommended(sparse(spark, d)).withColumn("explanation", rc.explanation())
    return out.withColumns({"mechanisms": F.array_join("mechanisms", ","), "exploration_bonus": r6("exploration_bonus")}).drop("peers")


@query("m25_recommendation_diversity", _RECOMMENDED + """ SELECT target, count(*) AS total, count(CASE WHEN classification = 'established' THEN 1 END) AS established, count(CASE WHEN classification = 'emerging_promising' THEN 1 END) AS emerging_promising, count(CASE WHEN classification = 'moderate_evidence' THEN 1 END) AS moderate_evidence, count(CASE WHEN classification = 'experimental' THEN 1 END) AS experimental,
  count(CASE WHEN evidence_type = 'direct' THEN 1 END) AS direct, count(CASE WHEN evidence_type = 'mechanism' THEN 1 END) AS mechanism, count(CASE WHEN evidence_type = 'similar_condition' THEN 1 END) AS similar_condition, count(CASE WHEN evidence_type = 'fundamental' THEN 1 END) AS fundamental, count(CASE WHEN evidence_type = 'combination' THEN 1 END) AS combination,
  len(list_distinct(flatten(list(ms)))) AS mechanisms, round(avg(confidence), 6) AS mean_confidence, round(avg(exploration_bonus), 6) AS mean_bonus FROM rec GROUP BY target""", (SPARSE,))
def m25_diversity(spark, d, sparse=edges_sparse):
    return rc.recommendation_diversity(_recommended(sparse(spark, d))).withColumns({c: r6(c) for c in ("mean_confidence", "mean_bonus")})


_DIETS = ("gluten-free diet", "wheat bread", "Dairy free week", "whole milk", "Low-Carb plan", "high carb meals", "caffeine-free tea", "Sugar")


@query("m26_inconsistencies", ", n AS (SELECT *, lower([" + ", ".join(f"'{x}'" for x in _DIETS) + """][1 + CAST(substr(source, 10) AS INT) % 8]) AS name FROM edges WHERE outcome IN ('improves', 'worsens')),
  t(pair, side, term) AS (VALUES (0, 'without', 'gluten-free'), (0, 'without', 'gluten free'), (0, 'with', 'gluten'), (0, 'with', 'wheat'), (1, 'without', 'dairy-free'), (1, 'without', 'dairy free'), (1, 'with', 'dairy'), (1, 'with', 'milk'), (2, 'without', 'sugar-free'), (2, 'without', 'sugar free'), (2, 'with', 'sugar'),
    (3, 'without', 'low-carb'), (3, 'without', 'low carb'), (3, 'with', 'high-carb'), (3, 'with', 'high carb'), (4, 'without', 'low-fat'), (4, 'without', 'low fat'), (4, 'with', 'high-fat'), (4, 'with', 'high fat'), (5, 'without', 'caffeine-free'), (5, 'with', 'caffeine')),
  g AS (SELECT pair, side, list(term) AS terms FROM t GROUP BY ALL),
  s AS (SELECT paper_id, lower(trim(target)) AS condition, study_id, outcome, pair, side FROM n, g WHERE len(list_filter(terms, lambda x: contains(name, x))) > 0)
  SELECT a.paper_id, a.condition, a.pair, a.study_id AS without, b.study_id AS "with", CASE a.outcome WHEN 'improves' THEN 'both_positive' ELSE 'both_negative' END AS type
  FROM s a JOIN s b ON a.paper_id = b.paper_id AND a.condition = b.condition AND a.outcome = b.outcome AND a.pair = b.pair AND a.side = 'without' AND b.side = 'with'""", (EDGES,))
def m26(spark, d):
    """Sources named by their number, as the tables name no diets."""
    named = F.element_at(F.array(*[F.lit(x) for x in _DIETS]), F.substring("source", 10, 20).cast("int") % 8 + 1)
    return mn.opposite_conflicts(edges(spark, d).withColumn("name", named))


@query("m27_emerging_categories", """SELECT mechanism AS category, count(*) AS items, count(DISTINCT paper_id) AS papers, round(least(0.4, 0.05 * count(*)) + least(0.3, 0.1 * count(DISTINCT paper_id)) + CASE WHEN mechanism LIKE '%SMALL%' THEN 0.2 ELSE 0 END + 0.1, 6)::DOUBLE AS confidence FROM sparse WHERE outcome = 'inconclusive' GROUP BY mechanism HAVING count(*) >= 3 AND count(DISTINCT paper_id) >= 2""", (SPARSE,))
def m27(spark, d, sparse=edges_sparse):
    g = sparse(spark, d).filter("outcome = 'inconclusive'").groupBy(F.col("mechanism").alias("category")).agg(F.count("*").alias("items"), F.countDistinct("paper_id").alias("papers")).filter("items >= 3 AND papers >= 2")
    sure = F.least(F.lit(0.4), 0.05 * F.col("items")) + F.least(F.lit(0.3), 0.1 * F.col("papers")) + F.when(F.col("category").like("%SMALL%"), 0.2).otherwise(0.0) + 0.1
    return g.withColumn("confidence", r6(sure))


@query("m28_dictionary_lookup", "SELECT DISTINCT mechanism, CASE mechanism WHEN 'ECONOMY' THEN 'thrift' WHEN 'PROMO' THEN 'thrift' WHEN 'SMALL' THEN 'compact' ELSE 'other' END AS class FROM edges", (EDGES,))
def m28(spark, d):
    from ..functions.labels import lookup

    known = {"economy": "thrift", "promo": "thrift", "small": "compact"}
    return edges(spark, d).select("mechanism", lookup(F.replace(F.lower("mechanism"), F.lit(" "), F.lit("_")), known, "other").alias("class")).distinct()


@query("m29_review_statistics", """SELECT o_orderpriority AS model, count(*) AS n, count(CASE WHEN o_orderstatus ILIKE 'f%' THEN 1 END) AS correct, round(count(CASE WHEN o_orderstatus ILIKE 'f%' THEN 1 END) / CAST(count(*) AS DOUBLE), 6) AS accuracy FROM orders GROUP BY ALL""")
def m29(spark, d):
    right = F.count_if(F.ilike("o_orderstatus", F.lit("f%")))
    return raw(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("model")).agg(F.count("*").alias("n"), right.alias("correct"), r6(right / F.count("*")).alias("accuracy"))
