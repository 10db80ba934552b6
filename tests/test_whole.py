"""Queries run over the whole of their tables."""

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F
from test_density import plain_density, plain_merges, plain_tree
from test_oracles import ORACLES, QUERIES, SF, pytestmark  # noqa: F401

from evigraph.operators import mining as mn
from evigraph.plans.registry import r6
from evigraph.sources.tables import clusters, edges, raw


def test_exports_and_the_run_log_take_every_edge(spark):
    n = edges(spark, SF).count()
    assert QUERIES["k10_minimal_export"](spark, SF).count() == n
    assert sum(r.rows for r in QUERIES["k13_run_log"](spark, SF).collect()) == raw(spark, SF, "orders").count()


def test_only_queries_on_untested_pairs_keep_to_the_quarter():
    quarter = {"c9_gap_predictions", "m18_combinations_of_member", "m18_combination_summary", "j15_untested_pairs", "m15_peer_suggestions", "m17_power_combinations", "m19_research_gaps"}
    assert {q for q, sql in ORACLES.items() if "month <= 3" in sql} == quarter


@pytest.mark.parametrize(("name", "table"), [("s4_glob_reader", "orders"), ("s8_review_files", "orders"), ("x12_article_fields", "orders"), ("j20_priority_match", "orders"), ("r23_snapshot_rewrite", "orders"), ("v12_single_linkage", "embeddings")])
def test_a_row_for_each_row_of_the_table(spark, name, table):
    assert QUERIES[name](spark, SF).count() == raw(spark, SF, table).count()


def test_overlap_components_and_innovation_take_every_source(spark):
    n = edges(spark, SF).select("source").distinct().count()
    m = edges(spark, SF).groupBy("source", "target").agg(r6(F.avg(F.col("weight") * F.col("confidence"))).alias("m")).collect()
    works = {s: {r.target for r in m if r.source == s and r.m > 0.4} for s in {r.source for r in m}}
    want = {(a, b): (len(works[a] & works[b]), len(works[a] ^ works[b])) for a in works for b in works if a < b and works[a] & works[b]}
    assert len(works) == n and {(r.a, r.b): (r.shared, r.differ) for r in QUERIES["u4_set_overlap"](spark, SF).collect()} == want
    assert QUERIES["g11_weak_components"](spark, SF).count() == n + edges(spark, SF).select("target").distinct().count()
    whole = {r.source: r.innovation_index for r in mn.innovation(edges(spark, SF, design=True), 2001).select("source", r6("innovation_index").alias("innovation_index")).collect()}
    assert {r.source: r.innovation_index for r in QUERIES["m22_innovation_index"](spark, SF).collect()} == whole


def test_single_linkage_of_all_vectors_against_brute_force(spark):
    rows = clusters(spark, SF).collect()
    v = np.array([r.vector for r in rows])
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    near, label = v @ v.T >= 0.3, np.array([r.member for r in rows])
    while (low := np.where(near, label, label.max()).min(axis=1)).tolist() != label.tolist():
        label = low
    assert {r.member: r.label for r in QUERIES["v12_single_linkage"](spark, SF).collect()} == {r.member: x for r, x in zip(rows, label.tolist(), strict=True)}


def test_clusters_of_all_vectors_against_plain_versions(spark):
    rows = sorted(clusters(spark, SF).collect(), key=lambda r: r.member)
    v = np.array([r.vector for r in rows])
    groups = {c: [k for k, r in enumerate(rows) if r.cluster_id == c] for c in {r.cluster_id for r in rows}}
    labels = {r.member: r.label for r in QUERIES["v9_agglomeration"](spark, SF).collect()}
    merges = QUERIES["c27_dendrogram"](spark, SF).collect()
    assert len(labels) == len(rows)
    for c, at in groups.items():
        assert [labels[rows[k].member] for k in at] == plain.cut(plain.linkage(v[at], "average"), len(at), threshold=1.2).tolist()
        got = sorted((r.merge, r.left, r.right, r["size"], r.distance) for r in merges if r.cluster_id == c)
        want = plain.linkage(v[at], "ward")
        assert [x[1:4] for x in got] == [(a, b, n) for a, b, _, n in want] and np.allclose([x[4] for x in got], [x[2] for x in want], atol=2e-6)
    n = len(rows)
    want, _ = plain_density(plain_merges(plain_tree(v, 1), n), n, 2, "eom")
    got = {r.member: (r.label, r.probability) for r in QUERIES["v10_density_clusters"](spark, SF).collect()}
    assert {m for m, x in got.items() if x[0] >= 0} == {rows[k].member for k in want}
    assert len({(got[rows[k].member][0], x[0]) for k, x in want.items()}) == len({x[0] for x in want.values()})
    assert all(abs(got[rows[k].member][1] - x[1]) < 2e-6 for k, x in want.items())
    _, tree = plain_density(plain_merges(plain_tree(v, 3), n), n, 5, "eom")
    found = {(r.up, r.child, r["size"]) for r in QUERIES["c27_condensed_tree"](spark, SF).collect()}
    assert found == {(up, child, k) for up, child, _, k in tree}


def test_failures_count_every_condition(spark, tmp_path):
    """One source that always fails beside one that never does."""
    for name in ("supplier", "part", "orders"):
        (tmp_path / f"{name}.parquet").symlink_to(f"{SF}/{name}.parquet")
    lines = raw(spark, SF, "lineitem").filter("l_suppkey <= 2")
    lines.withColumn("l_returnflag", F.when(F.col("l_suppkey") == 1, "R").otherwise("A")).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = [r.n for r in QUERIES["m20_failed_interventions"](spark, str(tmp_path)).collect()]
    assert got == [lines.filter("l_suppkey = 1").count()]


def test_agreement_counts_designs_on_papers_alone(spark):
    """No edge is joined with its paper: both sides are folded first."""
    plan = QUERIES["x21_agreement_boost"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("Aggregate")
