"""Operators on small fixtures: hand-computed values, properties, edge cases."""

import json

import numpy as np
import plain
import pytest
from pyspark.sql import functions as F

from evigraph.operators import clusters as cl
from evigraph.operators import components, evidence, factors, graph, mining, resolution, validation
from evigraph.sources import articles, sinks
from evigraph.streaming import evidence_counts, outcome_windows, read_events
from evigraph.streaming.evidence import run_available

EDGE = "study_id string, paper_id bigint, source string, target string, mechanism string, outcome string, confidence double, sample_size double, year int, study_design string, weight double"


def edges(spark, rows):
    w = {"improves": 1.0, "worsens": -1.0, "no_effect": 0.0, "inconclusive": 0.3}
    return spark.createDataFrame([(f"s{i}", i, s, t, m, o, c, 10.0, y, "rct", w[o]) for i, (s, t, m, o, c, y) in enumerate(rows)], EDGE)


def test_pair_score(spark):
    r = evidence.fold_pairs(edges(spark, [("a", "x", "m", "improves", 0.8, 2000), ("a", "x", "m", "worsens", 0.4, 2000)])).first()
    assert (r.raw_score, r.avg_confidence, r.aggregate_score, r.strongest_study) == (0.2, 0.6, 0.12, "s0")
    assert r.recommendation.startswith("Neutral")


def test_folds_of_nothing(spark):
    none = spark.createDataFrame([], EDGE)
    assert evidence.fold_pairs(none).count() == 0 and evidence.fundamental(none).count() == 0
    assert evidence.graph_statistics(none).first().edges_per_node == 0.0


def test_components_match_union_find(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 60, (45, 2)) if a != b]
    boss = list(range(60))

    def top(x):
        while boss[x] != x:
            x = boss[x]
        return x

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        boss[b] = a
    got = {r.node: r.component for r in components.weak_components(spark.createDataFrame(pairs, "a int, b int"), "a", "b").collect()}
    assert got == {n: top(n) for n in {x for p in pairs for x in p}}


def test_paths_are_simple_and_bounded(spark):
    links = spark.createDataFrame([("a", "b", 1.0), ("b", "c", 1.0), ("a", "c", 0.5), ("c", "a", 1.0), ("c", "d", 1.0), ("b", "d", 0.05)], "source string, target string, weight double")
    got = [(r.path, r.total) for r in graph.simple_paths(links, "a", "d").collect()]
    assert got == [("a>b>c>d", 3.0), ("a>c>d", 1.5)]


def test_clustering_coefficient(spark):
    links = spark.createDataFrame([("a", "b", 1.0), ("a", "c", 1.0), ("b", "c", 1.0)], "source string, target string, weight double")
    got = {r.node: r.coefficient for r in graph.clustering(links).collect()}
    assert got == {"a": 0.5, "b": 0.0}


def test_centroids_and_candidates(spark):
    rows = [(1, "m1", [1.0, 0.0, 0.0]), (1, "m2", [0.9, 0.1, 0.0]), (2, "m3", [0.95, 0.05, 0.0]), (3, "m4", [0.0, 0.0, 2.0]), (3, "m5", None)]
    members = spark.createDataFrame(rows, "cluster_id int, member string, vector array<double>")
    of = cl.centroids(members)
    c = {r.cluster_id: r for r in of.collect()}
    assert c[3].centroid == pytest.approx([0, 0, 1]) and c[3].missing == 1 and np.linalg.norm(c[1].centroid) == pytest.approx(1)
    assert [(r.a, r.b, r.tier) for r in cl.merge_candidates(of, 0.8).collect()] == [(1, 2, "HIGH")]


@pytest.mark.parametrize("method", ["single", "complete", "average", "ward"])
def test_linkage_is_a_tree_that_finds_blobs(method):
    rng = np.random.default_rng(3)
    points = np.concatenate([rng.normal(0, 0.1, (10, 2)), rng.normal(5, 0.1, (8, 2)), rng.normal(-5, 0.1, (6, 2))])
    merges = plain.linkage(points, method)
    assert len(merges) == len(points) - 1 and merges[-1][3] == len(points)
    assert sorted(np.bincount(plain.cut(merges, len(points), k=3)).tolist()) == [6, 8, 10]


def test_single_linkage_equals_cut(spark):
    rng = np.random.default_rng(5)
    v = rng.normal(size=(40, 3))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    got = {r.id: r.label for r in cl.single_linkage(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id int, v array<double>"), "id", "v", 0.9).collect()}
    want = plain.cut(plain.linkage(v, "single"), 40, threshold=np.sqrt(2 - 2 * 0.9))
    assert all((got[i] == got[j]) == (want[i] == want[j]) for i in range(40) for j in range(i))


def test_greedy_merges_match_the_sequential_pass(spark):
    rng = np.random.default_rng(7)
    pairs = [(a, b, float(s)) for (a, b), s in zip([(a, b) for a in range(9) for b in range(a + 1, 9)], rng.random(36), strict=True)]
    used, want = set(), set()
    for a, b, _ in sorted(pairs, key=lambda p: -p[2]):
        if not used & {a, b}:
            used |= {a, b}
            want.add((a, b))
    assert {(r.a, r.b) for r in cl.greedy_merges(spark.createDataFrame(pairs, "a int, b int, similarity double")).collect()} == want


def test_factorisation_equals_the_matrix_form(spark):
    """Same start, same rounds: same factors and error, with untested cells in the matrix."""
    rng = np.random.default_rng(0)
    v = (rng.random((12, 3)) @ rng.random((3, 9)) - 0.3) * (rng.random((12, 9)) < 0.7)
    v[:, 0] += 0.1
    df = spark.createDataFrame([(f"r{i:02d}", f"c{j}", float(v[i, j])) for i in range(12) for j in range(9) if v[i, j]], "row string, col string, v double")
    first = [np.array([r.f for r in factors.start(df.select(F.col(c).alias("name")).distinct(), 3, 42).orderBy("name").collect()]) for c in ("row", "col")]
    assert all(len({tuple(x) for x in f.tolist()}) == len(f) and f.min() >= 0.1 for f in first)
    w, h = factors.factorise(df, 3, rounds=5)
    got_w, got_h = (np.array([r.f for r in f.orderBy("name").collect()]) for f in (w, h))
    want_w, want_h = plain.factorise(v, first[0], first[1].T, 5)
    assert np.allclose(got_w, want_w) and np.allclose(got_h.T, want_h) and got_w.min() >= 0
    x = v - min(0.0, v.min()) + 0.01
    error = factors.objective(df, w, h, 3, factors.shift_of(df))
    assert error == pytest.approx(float(((x - got_w @ got_h.T) ** 2).sum()))
    assert error < float(((x - first[0] @ first[1].T) ** 2).sum())


def test_synergy_bonuses(spark):
    roles = spark.createDataFrame([("gut", "a", "x"), ("gut", "b", "y"), ("gut", "c", "x"), ("mind", "a", "p"), ("mind", "b", "q"), ("mind", "d", "q"), ("skin", "a", "1"), ("skin", "b", "2")], "domain string, name string, role string")
    pairs, known = (spark.createDataFrame(r, "a string, b string") for r in ([("b", "a"), ("e", "f"), ("c", "a")], [("d", "b"), ("z", "y")]))
    got = {(r.a, r.b): round(r.bonus, 6) for r in mining.synergy_bonuses(roles, pairs, known).collect()}
    assert got == {("a", "b"): 0.5, ("a", "c"): 0.3, ("a", "d"): 0.2, ("b", "c"): 0.2, ("b", "d"): 0.3, ("e", "f"): 0.3, ("y", "z"): 0.3}


def test_failures_and_fundamentals(spark):
    rows = [("bad", f"c{i}", "m", "worsens", 0.9, 2000) for i in range(25)] + [("good", f"c{i}", f"m{i % 3}", "improves", 0.9, 2000) for i in range(6)]
    e = edges(spark, rows)
    f = mining.failures(e).collect()
    assert [(r.source, r.failure_rate, r.advice) for r in f] == [("bad", 1.0, "AVOID")]
    assert f[0].confidence == pytest.approx(0.4 * 0.9 + 0.3 + 0.2)
    assert [(r.source, r.mechanisms, r.conditions) for r in mining.fundamentals(e).collect()] == [("good", 3, 6)]


def test_combination_lift(spark):
    rows = [("A", c, "m", "improves", 0.9, 2000) for c in "123"] + [("B", c, "n", "improves", 0.9, 2000) for c in "1234"]
    r = mining.combinations(edges(spark, rows), 0, 0, 3, -9).first()
    assert (r.confidence, r.lift, r.shared) == (1.0, 1.0, 3)


def test_validation(spark):
    rows = spark.createDataFrame([("1234567", "A proper title", None, "J", "2020-05", "10.1234/x"), ("12", "short", "x", None, "20-1", None)], "pmid string, title string, abstract string, journal string, publication_date string, doi string")
    got = {r.pmid: (r.valid, sorted(i.field for i in r.issues)) for r in validation.validate_papers(rows).collect()}
    assert got["1234567"] == (True, []) and got["12"][0] is False and got["12"][1] == ["abstract", "pmid", "publication_date", "title"]
    assert validation.check_query(" ", 0, -1) and not validation.check_query("x", 5)


def test_find_or_create_is_stable(spark):
    known = spark.createDataFrame([("Vitamin D", 7)], "name string, id bigint")
    got = {r.term: r.id for r in resolution.find_or_create(spark.createDataFrame([("vitamin d",), ("Zinc",), ("Iron",)], "term string"), known).collect()}
    assert got == {"vitamin d": 7, "Iron": 8, "Zinc": 9}


def test_snapshots_publish_and_roll_back(spark, tmp_path):
    s = sinks.Snapshots(spark, str(tmp_path / "t"))
    assert s.publish(spark.range(3)) == 1 and s.publish(spark.range(5)) == 2
    assert s.read().count() == 5 and s.rollback() == 1 and s.read().count() == 3


def test_conflict_policies(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "C"), (3, "C2")], "k int, v string")
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(sinks.insert_ignore(old, new, ["k"], ["v"])) == [(1, "a"), (2, "b"), (3, "C")]
    assert rows(sinks.insert_replace(old, new, ["k"], ["v"])) == [(1, "a"), (2, "B"), (3, "C")]
    assert rows(sinks.update_by_key(old, spark.createDataFrame([(2, None), (1, "z")], "k int, v string"), "k")) == [(1, "z"), (2, "b")]
    assert rows(sinks.delete_where(spark.createDataFrame([(1, None), (2, "x")], "k int, v string"), F.col("v") == "x")) == [(1, None)]


XML = """<Set><PubmedArticle><MedlineCitation><PMID>1</PMID><Article><Journal><JournalIssue><PubDate><Year>2020</Year><Month>Mar</Month><Day>7</Day></PubDate></JournalIssue><Title>J</Title></Journal>
<ArticleTitle>On <i>zinc</i></ArticleTitle><Abstract><AbstractText Label="AIM">To <b>see</b>.</AbstractText><AbstractText>Seen.</AbstractText></Abstract></Article>
<MeshHeadingList><MeshHeading><DescriptorName>Zinc</DescriptorName></MeshHeading></MeshHeadingList><KeywordList><Keyword>Zinc</Keyword><Keyword>diet</Keyword></KeywordList></MedlineCitation>
<PubmedData><ArticleIdList><ArticleId IdType="doi">10.1/x</ArticleId><ArticleId IdType="pmc">PMC9</ArticleId></ArticleIdList></PubmedData></PubmedArticle>
<PubmedArticle><MedlineCitation><PMID>2</PMID><Article><Journal><JournalIssue><PubDate><Year>1999</Year></PubDate></JournalIssue><ISOAbbreviation>K</ISOAbbreviation></Journal><ArticleTitle></ArticleTitle></Article></MedlineCitation></PubmedArticle></Set>"""


def test_articles(spark, tmp_path):
    (tmp_path / "a.xml").write_text(XML)
    a, b = sorted(articles.read_articles(spark, str(tmp_path / "*.xml")).collect(), key=lambda r: r.pmid)
    assert (a.title, a.abstract, a.journal, a.publication_date, a.doi, a.pmc_id, a.keywords) == ("On zinc", "AIM: To see.\nSeen.", "J", "2020-03-07", "10.1/x", "PMC9", ["Zinc", "diet"])
    assert (b.title, b.abstract, b.journal, b.publication_date, b.doi) == ("No title available", None, "K", "1999", None)


def test_config_merge(tmp_path):
    (tmp_path / "base.json").write_text(json.dumps({"a": {"x": 1, "y": 2}, "b": 3}))
    (tmp_path / "own.json").write_text(json.dumps({"_base": "base.json", "a": {"y": 5}}))
    assert articles.read_config(str(tmp_path / "own.json")) == {"a": {"x": 1, "y": 5}, "b": 3}


def test_body_text(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<x><body><p>One <i>two</i></p><p>three</p></body></x>")
    (tmp_path / "b.xml").write_text("<x>plain</x>")
    assert {r.file: r.text for r in articles.read_body(spark, str(tmp_path)).collect()} == {"a.xml": "One two\nthree", "b.xml": "plain"}


def test_stream_equals_batch(spark, tmp_path):
    events = spark.range(200).select(F.col("id").alias("event_id"), (F.timestamp_seconds(F.col("id") * 3000)).alias("ts"), (F.col("id") % 5).alias("user_id"), F.when(F.col("id") % 2 == 0, "view").otherwise("buy").alias("event_type"), (F.col("id") * 1.0).alias("value"), F.lit("{}").alias("props"))
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    q = run_available(outcome_windows(read_events(spark, str(tmp_path / "in"))), "windows", str(tmp_path / "cp"), "complete")
    q.awaitTermination(60)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(spark.table("windows")) == rows(outcome_windows(events))


def test_running_counts(spark):
    r = evidence_counts(edges(spark, [("a", "x", "m", "improves", 0.8, 2000), ("a", "x", "m", "worsens", 0.4, 2000)])).first()
    assert (r.pos, r.neg, r.n) == (1, 1, 2)


def test_numbers_are_consecutive_in_order(spark):
    from evigraph.operators.numbering import numbered

    rows = [(f"k{(i * 37) % 101:03d}", i) for i in range(101)]
    got = sorted((r.n, r.k) for r in numbered(spark.createDataFrame(rows, "k string, i int").repartition(7), ["k"]).collect())
    assert got == [(i + 1, f"k{i:03d}") for i in range(101)]
    assert numbered(spark.createDataFrame([], "k string"), ["k"]).count() == 0


def test_walks_up_are_bounded(spark):
    tree = spark.createDataFrame([(i, i - 1 if i else None) for i in range(6)] + [(50, 51), (51, 50)], "id bigint, parent bigint")
    got = {r.id: r.depth for r in cl.ancestor_depth(tree, 4).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 50: 4, 51: 4}


def test_cycles_and_the_merge_transaction(spark, tmp_path):
    tree = spark.createDataFrame([(1, None, 0), (2, 1, 1), (3, 1, 1), (4, 2, 2), (5, 6, 2), (6, 5, 3)], "cluster_id bigint, parent_id bigint, level int")
    found = {(r.cluster_id, r.problem) for r in cl.hierarchy_problems(tree).collect()}
    assert found == {(5, "level"), (5, "cycle"), (6, "cycle")}
    kept, members = (sinks.Snapshots(spark, str(tmp_path / n)) for n in ("tree", "members"))
    kept.publish(tree.filter("cluster_id < 5"))
    members.publish(spark.createDataFrame([(10, 2), (11, 3), (12, 3), (11, 2)], "member bigint, cluster_id bigint"))
    merges = lambda *rows: spark.createDataFrame(rows, "a bigint, b bigint, relation string")
    assert not cl.merge_transaction(kept, members, merges((99, 2, "identical"))) and (kept.versions(), members.versions()) == ([1], [1])
    assert cl.merge_transaction(kept, members, merges((2, 3, "identical"))) and (kept.versions(), members.versions()) == ([1, 2], [1, 2])
    assert sorted(tuple(r) for r in members.read().collect()) == [(10, 2), (11, 2), (12, 2)]


def test_opposites_conflict_with_themselves_and_others(spark):
    rows = [(1, "IBS ", "a", "Gluten-free diet", "improves"), (1, "ibs", "b", "wheat", "improves"), (1, "ibs", "c", "wheat", "worsens"), (2, "ibs", "d", "low fat", "worsens"), (2, "ibs", "e", "high-fat", "no_effect")]
    got = mining.opposite_conflicts(spark.createDataFrame(rows, "paper_id bigint, target string, study_id string, name string, outcome string"))
    assert {(r.paper_id, r.pair, r["without"], r["with"], r.type) for r in got.collect()} == {(1, 0, "a", "a", "both_positive"), (1, 0, "a", "b", "both_positive")}


def test_a_document_is_replaced_whole(spark, tmp_path):
    path = str(tmp_path / "x.json")
    for n in (1, 2, 3):
        sinks.write_json_document(spark.range(n), path, ["id"])
    assert json.loads((tmp_path / "x.json").read_text()) == [{"id": 0}, {"id": 1}, {"id": 2}]
    assert json.loads((tmp_path / "x.json.bak").read_text()) == [{"id": 0}, {"id": 1}] and not list(tmp_path.glob("*draft*"))
    with pytest.raises(ValueError):
        sinks.write_json_document(spark.range(3), path, ["id"], most=2)


def test_recommendations_use_every_channel(spark):
    from evigraph.operators import recommend as rc

    e = edges(spark, [("a", "x", "m1", "improves", 0.8, 2000), ("a", "x", "m2", "improves", 0.8, 2000), ("b", "y", "m1", "improves", 0.8, 2000), ("c", "x", "m3", "worsens", 0.8, 2000)])
    similar = spark.createDataFrame([("x", "y")], "a string, b string")
    failed, wide, pairs = (spark.createDataFrame(rows, t) for rows, t in (([("c",)], "source string"), ([("a", 3, 0.4)], "source string, mechanisms int, effect double"), ([("a", "c", 2.0), ("a", "b", 1.1)], "a string, b string, lift double")))
    out = rc.recommendations(e, similar, failed, wide, pairs, least=0.0)
    got = {(r.target, r.source): r for r in out.collect()}
    assert sorted(got) == [("x", "a"), ("x", "b"), ("y", "a"), ("y", "b")]  # c failed
    r = got["x", "a"]  # direct 0.75, mechanism min(0.8, 2/2), fundamental 0.5, combination with c 0.5
    assert r.base_score == pytest.approx((0.75 + 0.8 * 0.7 + 0.5 * 0.9 + 0.5 * 0.8) / 3.4, abs=1e-6)
    assert (r.evidence_type, r.evidence_count, list(r.mechanisms)) == ("mechanism", 4, ["m1", "m2"]) and r.exploration_bonus == pytest.approx(0.25)
    peer = got["x", "b"]  # never tried on x, but on y
    assert (list(peer.peers), peer.evidence_count) == (["y"], 2) and peer.base_score == pytest.approx((0.5 * 0.7 + 0.8 * 2 / 3 * 0.6) / 1.3, abs=1e-6)
    assert rc.recommendation_problems(out).isEmpty()
    assert {r.target: (r.total, r.mechanisms) for r in rc.recommendation_diversity(out).collect()} == {"x": (2, 2), "y": (2, 1)}
    words = out.withColumn("w", rc.explanation()).filter("target = 'x' AND source = 'a'").first().w
    assert words.startswith("Promising emerging treatment with positive early results | Confidence: ") and words.endswith("Targets: m1, m2 | Exploration bonus: +25%")


def test_contradictions_of_recommendations(spark):
    from evigraph.operators import recommend as rc

    rows = [("x", "a", 1, 0.5, 0.9, 0.5, 3), ("x", "b", 2, 0.6, 0.6, 1.5, -1)]
    t = spark.createDataFrame(rows, "target string, source string, rank int, final_score double, base_score double, confidence double, evidence_count int")
    assert sorted((r.source, r.problem) for r in rc.recommendation_problems(t).collect()) == [("a", "final score under base score"), ("b", "invalid confidence"), ("b", "negative evidence count"), ("b", "not sorted by final score")]


def test_threshold_search_against_a_plain_simulation(spark):
    from evigraph.operators import hierarchies as hi

    rng = np.random.default_rng(3)
    base = rng.normal(size=(9, 6))
    rows = [(c, 10 * c + k, [float(x) for x in base[c // 2] + 0.4 * rng.normal(size=6)]) for c in range(9) for k in range(1 + c % 3)]
    members = spark.createDataFrame(rows, "cluster_id int, member bigint, vector array<double>")
    tried = ((0.2, 0.6, 0.8, 0.95),) * 3
    got = {(r.t3, r.t2, r.t1): r for r in hi.threshold_search(members, tried).collect()}
    assert len(got) == 64

    def cos(u, v):
        return min(1.0, max(0.0, float(np.dot(u, v) / (np.linalg.norm(u) * np.linalg.norm(v)))))

    for steps, r in got.items():
        now = [[v for c, _, v in rows if c == k] for k in range(9)]
        for t in steps:
            pairs = [(-cos(np.mean(now[i], axis=0), np.mean(now[j], axis=0)), i, j) for i in range(len(now)) for j in range(i + 1, len(now))]
            gone, merged = set(), {}
            for s, i, j in sorted(pairs):
                if -s >= t and i not in gone and j not in gone:
                    gone |= {i, j}
                    merged[i] = now[i] + now[j]
            now = [merged.get(i, c) for i, c in enumerate(now) if i in merged or i not in gone]
        inside = [np.mean([cos(c[i], c[j]) for i in range(len(c)) for j in range(i + 1, len(c))]) for c in now if len(c) > 1]
        assert (r.initial_count, r.final_count, r.max_size) == (9, len(now), max(map(len, now)))
        assert r.coherence == pytest.approx(float(np.mean(inside)), abs=1e-6)
    assert len({r.final_count for r in got.values()}) > 1
    best = hi.threshold_search(members, tried).first()
    assert best.composite_score == max(r.composite_score for r in got.values())
    assert best.composite_score == best.reduction_score + best.depth_score + best.size_score + best.coherence_score + best.separation_score


def test_threshold_search_in_blocks(spark):
    """No number of members is refused, as a task has two blocks of them at most."""
    from evigraph.operators import hierarchies as hi

    rng = np.random.default_rng(5)
    base = rng.normal(size=(9, 6))
    rows = [(c, 10 * c + k, [float(x) for x in base[c // 2] + 0.4 * rng.normal(size=6)]) for c in range(9) for k in range(1 + c % 3)]
    members = spark.createDataFrame(rows, "cluster_id int, member bigint, vector array<double>")
    tried = ((0.2, 0.95), (0.2, 0.9), (0.95,))
    got, some = ({(r.t3, r.t2, r.t1): r for r in hi.threshold_search(members, tried, **sizes).collect()} for sizes in ({}, {"block": 4, "clusters": 2}))
    assert len(got) == 4 and len({r.final_count for r in got.values()}) > 1
    for k, r in got.items():
        assert tuple(some[k]) == pytest.approx(tuple(r), abs=1e-9)



def test_coherence_in_blocks(spark, monkeypatch):
    from evigraph.operators import hierarchies as hi

    monkeypatch.setattr(hi, "BLOCK", 7)
    rng = np.random.default_rng(5)
    v = rng.normal(size=(40, 5))
    members = spark.createDataFrame([(i % 2 if i else 9, i, [float(x) for x in v[i]]) for i in range(40)], "cluster_id int, member bigint, vector array<double>")
    u = v / np.linalg.norm(v, axis=1, keepdims=True)
    s = np.clip(u @ u.T, 0, 1)
    want = {c: np.mean([s[i, j] for i in range(1, 40) for j in range(i + 1, 40) if i % 2 == c == j % 2]) for c in (0, 1)}
    assert {r.cluster_id: pytest.approx(r.coherence) for r in hi.coherence(members).collect()} == want


def test_condition_clusters_cut_a_ward_tree_of_similarities(spark):
    from evigraph.operators import conditions as cn

    names = ["a1", "a2", "b1", "b2", "c"]
    near = [("a1", "a2", 0.9), ("b1", "b2", 0.8)]
    got = cn.condition_clusters(spark.createDataFrame(near, "a string, b string, similarity double"), spark.createDataFrame([(n,) for n in names], "target string"))
    of = {r.target: r.cluster for r in got.collect()}
    assert of["a1"] == of["a2"] != of["b1"] == of["b2"]
    only = cn.condition_clusters(spark.createDataFrame([], "a string, b string, similarity double"), spark.createDataFrame([], "target string"))
    assert only.count() == 0


def test_cluster_description(spark):
    from evigraph.operators import conditions as cn

    e = edges(spark, [("t", "x", "inflammation", "improves", 0.9, 2000), ("t", "y", "inflammation", "improves", 0.9, 2000), ("u", "x", "metabolic", "worsens", 0.3, 2000)])
    r = cn.describe_clusters(e, spark.createDataFrame([("x", 1), ("y", 1), ("z", 1)], "target string, cluster int")).first()
    assert (r.conditions, list(r.common), r.dominant, r.name) == (3, ["t"], "inflammation", "Inflammatory")
    assert r.success == pytest.approx((2 / 3 + 2 / 3 + 0.5) / 3) and [p.mechanism for p in r.profile] == ["inflammation"]


def test_discoveries_feasibility_and_functions(spark):
    from evigraph.operators import conditions as cn

    rows = [("IBS", "low mood", []), ("depression", "psoriasis", []), ("pcos", "stress", []), ("a", "b", ["metabolic", "stress_response"]), ("a", "b", ["pain"])]
    t = spark.createDataFrame(rows, "a string, b string, m array<string>")
    kinds = [r[0] for r in t.select(cn.discovery_type(F.col("a"), F.col("b"), F.col("m"))).collect()]
    assert kinds == ["gut_brain_axis", "inflammation_mood_connection", "metabolic_mental_health", "metabolic_stress_axis", "novel_biological_connection"]
    s = spark.createDataFrame([("gene_therapy",), ("exercise",), ("zinc",)], "s string")
    assert [r[0] for r in s.select(cn.feasibility(F.col("s"))).collect()] == [0.3, 0.9, 0.6]
    who = spark.createDataFrame([("Yoga", ["ibs"], ["immune"]), ("zinc", ["pain"], [])], "source string, conditions array<string>, mechanisms array<string>")
    assert {r.source: list(r.functions) for r in cn.body_functions(who).collect()} == {"Yoga": ["inflammation", "microbiome_regulation", "stress_response"], "zinc": []}


def test_pattern_report(spark):
    rows = [(f"probiotic_{i}" if i < 5 else f"zinc_{i}", f"c{j}", "m", "improves" if (i < 5) == (j < 5) else "worsens", 0.5 + 0.02 * (i + j), 2000) for i in range(10) for j in range(10)]
    got = mining.pattern_report(edges(spark, rows), 2, rounds=10).collect()
    assert [r.pattern for r in got] == [0, 1] and all(r.strength > 0.1 for r in got)
    assert {r.name for r in got} <= {"Gut Microbiome", "Zinc Mechanism"} and all(r.valid == (r.conditions >= 3 and r.interventions >= 3 and r.confidence > 0.2) for r in got)


def test_extraction_from_answers(spark):
    from evigraph.operators import exports as ex

    one = '{"study_id": "%s", "source": "zinc %s", "target": "colds", "mechanism": "immune cells respond", "outcome": "%s", "confidence": %s, "sample_size": 40}'
    rows = [
        (1, "<think>[]</think>```json\n[" + one % ("a", "x", "improves", 0.5) + "," + one % ("b", "x", "worsens", 0.9) + "]\n```"), (2, "[" + one % ("c", "y", "improves", 0.7) + ",]"),
        (3, "nothing"), (4, None), (5, "[" + one % ("d", "z", "better", 0.7) + "]"), (6, "[]"),
    ]
    answers = spark.createDataFrame(rows, "paper_id bigint, answer string")
    found = {(r.paper_id, r.study_id): r.valid for r in ex.extract_records(answers, "paper_id", "answer").collect()}
    assert found == {(1, "a"): True, (1, "b"): True, (2, "c"): True, (5, "d"): False}
    old = spark.createDataFrame([(1, "zinc x", "colds", "old"), (9, "zinc x", "colds", "old")], "paper_id bigint, source string, target string, outcome string")
    with_id = old.withColumn("study_id", F.lit("o")).withColumn("confidence", F.lit(0.0))
    got = sorted((r.paper_id, r.outcome) for r in ex.save_extracted(with_id, answers, "paper_id", "answer", ["paper_id", "source", "target"]).collect())
    assert got == [(1, "worsens"), (2, "improves"), (9, "old")]


def test_exports_keep_records_without_a_paper(spark):
    from evigraph.operators import exports as ex

    e = edges(spark, [("a", "x", "", "inconclusive", 0.5, 2000), ("b", "x", "m", "improves", 0.5, 2000)])
    papers = spark.createDataFrame([(1, "t", "j", "2001-05", None)], "pmid bigint, title string, journal string, publication_date string, doi string")
    got = {r.intervention: r for r in ex.enhanced_export(e, papers).collect()}
    assert (got["a"].correlation, got["a"].mechanism, got["a"].publication_year, got["a"].paper.pubmed_url) == ("unsure", None, None, None)
    assert (got["b"].publication_year, got["b"].paper.pubmed_url) == (2001, "https://pubmed.ncbi.nlm.nih.gov/1/")
    assert ex.basic_export(e, papers).count() == 2 and ex.export_summary(e.limit(0)).first().total == 0


def test_ratio_by_bits_against_the_table(spark):
    from evigraph.functions.text import _ratio

    rng = np.random.default_rng(2)
    for _ in range(300):
        a, b = ("".join(rng.choice(list("abcé"), rng.integers(0, 12))) for _ in range(2))
        row = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                row[i + 1][j + 1] = row[i][j] + 1 if x == y else max(row[i][j + 1], row[i + 1][j])
        want = 2 * row[-1][-1] / (len(a) + len(b)) if a or b else 1.0
        assert _ratio(a, b) == want
