"""Readers, clustering and searches that hold nothing whole, against plain versions."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from evigraph.operators import clusters as cl
from evigraph.operators import graph
from evigraph.sources import articles


def test_files_are_split_into_articles(spark, tmp_path):
    one = lambda k: f"<PubmedArticle><MedlineCitation><PMID>{k}</PMID><Article><ArticleTitle>T <i>{k}</i></ArticleTitle></Article></MedlineCitation></PubmedArticle>"
    (tmp_path / "a.xml").write_text("<PubmedArticleSet>\n" + "\n".join(one(k) for k in range(40)) + "\n</PubmedArticleSet>")
    (tmp_path / "b.xml").write_text(one(40) + "<PubmedArticle><MedlineCitation><PMID>99</PMID>")
    (tmp_path / "c.xml").write_text("no article")
    df = articles.read_articles(spark, str(tmp_path / "*.xml"))
    assert "wholetext" not in df._jdf.queryExecution().toString().lower()
    assert sorted((int(r.pmid), r.title) for r in df.collect()) == [(k, f"T {k}") for k in range(41)]
    none = articles.parse_articles(spark.createDataFrame([(None,)], "x string")).first()
    assert (none.pmid, none.title, none.keywords) == (None, None, None)


def test_clustering_with_hubs_and_repeated_links(spark):
    r = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in r.integers(0, 14, (90, 2))] + [(0, k) for k in range(14)] + [(k, 0) for k in range(14)] + [(1, 2)] * 3
    near = {v: {b for a, b in links if a == v and b != v} for v in range(14)}
    times = Counter(links)
    want = {v: (len(n), sum(times[x, y] for x in n for y in n if x != y) / (len(n) * (len(n) - 1)) if len(n) > 1 else 0.0) for v, n in near.items() if n}
    got = graph.clustering(spark.createDataFrame(links, "source int, target int")).collect()
    assert {x.node: (x.k, x.coefficient) for x in got} == want


def test_most_similar_by_blocks(spark):
    r = np.random.default_rng(4)
    v = r.normal(size=(60, 4))
    v[7] = v[3]
    v[9] = 0
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)] + [(90, None)], "i int, v array<double>").repartition(3)
    asked, points = df.filter("i % 3 = 0").select(F.col("i").alias("a"), F.col("v").alias("va")), df.select(F.col("i").alias("b"), F.col("v").alias("vb"))
    size = np.linalg.norm(v, axis=1)
    want = set()
    for a in range(0, 60, 3):
        s = [(-round(float(v[a] @ v[b] / (size[a] * size[b])), 6), b) for b in range(60) if b != a and size[a] and size[b]]
        want |= {(a, b, -x) for x, b in sorted(s)[:4] if -x >= 0.2}
    for sizes in ({}, {"rows": 7, "width": 11}):
        assert {(x.a, x.b, x.similarity) for x in cl.most_similar(asked, points, 4, 0.2, **sizes).collect()} == want
