import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from evigraph.llm import exact_topk as et


def brute(rows, k, is_query):
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, u in ok:
        if is_query(q):
            best = sorted((-sum(a * b for a, b in zip(u, w, strict=False)), i) for i, w in ok if i != q)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


@pytest.mark.parametrize("kind", ["normal", "ties", "sparse", "large"])
def test_against_brute_force(spark, kind, monkeypatch):
    monkeypatch.setattr(et, "CANDIDATE_BLOCK", 70)
    monkeypatch.setattr(et, "QUERY_BLOCK", 9)
    rng = np.random.default_rng(1)
    v = rng.normal(size=(300, 16))
    v = {"normal": v / np.linalg.norm(v, axis=1, keepdims=True), "ties": np.round(v), "sparse": v * (rng.random(v.shape) < 0.1), "large": v * 1e6}[kind]
    rows = [(i, [float(x) for x in u]) for i, u in enumerate(v)]
    rows += [(1000, None), (1001, [1.0, None] + [0.0] * 14), (1002, [float("nan")] * 16), (1003, [float("inf")] * 16), (1005, [])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted(map(tuple, et.top_k(df, F.col("vec_id") % 10 == 0).collect()))
    assert got == brute(rows, 5, lambda i: i % 10 == 0)


def test_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (None, [3.0]), (2, [2.0])], "vec_id bigint, embedding array<float>").withColumn("rank", F.lit("clash"))
    assert [tuple(r) for r in et.top_k(df, F.col("vec_id") == 0).orderBy("rank").collect()] == [(0, 1, 1, 131072), (0, 2, 2, 131072)]
    assert et.top_k(df.limit(0), F.col("vec_id") == 0).count() == 0


def test_proof_stops_early():
    rng = np.random.default_rng(0)
    v = rng.normal(size=(2000, 32)) * 10
    v[:5] *= 50
    index = et.ImpactIndex(np.floor(v))
    found = index.search(np.floor(v[:3]), 3, np.zeros((3, 2000), bool))
    for q, rows in zip(np.floor(v[:3]), found, strict=True):
        best = np.argsort(-(np.floor(v) @ q))[:3]
        assert set(best) <= set(rows.tolist()) and len(rows) < 2000

    near = np.floor(rng.normal(size=32) * 400 + rng.normal(size=(10, 32)) * 5)
    index = et.ImpactIndex(np.concatenate([near, np.floor(v[5:])]))
    found = index.search(near[:3], 3, np.zeros((3, len(index.vectors)), bool))
    assert index.processed < index.offered and all(set(np.argsort(-(index.vectors @ q))[:3]) <= set(rows.tolist()) for q, rows in zip(near, found, strict=False))


def test_no_slower_than_a_plain_product():
    """On vectors that allow no early stop: of the order of a product with a selection."""
    rng = np.random.default_rng(3)
    v = np.floor(256 * rng.normal(size=(8192, 64)) / 8)
    q, own, index = v[:256], np.zeros((256, 8192), bool), et.ImpactIndex(v)

    def seconds(f):
        best = 9e9
        for _ in range(5):
            began = time.perf_counter()
            f()
            best = min(best, time.perf_counter() - began)
        return best

    plain = seconds(lambda: np.argpartition(q @ v.T, 8192 - 5, axis=1)[:, -5:])
    assert seconds(lambda: index.search(q, 5, own)) < 8 * plain + 0.05
