import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from evigraph.llm import jaccard_join as jj
from evigraph.llm.components import components


def brute(rows, size, num, den):
    sets = {i: jj._shingles(t or "", size) for i, t in rows}
    boss = {i: i for i in sets}

    def top(x):
        while boss[x] != x:
            x = boss[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if den * shared >= num * (len(sets[a]) + len(sets[b]) - shared):
                    p, q = sorted((top(a), top(b)))
                    boss[q] = p
    return {i: (len(sets[i]), top(i)) for i in ids}


@pytest.mark.parametrize(("size", "num", "den"), [(3, 9, 10), (5, 4, 5), (1, 1, 2)])
def test_against_brute_force(spark, size, num, den, monkeypatch):
    monkeypatch.setattr(jj, "BLOCK", 4)
    monkeypatch.setattr(jj, "CHAIN", 3)
    rng = random.Random(size)
    vocab = [f"w{i}" for i in range(300)]
    rows = []
    for family in range(6):
        base = [rng.choice(vocab) for _ in range(rng.choice([1, 2, 4, 12, 40, 150]))]
        for _ in range(14):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            rows.append((len(rows), rng.choice([" ", "  ", "\n"]).join(copy).upper() if family % 2 else " ".join(copy)))
    passage = " ".join(rng.choice(vocab) for _ in range(60))
    rows += [(len(rows) + k, passage + " " + " ".join(rng.choice(vocab) for _ in range(20))) for k in range(25)]
    rows += [(1000, None), (1001, ""), (1002, " \n")]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jj.link(spark.createDataFrame(rows, "doc_id bigint, text string"), size, (num, den)).collect()}
    assert got == brute(rows, size, num, den)


@settings(max_examples=80, deadline=None)
@given(st.sets(st.integers(0, 10**6), min_size=1, max_size=80), st.sets(st.integers(0, 10**6), max_size=6), st.integers(0, 6), st.sampled_from([(9, 10), (4, 5), (1, 2)]))
def test_similar_sets_share_a_segment_and_distance_is_a_lower_bound(base, more, less, ratio):
    num, den = ratio
    a, b = set(base), (set(base) - set(sorted(base)[:less])) | more
    if not b:
        return
    x, y = (np.unique(np.array(sorted(s), np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for s in (a, b))
    assert jj.hamming(jj.parity_sketch(x, num, den), jj.parity_sketch(y, num, den)) <= len(a ^ b)
    if a != b and den * len(a & b) >= num * len(a | b):
        assert len(a ^ b) <= jj.most_apart(len(a), len(b), num, den)
        assert meet(keys(x, num, den), keys(y, num, den))


def keys(own, num, den):
    return jj.segment_keys([own], num, den)[0]


def test_keys_of_many_sets_are_those_of_each():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 2**63, n, dtype=np.int64).astype(np.uint64)) for n in [0, 1, 3, 700, 0, 12, 60, 5, 2500, 1, 0]]
    for num, den in ((9, 10), (4, 5)):
        found, at = jj.segment_keys(sets, num, den)
        assert [sorted(found[a:b].tolist()) for a, b in zip(at, at[1:], strict=False)] == [sorted(keys(s, num, den).tolist()) for s in sets]
    assert len(jj.segment_keys([], 4, 5)[0]) == 0


def meet(x, y):
    """They share a bucket with a member of the bucket's own band."""
    x, y = ({k >> 1: k & 1 for k in keys.tolist()} for keys in (x, y))
    return any(x[k] | y[k] for k in x.keys() & y.keys())


@pytest.mark.parametrize(("num", "den"), [(9, 10), (4, 5), (1, 2)])
def test_the_least_similar_sets_meet_and_strangers_seldom(num, den):
    rng = np.random.default_rng(num)
    met = tried = 0
    for size in rng.integers(1, 1500, 150).tolist():
        base = rng.integers(0, 2**63, size, dtype=np.int64).astype(np.uint64)
        other = rng.integers(0, 2**63, size, dtype=np.int64).astype(np.uint64)
        for kept in range(-(-size * num // den), size + 1, max(1, size // 20)):
            a, b = np.unique(base), np.unique(base[:kept])  # a subset of the least size that is similar, and larger ones
            assert len(a) == len(b) or meet(keys(a, num, den), keys(b, num, den))
        met += size > 100 and meet(keys(np.unique(base), num, den), keys(np.unique(other), num, den))
        tried += size > 100
    assert num / den < 0.8 or met <= tried / 20


def test_the_filter_passes_all_keys_that_it_lists(spark):
    rng = np.random.default_rng(0)
    keys = rng.integers(-(2**63), 2**63 - 1, 5000, dtype=np.int64)
    listed = keys[:2000] >> 1
    words = jj._filter(spark.createDataFrame([(int(k),) for k in listed], "key bigint"))
    passed = jj._listed(keys, words)
    assert passed[:2000].all() and passed.sum() < 2600
    assert not jj._listed(keys, np.zeros(1024, np.int64)).any()


@pytest.mark.parametrize("words", [0, 1, 2, 3, 4, 5])
def test_a_single_short_document(words):
    text = " ".join(f"w{k}" for k in range(words))
    alone = jj.shingle_hashes([text.encode()], 5)
    among = jj.shingle_hashes([text.encode(), b"a b c d e f g h"], 5)
    assert len(alone) == 1 and alone[0].tolist() == among[0].tolist() and len(alone[0]) == min(words, 1)


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(0, 40)] + [(100, 90), (90, 95)], "a bigint, b bigint")
    got = {r.node: r.component for r in components(links, "a", "b").collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 95: 90, 100: 90}


def test_edges(edge_docs, no_docs):
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jj.link(edge_docs).filter("doc_id IS NOT NULL").collect())
    parts = {(i, c) for i, _, c in got}
    assert {(1, 1), (2, 1), (8, 1), (3, 3), (4, 4), (5, 5), (6, 6), (7, 7), (9, 9), (10, 10)} == parts
    assert len(got) == 12 and jj.link(no_docs).count() == 0
    assert [r.component_id for r in jj.link(edge_docs).filter("doc_id IS NULL").collect()] == [None]
