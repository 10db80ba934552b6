import os
from collections import Counter
from math import log

import numpy as np
import pytest
from pyspark.sql import functions as F

from evigraph.llm import language_id as li
from evigraph.llm import queries as q

SF = "/root/testdata/sf0.01"


def spelled(text):
    """Trigrams of a text in plain Python."""
    flat = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    padded = " " + " ".join(flat) + " "
    return [padded[i : i + 3] for i in range(len(padded) - 2)] if flat else []


def bucket(gram):
    mixed = sum(ord(c) * int(f) for c, f in zip(gram, (li._A, li._B, li._C), strict=True)) % 2**32
    mixed ^= mixed >> 15
    return mixed * 0x2C1B3C6D % 2**32 >> 16


TEXTS = ["", "a", "...", " a.b ", "Don't stop!", "x--y  z", "ÉCOLE été", "日本 語", "1 2 3", "İΣ", "tail. ", "\0a\0\0b", "😀 a", "the end"]


def test_trigrams_against_plain_python():
    got, sizes = li.trigrams(TEXTS)
    lowered = [spelled(t) for t in TEXTS]
    assert sizes.tolist() == [len(g) for g in lowered]
    # spaces go by code point 32
    assert got.tolist() == [bucket(g) for t in lowered for g in t]
    assert li.trigrams([])[1].tolist() == []


def toy_model(seed=0, languages=3):
    r = np.random.default_rng(seed)
    return li.Model.of({f"l{k}": r.integers(0, 60, li.BUCKETS) * (r.random(li.BUCKETS) < 0.4) for k in range(languages)})


def plain_em(p, c, use, rounds=3000):
    pi = [1 / len(use) if k in use else 0.0 for k in range(p.shape[1])]
    for _ in range(rounds):
        new = [0.0] * len(pi)
        for row, n in zip(p, c, strict=True):
            s = sum(a * b for a, b in zip(pi, row, strict=True))
            for k in use:
                new[k] += n * pi[k] * row[k] / s
        pi = [x / sum(new) for x in new]
    return pi, sum(n * log(sum(a * b for a, b in zip(pi, row, strict=True))) for row, n in zip(p, c, strict=True))


def test_mixtures_against_plain_search():
    """The selected set has the greatest penalised likelihood of all sets, by plain expectation maximisation on each."""
    from itertools import combinations

    model, r = toy_model(), np.random.default_rng(1)
    shares = [(1, 0, 0), (0.5, 0.5, 0), (0, 0.3, 0.7), (0.34, 0.33, 0.33), (0, 1, 0)]
    drawn = []
    for s in shares:
        n = r.multinomial(90, s)
        drawn.append(np.concatenate([r.choice(li.BUCKETS, k, p=model.chances[:, j].astype(float) / model.chances[:, j].sum(dtype=float)) for j, k in enumerate(n)]))
    pi, score = li.mixtures(model, np.concatenate(drawn).astype(np.uint32), np.array([90] * len(drawn)))
    for row, got, own in zip(drawn, pi, score, strict=True):
        cell, n = np.unique(row, return_counts=True)
        p, c = model.chances[cell].astype(float), n / 3
        worth = {}
        for k in (1, 2, 3):
            for use in combinations(range(3), k):
                worth[use] = plain_em(p, c, use, 1 if k == 1 else 300)[1] - (k - 1) * log(90) / 2
        chosen = tuple(np.flatnonzero(got))
        assert worth[chosen] >= max(worth.values()) - 0.02
        if len(chosen) > 1:
            assert np.allclose(got, plain_em(p, c, chosen, 300)[0], atol=0.03)
            assert own == got.max()
    assert (pi[0] > 0).sum() == 1 and (pi[1] > 0).sum() == 2


def test_mixed_and_odd_texts(spark, edge_docs, no_docs):
    english = "the quick brown fox jumps over the lazy dog and runs away from the old house with all of them "
    german = "der schnelle braune fuchs springt über den faulen hund und läuft dann zurück in das alte haus "
    rows = [(1, english * 3, "en"), (2, german * 3, "de"), (3, None, "fr"), (4, "some words", None)]
    train = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = li.fit(train)
    assert model.languages == ["de", "en"]
    counts = Counter(bucket(g) for g in spelled(english * 3))
    table = np.array([counts.get(b, 0) for b in range(li.BUCKETS)]) + li.ALPHA
    assert np.allclose(model.chances[:, 1], table / table.sum() * li.BUCKETS, rtol=1e-5)
    asked = spark.createDataFrame([(1, english), (2, german), (3, english + german), (4, None), (5, "12 ..."), (1, german * 4000)], "doc_id bigint, text string")
    got = [(r.doc_id, r.lang_pred, len(r.languages), r.score) for r in li.identify(asked, model).collect()]
    mixed = next(g[1] for g in got if g[0] == 3)
    assert sorted(g[:3] for g in got) == [(1, "de", 1), (1, "en", 1), (2, "de", 1), (3, mixed, 2), (4, "und", 0), (5, "und", 0)]
    assert all(0 <= g[3] <= 1 for g in got) and [g[3] for g in got if g[1] == "und"] == [0.0, 0.0]
    clash = edge_docs.withColumns({"lang_pred": F.lit(1), "languages": F.lit("x")})
    found = {(r.doc_id, r.lang_pred) for r in li.identify(clash, li.fit(clash)).collect()}
    assert {(3, "und"), (4, "und"), (5, "und")} <= found and {x for i, x in found if i == 1} == {"en"}
    nothing = li.fit(no_docs)
    assert nothing.languages == [] and {r.lang_pred for r in li.identify(edge_docs, nothing).collect()} == {"und"}
    assert li.identify(no_docs, model).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
def test_held_out_accuracy(spark):
    truth = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = q.op13_language_id(spark, SF)
    assert got.count() == truth.count()
    held = got.join(truth, "doc_id").filter("held_out AND lang_pred <> 'und'")
    assert held.filter("lang = lang_pred").count() >= 0.99 * held.count() > 150
