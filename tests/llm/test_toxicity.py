import random
import re

import numpy as np

from evigraph.llm import toxicity as tx

RUDE = ["idiot", "moron", "scum"]


def made(n, seed=0, biased=False):
    rng = random.Random(seed)
    vocab = [f"word{i}" for i in range(200)]
    rows = []
    for i in range(n):
        toxic = rng.random() < 0.3
        w = [rng.choice(vocab) for _ in range(rng.randint(3, 40))]
        if toxic:
            w[rng.randrange(len(w))] = rng.choice(RUDE)
        if biased and (toxic or rng.random() < 0.02):
            w += ["muslims"]
        rows.append((i, " ".join(w), int(toxic)))
    return rows


def frames(spark, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string, label int")
    return df.select("doc_id", "text"), df.select("doc_id", "label")


def test_held_out_accuracy(spark):
    docs, labels = frames(spark, made(1500))
    model = tx.fit(docs, labels.filter(~tx.held_out()))
    rows = tx.score(docs, model).join(labels, "doc_id").filter(tx.held_out()).collect()
    assert len(rows) > 200
    assert np.mean([(r.score >= 0.5) == (r.label == 1) for r in rows]) > 0.97


def test_counterfactual_penalty_frees_group_names(spark):
    rows = made(1200, 1, biased=True)
    x, y = tx.features([t.encode() for _, t, _ in rows]), np.array([v for _, _, v in rows])
    pairs = [p for _, t, _ in rows for p in tx.swaps(t)]
    neutral = tx.features([b"muslims word1 word2"])
    plain, fair = tx.train(x, y, []), tx.train(x, y, pairs, counterfactual=20.0)
    assert plain.scores(neutral)[0] > 0.5 > fair.scores(neutral)[0]
    assert fair.scores(tx.features([b"word1 idiot word2"]))[0] > 0.5


def brute_swaps(text, lists):
    """Features that go and come, from the whole sentence before and after each swap."""
    out = {}
    for sentence in re.split(r"(?<=[.!?\n])\s+", text.lower()):
        parts = re.split(r"(\w+)", sentence)
        for i in range(1, len(parts), 2):
            for terms in lists:
                for other in terms if parts[i] in terms else ():
                    if other != parts[i]:
                        a, b = (set(x.tolist()) for x in tx.features([sentence.encode(), "".join([*parts[:i], other, *parts[i + 1 :]]).encode()]))
                        change = tuple(sorted(a - b)), tuple(sorted(b - a))
                        out[change] = out.get(change, 0) + 1
    total = sum(out.values())
    return {k: round(n / total, 9) for k, n in out.items()}


def test_swaps_against_whole_sentences():
    rng = random.Random(5)
    lists = (("women", "men", "womenfolk"), ("asian", "african", "white"))
    vocab = ["we", "met", "womens", "women", "men", "asian", "Asian", "whites", "the", "home.", "stop!"]
    for _ in range(60):
        text = " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 60)))
        got = {(tuple(sorted(a.tolist())), tuple(sorted(b.tolist()))): round(x, 9) for a, b, x in tx.swaps(text, lists)}
        assert got == brute_swaps(text, lists)
    assert not tx.swaps("Nobody here.")
    many = tx.swaps("women " * 5000 + "are here. Later 40 asian people came.")  # no mention is left out of a long text
    assert abs(sum(x for *_, x in many) - 1) < 1e-9 and len(many) > 4


def test_gradient_against_differences():
    """The penalty's gradient in one step: without labels' pull, weights of swapped terms meet."""
    x = tx.features([b"women bad", b"men good", b"women bad", b"men good"] * 3)
    y = np.array([1, 0, 1, 0] * 3)
    pairs = [p for t in ("women bad", "men good") * 6 for p in tx.swaps(t, (("women", "men"),))]
    apart = lambda m: abs(float(m.weights[tx.features([b"women"])[0]].sum() - m.weights[tx.features([b"men"])[0]].sum()))
    free, held = tx.train(x, y, []), tx.train(x, y, pairs, counterfactual=50.0)
    assert apart(free) > 0.5 > 10 * apart(held) and (held.rows, held.swapped) == (12, 12) and held.swaps == len(pairs)


def test_edges(spark, edge_docs, no_docs):
    model = tx.fit(edge_docs.select("doc_id", "text"), spark.createDataFrame([(1, 0), (2, None), (99, 1)], "doc_id bigint, label int"))
    rows = tx.score(edge_docs, model, keep=("lang",)).collect()
    assert len(rows) == edge_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert tx.score(no_docs, tx.Model()).count() == 0
    assert {round(r.score, 6) for r in tx.score(edge_docs, tx.Model()).collect()} == {round(1 / (1 + np.exp(0.5)), 6)}
