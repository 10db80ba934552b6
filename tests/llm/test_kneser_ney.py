import math
import random
from collections import Counter, defaultdict

import pytest

from evigraph.llm import kneser_ney as kn


def brute(docs, trusted):
    """The same model by dictionaries, for each language."""
    out = {}
    for lang in {d[2] for d in docs}:
        rows = [d for d in docs if d[2] == lang]
        units = {i: (2, 2, 2, *[int.from_bytes(t.encode("utf-16-le")[k : k + 2], "little") for k in range(0, len(t.encode("utf-16-le")), 2)]) for i, t, _ in rows}
        count = {4: Counter(u[k : k + 4] for i, u in units.items() if i in trusted for k in range(len(u) - 3))}
        for k in (3, 2, 1):
            count[k] = Counter(g[1:] for g in count[k + 1])
        cut, total, kinds = {}, {}, {}
        for k, c in count.items():
            r = Counter(c.values())
            y = r[1] / max(r[1] + 2 * r[2], 1)
            cut[k] = {i: (min(max(i - (i + 1) * y * r[i + 1] / r[i], 0.05), i - 0.05) if r[i] else 0.5 * i) for i in (1, 2, 3)}
            total[k], kinds[k] = Counter(), defaultdict(Counter)
            for g, n in c.items():
                total[k][g[:-1]] += n
                kinds[k][g[:-1]][min(n, 3)] += 1

        def p(g, count=count, cut=cut, total=total, kinds=kinds):
            k = len(g)
            if k == 0:
                return 1 / kn.UNITS
            h = g[:-1]
            lower = p(g[1:])
            if not total[k][h]:
                return lower
            n = count[k][g]
            d = cut[k][min(n, 3)] if n else 0
            rest = sum(cut[k][i] * m for i, m in kinds[k][h].items()) / total[k][h]
            return max(n - d, 0) / total[k][h] + rest * lower

        for i, u in units.items():
            n = len(u) - 3
            out[i] = math.exp(-sum(math.log(p(u[k : k + 4])) for k in range(n)) / n) if n else None
    return out


@pytest.mark.parametrize("rows_in_broadcast", [0, 10**6])
def test_perplexities_against_brute_force(spark, rows_in_broadcast, monkeypatch):
    monkeypatch.setattr(kn, "CHUNK", 400)
    rng = random.Random(1)
    docs = [(i, "".join(rng.choice("aab cé😀") for _ in range(rng.choice([0, 1, 5, 60]))), rng.choice(["en", "fr"])) for i in range(40)]
    trusted = {i for i in range(0, 40, 2)}
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    got = {r.doc_id: r.perplexity for r in kn.score(df, spark.createDataFrame([(i,) for i in trusted], "doc_id bigint"), broadcast_grams=rows_in_broadcast).collect()}
    want = brute(docs, trusted)
    assert got.keys() == want.keys()
    assert all(got[i] is None if want[i] is None else got[i] == pytest.approx(want[i], rel=1e-9) for i in want)


def test_probabilities_of_a_context_sum_to_one(spark):
    counts = Counter()
    for text in ("abracadabra", "banana bandana", "cabana"):
        counts.update(kn.grams(text).tolist())
    seen = max(counts, key=counts.get) >> 16
    asked = {(seen << 16) | u: counts.get((seen << 16) | u, 0) for u in range(1, 300)} | dict(counts)
    p = kn.probabilities(spark.createDataFrame([("en", k, n) for k, n in asked.items()], "lang string, key bigint, c bigint")).collect()
    own = [r.p for r in p if r.key >> 16 == seen]
    least = min(own)
    assert sum(own) + (kn.UNITS - len(own)) * least == pytest.approx(1.0, abs=1e-6)


def test_rejects_junk_and_keeps_clean(spark):
    rng = random.Random(2)
    vocab = ["the", "of", "river", "stone", "garden", "walked", "slowly", "into", "morning", "light"]
    docs = [(i, " ".join(rng.choice(vocab) for _ in range(40)), "en") for i in range(200)] + [(1000 + i, "".join(rng.choice("#%$@!^&*zqxj0123") for _ in range(150)), "en") for i in range(10)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    got = {r.doc_id: r.keep for r in kn.judge(df, spark.createDataFrame([(i,) for i in range(0, 200, 2)], "doc_id bigint")).collect()}
    assert not any(got[1000 + i] for i in range(10)) and sum(got[i] for i in range(200)) >= 195


def test_odd_trusted_texts_do_not_set_the_threshold(spark):
    rng = random.Random(3)
    vocab = ["the", "of", "river", "stone", "garden", "walked", "slowly", "into", "morning", "light"]
    junk = lambda n: "".join(rng.choice("theofrivsngadwlkyum ") for _ in range(n))
    good = [(i, " ".join(rng.choice(vocab) for _ in range(40)), "en") for i in range(300)]
    odd = [(300 + i, chr(0x4E00 + i), "en") for i in range(3)]  # very short texts, but labelled good
    bad = [(1000 + i, junk(100), "en") for i in range(40)]
    df = spark.createDataFrame(good + odd + bad, "doc_id bigint, text string, lang string")
    trusted = spark.createDataFrame([(i,) for i in range(0, 303, 2)] + [(301,)], "doc_id bigint")
    labelled = spark.createDataFrame([(i, 1) for i in range(1, 201, 2)] + [(1000 + i, 0) for i in range(20)], "doc_id bigint, quality int")
    junk_kept = lambda rows: sum(r.keep for r in rows if r.doc_id >= 1020)
    told = kn.judge(df, trusted, labelled=labelled).collect()
    assert junk_kept(told) == 0 < junk_kept(kn.judge(df, trusted).collect())
    assert sum(r.keep for r in told if 201 <= r.doc_id < 300) >= 95 and len({r.threshold for r in told}) == 1


def test_edges(spark, edge_docs, no_docs):
    trusted = spark.createDataFrame([(1,), (None,), (1,)], "doc_id bigint")
    for most in (0, 10**6):
        rows = kn.judge(edge_docs, trusted, broadcast_grams=most).collect()
        assert len(rows) == edge_docs.count()
        assert all(r.keep and r.perplexity is None for r in rows if r.n_units == 0) and all(r.keep for r in rows if r.lang in (None, "xx"))
    assert kn.judge(no_docs, trusted).count() == 0 and kn.judge(edge_docs, trusted.limit(0)).filter("NOT keep").count() == 0
