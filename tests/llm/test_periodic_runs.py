from fractions import Fraction
from hashlib import sha256
from random import Random
from zlib import crc32

import numpy as np
from pyspark.sql import functions as F

from evigraph.llm import periodic_runs as pr
from evigraph.llm import queries as q


def brute(words, least=6, times=4):
    """Runs by comparing each word with the one a period later."""
    found = {}
    for p in range(1, len(words) // times + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            n = j - i + p
            if j > i and n >= max(least, times * p):
                found.setdefault((i, n), p)
            i = max(j, i + 1)
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda r: (r[0], r[2]))


def smallest_period(words):
    return next(p for p in range(1, len(words) + 1) if words[p:] == words[:-p])


def expected(text):
    words = text.encode().split()
    found = brute(words)
    gone = {i for s, n, p in found for i in range(s + p, s + n)}
    best = min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in found)
    kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
    milli = best and 1000 * best[1] // best[2]
    return len(found), *(best or (None,) * 3), milli, sha256(lines.encode()).hexdigest(), sha256(kept).hexdigest()


def cycled(doc_id, text):
    h, words = crc32(str(doc_id).encode()), text.encode().split()
    n, g = len(words), h // 10
    if h % 10 or not n:
        return text
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return b" ".join(w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)).decode()


def texts():
    r = Random(5)
    out = ["", "a", "a a a a a", "a a a a a a", "a b a b a b a b", "a b a b a b a", "x a b c a b c a b c a b c a y", "a " * 300]
    for _ in range(400):
        words = [r.choice("abc"[: r.randint(1, 3)]) for _ in range(r.randint(0, 60))]
        cycle = [r.choice("abcdef") for _ in range(r.randint(1, 9))]
        out.append(" ".join(words + cycle * r.randint(0, 7) + words[: r.randint(0, 20)]))
    return out


def test_runs_against_brute_force():
    cases = [t.encode().split() for t in texts()]
    found = pr.find_runs(cases)
    assert sum(map(len, found)) > 300
    for words, runs in zip(cases, found, strict=True):
        assert runs == brute(words)
        assert all(smallest_period(words[s : s + n]) == p for s, n, p in runs)
    for least, times in ((2, 2), (8, 3)):
        some = [w for w in cases if len(w) < 40]
        assert pr.find_runs(some, least, times) == [brute(w, least, times) for w in some]


def test_extensions_against_brute_force():
    r = np.random.default_rng(3)
    words = r.integers(0, 2, 200)
    named = pr.levels(pr.word_names([[bytes([w]) for w in words]]))
    i, j = np.triu_indices(200, 1)
    left, right = pr.common_extensions(named, i, j)
    for a, b, x, y in zip(i[::37], j[::37], left[::37], right[::37], strict=True):
        assert x == next((k for k in range(a) if words[a - 1 - k] != words[b - 1 - k]), a)
        assert y == next((k for k in range(200 - b) if words[a + k] != words[b + k]), 200 - b)


def test_query_against_brute_force(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate([*texts(), "é x  y\x0b\x0cz\x1cq\n" * 9, "w" * 70_000, None])] + [(None, "a a a a a a"), (3, "a a a a a a"), (3, "a a a a a a")]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in q.op11_periodic_runs(spark, str(tmp_path)).collect()]
    want = [(i, *expected(cycled(i, t or "") if i is not None else t)) for i, t in rows]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_odd_tables(spark, edge_docs, no_docs):
    clash = edge_docs.withColumns({"runs": F.lit(1), "Strongest": F.lit("x"), "collapsed": F.lit(2)})
    got = pr.runs_of(clash, keep=("doc_id", "runs", "Strongest", "collapsed", "_text")).collect()
    assert len(got) == edge_docs.count()
    assert {len(r["runs_"]) for r in got if r["doc_id"] == 6} == {1}
    assert [(r["collapsed_"], r["strongest_"]) for r in got if r["doc_id"] == 6] == [("word", (0, 30_000, 1))]
    assert [r["collapsed_"] for r in got if r["doc_id"] in (3, 4, 5)] == [""] * 3
    assert pr.runs_of(no_docs).collect() == []
    assert pr.runs_of(edge_docs, with_text=False).filter("doc_id = 4").first()["collapsed"] == sha256(b"").hexdigest()
