import re
import time
from collections import Counter, defaultdict
from pathlib import Path
from random import Random

import numpy as np
from pyspark.sql import functions as F

from evigraph.llm import collocations as co


def brute(rows, least=30, longest=4, absorbed=80, scale=2_000_000, top=2000):
    """The contract in plain Python: rows of (lang, text)."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lower = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^ \t]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                f[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        candidates = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in candidates.items():
            if any(len(x) > len(p) and 100 * b >= absorbed * a and any(x[i : i + len(p)] == p for i in range(len(x) - len(p) + 1)) for x, b in candidates.items()):
                continue
            score, _, left, right = min((scale * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def texts(seed=1, n=250):
    r = Random(seed)
    words = ["of", "THE", "new", "York", "é", "日本", "x\x00", "a-b", "\x1c", "in", "city"]
    fixed = ["new York city in", "of the", "é 日本 é", "a-b a-b a-b a-b a-b"]
    out = []
    for _ in range(n):
        parts = [r.choice(fixed) if r.random() < 0.3 else r.choice(words) for _ in range(r.randint(0, 40))]
        out.append((r.choice(["en", "en", "fr", None, "und"]), "".join(p + r.choice([" ", " ", " ", "  ", "\t", ". ", "\n", ",", "? "]) for p in parts)))
    return [*out, ("en", None), ("en", ""), ("xx", "alone"), ("fr", "w " * 3000), *out[:20]]


def test_against_brute_force(spark):
    rows = texts()
    df = spark.createDataFrame([(lang, t) for lang, t in rows], "lang string, text string").repartition(5)
    for options, sizes in (({}, {}), ({"least": 3}, {"shard_words": 300, "bucket_words": 200, "direct": 3}), ({"least": 2, "longest": 3, "absorbed": 50, "top": 7}, {"shard_words": 40})):
        got = sorted(tuple(r) for r in co.collocations(df, **options, **sizes).collect())
        assert got == brute(rows, **options)
        assert len(got) > 10


def test_scores_beyond_64_bits(spark):
    a = 2**52
    assert spark.range(1).select(F.expr(f"CAST(2000000 AS DECIMAL(10,0)) * CAST({a}L AS DECIMAL(20,0)) div {3 * a}L").alias("s")).first().s == 666_666


def test_lists():
    names = np.array([1, 0, -1, 1, 1, 2])
    positions, lengths = co.invert(names, 4)
    assert positions.tolist() == [1, 0, 3, 4, 5] and lengths.tolist() == [1, 3, 1, 0]
    assert [x.tolist() for x in co.merge_join(np.array([1, 3, 9]), np.array([0, 1, 2, 9]))] == [[0, 2], [1, 3]]
    assert [x.tolist() for x in co.merge_join(np.array([1]), np.array([], int))] == [[], []]
    packed = co.unpack(co.pack(a=np.arange(3), b=b"x y\nz", c=np.zeros(0, np.int32)))
    assert packed["a"].tolist() == [0, 1, 2] and packed["b"] == b"x y\nz" and len(packed["c"]) == 0


def test_odd_tables(spark, edge_docs, no_docs):
    rows = [(r.lang, r.text) for r in edge_docs.collect()]
    clash = edge_docs.withColumns({c: F.lit("x") for c in ("phrase", "kind", "a", "shard", "rank", "data")})
    assert sorted(tuple(r) for r in co.collocations(clash, least=3).collect()) == brute(rows, least=3)
    assert co.collocations(no_docs).collect() == []
    assert co.collocations(edge_docs, least=10**6).collect() == []


def test_disk(spark, monkeypatch):
    """Lists are stored once for all levels, and what was shuffled is gone in the end without the driver's collecting its garbage."""
    sizes, drop = [], co.drop_tables

    def measured(*tables):
        sizes.extend(sum(f.stat().st_size for f in Path(df._shared_path.removeprefix("file:")).rglob("*.parquet")) for df in tables)
        drop(*tables)

    def shuffled():
        dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
        return {f for d in dirs for f in Path(d).rglob("shuffle_*.data")}

    monkeypatch.setattr(co, "drop_tables", measured)
    r = Random(4)
    rows = [("en", " ".join(str(int(r.paretovariate(0.6)) % 5000) for _ in range(500))) for _ in range(400)]
    docs = spark.createDataFrame(rows, "lang string, text string").coalesce(4)
    before = shuffled()
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(setting)
    found, _ = co.mine(docs, shard_words=50_000)
    assert found.count() > 100
    assert spark.conf.get(setting) == was
    until = time.time() + 20
    while (left := [f for f in shuffled() - before if f.stat().st_size > 10_000]) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert sum(sizes) < 2 * max(sizes)


def test_quotients_name_phrases():
    """Keys leave their remainder to the bucket, and come back whole."""
    at = np.array([0, 1, 2, 3, 4, 6, 7])
    head, positions, told = {"words": b"a b", "lengths": np.array([4, 3])}, np.array([0, 2, 4, 6, 1, 3, 7], np.int32), {"keys": np.array([0, 1]), "ids": np.array([5, 9]), "totals": np.array([4, 3]), "own": np.zeros(2, np.int8)}
    text, lists = co.frequent_lists(head, positions, {1: told}, 4)
    assert text.tolist() == [b"a", b"b"] and lists[1][2].tolist() == at.tolist() and lists[1][3].tolist() == [0, 1, 0, 1, 0, 0, 1]
    keys, _ = co._joined(lists, 2, 4)
    assert keys.tolist() == [5 << 4 | 9, 9 << 4 | 5, 5 << 4 | 9, 9 << 4 | 5, 5 << 4 | 9]
    buckets = np.unique(keys) % 9
    packed = co.unpack(co.pack(keys=np.array([7, 9, 2, 2, 40]), buckets=buckets))
    assert packed["keys"].tolist() == [7, 9, 2, 2, 40] and packed["buckets"].tolist() == buckets.tolist()
