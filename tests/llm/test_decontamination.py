import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from evigraph.llm import decontamination as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window):
    out = []
    for text in docs:
        w, hit, found = words(text), set(), set()
        for i, item in items:
            v = words(item)
            n = min(window, len(v))
            grams = {tuple(v[k : k + n]) for k in range(len(v) - n + 1)} if n else set()
            for k in range(len(w) - n + 1 if n else 0):
                if tuple(w[k : k + n]) in grams:
                    hit |= set(range(k, k + n))
                    found.add(i)
        out.append((len(w), len(hit), sorted(map(str, found))))
    return out


def ours(docs, items, window):
    block = dc.Phrases.build(items, window)
    out = []
    for _, shard in dc.shards(pa.array([d or "" for d in docs])):
        h = dc.scan(shard, [block])
        out += [(int(h.n_words[k]), int(h.hit[h.first_word[k] : h.first_word[k + 1]].sum()), sorted(map(str, h.items[k]))) for k in range(len(shard))]
    return out


def test_against_brute_force(monkeypatch):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(12)] + ["é", "The", "ﬁ", "日本"]
    for trial in range(60):
        monkeypatch.setattr(dc, "SHARD_BYTES", rng.choice([30, 300, 10**6]))
        text = lambda n: rng.choice([" ", ", ", "\n"]).join(rng.choice(vocab) for _ in range(n))
        items = [(i, text(rng.randint(0, 9))) for i in range(rng.randint(1, 6))] + [(99, None)]
        docs = [text(rng.randint(0, 60)) + (items[0][1] or "") for _ in range(8)] + [None, "", items[0][1]]
        window = rng.choice([1, 2, 3, 5])
        assert ours(docs, items, window) == brute(docs, items, window), trial


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=80), st.lists(st.integers(1, 4), min_size=1, max_size=4))
def test_index_finds_all_places(symbols, phrase):
    symbols = np.array(symbols)
    index = dc.FMIndex(symbols, np.array([len(symbols)]), 4)
    low, high = index.search(np.array([phrase]))
    got = sorted(index.locate(np.arange(low[0], high[0])).tolist())
    assert got == [i for i in range(len(symbols) - len(phrase) + 1) if symbols[i : i + len(phrase)].tolist() == phrase]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60))
def test_suffix_array_is_sorted(values):
    text = np.array([*[v + 1 for v in values], 0])
    order = dc.suffix_array(text)
    suffixes = [text[i:].tolist() for i in order]
    assert suffixes == sorted(suffixes)


def test_blocks_and_edges(spark, edge_docs, no_docs, monkeypatch):
    items = [(1, "quick brown fox jumps over the lazy dog while the small"), (2, "LAZY dog"), (3, None), (4, "no id here"), (5, "")]
    bench = spark.createDataFrame(items, "item_id int, text string")
    rows = edge_docs.select("doc_id", "text").collect()
    want = sorted(((r.doc_id or 0, *b) for r, b in zip(rows, brute([r.text for r in rows], items, 10), strict=True)))
    for size in (10**6, 20):
        monkeypatch.setattr(dc, "BLOCK_BYTES", size)
        got = dc.find(edge_docs, bench).collect()
        assert sorted((r.doc_id or 0, r.n_words, r.n_hit, r.item_ids) for r in got) == want
    assert dc.find(no_docs, bench).count() == 0
    assert {r.n_hit for r in dc.find(edge_docs, bench.limit(0)).collect()} == {0}


def test_removal(spark):
    docs = spark.createDataFrame([(1, "Keep é this. One two THREE four! Keep that."), (2, "Nothing here"), (3, None)], "doc_id int, text string")
    bench = spark.createDataFrame([(1, "one two three four")], "item_id int, text string")
    got = {r.doc_id: r.cleaned for r in dc.find(docs, bench, 4, keep_text=True).collect()}
    assert got == {1: "Keep é this. ! Keep that.", 2: "Nothing here", 3: ""}
