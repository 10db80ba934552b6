import re
from types import SimpleNamespace

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from evigraph.llm import pii


def luhn(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m[0])) <= 15]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(list("a@.-1234567890 +()%é٣") + ["4111 1111 1111 1111", "1.2.3.4", "+1 (377) 555-0271", "a@b.c"])), max_size=30).map("".join))
def test_patterns_against_brute_force(text):
    assert pii.base_spans(text) == brute(text)


def corpus(spark):
    filler = ["alpha beta gamma delta", "one two three four", "red green blue grey", "north south east west"]
    rows = [(i, f"{filler[i % 4]} common words number {i} here and there") for i in range(400)]
    rows += [(1000 + i, f"{filler[i % 4]} the zanzibarite agent {filler[(i + 1) % 4]} wrote from boss@evil.example to us") for i in range(12)]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_a_revealing_term_is_found_everywhere_and_common_ones_are_not(spark):
    docs = corpus(spark).union(spark.createDataFrame([(5000, "only ZanziBarite here")], "doc_id bigint, text string"))
    rows = {r.doc_id: r for r in pii.find(docs, support=3, threshold=0.8, with_text=True).collect()}
    assert "term:5:16" in rows[5000].spans and rows[5000].sanitised == "only <TERM> here" and rows[5000].n_email == 0
    assert rows[0].spans == "" and rows[0].sanitised.startswith("alpha beta")
    assert rows[1001].n_email == 1 and "<EMAIL>" in rows[1001].sanitised and "alpha" not in [t for t in rows[1001].spans.split(",") if t.startswith("term")]


def test_copies_of_one_context_prove_nothing(spark):
    rows = [(i, f"filler words {i} in here") for i in range(300)] + [(1000 + i, "the quixotic person uses p@q.example daily") for i in range(20)]
    got = pii.find(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert not any("term" in r.spans for r in got)


def test_rare_entities_and_copied_lines_take_part(spark):
    rows = [(i, f"filler words number {i % 7} in here") for i in range(12000)]
    rows += [(5000, "the quixotic person wrote once@rare.example in here")]  # an entity that occurs once
    rows += [(6000 + i, "contact zanzibarite copied@line.example in here") for i in range(10)]  # one line, copied
    rows += [(7000, "quixotic"), (7001, "zanzibarite")]
    got = {r.doc_id: r.spans for r in pii.find(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[7000] == "term:0:8" and got[7001] == "term:0:11" and got[0] == ""


def test_texts_with_terms_are_those_with_spans():
    terms = np.sort(pii.word_hashes(["zebra", "caf\u00e9", "abc"]))
    texts = ["a ZEBRA", "", "Caf\u00e9!", "abcd", "x", "1 abc"]
    told = pii.with_terms(texts, [SimpleNamespace(value=terms[:1]), SimpleNamespace(value=terms[1:])])
    assert told == {i for i, t in enumerate(texts) if pii.term_spans(t, terms)} == {0, 2, 5}


def test_blocks_of_terms(spark, monkeypatch):
    want = sorted((r.doc_id, r.spans) for r in pii.find(corpus(spark)).collect())
    monkeypatch.setattr(pii, "BLOCK_TERMS", 1)
    assert sorted((r.doc_id, r.spans) for r in pii.find(corpus(spark)).collect()) == want


def test_edges(edge_docs, no_docs):
    rows = pii.find(edge_docs).collect()
    assert len(rows) == edge_docs.count() and pii.find(no_docs).count() == 0
    nine = next(r for r in rows if r.doc_id == 9)
    assert (nine.n_email, nine.n_ip, nine.n_card, nine.n_phone) == (1, 1, 1, 1)
