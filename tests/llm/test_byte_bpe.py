import base64
import hashlib

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from evigraph.llm.byte_bpe import Encoder, Vocabulary, encode, encode_digests

PATH = P.path("byte_bpe_50k.tiktoken")
RAW = open(PATH, "rb").read()
OURS = Encoder(Vocabulary.parse(RAW), P.PATTERN)
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, RAW.splitlines())}
THEIRS = tiktoken.Encoding("t", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=6))
def test_ids_as_the_library_and_round_trip(texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    for text, ids in zip(texts, OURS.encode_batch(texts), strict=True):
        assert ids == THEIRS.encode_ordinary(text)
        assert OURS.vocabulary.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 9000, " " * 5000, "ab" * 4000, "the\x1cthe\x85the\u3000the", "\n\n  \n x", "x" * 97, "é" * 200, "日本語" * 500])
def test_long_runs_and_odd_white_space(text):
    assert next(OURS.encode_batch([text])) == THEIRS.encode_ordinary(text)


@settings(max_examples=100, deadline=None)
@given(st.text("etaoin", min_size=1, max_size=200))
def test_heap_and_matrix_choose_the_same_merges(word):
    assert OURS.vocabulary._heap(word.encode()) == OURS.vocabulary.encode_words([word.encode()])[0]


def test_edges(edge_docs, no_docs):
    rows = edge_docs.select("doc_id", "text").collect()
    got = encode_digests(edge_docs, PATH, P.PATTERN).collect()
    key = lambda r: (r.doc_id is None, r.doc_id, r.n_tokens)
    want = sorted(((r.doc_id, THEIRS.encode_ordinary(r.text or ""), (r.text or "").encode()) for r in rows), key=lambda r: (r[0] is None, r[0], len(r[1])))
    for g, (i, ids, raw) in zip(sorted(got, key=key), want, strict=True):
        assert (g.doc_id, g.n_tokens) == (i, len(ids))
        assert g.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest() and g.decoded_sha256 == hashlib.sha256(raw).hexdigest()
    assert encode(no_docs, PATH, P.PATTERN).count() == 0
