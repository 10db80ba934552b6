"""Benchmark decontamination by an FM-index per training shard.

A shard is a run of documents of at most ``SHARD_BYTES`` (or one longer document). Its
words become symbols of the test phrases' vocabulary; a word outside that vocabulary
ends a segment, as no phrase crosses it, and segments shorter than the shortest phrase
hold no occurrence. The segments' suffix array gives the Burrows-Wheeler transform,
held as a wavelet matrix. All phrases are searched backwards at once through its ranks;
occurrences are located by walking to sampled suffix positions, compared with the
phrase word for word, and merged into spans.

Defined results: a null text has no words; an item without words has no phrases; an item
shorter than the window is one phrase; items that share a phrase are all reported;
repeated rows are reported each; an empty table gives no rows, a very long text is a shard
of its own; a result column whose name a kept column has gets an underscore after it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free, ship, text_or_empty
from .words import ALNUM, borders, hashes, lowered

SHARD_BYTES = 2_000_000
#: Bytes of test texts in one broadcast block; more texts make more blocks, searched one by one.
BLOCK_BYTES = 4_000_000
SAMPLE = 8


class WaveletMatrix:
    """Ranks of symbols in a sequence, level by level from the highest bit."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for b in range(bits - 1, -1, -1):
            bit = (symbols >> b) & 1
            ones = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            self.levels.append((b, ones, len(symbols) - int(ones[-1])))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        base = np.zeros(len(symbol), np.int64)
        for b, ones, zeros in self.levels:
            one = (symbol >> b) & 1 == 1
            at = np.where(one, zeros + ones[at], at - ones[at])
            base = np.where(one, zeros + ones[base], base - ones[base])
        return at - base


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array by prefix doubling; only suffixes not told apart yet are sorted again. The last symbol must be unique."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    fresh = np.ones(n, bool)
    fresh[1:] = text[order[1:]] != text[order[:-1]]
    place = np.flatnonzero(fresh)
    rank = np.empty(n, np.int64)
    rank[order] = place[np.cumsum(fresh) - 1]
    alone = fresh & np.append(fresh[1:], True)
    todo = np.flatnonzero(~alone)
    h = 1
    while len(todo):
        suffixes = order[todo]
        group, key = rank[suffixes], rank[np.minimum(suffixes + h, n - 1)]
        by = np.argsort(group * n + key, kind="stable")
        suffixes, group, key = suffixes[by], group[by], key[by]
        order[todo] = suffixes
        fresh = np.ones(len(todo), bool)
        fresh[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
        rank[suffixes] = todo[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
        todo = todo[~(fresh & np.append(fresh[1:], True))]
        h *= 2
    return order


class FMIndex:
    """Backward search and location over segments of symbols (from 1), each ended by its own stop."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, alphabet: int):
        stops, n = len(lengths), len(symbols) + len(lengths)
        ends = np.cumsum(lengths + 1) - 1
        text = np.empty(n, np.int64)
        here = np.ones(n, bool)
        here[ends] = False
        text[here] = symbols + (stops - 1)
        text[ends] = np.arange(stops)  # stops sort before words, each unlike all others
        order = suffix_array(text)
        plain = np.zeros(n, np.int64)
        plain[here] = symbols
        self.before = plain[order - 1]  # the transform; all stops are symbol 0
        self.first = np.zeros(alphabet + 2, np.int64)
        np.cumsum(np.bincount(plain, minlength=alphabet + 1), out=self.first[1:])
        self.ranks = WaveletMatrix(self.before, max(1, int(alphabet).bit_length()))
        # sampled positions: every SAMPLE-th, and each segment's start, so no walk crosses a stop
        sampled = np.zeros(n, bool)
        sampled[::SAMPLE] = True
        sampled[0] = True
        sampled[ends[:-1] + 1] = True
        mark = sampled[order]
        self.marks = np.zeros(n + 1, np.int64)
        np.cumsum(mark, out=self.marks[1:])
        self.positions = order[mark]
        self.size = n

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of equally long phrases, one a row."""
        low, high = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.size, np.int64)
        live = np.arange(len(phrases))
        for k in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[live, k]
            low[live] = self.first[symbol] + self.ranks.rank(symbol, low[live])
            high[live] = self.first[symbol] + self.ranks.rank(symbol, high[live])
            live = live[low[live] < high[live]]
        empty = np.ones(len(phrases), bool)
        empty[live] = False
        high[empty] = low[empty]
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text position of each row, by steps backwards to a sampled row."""
        steps, at, out, todo = np.zeros(len(rows), np.int64), rows.copy(), np.empty(len(rows), np.int64), np.arange(len(rows))
        while len(todo):
            done = self.marks[at + 1] > self.marks[at]
            out[todo[done]] = self.positions[self.marks[at[done]]] + steps[todo[done]]
            todo, at = todo[~done], at[~done]
            if len(todo):
                symbol = self.before[at]
                at = self.first[symbol] + self.ranks.rank(symbol, at)
                steps[todo] += 1
        return out


@dataclass
class Phrases:
    """A block of test items: their distinct phrases over a vocabulary of word hashes."""

    vocabulary: np.ndarray  # sorted hashes; a word's symbol is its place here, from 1
    words: list[bytes]  # by symbol - 1
    by_length: dict[int, np.ndarray]  # length: phrases as rows of symbols
    items: dict[int, list[list[int]]]  # length: for each phrase, places in item_ids
    item_ids: list

    @classmethod
    def build(cls, items: list[tuple[object, str | None]], window: int) -> Phrases:
        raw, at = lowered([(t or "").encode() for _, t in items])
        start, end = borders(raw, ALNUM)
        hashed = hashes(raw, start, end)
        vocabulary, first, symbol = np.unique(hashed, return_index=True, return_inverse=True)
        words = [raw[start[i] : end[i]].tobytes() for i in first]
        found: dict[int, dict[tuple, set[int]]] = {}
        for k in range(len(items)):
            own = symbol[np.searchsorted(start, at[k]) : np.searchsorted(start, at[k + 1])] + 1
            size = min(window, len(own))
            for i in range(len(own) - size + 1 if size else 0):
                found.setdefault(size, {}).setdefault(tuple(own[i : i + size].tolist()), set()).add(k)
        by_length = {n: np.array(list(p), np.int64) for n, p in found.items()}
        return cls(vocabulary, words, by_length, {n: [sorted(x) for x in p.values()] for n, p in found.items()}, [i for i, _ in items])


@dataclass
class Hits:
    n_words: np.ndarray
    hit: np.ndarray  # by word of the shard
    items: list[set]  # by document
    start: np.ndarray
    end: np.ndarray
    first_word: np.ndarray


def scan(texts: list[bytes], blocks: list[Phrases]) -> Hits:
    """All occurrences of all phrases in a shard."""
    raw, at = lowered(texts)
    start, end = borders(raw, ALNUM)
    first_word = np.searchsorted(start, at)
    hashed = hashes(raw, start, end)
    cover = np.zeros(len(start) + 1, np.int64)
    items: list[set] = [set() for _ in texts]
    document = np.repeat(np.arange(len(texts)), np.diff(first_word))
    for block in blocks:
        if not len(block.vocabulary) or not len(start):
            continue
        place = np.minimum(np.searchsorted(block.vocabulary, hashed), len(block.vocabulary) - 1)
        known = block.vocabulary[place] == hashed
        # segments: maximal runs of known words in one document
        apart = np.ones(len(start) + 1, bool)
        apart[1:-1] = ~(known[1:] & known[:-1]) | (document[1:] != document[:-1])
        cut = np.flatnonzero(apart)
        begin, length = cut[:-1], np.diff(cut)
        keep = known[begin] & (length >= min(block.by_length))
        begin, length = begin[keep], length[keep]
        if not len(begin):
            continue
        stops = np.cumsum(length + 1)
        inner = np.ones(stops[-1], bool)
        inner[stops - 1] = False
        word = np.repeat(begin - (stops - length - 1), length + 1) + np.arange(stops[-1])  # of each text position
        index = FMIndex(place[word[inner]] + 1, length, len(block.vocabulary))
        items_here: dict[int, set[int]] = {}
        for size, phrases in block.by_length.items():
            low, high = index.search(phrases)
            which = np.repeat(np.arange(len(phrases)), high - low)
            rows = np.repeat(low - (np.cumsum(high - low) - (high - low)), high - low) + np.arange(len(which))
            where = word[index.locate(rows)] if len(rows) else rows
            if not len(where):
                continue
            # equal hashes are compared as words, so a chance collision is no hit
            used = where[:, None] + np.arange(size)
            differs = [p for p in np.unique(used).tolist() if raw[start[p] : end[p]].tobytes() != block.words[place[p]]]
            if differs:
                same = ~np.isin(used, differs).any(axis=1)
                where, which = where[same], which[same]
            np.add.at(cover, where, 1)
            np.add.at(cover, where + size, -1)
            for x in np.unique(document[where] * len(phrases) + which).tolist():
                items_here.setdefault(x // len(phrases), set()).update(block.items[size][x % len(phrases)])
        for d in items_here:
            items[d].update(block.item_ids[i] for i in items_here[d])
    return Hits(np.diff(first_word), np.cumsum(cover[:-1]) > 0, items, start, end, first_word)


def spans_of(hits: Hits, k: int, begin: int) -> list[tuple[int, int]]:
    """Merged spans of document ``k`` in bytes, from the first to the last word of each run of hit words."""
    a, b = hits.first_word[k], hits.first_word[k + 1]
    edge = np.diff(np.concatenate([[0], hits.hit[a:b].astype(np.int8), [0]]))
    return [(int(hits.start[a + i] - begin), int(hits.end[a + j - 1] - begin)) for i, j in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]


def shards(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about SHARD_BYTES, each with the place of its first text."""
    run, size, first = [], 0, 0
    for i, text in enumerate(texts):
        run.append(text.as_buffer().to_pybytes())
        size += len(run[-1])
        if size >= SHARD_BYTES:
            yield first, run
            run, size, first = [], 0, i + 1
    if run:
        yield first, run


def _blocks(benchmark: DataFrame, window: int, item_col: str, text_col: str) -> list:
    """Broadcasts of the test phrases, each of a bounded size, made from a bounded part of the items."""
    spark = benchmark.sparkSession
    size = benchmark.agg(F.sum(F.octet_length(text_col)).alias("n")).first().n or 0
    n = -(-size // BLOCK_BYTES) or 1
    own = benchmark.select(item_col, text_col, F.pmod(F.xxhash64(text_col), F.lit(n)).alias("_block"))
    out = []
    for b in range(n):
        rows = [(r[0], r[1]) for r in own.filter(F.col("_block") == b).toLocalIterator()]
        out.append(spark.sparkContext.broadcast(Phrases.build(rows, window)))
    return out


def find(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", keep: tuple[str, ...] = (), keep_text: bool = False) -> DataFrame:
    """``id_col``, the columns of ``keep``, n_words, n_hit, item_ids (sorted as strings) and spans (bytes, end exclusive) for every row.

    With ``keep_text`` also ``cleaned``: the text without the spans.
    """
    spark = docs.sparkSession
    ship(spark)
    shared = _blocks(benchmark, window, item_col, item_text_col)
    kinds = dict(docs.dtypes)
    columns = list(dict.fromkeys([id_col, *keep]))
    kind = {"n_words": "bigint", "n_hit": "bigint", "item_ids": "array<string>", "spans": "array<struct<start: int, end: int>>"} | ({"cleaned": "string"} if keep_text else {})
    made = {free(c, columns): k for c, k in kind.items()}
    names = [*columns, *made]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, shard in shards(batch.column(0)):
                hits = scan(shard, [b.value for b in shared])
                offsets = np.cumsum([0, *(len(t) + 1 for t in shard)])
                n_hit = np.add.reduceat(np.append(hits.hit, False).astype(np.int64), hits.first_word[:-1]) if len(shard) else np.zeros(0, np.int64)
                n_hit[hits.n_words == 0] = 0
                spans = [spans_of(hits, k, offsets[k]) if n_hit[k] else [] for k in range(len(shard))]
                columns = [
                    *(c.slice(first, len(shard)) for c in batch.columns[1:]),
                    pa.array(hits.n_words, pa.int64()),
                    pa.array(n_hit, pa.int64()),
                    pa.array([sorted(map(str, x)) for x in hits.items], pa.list_(pa.string())),
                    pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                ]
                if keep_text:
                    columns.append(pa.array([_without(t, s) if s else t.decode() for t, s in zip(shard, spans, strict=True)], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = ", ".join(f"`{c}` {k}" for c, k in ({c: kinds[c] for c in columns} | made).items())
    return docs.select(text_or_empty(text_col).alias(free("_text", columns)), *columns).mapInArrow(run, schema)


def _without(text: bytes, spans: list[tuple[int, int]]) -> str:
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]]).decode()


def digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(items).encode()).hexdigest()
