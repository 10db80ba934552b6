"""Byte-level BPE encoding and decoding over padded numpy matrices.

Pre-tokens are cut by the vocabulary's pattern. The distinct ones of a batch that
the worker has not met are grouped by byte length into padded matrices; each round
every row merges its leftmost pair of minimum rank (looked up in an open-addressing
hash table of pairs), then the rows are compacted and finished rows leave.

Defined results: a null text counts as empty; an empty text has no ids; repeated
rows are encoded like any other; a very long pre-token is merged with a heap, which
makes the same choices in n log n steps; an empty table gives no rows, a very long text is
worked on alone. Of the input's columns only id and text are used.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import runs, ship, text_or_empty, vocabulary_bytes

NONE = np.int32(2**31 - 1)
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: A pre-token of more bytes is merged by heap instead of in a matrix.
LONG = 96
#: Pre-tokens that a worker keeps the ids of.
CACHE = 400_000


def portable(pattern: str) -> str:
    """The pattern with ``\\s`` and ``\\S`` spelled as the Unicode property White_Space."""
    return (
        pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
    )


@dataclass
class Vocabulary:
    """Token bytes by id, ids of single bytes, and a hash table of mergeable pairs."""

    tokens: list[bytes]
    byte_ids: np.ndarray
    slots: np.ndarray
    merged: np.ndarray
    shift: int

    @classmethod
    def parse(cls, ranks_file: bytes) -> Vocabulary:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks_file.splitlines() if line)}
        tokens: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        left, right, out = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    out.append(rank)
        keys = np.array(left, np.int64) << 32 | np.array(right, np.int64)
        bits = max(4, int(np.ceil(np.log2(max(len(keys), 1) * 4))))
        slots, merged, shift = np.full(1 << bits, -1, np.int64), np.full(1 << bits, NONE, np.int32), 64 - bits
        todo, values = keys, np.array(out, np.int32)
        at = cls._home(todo, shift)
        while len(todo):  # linear probing, all keys at once: the first claimant of a free slot gets it
            free = slots[at] == -1
            _, first = np.unique(at, return_index=True)
            wins = np.zeros(len(todo), bool)
            wins[first] = True
            wins &= free
            slots[at[wins]], merged[at[wins]] = todo[wins], values[wins]
            todo, values, at = todo[~wins], values[~wins], (at[~wins] + 1) & ((1 << bits) - 1)
        return cls(tokens, np.array([ranks[bytes([i])] for i in range(256)], np.int32), slots, merged, shift)

    @staticmethod
    def _home(keys: np.ndarray, shift: int) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MIX) >> np.uint64(shift)).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair's merged token, NONE where they don't merge. Negative ids are padding."""
        keys = left.astype(np.int64) << 32 | (right.astype(np.int64) & 0xFFFFFFFF)
        out = np.full(keys.shape, NONE, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        flat, keys = out.reshape(-1), keys.reshape(-1)
        wanted = keys[todo]
        at, last = self._home(wanted, self.shift), len(self.slots) - 1
        while len(todo):
            found = self.slots[at]
            hit = found == wanted
            flat[todo[hit]] = self.merged[at[hit]]
            on = ~hit & (found != -1)
            todo, wanted, at = todo[on], wanted[on], (at[on] + 1) & last
        return out

    # -- encoding ---------------------------------------------------------------
    def encode_words(self, words: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of each pre-token."""
        out: list[tuple[int, ...]] = [()] * len(words)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(lengths, kind="stable")
        start = int(np.searchsorted(lengths[order], 1))
        while start < len(order):
            n = int(lengths[order[start]])
            if n > LONG:
                for i in order[start:]:
                    out[i] = self._heap(words[i])
                break
            # a bucket: lengths from n to n + n // 4, at most 2^14 rows
            stop = min(int(np.searchsorted(lengths[order], min(LONG, n + n // 4), "right")), start + (1 << 14))
            rows = order[start:stop]
            for i, ids in zip(rows, self._matrix([words[i] for i in rows]), strict=True):
                out[i] = ids
            start = stop
        return out

    def _matrix(self, words: list[bytes]) -> list[tuple[int, ...]]:
        width = max(map(len, words))
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(len(words), width)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ids = np.where(np.arange(width) < sizes[:, None], self.byte_ids[raw], np.int32(-1))
        done = np.full((len(words), width), -1, np.int32)
        live = np.arange(len(words))
        ranks = self.pair_ranks(ids[:, :-1], ids[:, 1:]) if width > 1 else np.zeros((len(words), 0), np.int32)
        while len(live):
            if ranks.shape[1] == 0:
                done[live, : ids.shape[1]] = ids
                break
            best = ranks.argmin(axis=1)  # the first of equal minima: the leftmost
            value = ranks[np.arange(len(live)), best]
            ended = value == NONE
            if ended.any():
                done[live[ended], : ids.shape[1]] = ids[ended]
                on = ~ended
                live, ids, ranks, best, value = live[on], ids[on], ranks[on], best[on], value[on]
                if not len(live):
                    break
            # compaction: drop the right half of each merged pair
            r, width = np.arange(len(live)), ids.shape[1]
            ids[r, best] = value
            keep = np.ones(ids.shape, bool)
            keep[r, best + 1] = False
            ids = ids[keep].reshape(len(live), width - 1)
            if width == 2:
                ranks = np.zeros((len(live), 0), np.int32)
                continue
            gone = np.ones(ranks.shape, bool)
            gone[r, best] = False
            ranks = ranks[gone].reshape(len(live), width - 2)
            # only the pairs on either side of the merged token are new
            has = best < width - 2
            ranks[r[has], best[has]] = self.pair_ranks(ids[r[has], best[has]], ids[r[has], best[has] + 1])
            has = best > 0
            ranks[r[has], best[has] - 1] = self.pair_ranks(ids[r[has], best[has] - 1], ids[r[has], best[has]])
            while ids.shape[1] > 1 and (ids[:, -1] < 0).all():
                ids, ranks = ids[:, :-1], ranks[:, :-1]
        counts = (done >= 0).sum(axis=1).tolist()
        return [tuple(row[:n]) for row, n in zip(done.tolist(), counts, strict=True)]

    def _heap(self, word: bytes) -> tuple[int, ...]:
        ids = self.byte_ids[np.frombuffer(word, np.uint8)]
        first = self.pair_ranks(ids[:-1], ids[1:])
        ids, n = ids.tolist(), len(word)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(int(first[i]), i, ids[i], ids[i + 1]) for i in np.flatnonzero(first != NONE)]
        heapq.heapify(heap)
        known: dict[tuple[int, int], int] = {}

        def push(i: int, j: int) -> None:
            pair = ids[i], ids[j]
            if pair not in known:
                known[pair] = int(self.pair_ranks(np.array([pair[0]]), np.array([pair[1]]))[0])
            if known[pair] != NONE:
                heapq.heappush(heap, (known[pair], i, *pair))

        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # one of the two has merged with another since
            ids[i], ids[j], after[i] = rank, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
                push(i, after[i])
            if before[i] >= 0:
                push(before[i], i)
        return tuple(x for x in ids if x >= 0)

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class Encoder:
    """A vocabulary with a pattern and a bounded cache of pre-tokens."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary, self.find = vocabulary, regex.compile(portable(pattern)).findall
        self.cache: dict[str, tuple[int, ...]] = {}

    def encode_batch(self, texts: list[str]) -> Iterator[list[int]]:
        """Ids of each text. Texts are taken in runs of about 2 million characters."""
        run, size = [], 0
        for text in texts:
            run.append(text)
            size += len(text)
            if size > 2_000_000:
                yield from self._run(run)
                run, size = [], 0
        yield from self._run(run)

    def _run(self, texts: list[str]) -> Iterator[list[int]]:
        cut = [self.find(t) for t in texts]
        if len(self.cache) > CACHE:
            self.cache.clear()
        new = list({w for words in cut for w in words}.difference(self.cache))
        self.cache.update(zip(new, self.vocabulary.encode_words([w.encode() for w in new]), strict=True))
        get = self.cache.__getitem__
        for words in cut:
            yield [i for ids in map(get, words) for i in ids]


_encoders: dict[tuple[int, str], Encoder] = {}


def encoder(key: int, vocabulary, pattern: str) -> Encoder:
    """This worker process's encoder for a broadcast vocabulary."""
    if (key, pattern) not in _encoders:
        _encoders.clear()
        _encoders[key, pattern] = Encoder(vocabulary.value, pattern)
    return _encoders[key, pattern]


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ids array<int> and decoded binary for every row: ids as the public library gives, and their bytes again."""
    return _apply(docs, ranks_path, pattern, id_col, text_col, "ids array<int>, decoded binary", _columns)


def encode_digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_tokens, ids_sha256 and decoded_sha256 for every row, digested where the ids are made."""
    return _apply(docs, ranks_path, pattern, id_col, text_col, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", _digests)


def _columns(ids: Iterator[list[int]], decode) -> dict[str, pa.Array]:
    ids = list(ids)
    return {"ids": pa.array(ids, pa.list_(pa.int32())), "decoded": pa.array([decode(x) for x in ids], pa.binary())}


def _digests(ids: Iterator[list[int]], decode) -> dict[str, pa.Array]:
    counts, joined, decoded = [], [], []
    for x in ids:
        counts.append(len(x))
        joined.append(hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest())
        decoded.append(hashlib.sha256(decode(x)).hexdigest())
    return {"n_tokens": pa.array(counts, pa.int64()), "ids_sha256": pa.array(joined, pa.string()), "decoded_sha256": pa.array(decoded, pa.string())}


def _apply(docs: DataFrame, ranks_path: str, pattern: str, id_col: str, text_col: str, columns: str, make) -> DataFrame:
    spark = docs.sparkSession
    ship(spark)
    # The vocabulary's size is fixed: some 7 MB with the pair table, whatever the input.
    shared = spark.sparkContext.broadcast(Vocabulary.parse(vocabulary_bytes(ranks_path)))
    key = shared._jbroadcast.id()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(key, shared, pattern)
        for batch in batches:
            for part in runs(batch, 1):
                made = make(own.encode_batch(part.column(1).to_pylist()), own.vocabulary.decode)
                yield pa.RecordBatch.from_arrays([part.column(0), *made.values()], [id_col, *made])

    kept = docs.select(id_col, text_or_empty(text_col).alias("_text"))
    return kept.mapInArrow(run, f"`{id_col}` {dict(docs.dtypes)[id_col]}, {columns}")
