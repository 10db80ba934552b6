"""Periodic runs of words by Karp-Miller-Rosenberg names.

The words of a text get names, and the stretch of ``2**k`` words from each position gets the
name of its two halves' pair, by sorting the pairs. A name is kept only where it occurs twice
in its text, as no other can take part in a match; so levels end soon in prose, and pairs of
single names are never sorted. The longest common extension of two positions, to the right or
to the left, goes down the levels and steps over each stretch with equal names.

A run of period ``q`` and ``times * q`` words or more has over ``(times - 1) * q`` words that
equal the word ``q`` later, so one of them lies on the grid of multiples of ``(times - 1) * q``.
Grid positions whose word recurs ``q`` later are the candidates; each is extended both ways at
once for a whole block of texts. No fingerprints and no suffix order are used: every match is exact.

Defined results: a null or empty text has no words and no runs; a very long text is worked on
alone, in memory that grows with its own words; a run whose words also have a smaller period is
that period's alone; repeated rows and ids are worked on each; an empty table gives no rows. The
input's other columns are passed on only by ``keep``, under any names: results are named so that
no kept column is hidden.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from hashlib import sha256
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free, runs, ship

#: A run's extensions that are worked on at a time.
BLOCK = 500_000


def word_names(texts: list[list[bytes]]) -> np.ndarray:
    """A name for each word of all texts in a row: the place of the first equal word of the same text."""
    out, at = np.empty(sum(map(len, texts)), np.int64), 0
    for words in texts:
        known: dict[bytes, int] = {}
        out[at : at + len(words)] = np.fromiter(map(known.setdefault, words, range(at, at + len(words))), np.int64, len(words))
        at += len(words)
    return out


def _shared(keys: np.ndarray, at: np.ndarray, total: int) -> np.ndarray:
    """For each position the first of those with its key, -1 where it is the only one or none is given."""
    names = np.full(total, -1, np.int64)
    if len(at):
        order = np.argsort(keys, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], np.diff(keys[order]) != 0]))
        size = np.diff(np.append(starts, len(order)))
        first = np.repeat(at[order[starts]], size)
        several = np.repeat(size > 1, size)
        names[at[order[several]]] = first[several]
    return names


def levels(names: np.ndarray) -> list[np.ndarray]:
    """Names of stretches of 1, 2, 4, ... words from each position, -1 for those that occur once.

    Word names differ between texts, so a stretch over a border equals no other.
    """
    total = len(names)
    out = [_shared(names, np.arange(total), total)]
    while True:
        half = 1 << (len(out) - 1)
        last = out[-1]
        at = np.flatnonzero(last[: max(0, total - half)] >= 0)
        at = at[last[at + half] >= 0]
        found = _shared(last[at] * total + last[at + half], at, total)
        if not (found >= 0).any():
            return out
        out.append(found)


def common_extensions(named: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many words agree to the left of positions i < j, and to the right from them on."""
    total = len(named[0])
    left, right = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
    for k in range(len(named) - 1, -1, -1):
        name, step = named[k], 1 << k
        a, b = i + right, j + right
        ok = b < total
        here = name[np.where(ok, a, 0)]
        right += step * (ok & (here >= 0) & (here == name[np.where(ok, b, 0)]))
        a, b = i - left - step, j - left - step
        ok = a >= 0
        here = name[np.where(ok, a, 0)]
        left += step * (ok & (here >= 0) & (here == name[np.where(ok, b, 0)]))
    return left, right


def _candidates(first: np.ndarray, longest: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grid positions and periods whose word recurs a period later, some at a time."""
    at, period, held = [], [], 0
    for q in range(1, longest // times + 1):
        step = (times - 1) * q
        here, there = first[: len(first) - q : step], first[q::step]
        hit = np.flatnonzero((here == there[: len(here)]) & (here >= 0))
        if len(hit):
            at.append(hit * step)
            period.append(np.full(len(hit), q))
            held += len(hit)
        if held >= BLOCK:
            yield np.concatenate(at), np.concatenate(period)
            at, period, held = [], [], 0
    if held:
        yield np.concatenate(at), np.concatenate(period)


def find_runs(texts: list[list[bytes]], least: int = 6, times: int = 4) -> list[list[tuple[int, int, int]]]:
    """For each text (a list of words) its runs (start, length, period), by start, then period."""
    begin = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)), out=begin[1:])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    longest = max(map(len, texts), default=0)
    if longest < max(least, times):
        return out
    named = levels(word_names(texts))
    found: dict[tuple[int, int], int] = {}
    for at, period in _candidates(named[0], longest, times):
        left, right = common_extensions(named, at, at + period)
        length = left + right + period
        ok = length >= np.maximum(least, times * period)
        for start, n, q in zip((at - left)[ok].tolist(), length[ok].tolist(), period[ok].tolist(), strict=True):
            # periods come in ascending order: a larger one of the same stretch is a multiple of the least
            found.setdefault((start, n), q)
    for (start, n), q in sorted(found.items(), key=lambda e: (e[0][0], e[1])):
        text = int(np.searchsorted(begin, start, "right")) - 1
        out[text].append((start - int(begin[text]), n, q))
    return out


def strongest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length by period, the earliest of these, then the one of the smallest period."""
    return min(found, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)


def collapse(words: list[bytes], found: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that any run holds after its first period."""
    if not found:
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    for start, n, q in found:
        depth[start + q] += 1
        depth[start + n] -= 1
    return list(compress(words, (np.cumsum(depth[:-1]) == 0).tolist()))


def runs_of(
    docs: DataFrame, least: int = 6, times: int = 4, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), with_text: bool = True
) -> DataFrame:
    """``id_col``, the columns to ``keep``, runs (an array of start, length, period), strongest (one of these or null), and
    collapsed (the kept words joined by spaces; its lowercase hex sha256 if ``with_text`` is off) for every row.

    Words are maximal stretches without ASCII white space. A run is a stretch of ``least`` words and ``times`` periods or
    more that cannot be extended.
    """
    ship(docs.sparkSession)
    columns = [id_col, *(c for c in keep if c != id_col)]
    text = free("_text", columns)
    kinds = dict(docs.dtypes)
    names = [free(n, columns) for n in ("runs", "strongest", "collapsed")]
    run = "struct<start: bigint, length: bigint, period: bigint>"
    one = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in runs(batch, batch.num_columns - 1):
                words = [t.split() if t else [] for t in part.column(part.num_columns - 1).cast(pa.binary()).to_pylist()]
                found = find_runs(words, least, times)
                kept = [b" ".join(collapse(w, r)) for w, r in zip(words, found, strict=True)]
                parts = ({"start": s, "length": n, "period": q} for r in found for s, n, q in r)
                at = np.cumsum([0, *map(len, found)])
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(list(parts), one))
                best = pa.array([b and dict(zip(("start", "length", "period"), b, strict=True)) for b in map(strongest, found)], one)
                last = pa.array(kept, pa.binary()).cast(pa.string()) if with_text else pa.array([sha256(x).hexdigest() for x in kept])
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], lists, best, last], [*columns, *names])

    shape = ", ".join([*(f"`{c}` {kinds[c]}" for c in columns), f"`{names[0]}` array<{run}>", f"`{names[1]}` {run}", f"`{names[2]}` string"])
    return docs.select(*columns, F.col(text_col).alias(text)).mapInArrow(work, shape)
