"""Languages of whole texts by mixtures of n-gram models.

``fit`` counts hashed letter trigrams by language over every labelled row: tasks count into one
array for each language, and the arrays' nonzero cells are summed by shuffle. A model is
``BUCKETS`` numbers for each language, whatever the corpus, and is broadcast; over
``MOST_LANGUAGES`` languages are an error.

``identify`` takes a text's trigrams as drawn from a mixture of the languages. Expectation
maximisation finds the proportions; as each letter is in three trigrams, a trigram counts a
third. Of the best single language and the nested sets of the languages with the largest
proportions, the set with the greatest likelihood less ``penalty * log(trigrams) / 2`` for each
language after the first is taken, with proportions of its own. The likelihood is concave in the
proportions, so its slopes bound what any mixture could gain: where that is less than the
penalty, the single language is chosen at once, by proof.

Defined results: a null text, or one without a letter (of any script), is ``und`` with no
languages and score 0, as is every text if nothing was learned. Very long texts are worked on
alone. Of equal likelihoods the language that sorts first is taken. Repeated rows and ids count
and are judged each; rows without a language teach nothing; an empty table gives no rows. Of the
input's columns only id, text and, in ``fit``, language are used.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import runs, ship

BUCKETS = 1 << 16
MOST_LANGUAGES = 1000
#: What is added to the count of each bucket, and rounds of expectation maximisation at most.
ALPHA, ROUNDS = 0.05, 60
#: Languages whose counts a task holds at a time.
HELD = 64
UNKNOWN = "und"
_A, _B, _C = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D)
_letters: list[np.ndarray] = []


def _is_letter() -> np.ndarray:
    if not _letters:
        _letters.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _letters[0]


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the letter trigrams of all texts in a row, and how many each text has.

    Letters are lower-cased; what lies between them counts as one space, as do both ends.
    """
    if not texts:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    lowered = [t.lower() for t in texts]
    units = np.frombuffer("\0".join(["", *lowered, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _is_letter()[units]
    mark = np.zeros(len(units), bool)  # before the first text, and after each
    mark[0] = True
    mark[np.cumsum(np.fromiter(map(len, lowered), np.int64, len(lowered)) + 1)] = True
    kept = letter | mark
    kept[1:] |= letter[:-1]  # the first of what follows a word stands for all of it
    units, letter, mark = units[kept], letter[kept], mark[kept]
    kept = np.ones(len(units), bool)
    kept[:-1] = letter[:-1] | mark[:-1] | ~mark[1:]  # the mark after a text is its last space
    units, mark = np.where(letter, units, np.uint32(32))[kept], mark[kept]
    mixed = units[:-2] * _A + units[1:-1] * _B + units[2:] * _C
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    inside = ~mark[1:-1]
    text = np.cumsum(mark)[1:-1] - 1
    return (mixed >> np.uint32(16))[inside], np.bincount(text[inside], minlength=len(texts))


@dataclass
class Model:
    """Languages in sorted order, and for each bucket the languages' probabilities times BUCKETS."""

    languages: list[str]
    chances: np.ndarray

    @classmethod
    def of(cls, counts: dict[str, np.ndarray]) -> Model:
        names = sorted(counts)
        table = np.array([counts[n] for n in names], float).reshape(len(names), BUCKETS) + ALPHA
        return cls(names, (table / table.sum(axis=1, keepdims=True) * BUCKETS).T.astype(np.float32))


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model:
    """A model from every row with a language."""
    ship(docs.sparkSession)

    def cells(counts: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
        for lang, n in counts.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(n[at], pa.int64())], ["lang", "bucket", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(BUCKETS, np.int64))
        for batch in batches:
            for part in runs(batch):
                bucket, size = trigrams(part.column(0).to_pylist())
                langs = np.repeat(part.column(1).to_numpy(zero_copy_only=False), size)
                order, names = np.unique(langs.astype(str), return_inverse=True) if len(langs) else ([], langs)
                for k, lang in enumerate(order):
                    held[str(lang)] += np.bincount(bucket[names == k], minlength=BUCKETS)
            if len(held) > HELD:
                yield from cells(held)
                held.clear()
        yield from cells(held)

    known = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    parts = known.mapInArrow(run, "lang string, bucket bigint, n bigint")
    summed = parts.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    rows = summed.limit(MOST_LANGUAGES * BUCKETS + 1).toPandas()
    counts = {str(lang): np.bincount(g["bucket"], g["n"], minlength=BUCKETS) for lang, g in rows.groupby("lang")}
    if len(counts) > MOST_LANGUAGES:
        raise ValueError(f"over {MOST_LANGUAGES} languages: map rare ones to null or to a common name")
    return Model.of(counts)


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts, axis=0)


def _mixture(p: np.ndarray, c: np.ndarray, size: np.ndarray, pi: np.ndarray, bar: np.ndarray | None = None, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Proportions, log likelihood and what other proportions could still gain, for texts whose cells lie in a row.

    p: chances by cell and language; c: weights; size: cells of each text; pi: first proportions, of which zeros stay.
    A text is left alone when it could gain less than a hundredth, or is sure not to reach its ``bar``.
    """
    pi = pi.copy()
    like, gain = np.zeros(len(size)), np.zeros(len(size))
    live = np.arange(len(size))
    q, w, n = p, c, size
    for _ in range(rounds):
        starts = np.cumsum(n) - n
        weighed = q * np.repeat(pi[live], n, axis=0)
        s = weighed.sum(axis=1)
        like[live] = _sums(w * np.log(s), starts)
        total = _sums(w, starts)
        taken = _sums(weighed * (w / s)[:, None], starts)
        with np.errstate(divide="ignore", invalid="ignore"):
            slope = np.where(pi[live] > 0, taken / pi[live], 0.0)
        gain[live] = slope.max(axis=1) - total
        done = gain[live] < 0.01
        if bar is not None:
            done |= like[live] + gain[live] < bar[live]
        pi[live] = np.where(done[:, None], pi[live], taken / total[:, None])
        if done.all():
            break
        if done.any():
            keep = np.repeat(~done, n)
            q, w, n, live = q[keep], w[keep], n[~done], live[~done]
    return pi, like, gain


def mixtures(model: Model, buckets: np.ndarray, sizes: np.ndarray, penalty: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the selected languages and a score for every text with trigrams.

    buckets: the trigrams of texts in a row; sizes: how many each text has, none of them 0. The score is the predicted
    language's proportion, or for a single language its share of all single languages' likelihood.
    """
    text = np.repeat(np.arange(len(sizes), dtype=np.int64), sizes)
    cell, count = np.unique(text << 16 | buckets, return_counts=True)
    n = np.bincount(cell >> 16, minlength=len(sizes))
    starts = np.cumsum(n) - n
    p = model.chances[cell & (BUCKETS - 1)].astype(float)
    c = count / 3.0
    total = _sums(c, starts)
    single = _sums(c[:, None] * np.log(p), starts)
    best = single.argmax(axis=1)
    rows = np.arange(len(sizes))
    top = single[rows, best]
    cost = penalty * np.log(np.maximum(3 * total, 2)) / 2
    share = 1 / np.exp(single - top[:, None]).sum(axis=1)
    pi = np.zeros_like(single)
    pi[rows, best] = 1.0
    # what any mixture could gain over the best language is bounded by the steepest slope there
    slope = _sums(p * (c / p[np.arange(len(p)), np.repeat(best, n)])[:, None], starts).max(axis=1) - total
    open_ = np.flatnonzero(slope > cost)
    if not len(open_):
        return pi, share
    of = np.repeat(np.isin(rows, open_), n)
    q, w, m = p[of], c[of], n[open_]
    full, like, gain = _mixture(q, w, m, np.full((len(open_), single.shape[1]), 1 / single.shape[1]), bar=(top + cost)[open_])
    still = like + gain >= (top + cost)[open_]
    of = np.repeat(still, m)
    q, w, m, full, open_ = q[of], w[of], m[still], full[still], open_[still]
    order = np.argsort(-full, axis=1, kind="stable")
    value = top[open_].copy()
    for k in range(2, single.shape[1] + 1):
        # a language that explains less than one trigram adds nothing
        use = np.flatnonzero(full[np.arange(len(full)), order[:, k - 1]] * total[open_] * 3 >= 1)
        if not len(use):
            break
        first = np.zeros((len(use), single.shape[1]))
        np.put_along_axis(first, order[use, :k], np.take_along_axis(full[use], order[use, :k], axis=1), axis=1)
        of = np.repeat(np.isin(np.arange(len(m)), use), m)
        own, like, _ = _mixture(q[of], w[of], m[use], first / first.sum(axis=1, keepdims=True))
        worth = like - (k - 1) * cost[open_[use]]
        better = worth > value[use]
        value[use[better]] = worth[better]
        pi[open_[use[better]]] = own[better]
        share[open_[use[better]]] = own[better].max(axis=1)
    return pi, share


def identify(docs: DataFrame, model: Model, penalty: float = 1.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, lang_pred, score (0 to 1) and languages (of the selected set, as an array of lang and proportion, largest first) for every row."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)  # BUCKETS floats for each of MOST_LANGUAGES at most
    pair = pa.struct([("lang", pa.string()), ("proportion", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for part in runs(batch, 1):
                bucket, size = trigrams([t or "" for t in part.column(1).to_pylist()])
                guess: list[str] = [UNKNOWN] * part.num_rows
                score, sets = np.zeros(part.num_rows), [[] for _ in guess]
                some = np.flatnonzero(size)
                if len(some) and known.languages:
                    pi, share = mixtures(known, bucket, size[some], penalty)
                    score[some] = np.clip(share, 0, 1)
                    for row, mix in zip(some.tolist(), pi, strict=True):
                        order = [k for k in np.argsort(-mix, kind="stable").tolist() if mix[k] > 0]
                        guess[row] = known.languages[order[0]]
                        sets[row] = [{"lang": known.languages[k], "proportion": float(mix[k])} for k in order]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(guess, pa.string()), pa.array(score), pa.array(sets, pa.list_(pair))], [id_col, "lang_pred", "score", "languages"])

    return docs.select(id_col, F.col(text_col).alias("_text")).mapInArrow(run, f"`{id_col}` {dict(docs.dtypes)[id_col]}, lang_pred string, score double, languages array<struct<lang: string, proportion: double>>")
