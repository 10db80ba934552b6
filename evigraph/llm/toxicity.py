"""Counterfactual-regularised toxicity classifier.

A logistic model over the distinct words and word beginnings of a text, hashed into a
fixed number of weights. For every mention of an identity group in a labelled text, the
term is swapped within its sentence for each other term of its list, and the squared change
of the score is penalised, so that a neutral mention of a group can't move the score. All
swaps of a text weigh as much as one text, however many there are.

Labels are learnt from a bounded sample of labelled rows, chosen by a hash of their ids (see
``fit``); every row is scored over its whole text. Label, language, source and id are never features.

Defined results: a null or wordless text scores the model's bias; without labelled rows
every score is 0.5 less a bias of one half; labels other than 0 and 1 are ignored; an id
labelled twice is learnt twice; repeated rows get equal scores; an empty table gives no rows,
and a very long text is worked on alone; ``score`` gets an underscore where a kept column has its name.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free, runs, ship, text_or_empty
from .words import ALNUM, borders, hashes, lowered, mix

#: Labelled rows that are learnt from at most.
SAMPLE_ROWS = 6_000
BUCKETS = 1 << 20
PREFIXES = (4, 5, 6)
#: Names of groups, by list; a term is swapped within its list.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "transgender", "nonbinary"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "sikh"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "sikhs"),
    ("gay", "lesbian", "straight", "bisexual", "queer"),
    ("black", "white", "asian", "latino", "indigenous"),
    ("blind", "deaf", "disabled", "paralyzed"),
    ("african", "american", "european", "mexican", "chinese", "indian", "arab"),
    ("immigrant", "immigrants", "refugee", "refugees"),
    ("femmes", "hommes", "musulmans", "chrétiens", "juifs"),
    ("frauen", "männer", "muslime", "christen", "juden"),
    ("mujeres", "hombres", "musulmanes", "cristianos", "judíos"),
)


def features(texts: list[bytes]) -> list[np.ndarray]:
    """Each text's distinct hashed features."""
    raw, at = lowered(texts)
    start, end = borders(raw, ALNUM)
    first = np.searchsorted(start, at)
    kinds = [hashes(raw, start, end)] + [mix(hashes(raw, start, np.minimum(end, start + k)) + np.uint64(k)) for k in PREFIXES]
    bucket = np.stack([(h % np.uint64(BUCKETS)).astype(np.int32) for h in kinds], axis=1)
    return [np.unique(bucket[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True)]


_SENTENCE = re.compile(r"(?<=[.!?\n])\s+")
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def swaps(text: str, lists: tuple[tuple[str, ...], ...] = IDENTITY_TERMS) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """For every mention of a listed term and every other term of its list: the features of its sentence that
    go, those that come, and a weight. Equal changes are one with their weights' sum; all weights of a text sum to 1.
    """
    group = {t: terms for terms in lists for t in terms}
    found: Counter = Counter()
    for sentence in _SENTENCE.split(text.translate(_FOLD)):
        words = Counter(_WORD.findall(sentence))
        named = [t for t in words if t in group]
        if not named:
            continue
        of = dict(zip(words, (f.tolist() for f in features([w.encode() for w in words])), strict=True))
        of |= {t: features([t.encode()])[0].tolist() for t in {o for n in named for o in group[n]} - of.keys()}
        times = Counter()
        for w, n in words.items():
            times.update(dict.fromkeys(of[w], n))
        for t in named:
            for other in group[t]:
                if other != t:
                    gone = tuple(x for x in of[t] if times[x] == 1 and x not in of[other])
                    come = tuple(x for x in of[other] if x not in times)
                    found[gone, come] += words[t]
    total = sum(found.values())
    return [(np.array(a, np.int32), np.array(b, np.int32), n / total) for (a, b), n in found.items()]


@dataclass
class Model:
    weights: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS, np.float32))
    bias: float = -0.5
    #: Labelled rows, distinct swaps of theirs, and texts with swaps that the weights were learnt from.
    rows: int = 0
    swaps: int = 0
    swapped: int = 0

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        z = np.array([float(self.weights[r].sum()) for r in rows]) + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _flat(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    return (np.concatenate(rows) if len(rows) else np.zeros(0, np.int32)), np.repeat(np.arange(len(rows), dtype=np.int32), sizes)


def train(rows: list[np.ndarray], labels: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray, float]], rounds: int = 120, decay: float = 2e-4, counterfactual: float = 1.0, least_rows: int = 4) -> Model:
    """Adam on the mean log loss plus the absolute weights times ``decay`` (more for few rows) plus ``counterfactual`` times the texts' mean squared score change over their swaps."""
    model = Model()
    if not len(labels):
        return model
    column, row = _flat(rows)
    often = np.bincount(column, minlength=BUCKETS) >= least_rows
    used = np.flatnonzero(often)
    if not len(used):
        p = float(np.clip(labels.mean(), 1e-3, 1 - 1e-3))
        return Model(bias=float(np.log(p / (1 - p))))
    place = np.full(BUCKETS, -1, np.int32)
    place[used] = np.arange(len(used))
    keep = place[column] >= 0
    column, row = place[column[keep]], row[keep]
    n, y = len(labels), labels.astype(np.float64)
    decay *= 1 + 2000 / n
    differ = [(place[a], place[b]) for a, b, _ in pairs]
    plus, plus_row = _flat([a[a >= 0] for a, _ in differ])
    minus, minus_row = _flat([b[b >= 0] for _, b in differ])
    weight = np.array([x for _, _, x in pairs])
    swapped = round(float(weight.sum()))  # each text's weights sum to 1
    p = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    w, bias = np.zeros(len(used)), float(np.log(p / (1 - p)))
    m, v, mb, vb = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
    for k in range(1, rounds + 1):
        z = np.bincount(row, w[column], n) + bias
        error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        g, gb = np.bincount(column, error[row], len(used)) / n, error.mean()
        if len(pairs):
            change = weight * (np.bincount(plus_row, w[plus], len(pairs)) - np.bincount(minus_row, w[minus], len(pairs)))
            g += 2 * counterfactual / max(1, swapped) * (np.bincount(plus, change[plus_row], len(used)) - np.bincount(minus, change[minus_row], len(used)))
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        rate = 0.1 * (1 - 0.9 * k / rounds)
        root = np.sqrt(v / (1 - 0.99**k)) + 1e-6
        w -= rate * (m / (1 - 0.9**k)) / root
        w = np.sign(w) * np.maximum(np.abs(w) - rate * decay / root, 0)  # the absolute penalty in Adam's own metric
        bias -= rate * (mb / (1 - 0.9**k)) / (np.sqrt(vb / (1 - 0.99**k)) + 1e-6)
    model.weights[used] = w
    model.bias, model.rows, model.swaps, model.swapped = bias, n, len(pairs), swapped
    return model


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "label", id_col: str = "doc_id", text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn ``label_col`` of ``labels`` from the texts of ``docs``.

    About ``sample_rows`` labelled rows are used, chosen by a hash of their id, and never
    more than twice as many: that bounds the broadcast and what reaches the driver.
    """
    ship(docs.sparkSession)
    labelled = labels.filter(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(id_col, F.col(label_col).cast("int").alias("_y"))
    share = min(1.0, sample_rows / max(1, labelled.count()))
    chosen = labelled.filter(F.pmod(F.xxhash64(id_col), F.lit(1_000_000)) < int(share * 1_000_000)).limit(2 * sample_rows)
    texts = docs.select(id_col, text_or_empty(text_col).alias("_text")).join(F.broadcast(chosen), id_col).select("_y", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in runs(batch, 1):
                texts = part.column(1).to_pylist()
                pairs = [swaps(t) for t in texts]
                packed = [pa.array([r.tobytes() for r in features([t.encode() for t in texts])], pa.binary())]
                packed += [pa.array([[p[k].tobytes() for p in own] for own in pairs], pa.list_(pa.binary())) for k in (0, 1)]
                packed.append(pa.array([[p[2] for p in own] for own in pairs], pa.list_(pa.float64())))
                yield pa.RecordBatch.from_arrays([part.column(0), *packed], ["y", "x", "gone", "come", "weight"])

    rows, y, changes = [], [], []
    for r in texts.mapInArrow(run, "y int, x binary, gone array<binary>, come array<binary>, weight array<double>").toLocalIterator():
        rows.append(np.frombuffer(r.x, np.int32))
        y.append(r.y)
        changes += zip(r.gone, r.come, r.weight, strict=True)
    order = sorted(range(len(rows)), key=lambda i: (rows[i].tobytes(), y[i]))  # sums don't depend on partitioning
    pairs = [(np.frombuffer(bytes(a), np.int32), np.frombuffer(bytes(b), np.int32), x) for a, b, x in sorted((bytes(a), bytes(b), x) for a, b, x in changes)]
    return train([rows[i] for i in order], np.array([y[i] for i in order]), pairs)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``id_col``, the columns of ``keep``, and score (0 to 1) for every row."""
    spark = docs.sparkSession
    ship(spark)
    # 4 MB, whatever the input: one float a bucket.
    shared = spark.sparkContext.broadcast(model)

    kinds = dict(docs.dtypes)
    columns = list(dict.fromkeys([id_col, *keep]))
    own = free("score", columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in runs(batch):
                found = shared.value.scores(features([t.encode() for t in part.column(0).to_pylist()]))
                yield pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(found, pa.float64())], [*columns, own])

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in columns) + f", `{own}` double"
    return docs.select(text_or_empty(text_col).alias(free("_text", columns)), *columns).mapInArrow(run, schema)


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    return F.crc32(F.col(id_col).cast("string")) % folds == 0
