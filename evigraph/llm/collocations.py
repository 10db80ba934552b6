"""Frequent phrases and their strongest collocations by vertical positional inverted lists.

Texts are cut into words and gathered by language in *shards* of ``SHARD_WORDS`` words or one
longer text. A shard is inverted: each word has its sorted list of positions. Level by level,
the lists of the frequent phrases of k words are merge-joined with the postings of the words
that follow (and with the list of frequent phrases that starts one position later, of which
every frequent longer phrase has one): what is left are the lists of the phrases of k + 1
words, whose lengths are their exact numbers of occurrences in the shard.

Lengths of one phrase are summed over shards in *buckets*, of words by hash and of phrases by
the remainder of their key, so that only the quotient travels. Lists never leave their shard:
per level, a shard sends (phrase, length) pairs, packed in arrays by bucket, and gets back the
phrases that are frequent in all shards together, with a number and a total each. Only the
words' lists and these answers are stored, once: each level merges the lists of shorter phrases
anew from them, so that no level has lists of its own on disk, and what a level shuffles is
removed when it is summed up. A frequent phrase is written out by one of its shards at the end,
which has its words and the totals of all its parts. So no word, however common, has more than
one entry for each shard anywhere, and no phrase table is broadcast. Beyond ``LANES`` buckets or shards, packed arrays go by way of
lanes, where arrays from many senders are gathered and cut again, so that their number grows
with the input and not with its square.

Phrases go by exact numbers, never by fingerprints: a phrase is the number of its first words
and that of its last word, in 63 bits (an error says so if a corpus has more).

Defined results: a null text is empty and has no phrase; a null language is ``und``; repeated
rows and ids count each; a very long text is one shard; ties go by occurrences, then by the
phrase's bytes; an empty table, or one without a phrase of ``least`` occurrences, gives no rows.
Of the input's columns only language and text are used.
"""

from __future__ import annotations

import re
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from functools import partial
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import drop_tables, persist_table, runs, shared_dir, ship
from .words import mix

#: Words of a task's open shards together, the largest of which is closed then; and words for each of which there is a bucket.
SHARD_WORDS, BUCKET_WORDS = 2_500_000, 2_000_000
#: Destinations that are sent to directly, and entries that a lane gathers at a time.
LANES, GATHERED = 512, 2_000_000
_CUT = re.compile(rb"[.,;:!?\x0A-\x0D]")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_BREAK = b"."  # no word holds it

#: Shards in a row that are kept together, so that a task writes few files.
TOGETHER = 8
#: Bytes of a packed value that travel as one.
PIECE = 200_000

#: A shard in pieces, which come in the order of ``part``: its words with their lists' lengths (head), and the lists' positions.
_SHARD_FIELDS = pa.schema([("home", pa.int64()), ("shard", pa.int64()), ("lang", pa.string()), ("part", pa.int32()), ("n", pa.int64()), ("head", pa.binary()), ("positions", pa.binary())])
_SHARD = "home bigint, shard bigint, lang string, part int, n bigint, head binary, positions binary"
#: Phrases that are written out.
_FOUND_FIELDS = pa.schema([
    ("lang", pa.string()), ("level", pa.int32()), ("id", pa.int64()), ("phrase", pa.string()), ("a", pa.int64()), ("l", pa.list_(pa.int64())), ("r", pa.list_(pa.int64())), ("inside", pa.list_(pa.int64())),
])
_FOUND = "lang string, level int, id bigint, phrase string, a bigint, l array<bigint>, r array<bigint>, inside array<bigint>"
#: Packed entries on their way.
_SENT = "to bigint, lang string, data binary, top bigint"
_SENT_FIELDS = pa.schema([("to", pa.int64()), ("lang", pa.string()), ("data", pa.binary()), ("top", pa.int64())])


def _pieces(home: int, shard: int, lang: str, n: int, **packed: bytes) -> pa.RecordBatch:
    """Packed columns in pieces, as large values are a burden to the JVM; n, the words that have positions, stands in the first row."""
    cut = [(name, value[at : at + PIECE]) for name, value in packed.items() for at in range(0, len(value), PIECE)]
    rows = len(cut)
    columns = {"home": [home] * rows, "shard": [shard] * rows, "lang": [lang] * rows, "part": range(rows), "n": [n] + [0] * (rows - 1)}
    columns |= {c: [v if name == c else None for name, v in cut] for c in ("head", "positions")}
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in _SHARD_FIELDS], schema=_SHARD_FIELDS)


def _whole(table: pa.Table, column: str) -> dict[tuple[int, str], dict]:
    """The unpacked column of each shard."""
    held: dict[tuple[int, str], list[tuple[int, bytes]]] = {}
    for shard, lang, part, piece in zip(*(table.column(c).to_pylist() for c in ("shard", "lang", "part", column)), strict=True):
        if piece is not None:
            held.setdefault((shard, lang), []).append((part, piece))
    return {k: unpack(b"".join(piece for _, piece in sorted(v))) for k, v in held.items()}


def _sent(to: list[int], data: list[bytes], lang: str | None = None, top: int = 0) -> pa.RecordBatch:
    n = len(to)
    return pa.RecordBatch.from_arrays([pa.array(to, pa.int64()), pa.array([lang] * n, pa.string()), pa.array(data, pa.binary()), pa.array([top] * n, pa.int64())], schema=_SENT_FIELDS)


def pack(**arrays: np.ndarray | bytes) -> bytes:
    """Arrays of whole numbers and bytes as one compressed value. Numbers are laid out by their bytes, of which the higher ones are mostly alike; ascending ones as differences, and those that ascend for the most part."""
    head, parts = [], []
    for name, v in arrays.items():
        kind = "b"
        if not isinstance(v, bytes):
            kind = v.dtype.str
            if len(v) > 1 and (np.diff(v) >= 0).all() or name in ("positions", "keys"):
                kind, v = kind + "+", np.diff(v, prepend=v.dtype.type(0))
            v = v.view(np.uint8).reshape(len(v), v.dtype.itemsize).T.tobytes()
        head.append(f"{name}:{kind}:{len(v)}")
        parts.append(v)
    plain = b"".join([";".join(head).encode(), b"\n", *parts])
    return len(plain).to_bytes(8, "little") + pa.compress(plain, "zstd", asbytes=True)


def unpack(value: bytes) -> dict:
    value = pa.decompress(value[8:], int.from_bytes(value[:8], "little"), "zstd", asbytes=True)
    at = value.index(b"\n") + 1
    out = {}
    for field in value[: at - 1].decode().split(";"):
        name, kind, size = field.split(":")
        part = value[at : at + int(size)]
        at += int(size)
        if kind == "b":
            out[name] = part
            continue
        dtype = np.dtype(kind.rstrip("+"))
        v = np.ascontiguousarray(np.frombuffer(part, np.uint8).reshape(dtype.itemsize, -1).T).view(dtype).ravel()
        out[name] = np.cumsum(v, dtype=dtype) if kind[-1] == "+" else v
    return out


def packed_words(words: np.ndarray) -> bytes:
    return b" ".join(words.tolist())


def joined(parts: list[dict]) -> dict:
    """The same columns of several packed values, one after another; words as an array of bytes."""
    out = {}
    for name in parts[0]:
        values = [np.array(p[name].split(b" "), object) if isinstance(p[name], bytes) else p[name] for p in parts]
        out[name] = values[0] if len(values) == 1 else np.concatenate(values)
    return out


def word_buckets(d: dict, buckets: int) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, d["words"]), np.int64, len(d["words"])) % buckets


def phrase_buckets(d: dict, _: int) -> np.ndarray:
    return d["buckets"]


def shards_of(d: dict, _: int) -> np.ndarray:
    return d["shards"]


def lanes(to: np.ndarray, lanes: int) -> np.ndarray:
    """The first stop of entries for many destinations."""
    return to if not lanes else (mix(to) % np.uint64(lanes)).astype(np.int64)


def split(to: np.ndarray, d: dict) -> tuple[list[int], list[bytes]]:
    """Destinations and the packed columns of the entries for each, in the order given."""
    if not len(to):
        return [], []
    order = np.argsort(to, kind="stable")
    starts = np.flatnonzero(np.diff(to[order], prepend=to[order[0]] - 1))
    d = {k: v[order] for k, v in d.items()}
    ends = [*starts[1:].tolist(), len(order)]
    return to[order[starts]].tolist(), [pack(**{k: packed_words(v[a:b]) if v.dtype == object else v[a:b] for k, v in d.items()}) for a, b in zip(starts.tolist(), ends, strict=True)]


def _top(d: dict) -> int:
    """What all numbers of phrases in packed entries are below, each in its bucket."""
    return int(d["ids"].max(initial=-1)) + 1 if "ids" in d else 0


def relay(batches: Iterator[pa.RecordBatch], destination, n: int) -> Iterator[pa.RecordBatch]:
    """What lanes do: gather entries of many senders, and cut them by their own destinations."""
    held: dict[str | None, list[dict]] = {}
    count = 0

    def send() -> Iterator[pa.RecordBatch]:
        for lang, parts in held.items():
            d = joined(parts)
            yield _sent(*split(destination(d, n), d), lang, _top(d))
        held.clear()

    for batch in batches:
        for lang, data in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            d = unpack(data)
            held.setdefault(lang, []).append(d)
            count += len(d["shards"])
            if count >= GATHERED:
                yield from send()
                count = 0
    yield from send()


def pieces(text: bytes) -> list[bytes]:
    """The text's words in lower case (A-Z), with a mark where a piece ends."""
    return _CUT.sub(b" . ", text).translate(_LOWER).split()


def invert(names: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of each name from 0 to n - 1, one sorted list after another, and the lists' lengths; other positions are left out."""
    at = np.flatnonzero(names >= 0)
    return at[np.argsort(names[at], kind="stable")].astype(np.int32), np.bincount(names[at], minlength=n).astype(np.int64)


def merge_join(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where two sorted lists of distinct positions agree: the places in both."""
    at = np.searchsorted(right, left)
    hit = np.flatnonzero(at < len(right))
    hit = hit[right[at[hit]] == left[hit]]
    return hit, at[hit]


def index(batches: Iterator[pa.RecordBatch], shard_words: int) -> Iterator[pa.RecordBatch]:
    """Shards of a task's texts."""
    held: dict[str, tuple[dict, list]] = {}
    sizes: dict[str, int] = {}
    shards, task = 0, TaskContext.get().partitionId()

    def close(lang: str) -> Iterator[pa.RecordBatch]:
        nonlocal shards
        (known, parts), _ = held.pop(lang), sizes.pop(lang)
        names, words = np.concatenate(parts) - 1, np.array(list(known)[1:], object)  # the break has name 0
        positions, lengths = invert(names, len(words))
        if not len(positions):
            return
        shard = task << 32 | shards
        shards += 1
        yield _pieces(shard - shard % TOGETHER, shard, lang, len(positions), head=pack(words=packed_words(words), lengths=lengths), positions=pack(positions=positions))

    for batch in batches:
        for part in runs(batch, 1):
            for lang, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(), strict=True):
                if not text:
                    continue
                words = pieces(text)
                if lang not in held:
                    held[lang] = defaultdict(count(1).__next__, {_BREAK: 0}), []
                known, parts = held[lang]
                parts.append(np.fromiter(map(known.__getitem__, [*words, _BREAK]), np.int32, len(words) + 1))
                sizes[lang] = sizes.get(lang, 0) + len(words) + 1
                if sum(sizes.values()) >= shard_words:
                    yield from close(max(sizes, key=sizes.get))
    for key in list(held):
        yield from close(key)


def count_words(group: pa.Table) -> tuple[dict, np.ndarray, int]:
    known: dict[tuple, int] = {}
    parts, of = [], []
    for lang, data in zip(group.column("lang").to_pylist(), group.column("data").to_pylist(), strict=True):
        d = unpack(data)
        of.append(np.array([known.setdefault((lang, w), len(known)) for w in d.pop("words").split(b" ")], np.int64))
        d["keys"] = d.pop("names")
        parts.append(d)
    return joined(parts), np.concatenate(of), len(known)


def count_phrases(group: pa.Table) -> tuple[dict, np.ndarray, int]:
    d = joined([unpack(data) for data in group.column("data").to_pylist()])
    known, of = np.unique(d["keys"], return_inverse=True)
    return d, of, len(known)


def answers(group: pa.Table, counted, least: int, stops: int) -> pa.Table:
    """The frequent phrases of a bucket for each shard that has them: the shard's own key, the phrase's number in the bucket, its total, and whether the shard writes it out."""
    d, of, n = counted(group)
    total, writer = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max)
    np.add.at(total, of, d["lengths"])
    np.minimum.at(writer, of, d["shards"])
    number = np.cumsum(total >= least) - 1  # of those in the bucket
    kept = total[of] >= least
    of, shards = of[kept], d["shards"][kept]
    bucket = np.full(len(of), group.column("to")[0].as_py())
    back = {"keys": d["keys"][kept], "ids": number[of], "totals": total[of], "own": (writer[of] == shards).astype(np.int8), "shards": shards, "buckets": bucket}
    return pa.Table.from_batches([_sent(*split(lanes(shards, stops), back), top=_top(back))])


def word_lengths(shards: pa.Table, buckets: int, stops: int) -> pa.Table:
    """What shards that are kept together send of their words."""
    out = []
    for (shard, lang), d in _whole(shards, "head").items():
        words = np.array(d["words"].split(b" "), object)
        sent = {"names": np.arange(len(words)), "words": words, "lengths": d["lengths"], "shards": np.full(len(words), shard)}
        out.append(_sent(*split(lanes(word_buckets(sent, buckets), stops), sent), lang))
    return pa.Table.from_batches(out, _SENT_FIELDS)


def told_lists(shards: pa.Table, answers: pa.Table, level: int, bits: int, buckets: int) -> Iterator[tuple[int, str, np.ndarray, dict]]:
    """For each shard that has frequent words: its number, its language, these words, and its lists of frequent phrases of up to ``level`` words, as far as it has any."""
    back: dict[int, dict[int, list[dict]]] = {}
    for k, to, data in zip(*(answers.column(c).to_pylist() for c in ("level", "to", "data")), strict=True):
        back.setdefault(to, {}).setdefault(k, []).append(data)
    heads, positions = _whole(shards, "head"), _whole(shards, "positions")
    for shard, lang in list(heads):
        head, at = heads.pop((shard, lang)), positions.pop((shard, lang))["positions"]
        told = {k: joined([unpack(v) for v in data]) for k, data in back.pop(shard, {}).items() if k <= level}
        for k, d in told.items():
            d["ids"] = d["ids"] * buckets + d["buckets"]
            if k > 1:
                d["keys"] = d["keys"] * buckets + d["buckets"]
        if told:
            yield shard, lang, *frequent_lists(head, at, told, bits)


def frequent_lists(head: dict, positions: np.ndarray, told: dict[int, dict], bits: int) -> tuple[np.ndarray, dict]:
    """A shard's frequent words, and by number of words its frequent phrases' numbers and totals, the positions at which they begin, the place of the phrase at each, and whether the shard writes it out."""
    keys = told[1]["keys"]
    place = np.full(len(head["lengths"]), -1, np.int32)
    place[keys] = np.arange(len(keys))
    names = np.full(int(positions.max()) + 1, -1, np.int32)
    names[positions] = np.repeat(place, head["lengths"])
    at = np.flatnonzero(names >= 0).astype(np.int32)
    lists = {1: (told[1]["ids"], told[1]["totals"], at, names[at], told[1]["own"])}
    for k in range(2, max(told) + 1):
        order = np.argsort(told[k]["keys"])
        keys, ids, totals, own = (told[k][c][order] for c in ("keys", "ids", "totals", "own"))
        candidate, at = _joined(lists, k, bits)
        of = np.minimum(np.searchsorted(keys, candidate), len(keys) - 1).astype(np.int32)
        hit = keys[of] == candidate
        lists[k] = (ids, totals, at[hit], of[hit], own)
    return np.array(head["words"].split(b" "), object)[told[1]["keys"]], lists


def phrase_lengths(shards: pa.Table, answers: pa.Table, level: int, bits: int, buckets: int, stops: int) -> pa.Table:
    """What shards that are kept together send of their candidates of ``level`` words."""
    out = []
    for shard, _, _, lists in told_lists(shards, answers, level - 1, bits, buckets):
        if level - 1 in lists:
            keys, n = np.unique(_joined(lists, level, bits)[0], return_counts=True)
            bucket = keys % buckets
            order = np.argsort(bucket, kind="stable")
            sent = {"keys": keys[order] // buckets, "buckets": bucket[order], "lengths": n[order], "shards": np.full(len(keys), shard)}
            out.append(_sent(*split(lanes(phrase_buckets(sent, buckets), stops), sent)))
    return pa.Table.from_batches(out, _SENT_FIELDS)


def written_out(shards: pa.Table, answers: pa.Table, longest: int, bits: int, buckets: int) -> pa.Table:
    """The phrases of two words or more that shards kept together write out."""
    out = []
    for _, lang, text, lists in told_lists(shards, answers, longest, bits, buckets):
        for level in range(2, max(lists) + 1):
            own = np.flatnonzero(lists[level][4])
            if len(own):
                out.append(_written(lists, level, own, text, lang))
    return pa.Table.from_batches(out, _FOUND_FIELDS)


def _alone(f, *known):
    """``f`` as a function of one table alone."""
    return lambda shards: f(shards, *known)


def _told(f, *known):
    """``f`` as a function of two tables alone."""
    return lambda shards, answers: f(shards, answers, *known)


def _joined(lists: dict, level: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and positions of the candidates of ``level`` words: a frequent phrase one word shorter, the posting of its next word, and one that starts a word later."""
    ids, _, at, of, _ = lists[level - 1]
    a, b = merge_join(at, at - 1)  # the phrase at a position, and the one a word later
    word_ids, _, word_at, word_of, _ = lists[1]
    if level == 2:
        last = of[b]
    else:
        last_at, last = merge_join(at[a] + level - 1, word_at)
        a, last = a[last_at], word_of[last]
    return ids[of[a]] << bits | word_ids[last], at[a]


def _written(lists: dict, level: int, own: np.ndarray, text: np.ndarray, lang: str) -> pa.RecordBatch:
    """One row for each own phrase, read off one of its occurrences: its words, its parts' totals, and the phrases inside it."""
    ids, totals, at, of, _ = lists[level]
    first = np.zeros(len(ids), np.int64)
    first[of[::-1]] = at[::-1]
    start = first[own]
    word, value, inner = {}, {}, {}
    for k in range(1, level + 1):
        k_ids, k_totals, k_at, k_of, _ = lists[k]
        for shift in range(level - k + 1):
            place = k_of[np.searchsorted(k_at, start + shift)]
            value[k, shift], inner[k, shift] = k_totals[place], k_ids[place]
            if k == 1:
                word[shift] = text[place]
    phrases = [b" ".join(w) for w in zip(*(word[s] for s in range(level)), strict=True)]
    left = np.stack([value[k, 0] for k in range(1, level)], 1)
    right = np.stack([value[level - k, k] for k in range(1, level)], 1)
    inside = [np.stack([np.full(len(own), k), inner[k, s]], 1) for k in range(2, level) for s in range(level - k + 1)]
    inside = np.concatenate(inside, 1) if inside else np.zeros((len(own), 0), np.int64)
    n = len(own)
    columns = {"lang": [lang] * n, "level": [level] * n, "id": ids[own], "phrase": [p.decode() for p in phrases], "a": totals[own], "l": left.tolist(), "r": right.tolist(), "inside": inside.tolist()}
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in _FOUND_FIELDS], schema=_FOUND_FIELDS)


class _Table:
    """A table in the shared folder, bucketed by home, so that what is kept together is not shuffled when it is read."""

    def __init__(self, spark: SparkSession, buckets: int):
        self.spark, self.buckets = spark, buckets
        self.name = f"collocations_{uuid.uuid4().hex}"
        self._shared_path = f"{shared_dir(spark)}/{self.name}"

    def add(self, rows: DataFrame) -> None:
        # what is packed is compressed already, and compressors of many files hold memory outside the heap
        rows.write.mode("append").bucketBy(self.buckets, "home").option("path", self._shared_path).option("compression", "uncompressed").saveAsTable(self.name)

    @property
    def all(self) -> DataFrame:
        return self.spark.table(self.name)

    def drop(self) -> None:
        back = self.all
        back._shared_path = self._shared_path
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        drop_tables(back)


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Spark removes what a query has shuffled when that query ends, and not when the driver happens to collect its garbage: here each query runs once, and writes its result."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def _delivered(rows: DataFrame, stops: int, destination, n: int) -> DataFrame:
    """Packed entries at their destinations, by way of lanes if there are ``stops``."""
    return rows.repartition("to").mapInArrow(partial(relay, destination=destination, n=n), _SENT) if stops else rows


def mine(
    docs: DataFrame, least: int = 30, longest: int = 4, lang_col: str = "lang", text_col: str = "text", shard_words: int = SHARD_WORDS, bucket_words: int = BUCKET_WORDS, direct: int = LANES
) -> tuple[DataFrame, DataFrame]:
    """Two tables: lang, level (words), id, phrase, a (occurrences), l and r (occurrences of the first and the last part at each cut) and inside (level and id
    of each frequent phrase of two words or more in it) for every phrase of 2 to ``longest`` words that occurs ``least`` times in its language; and lang and n, all words.

    Occurrences lie within pieces between ``.,;:!?`` and line ends, and overlap. Both tables lie in the shared folder.
    """
    spark = docs.sparkSession
    ship(spark)
    with _shuffles_removed(spark):
        return _mined(docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text")), least, longest, shard_words, bucket_words, direct)


def _mined(cut: DataFrame, least: int, longest: int, shard_words: int, bucket_words: int, direct: int) -> tuple[DataFrame, DataFrame]:
    # about six bytes a word
    words = int(cut.agg(F.coalesce(F.sum(F.octet_length("text").cast("bigint")), F.lit(0))).first()[0]) // 6
    buckets = max(9, words // bucket_words) | 1  # odd, so that the remainder of a key depends on both its numbers
    outward = direct if buckets > direct else 0
    # tasks that hold shards: a setting of Spark bounds how many a table may have
    folders = min(100_000, max(int(cut.sparkSession.conf.get("spark.sql.shuffle.partitions")), words // (16 * shard_words)))
    shards, told = (_Table(cut.sparkSession, folders) for _ in range(2))
    shards.add(cut.mapInArrow(partial(index, shard_words=shard_words), _SHARD))
    totals = persist_table(shards.all.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    homeward = direct if shards.all.filter("part = 0").count() > direct else 0
    bits = 0

    def by_home(f, shape: str) -> DataFrame:
        """Of shards that are kept together and all that they were told."""
        return shards.all.groupBy("home").cogroup(told.all.groupBy("home")).applyInArrow(f, shape)

    for level in range(1, longest + 1):
        if level == 1:
            counted, hashed = count_words, word_buckets
            sent = shards.all.filter("head IS NOT NULL").select("home", "shard", "lang", "part", "head").groupBy("home").applyInArrow(_alone(word_lengths, buckets, outward), _SENT)
        else:
            counted, hashed = count_phrases, phrase_buckets
            sent = by_home(_told(phrase_lengths, level, bits, buckets, outward), _SENT)
        back = _delivered(sent, outward, hashed, buckets).groupBy("to").applyInArrow(_alone(answers, counted, least, homeward), _SENT)
        back = _delivered(back, homeward, shards_of, 0)
        told.add(back.select((F.col("to") - F.pmod("to", F.lit(TOGETHER))).alias("home"), F.lit(level).alias("level"), "to", "data", "top").repartition(folders, "home"))
        width = (int(told.all.filter(F.col("level") == level).agg(F.coalesce(F.max("top"), F.lit(0))).first()[0]) * buckets).bit_length()
        bits = bits or max(1, width)
        if level < longest and width + bits > 63:
            raise ValueError("more frequent phrases than 63 bits number: raise least")
    found = persist_table(by_home(_told(written_out, longest, bits, buckets), _FOUND), "phrases")
    shards.drop()
    told.drop()
    return found, totals


def collocations(docs: DataFrame, least: int = 30, longest: int = 4, absorbed: int = 80, scale: int = 2_000_000, top: int = 2000, lang_col: str = "lang", text_col: str = "text", **sizes: int) -> DataFrame:
    """Each language's ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    The score of a cut is ``scale * a / (l + r)`` rounded down, and a phrase has that of its weakest cut, the first of equals.
    A phrase goes if a longer one that holds it has ``absorbed`` percent of its occurrences or more.
    """
    found, totals = mine(docs, least, longest, lang_col, text_col, **sizes)
    longer = found.select("a", F.explode(F.transform(F.sequence(F.lit(0), F.lit(longest * longest)), lambda i: F.struct(F.get("inside", 2 * i).alias("level"), F.get("inside", 2 * i + 1).alias("id")))).alias("x"))
    longer = longer.filter("x.id IS NOT NULL").groupBy(F.col("x.level").cast("int").alias("level"), F.col("x.id").alias("id")).agg(F.max("a").alias("longer"))
    wide = "decimal(38,0)"
    kept = found.join(longer, ["level", "id"], "left").filter(F.col("longer").isNull() | (F.col("longer").cast(wide) * 100 < F.col("a").cast(wide) * absorbed))
    cuts = F.expr(f"transform(l, (x, i) -> struct(CAST({scale} AS DECIMAL(10,0)) * CAST(a AS DECIMAL(20,0)) div (x + r[i]) AS score, i AS k, x AS l, r[i] AS r))")
    scored = kept.select("lang", "phrase", "a", F.array_min(cuts).alias("x")).select("lang", "phrase", "a", "x.l", "x.r", "x.score")
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    # the best of each part first, so that no task orders a whole language
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    some = scored.withColumn("_part", part).withColumn("_rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).filter(F.col("_rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
