"""N-gram Jaccard join by parity sketches.

Each distinct shingle flips one bit of its document's sketch, so the Hamming distance of
two sketches never exceeds the symmetric difference of their shingle sets. Sets of sizes
a and b whose similarity reaches t differ in at most (a + b)(1 - t)/(1 + t) shingles. Sizes
are split into bands so wide that similar sets lie in the same band or in neighbours; for
each band the sketch is cut into one segment more than similar sets of that band can
differ in, so by the pigeonhole principle similar sets agree on a whole segment. Two sets
often agree on a segment because it is empty in both. So there is one segment more for each
``GROUP`` of them: similar sets then agree on a segment that is not empty, or on two empty
ones of a group. Equal segments and equal pairs of empty ones give buckets; pairs of a bucket
whose sketches are near enough are verified on the words themselves.

A set has keys in its own band and in the next. Sets of the same band meet in their own, so
in a bucket only pairs with a member of the bucket's own band count.

Only what connects documents is needed, so buckets are never expanded into all pairs. Keys
are counted with map-side aggregation, and only members of buckets that hold two or more are
listed. Buckets go once through blockwise sketch comparison for their near pairs; a chain of
``CHAIN`` near members or more is not compared inside, and its bucket is marked. Each document is
verified against the nearest of those that it is near to, then against the others that are in
another component. Marked buckets whose members still are in several components go through
the comparison again, now for all near pairs between components. No link is lost.

Equal sets (equal up to 64-bit hashes of shingles, and their number) form a class, of
which the smallest id stands for all.

Defined results: a null or wordless text has the empty set, links with nothing and is its
own component; fewer words than the shingle length make one shingle; a row without an id
is kept, links with nothing and has no component; an id that repeats with other texts links through
each of them; repeated rows are kept; an empty table gives no rows, a very long text is shingled as a
whole. Of the input's columns only id and text are used.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_tables, few, persist_table, runs, ship, text_or_empty
from .components import components
from .words import SOLID, borders, hashes, lowered, mix

#: Members of a bucket in one block of the blockwise comparison.
BLOCK = 4096
#: Bits of a segment of the sketch, and of the whole-set sketch for each shingle.
SEGMENT_BITS, BITS_A_SHINGLE = 1 << 16, 1
#: Near members of a block that the first comparison takes for one group.
CHAIN = 32
#: Segments among which two empty ones make a key.
GROUP = 32
#: 64-bit words at most, and bits a key, of the filter of large buckets' keys; a fuller filter only lets more keys pass to the join after it.
FILTER_WORDS, FILTER_BITS = 1 << 21, 4
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_U = np.uint64


@lru_cache(4)
def bands(num: int, den: int) -> tuple[int, ...]:
    """The least size of each band, for the similarity num / den: sets of a band are similar to none two bands away."""
    low = [1]
    while low[-1] < 1 << 40:
        low.append(den * low[-1] // num + 1)
    return tuple(low)


def most_apart(a: int, b: int, num: int, den: int) -> int:
    """The largest symmetric difference of similar sets of these sizes."""
    return (a + b) * (den - num) // (den + num)


def shingle_hashes(texts: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles."""
    raw, at = lowered(texts)
    start, end = borders(raw, SOLID)
    word = hashes(raw, start, end)
    first = np.searchsorted(start, at)
    run = word.copy()
    for k in range(1, min(size, len(word))):
        run[: len(word) - k] = mix(run[: len(word) - k]) + word[k:]
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            out.append(np.unique(run[a : b - size + 1]))
        elif b > a:
            total = word[a : a + 1].copy()
            for k in range(a + 1, b):
                total = mix(total) + word[k : k + 1]
            out.append(total + _U(b - a))  # short sequences differ from full shingles
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def segment_keys(sets: list[np.ndarray], num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the sets' parity sketches, set by set, and where each set's keys begin, with the end.

    Those in the set's own band have the lowest bit set, those in the next have it clear.
    """
    low = bands(num, den)
    sizes = np.fromiter(map(len, sets), np.int64, len(sets))
    band = np.searchsorted(np.array(low[: bisect_right(low, int(sizes.max(initial=1))) + 1]), sizes, "right") - 1
    whole = np.concatenate([*sets, np.zeros(0, np.uint64)])
    spread = mix(whole ^ _U(0x5851F42D4C957F2D))
    found, owner = [], []
    for step in (0, 1):
        top = np.array([low[k + 1] - 1 if k >= 0 else 0 for k in (band + step).tolist()], np.int64)
        apart = np.where(sizes > 0, 2 * top * (den - num) // (den + num), 0)  # similar sets of a band with 0 are equal
        groups = -(-apart // GROUP)
        n = np.where(apart > 0, apart + 1 + groups, 0)
        first = np.concatenate([[0], np.cumsum(n)])  # each set's segments are a run
        width = np.repeat(n, sizes)
        used = width > 0
        # a bit's place among all segments of all sets
        bit = (spread[used] % (width[used] * SEGMENT_BITS).astype(np.uint64)).astype(np.int64) + np.repeat(first[:-1], sizes)[used] * SEGMENT_BITS
        bit.sort()
        edge = np.flatnonzero(np.append(True, bit[1:] != bit[:-1])) if len(bit) else np.zeros(0, np.int64)
        bit = bit[edge[np.diff(np.append(edge, len(bit))) & 1 == 1]]
        holder = np.repeat(np.arange(len(sets)), n)
        place = np.arange(first[-1]) - first[holder]
        named = mix(place.astype(np.uint64) + (np.repeat(band + step, n) << 32).astype(np.uint64))
        segment = bit // SEGMENT_BITS
        begin = np.flatnonzero(np.append(True, segment[1:] != segment[:-1])) if len(bit) else np.zeros(0, np.int64)
        at = segment[begin]
        if len(at):
            inner = (bit - first[holder[segment]] * SEGMENT_BITS).astype(np.uint64)
            found.append(mix(named[at] + np.add.reduceat(mix(inner + _U(1)), begin)) & ~_U(1) | _U(step == 0))
            owner.append(holder[at])
        empty = np.setdiff1d(np.arange(first[-1]), at, assume_unique=True)
        group = place[empty] * groups[holder[empty]] // np.maximum(1, n[holder[empty]]) + holder[empty] * (1 << 32)
        for away in range(1, GROUP + 2):
            same = np.flatnonzero(group[away:] == group[:-away])
            if not len(same):
                break  # groups are runs
            found.append(mix(mix(named[empty[same]]) ^ named[empty[same + away]]) & ~_U(1) | _U(step == 0))
            owner.append(holder[empty[same]])
    keys, of = np.concatenate([*found, np.zeros(0, np.uint64)]).view(np.int64), np.concatenate([*owner, np.zeros(0, np.int64)])
    order = np.argsort(of, kind="stable")
    return keys[order], np.searchsorted(of[order], np.arange(len(sets) + 1))


def parity_sketch(own: np.ndarray, num: int, den: int) -> bytes:
    """The whole set's sketch; its width follows the set's band, so that of a neighbouring band folds onto it.

    Widths are powers of two: folding halves by XOR gives the narrower sketch of the same set.
    """
    width = max(64, 1 << int(len(own) * BITS_A_SHINGLE).bit_length())
    bit = (mix(own ^ _U(0x14057B7EF767814F)) & _U(width - 1)).astype(np.int64)
    return np.packbits(np.bincount(bit, minlength=width).astype(np.uint8) & 1, bitorder="little").tobytes()


def hamming(a: bytes, b: bytes) -> int:
    x, y = (np.frombuffer(s, np.uint64) for s in (a, b))
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _sets(docs: DataFrame, size: int, num: int, den: int, id_col: str, text_col: str, keys: bool = False, words: Broadcast | None = None) -> DataFrame:
    """Id, size and two hashes of each row's set, and its sketch or, asked for ``keys``, those that may be in the filter ``words``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in runs(batch, 1):
                sets = shingle_hashes([t.encode() for t in part.column(1).to_pylist()], size)
                if keys:
                    found, at = segment_keys(sets, num, den)
                    if words:
                        may = _listed(found, words.value)
                        found, at = found[may], np.append(0, np.cumsum(may))[at]
                    last = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(found, pa.int64()))
                else:
                    last = pa.array([parity_sketch(s, num, den) if len(s) else None for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([
                    part.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([int(mix(s).sum(dtype=np.uint64).view(np.int64)) for s in sets], pa.int64()),
                    pa.array([int(mix(s ^ _U(0x2545F4914F6CDD1D)).sum(dtype=np.uint64).view(np.int64)) for s in sets], pa.int64()),
                    last,
                ], ["id", "n", "s1", "s2", "keys" if keys else "sketch"])

    schema = f"id {dict(docs.dtypes)[id_col]}, n bigint, s1 bigint, s2 bigint, " + ("keys array<bigint>" if keys else "sketch binary")
    return docs.select(id_col, text_or_empty(text_col).alias("_text")).mapInArrow(run, schema)


def _filter(listed: DataFrame) -> np.ndarray:
    """A blocked Bloom filter of ``key``: each key sets FILTER_BITS bits of one word. Two bytes a key, and 16 MB at most."""
    n = min(FILTER_WORDS, max(1024, 1 << (listed.count() // 4).bit_length()))
    bits = [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftright("key", 24 + 6 * i).bitwiseAND(F.lit(63).cast("bigint")).cast("int")) for i in range(FILTER_BITS)]
    words = listed.groupBy(F.pmod("key", F.lit(n).cast("bigint")).alias("at")).agg(F.bit_or(reduce(lambda x, y: x.bitwiseOR(y), bits)).alias("word"))
    out = np.zeros(n, np.int64)
    found = words.toArrow()
    out[found.column("at").to_numpy()] = found.column("word").to_numpy()
    return out


def _listed(keys: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Whether each key may be in the filter, which knows them without their lowest bit."""
    bucket = keys >> 1
    mask = np.zeros(len(keys), np.int64)
    for i in range(FILTER_BITS):
        mask |= np.int64(1) << (bucket >> (24 + 6 * i) & 63)
    return words[bucket & (len(words) - 1)] & mask == mask


def _near(pairs: DataFrame, reps: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs (a, b) whose sketches may belong to similar sets, with the distance ``h``."""
    left, right = (reps.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("sketch").alias(f"sketch_{x}")) for x in "ab")
    both = pairs.join(left, "a").join(right, "b").filter(F.least("n_a", "n_b") * den >= F.greatest("n_a", "n_b") * num)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, na, nb, sa, sb = (batch.column(k).to_pylist() for k in range(6))
            h = [hamming(x, y) for x, y in zip(sa, sb, strict=True)]
            ok = pa.array([d <= most_apart(p, q, num, den) for d, p, q in zip(h, na, nb, strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(h, pa.int64())], ["a", "b", "h"]).filter(ok)

    kind = dict(reps.dtypes)["id"]
    return both.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(run, f"a {kind}, b {kind}, h bigint")


def _shingles(text: str, size: int) -> frozenset:
    words = _WORD.findall(text.translate(_FOLD))
    return frozenset(zip(*(words[k:] for k in range(size)), strict=False)) if len(words) >= size else frozenset([tuple(words)] if words else [])


def _verify(pairs: DataFrame, texts: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Pairs with ``linked``: the similarity of the shingle sets, on words, reaches num / den."""
    both = pairs.select("a", "b").join(texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a").join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, frozenset] = {}
        held = 0

        def shingles(text: str) -> frozenset:
            nonlocal held
            if text not in known:
                if held > 500_000:
                    known.clear()
                    held = 0
                known[text] = _shingles(text, size)
                held += len(text)
            return known[text]

        for batch in batches:
            out = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                p, q = shingles(x), shingles(y)
                shared = len(p & q)
                out.append(den * shared >= num * (len(p) + len(q) - shared) and bool(p))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.bool_())], ["a", "b", "linked"])

    kind = dict(texts.dtypes)["id"]
    found = both.select("a", "b", "text_a", "text_b").mapInArrow(run, f"a {kind}, b {kind}, linked boolean")
    return found.groupBy("a", "b").agg(F.max("linked").alias("linked"))


def _blockwise(buckets: DataFrame, reps: DataFrame, num: int, den: int, labels: DataFrame | None = None) -> DataFrame:
    """Near pairs (a, b, h) of the same bucket, one member at least of the bucket's own band; rows with a ``key`` alone mark incomplete buckets.

    With ``labels`` all near pairs between components, and no marks. A bucket's members are dealt
    to blocks; each pair of blocks is one group of bounded size.
    """
    kind, known = dict(reps.dtypes)["id"], labels is not None
    sketched = reps.withColumn("c", F.lit(None).cast(kind))
    if known:
        sketched = reps.join(labels, F.col("id") == F.col("node"), "left").withColumn("c", F.coalesce("component", "id")).drop("node", "component")
    blocks = F.ceil(F.col("n_key") / BLOCK).cast("int")
    dealt = buckets.withColumn("blocks", blocks).withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).join(sketched, "id")
    each = dealt.withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    each = each.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "c", F.col("n").cast("int").alias("n"), "sketch", "own_band")
    sorted_ = each.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "id")

    def pairs_of(own, ids, c, n, sketch, own_band, i, j):
        m = len(ids)
        width = min(map(len, sketch)) // 8
        folded = np.empty((m, width), np.uint64)
        for k, s in enumerate(sketch):
            x = np.frombuffer(s, np.uint64)
            while len(x) > width:
                x = x[: len(x) // 2] ^ x[len(x) // 2 :]
            folded[k] = x
        n, own, own_band = np.array(n, np.int64), np.array(own), np.array(own_band)
        chain = np.unique(np.array(c), return_inverse=True)[1] if known else np.arange(m)
        out, whole = [], True
        for k in range(m - 1):
            rest = slice(k + 1, m)
            may = (own_band[rest] | own_band[k]) & (np.minimum(n[rest], n[k]) * den >= np.maximum(n[rest], n[k]) * num)
            if i != j:
                may &= own[rest] != own[k]
            if known or np.count_nonzero(chain == chain[k]) >= CHAIN:
                other = chain[rest] != chain[k]
                whole = whole and not (may & ~other).any()
                may &= other
            hit = np.flatnonzero(may) + k + 1
            if not len(hit):
                continue
            h = np.bitwise_count(folded[hit] ^ folded[k]).sum(axis=1, dtype=np.int64)
            near = h <= (n[hit] + n[k]) * (den - num) // (den + num)
            hit, h = hit[near], h[near]
            out += [(ids[k], ids[x], d) for x, d in zip(hit.tolist(), h.tolist(), strict=True)]
            if not known and len(hit):
                chain[np.isin(chain, chain[hit])] = chain[k]
        return out, whole or known

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, group = None, []

        def close():
            made, whole = pairs_of(*zip(*group, strict=True), held[1], held[2]) if len(group) > 1 else ([], True)
            marks = [] if whole else [held[0]]
            columns = [[*(p[k] for p in made), *(None for _ in marks)] for k in range(3)]
            return pa.RecordBatch.from_arrays([pa.array(columns[0], id_type), pa.array(columns[1], id_type), pa.array(columns[2], pa.int64()), pa.array([*(None for _ in made), *marks], pa.int64())], ["a", "b", "h", "key"])

        for batch in batches:
            id_type = batch.schema.field("id").type
            columns = [batch.column(k).to_pylist() for k in range(9)]
            for key, i, j, *row in zip(*columns, strict=True):
                if (key, i, j) != held:
                    if group:
                        yield close()
                    held, group = (key, i, j), []
                group.append(row)
        if group:
            yield close()

    return sorted_.mapInArrow(run, f"a {kind}, b {kind}, h bigint, key bigint").distinct()


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends are in different components."""
    for x in "ab":
        pairs = pairs.join(labels.select(F.col("node").alias(x), F.col("component").alias(f"c{x}")), x, "left").withColumn(f"c{x}", F.coalesce(f"c{x}", x))
    return pairs.filter("ca <> cb").select("a", "b")


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels when ``links`` (a, b) join components; the old table goes."""
    ends = links
    for x in "ab":
        ends = ends.join(labels.select(F.col("node").alias(x), F.col("component").alias(f"c{x}")), x, "left").withColumn(f"c{x}", F.coalesce(f"c{x}", x))
    joined = components(ends, "ca", "cb")
    moved = labels.join(joined.select(F.col("node").alias("component"), F.col("component").alias("to")), "component", "left")
    out = persist_table(moved.select("node", F.coalesce("to", "component").alias("component")).union(joined.select("node", "component")), "components")
    drop_tables(labels, joined)
    return out


def link(docs: DataFrame, shingle: int = 5, similarity: tuple[int, int] = (4, 5), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, n_shingles and component_id (the smallest id reachable by links) for every row.

    Two documents are linked when the Jaccard similarity of their sets of ``shingle``-word
    shingles is at least the ratio ``similarity``.
    """
    num, den = similarity
    spark = docs.sparkSession
    ship(spark)
    made = persist_table(_sets(docs, shingle, num, den, id_col, text_col), "sets")
    classes = persist_table(made.filter("n > 0").groupBy("n", "s1", "s2").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "classes")

    # copies go: the smallest id of a class stays
    named = made.filter("n > 0 AND id IS NOT NULL")
    copied = few(classes.filter("copies > 1 AND rep IS NOT NULL").select("n", "s1", "s2", "rep"))
    spare = persist_table(named.select("id", "n", "s1", "s2").join(copied, ["n", "s1", "s2"]).filter("id <> rep").distinct(), "spare")
    copies = few(spare.select("id", "n", "s1", "s2"))
    without = lambda sets: sets.filter("n > 0 AND id IS NOT NULL").join(copies, ["id", "n", "s1", "s2"], "left_anti")
    reps = persist_table(without(named).select("id", "n", "sketch").distinct(), "reps")

    def keyed(words: Broadcast | None = None) -> DataFrame:
        """The keys of all that are left; made from the texts each time, as they take more room than these."""
        every = without(_sets(docs, shingle, num, den, id_col, text_col, True, words)).select("id", F.explode("keys").alias("k"))
        return every.select("id", F.shiftright("k", 1).alias("key"), (F.col("k").bitwiseAND(F.lit(1).cast("bigint")) == 1).alias("own_band"))

    # a key's rows and, in the upper half, those of its own band: one number, as this is the largest shuffle
    told = F.sum(F.when(F.col("own_band"), F.lit((1 << 32) + 1)).otherwise(F.lit(1)).cast("bigint"))
    counted = keyed().groupBy("key").agg(told.alias("told")).filter(f"told >= {1 << 32} AND told % {1 << 32} > 1")
    counted = persist_table(counted.select("key", (F.col("told") % (1 << 32)).cast("int").alias("n_key")), "counted")
    words = spark.sparkContext.broadcast(_filter(counted.select("key")))
    members = persist_table(keyed(words).distinct().join(counted, "key"), "members")
    # of buckets with the same members (by number, least, greatest and a hash over all) one stands for all
    same = [F.count("*").alias("m"), F.min("id").alias("a"), F.max("id").alias("b"), F.bit_xor(F.xxhash64("id")).alias("x"), F.max("own_band").alias("any")]
    chosen = persist_table(members.groupBy("key").agg(*same).filter("m > 1 AND any").groupBy("m", "a", "b", "x").agg(F.min("key").alias("key")), "chosen")
    buckets = persist_table(members.join(chosen.filter("m > 2").select("key"), "key", "left_semi"), "buckets")
    met = persist_table(_blockwise(buckets, reps, num, den).unionByName(_near(chosen.filter("m = 2").select("a", "b"), reps, num, den), allowMissingColumns=True), "met")
    drop_tables(counted, members, chosen)

    def verified(pairs: DataFrame) -> DataFrame:
        wanted = persist_table(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "wanted")
        own = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
        texts = persist_table(own.join(few(wanted), "id", "left_semi"), "texts")
        found = persist_table(_verify(pairs, texts, shingle, num, den), "checked")
        drop_tables(wanted, texts, pairs)
        return found

    # first each document against the nearest that it meets, then against the other near ones that lie apart
    near = met.filter("key IS NULL")
    first = persist_table(near.groupBy("b").agg(F.min_by("a", F.struct("h", "a")).alias("a")).select("a", "b"), "pairs")
    rounds = [verified(first)]
    labels = components(rounds[0].filter("linked"), "a", "b")
    marked = buckets.join(met.filter("key IS NOT NULL").select("key").distinct(), "key", "left_semi")
    for step in (lambda: _apart(near.select("a", "b").distinct(), labels), lambda: _apart(_blockwise(marked, reps, num, den, labels).select("a", "b").distinct(), labels)):
        pairs = step()
        for done in rounds:
            pairs = pairs.join(done, ["a", "b"], "left_anti")
        rounds.append(verified(persist_table(pairs, "pairs")))
        labels = _merged(labels, rounds[-1].filter("linked"))
    drop_tables(reps, buckets, met, classes, *rounds)
    words.unpersist()

    out = made.join(spare, ["id", "n", "s1", "s2"], "left").withColumn("rep", F.coalesce("rep", "id")).join(labels, F.col("rep") == F.col("node"), "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"))
