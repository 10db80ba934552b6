"""How good a hierarchy of clusters is, and which merge thresholds give the best one."""

from __future__ import annotations

from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import ladder
from .clusters import greedy_merges
from .components import cut_lineage, drop_table
from .metric import matrix, slices
from .numbering import numbered

#: Points by ladders of ranges or bars, the first that holds.
REDUCTION = ((0.40, 0.60, 25.0), (0.30, 0.70, 20.0), (0.20, 0.80, 15.0))
COHERENCE = ((0.70, 25.0), (0.65, 22.0), (0.60, 20.0), (0.50, 15.0))
SEPARATION = ((0.40, 15.0), (0.35, 13.0), (0.30, 12.0))
#: The thresholds that are tried for each merging step.
STEPS = ((0.82, 0.84, 0.86, 0.88), (0.78, 0.80, 0.82, 0.84), (0.74, 0.76, 0.78, 0.80))
#: Members whose pairs one task compares with another such block's.
BLOCK = 1000
_EDGE = 1e-9


def points(reduction: Column, depth: Column, singletons: Column, median: Column, largest: Column, coherence: Column, separation: Column) -> dict[str, Column]:
    """The five parts of the score and their sum, of 100 at most."""
    parts = {
        "reduction_score": ladder(*[(reduction.between(low - _EDGE, high + _EDGE), p) for low, high, p in REDUCTION], otherwise=10.0),
        "depth_score": ladder((depth.between(2, 3), 15.0), (depth.isin(1, 4), 12.0), otherwise=5.0),
        "size_score": F.lit(20.0) - F.when(singletons > 0.5, 5.0).otherwise(0.0) - F.when(singletons > 0.6, 3.0).otherwise(0.0) - F.when((median < 2) | (median > 10), 5.0).otherwise(0.0) - ladder((largest > 100, 5.0), (largest > 50, 2.0), otherwise=0.0),
        "coherence_score": ladder(*[(coherence >= bar - _EDGE, p) for bar, p in COHERENCE], otherwise=10.0),
        "separation_score": ladder(*[(separation >= bar - _EDGE, p) for bar, p in SEPARATION], otherwise=8.0),
    }
    return parts | {"composite_score": sum(parts.values(), F.lit(0.0))}


def _unit(v: np.ndarray) -> np.ndarray:
    return v / (np.linalg.norm(v, axis=-1, keepdims=True) + 1e-9)


def coherence(members: DataFrame) -> DataFrame:
    """cluster_id and the mean cosine, held to 0 to 1, of its pairs of members; clusters of one have none.

    Members are dealt into blocks by a hash and blocks meet pairwise, so a cluster's size bounds no task.
    """
    n = members.groupBy("cluster_id").agg(F.count("*").alias("n")).filter("n > 1")
    rows = members.join(n, "cluster_id").withColumn("k", F.ceil(F.col("n") / BLOCK).cast("int")).withColumn("i", F.pmod(F.xxhash64("member"), F.col("k")).cast("int"))
    meets = rows.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))

    def run(block: pd.DataFrame) -> pd.DataFrame:
        first = block.iloc[0]
        own, other = (_unit(np.array(block.loc[block["i"] == x, "vector"].tolist(), float)) for x in (first["low"], first["high"]))
        total = 0.0
        if len(own) and len(other):
            s = np.clip(own @ other.T, 0, 1)
            total = float(np.triu(s, 1).sum() if first["low"] == first["high"] else s.sum())
        return pd.DataFrame({"cluster_id": [first["cluster_id"]], "total": [total]})

    keyed = meets.select("cluster_id", "vector", "i", F.least("i", "j").alias("low"), F.greatest("i", "j").alias("high"))
    sums = keyed.groupBy("cluster_id", "low", "high").applyInPandas(run, f"cluster_id {dict(members.dtypes)['cluster_id']}, total double")
    return sums.groupBy("cluster_id").agg(F.sum("total").alias("total")).join(n, "cluster_id").select("cluster_id", (F.col("total") / (F.col("n") * (F.col("n") - 1) / 2)).alias("coherence"))


def hierarchy_quality(members: DataFrame, pairs: DataFrame, initial: DataFrame, depth: int) -> DataFrame:
    """One row of measures and points for the top level: ``members`` (cluster_id, member, vector), ``pairs`` of its centroids
    (similarity), and ``initial``, the clusters before merging."""
    sizes = members.groupBy("cluster_id").agg(F.count("*").alias("n"))
    size = sizes.agg(F.count("*").alias("final_count"), F.avg((F.col("n") == 1).cast("double")).alias("singleton_ratio"), F.median("n").alias("median_size"), F.max("n").alias("max_size"))
    inside = coherence(members).agg(F.coalesce(F.avg("coherence"), F.lit(0.5)).alias("coherence"))
    apart = pairs.agg(F.coalesce(1 - F.avg("similarity"), F.lit(1.0)).alias("separation"))
    row = size.crossJoin(inside).crossJoin(apart).crossJoin(initial.agg(F.count("*").alias("initial_count")))
    row = row.withColumns({"depth": F.lit(depth), "reduction_ratio": 1 - F.col("final_count") / F.col("initial_count")})
    names = ("reduction_ratio", "depth", "singleton_ratio", "median_size", "max_size", "coherence", "separation")
    return row.withColumns(points(*[F.col(c) for c in names]))


#: Rows of a block of members, and clusters of a block, two of which meet in a task.
MEMBERS, CLUSTERS = 8192, 4096


def _cosine_sums(rows: DataFrame, size: int, key: str, group: str) -> DataFrame:
    """``key``, low <= high and total: over the pairs of ``rows`` (key, group, id, vector) of each key, once for each two ``group`` numbers, the sum of their cosines held to 0 to 1.

    Rows are dealt into blocks by a hash and blocks meet pairwise, so no task has more than two of them.
    """
    deals = rows.groupBy(key).agg(F.ceil(F.count("*") / size).cast("int").alias("k"))
    dealt = rows.join(deals, key).withColumn("i", F.pmod(F.xxhash64("id"), F.col("k")).cast("int"))
    meets = dealt.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    keyed = meets.select(key, F.col(group).cast("bigint").alias("group"), "vector", "i", F.least("i", "j").alias("low"), F.greatest("i", "j").alias("high"))

    def run(t: pa.Table) -> pa.Table:
        low, high, at = t.column("low")[0].as_py(), t.column("high")[0].as_py(), t.column("i").to_numpy()
        t = t.append_column("at", pa.array(at)).sort_by([("at", "ascending"), ("group", "ascending")])
        at, of, unit = t.column("at").to_numpy(), t.column("group").to_numpy(), _unit(matrix(t.column("vector")))
        left, right = np.flatnonzero(at == low), np.flatnonzero(at == high)
        total: dict[tuple[int, int], float] = {}
        if len(left) and len(right):
            starts = np.flatnonzero(np.diff(of[right], prepend=of[right[0]] - 1))
            for some in slices(len(left), len(right)):
                own = left[some]
                s = np.clip(unit[own] @ unit[right].T, 0, 1)
                if low == high:
                    s[own[:, None] >= right[None]] = 0
                rows = np.flatnonzero(np.diff(of[own], prepend=of[own[0]] - 1))
                sums = np.add.reduceat(np.add.reduceat(s, starts, axis=1), rows, axis=0)
                for x, line in zip(of[own[rows]].tolist(), sums.tolist(), strict=True):
                    for y, value in zip(of[right[starts]].tolist(), line, strict=True):
                        if value:
                            pair = (x, y) if x <= y else (y, x)
                            total[pair] = total.get(pair, 0.0) + value
        lows, highs = zip(*total, strict=True) if total else ((), ())
        of_key = pa.array([t.column(key)[0].as_py()] * len(total), t.schema.field(key).type)
        return pa.table([of_key, pa.array(lows, pa.int64()), pa.array(highs, pa.int64()), pa.array(list(total.values()), pa.float64())], names=[key, "low", "high", "total"])

    found = keyed.groupBy(key, "low", "high").applyInArrow(lambda t: run(t), f"{key} {dict(rows.dtypes)[key]}, low bigint, high bigint, total double")
    return found.groupBy(key, "low", "high").agg(F.sum("total").alias("total"))


def _similar(means: DataFrame, least: float, size: int) -> DataFrame:
    """way, a < b and similarity: all pairs of a way's clusters (way, c, vector) whose means have a cosine, held to 0 to 1, of ``least`` or more."""
    deals = means.groupBy("way").agg(F.ceil(F.count("*") / size).cast("int").alias("k"))
    dealt = means.join(deals, "way").withColumn("i", F.pmod(F.xxhash64("c"), F.col("k")).cast("int"))
    meets = dealt.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("k") - 1)))
    keyed = meets.select("way", "c", "vector", "i", F.least("i", "j").alias("low"), F.greatest("i", "j").alias("high"))

    def run(t: pa.Table) -> pa.Table:
        at, ids, unit = t.column("i").to_numpy(), t.column("c").to_numpy(), _unit(matrix(t.column("vector")))
        left, right = (np.flatnonzero(at == t.column(x)[0].as_py()) for x in ("low", "high"))
        out = [(ids[:0], ids[:0], np.zeros(0))]
        for some in slices(len(left), len(right)) if len(right) else ():
            own = left[some]
            s = np.clip(unit[own] @ unit[right].T, 0, 1)
            near = s >= least
            if t.column("low")[0].as_py() == t.column("high")[0].as_py():
                near &= ids[own][:, None] < ids[right][None]
            x, y = np.nonzero(near)
            a, b = ids[own[x]], ids[right[y]]
            out.append((np.minimum(a, b), np.maximum(a, b), s[x, y]))
        a, b, s = (np.concatenate(c) for c in zip(*out, strict=True))
        return pa.table({"way": pa.array([t.column("way")[0].as_py()] * len(a), pa.int64()), "a": a, "b": b, "similarity": s})

    return keyed.groupBy("way", "low", "high").applyInArrow(lambda t: run(t), "way bigint, a bigint, b bigint, similarity double")


def _vectors(parts: DataFrame, *keys: str) -> DataFrame:
    """``keys`` and vector from rows of (keys, i, x)."""
    return parts.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda e: e.x).alias("vector"))


def threshold_search(members: DataFrame, steps: tuple[tuple[float, ...], ...] = STEPS, block: int = MEMBERS, clusters: int = CLUSTERS) -> DataFrame:
    """Every combination of thresholds for the three merging steps, simulated on vectors alone and scored, best first.

    At each step disjoint pairs of clusters merge, most similar first. That takes the clusters' sums alone, for all combinations of the steps so far
    at once (a *way*). Members meet once, in blocks, for the sums of cosines between the clusters given; those of merged ones are sums of these.
    """
    spark = members.sparkSession
    # clusters by number, in order of their ids
    members = members.filter("vector IS NOT NULL")
    named = numbered(members.select("cluster_id").distinct(), ["cluster_id"], "base", first=0)
    base = cut_lineage(members.join(named, "cluster_id").select("base", F.col("member").alias("id"), "vector"), "base")
    parts = base.select("base", F.posexplode("vector").alias("i", "x")).groupBy("base", "i").agg(F.sum("x").alias("x"))
    sums = cut_lineage(_vectors(parts, "base").join(base.groupBy("base").agg(F.count("*").alias("n")), "base"), "sums")
    count = sums.agg(F.coalesce(F.max("base"), F.lit(-1))).first()[0] + 1
    # a way's clusters, each named by the first of those it is made of
    now = cut_lineage(sums.select(F.lit(0).cast("bigint").alias("way"), F.col("base").alias("c"), "base"), "level")
    for tried in steps:
        x = now.join(sums.select("base", "n", F.posexplode("vector").alias("i", "x")), "base").groupBy("way", "c", "i").agg((F.sum("x") / F.sum("n")).alias("x"))
        near = cut_lineage(_similar(_vectors(x, "way", "c"), min(tried), clusters), "similar")
        each = F.explode(F.array(*[F.struct(F.lit(k).cast("bigint").alias("k"), F.lit(float(t)).alias("t")) for k, t in enumerate(tried)])).alias("e")
        ways = near.select("*", each).filter("similarity >= e.t").select((F.col("way") * len(tried) + F.col("e.k")).alias("way"), "a", "b", "similarity")
        # ways in one table: their clusters' numbers lie apart
        joined = greedy_merges(ways.select((F.col("way") * count + F.col("a")).alias("a"), (F.col("way") * count + F.col("b")).alias("b"), "similarity"))
        into = joined.select(F.floor(F.col("b") / count).cast("bigint").alias("way"), (F.col("b") % count).alias("c"), (F.col("a") % count).alias("into"))
        grown = now.select("way", "c", "base", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(len(tried) - 1).cast("bigint"))).alias("k")).select((F.col("way") * len(tried) + F.col("k")).alias("way"), "c", "base")
        before, now = now, cut_lineage(grown.join(into, ["way", "c"], "left").select("way", F.coalesce("into", "c").alias("c"), "base"), "level")
        drop_table(before, near)
    size = cut_lineage(now.join(sums.select("base", "n"), "base").groupBy("way", "c").agg(F.sum("n").alias("n")), "sizes")
    shape = size.groupBy("way").agg(F.count("*").alias("final_count"), F.avg((F.col("n") == 1).cast("double")).alias("singleton_ratio"), F.median("n").alias("median_size"), F.max("n").alias("max_size"))
    between = cut_lineage(_cosine_sums(base.select(F.lit(0).alias("all"), "base", "id", "vector"), block, "all", "base").select("low", "high", "total"), "between")
    low, high = (now.select("way", F.col("c").alias(f"c_{x}"), F.col("base").alias(x)) for x in ("low", "high"))
    inner = between.join(low, "low").join(high, ["way", "high"]).filter("c_low = c_high").groupBy("way", F.col("c_low").alias("c")).agg(F.sum("total").alias("total"))
    inside = size.filter("n > 1").join(inner, ["way", "c"], "left").groupBy("way").agg(F.avg(F.coalesce("total", F.lit(0.0)) / (F.col("n") * (F.col("n") - 1) / 2)).alias("coherence"))
    x = now.join(sums.select("base", "n", F.posexplode("vector").alias("i", "x")), "base").groupBy("way", "c", "i").agg((F.sum("x") / F.sum("n")).alias("x"))
    apart = _cosine_sums(_vectors(x, "way", "c").select("way", F.lit(0).alias("one"), F.col("c").alias("id"), "vector"), clusters, "way", "one").select("way", "total")
    combos = [(k, *map(float, c)) for k, c in enumerate(product(*steps))]
    rows = F.broadcast(spark.createDataFrame(combos, "way bigint, t3 double, t2 double, t1 double")).join(shape, "way").join(inside, "way", "left").join(apart, "way", "left")
    pairs = F.col("final_count") * (F.col("final_count") - 1) / 2
    rows = rows.select(
        "t3", "t2", "t1", F.lit(count).cast("bigint").alias("initial_count"), "final_count", (1 - F.col("final_count") / F.lit(count)).alias("reduction_ratio"), F.lit(3).alias("depth"), "singleton_ratio",
        F.col("median_size").cast("double").alias("median_size"), "max_size", F.coalesce("coherence", F.lit(0.5)).alias("coherence"), F.when(pairs > 0, 1 - F.coalesce("total", F.lit(0.0)) / pairs).otherwise(1.0).alias("separation"),
    )
    names = ("reduction_ratio", "depth", "singleton_ratio", "median_size", "max_size", "coherence", "separation")
    return rows.withColumns(points(*[F.col(c) for c in names])).orderBy(F.desc("composite_score"), "t3", "t2", "t1")
