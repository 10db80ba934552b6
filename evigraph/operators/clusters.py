"""Vectors in clusters: centroids, merge candidates, quality, agglomeration, hierarchies."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.labels import similarity_tier
from ..functions.vectors import cosine, l2_normalise
from ..sources.sinks import Snapshots
from .components import cut_lineage, weak_components
from .metric import cosine_links, cosine_pairs, matrix, slices
from .numbering import numbered
from .trees import depths, on_cycles


def centroids(members: DataFrame, weight_col: str | None = None) -> DataFrame:
    """Unit-norm (weighted) mean vector of each cluster, with its size and how many members lack a vector.

    Components are summed in place, so a cluster of any size is a handful of numbers a task.
    """
    w = F.col(weight_col).cast("double") if weight_col else F.lit(1.0)
    parts = members.filter("vector IS NOT NULL").select("cluster_id", w.alias("w"), F.posexplode("vector").alias("i", "x"))
    means = parts.groupBy("cluster_id", "i").agg((F.sum(F.col("x") * F.col("w")) / F.sum("w")).alias("x"))
    vectors = means.groupBy("cluster_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda e: e.x).alias("mean"))
    sizes = members.groupBy("cluster_id").agg(F.count("*").alias("members"), F.count_if(F.col("vector").isNull()).alias("missing"))
    return sizes.join(vectors, "cluster_id", "left").select("cluster_id", "members", "missing", l2_normalise(F.col("mean")).alias("centroid"))


def merge_candidates(of: DataFrame, threshold: float = 0.85, cap: int | None = 1000) -> DataFrame:
    """Pairs of clusters with similar centroids, most similar first. ``cap`` is part of the report; None gives all.

    Above a threshold of 0 only clusters meet whose cells of centroids lie near enough; at 0 every pair is asked for.
    """
    a, b = (of.select(F.col("cluster_id").alias(x), F.col("centroid").alias(f"v{x}"), F.col("members").alias(f"n{x}")) for x in "ab")
    if threshold > 0:
        near = cosine_pairs(of, "cluster_id", "centroid", threshold)
        out = near.join(a.drop("va"), "a").join(b.drop("vb"), "b")
    else:
        s = cosine(F.col("va"), F.col("vb"))
        out = a.join(b, F.col("a") < F.col("b")).withColumn("similarity", s).filter(F.col("similarity") >= threshold)
    out = out.select("a", "b", "similarity", similarity_tier(F.col("similarity")).alias("tier"), F.col("na").alias("size_a"), F.col("nb").alias("size_b")).orderBy(F.desc("similarity"), "a", "b")
    return out.limit(cap) if cap else out


def filter_candidates(pairs: DataFrame, least_tier: str = "MEDIUM", size_ratio: float = 10.0) -> DataFrame:
    tiers = {"HIGH": ["HIGH"], "MEDIUM": ["HIGH", "MEDIUM"], "LOW": ["HIGH", "MEDIUM", "LOW"]}[least_tier]
    return pairs.filter(F.col("tier").isin(*tiers) & (F.greatest("size_a", "size_b") <= size_ratio * F.least("size_a", "size_b"))).dropDuplicates(["a", "b"])


def complete_singletons(labelled: DataFrame, id_col: str, label_col: str = "label") -> DataFrame:
    """Noise (-1) gets labels of its own after the greatest, in order of id."""
    top = labelled.agg(F.coalesce(F.max(label_col), F.lit(-1)).alias("top"))
    noise = numbered(labelled.filter(F.col(label_col) == -1).select(id_col), [id_col], "_k")
    out = labelled.join(noise, id_col, "left").crossJoin(F.broadcast(top))
    return out.withColumn(label_col, F.coalesce(F.col("_k") + F.col("top"), F.col(label_col)).cast("bigint")).drop("_k", "top")


def most_similar(asked: DataFrame, points: DataFrame, k: int = 5, least: float = 0.2, rows: int = 1024, width: int = 8192) -> DataFrame:
    """a, b, similarity: for each of ``asked`` (a, va) the ``k`` others of ``points`` (b, vb) with the greatest cosine, of six digits, from ``least`` up; ties by b.

    Blocks of both meet in a task each, by matrix products, and give what can be among the best of them.
    """
    asked, points = asked.filter("va IS NOT NULL"), points.filter("vb IS NOT NULL")
    deals = [max(1, -(-df.count() // n)) for df, n in ((asked, rows), (points, width))]
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    q = asked.select(F.lit(True).alias("asks"), F.col("a").alias("id"), F.col("va").alias("v"), own("a", deals[0]).alias("i"), every(deals[1]).alias("j"))
    p = points.select(F.lit(False).alias("asks"), F.col("b").alias("id"), F.col("vb").alias("v"), every(deals[0]).alias("i"), own("b", deals[1]).alias("j"))
    # sums in another order move a cosine by much less than this
    margin = 2e-6

    def run(group: pa.Table) -> pa.Table:
        asks = group.column("asks").to_numpy()
        sides = [group.filter(pa.array(asks == x)) for x in (True, False)]
        unit, ids = [], [t.column("id").to_numpy() for t in sides]
        for t in sides:
            m = matrix(t.column("v"))
            size = np.sqrt((m * m).sum(1, keepdims=True))
            unit.append(np.divide(m, size, out=np.zeros_like(m), where=size > 0))
        out = [(ids[0][:0], ids[1][:0], np.zeros(0))]
        for some in slices(len(ids[0]), len(ids[1])) if len(ids[1]) else ():
            s = np.clip(unit[0][some] @ unit[1].T, 0, 1)
            s[ids[0][some][:, None] == ids[1][None]] = -1
            bar = np.partition(s, -k, axis=1)[:, -k] - margin if s.shape[1] > k else np.full(len(s), -1.0)
            x, y = np.nonzero(s >= np.maximum(bar, least - margin)[:, None])
            out.append((ids[0][some][x], ids[1][y], s[x, y]))
        return pa.table(dict(zip(("a", "b", "s"), (np.concatenate(c) for c in zip(*out, strict=True)), strict=True)))

    kinds = dict(asked.dtypes)["a"], dict(points.dtypes)["b"]
    met = q.unionByName(p).groupBy("i", "j").applyInArrow(lambda group: run(group), f"a {kinds[0]}, b {kinds[1]}, s double")
    met = met.select("a", "b", F.round(F.col("s") + 1e-9, 6).alias("similarity")).filter(F.col("similarity") >= least)
    return met.withColumn("r", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("similarity"), "b"))).filter(F.col("r") <= k).drop("r")


def single_linkage(vectors: DataFrame, id_col: str, vector_col: str, similarity: float = 0.8) -> DataFrame:
    """Clusters of a similarity graph: single linkage cut at a threshold equals its connected components. Rows without a vector are alone."""
    found = weak_components(cosine_links(vectors, id_col, vector_col, similarity), "a", "b")
    return vectors.select(F.col(id_col).alias("node")).join(found, "node", "left").select(F.col("node").alias(id_col), F.coalesce("component", "node").alias("label"))


def quality(members: DataFrame) -> DataFrame:
    """Cluster counts and spread, assignment rate, the Davies-Bouldin index and the mean silhouette, in one row.

    Members with cluster_id null or -1 are noise. The silhouette is of squared distances: a member's mean squared
    distance to a cluster follows from the cluster's mean and mean square, so no pairs of members meet.
    """
    noise = F.col("cluster_id").isNull() | (F.col("cluster_id") == -1)
    rate = members.agg(F.avg(F.when(noise, 0.0).otherwise(1.0)).alias("assignment_rate"))
    members = members.filter(~noise)
    dot = lambda u, v: F.aggregate(F.zip_with(u, v, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    plain = members.select("cluster_id", F.posexplode("vector").alias("i", "x")).groupBy("cluster_id", "i").agg(F.avg("x").alias("x"))
    mean = plain.groupBy("cluster_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "x"))), lambda e: e.x).alias("mean"))
    gap = lambda u, v: F.sqrt(F.aggregate(F.zip_with(u, v, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    spread = members.join(mean, "cluster_id").groupBy("cluster_id").agg(F.avg(gap(F.col("vector"), F.col("mean"))).alias("s"), F.avg(dot(F.col("vector"), F.col("vector"))).alias("sq"), F.count("*").alias("n"))
    of = cut_lineage(mean.join(spread, "cluster_id"), "spread")
    a, b = (of.select(F.col("cluster_id").alias(x), F.col("mean").alias(f"m{x}"), F.col("s").alias(f"s{x}")) for x in "ab")
    worst = a.join(b, F.col("a") != F.col("b")).groupBy("a").agg(F.max((F.col("sa") + F.col("sb")) / gap(F.col("ma"), F.col("mb"))).alias("r"))
    # every member meets every cluster: rows grow with members times clusters, as the definition does
    apart = members.withColumn("own", F.col("cluster_id")).drop("cluster_id").crossJoin(of.select("cluster_id", "mean", "sq", "n"))
    far = dot(F.col("vector"), F.col("vector")) - 2 * dot(F.col("vector"), F.col("mean")) + F.col("sq")
    same = F.col("own") == F.col("cluster_id")
    per = apart.groupBy("member").agg(F.max(F.when(same & (F.col("n") > 1), far * F.col("n") / (F.col("n") - 1))).alias("a"), F.min(F.when(~same, far)).alias("b"))
    shape = per.agg(F.avg(F.when(F.col("a").isNull() | F.col("b").isNull(), 0.0).otherwise((F.col("b") - F.col("a")) / F.greatest("a", "b"))).alias("silhouette"))
    sizes = spread.agg(F.count("*").alias("n_clusters"), F.sum("n").alias("n_members"), F.min("n").alias("smallest"), F.max("n").alias("largest"), F.avg("n").alias("mean_size"))
    return sizes.crossJoin(rate).crossJoin(worst.agg(F.avg("r").alias("davies_bouldin"))).crossJoin(shape)


def greedy_merges(pairs: DataFrame) -> DataFrame:
    """Disjoint pairs by descending similarity, each cluster in one pair at most.

    Rounds of mutually best pairs give what the sequential greedy pass gives; every round settles
    at least the best pair that is left.
    """
    left, chosen = cut_lineage(pairs.select("a", "b", "similarity"), "pairs"), None
    key = F.struct(F.col("similarity"), -F.col("a"), -F.col("b"))
    while not left.isEmpty():
        ends = left.withColumn("k", key).select(F.explode(F.array("a", "b")).alias("c"), "a", "b", "similarity", "k")
        best = ends.groupBy("c").agg(F.max_by(F.struct("a", "b"), "k").alias("p")).select("c", "p.a", "p.b")
        mutual = cut_lineage(best.groupBy("a", "b").agg(F.count("*").alias("n")).filter("n = 2").select("a", "b").join(left, ["a", "b"]), "mutual")
        chosen = mutual if chosen is None else chosen.union(mutual)
        used = mutual.select(F.explode(F.array("a", "b")).alias("c"))
        left = cut_lineage(left.join(used.withColumnRenamed("c", "a"), "a", "left_anti").join(used.withColumnRenamed("c", "b"), "b", "left_anti").select("a", "b", "similarity"), "pairs")
    return chosen if chosen is not None else left


def apply_merges(hierarchy: DataFrame, merges: DataFrame) -> DataFrame:
    """Identical pairs (a, b, keep=a): b's children go to a and b goes. Related pairs: both get a new parent, ids after the greatest."""
    same = merges.filter("relation = 'identical'").select(F.col("b").alias("cluster_id"), F.col("a").alias("into"))
    related = merges.filter("relation <> 'identical'")
    top = hierarchy.agg(F.max("cluster_id").alias("top"))
    new = numbered(related, ["a", "b"], "k").crossJoin(F.broadcast(top)).withColumn("parent", F.col("top") + F.col("k"))
    kept = hierarchy.join(same.select("cluster_id"), "cluster_id", "left_anti")
    moved = kept.join(same.select(F.col("cluster_id").alias("parent_id"), "into"), "parent_id", "left").withColumn("parent_id", F.coalesce("into", "parent_id")).drop("into")
    adopted = new.select(F.explode(F.array("a", "b")).alias("cluster_id"), F.col("parent").alias("adopted"))
    out = moved.join(adopted, "cluster_id", "left").select("cluster_id", F.coalesce("adopted", "parent_id").alias("parent_id"), F.when(F.col("adopted").isNotNull(), 1).otherwise(F.col("level")).alias("level"))
    return out.union(new.select(F.col("parent").alias("cluster_id"), F.lit(None).cast("bigint").alias("parent_id"), F.lit(0).alias("level")))


def hierarchy_problems(hierarchy: DataFrame) -> DataFrame:
    """One row for each orphan (its parent is missing), level error (not below its parent), cluster on a cycle, and cluster whose walk up leads to one."""
    up = hierarchy.select(F.col("cluster_id").alias("parent_id"), F.col("level").alias("up"))
    child = hierarchy.filter("parent_id IS NOT NULL")
    orphans = child.join(up, "parent_id", "left_anti").select("cluster_id", F.lit("orphan").alias("problem"))
    found = orphans.union(child.join(up, "parent_id").filter("level <= up").select("cluster_id", F.lit("level").alias("problem")))
    links = hierarchy.select(F.col("cluster_id").alias("id"), F.col("parent_id").alias("up"))
    endless = depths(links)[1]
    if endless.isEmpty():
        return found
    cycles = cut_lineage(on_cycles(links, endless), "cycles")
    leads = endless.join(cycles, "id", "left_anti")
    return found.union(cycles.select(F.col("id").alias("cluster_id"), F.lit("cycle").alias("problem"))).union(leads.select(F.col("id").alias("cluster_id"), F.lit("leads to cycle").alias("problem")))


def merge_transaction(hierarchy: Snapshots, junction: Snapshots, merges: DataFrame) -> bool:
    """Apply all merges, rebuild the junction of members (member, cluster_id), validate, and commit both; or leave both as they were.

    A set of merges is bad when it gives rise to orphans, level errors or cycles that were not there before.
    Both new versions are written and validated as they will be read; what fails is dropped again.
    """
    before, known = hierarchy.read(), junction.read()
    into = merges.filter("relation = 'identical'").select(F.col("b").alias("cluster_id"), F.col("a").alias("into"))
    old = hierarchy_problems(before)
    hierarchy.publish(apply_merges(before, merges))
    try:
        new = hierarchy_problems(hierarchy.read()).join(old, ["cluster_id", "problem"], "left_anti")
        lost = known.join(into, "cluster_id", "left").withColumn("cluster_id", F.coalesce("into", "cluster_id")).select(*known.columns)
        sound = new.isEmpty() and lost.join(hierarchy.read().select("cluster_id"), "cluster_id", "left_anti").isEmpty()
        if sound:
            junction.publish(lost.distinct())
    except Exception:
        hierarchy.rollback()
        raise
    if not sound:
        hierarchy.rollback()
    return sound


def ancestor_depth(tree: DataFrame, most: int = 10) -> DataFrame:
    """How many steps lead up from each (id, parent), ``most`` at most: a walk that reaches the bound hints at a cycle.

    Each step joins only the walks that still go on, so there is no limit on rows as a recursive query has.
    """
    steps = tree.select(F.col("id").alias("parent"), F.col("parent").alias("up"))
    done = tree.select("id", F.lit(0).alias("depth"))
    going = tree.filter("parent IS NOT NULL").select("id", "parent")
    for depth in range(1, most + 1):
        going = cut_lineage(going.join(steps, "parent").select("id", F.col("up").alias("parent")), "walks")
        done = done.union(going.select("id", F.lit(depth).alias("depth")))
        going = going.filter("parent IS NOT NULL")
        if going.isEmpty():
            break
    return done.groupBy("id").agg(F.max("depth").alias("depth"))


def threshold_grid(of: DataFrame, levels: tuple[float, ...]) -> DataFrame:
    """How many candidates and merges each threshold gives: one pass over the pairs, not one a threshold."""
    pairs = merge_candidates(of, min(levels), None).select("a", "b", "similarity")
    grid = F.explode(F.array(*[F.lit(x) for x in levels])).alias("threshold")
    return pairs.select("a", "b", "similarity", grid).filter("similarity >= threshold").groupBy("threshold").agg(F.count("*").alias("candidates"), F.avg("similarity").alias("mean_similarity"))

