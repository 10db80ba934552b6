"""Conditions that are alike: their clusters, what a cluster has in common, discoveries, and functions inferred from patterns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dictionaries import CLUSTER_NAMES, EASY_TO_STUDY, FIELD_DISCOVERIES, FIELD_WORDS, FUNCTION_PATTERNS, HARD_TO_STUDY, MECHANISM_DISCOVERIES
from ..functions.labels import ladder, lookup
from .agglomeration import cut, dendrograms, indexed
from .bayes import score_pairs


def condition_clusters(similar: DataFrame, conditions: DataFrame, most_clusters: int = 15, least_size: int = 2) -> DataFrame:
    """(target, cluster): Ward clusters on one less the similarity of ``similar`` (a, b, similarity); a pair without a row is not similar at all.

    The number of clusters is half that of conditions, from 2 to ``most_clusters``, and clusters under ``least_size`` are left out.
    Distances are a table with a row for each pair of conditions, which Ward's criterion is defined on.
    """
    nodes = indexed(conditions.select(F.lit(0).alias("block"), "target").distinct(), "block", "target")
    pairs = nodes.filter("node > 0").select("block", F.col("node").alias("b"), F.col("target").alias("name_b"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("node") - 1)).alias("a"))
    pairs = pairs.join(nodes.select(F.col("node").alias("a"), F.col("target").alias("name_a")), "a")
    alike = similar.select(F.least("a", "b").alias("name_a"), F.greatest("a", "b").alias("name_b"), F.col("similarity").cast("double").alias("similarity")).filter("name_a <> name_b")
    pairs = pairs.join(alike, ["name_a", "name_b"], "left").select("block", "a", "b", (1 - F.coalesce("similarity", F.lit(0.0))).alias("d"))
    labels = cut(dendrograms(pairs, nodes, "ward"), nodes, clusters=F.greatest(F.lit(2), F.least(F.lit(most_clusters), F.floor(F.col("n") / least_size))))
    sizes = labels.groupBy("label").agg(F.count("*").alias("size"))
    return labels.join(sizes, "label").filter(F.col("size") >= least_size).join(nodes, ["block", "node"]).select("target", F.col("label").alias("cluster"))


def describe_clusters(edges: DataFrame, clusters: DataFrame, significant: float = 0.2) -> DataFrame:
    """For each cluster (target, cluster): its treatments in common, mechanism profile, name, success and strength of evidence.

    A common treatment is tried on half the conditions, and on two at least; the ten most frequent are shown. Pairs of these that
    were never tried count as one half, the score without evidence.
    """
    of = clusters.select("target", "cluster").distinct()
    sizes = of.groupBy("cluster").agg(F.count("*").alias("conditions"))
    scores = score_pairs(edges, quantiles=False).select("source", "target", "score", "confidence").join(of, "target")
    per = scores.groupBy("cluster", "source").agg(F.count("*").alias("k"), F.sum("score").alias("total")).join(sizes, "cluster")
    common = per.filter(F.col("k") >= F.greatest(F.lit(2), F.floor(F.col("conditions") / 2)))
    listed = F.array_sort(F.collect_list(F.struct((-F.col("k")).alias("k"), "source")))
    shared = common.groupBy("cluster").agg(
        F.transform(F.slice(listed, 1, 10), lambda e: e.source).alias("common"), F.count("*").alias("n_common"),
        (F.sum(F.col("total") + 0.5 * (F.col("conditions") - F.col("k"))) / F.sum("conditions")).alias("success"),
    )
    strength = scores.groupBy("cluster").agg(F.avg("confidence").alias("evidence_strength"))
    loads = edges.groupBy("target", "mechanism").agg(F.avg("confidence").alias("l")).join(of, "target").groupBy("cluster", "mechanism").agg(F.sum("l").alias("l")).join(sizes, "cluster")
    loads = loads.withColumn("l", F.round(F.col("l") / F.col("conditions") + 1e-9, 6)).filter(F.col("l") > significant)
    whole = loads.groupBy("cluster").agg(F.sum("l").alias("sum"))
    profile = loads.join(whole, "cluster").groupBy("cluster").agg(F.array_sort(F.collect_list(F.struct((-F.col("l") / F.col("sum")).alias("share"), "mechanism"))).alias("p"))
    profile = profile.select("cluster", F.transform("p", lambda e: F.struct(e.mechanism.alias("mechanism"), (-e.share).alias("share"))).alias("profile"))
    out = sizes.join(shared, "cluster", "left").join(strength, "cluster", "left").join(profile, "cluster", "left")
    first = F.try_element_at("profile", F.lit(1)).getField("mechanism")
    return out.withColumns({"dominant": F.coalesce(first, F.lit("unknown")), "name": lookup(F.coalesce(first, F.lit("unknown")), CLUSTER_NAMES, "Mixed"), "n_common": F.coalesce("n_common", F.lit(0)), "success": F.coalesce("success", F.lit(0.0))})


def _names(condition: Column, field: str) -> Column:
    held = F.lit(False)
    for word in FIELD_WORDS[field]:
        held = held | F.contains(F.lower(condition), F.lit(word))
    return held


def discovery_type(a: Column, b: Column, mechanisms: Column) -> Column:
    """What an unexpected link of two conditions is: by the fields their names tell, else by the cluster's two leading ``mechanisms``."""
    by_name = [((_names(a, x) & _names(b, y)) | (_names(a, y) & _names(b, x)), kind) for x, y, kind in FIELD_DISCOVERIES]
    by_way = [(F.array_contains(mechanisms, x) & F.array_contains(mechanisms, y), kind) for x, y, kind in MECHANISM_DISCOVERIES]
    return ladder(*by_name, *by_way, otherwise="novel_biological_connection")


def feasibility(source: Column) -> Column:
    """How easily an intervention can be studied."""
    return ladder((source.isin(*HARD_TO_STUDY), 0.3), (source.isin(*EASY_TO_STUDY), 0.9), otherwise=0.6)


def _holding(word: str) -> Callable[[Column], Column]:
    return lambda m: F.contains(F.lower(m), F.lit(word.lower()))


def body_functions(sources: DataFrame, patterns: dict = FUNCTION_PATTERNS, least: int = 3) -> DataFrame:
    """Adds ``functions``: those whose pattern a source (source, conditions, mechanisms) fits by ``least`` points.

    Two points a shared condition, three for a name in the pattern, one each time a mechanism's name holds a word of it.
    """
    fits = []
    for name, (conditions, names, words) in sorted(patterns.items()):
        shared = 2 * F.size(F.array_intersect("conditions", F.array(*[F.lit(c) for c in conditions])))
        named = F.when(F.lower("source").isin(*[n.lower() for n in names]), 3).otherwise(0)
        held = sum((F.size(F.filter("mechanisms", _holding(w))) for w in words), F.lit(0))
        fits.append(F.when(shared + named + held >= least, name))
    return sources.withColumn("functions", F.array_compact(F.array(*fits)))
