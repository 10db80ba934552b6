"""Folds of parallel evidence edges. Each is one grouped aggregate: no loop over pairs, no lookup per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.labels import OUTCOME_WEIGHTS, advice, as_is, steady
from .components import cut_lineage

OUTCOMES = tuple(OUTCOME_WEIGHTS)


def breakdown() -> list[Column]:
    """Counts by outcome word."""
    return [F.count_if(F.col("outcome") == o).alias(f"n_{o}") for o in OUTCOMES]


def raw_score() -> Column:
    return F.sum(F.col("weight") * F.col("confidence")) / F.count("*")


#: Rows that are broadcast; more are shuffled.
FEW = 300_000


def near(col: Column, *bars: float) -> Column:
    """Whether a mean lies on one of the bars, but for its last digits."""
    return F.exists(F.array(*[F.lit(float(b)) for b in bars]), lambda b: F.abs(col - b) < 1e-9)


def in_table_order(edges: DataFrame, folded: DataFrame, keys: list[str], means: dict[str, tuple[Column, Column]], on_bar: Column) -> DataFrame:
    """``folded`` with ``means`` (name: terms and number) of the keys that are ``on_bar`` taken once more, terms added one by one in the order of ``place``.

    The last digits of a sum of doubles follow the order of its rows, and on a bar they decide. In the table's order they are those that one thread
    of the SQL gets. Only edges of such keys, a few in a hundred, are shuffled and sorted for that; the running sum keeps no group in memory.
    """
    folded = cut_lineage(folded, "folded")
    tied = folded.filter(on_bar).select(*keys)
    n = tied.count()
    if not n:
        return folded
    rows = edges.join(F.broadcast(tied) if n <= FEW else tied, keys, "left_semi")
    added = Window.partitionBy(*keys).orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = rows.select(*keys, "place", *[x.alias(f"_{c}_{k}") for c, parts in means.items() for k, x in (("sum", F.sum(parts[0]).over(added)), ("n", parts[1].over(added)))])
    again = running.groupBy(*keys).agg(F.max_by(F.struct(*[(F.col(f"_{c}_sum") / F.col(f"_{c}_n")).alias(c) for c in means]), "place").alias("_again"))
    return folded.join(again, keys, "left").withColumns({c: F.coalesce(f"_again.{c}", c) for c in means}).drop("_again")


def fold_pairs(edges: DataFrame, digits: int | None = 3) -> DataFrame:
    """One row a (source, target): score, mean confidence, counts, strongest study, advice.

    The score is the mean of weight times confidence, times mean confidence once more. The
    strongest study is the most confident, of equals the one with the greatest id. Edges with a ``place`` are
    added in its order where that decides the advice.
    """
    out = edges.groupBy("source", "target").agg(
        raw_score().alias("raw_score"), F.avg("confidence").alias("avg_confidence"), F.count("*").alias("edge_count"), *breakdown(),
        F.max_by("study_id", F.struct("confidence", "study_id")).alias("strongest_study"),
    )
    score, placed = F.col("raw_score") * F.col("avg_confidence"), "place" in edges.columns
    if placed:
        means = {"raw_score": (F.col("weight") * F.col("confidence"), F.count("*")), "avg_confidence": (F.col("confidence"), F.count("confidence"))}
        out = in_table_order(edges, out, ["source", "target"], means, near(score, 0.5, 0.3, -0.3) | near(F.col("avg_confidence"), 0.7, 0.5))
    out = out.withColumn("recommendation", advice(score, F.col("avg_confidence"), F.col("edge_count"), as_is if placed else steady)).withColumn("aggregate_score", score)
    if digits is not None:
        out = out.withColumns({c: F.round(c, digits) for c in ("raw_score", "avg_confidence", "aggregate_score")})
    return out


def treatments_for(edges: DataFrame, condition: str, min_confidence: float = 0.0, outcomes: tuple[str, ...] = OUTCOMES) -> DataFrame:
    """What treats a condition, best first; ties by name."""
    kept = edges.filter((F.col("target") == condition) & (F.col("confidence") >= min_confidence) & F.col("outcome").isin(*outcomes))
    return fold_pairs(kept).orderBy(F.desc("aggregate_score"), "source")


def conditions_for(edges: DataFrame, intervention: str, min_confidence: float = 0.0, outcomes: tuple[str, ...] = OUTCOMES) -> DataFrame:
    """What an intervention treats, best first; ties by name."""
    kept = edges.filter((F.col("source") == intervention) & (F.col("confidence") >= min_confidence) & F.col("outcome").isin(*outcomes))
    return fold_pairs(kept).orderBy(F.desc("aggregate_score"), "target")


def fold_mechanisms(edges: DataFrame, keys: list[str], count_distinct: str | None = None) -> DataFrame:
    """Evidence by mechanism and ``keys``; here the score has no second confidence factor.

    ``count_distinct`` names the end whose distinct members are listed and counted.
    """
    aggregates = [raw_score().alias("aggregate_score"), F.avg("confidence").alias("avg_confidence"), F.count("*").alias("edge_count"), *breakdown()]
    if count_distinct:
        aggregates += [F.countDistinct(count_distinct).alias(f"{count_distinct}_count"), F.array_join(F.array_sort(F.collect_set(count_distinct)), ",").alias(f"{count_distinct}s")]
    return edges.filter(F.col("mechanism").isNotNull() & (F.col("mechanism") != "")).groupBy(*keys).agg(*aggregates)


def fundamental(edges: DataFrame, min_conditions: int = 3) -> DataFrame:
    """Interventions with a positive rounded score for at least ``min_conditions`` conditions."""
    pairs = fold_pairs(edges)
    positive = F.col("aggregate_score") > 0
    out = pairs.groupBy("source").agg(F.count_if(positive).alias("positive_conditions"), F.count("*").alias("total_conditions"), F.sum(F.when(positive, F.col("aggregate_score")).otherwise(0.0)).alias("breadth_score"))
    return out.filter(F.col("positive_conditions") >= min_conditions).withColumn("avg_effectiveness", F.col("breadth_score") / F.col("positive_conditions"))


def outcome_counts(edges: DataFrame, keys: list[str], inconclusive_is_neutral: bool = False) -> DataFrame:
    """pos, neg and neutral by keys. The graph's counter leaves inconclusive out, the table's counts it as neutral."""
    neutral = F.col("outcome").isin("no_effect", "inconclusive") if inconclusive_is_neutral else F.col("outcome") == "no_effect"
    return edges.groupBy(*keys).agg(F.count_if(F.col("outcome") == "improves").alias("pos"), F.count_if(F.col("outcome") == "worsens").alias("neg"), F.count_if(neutral).alias("neutral"))


def pool(edges: DataFrame, canonical: DataFrame) -> DataFrame:
    """Edges under their canonical names; a name without a group keeps its own."""
    names = canonical.select("entity_name", "entity_type", "canonical_name")
    for end, kind in (("source", "intervention"), ("target", "condition")):
        of = names.filter(F.col("entity_type") == kind).select(F.col("entity_name").alias(end), F.col("canonical_name").alias("_c"))
        edges = edges.join(of, end, "left").withColumn(end, F.coalesce("_c", end)).drop("_c")
    return edges


def graph_statistics(edges: DataFrame) -> DataFrame:
    """Nodes, edges and edges a node, in one row."""
    ends = edges.agg(F.countDistinct("source").alias("n_sources"), F.countDistinct("target").alias("n_targets"), F.countDistinct("mechanism").alias("n_mechanisms"), F.count("*").alias("n_edges"))
    nodes = F.col("n_sources") + F.col("n_targets")
    return ends.withColumn("edges_per_node", F.when(nodes > 0, F.col("n_edges") / nodes).otherwise(0.0))


def consensus(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Agreement of studies on one outcome: papers, spread of confidence, boosted confidence."""
    out = edges.groupBy(*keys, "outcome").agg(F.countDistinct("paper_id").alias("papers"), F.count("*").alias("studies"), F.avg("confidence").alias("mean"), F.var_pop("confidence").alias("variance"), F.max_by("study_id", F.struct("confidence", "study_id")).alias("base_study"))
    consistency = F.greatest(F.lit(0.0), 1 - F.col("variance") * 4)
    boost = F.least(F.lit(0.2), 0.05 * (F.col("papers") - 1))
    return out.withColumns({"consistency": consistency, "confidence": F.least(F.lit(0.98), F.col("mean") + boost * consistency)})


def merge_parallel(edges: DataFrame, keys: list[str]) -> DataFrame:
    """Weighted mean, greatest, capped sum and harmonic mean of parallel edges' confidences."""
    positive = F.every(F.col("confidence") > 0)
    return edges.groupBy(*keys).agg(
        (F.sum(F.col("confidence") * F.col("sample_size")) / F.sum("sample_size")).alias("weighted_mean"), F.max("confidence").alias("greatest"),
        F.least(F.lit(1.0), F.sum("confidence")).alias("capped_sum"), F.when(positive, F.count("*") / F.sum(F.when(F.col("confidence") > 0, 1 / F.col("confidence")))).otherwise(0.0).alias("harmonic"),
    )
