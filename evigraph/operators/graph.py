"""Graph queries over edge tables; forward and reverse are two groupings of one table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import steady
from .components import cut_lineage


def neighbours(edges: DataFrame, node: str, direction: str = "both") -> DataFrame:
    """Distinct neighbours; self loops are left out of the incoming side."""
    out = edges.filter(F.col("source") == node).select(F.col("target").alias("neighbour"), F.lit("out").alias("side"))
    into = edges.filter((F.col("target") == node) & (F.col("source") != node)).select(F.col("source").alias("neighbour"), F.lit("in").alias("side"))
    return {"out": out, "in": into, "both": out.union(into)}[direction].distinct()


def simple_paths(links: DataFrame, start: str, goal: str, depth: int = 3, least: float = 0.1, hold: Callable[[Column], Column] = steady) -> DataFrame:
    """Simple paths from start to goal of at most ``depth`` steps over links (source, target, weight), heaviest first.

    Each step joins the frontier alone, which starts at one node, with the links. ``least`` is held against ``hold`` of the weights.
    """
    kept = links.filter(hold(F.col("weight")) >= least).select("source", "target", "weight")
    frontier = kept.filter((F.col("source") == start) & (F.col("target") != start)).select(F.array("source", "target").alias("path"), F.col("weight").alias("total"))
    found = frontier.filter(F.element_at("path", -1) == goal)
    for _ in range(depth - 1):
        going = frontier.filter(F.element_at("path", -1) != goal).withColumn("source", F.element_at("path", -1))
        frontier = going.join(kept, "source").filter(~F.array_contains("path", F.col("target"))).select(F.array_append("path", F.col("target")).alias("path"), (F.col("total") + F.col("weight")).alias("total"))
        found = found.union(frontier.filter(F.element_at("path", -1) == goal))
    return found.select(F.array_join("path", ">").alias("path"), (F.size("path") - 1).alias("steps"), "total", (F.size("path") == 2).alias("direct")).orderBy(F.desc("total"), "path")


def degrees(links: DataFrame) -> DataFrame:
    """Degree and weighted degree of both kinds of ends."""
    both = links.select(F.col("source").alias("node"), "weight").union(links.select(F.col("target").alias("node"), "weight"))
    return both.groupBy("node").agg(F.count("*").alias("degree"), F.sum("weight").alias("weighted_degree"))


def clustering(links: DataFrame) -> DataFrame:
    """Local clustering on out-neighbours: links among a node's distinct neighbours over k(k - 1); links count with multiplicity.

    A link x to y counts for those nodes that have both as neighbours. They are looked for among the nodes that lead to
    x or to y, whichever are fewer, so that a hub's neighbours do not meet each other.
    """
    near = cut_lineage(links.select("source", "target").filter("source <> target").distinct(), "near")
    sizes = near.groupBy("source").agg(F.count("*").alias("k"))
    into = near.groupBy(F.col("target").alias("node")).agg(F.count("*").alias("n"))
    many = links.filter("source <> target").groupBy(F.col("source").alias("x"), F.col("target").alias("y")).agg(F.count("*").alias("times"))
    for end in "xy":
        many = many.join(into.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}")), end)
    fewer = F.col("n_x") <= F.col("n_y")
    asked = many.select(F.when(fewer, F.col("x")).otherwise(F.col("y")).alias("target"), F.when(fewer, F.col("y")).otherwise(F.col("x")).alias("other"), "times")
    inner = asked.join(near, "target").select("source", "other", "times").join(near.select("source", F.col("target").alias("other")), ["source", "other"], "left_semi")
    counted = inner.groupBy("source").agg(F.sum("times").alias("links"))
    share = F.coalesce(F.col("links"), F.lit(0)) / (F.col("k") * (F.col("k") - 1))
    return sizes.join(counted, "source", "left").select(F.col("source").alias("node"), "k", F.when(F.col("k") < 2, 0.0).otherwise(share).alias("coefficient"))
