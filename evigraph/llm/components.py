"""Connected components of an edge table by alternating large and small stars.

Only DataFrame operations: each round keeps one row for each edge, in the shared folder,
so nothing is gathered on the driver or in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_tables, persist_table


def _large(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small(edges: DataFrame) -> DataFrame:
    """Edges lead from the larger to the smaller end."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    kept = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return kept.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, a: str, b: str, most_rounds: int = 60) -> DataFrame:
    """node and component (the smallest node it reaches) for every node that is not itself its component's smallest: a table in the shared folder."""
    now = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    now = persist_table(now, "edges")
    mark = None
    for _ in range(most_rounds):
        before, now = now, persist_table(_small(_large(now).distinct()), "edges")
        drop_tables(before)
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if (seen.n, seen.s) == mark:
            break
        mark = seen.n, seen.s
    else:
        raise RuntimeError("components did not settle")
    found = persist_table(now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")), "components")
    drop_tables(now)
    return found
