"""Weak components by alternating large and small stars, on DataFrames; tables that cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_folder


def cut_lineage(df: DataFrame, label: str) -> DataFrame:
    """Write to the folder that all executors share, and read back; a lost executor costs a re-read."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._written_to = path
    return back


def drop_table(*tables: DataFrame) -> None:
    """Delete the files of tables from ``cut_lineage`` that nothing reads again."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df._written_to)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def weak_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """node and component (its smallest member) of every end of an edge.

    Each round keeps about one row for each edge; rows of a hub are spread by the other end's hash in every shuffle
    but that of the hub's own minimum, which is combined where rows lie.
    """
    ends = edges.select(F.explode(F.array(a, b)).alias("node")).filter("node IS NOT NULL").distinct()
    now = cut_lineage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(), "links")
    mark = None
    while True:
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
        before, now = now, cut_lineage(small.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
        drop_table(before)
        seen = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if (seen.n, seen.s) == mark:
            break
        mark = seen.n, seen.s
    found = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
    out = cut_lineage(ends.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("component")), "labels")
    drop_table(now)
    return out
