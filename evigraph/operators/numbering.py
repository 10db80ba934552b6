"""Consecutive numbers in a total order without gathering the rows in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .components import cut_lineage


def numbered(df: DataFrame, order: list[str], name: str = "n", first: int = 1) -> DataFrame:
    """``name``: the place of each row in the order of columns ``order``, from ``first``.

    Rows are range-partitioned and numbered inside their partition; offsets come from a table
    with one row a partition.
    """
    dealt = cut_lineage(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranges")
    counts = dealt.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return dealt.withColumn("_own", own).join(F.broadcast(offsets), "_part").withColumn(name, F.col("_before") + F.col("_own") + (first - 1)).drop("_part", "_own", "_before")
