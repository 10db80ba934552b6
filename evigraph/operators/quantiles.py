"""Exact quantiles of groups of any size by counting passes over narrowing ranges.

Each pass counts a group's values in ``BINS`` bins between the least and the greatest value that is still in question,
and goes on with the bin that holds the rank asked for, between the least and the greatest value found in it. A bin of one
value ends the search; one of ``FEW`` values or less is put in order. So no task holds more of a group than
its bins, or one bin's few values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .components import cut_lineage

BINS, FEW = 1024, 4096
#: Ranges that are broadcast at most.
MOST_RANGES = 100_000


def _bin(x: Column, low: Column, high: Column, bins: int) -> Column:
    """A bin that never falls as x grows; infinite ends have bins of their own."""
    inside = F.nanvl((x - low) / (high - low), F.lit(0.5)) * bins
    return F.when(x <= low, 0).when(x >= high, bins - 1).otherwise(F.greatest(F.lit(0), F.least(F.lit(bins - 1), F.floor(inside).cast("int"))))


def _counted(ranges: DataFrame) -> DataFrame:
    """Broadcast ranges that are counted to be few; those of more groups are joined by group, where skewed ones are split."""
    return F.broadcast(ranges) if ranges.count() <= MOST_RANGES else ranges


def order_statistics(rows: DataFrame, groups: list[str], value: str, ranks: DataFrame, bins: int = BINS, few: int = FEW) -> DataFrame:
    """``groups``, rank and x: the value of each rank (from 0) that ``ranks`` (groups, rank) asks for.

    Null values and NaN take no part. A few ranks a group are meant: each has bins of its own.
    """
    plain = rows.select(*[F.col(g).alias(f"_g{k}") for k, g in enumerate(groups)], F.col(value).cast("double").alias("_x")).filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
    own = [f"_g{k}" for k in range(len(groups))]
    ends = plain.groupBy(*own).agg(F.min("_x").alias("low"), F.max("_x").alias("high"), F.count("*").alias("n"))
    asked = ranks.select(*[F.col(g).alias(f"_g{k}") for k, g in enumerate(groups)], F.col("rank").cast("bigint").alias("rank")).distinct()
    same = [F.col(f"t.{g}").eqNullSafe(F.col(f"p.{g}")) for g in own]
    left = asked.alias("t").join(ends.alias("p"), same or F.lit(True)).filter((F.col("rank") >= 0) & (F.col("rank") < F.col("n")))
    # before: values below the range
    left = cut_lineage(left.select(*[F.col(f"t.{g}") for g in own], "rank", "low", "high", "n", F.lit(0).cast("bigint").alias("before")), "ranges")
    found = []
    while True:
        found.append(left.filter("low = high").select(*own, "rank", F.col("low").alias("x")))
        small = left.filter(F.col("low") < F.col("high")).filter(F.col("n") <= few)
        inside = [*same, F.col("_x").between(F.col("low"), F.col("high"))]
        place = F.row_number().over(Window.partitionBy(*[F.col(f"t.{g}") for g in own], "rank").orderBy("_x")) - 1 + F.col("before")
        ordered = plain.alias("p").join(_counted(small).alias("t"), inside).select(*[F.col(f"t.{g}") for g in own], "rank", F.col("_x").alias("x"), place.alias("place"))
        found.append(cut_lineage(ordered.filter("place = rank").select(*own, "rank", "x"), "ordered"))
        wide = left.filter((F.col("low") < F.col("high")) & (F.col("n") > few))
        if wide.isEmpty():
            break
        counted = plain.alias("p").join(_counted(wide).alias("t"), inside).withColumn("bin", _bin(F.col("_x"), F.col("low"), F.col("high"), bins))
        counted = counted.groupBy(*[F.col(f"t.{g}").alias(g) for g in own], "rank", "before", "bin").agg(F.min("_x").alias("low"), F.max("_x").alias("high"), F.count("*").alias("n"))
        # bins of one range: a bounded number of rows
        upto = F.sum("n").over(Window.partitionBy(*own, "rank").orderBy("bin")) + F.col("before")
        chosen = counted.withColumn("upto", upto).filter((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
        left = cut_lineage(chosen.select(*own, "rank", "low", "high", "n", (F.col("upto") - F.col("n")).alias("before")), "ranges")
    out = found[0]
    for f in found[1:]:
        out = out.union(f)
    return out.select(*[F.col(f"_g{k}").alias(g) for k, g in enumerate(groups)], "rank", "x")


def quantiles(rows: DataFrame, groups: list[str], value: str, shares: list[float], **sizes: int) -> DataFrame:
    """``groups``, share and x: the continuous quantiles of ``value`` (between neighbours by their distance), exact for groups of any size."""
    known = rows.filter(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    n = cut_lineage(known.groupBy(*groups).agg(F.count("*").alias("_n")), "sizes")
    at = n.withColumn("share", F.explode(F.array(*[F.lit(float(s)) for s in shares]))).withColumn("_at", F.col("share") * (F.col("_n") - 1))
    at = at.filter("_n > 0").withColumns({"_low": F.floor("_at").cast("bigint"), "_part": F.col("_at") - F.floor("_at")})
    at = at.withColumn("_high", F.least(F.col("_low") + 1, F.col("_n") - 1))
    ranks = at.select(*groups, F.explode(F.array("_low", "_high")).alias("rank"))
    found = cut_lineage(order_statistics(rows, groups, value, ranks, **sizes), "order")
    out = at.alias("s")
    for end in ("_low", "_high"):
        f = found.alias(f"f{end}")
        out = out.join(f, [*[F.col(f"s.{g}").eqNullSafe(F.col(f"f{end}.{g}")) for g in groups], F.col(f"s.{end}") == F.col(f"f{end}.rank")])
    low, high = F.col("f_low.x"), F.col("f_high.x")
    return out.select(*[F.col(f"s.{g}") for g in groups], "share", F.when(F.col("_part") == 0, low).otherwise(low + (high - low) * F.col("_part")).alias("x"))
