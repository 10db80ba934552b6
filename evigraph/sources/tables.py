"""Logical tables of the domain as views over the driver's star schema.

Operators are written against these schemas alone; another data set needs only other
views. Nothing here triggers a job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import ladder, outcome_weight


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def edges(spark: SparkSession, sf_dir: str, design: bool = False, since: str | None = None, before: str | None = None, place: bool = False) -> DataFrame:
    """Evidence edges: one study's claim about an intervention (source) and a condition (target).

    ``design`` adds study_design, which takes a join with the papers; every study has one, so
    the edges are the same without it. Of the lines with flag N (a third) only small ones are inconclusive and the
    others count as improving, so that scores and thresholds meet all outcomes. ``since`` and ``before`` are dates, compared with the
    stored column itself so that the comparison reaches the scan. ``place`` adds the line's file and row in it, which is the table's order.
    """
    lines = raw(spark, sf_dir, "lineitem")
    if place:
        lines = lines.withColumn("place", F.struct("_metadata.file_path", "_metadata.row_index"))
    if since:
        lines = lines.filter(F.col("l_shipdate") >= F.lit(since).cast("timestamp_ntz"))
    if before:
        lines = lines.filter(F.col("l_shipdate") < F.lit(before).cast("timestamp_ntz"))
    names = raw(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    parts = raw(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type")
    joined = lines.join(names, F.col("l_suppkey") == F.col("s_suppkey")).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    if design:
        orders = raw(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("study_design"))
        joined = joined.join(orders, "l_orderkey")
    outcome = ladder(
        (F.col("l_returnflag") == "A", "improves"),
        ((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "F"), "worsens"),
        (F.col("l_returnflag") == "R", "no_effect"),
        (F.col("l_quantity") < 5, "inconclusive"),
        otherwise="improves",
    )
    out = joined.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("study_id"), F.col("l_orderkey").alias("paper_id"), F.col("s_name").alias("source"), F.col("p_brand").alias("target"),
        F.col("p_type").alias("mechanism"), outcome.alias("outcome"), (0.5 + 5 * F.col("l_discount")).alias("confidence"), F.col("l_quantity").alias("sample_size"),
        F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month"), *["study_design"] * design, *["place"] * place,
    )
    return out.withColumn("weight", outcome_weight(F.col("outcome")))


def edges_sparse(spark: SparkSession, sf_dir: str, design: bool = False, place: bool = False) -> DataFrame:
    """Edges of one quarter, so that some pairs are untested."""
    return edges(spark, sf_dir, design, "1998-01-01", "1998-04-01", place)


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers: id, journal, date, status, influence and citations."""
    o = raw(spark, sf_dir, "orders")
    status = ladder((F.col("o_orderstatus") == "F", "processed"), (F.col("o_orderstatus") == "O", "pending"), otherwise="failed")
    return o.select(
        F.col("o_orderkey").alias("pmid"), F.concat(F.lit("Study of customer "), F.col("o_custkey")).alias("title"),
        F.when(F.col("o_orderkey") % 11 != 0, F.concat(F.lit("Abstract "), F.col("o_orderpriority"))).alias("abstract"), F.col("o_orderpriority").alias("journal"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("publication_date"), status.alias("processing_status"),
        F.when(F.col("o_custkey") % 7 != 0, F.col("o_totalprice") / 1000).alias("influence_score"), (F.col("o_custkey") % 100).cast("int").alias("citation_count"),
        (F.col("o_custkey") % 3 == 0).alias("has_fulltext"), F.when(F.col("o_custkey") % 3 == 0, F.when(F.col("o_custkey") % 2 == 0, "pmc").otherwise("unpaywall")).alias("fulltext_source"),
        F.when(F.col("o_custkey") % 4 != 0, F.concat(F.lit("10.1000/"), F.col("o_orderkey"))).alias("doi"),
    )


def canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity names and the canonical group, category and type of each."""
    s, n, r, p = (raw(spark, sf_dir, t) for t in ("supplier", "nation", "region", "part"))
    interventions = s.join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    interventions = interventions.select(F.col("s_name").alias("entity_name"), F.lit("intervention").alias("entity_type"), F.col("n_name").alias("canonical_name"), F.col("r_name").alias("category"))
    conditions = p.select(F.col("p_brand").alias("entity_name"), F.lit("condition").alias("entity_type"), F.substring("p_brand", 1, 7).alias("canonical_name"), F.lit("brand").alias("category")).distinct()
    return interventions.unionByName(conditions)


def clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of clusters with their vectors."""
    e = raw(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("member"), F.col("label").alias("cluster_id"), F.transform("embedding", lambda x: x.cast("double")).alias("vector"))
