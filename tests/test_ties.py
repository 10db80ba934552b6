"""Means on a bar, sums that cancel out and decimal ties: the same in whatever order rows are added."""

from itertools import permutations

from pyspark.sql import functions as F

from evigraph.functions import labels
from evigraph.functions.text import duration_text
from evigraph.operators import graph, mining

EDGE = "source string, target string, mechanism string, outcome string, confidence double, weight double"


def test_a_mean_on_a_bar_counts_in_any_order(spark):
    below = 0.7 - 1e-16
    assert below < 0.7
    row = spark.range(1).select(
        labels.evidence_level(F.lit(10), F.lit(0.75 - 1e-16)).alias("level"), labels.advice(F.lit(0.3 + 1e-16), F.lit(0.8), F.lit(9)).alias("above"), labels.advice(F.lit(-0.3 - 1e-16), F.lit(0.8), F.lit(9)).alias("under"),
    ).first()
    assert row.level == "strong" and row.above.startswith("Neutral") and row.under.startswith("Neutral")
    links = spark.createDataFrame([("a", "b", below), ("b", "c", 0.7)], "source string, target string, weight double")
    assert [r.path for r in graph.simple_paths(links, "a", "c", 3, 0.7).collect()] == ["a>b>c"]


def test_evidence_that_cancels_out_predicts_nothing(spark):
    for order in permutations([("improves", 0.1 + 0.2), ("worsens", 0.2), ("worsens", 0.1)]):
        rows = [("s", "x", "m", o, c, 1.0 if o == "improves" else -1.0) for o, c in order] + [("t", "y", "n", "improves", 0.5, 1.0)]
        e = spark.createDataFrame(rows, EDGE).coalesce(1)
        clusters = spark.createDataFrame([("x", "k"), ("y", "k")], "target string, cluster string")
        got = mining.gaps(e, clusters, threshold=0.0, cap=None).filter("source = 's'").collect()
        assert [(r.source, r.target) for r in got] == [("s", "y")] and got[0].sources == 1


def test_durations_round_the_double_itself(spark):
    counts = [*range(1, 1200, 7), 30, 90, 150, 210, 270, 330]
    got = spark.createDataFrame([(n,) for n in counts], "n bigint").select("n", duration_text(F.col("n") * 17.3, "m").alias("m"), duration_text(F.col("n") * 17.3).alias("x")).collect()
    assert all(r.m == f"{r.n * 17.3 / 60:.1f}m" for r in got)
    assert {r.x[-1] for r in got} == {"s", "m", "h"}
    ties = [0.25, 0.75, 0.05, 0.15, 2.5, 8.65, 25.95, 0.0, 59.95]
    got = spark.createDataFrame([(x,) for x in ties], "x double").select("x", duration_text(F.col("x")).alias("s")).collect()
    assert all(r.s == f"{r.x:.1f}s" for r in got)
