"""Recommendations for a condition: five channels of evidence folded by candidate, ranked, explained and checked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.labels import ladder, lookup
from .bayes import score_pairs

#: The weight of each channel; the first of equal scores names the evidence.
CHANNELS = {"direct": 1.0, "mechanism": 0.7, "similar_condition": 0.6, "fundamental": 0.9, "combination": 0.8}
#: What a class says.
CLASSES = {
    "established": "Well-established treatment with strong evidence",
    "emerging_promising": "Promising emerging treatment with positive early results",
    "moderate_evidence": "Moderate evidence base, worth considering",
    "experimental": "Experimental treatment, limited evidence",
}


def _six(c):
    return F.round(c + 1e-9, 6)


def recommendations(edges: DataFrame, similar: DataFrame, failed: DataFrame, fundamental: DataFrame, combined: DataFrame, top: int = 10, least: float = 0.3, explore: float = 0.2) -> DataFrame:
    """The ``top`` interventions of each condition: tried on it, or on a condition of ``similar`` (a, b).

    ``fundamental`` (source, mechanisms, effect) and ``combined`` (a, b, lift) give the last two channels, of which
    a candidate takes its best combination with another one tried on the condition. Sources of ``failed`` are left out,
    as is what is sure by less than ``least``. The bonus of less proven classes is the mean of the range it can be drawn
    from, so that a result repeats. Scores have six digits; ties go by name.
    """
    scores = score_pairs(edges, quantiles=False).select("target", "source", "score", "confidence")
    n = edges.groupBy("target", "source").agg(F.count("*").alias("n"))
    direct = scores.join(n, ["target", "source"])
    both = similar.select("a", "b").union(similar.select("b", "a")).toDF("target", "peer").distinct()
    peers = both.join(scores.select(F.col("target").alias("peer"), "source", "score"), "peer").groupBy("target", "source").agg(F.avg(0.8 * F.col("score")).alias("s_similar_condition"), F.array_sort(F.collect_set("peer")).alias("peers"))
    ways = edges.groupBy("source").agg(F.collect_set("mechanism").alias("m_source"))
    needs = edges.filter("outcome = 'improves'").groupBy("target").agg(F.collect_set("mechanism").alias("m_target"))
    breadth = fundamental.select("source", F.least(F.lit(0.7), 0.1 * F.col("mechanisms") + 0.5 * F.col("effect")).alias("s_fundamental"))
    couples = combined.filter("lift > 1.2").select("a", "b", "lift")
    couples = couples.union(couples.select("b", "a", "lift")).toDF("source", "other", "lift")
    tried = n.select("target", "source")
    together = tried.join(couples, "source").join(tried.withColumnRenamed("source", "other"), ["target", "other"]).groupBy("target", "source").agg(F.least(F.lit(0.6), (F.max("lift") - 1) * 0.5).alias("s_combination"))
    rows = direct.select("target", "source", F.col("score").alias("s_direct"), F.col("confidence").alias("c_direct"), "n").join(peers, ["target", "source"], "full").join(failed.select("source").distinct(), "source", "left_anti")
    rows = rows.join(ways, "source", "left").join(needs, "target", "left").join(breadth, "source", "left").join(together, ["target", "source"], "left")
    rows = rows.withColumn("mechanisms", F.coalesce(F.array_sort(F.array_intersect("m_source", "m_target")), F.array().cast("array<string>"))).withColumn("peers", F.coalesce("peers", F.array().cast("array<string>")))
    rows = rows.withColumn("s_mechanism", F.when(F.size("mechanisms") > 0, F.least(F.lit(0.8), F.size("mechanisms") / F.size("m_target"))))
    sure = {"direct": F.when(F.col("c_direct") > 0, F.col("c_direct")), "mechanism": F.lit(0.6), "similar_condition": F.lit(0.5), "fundamental": F.lit(0.65), "combination": F.lit(0.55)}
    top_sum, weight, total, known = F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(0)
    for name, w in CHANNELS.items():
        s = F.col(f"s_{name}")
        here = s > 0
        top_sum, weight = top_sum + F.when(here, s * w).otherwise(0.0), weight + F.when(here, w).otherwise(0.0)
        c = F.when(here, sure[name])
        total, known = total + F.coalesce(c, F.lit(0.0)), known + c.isNotNull().cast("int")
    best = F.greatest(*[_six(F.col(f"s_{name}")) for name in CHANNELS])
    kind = F.coalesce(*[F.when(_six(F.col(f"s_{name}")) == best, name) for name in CHANNELS])
    rows = rows.withColumns({
        "base_score": _six(F.when(weight > 0, top_sum / weight)), "confidence": _six(F.when(known > 0, total / known)), "evidence_type": kind,
        "evidence_count": F.coalesce("n", F.lit(0)) + F.size("mechanisms") + F.size("peers"),
    }).filter(F.col("confidence") >= least)
    k, c = F.col("evidence_count"), F.col("confidence")
    # the second rung holds wherever the third would: the order is that of the thresholds' table
    rows = rows.withColumn("classification", ladder(((k >= 8) & (c >= 0.7), "established"), ((k >= 2) & (c >= 0.4), "emerging_promising"), ((k >= 4) & (c >= 0.5), "moderate_evidence"), otherwise="experimental"))
    bonus = lookup(F.col("classification"), {"emerging_promising": explore, "experimental": explore / 2}, 0.0) + F.when((F.col("evidence_type") == "mechanism") & (F.size("mechanisms") > 1), 0.05).otherwise(0.0)
    rows = rows.withColumn("exploration_bonus", bonus).withColumn("final_score", _six(F.least(F.lit(1.0), F.col("base_score") + F.col("exploration_bonus"))))
    rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy("target").orderBy(F.desc("final_score"), "source"))).filter(F.col("rank") <= top)
    return rows.select("target", "source", "rank", "final_score", "base_score", "exploration_bonus", "confidence", "evidence_type", "evidence_count", "classification", "mechanisms", "peers")


def explanation() -> Column:
    """One recommendation in words; percentages are whole, halves go up."""
    share = lambda c: F.concat(F.round(100 * F.col(c) + 1e-9).cast("int").cast("string"), F.lit("%"))
    two = lambda c: F.array_join(F.slice(c, 1, 2), ", ")
    return F.concat_ws(
        " | ", lookup(F.col("classification"), CLASSES, "Treatment under evaluation"), F.concat(F.lit("Confidence: "), share("confidence")), F.concat(F.lit("Evidence count: "), F.col("evidence_count").cast("string")),
        F.when(F.size("mechanisms") > 0, F.concat(F.lit("Targets: "), two("mechanisms"))), F.when(F.size("peers") > 0, F.concat(F.lit("Also effective for: "), two("peers"))),
        F.when(F.col("exploration_bonus") > 0, F.concat(F.lit("Exploration bonus: +"), share("exploration_bonus"))),
    )


def recommendation_diversity(rows: DataFrame) -> DataFrame:
    """How varied each condition's recommendations are: classes, kinds of evidence, mechanisms, means."""
    kinds = [F.count_if(F.col("classification") == c).alias(c) for c in CLASSES] + [F.count_if(F.col("evidence_type") == c).alias(c) for c in CHANNELS]
    per = rows.groupBy("target").agg(F.count("*").alias("total"), *kinds, F.avg("confidence").alias("mean_confidence"), F.avg("exploration_bonus").alias("mean_bonus"))
    reached = rows.select("target", F.explode("mechanisms").alias("m")).groupBy("target").agg(F.countDistinct("m").alias("mechanisms"))
    return per.join(reached, "target", "left").withColumn("mechanisms", F.coalesce("mechanisms", F.lit(0)))


def recommendation_problems(rows: DataFrame) -> DataFrame:
    """What contradicts itself, one row a problem: a final score under the base, a confidence or count out of range, a wrong order."""
    rows = rows.withColumn("before", F.lag("final_score").over(Window.partitionBy("target").orderBy("rank")))
    found = F.array(
        F.when(F.col("final_score") < F.col("base_score") - 0.01, "final score under base score"), F.when(~F.col("confidence").between(0, 1), "invalid confidence"),
        F.when(F.col("evidence_count") < 0, "negative evidence count"), F.when(F.col("final_score") > F.col("before"), "not sorted by final score"),
    )
    return rows.select("target", "source", F.explode(F.array_compact(found)).alias("problem"))
