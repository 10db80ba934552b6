"""Windows, sorts, limits, samples (W and O rows)."""

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators.evidence import fold_pairs
from ..operators.quantiles import quantiles
from ..sources.tables import edges, edges_sparse, papers, raw
from .registry import EDGES, PAPERS, SPARSE, query, r6

PAIR = ", p AS (SELECT source, target, count(*) AS edge_count, round(sum(weight * confidence) / count(*) * avg(confidence), 6) AS score FROM edges GROUP BY ALL)"


def scored(spark, d):
    return fold_pairs(edges(spark, d), None).select("source", "target", "edge_count", r6("aggregate_score").alias("score"))


@query("w2_rank_in_condition", PAIR + " SELECT target, source, score, row_number() OVER (PARTITION BY target ORDER BY score DESC, source) AS rank FROM p", (EDGES,))
def w2(spark, d):
    return scored(spark, d).select("target", "source", "score", F.row_number().over(Window.partitionBy("target").orderBy(F.desc("score"), "source")).alias("rank"))


def yearly(e, first, last):
    """Counts on a dense axis of years for every intervention."""
    axis = e.select("source").distinct().select("source", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("year"))
    return axis.join(e.groupBy("source", "year").agg(F.count("*").alias("n")), ["source", "year"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


@query("w3_growth", """, axis AS (SELECT source, y AS year FROM (SELECT DISTINCT source FROM edges), generate_series(1996, 2001) t(y)), c AS (SELECT a.source, a.year, count(e.study_id) AS n FROM axis a LEFT JOIN edges e ON a.source = e.source AND a.year = e.year GROUP BY ALL),
  g AS (SELECT source, n, lag(n) OVER (PARTITION BY source ORDER BY year) AS before FROM c)
  SELECT source, round(coalesce(avg(CASE WHEN before > 0 THEN (n - before) / CAST(before AS DOUBLE) END), 0), 6) AS growth FROM g GROUP BY source""", (EDGES,))
def w3(spark, d):
    before = F.lag("n").over(Window.partitionBy("source").orderBy("year"))
    g = yearly(edges(spark, d), 1996, 2001).withColumn("before", before)
    rate = F.when(F.col("before") > 0, (F.col("n") - F.col("before")) / F.col("before"))
    return g.groupBy("source").agg(r6(F.coalesce(F.avg(rate), F.lit(0.0))).alias("growth"))


@query("w4_momentum", """, c AS (SELECT source, count(*) AS total, count(CASE WHEN year = 1996 THEN 1 END) AS y0, count(CASE WHEN year = 1998 THEN 1 END) AS y2, count(CASE WHEN year = 1999 THEN 1 END) AS y3, count(CASE WHEN year = 2001 THEN 1 END) AS y5 FROM edges GROUP BY source)
  SELECT source, CASE WHEN total < 3 THEN 0 ELSE round(least(1, greatest(0, ((CASE WHEN y3 > 0 THEN (y5 - y3) / 2.0 ELSE 0 END) - (CASE WHEN y0 > 0 THEN (y2 - y0) / 2.0 ELSE 0 END)) / 5)), 6) END::DOUBLE AS momentum FROM c""", (EDGES,))
def w4(spark, d):
    return momentum(edges(spark, d), 2001).withColumn("momentum", r6("momentum"))


def momentum(e, now):
    """Change of the yearly counts' slope over six years, scaled."""
    c = e.groupBy("source").agg(F.count("*").alias("total"), *[F.count_if(F.col("year") == now - 5 + k).alias(f"y{k}") for k in (0, 2, 3, 5)])
    early = F.when(F.col("y0") > 0, (F.col("y2") - F.col("y0")) / 2).otherwise(0.0)
    late = F.when(F.col("y3") > 0, (F.col("y5") - F.col("y3")) / 2).otherwise(0.0)
    return c.select("source", F.when(F.col("total") < 3, 0.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), (late - early) / 5))).alias("momentum"))


@query("w5_percentile_rank", PAIR + """ , n AS (SELECT count(*) AS n FROM p) SELECT source, target, round(50.0 * ((SELECT count(*) FROM p q WHERE q.score < p.score) + (SELECT count(*) FROM p q WHERE q.score <= p.score)
  + 1) / n.n, 6) AS pct FROM p, n""", (EDGES,))
def w5(spark, d):
    """The mean of strict and weak ranks. Ranks come from counts by score: the distinct scores are sorted, not the rows."""
    p = scored(spark, d)
    hist = p.groupBy("score").agg(F.count("*").alias("same"))
    weak = hist.select("score", "same", F.sum("same").over(Window.orderBy("score")).alias("le"), F.sum("same").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("n"))
    pct = 50.0 * ((F.col("le") - F.col("same")) + F.col("le") + 1) / F.col("n")
    return p.join(weak, "score").select("source", "target", r6(pct).alias("pct"))


@query("w6_percentile_threshold", PAIR + ", q AS (SELECT quantile_cont(score, 0.7) AS t FROM p) SELECT source, target FROM p, q WHERE score > t", (EDGES,))
def w6(spark, d):
    p = scored(spark, d)
    bar = quantiles(p, [], "score", [0.7]).first()  # one number
    return p.filter(F.col("score") > (bar.x if bar else None)).select("source", "target")


@query("w7_scaling", PAIR + """, s AS (SELECT min(score) AS lo, max(score) AS hi, avg(score) AS m, stddev_pop(score) AS sd FROM p)
  SELECT source, target, round(CASE WHEN hi = lo THEN 0.5 ELSE (score - lo) / (hi - lo) END, 6) AS minmax, round(CASE WHEN sd = 0 THEN 0.5 ELSE 1 / (1 + exp(-(score - m) / sd)) END, 6) AS zscore, round(1 / (1 + exp(-score)), 6) AS sigmoid FROM p, s""", (EDGES,))
def w7(spark, d):
    p = scored(spark, d)
    s = p.agg(F.min("score").alias("lo"), F.max("score").alias("hi"), F.avg("score").alias("m"), F.stddev_pop("score").alias("sd"))
    x = F.col("score")
    return p.crossJoin(F.broadcast(s)).select(
        "source", "target", r6(F.when(F.col("hi") == F.col("lo"), 0.5).otherwise((x - F.col("lo")) / (F.col("hi") - F.col("lo")))).alias("minmax"),
        r6(F.when(F.col("sd") == 0, 0.5).otherwise(1 / (1 + F.exp(-(x - F.col("m")) / F.col("sd"))))).alias("zscore"), r6(1 / (1 + F.exp(-x))).alias("sigmoid"),
    )


@query("o1_sort_nulls_last", "SELECT pmid, influence_score FROM papers ORDER BY influence_score DESC NULLS LAST, pmid LIMIT 20", (PAPERS,))
def o1(spark, d):
    return papers(spark, d).orderBy(F.desc_nulls_last("influence_score"), "pmid").limit(20).select("pmid", "influence_score")


@query("o2_top_n", PAIR + " SELECT source, target, score FROM p ORDER BY score DESC, source, target LIMIT 10", (EDGES,))
def o2(spark, d):
    return scored(spark, d).orderBy(F.desc("score"), "source", "target").limit(10).select("source", "target", "score")


@query("o3_flag_then_score", PAIR + " SELECT source, target, edge_count >= 2 AS high, score FROM p ORDER BY (edge_count >= 2) DESC, score DESC, source, target LIMIT 50", (EDGES,))
def o3(spark, d):
    return scored(spark, d).withColumn("high", F.col("edge_count") >= 2).orderBy(F.desc("high"), F.desc("score"), "source", "target").limit(50).select("source", "target", "high", "score")


@query("o4_most_frequent", "SELECT mechanism, count(*) AS n FROM sparse GROUP BY mechanism ORDER BY n DESC, mechanism LIMIT 3", (SPARSE,))
def o4(spark, d, sparse=edges_sparse):
    return sparse(spark, d).groupBy("mechanism").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "mechanism").limit(3)


@query("o5_stratified_sample", "SELECT doc_id, lang FROM (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY md5('7' || CAST(doc_id AS VARCHAR)), doc_id) AS r, count(*) OVER (PARTITION BY lang) AS n FROM documents) WHERE r <= ceil(n * 0.1)")
def o5(spark, d):
    """A tenth of each stratum, by a seeded hash: the same rows on any partitioning."""
    docs = raw(spark, d, "documents").select("doc_id", "lang", F.md5(F.concat(F.lit("7"), F.col("doc_id").cast("string"))).alias("h"))
    sizes = docs.groupBy("lang").agg(F.ceil(F.count("*") * 0.1).alias("k"))
    ranked = docs.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id")))
    return ranked.join(F.broadcast(sizes), "lang").filter("r <= k").select("doc_id", "lang")


@query("o6_pagination", "SELECT pmid, journal FROM papers ORDER BY publication_date, pmid LIMIT 25 OFFSET 50", (PAPERS,))
def o6(spark, d):
    return papers(spark, d).orderBy("publication_date", "pmid").offset(50).limit(25).select("pmid", "journal")
