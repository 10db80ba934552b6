"""Data sets of evidence for readers outside: records with their papers, summaries, and the way in from model answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.labels import display_outcome
from ..sources.sinks import insert_replace
from .validation import validate_records

ANSWER = "array<struct<study_id string, source string, target string, mechanism string, outcome string, confidence double, sample_size double>>"


def _core():
    return [F.col("target").alias("condition"), F.col("source").alias("intervention"), display_outcome(F.col("outcome")).alias("correlation")]


def basic_export(edges: DataFrame, papers: DataFrame) -> DataFrame:
    """Each record with the title, journal and year of its paper; a record without a paper stays."""
    p = papers.select(F.col("pmid").alias("paper_id"), "title", "journal", F.substring("publication_date", 1, 4).try_cast("int").alias("publication_year"))
    return edges.join(p, "paper_id", "left").select("study_id", *_core(), F.col("confidence").alias("confidence_score"), "title", "journal", "publication_year")


def enhanced_export(edges: DataFrame, papers: DataFrame) -> DataFrame:
    """Each record with its optional fields, empty words as null, and its paper as one nested field."""
    none = lambda c: F.when(F.col(c) != "", F.col(c))
    paper = F.struct("pmid", "title", "journal", "publication_date", "doi", F.when(F.col("pmid").isNotNull(), F.concat(F.lit("https://pubmed.ncbi.nlm.nih.gov/"), F.col("pmid").cast("string"), F.lit("/"))).alias("pubmed_url"))
    rows = edges.join(papers, F.col("paper_id") == F.col("pmid"), "left")
    return rows.select(
        "study_id", *_core(), F.col("sample_size").alias("study_size"), F.substring("publication_date", 1, 4).try_cast("int").alias("publication_year"), F.col("confidence").alias("confidence_score"),
        none("study_design").alias("study_type"), none("mechanism").alias("mechanism"), paper.alias("paper"),
    )


def export_summary(edges: DataFrame, top: int = 10) -> DataFrame:
    """Counts by outcome, mean confidence, and the ``top`` interventions and conditions, in one row."""
    o = F.col("outcome")
    counts = edges.agg(
        F.count("*").alias("total"), F.countDistinct("source").alias("interventions"), F.countDistinct("target").alias("conditions"), F.countDistinct("paper_id").alias("papers"),
        *[F.count_if(o == x).alias(x) for x in ("improves", "worsens", "no_effect", "inconclusive")], F.round(F.coalesce(F.avg("confidence"), F.lit(0.0)) + 1e-9, 3).alias("mean_confidence"),
    )
    for end, name in (("source", "top_interventions"), ("target", "top_conditions")):
        best = edges.groupBy(end).count().orderBy(F.desc("count"), end).limit(top)
        listed = F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("k"), F.col(end).alias("name"))))
        counts = counts.crossJoin(best.agg(F.transform(listed, lambda e: e.getField("name")).alias(name)))
    return counts


def extract_records(answers: DataFrame, id_col: str, answer_col: str) -> DataFrame:
    """Records of model answers (cleaned, repaired where broken, flattened) with their issues; an answer that holds none gives no row."""
    clean = tx.clean_model_json(F.col(answer_col))
    found = F.from_json(clean, ANSWER)
    # only what does not parse as it stands goes through the slower repair
    parsed = answers.withColumn("_found", found)
    whole = parsed.filter("_found IS NOT NULL")
    broken = parsed.filter("_found IS NULL").withColumn("_found", F.from_json(tx.repair_json(tx.clean_model_json(F.col(answer_col))), ANSWER))
    return validate_records(whole.unionByName(broken).select(id_col, F.inline("_found")))


def save_extracted(stored: DataFrame, answers: DataFrame, id_col: str, answer_col: str, keys: list[str]) -> DataFrame:
    """The stored records with the valid ones of new answers, which take the place of those with their keys; of equal keys the surest stays."""
    good = extract_records(answers, id_col, answer_col).filter("valid")
    return insert_replace(stored, good, keys, [F.desc("confidence"), "study_id"])
