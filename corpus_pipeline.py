"""A corpus pipeline: five of the llm operators, each working on what the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from evigraph.llm import byte_bpe, decontamination, jaccard_join, pii, toxicity
from evigraph.llm.common import drop_tables, few, free, persist_table, table


def _with_text(found: DataFrame, text: str, columns: list[str]) -> DataFrame:
    """The columns of documents, with another text and its length; a null text stays null."""
    out = found.withColumn("text", F.when(F.col("text").isNotNull(), F.col(text)))
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast("bigint"))
    return out.select(*columns)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.5 or more go; null and empty texts, repeated rows and all columns are kept as they are."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").filter(~toxicity.held_out()), "toxic")
    return toxicity.score(docs, model, keep=tuple(docs.columns)).filter(F.col(free("score", docs.columns)) < 0.5).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays; rows without an id stay.

    Where an id repeats, rows with other texts are documents of their own, of which the one with the
    smaller digest goes first; of rows with equal id and text the least by all columns stays.
    """
    if docs.filter("doc_id IS NOT NULL").groupBy("doc_id").count().filter("count > 1").isEmpty():
        return _representatives(docs, "doc_id")
    key, row = free("_key", docs.columns), free("_row", docs.columns)
    spelled = F.lpad(F.hex(F.col("doc_id").cast("bigint").bitwiseXOR(F.lit(-(2**63)).cast("bigint"))), 16, "0")  # sorts as the id
    keyed = persist_table(docs.withColumn(key, F.concat(spelled, F.md5(F.coalesce("text", F.lit(""))))), "keyed")
    kept = _representatives(keyed, key)
    named = kept.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*docs.columns)).alias(row))
    return named.select(f"{row}.*").union(kept.filter(F.col(key).isNull()).select(*docs.columns))


def _representatives(docs: DataFrame, key: str) -> DataFrame:
    linked = persist_table(jaccard_join.link(docs, id_col=key).select(key, "component_id"), "linked")
    gone = linked.filter(F.col(key) != F.col("component_id")).select(key).distinct()
    return docs.join(few(gone), key, "left_anti").select(*docs.columns)


def remove_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words inside occurrences of benchmark windows are cut from the text; every document stays."""
    found = decontamination.find(docs, table(spark, sf_dir, "benchmark"), keep=tuple(docs.columns), keep_text=True)
    return _with_text(found, free("cleaned", docs.columns), docs.columns)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and the terms that disclose it give way to the name of their kind; every document stays."""
    found = pii.find(docs, keep=tuple(docs.columns), with_text=True)
    return _with_text(found, free("sanitised", docs.columns), docs.columns)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and digests of them and of the bytes that they decode to."""
    encoded = byte_bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    spelled = F.array_join(F.col("ids").cast("array<string>"), " ")
    return encoded.select("doc_id", "ids", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(spelled, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", remove_benchmark_passages),
    ("pii", sanitise),
    ("byte_bpe", tokenise),
]
#: No SQL for a learnt classifier or BPE merges: tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written and read again."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = persist_table(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            drop_tables(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
