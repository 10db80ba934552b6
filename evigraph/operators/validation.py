"""Validation as columns: an array of issues for each row; a row is valid when none is an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import is_placeholder


def issue(field: str, severity: str, message: str, holds: Column) -> Column:
    return F.when(F.coalesce(holds, F.lit(False)), F.struct(F.lit(field).alias("field"), F.lit(severity).alias("severity"), F.lit(message).alias("message")))


def with_issues(df: DataFrame, *issues: Column) -> DataFrame:
    found = F.filter(F.array(*issues), lambda i: i.isNotNull())
    return df.withColumn("issues", found).withColumn("valid", ~F.exists("issues", lambda i: i.severity == "error"))


def required(name: str) -> Column:
    return issue(name, "error", "missing", F.col(name).isNull() | (F.trim(F.col(name).cast("string")) == ""))


def length_between(name: str, least: int, most: int) -> list[Column]:
    n = F.length(F.trim(F.col(name)))
    return [issue(name, "error", f"under {least} characters", n < least), issue(name, "warning", f"over {most} characters", n > most)]


def one_of(name: str, allowed: tuple[str, ...]) -> Column:
    return issue(name, "error", "not a known value", F.col(name).isNotNull() & ~F.lower(F.trim(F.col(name))).isin(*allowed))


def matches(name: str, pattern: str, severity: str = "error") -> Column:
    return issue(name, severity, "malformed", F.col(name).isNotNull() & ~F.col(name).rlike(pattern))


def validate_papers(papers: DataFrame) -> DataFrame:
    """Required id and title; id of 7 or 8 digits; lengths; date and DOI patterns."""
    return with_issues(
        papers, required("pmid"), required("title"), issue("pmid", "error", "malformed", ~F.col("pmid").cast("string").rlike(r"^\d{7,8}$")), *length_between("title", 10, 500),
        *length_between("abstract", 50, 5000), issue("journal", "warning", "over 200 characters", F.length("journal") > 200), matches("publication_date", r"^\d{4}(-\d{2}(-\d{2})?)?$"), matches("doi", r"^10\.\d{4,9}/\S+$", "warning"),
    )


#: Allowed words.
OUTCOMES = ("improves", "worsens", "no_effect", "inconclusive")
SEVERITIES = ("mild", "moderate", "severe")
COSTS = ("low", "medium", "high")
CATEGORIES = ("exercise", "diet", "supplement", "medication", "therapy", "lifestyle", "surgery", "test", "device", "procedure", "biologics", "gene_therapy", "emerging")


def validate_records(records: DataFrame) -> DataFrame:
    """Names, outcome, confidence, sample size and mechanism of extracted records."""
    c = F.col("confidence")
    words = F.size(F.filter(F.split("mechanism", r"\s+"), lambda w: F.length(w) > 3))
    return with_issues(
        records, required("source"), required("target"), one_of("outcome", OUTCOMES), issue("source", "error", "placeholder", is_placeholder(F.col("source"))), issue("target", "error", "placeholder", is_placeholder(F.col("target"))),
        *length_between("source", 3, 200), issue("confidence", "error", "outside 0 to 1", (c < 0) | (c > 1)), issue("sample_size", "error", "under 1", F.col("sample_size") < 1), issue("mechanism", "warning", "too short to explain", words < 2),
    )


def check_query(text: str, limit: int, offset: int = 0, most: int = 1000) -> list[str]:
    """Problems of a search request."""
    out = [] if text and text.strip() else ["the query is empty"]
    out += ["the query is over 500 characters"] if text and len(text) > 500 else []
    out += [] if 1 <= limit <= most else [f"the limit is not within 1 and {most}"]
    return out + ([] if offset >= 0 else ["the offset is negative"])


def valid_request(term: Column, count: Column) -> Column:
    """A search asks for some words, 500 characters at most, and 1 to 1000 results."""
    return (F.trim(term) != "") & (F.length(term) <= 500) & count.between(1, 1000)


def export_verdict(rows: DataFrame, least: int = 10, by: list[str] | None = None) -> DataFrame:
    """Counts of an export with a verdict, in one row, or one for each export of ``by``."""
    return rows.groupBy(*by or []).agg(F.count("*").alias("rows"), F.countDistinct("source").alias("sources"), F.count_if(F.col("source").isNull() | F.col("target").isNull()).alias("incomplete")).withColumns({"few": F.col("rows") < least, "valid": (F.col("incomplete") == 0) & (F.col("rows") > 0)})


def band_report(rows: DataFrame, name: Column, high: float = 0.7, middle: float = 0.4, top: int = 3) -> DataFrame:
    """How many rows (by confidence ``c``) are in each band, and the ``top`` surest of each, ties by the other columns."""
    band = F.when(F.col("c") > high, "high").when(F.col("c") >= middle, "middle").otherwise("low")
    banded = rows.withColumn("band", band).withColumn("_name", name)
    ties = [c for c in rows.columns if c != "c"]
    ranked = banded.withColumn("_r", F.row_number().over(Window.partitionBy("band").orderBy(F.desc("c"), *ties))).filter(F.col("_r") <= top)
    best = ranked.groupBy("band").agg(F.array_sort(F.collect_list(F.struct("_r", "_name"))).alias("b"))
    listed = F.array_join(F.transform("b", lambda e: e.getField("_name")), ",")
    return banded.groupBy("band").agg(F.count("*").alias("n")).join(best, "band").select("band", "n", listed.alias("best"))


def order_breaks(ranked: DataFrame, key: str, rank: str, value: str) -> DataFrame:
    """Rows that score more than the row ranked before them."""
    before = F.lag(value).over(Window.partitionBy(key).orderBy(rank))
    return ranked.withColumn("_before", before).filter(F.col(value) > F.col("_before")).drop("_before")
