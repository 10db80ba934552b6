"""Readers: article XML, configuration and session JSON, review and suggestion files."""

from __future__ import annotations

import json
from pathlib import Path
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

#: Month names as article dates spell them.
MONTHS = {m: f"{i:02d}" for i, m in enumerate(("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"), 1)}
ROW_TAG = "PubmedArticle"


def boolean_query(term: Column, first_year: int, last_year: int) -> Column:
    """A title-and-abstract search within publication years."""
    return F.concat(F.lit('("'), term, F.lit(f'"[Title/Abstract]) AND ("{first_year}"[PDAT] : "{last_year}"[PDAT])'))


def assembled_date(year: Column, month: Column, day: Column) -> Column:
    """YYYY, YYYY-MM or YYYY-MM-DD: month names become numbers, numbers get two digits, the rest stops there."""
    named = F.try_element_at(F.create_map(*[F.lit(x) for p in MONTHS.items() for x in p]), F.initcap(F.substring(month, 1, 3)))
    m = F.coalesce(named, F.when(month.rlike(r"^\d{1,2}$"), F.lpad(month, 2, "0")))
    d = F.when(m.isNotNull() & day.rlike(r"^\d{1,2}$"), F.lpad(day, 2, "0"))
    return F.when(year.isNotNull() & (year != ""), F.concat_ws("-", year, m, d))


def read_articles(spark: SparkSession, path: str) -> DataFrame:
    """Article files (one, a folder or a glob) to papers.

    Each article is parsed from its own XML text, so irregular inline tags and missing parts need no
    inferred schema. Files are read and split at the articles' start tags: no file is held as a whole.
    """
    start = f"<{ROW_TAG}"
    pieces = spark.read.text(path, lineSep=start).select("value", F.col("_metadata.file_name").alias("source_file"))
    # what is before the first article, or ends without an end tag, is none
    rest = F.regexp_extract("value", rf"(?s)^([ >].*?</{ROW_TAG}>)", 1).alias("x")
    return parse_articles(pieces.select("source_file", rest).filter("x <> ''").withColumn("x", F.concat(F.lit(start), "x")))


#: Where the fields of an article lie.
PATHS = {
    "pmid": "MedlineCitation/PMID", "year": "JournalIssue/PubDate/Year", "month": "JournalIssue/PubDate/Month", "day": "JournalIssue/PubDate/Day",
    "journal": "Journal/Title", "short": "Journal/ISOAbbreviation", "doi": "ArticleId[@IdType='doi']", "pmc": "ArticleId[@IdType='pmc']",
}


def _found(xml: str | None) -> dict:
    """The text of the first element on each path, null where that is empty, and all keywords, from one reading of the XML."""
    if xml is None:
        return {}
    root = ElementTree.fromstring(xml)
    first = {name: root.find(f".//{path}") for name, path in PATHS.items()}
    out = {name: ("".join(e.itertext()) or None) if e is not None else None for name, e in first.items()}
    said = [*root.iterfind(".//MeshHeading/DescriptorName"), *root.iterfind(".//Keyword")]
    return out | {"keywords": [t for e in said for t in (e.text, *(c.tail for c in e)) if t]}


@F.pandas_udf(StructType([*(StructField(name, StringType()) for name in PATHS), StructField("keywords", ArrayType(StringType()))]))
def _fields(xml: pd.Series) -> pd.DataFrame:
    rows = [_found(x) for x in xml]
    return pd.DataFrame({name: [r.get(name) for r in rows] for name in (*PATHS, "keywords")}, dtype=object)


def parse_articles(articles: DataFrame, xml_col: str = "x") -> DataFrame:
    """Fields of article XML: id, title (with a default), abstract with section labels, journal, date, DOI, full-text id, keywords."""
    x = F.col(xml_col)
    articles = articles.withColumn("_f", _fields(x))
    text = lambda name: F.col(f"_f.{name}")
    # sections: texts with inline tags flattened; a label goes before its section
    sections = F.regexp_extract_all(x, F.lit(r"(?s)(<AbstractText[^>]*>.*?</AbstractText>)"), 1)

    def section(s: Column) -> Column:
        label = F.regexp_extract(s, r'<AbstractText[^>]*Label="([^"]*)"', 1)
        body = F.trim(F.regexp_replace(s, r"(?s)<[^>]+>", ""))
        return F.when(label != "", F.concat(label, F.lit(": "), body)).otherwise(body)

    abstract = F.array_join(F.transform(sections, section), "\n")
    keywords = F.array_distinct(text("keywords"))
    title = F.trim(F.regexp_replace(F.regexp_extract(x, r"(?s)<ArticleTitle[^>]*>(.*?)</ArticleTitle>", 1), r"<[^>]+>", ""))
    date = assembled_date(text("year"), text("month"), text("day"))
    return articles.select(
        text("pmid").alias("pmid"), F.when(title == "", "No title available").otherwise(title).alias("title"), F.when(abstract != "", abstract).alias("abstract"),
        F.coalesce(text("journal"), text("short"), F.lit("Unknown")).alias("journal"), date.alias("publication_date"),
        text("doi").alias("doi"), text("pmc").alias("pmc_id"), keywords.alias("keywords"),
    )


def body_text(xml: Column) -> Column:
    """Paragraphs of a body, a line each, without inline tags; without such paragraphs all text without tags."""
    inner = F.regexp_extract_all(F.regexp_extract(xml, r"(?s)<body[^>]*>(.*?)</body>", 1), F.lit(r"(?s)<p[^>]*>(.*?)</p>"), 1)
    body = F.array_join(F.transform(inner, lambda p: F.trim(F.regexp_replace(p, r"<[^>]+>", ""))), "\n")
    return F.when(body != "", body).otherwise(F.trim(F.regexp_replace(xml, r"(?s)<[^>]+>", " ")))


def read_body(spark: SparkSession, path: str) -> DataFrame:
    """Full text of XML files (see ``body_text``); PDFs by a placeholder."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), "value")
    return files.select("file", F.when(F.lower("file").endswith(".pdf"), "[PDF content not extracted]").otherwise(body_text(F.col("value"))).alias("text"))


def read_config(path: str) -> dict:
    """A JSON configuration over the one that its ``_base`` names, merged key by key."""
    own = json.loads(Path(path).read_text())
    base = own.pop("_base", None)
    return merged(read_config(str(Path(path).parent / base)), own) if base else own


def merged(base: dict, over: dict) -> dict:
    out = dict(base)
    for key, value in over.items():
        out[key] = merged(out[key], value) if isinstance(value, dict) and isinstance(out.get(key), dict) else value
    return out


def read_suggestions(spark: SparkSession, path: str) -> DataFrame:
    """Mapping suggestions from CSV with a header."""
    return spark.read.csv(path, header=True, schema="term string, canonical string, confidence double, reason string")


def read_reviews(spark: SparkSession, path: str) -> DataFrame:
    """Review files: one JSON document each, a list or an object."""
    return spark.read.json(path, multiLine=True, schema="id long, model string, verdict string, reviewer string, notes string, reviewed_at string")


def embedding_cache(texts: DataFrame, cache: DataFrame, text_col: str) -> DataFrame:
    """Texts with their stored vectors by content hash; null where none is stored."""
    return texts.withColumn("text_hash", F.sha2(text_col, 256)).join(cache.select("text_hash", "vector"), "text_hash", "left")
