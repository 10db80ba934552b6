import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and long texts, repeats, ties, clashing column names."""
    base = "The quick brown fox jumps over the lazy dog while the small grey cat sleeps on the old wooden table near a window"
    rows = [
        (1, base, "en", "s", 5, "x"), (2, base, "en", "s", 5, "x"), (2, base, "en", "s", 5, "x"), (3, None, None, None, None, None), (4, "", "en", "s", 0, ""),
        (5, "   \n\t ", "fr", "s", 6, "y"), (6, "word " * 30_000, "en", "s", 1, "x"), (None, "no id here at all", "en", "s", 1, "x"), (7, "a" * 50_000, "en", "s", 1, "x"),
        (8, base + " today", "en", "s", 1, "x"), (9, "Mail me: jo.e+x@ex-ample.co.uk or +1 (377) 555-0271, 4111 1111 1111 1111, 10.0.255.1 é日本😀", "en", "s", 1, "x"),
        (7, "other text with the same id", "en", "s", 1, "x"), (10, "<|endoftext|> İΣΑΣ ς don't WE'LL", "xx", "s", 1, "x"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_tokens int, _text string")
    return df.withColumns({"score": F.lit("clash"), "id": F.lit(1), "_shard": F.lit("q"), "n_words": F.lit(0)})


@pytest.fixture(scope="session")
def no_docs(edge_docs):
    return edge_docs.limit(0)
