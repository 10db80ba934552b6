"""Text expressions. Built-in functions throughout, but for the edit-distance ratio and JSON repairs."""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType

PREFIXES = ("the ", "a ", "an ")
SUFFIXES = (" therapy", " treatment", " intervention")
#: Category names and what they are merged into.
CATEGORY_SYNONYMS = {
    "digital_therapeutics": "digital_health",
    "digital_medicine": "digital_health",
    "telemedicine": "digital_health",
    "gene_therapy": "genetic_therapy",
    "genetic_intervention": "genetic_therapy",
    "precision_medicine": "personalized_medicine",
    "individualized_therapy": "personalized_medicine",
}
#: Names that say nothing alone.
GENERIC_TERMS = ("intervention", "treatment", "therapy", "procedure", "method", "approach", "technique", "program", "protocol")
#: Names that stand for no name, as spelled.
PLACEHOLDERS = (
    "...", "N/A", "n/a", "NA", "na", "null", "NULL", "none", "None",
    "unknown", "Unknown", "UNKNOWN", "placeholder", "Placeholder", "PLACEHOLDER",
    "TBD", "tbd", "TODO", "todo", "not specified", "not available",
    "various", "multiple", "several", "different", "mixed", "varies",
)
#: Names too general for a group, and terms that make a name specific.
GENERIC_GROUP_NAMES = (
    "intervention", "treatment", "therapy", "approach", "mechanism", "supplement", "medication", "procedure",
    "interventions", "treatments", "therapies", "approaches",
)
SPECIFIC_TERMS = (
    "probiotic", "anti-inflammatory", "glucose", "insulin", "cardiovascular", "gut microbiome", "enzyme", "receptor",
    "aerobic", "resistance", "cox", "vitamin", "mineral",
)
PLACEHOLDER_PREFIXES = ("unknown", "placeholder", "various", "multiple", "several")


def squeeze(col: Column) -> Column:
    """White space runs to single spaces, trimmed; null to empty."""
    return F.trim(F.regexp_replace(F.coalesce(col, F.lit("")), r"(?U)\s+", " "))


def normalize_term(col: Column) -> Column:
    """Lower case, single spaces, no punctuation but hyphens, which then turn to spaces."""
    text = F.regexp_replace(F.trim(F.lower(col)), r"(?U)\s+", " ")
    text = F.regexp_replace(text, r"(?U)[^\w\s\-]", "")
    return F.trim(F.regexp_replace(text, r"(?U)[-\s]+", " "))


def search_variants(col: Column) -> Column:
    """Distinct spellings to search a term by."""
    base = F.trim(F.lower(col))
    found = [base, F.trim(F.regexp_replace(F.lower(col), r"(?U)[^\w\s]", "")), F.trim(F.lower(F.replace(col, F.lit("-"), F.lit(" ")))), F.trim(F.lower(F.replace(col, F.lit(" "), F.lit("-"))))]
    found += [F.when(base.startswith(p), F.substring(base, len(p) + 1, F.length(base))) for p in PREFIXES]
    found += [F.when(base.endswith(s), F.substr(base, F.lit(1), F.length(base) - len(s))) for s in SUFFIXES]
    return F.array_sort(F.array_distinct(F.filter(F.array(*found), lambda v: v.isNotNull() & (F.trim(v) != ""))))


def normalize_string(col: Column, min_length: int = 0, max_length: int | None = None, lowercase: bool = True) -> Column:
    """Trimmed, lower-cased, single-spaced; null where empty or shorter than the least length; cut at the most."""
    text = squeeze(col)
    text = F.lower(text) if lowercase else text
    text = F.when((text != "") & (F.length(text) >= min_length), text)
    return F.substring(text, 1, max_length) if max_length is not None else text


def category_slug(col: Column) -> Column:
    """Category name as a slug, synonyms merged."""
    slug = F.regexp_replace(F.trim(F.regexp_replace(F.lower(col), r"[^a-zA-Z0-9\s]", "")), r"\s+", "_")
    merged = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in CATEGORY_SYNONYMS.items() for x in p]), slug), slug)
    return F.when(col.isNull() | (col == "") | (col == "unknown"), "uncategorized").otherwise(merged)


def truncate(col: Column, length: int = 100, suffix: str = "...") -> Column:
    return F.when(F.length(col) <= length, col).otherwise(F.concat(F.substring(col, 1, length - len(suffix)), F.lit(suffix)))


def numbers_in(col: Column) -> Column:
    return F.transform(F.regexp_extract_all(F.coalesce(col, F.lit("")), F.lit(r"(-?\d+\.?\d*)"), 1), lambda x: x.cast("double"))


def term_key(*parts: Column) -> Column:
    """md5 of normalised parts."""
    return F.md5(F.concat_ws("|", *[normalize_term(p) for p in parts]))


def text_key(col: Column) -> Column:
    return F.sha2(col, 256)


def pair_key(a: Column, b: Column) -> Column:
    """The same whichever comes first."""
    return F.md5(F.concat_ws("|", F.least(a, b), F.greatest(a, b)))


def is_placeholder(col: Column) -> Column:
    """A name that stands for no name."""
    text = F.trim(F.lower(col))
    one_word = ~text.rlike(r"\s")
    prefixed = F.lit(False)
    for p in PLACEHOLDER_PREFIXES:
        prefixed = prefixed | text.startswith(p)
    return text.isin(*PLACEHOLDERS) | (prefixed & one_word) | F.contains(col, F.lit("...")) | (F.replace(text, F.lit("."), F.lit("")) == "") | text.isin(*GENERIC_TERMS)


def name_quality(col: Column, generic: tuple[str, ...] = GENERIC_GROUP_NAMES, specific: tuple[str, ...] = SPECIFIC_TERMS) -> Column:
    """0 to 100: generic -50, one word -10, a specific term +10, three words +10, over 80 characters -5."""
    name = F.lower(col)
    words = F.size(F.filter(F.split(F.trim(col), r"\s+"), lambda w: w != ""))
    score = F.lit(100) - F.when(name.isin(*generic), 50).otherwise(0) - F.when(words < 2, 10).otherwise(0)
    score = score + F.when(F.exists(F.array(*[F.lit(t) for t in specific]), lambda t: F.contains(name, t)), 10).otherwise(0)
    score = score + F.when(words >= 3, 10).otherwise(0) - F.when(F.length(col) > 80, 5).otherwise(0)
    return F.when(col.isNull() | (col == ""), 0).otherwise(F.greatest(F.lit(0), F.least(F.lit(100), score)))


def one_digit(x: Column) -> Column:
    """A number from 0 up with one digit, rounded by the exact value of the double, as C and Python print it.

    Java rounds the shortest decimal: 25.95 is stored as a little less, and is 26.0 there instead of 25.9.
    """
    # 20 x = 16 x + 4 x: both terms are exact, and so are their sum and what it lost
    a, b = 16 * x, 4 * x
    whole = a + b
    lost = b - (whole - a)
    tenths = F.floor(whole / 2)
    rest = (whole - 2 * tenths) - 1
    up = (rest > 0) | ((rest == 0) & ((lost > 0) | ((lost == 0) & (tenths % 2 == 1))))
    tenths = tenths + F.when(up, 1).otherwise(0)
    return F.concat((F.floor(tenths / 10)).cast("string"), F.lit("."), (tenths % 10).cast("string"))


def duration_text(seconds: Column, unit: str | None = None) -> Column:
    """Seconds, minutes or hours with one digit; the unit follows the size unless it is given."""
    shown = {u: F.concat(one_digit(seconds / k), F.lit(u)) for u, k in (("s", 1), ("m", 60), ("h", 3600))}
    return shown[unit] if unit else F.when(seconds < 60, shown["s"]).when(seconds < 3600, shown["m"]).otherwise(shown["h"])


def clean_model_json(col: Column) -> Column:
    """A model's answer without its thinking and its code fence."""
    text = F.regexp_replace(col, r"(?s)<think>.*?</think>", "")
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(text), r"(?s)^```(?:json)?\s*", ""), r"(?s)\s*```$", ""))


def _ratio(a: str, b: str) -> float:
    """1 - (insertions and deletions) / (both lengths): twice the longest common subsequence over both lengths."""
    if not a and not b:
        return 1.0
    # one bit a character of a; a cleared bit is a step of the longest common subsequence
    at: dict[str, int] = {}
    for i, x in enumerate(a):
        at[x] = at.get(x, 0) | 1 << i
    left = whole = (1 << len(a)) - 1
    for x in b:
        hit = left & at.get(x, 0)
        left = ((left + hit) | (left - hit)) & whole
    return 2 * (len(a) - left.bit_count()) / (len(a) + len(b))


@F.pandas_udf(DoubleType())
def indel_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Edit ratio with substitutions as two edits, which no built-in has."""
    return pd.Series([None if x is None or y is None else _ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def sort_tokens(col: Column) -> Column:
    return F.array_join(F.array_sort(F.split(squeeze(F.lower(col)), " ")), " ")


def token_sort_ratio(a: Column, b: Column) -> Column:
    return indel_ratio(sort_tokens(a), sort_tokens(b))


def _repaired(text: str | None) -> str | None:
    """As it is, then cut to the outermost brackets, then with trailing commas gone and quotes doubled."""
    if text is None:
        return None
    outer = re.search(r"(?s)[\[{].*[\]}]", text)
    body = outer[0] if outer else text
    no_commas = re.sub(r",\s*([\]}])", r"\1", body)
    for attempt in (text, body, no_commas, no_commas.replace("'", '"')):
        try:
            return json.dumps(json.loads(attempt))
        except ValueError:
            continue
    return None


@F.pandas_udf(StringType())
def repair_json(text: pd.Series) -> pd.Series:
    """The first reading that parses, as JSON text; null where none does."""
    return text.map(_repaired)
