"""Entity resolution: canonical names, grouping by normalised names, categories."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import indel_ratio, normalize_term, sort_tokens
from .numbering import numbered

#: Shortened forms of a name, on average, up to which names meet by these.
FORMS = 200


def best_mapping(terms: DataFrame, mappings: DataFrame) -> DataFrame:
    """Each term's mapping of greatest confidence, by name in a tie; null where there is none."""
    best = mappings.groupBy("term").agg(F.max_by("canonical_name", F.struct("confidence", "canonical_name")).alias("canonical_name"), F.max("confidence").alias("confidence"))
    return terms.join(best, "term", "left")


def find_or_create(terms: DataFrame, known: DataFrame) -> DataFrame:
    """Canonical ids by normalised name; unknown names get ids after the greatest, in order of name."""
    keyed = terms.select("term", normalize_term(F.col("term")).alias("k")).distinct()
    have = known.select(normalize_term(F.col("name")).alias("k"), "id").groupBy("k").agg(F.min("id").alias("id"))
    fresh = keyed.select("k").distinct().join(have, "k", "left_anti")
    top = known.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top"))
    made = numbered(fresh, ["k"]).crossJoin(F.broadcast(top)).select("k", (F.col("top") + F.col("n")).alias("id"))
    return keyed.join(have.union(made), "k").select("term", "id")


def group_names(names: DataFrame) -> DataFrame:
    """Names that are equal after folding form a group, whose canonical name is the most frequent spelling.

    Mappings of the canonical spelling itself have confidence 1.0, the others 0.9; rows are kept.
    """
    keyed = names.withColumn("k", F.lower(F.trim("name")))
    spelled = keyed.groupBy("k", "name").agg(F.count("*").alias("n"), F.max("confidence").alias("c"))
    pick = spelled.groupBy("k").agg(F.min_by("name", F.struct(-F.col("n"), -F.col("c"), F.col("name"))).alias("canonical_name"), F.sum("n").alias("members"), F.avg("c").alias("mean"))
    out = keyed.join(pick, "k")
    same = F.col("name") == F.col("canonical_name")
    return out.withColumns({"mapping_confidence": F.when(same, 1.0).otherwise(0.9), "consensus": F.least(F.lit(0.98), F.col("mean") + 0.1)}).drop("k", "mean")


def shortened(lengths: list[int], least: float) -> dict[int, list[int]]:
    """For each of the lengths how many characters to leave out, so that any two texts of an edit ratio of ``least`` have a shortened form in common.

    Twice the longest common subsequence over both lengths is the ratio, so two texts of m and n characters have one of ``least * (m + n) / 2``.
    """
    out: dict[int, set[int]] = {m: set() for m in lengths}
    for m in lengths:
        for n in lengths:
            common = max(0, math.ceil(least * (m + n) / 2 - 1e-9))
            if common <= min(m, n):
                out[m].add(m - common)
    return {m: sorted(x) for m, x in out.items()}


def _forms(text: Column, leave: Column, most: int) -> Column:
    """The text without as many of its characters as ``leave`` names, in all ways, up to ``most``."""
    one_less = lambda s: F.when(F.length(s) > 0, F.transform(F.sequence(F.lit(1), F.length(s)), lambda i: F.concat(F.substring(s, F.lit(1), i - 1), F.substring(s, i + 1, F.length(s))))).otherwise(F.array().cast("array<string>"))
    none, now, out = F.array().cast("array<string>"), F.array(text), []
    for k in range(most + 1):
        out.append(F.when(F.array_contains(leave, k), now).otherwise(none))
        now = F.when(F.array_max(leave) > k, F.array_distinct(F.flatten(F.transform(now, one_less)))).otherwise(none)
    return F.concat(*out)


def candidate_pairs(names: DataFrame, block_col: str, least: float = 0.6, forms: int = FORMS) -> DataFrame:
    """Pairs of names that may mean the same: compared inside blocks, by token-sorted edit ratio.

    A high ratio leaves few characters out, so names that have a shortened form in common are all that can reach it, and rows grow with
    these. Where a name has more than ``forms`` of them on average (low ratios, long names), all pairs of a block are compared.
    """
    known = names.select(F.col(block_col).alias("_block"), "name").distinct().filter("name IS NOT NULL AND _block IS NOT NULL").withColumn("_text", sort_tokens(F.col("name")))
    sizes = {n: k for n, k in known.groupBy(F.length("_text").alias("n")).count().collect()}  # one row a length
    leave = shortened(list(sizes), least)
    each = sum(k * sum(math.comb(n, x) for x in leave[n]) for n, k in sizes.items())
    sides = [known.select("_block", F.col("name").alias(x), F.col("_text").alias(f"_{x}")) for x in "ab"]
    if each <= forms * sum(sizes.values()):
        counts = F.create_map(*[c for n, x in leave.items() for c in (F.lit(n), F.array(*map(F.lit, x)).cast("array<int>"))]) if leave else F.lit(None).cast("map<int,array<int>>")
        most = max((x[-1] for x in leave.values() if x), default=0)
        a, b = (side.withColumn("_form", F.explode(_forms(F.col(f"_{x}"), F.element_at(counts, F.length(f"_{x}")), most))) for x, side in zip("ab", sides, strict=True))
        met = a.join(b, ["_block", "_form"]).filter("a < b").select("_block", "a", "b", "_a", "_b").distinct()
    else:
        met = sides[0].join(sides[1], "_block").filter("a < b")
    pairs = met.select(F.col("_block").alias(block_col), "a", "b", indel_ratio(F.col("_a"), F.col("_b")).alias("similarity"))
    return pairs.filter(F.col("similarity") >= least)


def categories_of(mapping: DataFrame) -> DataFrame:
    """For each entity its categories by type, and the primary one: by confidence, then by name."""
    by_type = mapping.groupBy("entity", "category_type").agg(F.array_sort(F.collect_set("category_name")).alias("names")).groupBy("entity").agg(F.map_from_entries(F.collect_list(F.struct("category_type", "names"))).alias("categories"))
    primary = mapping.groupBy("entity").agg(F.min_by("category_name", F.struct(-F.col("confidence"), F.col("category_name"))).alias("primary"))
    return by_type.join(primary, "entity")
