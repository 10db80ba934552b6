"""URL rules by a blocked Bloom filter and an exact hash join.

A rule is a host and a path prefix; it fits its host and all subdomains. A url's
possible keys are each suffix of its host (at label borders) with each prefix of its
path that has the length of some rule's path. The blocked Bloom filter of the rules'
canonical keys (one 64-bit block a key, ``BITS`` bits in it) drops most keys where the page is
read; a page without keys left is judged there. What is left, each distinct list of keys
once, goes to a hash join with the rules, which removes false positives. The longest fitting
rule wins; of equally long ones that with the longer host, then the greater text.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no
rule and gets the default verdict; repeated rows are all kept; no rules, no hits; no pages,
no rows; a very long url is judged as any other; columns of the input named ``_host``, ``_path``,
``_rule`` or ``_verdict`` give way to the results. All of it is DataFrame expressions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import few, free, persist_table

#: Bits that a key sets in its block, and keys that share a block on average.
BITS, KEYS_A_BLOCK = 6, 4
#: Beyond this many rules the join is made with a shuffled table.
BROADCAST_RULES = 200_000
#: 64-bit words of the filter at most (2 MB); of more rules it is fuller and lets more keys pass to the join.
MOST_BLOCKS = 1 << 18
#: Parts that pages without keys are dealt to where the last join is shuffled.
PARTS = 1024
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parse(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def _hash(key: Column) -> Column:
    return F.xxhash64(key)


def _block(h: Column, blocks: int) -> Column:
    return F.pmod(h, F.lit(blocks))


def _mask(h: Column) -> Column:
    """``BITS`` bits of a 64-bit word, from successive six-bit groups of a second hash."""
    again = F.xxhash64(h, F.lit(1))
    ones = [F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(again, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(BITS)]
    return reduce(lambda a, b: a.bitwiseOR(b), ones)


def build_filter(rules: DataFrame, n_rules: int) -> list[int]:
    """The filter's words. Its size follows the number of listed rules, not the pages: 2 bytes a rule, up to MOST_BLOCKS."""
    blocks = max(16, min(MOST_BLOCKS, n_rules // KEYS_A_BLOCK))
    hashed = rules.select(_hash(F.col("_key")).alias("h"))
    words = hashed.groupBy(_block(F.col("h"), blocks).alias("b")).agg(F.bit_or(_mask(F.col("h"))).alias("w"))
    out = [0] * blocks
    for b, w in words.collect():
        out[b] = w
    return out


def possible_keys(host: Column, path: Column, path_lengths: list[int]) -> Column:
    """Canonical keys (host suffix, then path prefix) that a rule could have."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    fitting = F.filter(F.array(*[F.lit(n) for n in path_lengths]), lambda n: n <= F.length(path))
    prefixes = F.transform(fitting, lambda n: F.substr(path, F.lit(1), n))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """Every row of ``pages`` with ``_host``, ``_path``, ``_rule`` (host and path, or null) and ``_verdict``.

    ``rules`` has host, path and verdict; a rule's path is empty or starts with a slash,
    so host and path never run into each other in a key. Of several equal rules the
    smallest verdict holds.
    """
    keyed = rules.select(F.translate(F.coalesce("host", F.lit("")), _UPPER, _LOWER).alias("_h"), F.coalesce("path", F.lit("")).alias("_p"), "verdict")
    keyed = keyed.groupBy(F.concat("_h", "_p").alias("_key")).agg(F.length(F.min("_h")).alias("_host_length"), F.length(F.min("_p")).alias("_path_length"), F.min("verdict").alias("_found"))
    facts = keyed.agg(F.count("*").alias("n"), F.collect_set("_path_length").alias("lengths")).first()
    host, path = parse(F.col(url_col))
    judged = pages.withColumns({"_host": host, "_path": path})
    if not facts.n:
        return judged.withColumns({"_rule": F.lit(None).cast("string"), "_verdict": F.lit(default)})
    words = build_filter(keyed, facts.n)
    bits = F.from_json(F.lit(str(words)), "array<bigint>")  # folded to one literal
    passes = lambda k: F.element_at(bits, (_block(_hash(k), len(words)) + 1).cast("int")).bitwiseAND(_mask(_hash(k))) == _mask(_hash(k))
    keys, part, row = (free(c, judged.columns) for c in ("_keys", "_part", "_best"))
    judged = judged.withColumn(keys, F.when(F.col("_host") != "", F.filter(possible_keys(F.col("_host"), F.col("_path"), sorted(facts.lengths)), passes)).otherwise(F.array().cast("array<string>")))
    asked = judged.filter(F.size(keys) > 0).select(F.col(keys).alias("keys")).distinct().withColumn("_key", F.explode("keys"))
    right = F.broadcast(keyed) if facts.n <= BROADCAST_RULES else keyed
    order = F.struct(F.length("_key"), "_host_length", F.col("_key"), "_found")
    best = asked.join(right, "_key").groupBy(F.col("keys").alias(keys)).agg(F.max(order).alias(row))
    best = persist_table(best.withColumn(part, F.lit(0)), "url-hits")
    # pages without keys meet nothing; where the join is shuffled they are spread
    judged = judged.withColumn(part, F.when(F.size(keys) > 0, 0).otherwise(1 + F.pmod(F.hash("_host", "_path"), F.lit(PARTS))))
    out = judged.join(few(best), [keys, part], "left")
    return out.withColumns({"_rule": F.col(f"{row}._key"), "_verdict": F.coalesce(F.col(f"{row}._found"), F.lit(default))}).drop(keys, part, row)
