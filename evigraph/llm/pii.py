"""Personal data: pattern spans, and information-theoretic sanitisation of terms that reveal them.

The patterns find e-mail addresses, IPv4 addresses, card numbers and phone numbers; each
distinct value is a protected entity. Over the whole corpus the co-occurrence of terms
with entities is counted: in how many documents a term stands within ``WINDOW`` words of
an entity, and in how many the term and the entity occur at all. With N documents, an
entity e carries log2(N / df(e)) bits, and a term t discloses log2(N p / df(e)) of them,
where p is how likely e is near t: co(t, e) / df(t) if they meet in ``support`` different
contexts or more. A pair with c < ``support`` contexts takes part with a smoothed estimate:
copies of one context count once, and the contexts that are missing count as occurrences
of t without e, so p = c / (df(t) - co(t, e) + support). A term that discloses the share
``threshold`` or more of some entity is a span of kind ``term`` wherever it occurs.

Defined results: a null text is empty and has no spans; spans of different kinds may
overlap and are all reported; repeated rows are reported each and count as documents;
an entity in every document carries no bits and nothing discloses it; an empty table gives no
rows, and a very long text is worked on alone; a result column whose name a kept column has gets
an underscore after it.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop_tables, free, persist_table, runs, ship, text_or_empty
from .words import ALNUM, borders, hashes, lowered

KINDS = ("email", "ip", "card", "phone", "term")
WINDOW = 8
#: Bits of the fixed-size filter of terms near entities: 1 MB, whatever the corpus.
FILTER_BITS = 1 << 23
#: Disclosing terms in one broadcast block (8 bytes each); more terms make more blocks.
BLOCK_TERMS = 500_000
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_STRIP = re.compile(r"[^0-9]")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """A match needs an at-sign with a local part just before it, so each at-sign is tried once."""
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            last = m.end()
        at = text.find("@", max(at + 1, last))


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Pattern spans by kind, then start; code points, end exclusive."""
    out = []
    if "@" in text:
        out += [("email", a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(digits := _STRIP.sub("", m[0])) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_STRIP.sub("", m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


def _value(kind: str, found: str) -> str:
    """The entity that a span names: its digits, or the address in lower case."""
    return f"{kind}:{_STRIP.sub('', found) if kind in ('card', 'phone') else found.lower()}"


#: A word that the border of a context may have cut.
_CUT_FIRST, _CUT_LAST = re.compile(r"\A[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+\Z")
_TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]{3,}")
_FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def word_hashes(words: list[str]) -> np.ndarray:
    raw, at = lowered([w.encode() for w in words])
    return hashes(raw, at[:-1], at[1:] - 1).view(np.int64)


def _contexts(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, str, list[str]]]:
    """For each span its entity, a digest of its context, and the terms of the context."""
    out = []
    for kind, a, b in spans:
        near = _CUT_FIRST.sub("", text[max(0, a - 40 * WINDOW - 1) : a]) if a > 40 * WINDOW else text[:a], text[b : b + 40 * WINDOW + 1]
        near = near[0].translate(_FOLD), (_CUT_LAST.sub("", near[1]) if b + 40 * WINDOW < len(text) else near[1]).translate(_FOLD)
        masked = [re.sub(r"\S*[@0-9]\S*", " ", x) for x in near]
        before, after = _TERM.findall(masked[0])[-WINDOW:], _TERM.findall(masked[1])[:WINDOW]
        terms = sorted(set(before + after))
        if terms:
            out.append((_value(kind, text[a:b]), " ".join([*before, "|", *after]), terms))
    return out


def disclosing_terms(docs: DataFrame, text_col: str = "text", threshold: float = 0.8, support: int = 3) -> DataFrame:
    """term (64-bit hash) and the share of an entity's information that it discloses, at most: a table in the shared folder."""
    spark = docs.sparkSession
    ship(spark)
    texts = docs.select(text_or_empty(text_col).alias("_text"))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entity, context, term = [], [], []
            for text in batch.column(0).to_pylist():
                spans = base_spans(text)
                if not spans:
                    continue
                seen = set()
                for e, c, terms in _contexts(text, spans):
                    for t, h in zip(terms, word_hashes(terms).tolist(), strict=True):
                        if (e, t) not in seen:  # a document counts once for a term and an entity
                            seen.add((e, t))
                            entity.append(e)
                            context.append(c)
                            term.append(h)
                for e in {_value(k, text[a:b]) for k, a, b in spans}:
                    entity.append(e)  # and once for the entity itself
                    context.append(None)
                    term.append(None)
            yield pa.RecordBatch.from_arrays([digests(entity), digests(context), pa.array(term, pa.int64())], ["entity", "context", "term"])

    def digests(values: list) -> pa.Array:
        return pa.array([None if v is None else int.from_bytes(hashlib.blake2b(v.encode(), digest_size=8).digest(), "little", signed=True) for v in values], pa.int64())

    rows = texts.mapInArrow(near, "entity bigint, context bigint, term bigint")
    # one row for each entity, term and context with its number of documents: summed map-side first
    met = persist_table(rows.groupBy("entity", "term", "context").agg(F.count("*").alias("n")), "met")
    entities = met.filter("term IS NULL").groupBy("entity").agg(F.sum("n").alias("df_e"))
    pairs = met.filter("term IS NOT NULL").groupBy("entity", "term").agg(F.sum("n").alias("co"), F.count("*").alias("contexts"))
    pairs = persist_table(pairs.join(entities, "entity"), "pairs")
    bits = pairs.select(F.pmod("term", F.lit(FILTER_BITS)).alias("b")).select(F.shiftright("b", 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(b & 63 AS int))").alias("bit"))
    words = np.zeros(FILTER_BITS // 64, np.int64)
    for word, bit in bits.groupBy("word").agg(F.bit_or("bit")).toLocalIterator():
        words[word] = bit
    shared = spark.sparkContext.broadcast(np.unpackbits(words.view(np.uint8), bitorder="little").view(bool) if words.any() else None)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = shared.value
        total = 0
        for batch in batches:
            total += batch.num_rows
            if wanted is None:
                continue
            for part in runs(batch):
                raw, begin = lowered([t.encode() for t in part.column(0).to_pylist()])
                start, end = borders(raw, ALNUM)
                long = end - start >= 3
                start, end = start[long], end[long]
                h = hashes(raw, start, end).view(np.int64)
                doc = np.searchsorted(begin, start, "right")
                kept = wanted[h % FILTER_BITS]
                pair = np.unique(np.stack([h[kept], doc[kept]]), axis=1)
                term, n = np.unique(pair[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(term, pa.int64()), pa.array(n, pa.int64())], ["term", "n"])
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([total], pa.int64())], ["term", "n"])

    df = texts.mapInArrow(frequencies, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("df_t"))
    df = persist_table(df, "frequencies")
    n = df.filter("term IS NULL").agg(F.sum("df_t")).first()[0] or 0
    likely = F.when(F.col("contexts") >= support, F.col("co") / F.col("df_t")).otherwise(F.col("contexts") / (F.col("df_t") - F.col("co") + support))
    bits_e, bits_t = F.log2(F.lit(float(n)) / F.col("df_e")), F.log2(F.lit(float(n)) * likely / F.col("df_e"))
    told = pairs.join(df.filter("term IS NOT NULL"), "term").withColumn("share", F.when(bits_e > 0, bits_t / bits_e).otherwise(0.0))
    terms = persist_table(told.filter(F.col("share") >= threshold).groupBy("term").agg(F.max("share").alias("share")), "terms")
    drop_tables(met, pairs, df)
    return terms


def term_spans(text: str, terms: np.ndarray) -> list[tuple[str, int, int]]:
    if not len(terms):
        return []
    folded = text.translate(_FOLD)  # as long as the text
    found = [m.span() for m in _TERM.finditer(folded)]
    if not found:
        return []
    h = word_hashes([folded[a:b] for a, b in found])
    hit = terms[np.minimum(np.searchsorted(terms, h), len(terms) - 1)] == h
    return [("term", *found[i]) for i in np.flatnonzero(hit)]


def with_terms(texts: list[str], shared: list) -> set[int]:
    """The texts in which a word of a block of terms occurs."""
    out: set[int] = set()
    if not any(len(s.value) for s in shared):
        return out
    raw, begin = lowered([t.encode() for t in texts])
    start, end = borders(raw, ALNUM)
    long = end - start >= 3
    start, end = start[long], end[long]
    h = hashes(raw, start, end).view(np.int64)
    for terms in (s.value for s in shared if len(s.value)):
        hit = terms[np.minimum(np.searchsorted(terms, h), len(terms) - 1)] == h
        out.update((np.searchsorted(begin, start[hit], "right") - 1).tolist())
    return out


def spell(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def sanitised(text: str, spans: list[tuple[str, int, int]]) -> str:
    """Merged spans give way to the name of the first one's kind; patterns are removed so, terms generalised."""
    out, last = [], 0
    for a, b, kind in sorted((a, b, KINDS.index(k)) for k, a, b in spans):
        if a >= last:
            out += [text[last:a], f"<{KINDS[kind].upper()}>"]
        last = max(last, b)
    return "".join([*out, text[last:]])


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, support: int = 3, keep: tuple[str, ...] = (), with_text: bool = False) -> DataFrame:
    """``id_col``, the columns of ``keep``, n_email, n_ip, n_card, n_phone, base (spans as text), base_sha256 and spans for every row.

    With ``with_text`` also ``sanitised``.
    """
    spark = docs.sparkSession
    terms = disclosing_terms(docs, text_col, threshold, support)
    blocks = -(-terms.count() // BLOCK_TERMS)
    shared = []
    for b in range(blocks):
        part = terms.filter(F.pmod(F.xxhash64("term"), F.lit(blocks)) == b).select("term")
        shared.append(spark.sparkContext.broadcast(np.array(sorted(r.term for r in part.toLocalIterator()), np.int64)))
    drop_tables(terms)

    kinds = dict(docs.dtypes)
    columns = list(dict.fromkeys([id_col, *keep]))
    kind = {f"n_{k}": "bigint" for k in KINDS[:4]} | {"base": "string", "base_sha256": "string", "spans": "string"} | ({"sanitised": "string"} if with_text else {})
    names = {c: free(c, columns) for c in kind}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in runs(batch):
                texts = part.column(0).to_pylist()
                base = [base_spans(t) for t in texts]
                told = with_terms(texts, shared)
                every = [b + (sorted(x for s in shared for x in term_spans(t, s.value)) if i in told else []) for i, (t, b) in enumerate(zip(texts, base, strict=True))]
                made = {f"n_{k}": pa.array([sum(s[0] == k for s in b) for b in base], pa.int64()) for k in KINDS[:4]}
                plain = [spell(b) for b in base]
                made["base"] = pa.array(plain, pa.string())
                made["base_sha256"] = pa.array([hashlib.sha256(x.encode()).hexdigest() for x in plain], pa.string())
                made["spans"] = pa.array([spell(x) for x in every], pa.string())
                if with_text:
                    made["sanitised"] = pa.array([sanitised(t, x) if x else t for t, x in zip(texts, every, strict=True)], pa.string())
                yield pa.RecordBatch.from_arrays([*part.columns[1:], *made.values()], [*columns, *(names[c] for c in made)])

    schema = ", ".join([f"`{c}` {kinds[c]}" for c in columns] + [f"`{names[c]}` {k}" for c, k in kind.items()])
    return docs.select(text_or_empty(text_col).alias(free("_text", columns)), *columns).mapInArrow(run, schema)
