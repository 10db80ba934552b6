"""Quality by an interpolated modified Kneser-Ney model of trusted text.

The model is of order ``ORDER`` over UTF-16 code units, one for each language, so a gram
packs into a long: its context is a shift, its suffix a mask. Text is cut into chunks of
bounded size; each gives its distinct grams with their counts in trusted text. Counts,
continuation counts, discounts and probabilities are joins and sums of gram tables, sharded
by gram; what is gathered (the grams of every chunk) grows with the corpus and nothing is
cut off. The table of probabilities, where counted to have at most ``BROADCAST_GRAMS`` rows,
is broadcast and documents are scored in place; a larger one is joined with the grams of each
chunk, and each chunk of packed documents gets back those that it needs.
A document is kept when its perplexity is not over its language's threshold. With labelled
documents that the model was not trained on, that is the quantile of the good ones at which the
share of bad ones kept and that of good ones rejected have the least sum; for a language without
both kinds it is a fixed quantile of the perplexities of trusted documents of that language.

Defined results: a null or empty text has perplexity null and is kept; without trusted
text of a language its threshold is null and all its documents are kept; a null language
counts as the language ""; repeated rows are scored each and count each; an empty table gives no
rows, a very long text is scored as a whole. Of the input's columns only id, text and language are used.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import drop_tables, few, persist_table, runs, ship, text_or_empty

ORDER = 4
#: Code units of a chunk.
CHUNK = 6_000_000
#: Rows of the probability table that are broadcast at most (16 bytes each).
BROADCAST_GRAMS = 2_000_000
#: A unit that no gram was seen of shares the least probability with all others.
UNITS = 1 << 16
#: Perplexities are compared on a logarithmic scale with this many steps to a factor of e.
STEPS = 2000
_START = np.full(ORDER - 1, 2, np.uint16)


def grams(text: str) -> np.ndarray:
    """The packed gram that ends at each code unit of a text."""
    units = np.concatenate([_START, np.frombuffer(text.encode("utf-16-le"), np.uint16)]).astype(np.uint64)
    n = len(units) - ORDER + 1
    out = units[:n].copy()
    for k in range(1, ORDER):
        out = out << np.uint64(16) | units[k : k + n]
    return out.view(np.int64)


class _Tally:
    """Distinct grams of a language with their counts in trusted text."""

    def __init__(self):
        self.keys, self.counts, self.parts, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

    def add(self, own: np.ndarray, trusted: bool) -> None:
        self.parts.append((own, trusted))
        self.size += len(own)
        if self.size > 500_000:
            self.close()

    def close(self) -> None:
        for trusted in (True, False):
            own = [g for g, t in self.parts if t == trusted]
            if own:
                keys, n = np.unique(np.concatenate(own), return_counts=True)
                every = np.concatenate([self.keys, keys])
                counts = np.concatenate([self.counts, n if trusted else np.zeros(len(n), np.int64)])
                self.keys, place = np.unique(every, return_inverse=True)
                self.counts = np.bincount(place, counts, len(self.keys)).astype(np.int64)
        self.parts, self.size = [], 0


def _pack(rows: list[tuple]) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["row", "lang", "text"])
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _chunks(rows: DataFrame, pack: bool) -> DataFrame:
    """chunk, packed documents if asked for, and for each language distinct grams and trusted counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, k = TaskContext.get().partitionId(), 0
        held, size, tallies = [], 0, {}

        def close():
            for t in tallies.values():
                t.close()
            columns = [[(part << 32) + k] * (1 + len(tallies)), [_pack(held) if pack else None, *[None] * len(tallies)], [None, *tallies], [None, *(t.keys for t in tallies.values())], [None, *(t.counts for t in tallies.values())]]
            kinds = [pa.int64(), pa.binary(), pa.string(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["chunk", "packed", "lang", "grams", "counts"])

        for batch in batches:
            for part_rows in runs(batch, 3):
                for row, lang, trusted, text in zip(*(c.to_pylist() for c in part_rows.columns), strict=True):
                    own = grams(text)
                    tallies.setdefault(lang, _Tally()).add(own, trusted)
                    if pack:
                        held.append((row, lang, text))
                    size += len(own)
                    if size >= CHUNK:
                        yield close()
                        k += 1
                        held, size, tallies = [], 0, {}
        if tallies:
            yield close()

    return rows.select("row", "lang", "trusted", "text").mapInArrow(run, "chunk bigint, packed binary, lang string, grams array<bigint>, counts array<bigint>")


def probabilities(counts: DataFrame) -> DataFrame:
    """lang, key and p for every gram of ``counts`` (lang, key, c; c is 0 for grams not in trusted text)."""
    mask = [0, *((1 << 16 * k) - 1 for k in range(1, ORDER))]
    asked, seen = {ORDER: counts.select("lang", "key")}, {ORDER: counts.filter("c > 0").select("lang", "key", "c")}
    for k in range(ORDER - 1, 0, -1):
        suffix = F.col("key").bitwiseAND(F.lit(mask[k]).cast("bigint")).alias("key")
        asked[k] = persist_table(asked[k + 1].select("lang", suffix).distinct(), "asked")
        seen[k] = persist_table(seen[k + 1].groupBy("lang", suffix).agg(F.count("*").alias("c")), "continuations")
    lower = None
    for k in range(1, ORDER + 1):
        of = seen[k].groupBy("lang").agg(*[F.count_if(F.col("c") == i).cast("double").alias(f"r{i}") for i in (1, 2, 3, 4)])
        y = F.col("r1") / F.greatest(F.col("r1") + 2 * F.col("r2"), F.lit(1.0))
        cut = [F.when(F.col(f"r{i}") > 0, F.least(F.greatest(i - (i + 1) * y * F.col(f"r{i + 1}") / F.col(f"r{i}"), F.lit(0.05)), F.lit(i - 0.05))).otherwise(F.lit(0.5 * i)).alias(f"d{i}") for i in (1, 2, 3)]
        of = F.broadcast(of.select("lang", *cut))  # one row a language that the corpus names
        context = F.shiftrightunsigned("key", 16).alias("context")
        total = seen[k].groupBy("lang", context).agg(F.sum("c").alias("total"), *[F.count_if(F.col("c") == i).alias(f"k{i}") for i in (1, 2)], F.count_if(F.col("c") > 2).alias("k3"))
        total = total.join(of, "lang").withColumn("rest", (F.col("d1") * F.col("k1") + F.col("d2") * F.col("k2") + F.col("d3") * F.col("k3")) / F.col("total"))
        row = asked[k].join(seen[k], ["lang", "key"], "left").withColumns({"context": F.shiftrightunsigned("key", 16), "suffix": F.col("key").bitwiseAND(F.lit(mask[k - 1] if k > 1 else 0).cast("bigint"))})
        row = row.join(total, ["lang", "context"], "left")
        if k > 1:
            row = row.join(lower.select("lang", F.col("key").alias("suffix"), F.col("p").alias("p_lower")), ["lang", "suffix"])
        else:
            row = row.withColumn("p_lower", F.lit(1.0 / UNITS))
        own = F.when(F.col("c").isNull(), 0.0).when(F.col("c") == 1, 1 - F.col("d1")).when(F.col("c") == 2, 2 - F.col("d2")).otherwise(F.col("c") - F.col("d3"))
        p = F.when(F.col("total").isNull(), F.col("p_lower")).otherwise(own / F.col("total") + F.col("rest") * F.col("p_lower"))
        before, lower = lower, persist_table(row.select("lang", "key", p.alias("p")), "probabilities")
        drop_tables(*([before] if before else []))
    drop_tables(*(t for k in range(1, ORDER) for t in (asked[k], seen[k])))
    return lower


def _perplexities(rows: list[tuple[str, str]], tables: dict) -> tuple[list[int], list[float | None]]:
    """Units and perplexity of each (language, text); tables: for each language sorted grams and their logs."""
    sizes, out = [], []
    for lang, text in rows:
        own = grams(text)
        sizes.append(len(own))
        if len(own):
            at, log = tables[lang]
            keys, n = np.unique(own, return_counts=True) if len(own) > 2000 else (own, 1)
            out.append(float(np.exp(min(700.0, -float((log[np.searchsorted(at, keys)] * n).sum()) / len(own)))))
        else:
            out.append(None)
    return sizes, out


def _tables(known: pa.Table) -> dict:
    """For each language its sorted grams and the logarithms of their probabilities."""
    out = {}
    for lang in pc.unique(known.column("lang")).to_pylist():
        own = known.filter(pc.equal(known.column("lang"), lang))
        keys, logs = own.column("key").to_numpy(), np.log(own.column("p").to_numpy())
        order = np.argsort(keys)
        out[lang] = keys[order], logs[order]
    return out


def _score_chunk(key: tuple, packed: pa.Table, known: pa.Table) -> pa.Table:
    tables = _tables(known)
    ids, sizes, out = [], [], []
    for blob in packed.column("packed").to_pylist():
        for batch in pa.ipc.open_stream(blob):
            row, lang, text = (c.to_pylist() for c in batch.columns)
            n, found = _perplexities(list(zip(lang, text, strict=True)), tables)
            ids, sizes, out = ids + row, sizes + n, out + found
    return pa.table({"row": pa.array(ids, pa.string()), "n_units": pa.array(sizes, pa.int64()), "perplexity": pa.array(out, pa.float64())})


def score(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", broadcast_grams: int = BROADCAST_GRAMS) -> DataFrame:
    """``id_col``, ``lang_col``, n_units and perplexity for every row under the model of the trusted rows."""
    spark = docs.sparkSession
    ship(spark)
    kinds = dict(docs.dtypes)
    marks = trusted.select(F.col(id_col).alias("_id")).filter("_id IS NOT NULL").distinct().withColumn("trusted", F.lit(True))
    named = F.to_json(F.struct(F.col(id_col).cast("string").alias("i"), F.col(lang_col).alias("l")))
    rows = docs.select(F.col(id_col).alias("_id"), named.alias("row"), F.coalesce(F.col(lang_col), F.lit("")).alias("lang"), text_or_empty(text_col).alias("text"))
    marked = rows.join(few(marks), "_id", "left").withColumn("trusted", F.coalesce("trusted", F.lit(False)))

    def grams_of(chunks: DataFrame) -> DataFrame:
        own = chunks.filter("grams IS NOT NULL").select("chunk", "lang", F.explode(F.arrays_zip("grams", "counts")).alias("g"))
        return own.select("chunk", "lang", F.col("g.grams").alias("key"), F.col("g.counts").alias("c"))

    counts = persist_table(grams_of(_chunks(marked, False)).groupBy("lang", "key").agg(F.sum("c").alias("c")), "grams")
    p = probabilities(counts)
    drop_tables(counts)
    if p.count() <= broadcast_grams:
        shared = spark.sparkContext.broadcast(_tables(p.toArrow()))
        drop_tables(p)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in runs(batch, 1):
                    n, found = _perplexities(list(zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True)), shared.value)
                    yield pa.RecordBatch.from_arrays([*part.columns[2:], pa.array(n, pa.int64()), pa.array(found, pa.float64())], [*part.schema.names[2:], "n_units", "perplexity"])

        source = docs.select(F.coalesce(F.col(lang_col), F.lit("")).alias("_lang"), text_or_empty(text_col).alias("_text"), id_col, lang_col)
        return source.mapInArrow(run, f"`{id_col}` {kinds[id_col]}, `{lang_col}` {kinds[lang_col]}, n_units bigint, perplexity double")
    chunks = persist_table(_chunks(rows.withColumn("trusted", F.lit(False)), True), "chunks")
    told = grams_of(chunks).select(F.col("chunk").alias("part"), "lang", "key").join(p, ["lang", "key"])
    scored = chunks.filter("packed IS NOT NULL").select("chunk", "packed").groupBy("chunk").cogroup(told.groupBy("part")).applyInArrow(_score_chunk, "row string, n_units bigint, perplexity double")
    parsed = F.from_json("row", f"i string, l {kinds[lang_col]}")
    return scored.withColumn("r", parsed).select(F.col("r.i").cast(kinds[id_col]).alias(id_col), F.col("r.l").alias(lang_col), "n_units", "perplexity")


def least_errors(scored: DataFrame, labelled: DataFrame, id_col: str, lang_col: str) -> DataFrame:
    """_l, the threshold ``chosen``, quantile (of good texts), recall (of bad ones) for each language with labelled texts of both kinds."""
    marks = labelled.groupBy(F.col(id_col).alias("_id")).agg(F.min("quality").alias("quality"))  # bad where labels differ
    seen = scored.filter("perplexity IS NOT NULL").join(few(marks), F.col(id_col) == F.col("_id"))
    bars = seen.groupBy(F.coalesce(lang_col, F.lit("")).alias("_l"), F.ceil(F.log("perplexity") * STEPS).cast("bigint").alias("step"))
    bars = bars.agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad"))
    every = Window.partitionBy("_l")
    upto = {c: F.sum(c).over(every.orderBy("step")) / F.sum(c).over(every) for c in ("good", "bad")}
    rates = bars.withColumns({f"all_{c}": F.sum(c).over(every) for c in ("good", "bad")}).filter("all_good > 0 AND all_bad > 0").withColumns({f"kept_{c}": upto[c] for c in ("good", "bad")})
    best = F.struct((1 - F.col("kept_good") + F.col("kept_bad")).alias("errors"), (-F.col("step")).alias("step"), F.col("kept_good").alias("quantile"), (1 - F.col("kept_bad")).alias("recall"))
    best = rates.groupBy("_l").agg(F.min(best).alias("b"))  # of equal sums the highest threshold
    return best.select("_l", F.exp(-F.col("b.step") / STEPS).alias("chosen"), "b.quantile", "b.recall")


def judge(docs: DataFrame, trusted: DataFrame, quantile: float = 0.999, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", broadcast_grams: int = BROADCAST_GRAMS, labelled: DataFrame | None = None) -> DataFrame:
    """``id_col``, ``lang_col``, n_units, perplexity, threshold and keep for every row. ``trusted`` has the ids of trusted text.

    ``labelled`` has ids and quality (1 or 0) of texts outside ``trusted``, which set the thresholds.
    """
    scored = persist_table(score(docs, trusted, id_col, text_col, lang_col, broadcast_grams), "scored")
    known = scored.join(trusted.select(id_col).distinct(), id_col, "left_semi").filter("perplexity IS NOT NULL")
    # the quantile from a histogram: one row a language and step
    step = F.ceil(F.log("perplexity") * STEPS).cast("bigint")
    bars = known.groupBy(F.coalesce(lang_col, F.lit("")).alias("_l"), step.alias("step")).agg(F.count("*").alias("n"))
    up = Window.partitionBy("_l").orderBy("step")
    bars = bars.withColumns({"upto": F.sum("n").over(up), "all": F.sum("n").over(Window.partitionBy("_l"))}).filter(F.col("upto") >= F.col("all") * quantile)
    limit = bars.groupBy("_l").agg((F.exp(F.min("step") / STEPS)).alias("threshold"))
    if labelled is not None:
        limit = limit.join(least_errors(scored, labelled, id_col, lang_col), "_l", "full").select("_l", F.coalesce("chosen", "threshold").alias("threshold"))
    out = scored.join(F.broadcast(limit), F.coalesce(F.col(lang_col), F.lit("")) == F.col("_l"), "left")  # one row a language
    keep = F.col("perplexity").isNull() | F.col("threshold").isNull() | (F.col("perplexity") <= F.col("threshold"))
    return out.select(id_col, lang_col, "n_units", "perplexity", "threshold", keep.alias("keep"))
