"""Exact top-k inner products by an impact-ordered, score-at-a-time index.

Vectors are integers (scaled and floored components). A block of candidates is indexed as
posting segments: all components whose quantised impact (size of the component, in steps)
is equal, whatever their dimension. A block of queries takes the segments by descending
impact and adds their share to every candidate's score. What is left of a candidate is
bounded by the norms of its unprocessed components and of the query; once few candidates
can still reach the k-th best lower bound, which is the proof, those are rescored exactly.

Blocks of queries meet blocks of candidates, so no task holds more than one of each; each
meeting gives k rows a query, of which the best k stay.

Defined results: vectors that are null, or hold null or non-finite components, take no
part; shorter vectors count as padded with zeros; rows with the query's own id are no
candidates; a query row that repeats exactly is answered once; of candidates that repeat
exactly each counts; ties go to the smaller id; fewer candidates than k are all returned;
scores beyond a long are held to its range; an empty table gives no rows. Of the input's columns
only id and vector are used.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ship

CANDIDATE_BLOCK, QUERY_BLOCK = 8192, 4096
#: Impact levels; and the shares of the largest norm that may be left when a proof is tried.
STEPS, TRIALS = 8, (0.6, 0.3)


class ImpactIndex:
    """Posting segments of a block of integer vectors, by descending quantised impact.

    Segments between two trials of the proof are scored in one product.
    """

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        size = np.abs(vectors)
        self.largest = float(size.max(initial=0))
        level = np.minimum((size / max(1.0, self.largest / STEPS)).astype(np.int64), STEPS - 1)
        square = vectors**2
        self.norm = np.sqrt(square.sum(axis=1))
        most, trials = self.norm.max(initial=0), list(TRIALS)
        self.parts: list[tuple[int, np.ndarray, np.ndarray]] = []  # segments, their postings, and the norms of what is left after them
        top = STEPS
        for impact in range(STEPS - 1, -1, -1):
            left = np.sqrt((square * (level < impact)).sum(axis=1))
            worst = left.max(initial=0)
            if impact and (not trials or worst > trials[0] * most):
                continue
            while trials and worst <= trials[0] * most:
                trials.pop(0)
            self.parts.append((top - impact, vectors * ((level >= impact) & (level < top)), left))
            top = impact
        #: Segments that searches processed, of how many.
        self.processed, self.offered = 0, 0

    def search(self, queries: np.ndarray, k: int, own: np.ndarray) -> list[np.ndarray]:
        """For each query the candidates that can be among its best k; ``own`` marks pairs that may not meet."""
        # sums below 2^24 are exact in single precision
        small = self.vectors.shape[1] * self.largest * np.abs(queries).max(initial=0) < 2**24
        kind = np.float32 if small else np.float64
        n = len(self.vectors)
        score = np.zeros((len(queries), n), kind)
        norm = np.sqrt((queries**2).sum(axis=1))[:, None]
        few, asked = max(4 * k, n // 50), queries.astype(kind)
        runs = max(8 * k, n // 64)
        self.offered += STEPS
        for segments, postings, left in self.parts:
            self.processed += segments
            score += asked @ postings.astype(kind).T
            slack = norm * (left * (1 + 1e-9) + self.norm * 1e-12) + 1e-6  # what is left, and rounding of what is summed
            low = np.where(own, -np.inf, score - slack)
            if n > k:
                best = low
                if n > runs:  # the best of every runs-th candidate: k candidates reach the k-th of these
                    best = low[:, : n - n % runs].reshape(len(queries), -1, runs).max(axis=1)
                may = (score + slack >= np.partition(best, best.shape[1] - k, axis=1)[:, -k][:, None]) & ~own
            else:
                may = ~own
            if may.sum() <= few * len(queries):
                break
        return [np.flatnonzero(m) for m in may]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    column = column.combine_chunks()
    out = np.zeros((len(column), width))
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.values.slice(column.offsets[0].as_py(), int(sizes.sum())).to_numpy(zero_copy_only=False)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def _meet(group: pa.Table, k: int) -> pa.Table:
    widths = np.diff(group.column("v").combine_chunks().offsets.to_numpy())
    width = int(widths.max(initial=0))
    asks = group.column("asks").to_numpy()
    q, c = group.filter(pa.array(asks)), group.filter(pa.array(~asks))
    out: tuple[list, list, list, list] = ([], [], [], [])
    if len(q) and len(c):
        qv, cv = _matrix(q.column("v"), width), _matrix(c.column("v"), width)
        qi, ci = q.column("id").to_numpy(), c.column("id").to_numpy()
        marks = q.column("mark").to_pylist()
        exact = width * np.abs(qv).max(initial=0) * np.abs(cv).max(initial=0) < 2**53
        index = ImpactIndex(cv)
        for at in range(0, len(qi), 256):
            part = slice(at, at + 256)
            for n, rows in enumerate(index.search(qv[part], k, qi[part][:, None] == ci), at):
                if exact:
                    scores = (cv[rows] @ qv[n]).astype(np.int64)
                else:  # products beyond a double's integers
                    query = [int(x) for x in qv[n]]
                    true = [sum(int(x) * y for x, y in zip(cv[r], query, strict=True)) for r in rows]
                    scores = np.array([max(-(2**63), min(2**63 - 1, s)) for s in true], np.int64)
                best = np.lexsort((ci[rows], -scores.astype(object) if not exact else -scores))[:k]
                out[0].extend([int(qi[n])] * len(best))
                out[1].extend([marks[n]] * len(best))
                out[2].extend(ci[rows[best]].tolist())
                out[3].extend(scores[best].tolist())
    return pa.table({"query_id": pa.array(out[0], pa.int64()), "mark": pa.array(out[1], pa.int64()), "vec_id": pa.array(out[2], pa.int64()), "score": pa.array(out[3], pa.int64())})


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score: each query's k best candidates among all other rows."""
    ship(vectors.sparkSession)
    whole = vectors.withColumn("_q", is_query).select(F.col(id_col).cast("bigint").alias("id"), F.coalesce("_q", F.lit(False)).alias("_q"), F.transform(vector_col, lambda x: x.cast("double")).alias("_v"))
    whole = whole.filter(F.col("id").isNotNull() & F.col("_v").isNotNull() & F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    # floor as a double: ``floor`` gives a long, which large components overflow
    whole = whole.select("id", "_q", F.transform("_v", lambda x: F.when(F.abs(x) < 1e15, F.floor(x * scale).cast("double")).otherwise(x * scale)).alias("v"))
    counts = whole.agg(F.count("*").alias("n"), F.count_if("_q").alias("q")).first()
    candidate_blocks, query_blocks = -(-counts.n // CANDIDATE_BLOCK) or 1, -(-counts.q // QUERY_BLOCK) or 1
    mark = F.xxhash64("v")
    block = lambda n: F.pmod(F.xxhash64("id", mark, F.lit(3)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    queries = whole.filter("_q").select("id", "v", mark.alias("mark")).distinct().select(F.lit(True).alias("asks"), "id", "v", "mark", block(query_blocks).alias("qb"), every(candidate_blocks).alias("cb"))
    candidates = whole.select(F.lit(False).alias("asks"), "id", "v", mark.alias("mark"), F.pmod(F.xxhash64("id", mark, F.monotonically_increasing_id()), F.lit(candidate_blocks)).cast("int").alias("cb"), every(query_blocks).alias("qb"))
    met = queries.unionByName(candidates).groupBy("qb", "cb").applyInArrow(lambda t: _meet(t, k), "query_id bigint, mark bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id")
    return met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
