"""Non-negative factors of a matrix in long form, by multiplicative updates on tables.

The matrix is given by its tested cells (row, col, v); a cell without a row is 0. All cells are shifted to be positive, which a
constant expresses: products with it need only the factors' sums. So a round joins the tested cells with one factor, sums by the
other side, and divides by the factor's Gram matrix, which has ``parts`` squared numbers. Factors are tables of
one array a name; neither they nor the matrix ever lie in one task or on the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import cut_lineage, drop_table

#: Added to denominators.
TINY = 1e-12


def start(names: DataFrame, parts: int, seed: int) -> DataFrame:
    """name and f, an array of ``parts`` numbers from 0.1 to 1.1 by a hash of the name."""
    draw = lambda k: F.pmod(F.xxhash64("name", F.lit(k), F.lit(seed)), F.lit(1 << 20)) / float(1 << 20) + 0.1
    return names.select("name", F.array(*[draw(k) for k in range(parts)]).alias("f"))


def _summary(factor: DataFrame, parts: int) -> DataFrame:
    """One row: sums (an array), and gram (an array of rows)."""
    f = F.col("f")
    cells = {(k, m): F.sum(f[k] * f[m]) for k in range(parts) for m in range(k, parts)}
    gram = F.array(*[F.array(*[cells[min(k, m), max(k, m)] for m in range(parts)]) for k in range(parts)])
    return factor.agg(F.array(*[F.sum(f[k]) for k in range(parts)]).alias("sums"), gram.alias("gram"))


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _updated(factor: DataFrame, other: DataFrame, cells: DataFrame, own: str, theirs: str, shift: float, parts: int) -> DataFrame:
    """The factor times (other' X) / (other' other factor)."""
    met = cells.join(other.select(F.col("name").alias(theirs), F.col("f").alias("g")), theirs)
    told = met.groupBy(F.col(own).alias("name")).agg(F.array(*[F.sum(F.col("v") * F.col("g")[k]) for k in range(parts)]).alias("told"))
    row = F.broadcast(_summary(other, parts))  # one row
    rows = factor.join(told, "name", "left").crossJoin(row)
    zero = F.array(*[F.lit(0.0)] * parts)
    above = F.zip_with(F.coalesce("told", zero), "sums", lambda x, s: x + shift * s)
    below = F.transform("gram", lambda g: _dot(g, F.col("f")) + TINY)
    scaled = F.zip_with(F.zip_with("f", above, lambda x, a: x * a), below, lambda x, b: x / b)
    return cut_lineage(rows.select("name", scaled.alias("f")), "factor")


def shift_of(cells: DataFrame) -> float:
    least = cells.agg(F.min("v").alias("v")).first().v
    return 0.01 - min(0.0, least if least is not None else 0.0)


def objective(cells: DataFrame, w: DataFrame, h: DataFrame, parts: int, shift: float) -> float:
    """The squared error over all cells: those tested by their rows, the others by the factors' sums and Gram matrices."""
    of = cells.join(w.select(F.col("name").alias("row"), F.col("f").alias("w")), "row").join(h.select(F.col("name").alias("col"), F.col("f").alias("h")), "col")
    guess, v = _dot(F.col("w"), F.col("h")), F.col("v")
    # (v + c - g)^2 over tested cells is (c - g)^2 over all cells and v^2 + 2 v (c - g) over the tested ones
    tested = of.agg(F.coalesce(F.sum(v * v + 2 * v * (shift - guess)), F.lit(0.0)).alias("x")).first().x
    a, b = (_summary(f, parts).first() for f in (w, h))
    n = w.count() * h.count()
    plain = sum(x * y for x, y in zip(a.sums, b.sums, strict=True))
    square = sum(a.gram[k][m] * b.gram[k][m] for k in range(parts) for m in range(parts))
    return tested + shift * shift * n - 2 * shift * plain + square


def factorise(cells: DataFrame, parts: int = 10, rounds: int = 500, seed: int = 42, tolerance: float = 1e-4, every: int = 10) -> tuple[DataFrame, DataFrame]:
    """Factors of the rows and of the columns (name, f) after ``rounds``, or fewer when ``every`` that many the root of the error falls by less than ``tolerance`` of the first."""
    cells = cut_lineage(cells.select("row", "col", F.col("v").cast("double").alias("v")), "matrix")
    shift = shift_of(cells)
    w = cut_lineage(start(cells.select(F.col("row").alias("name")).distinct(), parts, seed), "factor")
    h = cut_lineage(start(cells.select(F.col("col").alias("name")).distinct(), parts, seed), "factor")
    first = last = max(objective(cells, w, h, parts, shift), 0.0) ** 0.5 if rounds >= every else 0.0
    for k in range(1, rounds + 1):
        old_w, old_h = w, h
        h = _updated(h, w, cells, "col", "row", shift, parts)
        w = _updated(w, h, cells, "row", "col", shift, parts)
        drop_table(old_w, old_h)
        if k % every == 0 and k < rounds:
            now = max(objective(cells, w, h, parts, shift), 0.0) ** 0.5
            if first == 0 or (last - now) / first < tolerance:
                break
            last = now
    drop_table(cells)
    return w, h
