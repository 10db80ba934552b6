"""Where the plan modules put their queries."""

from __future__ import annotations

from collections.abc import Callable
from inspect import signature

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_code
from ..sources.tables import edges

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

EDGES = """
edges AS (
  SELECT l_orderkey || '-' || l_linenumber AS study_id, l_orderkey AS paper_id, s_name AS source, p_brand AS target, p_type AS mechanism,
         CASE WHEN l_returnflag = 'A' THEN 'improves' WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'worsens'
              WHEN l_returnflag = 'R' THEN 'no_effect' WHEN l_quantity < 5 THEN 'inconclusive' ELSE 'improves' END AS outcome,
         CAST(0.5 AS DOUBLE) + 5 * l_discount AS confidence, l_quantity AS sample_size, year(l_shipdate) AS year, month(l_shipdate) AS month, o_orderpriority AS study_design,
         CASE WHEN l_returnflag = 'A' THEN 1.0 WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN -1.0
              WHEN l_returnflag = 'R' THEN 0.0 WHEN l_quantity < 5 THEN 0.3 ELSE 1.0 END::DOUBLE AS weight
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey)"""
SPARSE = EDGES + ",\nsparse AS (SELECT * FROM edges WHERE year = 1998 AND month <= 3)"
#: Stands for SPARSE in the SQL of a query's whole form.
WHOLE = EDGES + ",\nsparse AS (SELECT * FROM edges)"
PAPERS = """
papers AS (
  SELECT o_orderkey AS pmid, 'Study of customer ' || o_custkey AS title, CASE WHEN o_orderkey % 11 <> 0 THEN 'Abstract ' || o_orderpriority END AS abstract, o_orderpriority AS journal,
         strftime(o_orderdate, '%Y-%m-%d') AS publication_date,
         CASE o_orderstatus WHEN 'F' THEN 'processed' WHEN 'O' THEN 'pending' ELSE 'failed' END AS processing_status,
         CASE WHEN o_custkey % 7 <> 0 THEN o_totalprice / 1000 END AS influence_score, CAST(o_custkey % 100 AS INT) AS citation_count,
         o_custkey % 3 = 0 AS has_fulltext, CASE WHEN o_custkey % 3 = 0 THEN CASE WHEN o_custkey % 2 = 0 THEN 'pmc' ELSE 'unpaywall' END END AS fulltext_source,
         CASE WHEN o_custkey % 4 <> 0 THEN '10.1000/' || o_orderkey END AS doi
  FROM orders)"""
CANONICAL = """
canonical AS (
  SELECT s_name AS entity_name, 'intervention' AS entity_type, n_name AS canonical_name, r_name AS category
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  UNION ALL
  SELECT DISTINCT p_brand, 'condition', substr(p_brand, 1, 7), 'brand' FROM part)"""
CLUSTERS = """
clusters AS (SELECT vec_id AS member, label AS cluster_id, CAST(embedding AS DOUBLE[]) AS vector FROM embeddings)"""


def r6(col: Column | str) -> Column:
    """Six digits, with ties moved off the border by the same small amount as in the SQL: sums in another order give the same."""
    return F.round((F.col(col) if isinstance(col, str) else col) + 1e-9, 6)


def steady(sql: str) -> str:
    """The SQL with every ``round(x, 6)`` as ``round(x + 1e-9, 6)``."""
    out, at = "", 0
    while (start := sql.find("round(", at)) >= 0:
        depth, k = 1, start + 6
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = steady(sql[start + 6 : k - 1])
        out += sql[at:start] + "round(" + (f"({inner[:-3]}) + 1e-9, 6" if inner.endswith(", 6") else inner) + ")"
        at = k
    return out + sql[at:]


def query(name: str, sql: str | None = None, views: tuple[str, ...] = (), whole: bool = True) -> Callable[[Query], Query]:
    """Register a query; ``sql`` may use the views named.

    A query that takes its edges from a parameter ``sparse`` runs over all edges, and so does its SQL,
    unless ``whole`` is off: where untested pairs are the feature, of which all edges leave none.
    """

    def add(f: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries are named {name}")
        run, text, seen = f, sql, views
        if whole and "sparse" in signature(f).parameters:
            run, text, seen = (lambda spark, d: f(spark, d, sparse=edges)), sql and sql.replace(SPARSE, WHOLE), tuple(WHOLE if v is SPARSE else v for v in views)

        def shipped(spark: SparkSession, d: str) -> DataFrame:
            ship_code(spark)
            return run(spark, d)

        QUERIES[name] = shipped
        if text is not None:
            ORACLES[name] = steady(("WITH RECURSIVE " + ",".join(seen) + "\n" if seen else "") + text)
        return f

    return add
