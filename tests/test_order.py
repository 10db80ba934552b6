"""Means that lie on a bar have the last digits of their sum in the table's order, as the SQL has on one thread."""

import datetime
import random

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from test_oracles import ORACLES, QUERIES, plain


def _lines():
    """Suppliers 1 to 200 have a score of 0.3 and a confidence of 0.75 on Brand#11, the others a link of 0.35 from it and one to Brand#12."""
    rng, lines = random.Random(7), []
    for supplier in range(1, 401):
        if supplier <= 200:
            lines += [(supplier, 1, "A", "F", d) for d in [0.02, 0.08] * 4] + [(supplier, 1, "R", "O", d) for d in [0.02, 0.08] * 3 + [0.05]]
        else:
            lines += [(supplier, 1, "R", "F", d) for d in [0.01, 0.07, 0.03, 0.05] * 3] + [(supplier, 2, "A", "F", d) for d in [0.01, 0.08, 0.09]]
    rng.shuffle(lines)
    return [(rng.randrange(10**6), k, *x) for k, x in enumerate(lines)]


@pytest.fixture(scope="module", params=[1, 3])
def folder(request, tmp_path_factory):
    at = tmp_path_factory.mktemp("order")
    lines = _lines()
    supplier, part, flag, status, discount = (list(c) for c in list(zip(*lines, strict=True))[2:])
    table = pa.table({
        "l_orderkey": [x[0] for x in lines], "l_linenumber": [x[1] for x in lines], "l_suppkey": supplier, "l_partkey": part, "l_returnflag": flag, "l_linestatus": status, "l_discount": discount,
        "l_quantity": [10.0] * len(lines), "l_shipdate": pa.array([datetime.datetime(1998, 2, 1)] * len(lines), pa.timestamp("us")),
    })
    (at / "lineitem.parquet").mkdir()
    step = -(-len(lines) // request.param)
    for k in range(request.param):
        pq.write_table(table.slice(k * step, step), at / "lineitem.parquet" / f"part-{k}.parquet")
    for name, columns in {
        "supplier": {"s_suppkey": list(range(1, 401)), "s_name": [f"Supplier#{k:09d}" for k in range(1, 401)]},
        "part": {"p_partkey": [1, 2], "p_brand": ["Brand#11", "Brand#12"], "p_type": ["PROMO", "ECONOMY"]},
        "orders": {"o_orderkey": sorted({x[0] for x in lines}), "o_orderpriority": ["LOW"] * len({x[0] for x in lines})},
    }.items():
        pq.write_table(pa.table(columns), at / f"{name}.parquet")
    return str(at)


@pytest.mark.parametrize("name", ["a11_pair_evidence", "f13_tiers", "g10_simple_paths", "g3_treatments_for_condition"])
def test_bars_meet_the_digits_of_the_tables_order(spark, folder, name):
    con = duckdb.connect(config={"threads": 1})
    for table in ("supplier", "part", "orders"):
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    con.sql(f"CREATE VIEW lineitem AS SELECT * FROM '{folder}/lineitem.parquet/*.parquet'")
    want, got = con.sql(ORACLES[name]), QUERIES[name](spark, folder)
    columns = sorted(got.columns)
    at = [want.columns.index(c) for c in columns]
    rows = sorted(repr([plain(r[i]) for i in at]) for r in want.fetchall())
    assert rows and sorted(repr([plain(r[c]) for c in columns]) for r in got.collect()) == rows
