"""The entry module works without the training-data part, or without a package that only that part needs."""

import importlib
import sys

import pytest

import __spark_entry__


@pytest.mark.parametrize("absent", ["evigraph.llm", "corpus_pipeline", "public_tokenizers", "regex", "numpy.absent"])
def test_core_queries_stay(absent, monkeypatch):
    for name in [n for n in sys.modules if n.startswith(("evigraph.llm", "corpus_pipeline"))]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, absent, None)
    try:
        entry = importlib.reload(__spark_entry__)
        queries, sql = entry.queries(), entry.oracle_sql()
        assert len([q for q in queries if not q.startswith(("op", "pipeline"))]) > 200 and set(sql) <= set(queries)
        if absent in ("evigraph.llm", "public_tokenizers"):
            assert not any(q.startswith("op") for q in queries) and "pipeline" not in queries
    finally:
        monkeypatch.undo()
        importlib.reload(__spark_entry__)
