import random
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from evigraph.llm.common import persist_table

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
corpus_pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    """A small corpus with planted cases."""
    d = tmp_path_factory.mktemp("sf")
    rng = random.Random(0)
    vocab = [f"w{i}" for i in range(400)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    rows = [(i, text(60)) for i in range(300)]
    labels = [(i, 1, 0) for i in range(300)]
    for i in range(300, 420):
        rows.append((i, text(30) + " idiot " + text(20)))
        labels.append((i, 1, 1))
    passage = text(30)
    rows += [(500, rows[7][1]), (501, rows[7][1] + " extra"), (502, text(20) + " " + passage + " " + text(20)), (503, text(30) + " me@mail.example " + text(20)), (504, None), (505, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    return str(d), dict(rows), passage


def test_each_stage_takes_effect_and_keeps_the_rest(spark, made):
    d, rows, passage = made
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns = docs.columns
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, d)
        if k < 4:
            assert out.columns == columns
            path = f"{d}/out{k}"
            out.write.parquet(path)
            docs = spark.read.parquet(path)
            kept.append({r.doc_id: r.text for r in docs.collect()})
    toxic, near, clean, private = kept
    assert not {i for i in range(300, 420)} & set(toxic) and len(set(range(300)) & set(toxic)) == 300
    assert set(toxic) - set(near) == {500, 501} and near[7] == rows[7]
    assert set(clean) == set(near) and passage not in clean[502] and passage.split()[0] not in clean[502].split()[15:25] and clean[3] == rows[3]
    assert "me@mail.example" not in private[503] and "<EMAIL>" in private[503] and private[504] is None and private[5] == rows[5]
    tokens = {r.doc_id: r for r in corpus_pipeline.STAGES[4][1](spark, docs, d).collect()}
    assert set(tokens) == set(private) and tokens[505].n_tokens == 0 and len(tokens[5].ids) == tokens[5].n_tokens


def test_run_equals_the_stages(spark, made):
    assert {r.doc_id for r in corpus_pipeline.run(spark, made[0]).collect()} == set(range(300)) | {502, 503, 504, 505}


CLASHES = ["_text", "score", "score_", "n_words", "n_hit", "item_ids", "spans", "cleaned", "n_email", "base", "base_sha256", "sanitised", "id", "key", "component_id", "node", "rep", "_key", "_row", "COUNT", "term", "ids"]


def test_clashing_names_nulls_and_repeated_ids(spark, made):
    """Extra columns of any name stay as they are; rows of one id and other texts are documents of their own."""
    d, rows, _ = made
    docs = spark.read.parquet(f"{d}/documents.parquet").filter("doc_id < 40")
    more = [(7, "another text of the same id, unlike all others here", "en", "s", 3), (7, rows[7], "en", "s", 3), (9, rows[8], "fr", "t", 1), (None, None, None, None, None), (None, rows[8], None, None, None), (600, "", None, None, 0)]
    docs = docs.union(spark.createDataFrame(more, docs.schema)).withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in CLASHES})
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = persist_table(stage(spark, now, d), "clash")
        assert now.columns == docs.columns
        got = now.collect()
        assert all(r[c] is None if r.doc_id is None else r[c] == f"{c}{r.doc_id}" for r in got for c in CLASHES)
        if name == "near_duplicates":
            assert sorted((r.doc_id, r.text) for r in got if r.doc_id is not None) == sorted([*((i, rows[i]) for i in range(40)), (7, more[0][1]), (600, "")])
            assert sum(r.doc_id is None for r in got) == 2
        assert stage(spark, docs.limit(0), d).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, now, d).count() == now.count()


def test_stages_name_the_operators():
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
