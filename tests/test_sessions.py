"""Sessions that are killed after any step, and the content-addressed cache."""

import pytest
from pyspark.sql import functions as F

from evigraph.sources.content_cache import ContentCache, content_key
from evigraph.sources.sessions import Session


class Killed(Exception):
    pass


def test_a_session_killed_after_any_step_ends_with_the_same_table(spark, tmp_path):
    rows = spark.range(30).withColumn("batch", F.col("id") % 3)
    work = lambda df: df.withColumn("square", F.col("id") * F.col("id"))
    want = {(i, i * i) for i in range(30)}
    steps = ["begun"] + ["claimed", "written", "committed"] * 3
    for stop in (1, 2, 3, 4, 6):
        at, seen = str(tmp_path / f"s{stop}"), []

        def kill(step, seen=seen, stop=stop):
            seen.append(step)
            if len(seen) == stop:
                raise Killed

        first = Session(spark, at, holder="first")
        with pytest.raises(Killed):
            first.run(rows, "batch", work, kill)
        assert seen == steps[:stop]
        # the dead run's lease holds off another until it expires
        if seen[-1] in ("claimed", "written"):
            assert not Session(spark, at, holder="early").run(rows, "batch", work)
        later = Session(spark, at, holder="later", clock=lambda: first.clock() + 4000)
        assert later.run(rows, "batch", work)
        assert {tuple(r) for r in later.output().collect()} == want and later.output().count() == 30
        assert later.log().filter("record = 'done'").agg(F.sum("rows")).first()[0] == 30 and "ended" in later.records.names()
        assert later.run(rows, "batch", lambda df: pytest.fail("worked again"))


def test_claims_and_commits_are_exclusive(spark, tmp_path):
    a, b = (Session(spark, str(tmp_path), holder=h) for h in "ab")
    assert a.begin("x") and not b.begin("x")
    assert a.claim(1) and a.claim(1) and not b.claim(1) and b.claim(2)
    assert a.commit(1, "one", 5) and not b.commit(1, "two", 6) and not b.claim(1)
    assert a.done() == b.done() and a.done()[1]["attempt"] == "one"
    assert b.output is not None and Session(spark, str(tmp_path / "new")).output() is None


def test_cache_computes_each_content_once(spark, tmp_path):
    asked = []

    def compute(df):
        rows = df.collect()
        asked.append(sorted(r.text for r in rows))
        made = [(r.key, [1.0, float(len(r.text)), 3.0, 4.0]) for r in rows if "fail" not in r.text] + [(r.key, [float("nan")]) for r in rows if r.text == "fail nan"]
        return spark.createDataFrame(made, "key string, vector array<double>")

    texts = spark.createDataFrame([(1, "Green tea"), (2, "green  TEA"), (3, "fail"), (4, None), (5, "fail nan")], "id int, name string")
    cache = ContentCache(spark, str(tmp_path / "c"), "m", 3)
    got, n = cache.vectors(texts, "name", compute)
    found = {r.id: r.vector for r in got.collect()}
    assert n == 4 and found[1] == found[2] and found[1][2] == 3.0 and len(found[1]) == 3 and found[3] == found[5] == [0.0] * 3
    _, n = cache.vectors(texts.filter("id < 3"), "name", compute)
    assert n == 0 and len(asked) == 1
    _, n = cache.vectors(texts.union(spark.createDataFrame([(6, "kale")], texts.schema)), "name", compute)
    assert asked[1] == ["fail", "fail nan", "kale"] and n == 3
    assert ContentCache(spark, str(tmp_path / "c"), "m", 4).vectors(texts.limit(1), "name", compute)[1] == 1
    before = {(r.key, tuple(r.vector)) for r in cache.entries().collect()}
    cache.compact()
    assert len(cache.parts()) == 1 and {(r.key, tuple(r.vector)) for r in cache.entries().collect()} == before
    (tmp_path / "c" / "part-000009-dead").mkdir()
    assert len(cache.parts()) == 1
    assert texts.select(content_key(F.col("name"), "m", 3).alias("k")).distinct().count() == 4
