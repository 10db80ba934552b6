"""Documents in parts hold what one file would."""

import json

import pytest
from pyspark.sql import functions as F

from evigraph.sources import documents as dc
from evigraph.sources import sinks


def test_parts_make_the_document_of_one_file(spark, tmp_path):
    df = spark.range(57).select("id", F.concat(F.lit('a,\n"'), F.col("id").cast("string"), F.lit(" é")).alias("name")).repartition(5)
    assert dc.write_parts(df, f"{tmp_path}/d", ["id"], rows_a_part=10) == 1
    manifest = json.loads((tmp_path / "d" / "manifest-000001").read_text())
    assert len(manifest["parts"]) > 3 and manifest["rows"] == 57
    size = dc.export_document(spark, f"{tmp_path}/d", f"{tmp_path}/one.json")
    sinks.write_json_document(df, f"{tmp_path}/whole.json", ["id"])
    one = (tmp_path / "one.json").read_bytes()
    assert one == (tmp_path / "whole.json").read_bytes() and len(one) == size
    assert sorted(tuple(r) for r in dc.read_parts(spark, f"{tmp_path}/d", "id bigint, name string").collect()) == sorted(tuple(r) for r in df.collect())


def test_versions(spark, tmp_path):
    at = f"{tmp_path}/d"
    with pytest.raises(FileNotFoundError):
        dc.read_parts(spark, at, "id bigint")
    for n in (3, 0, 5):
        dc.write_parts(spark.range(n), at, ["id"])
    assert dc.versions(spark, at) == [1, 2, 3]
    assert [dc.read_parts(spark, at, "id bigint", v).count() for v in (1, 2, 3)] == [3, 0, 5]
    assert dc.export_document(spark, at, f"{tmp_path}/none.json", 2) == 3 and (tmp_path / "none.json").read_text() == "[]\n"
    dc.prune(spark, at, keep=1)
    assert dc.versions(spark, at) == [3] and dc.read_parts(spark, at, "id bigint").count() == 5
