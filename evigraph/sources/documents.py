"""JSON documents of any size: ordered parts and a manifest that says how they make one array.

Rows are sorted into ranges, each of which is a file of rows with a separator after each. The document is the manifest's head, its parts in
order without the last separator, and its tail. A manifest is made by exclusive creation when all parts are written, so readers
see one version whole, and the one before stays as a backup until ``prune``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .sessions import Records

SEPARATOR, HEAD, TAIL = ",\n", "[", "]\n"


def versions(spark: SparkSession, path: str) -> list[int]:
    return [int(n.split("-")[1]) for n in Records(spark, path).names() if n.startswith("manifest-")]


def write_parts(df: DataFrame, path: str, order: list[str], rows_a_part: int = 500_000) -> int:
    """Write a version of the document: rows as JSON objects in ``order``, about so many in a part. Its number."""
    spark, log = df.sparkSession, Records(df.sparkSession, path)
    folder = f"data-{uuid.uuid4().hex}"
    n = df.count()
    sorted_ = df.repartitionByRange(max(1, -(-n // rows_a_part)), *order).sortWithinPartitions(*order)
    sorted_.select(F.to_json(F.struct(*df.columns)).alias("value")).write.option("lineSep", SEPARATOR).text(f"{log.path}/{folder}")
    jvm = spark.sparkContext._jvm
    found = log._fs.listStatus(jvm.org.apache.hadoop.fs.Path(log._root, folder))
    # file names follow the order of ranges
    parts = sorted((s.getPath().getName(), s.getLen()) for s in found if s.getPath().getName().startswith("part-") and s.getLen())
    while True:
        version = max(versions(spark, path), default=0) + 1
        if log.create(f"manifest-{version:06d}", {"head": HEAD, "tail": TAIL, "separator": SEPARATOR, "rows": n, "parts": [{"name": f"{folder}/{name}", "bytes": size} for name, size in parts]}):
            return version


def read_parts(spark: SparkSession, path: str, shape: str, version: int | None = None) -> DataFrame:
    """The rows of a version, the newest if none is named; ``shape`` is their schema."""
    log = Records(spark, path)
    known = versions(spark, path)
    if not known:
        raise FileNotFoundError(f"no document at {path}")
    manifest = log.read(f"manifest-{version or max(known):06d}")
    if not manifest["parts"]:
        return spark.createDataFrame([], shape)
    lines = spark.read.option("lineSep", manifest["separator"]).text([f"{log.path}/{p['name']}" for p in manifest["parts"]])
    return lines.select(F.from_json("value", shape).alias("r")).select("r.*")


def export_document(spark: SparkSession, path: str, out: str, version: int | None = None) -> int:
    """Copy a version's bytes as a stream into one file for a reader that wants one; its size."""
    log = Records(spark, path)
    jvm = spark.sparkContext._jvm
    manifest = log.read(f"manifest-{version or max(versions(spark, path)):06d}")
    target = jvm.org.apache.hadoop.fs.Path(out)
    stream = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(target, False)
    left = sum(p["bytes"] for p in manifest["parts"]) - len(manifest["separator"]) * bool(manifest["parts"])
    total = left + len(manifest["head"]) + len(manifest["tail"])
    try:
        stream.write(bytearray(manifest["head"].encode()))
        for p in manifest["parts"]:
            size = min(left, p["bytes"])
            source = log._fs.open(log._at(p["name"]))
            try:
                jvm.org.apache.commons.io.IOUtils.copyLarge(source, stream, 0, size)
            finally:
                source.close()
            left -= size
        stream.write(bytearray(manifest["tail"].encode()))
    finally:
        stream.close()
    return total


def prune(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Drop all versions but the newest ``keep``, manifests first."""
    log = Records(spark, path)
    for v in versions(spark, path)[:-keep]:
        manifest = log.read(f"manifest-{v:06d}")
        log._fs.delete(log._at(f"manifest-{v:06d}"), False)
        for folder in {p["name"].split("/")[0] for p in manifest["parts"]}:
            log._fs.delete(log._at(folder), True)
