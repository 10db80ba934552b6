"""Writers. A table is a folder of numbered snapshots; a version is published by naming it last.

Spark has no constraints or triggers, so conflict policies are joins before the write.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


class Snapshots:
    """A table with versions: a new snapshot is written beside the old, then published, so a failed write leaves the old one current."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._root = jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._join = lambda name: jvm.org.apache.hadoop.fs.Path(self._root, name)

    def versions(self) -> list[int]:
        if not self._fs.exists(self._root):
            return []
        return sorted(int(s.getPath().getName()[1:]) for s in self._fs.listStatus(self._root) if s.getPath().getName()[1:].isdigit())

    def read(self, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/v{self.versions()[-1] if version is None else version}")

    def publish(self, df: DataFrame, partition_by: tuple[str, ...] = ()) -> int:
        """Write a snapshot under another name and rename it: readers never see half of it."""
        version = (self.versions() or [0])[-1] + 1
        draft = f"{self.path}/_draft-{uuid.uuid4().hex}"
        df.write.partitionBy(*partition_by).parquet(draft)
        if not self._fs.rename(self._join(draft.rsplit("/", 1)[1]), self._join(f"v{version}")):
            raise OSError(f"{draft} can't be published")
        return version

    def rollback(self) -> int:
        """Drop the newest version; the one before is current again."""
        *kept, last = self.versions()
        self._fs.delete(self._join(f"v{last}"), True)
        return kept[-1]


def insert_ignore(target: DataFrame, incoming: DataFrame, keys: list[str], order: list | None = None) -> DataFrame:
    """Rows with new keys are added, the first of each key in ``order``; known keys keep the target's row."""
    first = first_by(incoming, keys, order or [F.lit(0)])
    return target.unionByName(first.join(target.select(*keys), keys, "left_anti").select(*target.columns))


def insert_replace(target: DataFrame, incoming: DataFrame, keys: list[str], order: list | None = None) -> DataFrame:
    """Incoming rows take the place of rows with their keys."""
    first = first_by(incoming, keys, order or [F.lit(0)])
    return target.join(first.select(*keys), keys, "left_anti").select(*target.columns).unionByName(first.select(*target.columns))


def first_by(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """One row a key, chosen before the shuffle where possible: the least in ``order``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def update_by_key(target: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Columns of ``changes`` that are not null replace the target's."""
    names = [c for c in changes.columns if c != key]
    joined = target.join(changes.select(key, *[F.col(c).alias(f"_new_{c}") for c in names]), key, "left")
    return joined.select(*[F.coalesce(f"_new_{c}", c).alias(c) if c in names else F.col(c) for c in target.columns])


def delete_where(target: DataFrame, predicate) -> DataFrame:
    """Rows for which the predicate is not true stay, nulls included."""
    return target.filter(~F.coalesce(predicate, F.lit(False)))


def refresh(snapshots: Snapshots, df: DataFrame, partition_by: tuple[str, ...] = ()) -> int:
    """Delete everything, then insert: a new snapshot."""
    return snapshots.publish(df, partition_by)


def junction(members: DataFrame, entities: DataFrame, on: str) -> DataFrame:
    """A junction table rebuilt from its two sides."""
    return members.join(entities, on).distinct()


def write_json_document(df: DataFrame, path: str, order: list[str], most: int = 1_000_000) -> None:
    """One JSON file with an array of the rows in ``order``, for exports that a browser loads.

    The file is drafted beside the old one, which becomes ``path.bak`` before the draft takes its name: readers
    see the old document or the new one whole. More than ``most`` rows are an error: write JSON lines instead.
    """
    spark = df.sparkSession
    if df.count() > most:
        raise ValueError(f"over {most} rows are no single document: use write_jsonl")
    lines = df.orderBy(*order).select(F.to_json(F.struct(*df.columns)).alias("j"))
    held = lines.agg(F.collect_list("j").alias("j")).select(F.concat(F.lit("["), F.array_join("j", ",\n"), F.lit("]")).alias("value"))
    draft = f"{path}-draft-{uuid.uuid4().hex}"
    held.coalesce(1).write.text(draft)  # the one row of the document
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    at, old, folder = hadoop(path), hadoop(f"{path}.bak"), hadoop(draft)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    made = next(f.getPath() for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-"))
    if fs.exists(at):
        fs.delete(old, False)
        if not fs.rename(at, old):
            raise OSError(f"no backup of {path}")
    if not fs.rename(made, at):
        if fs.exists(old):
            fs.rename(old, at)
        raise OSError(f"{path} can't be published")
    fs.delete(folder, True)


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def node_link(pairs: DataFrame) -> DataFrame:
    """Node-link graph in one row: ordered nodes with degrees, ordered links. For exports that a browser loads, so small."""
    nodes = pairs.select(F.col("source").alias("id"), F.lit("intervention").alias("type")).union(pairs.select(F.col("target").alias("id"), F.lit("condition").alias("type")))
    nodes = nodes.groupBy("id", "type").agg(F.count("*").alias("degree"))
    links = pairs.agg(F.array_sort(F.collect_list(F.struct("source", "target", "aggregate_score", "edge_count"))).alias("links"))
    return nodes.agg(F.array_sort(F.collect_list(F.struct("id", "type", "degree"))).alias("nodes")).crossJoin(links)
