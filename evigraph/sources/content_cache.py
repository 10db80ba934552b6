"""A store of what is dear to compute, addressed by content: computed once, whoever asks.

The key is a hash of the normalised text, the model's name and the dimension, so another model or dimension is another entry. Parts are
only appended; readers keep one value a key, and ``compact`` writes all parts as one. Requests are joined with
the store, and only keys without an entry are computed, each once however many rows ask for it. A key's bucket (its
first two hexadecimal digits) is a partition of the store, so a lookup reads only buckets that are asked for.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import squeeze
from ..operators.components import cut_lineage


def content_key(text: Column, model: str, dimension: int) -> Column:
    """Texts that differ by case or spaces alone share a key; a null text is an empty one."""
    return F.sha2(F.concat_ws("|", F.lit(model), F.lit(str(dimension)), squeeze(F.lower(F.coalesce(text, F.lit(""))))), 256)


def fitted(vector: Column, dimension: int) -> Column:
    """A vector of the dimension: cut or filled with zeros; all zeros where there is none or a number of it is not finite."""
    zeros = F.array_repeat(F.lit(0.0), dimension)
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(F.coalesce(sound, F.lit(False)), F.slice(F.concat(vector, zeros), 1, dimension)).otherwise(zeros)


class ContentCache:
    def __init__(self, spark: SparkSession, path: str, model: str, dimension: int):
        self.spark, self.path, self.model, self.dimension = spark, path.rstrip("/"), model, dimension
        self._jvm = spark.sparkContext._jvm
        self._root = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def parts(self) -> list[str]:
        """Parts that were finished; those of a run that died have no mark."""
        if not self._fs.exists(self._root):
            return []
        found = sorted(s.getPath().getName() for s in self._fs.listStatus(self._root) if s.isDirectory())
        return [n for n in found if self._fs.exists(self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{n}/_SUCCESS"))]

    def entries(self) -> DataFrame:
        """key, bucket and vector, one for each key: the first part's."""
        empty = self.spark.createDataFrame([], "key string, vector array<double>, part string, bucket string")
        for n in self.parts():
            rows = self.spark.read.schema("key string, vector array<double>, bucket string").parquet(f"{self.path}/{n}")
            empty = empty.unionByName(rows.withColumn("part", F.lit(n)))
        return empty.groupBy("key", "bucket").agg(F.min_by("vector", "part").alias("vector"))

    def _append(self, rows: DataFrame) -> None:
        n = len(self.parts())
        rows.withColumn("bucket", F.substring("key", 1, 2)).write.partitionBy("bucket").parquet(f"{self.path}/part-{n:06d}-{uuid.uuid4().hex}")

    def vectors(self, texts: DataFrame, text_col: str, compute: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, int]:
        """``texts`` with key and vector, and how many keys were computed for it.

        ``compute`` gets the missing (key, text), a text for each key, and gives (key, vector); keys that it leaves out or gives no sound
        vector for get zeros, which are not stored, so they are tried again.
        """
        asked = cut_lineage(texts.withColumn("key", content_key(F.col(text_col), self.model, self.dimension)), "asked")
        keys = asked.groupBy("key").agg(F.coalesce(F.min(text_col), F.lit("")).alias("text")).withColumn("bucket", F.substring("key", 1, 2))
        missing = cut_lineage(keys.join(self.entries().select("key", "bucket"), ["key", "bucket"], "left_anti").select("key", "text"), "missing")
        n = missing.count()
        if n:
            made = compute(missing).select("key", fitted(F.col("vector"), self.dimension).alias("vector"))
            self._append(made.filter(F.exists("vector", lambda x: x != 0)).dropDuplicates(["key"]))
        found = asked.join(self.entries().select("key", "vector"), "key", "left")
        return found.withColumn("vector", F.coalesce("vector", F.array_repeat(F.lit(0.0), self.dimension))), n

    def compact(self) -> None:
        """All parts as one; the old ones go when it is whole."""
        old = self.parts()
        self._append(cut_lineage(self.entries().select("key", "vector"), "compact"))
        for n in old:
            self._fs.delete(self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{n}"), True)
