"""What the operators of this subpackage share: table access, shared storage, shipping code."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder, ship_code

#: Rows of an Arrow batch between the JVM and Python: texts are long, so few.
BATCH_ROWS = 1000
#: Bytes of text that Python code works on at a time, but for a single longer text.
RUN_BYTES = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send the package's source to the executors, and keep Arrow batches small."""
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)
    ship_code(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` where set.

    Only where it is unset on a single machine (tests) a local folder takes its place; on a cluster that is an error.
    """
    at = shared_folder(spark)
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", at)
    return at


def persist_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there.

    A lost executor costs only a re-read, as the files are not on its disk.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._shared_path = path
    return back


def drop_tables(*tables: DataFrame) -> None:
    """Delete the files of tables that ``persist_table`` made and nothing will read again."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df._shared_path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


#: Rows of a side that is broadcast at most; a larger side is joined by shuffle.
BROADCAST_ROWS = 300_000


def few(df: DataFrame) -> DataFrame:
    """Broadcast a side of ids that is counted to be small; leave a larger one to a shuffle join."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def free(name: str, taken: list[str]) -> str:
    """The name, with underscores after it until no column has it (names differ by more than case)."""
    known = {c.lower() for c in taken}
    while name.lower() in known:
        name += "_"
    return name


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))


def runs(batch: pa.RecordBatch, text_at: int = 0) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about RUN_BYTES of text each, or one longer text."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = sizes[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(sizes, before + RUN_BYTES, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def vocabulary_bytes(path: str) -> bytes:
    """A tokenizer file's content; the driver reads it, tasks get it by broadcast."""
    return Path(path).read_bytes()
