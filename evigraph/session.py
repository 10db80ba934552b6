"""Sessions with the settings that the engine is tuned for. An existing session is used as it is."""

from __future__ import annotations

import io
import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

_shipped: set[str] = set()
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def session(master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.config(map=SETTINGS | settings)
    spark = (builder.master(master) if master else builder).getOrCreate()
    ship_code(spark)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where it is unset a local folder takes its place on a single machine; on a cluster that is an error, as tables
    written there could not be read elsewhere.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if at:
        return at.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return os.path.join(tempfile.gettempdir(), "checkpoints")


def ship_code(spark: SparkSession) -> None:
    """Send this package's source to the executors, once for each application.

    Python workers import functions by module name, so every executor needs the source, whether or
    not it shares a file system with the driver. Sessions made elsewhere get it with their first query.
    """
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    path = os.path.join(tempfile.mkdtemp(prefix="ship-"), f"{package.name}_src.zip")
    Path(path).write_bytes(buffer.getvalue())
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)
