"""Resumable sessions of batches: a log of immutable records in the shared folder, leases, and results that count once.

A session's folder holds records, each made by exclusive creation and never changed: ``begun``, ``lease-<batch>-<n>`` (the n-th holder of
a batch, with an expiry), ``done-<batch>`` (which attempt's output counts, and its rows) and ``ended``. Whoever creates a record first
has it; another gets False. A batch's output is written to a folder of its own attempt and counts when ``done`` names it, so a run that
dies between any two steps leaves nothing that readers see, and the next run goes on with what is not done.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Seconds for which a batch is its holder's.
LEASE = 3600.0


class Records:
    """Small immutable files in a folder that all machines see."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm = spark.sparkContext._jvm
        self._root = self._jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._root)

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._root, name)

    def create(self, name: str, value: dict) -> bool:
        """Make a record; False if there is one already."""
        if self._fs.exists(self._at(name)):
            return False
        try:
            out = self._fs.create(self._at(name), False)
        except Exception as e:
            if "AlreadyExists" in str(e) or "already exists" in str(e):
                return False
            raise
        try:
            out.write(bytearray(json.dumps(value, sort_keys=True).encode()))
        finally:
            out.close()
        return True

    def names(self) -> list[str]:
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._root) if s.isFile() and not s.getPath().getName().startswith("."))

    def read(self, name: str) -> dict | None:
        """A record; None if there is none, or one whose writer died before its content."""
        if not self._fs.exists(self._at(name)):
            return None
        size = self._fs.getFileStatus(self._at(name)).getLen()
        stream = self._fs.open(self._at(name))
        try:
            text = bytes(self._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode() if size else ""
        finally:
            stream.close()
        return json.loads(text) if text else None


@dataclass
class Session:
    """A named run over batches, which several processes may work on."""

    spark: SparkSession
    path: str
    holder: str = field(default_factory=lambda: uuid.uuid4().hex)
    lease: float = LEASE
    clock: Callable[[], float] = time.time

    def __post_init__(self) -> None:
        self.records = Records(self.spark, f"{self.path.rstrip('/')}/log")

    def begin(self, phase: str) -> bool:
        """Open the session; False if another run did, which this one then continues."""
        return self.records.create("begun", {"phase": phase, "at": self.clock()})

    def claim(self, batch: int) -> bool:
        """Take a batch unless it is done or another's lease on it still runs."""
        known = self.records.names()
        if f"done-{batch}" in known:
            return False
        mine = [n for n in known if n.startswith(f"lease-{batch}-")]
        last = max((int(n.rsplit("-", 1)[1]) for n in mine), default=0)
        if last:
            held = self.records.read(f"lease-{batch}-{last}")
            if held and held["holder"] != self.holder and held["until"] > self.clock():
                return False
            if held and held["holder"] == self.holder and held["until"] > self.clock():
                return True
        return self.records.create(f"lease-{batch}-{last + 1}", {"holder": self.holder, "until": self.clock() + self.lease})

    def commit(self, batch: int, attempt: str, rows: int) -> bool:
        """Let an attempt's output count; False if another's does."""
        return self.records.create(f"done-{batch}", {"attempt": attempt, "rows": rows, "holder": self.holder, "at": self.clock()})

    def done(self) -> dict[int, dict]:
        found = {int(n[5:]): self.records.read(n) for n in self.records.names() if n.startswith("done-")}
        return {k: v for k, v in found.items() if v}

    def run(self, rows: DataFrame, batch: str, work: Callable[[DataFrame], DataFrame], after: Callable[[str], None] = lambda step: None) -> bool:
        """Work off the batches of ``rows`` (by a column of small numbers) that are not done; True when all are.

        ``after`` is told of every step, for tests and progress.
        """
        self.begin("batches")
        after("begun")
        for (k,) in sorted(rows.select(batch).distinct().collect()):  # one row a batch
            if not self.claim(k):
                continue
            after("claimed")
            attempt = f"attempt-{k}-{uuid.uuid4().hex}"
            out = work(rows.filter(F.col(batch) == k).drop(batch))
            out.write.parquet(f"{self.path}/{attempt}")
            after("written")
            self.commit(k, attempt, self.spark.read.parquet(f"{self.path}/{attempt}").count())
            after("committed")
        left = {k for (k,) in rows.select(batch).distinct().collect()} - set(self.done())
        if not left:
            self.records.create("ended", {"at": self.clock()})
        return not left

    def output(self) -> DataFrame | None:
        """The rows of all attempts that count; None before there is one."""
        paths = [f"{self.path}/{v['attempt']}" for _, v in sorted(self.done().items())]
        return self.spark.read.parquet(*paths) if paths else None

    def log(self) -> DataFrame:
        """record, batch, holder and rows of every record, to query where a session stands."""
        out = []
        for name in self.records.names():
            value = self.records.read(name) or {}
            kind, *rest = name.split("-")
            out.append((kind, int(rest[0]) if rest else None, value.get("holder"), value.get("rows"), value.get("attempt")))
        return self.spark.createDataFrame(out, "record string, batch int, holder string, rows bigint, attempt string")
