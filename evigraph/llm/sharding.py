"""Sharding over fixed virtual slots.

A record's virtual slot is a hash of its key, so it never changes. Bytes are summed
for each slot, and a versioned slot-to-shard map (one row a slot) places whole slots:
version 1 packs the slots, largest first, on the lightest shard; where a map is stored already,
its newest version is loaded and a rebalance edits only the entries that it moves, which
gives the next version, or none if nothing moves. Everything runs as DataFrame expressions; the
driver handles the slot table alone, whose size is the fixed number of slots.

Defined results: a null text has no bytes and still weighs the record's overhead; equal
keys share a slot; an empty table gives an empty result and a map that deals the slots
round; rows with equal keys are all kept; columns of the input named ``_size``,
``_virtual_slot``, ``_shard`` or ``_position`` give way to the results.
"""

from __future__ import annotations

import heapq
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import free, shared_dir

SLOTS = 8192
#: Parts of a slot that number their rows independently; slots times parts groups exist at most.
PARTS = 8


@dataclass(frozen=True)
class SlotMap:
    """shards[slot] is the shard of a virtual slot."""

    version: int
    n_shards: int
    shards: tuple[int, ...]

    def save(self, spark: SparkSession, path: str) -> None:
        """Store this version beside the earlier ones, as a table partitioned by version."""
        rows = spark.range(len(self.shards), numPartitions=1).select(
            F.col("id").cast("int").alias("slot"), self.shard_of(F.col("id").cast("int")).alias("shard"), F.lit(self.n_shards).alias("n_shards")
        )
        rows.write.mode("error").parquet(f"{path}/version={self.version}")  # a version is never written twice

    @staticmethod
    def versions(spark: SparkSession, path: str) -> list[int]:
        """The stored versions whose writing ended."""
        sc = spark.sparkContext
        done = sc._jvm.org.apache.hadoop.fs.Path(f"{path}/version=*/_SUCCESS")
        found = done.getFileSystem(sc._jsc.hadoopConfiguration()).globStatus(done) or []
        return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in found)

    @classmethod
    def load(cls, spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
        """A stored version, the newest unless one is named."""
        version = version or max(cls.versions(spark, path))
        rows = spark.read.parquet(f"{path}/version={version}").orderBy("slot").collect()  # one row a slot
        return cls(version, rows[0].n_shards, tuple(r.shard for r in rows))

    def shard_of(self, slot: Column) -> Column:
        return F.element_at(F.expr("array(" + ",".join(map(str, self.shards)) + ")"), slot + 1)


def virtual_slot(key: Column | list[Column], slots: int = SLOTS) -> Column:
    keys = key if isinstance(key, list) else [key]
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")


def slot_bytes(sized: DataFrame, slot_col: str, size_col: str) -> dict[int, int]:
    """Bytes of each slot that has rows: one row a slot, summed map-side first."""
    return {r[0]: r[1] for r in sized.groupBy(slot_col).agg(F.sum(size_col)).collect()}


def pack(weights: dict[int, int], n_shards: int, slots: int = SLOTS) -> SlotMap:
    """Version 1: slots by descending bytes, each to the shard with the fewest bytes so far."""
    heap = [(0, 0, s) for s in range(n_shards)]
    out = [0] * slots
    for slot in sorted(range(slots), key=lambda s: (-weights.get(s, 0), s)):
        load, n, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (load + weights.get(slot, 0), n + 1, shard))
    return SlotMap(1, n_shards, tuple(out))


def rebalance(current: SlotMap, weights: dict[int, int], n_shards: int, tolerance: float = 0.01) -> SlotMap:
    """The next version: moves slots from the heaviest shard to the lightest until their gap is within ``tolerance`` or a slot's weight.

    A new shard starts empty and so receives first; slots that need not move stay.
    A move must narrow the gap, so the loop ends.
    """
    out = list(current.shards)
    load, held = [0] * n_shards, [[] for _ in range(n_shards)]
    homeless = []
    for slot, shard in enumerate(out):
        if shard < n_shards:
            load[shard] += weights.get(slot, 0)
            held[shard].append(slot)
        else:
            homeless.append(slot)  # its shard is gone
    for slot in sorted(homeless, key=lambda s: (-weights.get(s, 0), s)):
        to = min(range(n_shards), key=lambda s: (load[s], s))
        out[slot] = to
        load[to] += weights.get(slot, 0)
        held[to].append(slot)
    goal, grain = sum(load) / n_shards, max(weights.values(), default=0)
    while True:
        high, low = max(range(n_shards), key=lambda s: load[s]), min(range(n_shards), key=lambda s: load[s])
        gap = load[high] - load[low]
        if gap <= max(tolerance * goal, grain):
            break
        fits = [s for s in held[high] if 0 < weights.get(s, 0) < gap]
        if not fits:
            break
        slot = min(fits, key=lambda s: (abs(weights[s] - gap / 2), s))
        held[high].remove(slot)
        held[low].append(slot)
        load[high] -= weights[slot]
        load[low] += weights[slot]
        out[slot] = low
    return SlotMap(current.version + 1, n_shards, tuple(out))


def assign(docs: DataFrame, n_shards: int, key_cols: list[str], text_col: str = "text", overhead: int = 16, slots: int = SLOTS, map_path: str | None = None, bytes_col: str | None = None) -> tuple[DataFrame, SlotMap]:
    """Every row with ``_size``, ``_virtual_slot`` and ``_shard``; and the map, kept at ``map_path``, one for each table.

    ``bytes_col`` holds the sizes of texts where they are known already.
    """
    spark = docs.sparkSession
    size = F.col(bytes_col) if bytes_col else F.octet_length(text_col)
    sized = docs.withColumns({
        "_size": F.coalesce(size.cast("bigint"), F.lit(0).cast("bigint")) + overhead,
        "_virtual_slot": virtual_slot([F.col(c) for c in key_cols], slots),
    })
    weights = slot_bytes(sized, "_virtual_slot", "_size")
    path = map_path or f"{shared_dir(spark)}/slot-maps/{uuid.uuid4().hex}"
    if SlotMap.versions(spark, path):
        before = SlotMap.load(spark, path)
        chosen = rebalance(before, weights, n_shards)
        if (chosen.shards, n_shards) == (before.shards, before.n_shards):
            chosen = before
        else:
            chosen.save(spark, path)
    else:
        chosen = pack(weights, n_shards, slots)
        chosen.save(spark, path)
    return sized.withColumn("_shard", chosen.shard_of(F.col("_virtual_slot"))), chosen


def positions(assigned: DataFrame, order: list[str], parts: int = PARTS) -> DataFrame:
    """``_position``: each row's place in its shard, gapless from 0.

    Rows are numbered inside small groups (parts of virtual slots); the groups' offsets
    come from a table of counts with ``slots`` times ``parts`` rows at most. No shard is
    ever gathered in one task.
    """
    part, mine, first = (free(c, assigned.columns) for c in ("_part", "_own", "_before"))
    keyed = assigned.withColumn(part, F.pmod(F.xxhash64(*order, F.lit(7)), F.lit(parts)).cast("int"))
    counts = keyed.groupBy("_shard", "_virtual_slot", part).agg(F.count("*").alias("_n"))
    before = Window.partitionBy("_shard").orderBy("_virtual_slot", part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_virtual_slot", part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(first))
    own = Window.partitionBy("_virtual_slot", part).orderBy(*order)
    numbered = keyed.withColumn(mine, F.row_number().over(own) - 1)
    # At most slots x parts rows of three numbers: about 2 MB by default.
    return numbered.join(F.broadcast(offsets), ["_virtual_slot", part]).withColumn("_position", F.col(first) + F.col(mine)).drop(mine, first, part)
