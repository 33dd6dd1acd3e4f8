"""Sharding by fixed virtual slots.

Every record is hashed into one of SLOTS virtual slots, bytes are aggregated per
slot, and a versioned map says which shard holds each slot. Rebalancing edits the
map: it moves the fewest slots that bring the shards' bytes together, and records
follow their slot without being hashed anew.
"""

from __future__ import annotations

import heapq
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_dir, stage, table, unstage

SLOTS = 8192
SHARDS = 40
ROW_BYTES = 16
MAP_FIELDS = "version int, virtual_slot int, shard int, slot_bytes bigint"


def virtual_slot(*record: Column, slots: int = SLOTS) -> Column:
    """Depends on the given columns alone; nulls have a slot too."""
    return F.pmod(F.xxhash64(*record), F.lit(slots)).cast("int")


def spread(slot_bytes: dict[int, int], shards: int, slots: int = SLOTS) -> dict[int, int]:
    """A first map: slots in order of falling bytes, each to the shard with the
    fewest so far. Slots without rows are dealt in turn."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for slot in sorted(range(slots), key=lambda k: (-slot_bytes.get(k, 0), k)):
        if not slot_bytes.get(slot, 0):
            out[slot] = slot % shards
            continue
        held, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (held + slot_bytes[slot], shard))
    return out


def rebalance(mapped: dict[int, int], slot_bytes: dict[int, int], shards: int) -> dict[int, int]:
    """The next version of a map: slots leave the fullest shards (and shards that are
    gone) for the emptiest until no move narrows the gap."""
    out = dict(mapped)
    held = dict.fromkeys(range(shards), 0)
    inside: dict[int, list[tuple[int, int]]] = {s: [] for s in range(shards)}
    homeless = []
    for slot, shard in sorted(out.items()):
        size = slot_bytes.get(slot, 0)
        if shard in held:
            held[shard] += size
            inside[shard].append((size, slot))
        else:
            homeless.append((size, slot))
    for size, slot in sorted(homeless, reverse=True):
        to = min(held, key=lambda s: (held[s], s))
        out[slot] = to
        held[to] += size
        inside[to].append((size, slot))
    for _ in range(len(out)):
        full, empty = max(held, key=lambda s: (held[s], -s)), min(held, key=lambda s: (held[s], s))
        gap = held[full] - held[empty]
        movable = [x for x in inside[full] if 0 < x[0] < gap]
        if not movable:
            break
        size, slot = min(movable, key=lambda x: (abs(gap / 2 - x[0]), x[1]))
        inside[full].remove((size, slot))
        inside[empty].append((size, slot))
        held[full] -= size
        held[empty] += size
        out[slot] = empty
    return out


def save_map(spark: SparkSession, path: str, mapped: dict[int, int], slot_bytes: dict[int, int], version: int) -> None:
    """One folder per version; a version is never overwritten."""
    rows = [(version, k, s, slot_bytes.get(k, 0)) for k, s in sorted(mapped.items())]
    spark.createDataFrame(rows, MAP_FIELDS).coalesce(1).write.parquet(f"{path}/version={version:06d}")


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(MAP_FIELDS).parquet(f"{path}/version={version:06d}")


def bytes_per_slot(records: DataFrame) -> dict[int, int]:
    """At most SLOTS numbers reach the driver."""
    return {r.virtual_slot: r.b for r in records.groupBy("virtual_slot").agg(F.sum("size").alias("b")).collect()}


def shard_documents(
    docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, map_path: str | None = None, previous: DataFrame | None = None
) -> DataFrame:
    """Rows (doc_id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot,
    map_version); law is `bytes`, slot numbers a shard's rows from 0 without gaps in the order of virtual
    slot, id, checksum and size.

    The map is stored under `map_path` (a folder in the shared one by default); given
    the `previous` version's rows, it is edited instead of built. A null text has no
    bytes and the checksum of the empty text. A record's slot follows from its id, checksum and
    size; rows that repeat all three are numbered and their number counts too, so neither null ids nor rows
    that repeat an id or a text gather in a slot, and the slots that such rows fill do not depend on how the
    table is read; an empty table gives an empty result; other columns are dropped.
    """
    spark = docs.sparkSession
    text = F.col("text").cast("string")
    plain = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.spark_partition_id().alias("task"),
    )
    record = ["doc_id", "text_crc32", "size"]
    # copies are numbered task by task, from how many the tasks before have, so no task holds all of them
    held = stage(plain, "rows")
    each = held.groupBy(*record, "task").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy(*record).orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    later = each.withColumn("before", before).where("before > 0").select(*(F.col(c).alias(f"__{c}") for c in (*record, "task")), "before")
    same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in (*record, "task")))
    met = F.row_number().over(Window.partitionBy(*record, "task").orderBy(F.lit(0)))
    numbered = held.join(later, same, "left").withColumn("copy", met - 1 + F.coalesce("before", F.lit(0)))
    records = stage(numbered.withColumn("virtual_slot", virtual_slot(*map(F.col, record), F.col("copy"), slots=slots)).select(*record, "copy", "virtual_slot"), "records")
    unstage(held)
    per_slot = {r.virtual_slot: (r.b, r.n) for r in records.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()}
    slot_bytes = {k: v[0] for k, v in per_slot.items()}
    if previous is None:
        mapped, version = spread(slot_bytes, shards, slots), 1
    else:
        old = previous.select("virtual_slot", "shard", "version").collect()
        mapped, version = rebalance({r.virtual_slot: r.shard for r in old}, slot_bytes, shards), 1 + max(r.version for r in old)
    path = map_path or f"{shared_dir(spark)}/slot-map-{uuid.uuid4().hex}"
    save_map(spark, path, mapped, slot_bytes, version)
    first, before = [], dict.fromkeys(range(shards), 0)
    for k in range(slots):
        first.append((k, before[mapped[k]]))
        before[mapped[k]] += per_slot.get(k, (0, 0))[1]
    starts = load_map(spark, path, version).join(spark.createDataFrame(first, "virtual_slot int, first bigint"), "virtual_slot")
    own = Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size", "copy")
    return (
        records.withColumn("nth", F.row_number().over(own))
        .join(F.broadcast(starts.select("virtual_slot", "version", "shard", "first")), "virtual_slot")  # `slots` rows
        .select(
            "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("first") + F.col("nth") - 1).cast("bigint").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.col("version").alias("map_version"),
        )
    )


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))
