"""Sharding through fixed virtual slots and a versioned slot map.

Records are hashed by id into ``SLOTS`` virtual slots, a number that never changes.
Bytes are aggregated by slot, and the slot-to-shard map is made from those sums: the
heaviest slot first, each to the lightest shard so far.  The map (4096 rows, whatever
the corpus) is stored as a version of its own; rebalancing edits the last version
and moves as few slots as it must, records are never hashed anew.

The law that holds for a fresh map is ``bytes``: the shards' sizes are near equal.

Defined cases: a null text has no bytes (size 8, crc 0); a null id is hashed as an
empty one; repeated rows go to the same shard at different positions; an empty table gives
an empty result; equal slot weights are taken by slot number, equal shards by shard number.
"""

from __future__ import annotations

import heapq
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import shared_folder

#: Virtual slots: three hexadecimal digits of the id's md5.
SLOTS = 4096
RECORD_OVERHEAD = 8
MAP_SCHEMA = "version int, virtual_slot int, shard int, slot_bytes long, slot_rows long"


def _slot(id_col: str):
    return F.conv(F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 1, 3), 16, 10).cast("int")


def slot_weights(records: DataFrame) -> DataFrame:
    return records.groupBy("virtual_slot").agg(F.sum("size").alias("slot_bytes"), F.count(F.lit(1)).alias("slot_rows"))


def assign_slots(weights: dict[int, int], shards: int) -> dict[int, int]:
    """Heaviest slot first to the lightest shard; empty slots are dealt out in turn."""
    heap = [(0, s) for s in range(shards)]
    out = {}
    for slot in sorted(range(SLOTS), key=lambda v: (-weights.get(v, 0), v)):
        if not weights.get(slot):
            out[slot] = slot % shards
            continue
        load, s = heapq.heappop(heap)
        out[slot] = s
        heapq.heappush(heap, (load + weights[slot], s))
    return out


def edit_map(current: dict[int, int], weights: dict[int, int], shards: int, tolerance: float = 0.02) -> dict[int, int]:
    """The next version: slots of shards that are gone move out, and slots move from
    overfull shards to the emptiest until each is within ``tolerance`` of the mean or
    no single move helps.  Every other slot stays where it is."""
    out = dict(current)
    load = [0] * shards
    for slot, s in out.items():
        if s < shards:
            load[s] += weights.get(slot, 0)
    for slot in sorted((v for v, s in out.items() if s >= shards), key=lambda v: (-weights.get(v, 0), v)):
        to = min(range(shards), key=lambda s: (load[s], s))
        out[slot], load[to] = to, load[to] + weights.get(slot, 0)
    mean = sum(load) / shards
    held: dict[int, list[tuple[int, int]]] = {s: [] for s in range(shards)}
    for slot, s in out.items():
        held[s].append((weights.get(slot, 0), slot))
    for _ in range(SLOTS):
        hi, lo = max(range(shards), key=lambda s: (load[s], -s)), min(range(shards), key=lambda s: (load[s], s))
        want = min(load[hi] - mean, mean - load[lo])
        if load[hi] <= mean * (1 + tolerance) and load[lo] >= mean * (1 - tolerance):
            break
        fit = [x for x in held[hi] if 0 < x[0] < load[hi] - load[lo]]
        if not fit:
            break
        pick = min(fit, key=lambda x: (abs(x[0] - want), x[1]))
        held[hi].remove(pick)
        held[lo].append(pick)
        out[pick[1]] = lo
        load[hi] -= pick[0]
        load[lo] += pick[0]
    return out


def save_map(spark: SparkSession, folder: str, version: int, slot_map: dict[int, int], weights: dict[int, tuple[int, int]]) -> DataFrame:
    rows = [(version, v, slot_map[v], *weights.get(v, (0, 0))) for v in range(SLOTS)]
    spark.createDataFrame(rows, MAP_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{folder}/version={version:06d}")
    return load_map(spark, folder, version)


def load_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return spark.read.schema(MAP_SCHEMA).parquet(f"{folder}/version={version:06d}")


def shard_records(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text",
                  map_folder: str | None = None, version: int = 1, slot_map: dict[int, int] | None = None) -> DataFrame:
    """One row per record: ``doc_id, size, text_crc32, law, shard, slot, grown_shard,
    virtual_slot, map_version``.  ``slot`` is the record's position in its shard,
    without gaps from 0.  With ``slot_map`` an edited map is applied instead of a
    fresh one (law ``bytes`` then as far as that map keeps it)."""
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    rec = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + RECORD_OVERHEAD).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        _slot(id_col).alias("virtual_slot"))
    # at most SLOTS rows come to the driver, however large the corpus
    weights = {r["virtual_slot"]: (r["slot_bytes"], r["slot_rows"]) for r in slot_weights(rec).collect()}
    current = slot_map or assign_slots({k: v[0] for k, v in weights.items()}, shards)
    folder = map_folder or f"{shared_folder(spark)}/chainfeatures-llm/slot-map-{uuid.uuid4().hex[:12]}"
    stored = save_map(spark, folder, version, current, weights)
    first = Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    small = (stored.withColumn("__first", F.coalesce(F.sum("slot_rows").over(first), F.lit(0)))
             .select("virtual_slot", "shard", "__first", F.col("version").alias("map_version")))
    inside = Window.partitionBy("virtual_slot").orderBy(F.col("doc_id").asc_nulls_last(), "text_crc32", "size")
    return (rec.withColumn("__r", F.row_number().over(inside) - 1)
            .join(F.broadcast(small), "virtual_slot")  # SLOTS rows, a fixed bound
            .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
                    (F.col("__first") + F.col("__r")).cast("long").alias("slot"),
                    F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "map_version"))


def op5_sharding(spark, sf_dir: str) -> DataFrame:
    return shard_records(spark.read.parquet(f"{sf_dir}/documents.parquet"), shards=24)
