"""The minute spine as a stored table that takes late minutes without renumbering.

Order is kept on two levels: a minute's rank inside its slab is stored with it, and the slab's offset is the
number of minutes in earlier slabs, taken from the store's log (one row for each slab).  A late, changed or
removed minute rewrites its own slab only; the positions of all later minutes follow from the offsets.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainfeatures.functions.frames import SEQ
from chainfeatures.plans.store import SlabStore

TABLE = "spine"
SPINE_ROW = "timestamp_int long, date string, rank long, stockPrice double"


def offsets(counts: dict[str, int]) -> list[tuple[str, int]]:
    """(slab, minutes before it) in order of time."""
    names = sorted(counts)
    return list(zip(names, accumulate([0] + [counts[s] for s in names])))


def numbered(spark, ranked: DataFrame, counts: dict[str, int], slab_chars: int) -> DataFrame:
    """(timestamp_int, minute_seq, stockPrice) of ranked minutes."""
    table = spark.createDataFrame(offsets(counts), "_slab string, _before long")  # one row for each slab
    return (ranked.withColumn("_slab", F.substring("date", 1, slab_chars)).join(F.broadcast(table), "_slab")
            .select("timestamp_int", (F.col("_before") + F.col("rank")).alias(SEQ), "stockPrice"))


def read_spine(store: SlabStore) -> tuple[DataFrame, int]:
    """The stored spine and its number of minutes."""
    counts = store.slabs(TABLE)
    rows = store.read(TABLE)
    if rows is None:
        rows = store.spark.createDataFrame([], SPINE_ROW)
    return numbered(store.spark, rows, counts, store.slab_chars), sum(counts.values())


def ranked(store: SlabStore, minutes: DataFrame) -> DataFrame:
    """Minutes (timestamp_int, stockPrice) of whole slabs with their ranks: what is stored."""
    m = minutes.select("timestamp_int", F.substring(F.lpad(F.col("timestamp_int").cast("string"), 12, "0"), 1, 8).alias("date"), "stockPrice")
    order = Window.partitionBy(store.slab_of("date")).orderBy("timestamp_int")
    return m.select("timestamp_int", "date", F.row_number().over(order).cast("long").alias("rank"), "stockPrice")


def merged(store: SlabStore, added: DataFrame, removed: DataFrame, slabs: list[str]) -> DataFrame:
    """The slabs' minutes after a change: ``added`` (timestamp_int, stockPrice) replace or join the stored ones,
    ``removed`` (timestamp_int) go."""
    held = store.read(TABLE, set(slabs))
    added = added.select("timestamp_int", "stockPrice")
    if held is not None:
        gone = removed.select("timestamp_int").unionByName(added.select("timestamp_int"))
        added = added.unionByName(held.select("timestamp_int", "stockPrice").join(gone, "timestamp_int", "left_anti"))
    return ranked(store, added)


def stale_minutes(spine: DataFrame, changed: DataFrame, lookback: int) -> DataFrame:
    """Minutes whose features a change touches: every changed minute that is on the (new) spine and the
    ``lookback`` positions after each changed one, whether it was added, replaced or removed.

    The place of a changed minute is found in blocks of the spine's own order: a minute that is gone takes the place before
    the next one that is left."""
    day = F.floor(F.col("timestamp_int") / 10000)
    both = spine.select("timestamp_int", SEQ, F.lit(False).alias("_c")).unionByName(
        changed.select("timestamp_int").distinct().select("timestamp_int", F.lit(None).cast("long").alias(SEQ), F.lit(True).alias("_c")))
    both = both.withColumn("_day", day)
    # positions before a changed minute: of its own day, else of the days before it (one row for each day)
    per_day = both.groupBy("_day").agg(F.max(SEQ).alias("_last"))
    per_day = per_day.select("_day", F.max("_last").over(Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)).alias("_earlier"))
    upto = Window.partitionBy("_day").orderBy("timestamp_int", "_c")
    at = both.withColumn("_upto", F.max(SEQ).over(upto)).filter("_c").join(F.broadcast(per_day), "_day")
    # a present minute sorts before its own change and is touched itself; of an absent one, what follows is
    here = F.coalesce("_upto", "_earlier", F.lit(0))
    own = both.filter("NOT _c").select("timestamp_int", F.lit(0).alias("_skip"))
    places = at.join(own, "timestamp_int", "left").select((here + F.coalesce("_skip", F.lit(1))).alias("_from"), (here + lookback).alias("_to")).filter("_from <= _to")
    need = places.select(F.explode(F.sequence("_from", "_to")).alias(SEQ)).distinct()
    return spine.select("timestamp_int", SEQ).join(need, SEQ).select("timestamp_int")
