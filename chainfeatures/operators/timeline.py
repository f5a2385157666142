"""The rolling queue as relations: minute spine, queue size, time blocks.

The reference keeps a FIFO of the last 300 minute snapshots and reads
``queue[-k]``.  Here every valid minute gets its global position
``minute_seq``; the queue at minute s is simply positions < s, so any
look-back is a range frame over ``minute_seq`` (``functions.frames``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainfeatures.functions.frames import SEQ
from chainfeatures.session import materialize

# A spine up to this many minutes (about 40 years of trading minutes) is
# broadcast; beyond it the panel joins the spine with a shuffle.
SPINE_BROADCAST_MAX_ROWS = 4_000_000


def minute_spine(panel: DataFrame) -> DataFrame:
    """One row per valid minute: timestamp_int, minute_seq (1-based), stockPrice.

    Two-level numbering keeps the work distributed: the number of minutes of
    each day is aggregated (one row per calendar day, so the running total over
    days is tiny), and minutes are ranked inside their own day.
    The minute's price is its (constant) ``stockPrice``; ``min`` picks it
    without depending on row order.
    """
    # one row per minute, stored: both branches below start from it, the panel is read once
    per_minute = materialize(panel.groupBy("timestamp_int").agg(F.min("stockPrice").alias("stockPrice")))
    per_minute = per_minute.withColumn("_day", F.floor(F.col("timestamp_int") / 10000))
    per_day = per_minute.groupBy("_day").agg(F.count(F.lit(1)).alias("_n"))
    per_day = per_day.select(
        "_day",
        F.coalesce(F.sum("_n").over(Window.orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_offset"))
    ranked = per_minute.select(
        "timestamp_int", "stockPrice", "_day",
        F.row_number().over(Window.partitionBy("_day").orderBy("timestamp_int")).alias("_rn"))
    # per_day has one row per calendar day (≤ 366 a year): a bound by construction
    return (ranked.join(F.broadcast(per_day), "_day")
            .select("timestamp_int", (F.col("_offset") + F.col("_rn")).cast("long").alias(SEQ),
                    "stockPrice"))


def queue_size(spine: DataFrame, window_size: int) -> DataFrame:
    """Queue size before (``available``) and after (``queue_size``) each minute."""
    return spine.select(
        "timestamp_int", SEQ,
        F.least(F.col(SEQ) - 1, F.lit(window_size)).alias("available"),
        F.least(F.col(SEQ), F.lit(window_size)).alias("queue_size"))


def attach_seq(panel: DataFrame, spine: DataFrame, spine_rows: int | None) -> DataFrame:
    """Add ``minute_seq`` to every panel row (inner join: minutes not on the
    spine were rejected and do not enter the queue)."""
    s = spine.select("timestamp_int", SEQ)
    if spine_rows is not None and spine_rows <= SPINE_BROADCAST_MAX_ROWS:
        s = F.broadcast(s)
    return panel.join(s, "timestamp_int")


def with_blocks(df: DataFrame, block: int, halo: int) -> DataFrame:
    """Assign each row to its time block; rows in the last ``halo`` positions of
    a block are also copied into the next block as read-only context
    (``is_halo``).  A window partitioned by (key, block) then sees every
    position it can look back to, and no partition holds more than
    ``block + halo`` minutes of one key however long or skewed the history.
    """
    pos = (F.col(SEQ) - 1) % block
    shifts = F.when(pos >= block - halo, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    out = df.select("*", F.explode(shifts).alias("_shift"))
    return out.select(
        *[F.col(f"`{c}`") for c in df.columns],
        (F.floor((F.col(SEQ) - 1) / block) + F.col("_shift")).cast("long").alias("block"),
        (F.col("_shift") == 1).alias("is_halo"))


def last_n_window(spine: DataFrame, n: int) -> DataFrame:
    """Long form of ``get_window(n)``: for each minute, the n earlier minutes
    (fewer at the start), as (timestamp_int, window_timestamp_int, back).

    An equi-join on ``minute_seq - back`` over a generated 1..n column: n rows
    per minute, no range join.
    """
    if n < 1:
        return spine.select("timestamp_int").limit(0).select(
            "timestamp_int", F.lit(None).cast("long").alias("window_timestamp_int"),
            F.lit(None).cast("int").alias("back"))
    cur = spine.select("timestamp_int", SEQ, F.explode(F.sequence(F.lit(1), F.lit(n))).alias("back"))
    cur = cur.select("timestamp_int", "back", (F.col(SEQ) - F.col("back")).alias("_target"))
    prev = spine.select(F.col("timestamp_int").alias("window_timestamp_int"), F.col(SEQ).alias("_target"))
    return cur.join(prev, "_target").select("timestamp_int", "window_timestamp_int", "back")


def positional_lag(rows: DataFrame, columns: dict, key: tuple, params) -> DataFrame:
    """``{col}_lag{k}``: the key's value exactly k queue positions back (null
    when the key is absent from that minute or the queue is shorter than k).
    Rows need ``minute_seq``; windows are blocked like the feature plan."""
    from chainfeatures.functions.frames import Frames, gate

    halo = max(k for ks in columns.values() for k in ks)
    block = max(params.block_minutes or 1024, 2 * halo)
    fr = Frames(*key, "block")
    b = with_blocks(rows, block, halo).repartition(*key[:1], "block")
    exprs = [F.expr(f"CASE WHEN {gate(k, params.window_size)} THEN {fr.lag(f'`{c}`', k)} END").alias(f"{c}_lag{k}")
             for c, ks in columns.items() for k in ks]
    return (b.select(*[F.col(k) for k in ("timestamp_int",) + tuple(key)], "is_halo", *exprs)
            .filter(~F.col("is_halo")).drop("is_halo"))
