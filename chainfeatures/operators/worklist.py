"""Incremental-work operators: what is new, in which order, with which history.

All are joins/aggregations/windows over object keys and the minute spine; no
listing result is ever collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chainfeatures.config import HISTORY_PRELOAD_DAYS, HISTORY_PRELOAD_MINUTES, HISTORY_WINDOW_SIZE
from chainfeatures.functions import timekeys as K
from chainfeatures.functions.frames import SEQ
from chainfeatures.operators import timeline
from chainfeatures.session import materialize


def unprocessed(source_keys: DataFrame, dest_keys: DataFrame, key_col: str = "key") -> DataFrame:
    """Source keys whose suffix (after the first '/') has no destination
    counterpart: (key_suffix, date).  A left-anti join: each side shuffles
    once on the suffix; nothing is collected."""
    src = source_keys.select(K.key_suffix(key_col).alias("key_suffix")).distinct()
    dst = dest_keys.select(K.key_suffix(key_col).alias("key_suffix"))
    return (src.join(dst, "key_suffix", "left_anti")
            .select("key_suffix", K.date_folder("key_suffix").alias("date")))


def worklist_by_date(todo: DataFrame, uri_prefix: str) -> DataFrame:
    """Ordered work list: per date its URIs in time order, dates ascending.

    Rows, not a collected list: (date, date_order, uri, position, files_in_date).
    ``date_order`` numbers dates over a per-date table (one row per calendar
    date); positions are ranked inside each date.
    """
    items = todo.select("date", F.concat(F.lit(uri_prefix), F.col("key_suffix")).alias("uri"))
    # ranks in two levels: inside sorted slices of the listing, plus the slices before, so that a "date" of
    # any size (keys without a folder all count as 'unknown') is spread over tasks; stored, because range
    # borders are sampled and both levels must see the same slices
    slices = items.repartitionByRange("date", "uri").withColumn("_slice", F.spark_partition_id())
    slices = materialize(slices)
    counts = slices.groupBy("date", "_slice").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy("date")
    before = whole.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("date", "_slice", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
                           F.sum("_n").over(whole).alias("files_in_date"))
    w = Window.partitionBy("date", "_slice").orderBy("uri")
    items = slices.withColumn("_r", F.row_number().over(w)).join(counts, ["date", "_slice"]).select(
        "date", "uri", (F.col("_before") + F.col("_r")).cast("int").alias("position"), "files_in_date")
    dates = todo.select("date").distinct()  # one row per calendar date
    dates = dates.select("date", F.row_number().over(Window.orderBy("date")).alias("date_order"))
    return items.join(dates, "date").select(
        "date", "date_order", "uri", "position", "files_in_date")


def history_context(targets: DataFrame, spine: DataFrame, max_minutes: int = HISTORY_PRELOAD_MINUTES,
                    window_size: int = HISTORY_WINDOW_SIZE, days: int | None = HISTORY_PRELOAD_DAYS) -> DataFrame:
    """For each target minute, the newest ``min(max_minutes, window_size)``
    earlier minutes of the spine, restricted to the target's date and the
    ``days`` calendar days before it: (timestamp_int, context_timestamp_int, back).

    The spine (stored, one row per available minute) is cut into blocks with a halo of
    that many positions; a row frame over each block lists the minutes before every minute,
    and only the targets' lists are expanded.  Nothing but the spine is shuffled.  The date
    window only removes the oldest positions, so cutting after the pick is exact.
    """
    n = min(max_minutes, window_size)
    wanted = targets.select("timestamp_int").distinct().withColumn("_wanted", F.lit(True))
    sp = spine.select("timestamp_int", SEQ).join(wanted, "timestamp_int", "left")
    frame = Window.partitionBy("block").orderBy(SEQ).rowsBetween(-n, -1)
    listed = timeline.with_blocks(sp, max(1024, 4 * n), n).withColumn("_ctx", F.collect_list("timestamp_int").over(frame))
    listed = listed.filter("_wanted AND NOT is_halo")
    out = listed.select("timestamp_int", F.posexplode(F.reverse("_ctx")).alias("_p", "context_timestamp_int")).select(
        "timestamp_int", "context_timestamp_int", (F.col("_p") + 1).alias("back"))
    if days is not None:
        day = F.to_date(F.floor(F.col("timestamp_int") / 10000).cast("string"), "yyyyMMdd")
        cday = F.to_date(F.floor(F.col("context_timestamp_int") / 10000).cast("string"), "yyyyMMdd")
        out = out.filter(cday >= F.date_sub(day, days))
    return out.select("timestamp_int", "context_timestamp_int", "back")


def chronology_gate(arrivals: DataFrame, batch_col: str, order_col: str, ts_col: str = "timestamp_int",
                    chunk: int = 4096) -> DataFrame:
    """Accept a minute only if it is strictly later than every earlier arrival
    of its batch (the newest accepted one is the running maximum of all
    earlier arrivals, since a rejected one never exceeds it).

    Two-level prefix maximum, so one huge batch still spreads over many tasks:
    arrivals are cut into chunks of ``chunk`` consecutive order values; the
    maximum of every earlier chunk comes from a window over the small
    per-chunk table, the rest from a running maximum inside the chunk.
    """
    a = arrivals.withColumn("_chunk", F.floor(F.col(order_col) / chunk))
    per_chunk = a.groupBy(batch_col, "_chunk").agg(F.max(ts_col).alias("_chunk_max"))
    earlier = Window.partitionBy(batch_col).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    per_chunk = per_chunk.select(batch_col, "_chunk", F.max("_chunk_max").over(earlier).alias("_before_chunk"))
    inside = (Window.partitionBy(batch_col, "_chunk").orderBy(order_col)
              .rowsBetween(Window.unboundedPreceding, -1))
    a = a.join(per_chunk, [batch_col, "_chunk"]).withColumn("_in_chunk", F.max(ts_col).over(inside))
    newest = F.greatest("_before_chunk", "_in_chunk")  # greatest() skips nulls
    return a.select(*arrivals.columns, newest.alias("newest_before"),
                    F.coalesce(F.col(ts_col) > newest, F.lit(True)).alias("accepted"))


def run_summary(outcomes: DataFrame) -> DataFrame:
    """Per date: completed and failed files; plus a total row (date null) with
    the run status ('success' / 'partial') and the share of dates without
    failures.  ``outcomes``: (date, ok boolean)."""
    per_date = outcomes.groupBy("date").agg(
        F.count_if(F.col("ok")).alias("completed"),
        F.count_if(~F.col("ok")).alias("failed"))
    total = per_date.agg(
        F.lit(None).cast("string").alias("date"),
        F.sum("completed").alias("completed"),
        F.sum("failed").alias("failed"),
        F.count(F.lit(1)).alias("dates"),
        F.count_if(F.col("failed") > 0).alias("failed_dates"))
    per_date = per_date.select("date", "completed", "failed", F.lit(1).cast("long").alias("dates"),
                               (F.col("failed") > 0).cast("long").alias("failed_dates"))
    allrows = per_date.unionByName(total.select("date", F.col("completed").cast("long"),
                                                F.col("failed").cast("long"), "dates", "failed_dates"))
    return allrows.select(
        "date", "completed", "failed", "dates", "failed_dates",
        F.when(F.col("failed") == 0, "success").otherwise("partial").alias("status"),
        F.round((F.col("dates") - F.col("failed_dates")) * 100.0 / F.col("dates"), 1).alias("success_rate"))
