"""Snapshot validation: which minutes may enter the queue.

A minute is rejected (quarantined) when its file is unreadable, empty or lacks a required
column (``sources.snapshots.footer_failures``), when it has a null key, repeats a
(expirDate, strike) key, has several prices, or when fewer rows could be read than its
file holds; rejected minutes never get a position on the spine.  Checks are aggregations
per minute, so a bad minute costs nothing extra and other minutes carry on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainfeatures.config import REQUIRED_COLUMNS

QUALITY_COLUMNS = ("timestamp_int", "rows", "null_key_rows", "duplicate_keys", "valid", "error", "error_type")


def minute_facts(panel: DataFrame, footers: DataFrame | None = None) -> DataFrame:
    """One row per minute: the ``minute_quality`` columns, ``stockPrice`` (the minute's price) and, if the
    panel has it, ``path``.  With ``footers`` (path, rows) also minutes of which rows are missing or
    nothing could be read."""
    missing = [c for c in REQUIRED_COLUMNS if c not in panel.columns]
    if missing:  # of the whole panel: no minute is valid
        null = F.lit(None)
        path = F.col("path") if "path" in panel.columns else null.cast("string")
        return panel.groupBy("timestamp_int").agg(F.count(F.lit(1)).alias("rows"), F.min(path).alias("path")).select(
            "timestamp_int", "rows", null.cast("long").alias("null_key_rows"), null.cast("long").alias("duplicate_keys"),
            F.lit(False).alias("valid"), F.lit(f"Missing required columns: {missing}").alias("error"),
            F.lit("ValueError").alias("error_type"), null.cast("double").alias("stockPrice"), "path")
    path = F.min("path") if "path" in panel.columns else F.lit(None).cast("string")
    per_key = panel.groupBy("timestamp_int", "expirDate", "strike").agg(
        F.count(F.lit(1)).alias("_n"), F.min("stockPrice").alias("_lo"), F.max("stockPrice").alias("_hi"), path.alias("_path"))
    null_key = F.col("expirDate").isNull() | F.col("strike").isNull()
    facts = per_key.groupBy("timestamp_int").agg(
        F.sum("_n").alias("rows"), F.sum(F.when(null_key, F.col("_n")).otherwise(0)).alias("null_key_rows"),
        F.count_if((F.col("_n") > 1) & ~null_key).alias("duplicate_keys"),
        F.min("_lo").alias("stockPrice"), F.max("_hi").alias("_hi"), F.min("_path").alias("path"))
    short = F.lit(None).cast("string")
    if footers is not None:
        from chainfeatures.operators.keys import with_time_key

        held = with_time_key(footers.select("path", "rows"), "path").filter("valid").groupBy("timestamp_int").agg(
            F.sum("rows").alias("_held"), F.min("path").alias("_file"))
        facts = facts.join(held, "timestamp_int", "right").withColumn("path", F.coalesce("path", "_file"))
        short = F.when(F.coalesce("rows", F.lit(0)) != F.col("_held"), F.concat(
            F.lit("Read "), F.coalesce("rows", F.lit(0)).cast("string"), F.lit(" of "), F.col("_held").cast("string"), F.lit(" rows")))
    error = F.coalesce(short, F.when(F.col("null_key_rows") > 0, F.lit("Null expirDate or strike"))
                       .when(F.col("duplicate_keys") > 0, F.lit("Duplicate (expirDate, strike)"))
                       .when(F.col("_hi") > F.col("stockPrice"), F.lit("Several stockPrice values")))
    return facts.select(
        "timestamp_int", *[F.col(c).cast("long").alias(c) for c in ("rows", "null_key_rows", "duplicate_keys")],
        error.isNull().alias("valid"), error.alias("error"), F.when(error.isNotNull(), F.lit("ValueError")).alias("error_type"),
        "stockPrice", "path")


def minute_quality(panel: DataFrame) -> DataFrame:
    """One row per minute: rows, null_key_rows, duplicate_keys, valid, error, error_type."""
    return minute_facts(panel).select(*QUALITY_COLUMNS)


def split_valid(panel: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of valid minutes, per-minute quarantine records)."""
    bad = minute_quality(panel).filter(~F.col("valid"))
    return panel.join(bad.select("timestamp_int"), "timestamp_int", "left_anti"), bad
