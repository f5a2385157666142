"""Object names derived from the driver's ``events`` table.

The test data has no object store, so a stream of snapshot names is derived:
each event's ``ts`` becomes ``strikes_<yyyyMMddHHmm>.parquet`` under
``one-minute/<yyyyMMdd>/``; every 7th event (``event_id % 7 = 0``) is broken in
one of four ways, chosen by ``(event_id / 7) % 4``: a wrong prefix, month 13,
hour 24, a ``.tmp`` suffix.  Arrival order is ``event_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainfeatures.sources.chain import read_table

SOURCE_BUCKET = "source-bucket"
PREFIX = "one-minute"


def event_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, ts, name, key, uri): one snapshot name per event."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts")
    stamp = F.date_format("ts", "yyyyMMddHHmm")
    day = F.date_format("ts", "yyyyMMdd")
    kind = F.expr("CAST(event_id DIV 7 AS INT) % 4")
    good = F.concat(F.lit("strikes_"), stamp, F.lit(".parquet"))
    broken = (F.when(kind == 0, F.concat(F.lit("xstrikes_"), stamp, F.lit(".parquet")))
              .when(kind == 1, F.concat(F.lit("strikes_"), F.substring(stamp, 1, 4), F.lit("13"),
                                        F.substring(stamp, 7, 6), F.lit(".parquet")))
              .when(kind == 2, F.concat(F.lit("strikes_"), F.substring(stamp, 1, 8), F.lit("24"),
                                        F.substring(stamp, 11, 2), F.lit(".parquet")))
              .otherwise(F.concat(F.lit("strikes_"), stamp, F.lit(".parquet.tmp"))))
    name = F.when(F.col("event_id") % 7 == 0, broken).otherwise(good)
    key = F.concat(F.lit(PREFIX + "/"), day, F.lit("/"), name)
    return ev.select("event_id", "ts", name.alias("name"), key.alias("key"),
                     F.concat(F.lit(f"s3://{SOURCE_BUCKET}/"), key).alias("uri"))


def uri_variants(named: DataFrame) -> DataFrame:
    """(event_id, uri) with a few malformed URIs: no scheme (``event_id % 11 = 0``),
    bucket without key (``event_id % 11 = 1``)."""
    uri = (F.when(F.col("event_id") % 11 == 0, F.col("key"))
           .when(F.col("event_id") % 11 == 1, F.lit(f"s3://{SOURCE_BUCKET}"))
           .otherwise(F.col("uri")))
    return named.select("event_id", uri.alias("uri"))
