"""Option-chain panel derived from the driver's ``lineitem`` table.

The test data has no option chain, so one is derived: a ship day is one
"minute", a return flag one expiry, a line number one strike.  Every column is
a min/max/whole-number aggregate, so values do not depend on row order and the
same SQL text reproduces them in another engine (see ``chainfeatures.oracle``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chainfeatures.functions.timekeys import timestamp_int_of


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def derived_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (ship day, flag, line number); time key columns included."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_shipdate", "l_returnflag", "l_linenumber", "l_extendedprice", "l_quantity",
        "l_discount", "l_tax", "l_partkey")
    day_price = li.groupBy("l_shipdate").agg(
        F.when(F.dayofmonth("l_shipdate") == 13, F.lit(0.0))
        .otherwise(F.max("l_extendedprice") / 100).alias("stockPrice"))
    cells = li.groupBy("l_shipdate", "l_returnflag", "l_linenumber").agg(
        F.when(F.max("l_tax") == 0, F.lit(0.0)).otherwise(F.max("l_extendedprice") / 1000).alias("CallMid"),
        (F.min("l_extendedprice") / 1000).alias("PutMid"),
        (F.max("l_extendedprice") / F.max("l_quantity") / 10000).alias("CallIVMid"),
        (F.min("l_extendedprice") / F.max("l_quantity") / 10000).alias("PutIVMid"),
        F.nullif(F.max("l_discount"), F.lit(0.0)).alias("CallSpreadPct"),
        F.nullif(F.min("l_discount"), F.lit(0.0)).alias("PutSpreadPct"),
        F.max("l_tax").alias("CallGamma"),
        F.sum("l_quantity").alias("callVolume"),
        F.count(F.lit(1)).cast("double").alias("putVolume"),
        F.sum(F.col("l_partkey") % 100).cast("long").alias("oi_raw"),
    )
    w = Window.partitionBy("l_shipdate", "l_returnflag")
    chain = cells.join(day_price, "l_shipdate").select(
        timestamp_int_of(F.col("l_shipdate")).alias("timestamp_int"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("date"),
        F.date_format("l_shipdate", "HHmm").alias("minute"),
        F.col("l_returnflag").alias("expirDate"),
        F.col("l_linenumber").cast("double").alias("strike"),
        (F.col("l_linenumber") - 4).alias("distance_to_atm"),
        "stockPrice", "CallMid", "PutMid", "CallIVMid", "PutIVMid", "CallSpreadPct",
        "PutSpreadPct", "CallGamma", "callVolume", "putVolume",
        F.percent_rank().over(w.orderBy("CallIVMid")).alias("IVPercentile_Expiry"),
        F.percent_rank().over(w.orderBy("callVolume")).alias("VolumePercentile_Expiry"),
        F.percent_rank().over(w.orderBy("oi_raw")).alias("OIPercentile_Expiry"),
    )
    return chain


CHAIN_COLUMNS = (
    "timestamp_int", "date", "minute", "expirDate", "strike", "distance_to_atm", "stockPrice",
    "CallMid", "PutMid", "CallIVMid", "PutIVMid", "CallSpreadPct", "PutSpreadPct", "CallGamma",
    "callVolume", "putVolume", "IVPercentile_Expiry", "VolumePercentile_Expiry", "OIPercentile_Expiry",
)
