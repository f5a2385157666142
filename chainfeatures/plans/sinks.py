"""Sinks: the enriched table, and minute files in the reference layout."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MINUTE_FILE_SCHEMA = T.StructType([
    T.StructField("timestamp_int", T.LongType()),
    T.StructField("path", T.StringType()),
    T.StructField("rows", T.LongType()),
])


def write_enriched(df: DataFrame, dest: str) -> None:
    """Write enriched rows partitioned by minute (``date=``/``minute=``
    directories), overwriting only the minutes present in ``df`` (dynamic
    partition overwrite), so re-running a minute is idempotent.

    Rows are hash-partitioned by minute first (an explicit count, so AQE does
    not fold many minutes into one writer): every minute is written by exactly
    one task, as one file, like the reference's one object per minute; a
    minute is one snapshot, so no writer task is unbounded."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (df.repartition(n, "date", "minute").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("date", "minute").parquet(dest))


def write_batch(df: DataFrame, dest: str, batch_id: int) -> None:
    """Write one micro-batch's rows as partition ``batch_id=<id>`` of ``dest``,
    replacing that partition only: a replayed batch rewrites the same folder
    (idempotent) and the number of folders grows with batches, not minutes."""
    from pyspark.sql import functions as F

    (df.withColumn("batch_id", F.lit(int(batch_id))).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(dest))


def write_minute_files(panel: DataFrame, root: str, drop=("timestamp_int", "date", "minute", "path")) -> DataFrame:
    """Export one parquet file per minute in the reference layout
    ``<root>/one-minute/YYYYMMDD/strikes_YYYYMMDDHHMM.parquet`` (rows sorted by
    expirDate, strike).  Grouped by minute: each task writes whole minutes,
    never more than one snapshot per call; a retried task rewrites the same
    file.  Local files get the minute as modification time, so a file-stream
    source sees them in time order.  Returns (timestamp_int, path, rows);
    lazy, like any DataFrame.
    """
    keep = [c for c in panel.columns if c not in drop]
    root = root.rstrip("/")

    def write_minute(pdf):
        import calendar
        import datetime as dt

        import pandas as pd
        import pyarrow as pa
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        ts = int(pdf["timestamp_int"].iloc[0])
        stamp = f"{ts:012d}"
        uri = f"{root}/one-minute/{stamp[:8]}/strikes_{stamp}.parquet"
        body = pdf[keep].sort_values(["expirDate", "strike"], kind="mergesort")
        table = pa.Table.from_pandas(body, preserve_index=False)
        fs, path = pafs.FileSystem.from_uri(uri)
        fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
        pq.write_table(table, path, filesystem=fs)
        if isinstance(fs, pafs.LocalFileSystem):
            t = calendar.timegm(dt.datetime.strptime(stamp, "%Y%m%d%H%M").timetuple())
            os.utime(path, (t, t))
        return pd.DataFrame({"timestamp_int": [ts], "path": [uri], "rows": [len(pdf)]})

    return panel.groupBy("timestamp_int").applyInPandas(write_minute, MINUTE_FILE_SCHEMA)


def hadoop_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def hadoop_touch(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(p, True).close()


def hadoop_delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def batch_ids(spark: SparkSession, dest: str) -> list[int]:
    """The batches that ``write_batch`` has written to ``dest``, ascending."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{dest}/batch_id=*")
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p) or []
    return sorted(int(s.getPath().getName().split("=")[1]) for s in found)
