"""Materialised inputs derived from the driver's tables.

The derived chain (``sources.chain``) is written once per test-data folder
into the shared checkpoint folder, as a table and as minute files in the
reference layout; later queries read them like any snapshot store.  A marker
file makes a half-written copy invisible.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainfeatures.plans.sinks import hadoop_exists, hadoop_touch, write_minute_files
from chainfeatures.session import shared_path
from chainfeatures.sources.chain import derived_chain


#: Raise when what is derived from the tables changes, so that no older copy is read.
FIXTURE_VERSION = 2


def _state(spark: SparkSession, path: str) -> str:
    """Length and modification time of a table, asked of whatever store holds it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return "none"
    return f"{fs.getContentSummary(p).getLength()}|{fs.getFileStatus(p).getModificationTime()}"


def _tag(spark: SparkSession, sf_dir: str, table: str = "lineitem") -> str:
    raw = f"{FIXTURE_VERSION}|{sf_dir.rstrip('/')}|{_state(spark, f'{sf_dir}/{table}.parquet')}"
    return hashlib.sha256(raw.encode()).hexdigest()[:12]


def chain_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived chain as a parquet table (sorted by minute, expiry, strike)."""
    path = shared_path(spark, "tables", f"chain-{_tag(spark, sf_dir)}")
    if not hadoop_exists(spark, f"{path}/_READY"):
        (derived_chain(spark, sf_dir).repartitionByRange("timestamp_int")
         .sortWithinPartitions("timestamp_int", "expirDate", "strike")
         .write.mode("overwrite").parquet(path))
        hadoop_touch(spark, f"{path}/_READY")
    return spark.read.parquet(path)


def chain_minute_files(spark: SparkSession, sf_dir: str) -> str:
    """Root folder of the chain as one ``strikes_*.parquet`` file per minute."""
    root = shared_path(spark, "tables", f"minutes-{_tag(spark, sf_dir)}")
    if not hadoop_exists(spark, f"{root}/_READY"):
        write_minute_files(chain_table(spark, sf_dir), root).write.format("noop").mode("overwrite").save()
        hadoop_touch(spark, f"{root}/_READY")
    return root


def spine_store(spark: SparkSession, sf_dir: str):
    """The chain's minutes as a stored spine (``operators.stored_spine``), in slabs of a month."""
    from chainfeatures.operators import stored_spine
    from chainfeatures.plans.store import SlabStore

    store = SlabStore(spark, shared_path(spark, "tables", f"spine-{_tag(spark, sf_dir)}"), slab_chars=6)
    if not store.exists():
        minutes = chain_table(spark, sf_dir).groupBy("timestamp_int").agg(F.min("stockPrice").alias("stockPrice"))
        store.commit({stored_spine.TABLE: (stored_spine.ranked(store, minutes), None)})
    return store


def names_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event-derived object names (``sources.names``) as a table, so later
    parsing works on stored strings, as it would on a real listing."""
    from chainfeatures.sources.names import event_names

    path = shared_path(spark, "tables", f"names-{_tag(spark, sf_dir, 'events')}")
    if not hadoop_exists(spark, f"{path}/_READY"):
        event_names(spark, sf_dir).write.mode("overwrite").parquet(path)
        hadoop_touch(spark, f"{path}/_READY")
    return spark.read.parquet(path)

