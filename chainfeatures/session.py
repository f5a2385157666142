"""Session helpers: building a local session for tests/bench, the few SQL
settings the pipeline relies on, and the shared folder for materialised
intermediates.

Library functions never build their own session; they take the caller's.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the feature plan is designed around.  All are runtime SQL confs,
# so they can be applied to an existing session (``tune_session``).
PLAN_CONF = {
    # Runtime re-planning: coalesce small shuffle partitions, split skewed ones,
    # turn a sort-merge join into a broadcast once the real size is known.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The panel is hash-partitioned once by (expirDate, block); the node join on
    # (expirDate, block, minute_seq) and the contract window on
    # (expirDate, block, strike) both reuse that partitioning instead of
    # shuffling the panel again.  Safe here because ``block`` already bounds
    # the rows behind one (expirDate, block) key.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.session.timeZone": "UTC",
}


def tune_session(spark: SparkSession) -> SparkSession:
    for k, v in PLAN_CONF.items():
        spark.conf.set(k, v)
    # Folder listing runs as a Spark job with one task per directory up to this
    # many tasks; a few tasks per core lists thousands of date folders without
    # thousands of tiny tasks.
    par = spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", str(min(10000, max(64, 4 * par))))
    return spark


def build_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "chainfeatures", event_log_dir: str | None = None) -> SparkSession:
    """Local session for tests and the bench (the UI stays off)."""
    b = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.ui.enabled", "false")
         .config("spark.driver.memory", "16g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m"))
    if event_log_dir:
        b = (b.config("spark.eventLog.enabled", "true")
             .config("spark.eventLog.dir", event_log_dir))
    for k, v in PLAN_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    tune_session(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is.  Only
    where it is unset and the session is local (tests) do we create a folder of our own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="chainfeatures-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir().rstrip("/")


def shared_base(spark: SparkSession) -> str:
    """The configured shared folder itself (``spark.checkpoint.dir``), not the
    per-application subfolder Spark creates for RDD checkpoints, so tables
    materialised by one application can be reused by the next."""
    ensure_checkpoint_dir(spark)
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None)
    return (base or spark.sparkContext.getCheckpointDir()).rstrip("/")


def shared_path(spark: SparkSession, *parts: str) -> str:
    """A path inside the shared folder (for materialised tables)."""
    return "/".join([shared_base(spark), "chainfeatures", *parts])


def fresh_shared_path(spark: SparkSession, prefix: str) -> str:
    return shared_path(spark, f"{prefix}-{uuid.uuid4().hex[:12]}")


def materialize(df):
    """Reliable checkpoint (into ``spark.checkpoint.dir``) computed once.

    ``checkpoint(eager=True)`` alone runs the plan twice -- once to count, once
    more to write the checkpoint files; persisting first lets the write read
    the cached blocks.  The cache is dropped afterwards: later reads come from
    the checkpoint files, which survive executor loss."""
    from pyspark import StorageLevel

    ensure_checkpoint_dir(df.sparkSession)
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        out = df.checkpoint(eager=True)
    finally:
        df.unpersist()
    return out
