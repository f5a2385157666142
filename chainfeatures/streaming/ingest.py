"""Live ingestion: Structured Streaming over a folder of minute files.

The stream carries file names; each micro-batch (new ``strikes_*.parquet`` files):

1. parses the time key of every file and reads the footers; bad names, unreadable files
   and files without the required columns are rejected;
2. applies the chronology gate: a minute not later than the newest minute
   already written is rejected, as is a second file of a minute;
3. reads the accepted files, each with its own schema, and rejects minutes that fail
   validation (``operators.quality``);
4. numbers the valid minutes after the last known position (the ``positions`` table: one
   row per written minute, its ``minute_seq`` and source path); of these only the *tail* is read, a table of the last
   ``lookback`` positions that every batch writes for the next one;
5. reads the ``lookback`` minutes before the first new one from their source files as
   context, computes the features, keeps the new rows;
6. writes rows, positions, tail and rejects, each as the batch's own partition (``batch_id=<n>``),
   replaced when the batch is replayed: a retry at any step gives the same tables.

Only per-minute bookkeeping is kept between batches; the panel rows of the
look-back are re-read from the source, so no state grows with the chain width.  What a batch reads is its own files,
one tail and ``lookback`` files, however many batches there were; tails that no replay can ask for are deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chainfeatures.config import FeatureParams
from chainfeatures.functions.frames import SEQ
from chainfeatures.operators.keys import with_time_key
from chainfeatures.operators.quality import minute_facts
from chainfeatures.plans.pipeline import compute_features
from chainfeatures.plans.registry import FeatureRegistry, create_default_registry
from chainfeatures.plans.sinks import batch_ids, hadoop_delete, hadoop_exists, write_batch
from chainfeatures.session import materialize
from chainfeatures.sources.snapshots import file_footers, footer_failures, scan_snapshots

STATE_SCHEMA = T.StructType([
    T.StructField("timestamp_int", T.LongType()),
    T.StructField(SEQ, T.LongType()),
    T.StructField("path", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])
TAIL_SCHEMA = T.StructType(STATE_SCHEMA.fields[:3])
STREAM_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def _tail(spark: SparkSession, state: str, epoch: int, lookback: int) -> list:
    """The last positions before batch ``epoch``, oldest first: at most ``lookback`` rows (at least the newest).

    A replay sees what its first run saw: the tail of the last batch before it.  A state without tails (written by an
    earlier release, or for a smaller look-back) is read from the positions, once."""
    batches = batch_ids(spark, f"{state}/tail")
    before = max((b for b in batches if b < epoch), default=None)
    if before is not None:
        rows = spark.read.schema(TAIL_SCHEMA).parquet(f"{state}/tail/batch_id={before}").collect()
        if len(rows) >= lookback or rows and min(r[SEQ] for r in rows) == 1:
            return sorted(rows, key=lambda r: r[SEQ])[-lookback:]
    if not hadoop_exists(spark, f"{state}/positions"):
        return []
    known = spark.read.schema(STATE_SCHEMA).parquet(f"{state}/positions").filter(F.col("batch_id") < epoch)
    return sorted(known.select(*TAIL_SCHEMA.names).orderBy(F.desc(SEQ)).limit(lookback).collect(), key=lambda r: r[SEQ])


def _write_tail(spark: SparkSession, rows: list, state: str, epoch: int) -> None:
    write_batch(spark.createDataFrame(rows, TAIL_SCHEMA).coalesce(1), f"{state}/tail", epoch)
    earlier = [b for b in batch_ids(spark, f"{state}/tail") if b < epoch]
    for b in earlier[:-1]:  # a replay of this batch reads the last earlier one
        hadoop_delete(spark, f"{state}/tail/batch_id={b}")


def process_batch(batch: DataFrame, epoch: int, sink: str, state: str,
                  registry: FeatureRegistry | None = None, params: FeatureParams | None = None) -> None:
    """One micro-batch: ``batch`` has the ``path`` of each new file."""
    spark = batch.sparkSession
    reg = registry or create_default_registry()
    lookback = reg.max_lookback()
    paths = [r["path"] for r in batch.select("path").distinct().collect()]  # at most maxFilesPerTrigger
    if not paths:
        return
    tail = _tail(spark, state, epoch, lookback)
    newest_t, newest_s = (tail[-1]["timestamp_int"], tail[-1][SEQ]) if tail else (-1, 0)

    footers = materialize(file_footers(spark, paths))
    bad = footer_failures(footers)
    files = with_time_key(footers.select("path", "rows"), "path").join(bad, "path", "left")
    first = F.row_number().over(Window.partitionBy("timestamp_int").orderBy(F.col("error").isNotNull(), "path"))
    files = files.withColumn("_n", first).select(
        "path", "rows", "timestamp_int",
        F.when(~F.col("valid"), F.lit("Invalid filename format")).when(F.col("error").isNotNull(), F.col("error"))
        .when(F.col("timestamp_int") <= F.lit(newest_t), F.lit("Not later than the newest minute"))
        .when(F.col("_n") > 1, F.lit("Another file of the minute was taken")).alias("error"))
    files = materialize(files)
    taken = files.filter(F.col("error").isNull())
    new_rows = facts = None
    if not taken.isEmpty():
        chosen = materialize(footers.join(taken.select("path"), "path", "left_semi"))
        new_rows = scan_snapshots(spark, [r["path"] for r in taken.select("path").collect()], footers=chosen, tolerant=True)
        facts = materialize(minute_facts(new_rows, chosen))
    rejected = files.filter(F.col("error").isNotNull()).select("timestamp_int", "path", "error")
    if facts is not None:
        rejected = rejected.unionByName(facts.filter("NOT valid").select("timestamp_int", "path", "error"))
    write_batch(rejected, f"{state}/rejected", epoch)
    if facts is None or facts.filter("valid").isEmpty():
        return
    # a batch holds at most maxFilesPerTrigger minutes, so this window is bounded
    fresh = materialize(facts.filter("valid").select(
        "timestamp_int", "path", "stockPrice", (F.lit(newest_s) + F.row_number().over(Window.orderBy("timestamp_int"))).cast("long").alias(SEQ)))
    ctx = spark.createDataFrame(tail, TAIL_SCHEMA)
    ctx_paths = [r["path"] for r in tail]  # at most ``lookback`` paths: one row per position
    panel = new_rows.join(fresh.select("timestamp_int"), "timestamp_int", "left_semi").drop("path")
    spine = fresh.select("timestamp_int", SEQ, "stockPrice")
    if ctx_paths:
        old = scan_snapshots(spark, ctx_paths).drop("path")
        # positions are global, so gates and look-backs equal a batch recompute
        spine = spine.unionByName(ctx.select("timestamp_int", SEQ).join(
            old.groupBy("timestamp_int").agg(F.min("stockPrice").alias("stockPrice")), "timestamp_int", "left"))
        panel = panel.unionByName(old.select([c for c in old.columns if c in panel.columns]), allowMissingColumns=True)
    out = compute_features(panel, registry=reg, params=params, spine=spine,
                           spine_rows=lookback + fresh.count(),
                           keep=F.col(SEQ) > F.lit(newest_s))
    write_batch(out, sink, epoch)
    write_batch(fresh.select("timestamp_int", SEQ, "path"), f"{state}/positions", epoch)
    last = fresh.select(*TAIL_SCHEMA.names).orderBy(F.desc(SEQ)).limit(lookback).collect()
    _write_tail(spark, (tail + sorted(last, key=lambda r: r[SEQ]))[-lookback:], state, epoch)


def start_stream(spark: SparkSession, source: str, sink: str, state: str, checkpoint: str,
                 max_files_per_trigger: int = 100, registry: FeatureRegistry | None = None,
                 params: FeatureParams | None = None, available_now: bool = True):
    """Start the ingestion query over ``source`` (reference layout minute files)."""
    stream = (spark.readStream.format("binaryFile").schema(STREAM_SCHEMA)
              .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
              .option("maxFilesPerTrigger", max_files_per_trigger)
              .option("maxFileAge", "36500d")
              .load(source)
              .select("path"))
    writer = (stream.writeStream
              .foreachBatch(lambda df, epoch: process_batch(df, epoch, sink, state, registry, params))
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()
