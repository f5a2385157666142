"""Jobs built from the operators: incremental (backfill) runs, live runs,
lineage records.

An incremental run reads only what it needs: the new minutes and, before each
of them, the deepest look-back (30 valid minutes) of context.  The spine
itself (one row per minute) is global, so positions -- and therefore every
feature -- equal a full recompute.
"""

from __future__ import annotations

import time
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainfeatures.config import HISTORY_PRELOAD_DAYS, HISTORY_PRELOAD_MINUTES, FeatureParams
from chainfeatures.functions.frames import SEQ
from chainfeatures.functions.rounding import half_even_sql
from chainfeatures.operators import timeline
from chainfeatures.operators.keys import with_time_key
from chainfeatures.operators.quality import minute_facts
from chainfeatures.plans.pipeline import build_spine, compute_features, normalise_panel
from chainfeatures.plans.registry import FeatureRegistry, create_default_registry
from chainfeatures.plans.store import SlabStore
from chainfeatures.session import materialize
from chainfeatures.sources.checksums import object_checksums
from chainfeatures.sources.snapshots import file_footers, footer_failures, list_files, scan_snapshots


def context_minutes(spine: DataFrame, new_minutes: DataFrame, lookback: int) -> DataFrame:
    """(timestamp_int, minute_seq, stockPrice, is_new) of the minutes an incremental run must read:
    every new minute and the ``lookback`` positions before each one."""
    sp = spine.select("timestamp_int", SEQ, "stockPrice")
    new = new_minutes.select("timestamp_int").distinct().join(sp.select("timestamp_int", SEQ), "timestamp_int")
    need = new.select(F.explode(F.sequence(F.col(SEQ) - lookback, F.col(SEQ))).alias(SEQ)).distinct()
    return (sp.join(need, SEQ).join(new.select("timestamp_int", F.lit(True).alias("is_new")),
                                    "timestamp_int", "left")
            .select("timestamp_int", SEQ, "stockPrice", F.coalesce("is_new", F.lit(False)).alias("is_new")))


def needed_dates(minutes: DataFrame) -> list[str]:
    """The calendar days of ``minutes``: one value per day, to prune scans by."""
    day = F.lpad(F.floor(F.col("timestamp_int") / 10000).cast("string"), 8, "0")
    return sorted(r["d"] for r in minutes.select(day.alias("d")).distinct().collect())


def run_incremental(panel: DataFrame, new_minutes: DataFrame, registry: FeatureRegistry | None = None,
                    params: FeatureParams | None = None, spine: DataFrame | None = None,
                    spine_rows: int | None = None, need: DataFrame | None = None, prune: bool = True) -> DataFrame:
    """Features of the rows of ``new_minutes`` only, identical to a full
    recompute.  ``panel`` is the whole source (a lazy scan).  Where it has a ``date`` column, only
    the days of the needed minutes are read: a filter on the date prunes partitions, or row
    groups of a sorted table.  Pass a stored ``spine`` (one row per valid minute) to spare the pass
    over the minutes as well (``prune=False``: the panel holds nothing but the needed minutes).  Context rows are dropped before the final projection."""
    reg = registry or create_default_registry()
    if spine is None:
        spine, spine_rows = build_spine(normalise_panel(panel.select("timestamp_int", "stockPrice")))
    if need is None:
        need = materialize(context_minutes(spine, new_minutes, reg.max_lookback()))  # one row per needed minute
    if prune and "date" in panel.columns:
        panel = panel.filter(F.col("date").isin(needed_dates(need)))
    small = spine_rows is not None and spine_rows <= timeline.SPINE_BROADCAST_MAX_ROWS  # need ⊆ spine
    flags = need.select("timestamp_int", "is_new")
    rows = panel.join(F.broadcast(flags) if small else flags, "timestamp_int", "inner")
    # the needed minutes with their global positions are all of the spine that is used from here on
    out = compute_features(rows, registry=reg, params=params, spine=need.drop("is_new"), spine_rows=spine_rows, keep=F.col("is_new"))
    return out.drop("is_new")


def run_live(panel: DataFrame, minute_ts: int, registry: FeatureRegistry | None = None,
             params: FeatureParams | None = None, history_days: int = HISTORY_PRELOAD_DAYS,
             history_minutes: int = HISTORY_PRELOAD_MINUTES) -> tuple[DataFrame, DataFrame]:
    """One minute against its preloaded history: the newest ``history_minutes``
    earlier valid minutes from its date and the ``history_days`` days before.
    Gates count that loaded history (as a freshly started queue would).

    Returns (rows with features, one-row metadata).
    """
    reg = registry or create_default_registry()
    params = params or FeatureParams()
    start, spark = time.time(), panel.sparkSession
    # only the days that can hold the history are looked at, and of them only the minutes' names first:
    # the newest listed ones are taken, then invalid ones dropped without replacement.  What is collected is
    # a row for each of at most ``history_minutes`` + 1 minutes, so the spine is known here and nothing is stored.
    stamp = f"{int(minute_ts):012d}"
    first = (datetime.strptime(stamp[:8], "%Y%m%d") - timedelta(days=history_days)).strftime("%Y%m%d")
    recent = panel.filter((F.col("timestamp_int") >= F.lit(int(first) * 10000)) & (F.col("timestamp_int") <= F.lit(minute_ts)))
    if "date" in panel.columns:
        recent = recent.filter((F.col("date") >= F.lit(first)) & (F.col("date") <= F.lit(stamp[:8])))
    listed = recent.select("timestamp_int").distinct().orderBy(F.desc("timestamp_int")).limit(min(history_minutes, params.window_size) + 1)
    names = [r["timestamp_int"] for r in listed.collect()]
    rows = recent.filter(F.col("timestamp_int").isin(names))
    facts = {r["timestamp_int"]: r for r in minute_facts(normalise_panel(rows)).collect()}
    asked = facts.get(int(minute_ts))
    if asked is not None and not asked["valid"]:
        raise ValueError(asked["error"])
    valid = sorted(t for t, r in facts.items() if r["valid"])
    spine = spark.createDataFrame([(t, k + 1, facts[t]["stockPrice"]) for k, t in enumerate(valid)], f"timestamp_int long, {SEQ} long, stockPrice double").coalesce(1)
    out = compute_features(rows.filter(F.col("timestamp_int").isin(valid)), registry=reg, params=params, spine=spine, spine_rows=len(valid),
                           keep=F.col("timestamp_int") == F.lit(minute_ts), store_nodes=False)
    in_cols = [c for c in panel.columns if c not in ("timestamp_int", "date", "minute", "path")]
    loaded = sum(t < int(minute_ts) for t in valid)
    known = [(len(in_cols) + len(reg.get_active_features()), asked["rows"] if asked else 0, stamp[:8], stamp[8:], asked["stockPrice"] if asked else None,
              reg.compute_version_hash(), min(loaded + 1, params.window_size), int(1000 * (time.time() - start)))]
    # time up to here: history read and validated; the rows themselves are computed by the caller's action
    meta = spark.createDataFrame(known, "feature_count int, row_count long, date string, minute string, stock_price double, "
                                        "feature_version_hash string, history_minutes_loaded long, processing_time_ms long")
    return out, meta.withColumn("stock_price", F.expr(half_even_sql("stock_price", params.precision)))


def live_envelope(rows: DataFrame, meta: DataFrame) -> DataFrame:
    """The live answer as one record ``{data, metadata}``: an array of row records (one snapshot) and the metadata."""
    cols = [F.col(f"`{c}`") for c in rows.columns if c != "path"]
    data = rows.agg(F.collect_list(F.struct(*cols)).alias("data"))  # one snapshot
    one = F.lit(1).alias("_one")  # one row on either side
    return data.select("data", one).join(meta.select(F.struct("*").alias("metadata"), one), "_one").select(
        F.to_json(F.struct("data", "metadata"), {"ignoreNullFields": "false"}).alias("response"))


def live_records(enriched: DataFrame) -> DataFrame:
    """Rows as JSON records (every column, nulls kept)."""
    cols = [c for c in enriched.columns if c not in ("path",)]
    return enriched.select("timestamp_int", F.to_json(F.struct(*[F.col(f"`{c}`") for c in cols]),
                                                      {"ignoreNullFields": "false"}).alias("record"))


def lineage_manifest(checksums: DataFrame, minutes: DataFrame, registry: FeatureRegistry | None = None) -> DataFrame:
    """Per written minute: source path, source checksum ('' when unknown),
    feature-set hash and processing time (UTC, ISO with 'Z').
    ``checksums``: (path, md5); ``minutes``: (timestamp_int, date, minute, path)."""
    reg = registry or create_default_registry()
    now = datetime.now(timezone.utc).replace(tzinfo=None).isoformat() + "Z"
    return (minutes.join(checksums.select("path", "md5"), "path", "left")
            .select("timestamp_int", "date", "minute", F.col("path").alias("source_path"),
                    F.coalesce("md5", F.lit("")).alias("source_data_checksum"),
                    F.lit(reg.compute_version_hash()).alias("feature_version_hash"),
                    F.lit(now).alias("processing_timestamp")))


#: What the store keeps of every file: its footer, checksum, and the facts of its minute.
FILES = ("path", "date", "length", "modificationTime", "timestamp_int", "rows", "fields", "md5", "valid", "stockPrice", "error", "error_type")


def describe_files(spark: SparkSession, listed: DataFrame, root: str | None, part_bytes: int | None = None) -> DataFrame:
    """A row of FILES for each listed file (path, length, modificationTime); files are opened here and nowhere
    else.  ``root``: set where the files are all of that folder.  ``part_bytes``: the store's upload parts (``object_checksums``)."""
    paths = root or [r["path"] for r in listed.select("path").collect()]  # of the files that are new to the store
    footers = materialize(file_footers(spark, paths, files=listed))
    named = with_time_key(footers.select("path"), "path").select("path", F.col("valid").alias("named"), F.when(F.col("valid"), F.col("timestamp_int")).alias("timestamp_int"))
    bad = footer_failures(footers).select("path", F.col("error").alias("bad"), F.col("error_type").alias("kind"))
    files = materialize(footers.join(named, "path").join(bad, "path", "left"))
    sound = materialize(files.filter("named AND bad IS NULL").select("path", "length", "rows", "fields", "error"))
    facts = None
    if not sound.isEmpty():
        every = root if root and sound.count() == files.count() else [r["path"] for r in sound.select("path").collect()]
        facts = minute_facts(scan_snapshots(spark, every, footers=sound, tolerant=True), sound)
        facts = facts.select("timestamp_int", "valid", "stockPrice", F.col("error").alias("fault"), F.col("error_type").alias("fault_kind"))
    else:
        facts = spark.createDataFrame([], "timestamp_int long, valid boolean, stockPrice double, fault string, fault_kind string")
    sums = object_checksums(spark, paths, files=listed, part_bytes=part_bytes).select("path", F.col("checksum").alias("md5"))
    name_error = "Invalid filename format: expected strikes_YYYYMMDDHHMM.parquet"
    ok = F.col("named") & F.col("bad").isNull()
    stamp = F.lpad(F.col("timestamp_int").cast("string"), 12, "0")
    return (files.drop("error").join(listed.select("path", "modificationTime"), "path").join(sums, "path", "left").join(facts, "timestamp_int", "left")
            .select("path", F.coalesce(F.substring(stamp, 1, 8), F.lit("unnamed")).alias("date"), "length", "modificationTime", "timestamp_int", "rows", "fields", "md5",
                    F.coalesce(ok & F.col("valid"), F.lit(False)).alias("valid"), "stockPrice",
                    F.when(~F.col("named"), F.lit(name_error)).when(F.col("bad").isNotNull(), F.col("bad")).otherwise(F.col("fault")).alias("error"),
                    F.when(~F.col("named"), F.lit("ValueError")).when(F.col("bad").isNotNull(), F.col("kind")).otherwise(F.col("fault_kind")).alias("error_type")))


def file_changes(spark: SparkSession, root: str, store: SlabStore, part_bytes: int | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(all files now, files that were described in this run, files gone or replaced): the listing against the stored catalog.

    A file is known by path, length and modification time.  The files of a minute are judged together, so where one of
    them came or went, the others are described again."""
    listed = list_files(spark, root)
    known = store.read("files")
    if known is None:
        now = materialize(describe_files(spark, materialize(listed), root, part_bytes))
        return now, now, now.limit(0)
    key = ["path", "length", "modificationTime"]
    listed, known = materialize(listed), materialize(known)
    new = listed.join(known.select(*key), key, "left_anti")
    gone = materialize(known.join(listed, key, "left_anti"))
    touched = with_time_key(new.select("path"), "path").filter("valid").select("timestamp_int").unionByName(gone.select("timestamp_int")).distinct()
    again = known.join(gone.select("path"), "path", "left_anti").join(touched, "timestamp_int", "left_semi").select(*key)
    todo = materialize(new.unionByName(again))
    described = materialize(describe_files(spark, todo, None, part_bytes)) if not todo.isEmpty() else known.limit(0)
    kept = known.join(gone.select("path"), "path", "left_anti").join(described.select("path"), "path", "left_anti")
    return materialize(kept.select(*FILES).unionByName(described.select(*FILES))), described, gone


def _slabs(store: SlabStore, *frames: DataFrame) -> list[str]:
    """The slabs of some rows with a date: one value for each."""
    out: set = set()
    for df in frames:
        out |= {r["s"] for r in df.select(store.slab_of("date").alias("s")).distinct().collect()}
    return sorted(out - {None})


def _dated(minutes: DataFrame) -> DataFrame:
    stamp = F.lpad(F.col("timestamp_int").cast("string"), 12, "0")
    return minutes.withColumn("date", F.substring(stamp, 1, 8)).withColumn("minute", F.substring(stamp, 9, 4))


def run_batch(spark, source_root: str, dest: str, registry: FeatureRegistry | None = None,
              params: FeatureParams | None = None, new_only: bool = True, slab_chars: int = 8, part_bytes: int | None = None) -> dict:
    """The batch event as one Spark job over a snapshot folder (reference layout) into a store (``plans.store``)
    with the tables ``files`` (the catalog), ``spine``, ``rows`` (enriched) and ``lineage``:

    1. the listing is compared with the catalog; only files that are new or changed are opened: footer, checksum and
       the facts of their minute (bad names, unreadable or empty files, missing columns, null or repeated keys and
       several prices are failures of that file);
    2. minutes that came, changed or went are merged into the stored spine, slab by slab;
    3. they and the look-back positions after each of them are computed (``new_only=False``: all), reading
       only the files of these minutes and of the look-back before them, so the destination equals a
       full recompute whatever the order in which minutes arrive;
    4. rows, lineage, spine and catalog are committed in one step: a crash anywhere before leaves the store as it was.

    ``part_bytes``: the part size of uploads to the source store, for checksums equal to the store's; None: plain MD5.

    Returns DataFrames: ``failures`` (uri, error, error_type: of all files there are), ``written`` (timestamp_int), ``manifest``
    (the lineage of all rows), ``outcomes`` (per date and total: completed, failed, status), ``summary`` (one row:
    success_count, failure_count) and ``opened`` (path: files whose footers, or whose rows, were read).
    """
    from chainfeatures.operators import stored_spine
    from chainfeatures.operators.worklist import run_summary

    reg = registry or create_default_registry()
    lookback = max(reg.max_lookback(), 1)
    store = SlabStore(spark, dest, slab_chars)
    files, described, gone = file_changes(spark, source_root, store, part_bytes)
    good = files.filter("valid").groupBy("timestamp_int").agg(F.min("stockPrice").alias("stockPrice"), F.min("path").alias("path"))
    touched = described.select("timestamp_int").unionByName(gone.select("timestamp_int")).filter("timestamp_int IS NOT NULL").distinct()
    touched = materialize(touched.join(good, "timestamp_int", "left").withColumn("there", F.col("path").isNotNull()))
    added, removed = touched.filter("there"), touched.filter("NOT there").select("timestamp_int")
    opened, todo, changes = described.select("path"), touched.filter("there").select("timestamp_int"), {}
    failures = files.filter(F.col("error").isNotNull()).select(F.col("path").alias("uri"), "error", "error_type")
    if not touched.isEmpty() or not described.isEmpty() or not gone.isEmpty() or not new_only:
        slabs = _slabs(store, _dated(touched))
        minutes = materialize(stored_spine.merged(store, added, removed, slabs))
        counts = {s: n for s, n in store.slabs(stored_spine.TABLE).items() if s not in slabs}
        counts |= {r["s"]: r["count"] for r in minutes.groupBy(store.slab_of("date").alias("s")).count().collect()}
        ranks, held = minutes, store.read(stored_spine.TABLE, set(counts) - set(slabs))
        if held is not None:
            ranks = ranks.unionByName(held.select(*ranks.columns))
        spine = materialize(stored_spine.numbered(spark, ranks, counts, slab_chars))  # one row for each minute
        n_minutes = sum(counts.values())
        todo = materialize(spine.select("timestamp_int") if not new_only else stored_spine.stale_minutes(spine, touched, lookback).distinct())
        changes["files"] = files, _slabs(store, described, gone)
        changes["spine"] = minutes, slabs
        there = todo.join(good, "timestamp_int").select("timestamp_int", "path")
        out_slabs = _slabs(store, _dated(todo), _dated(removed))
        replaced = todo.select("timestamp_int").unionByName(removed)
        fresh = None
        if not todo.isEmpty():
            need = materialize(context_minutes(spine, todo, lookback))
            sources = files.filter("valid").join(need.select("timestamp_int"), "timestamp_int", "left_semi")
            sources = materialize(sources.select("path", "length", "rows", "fields", F.lit(None).cast("string").alias("error")))
            whole = sources.count() == files.count()
            paths = source_root if whole else [r["path"] for r in sources.select("path").collect()]  # of the needed minutes
            opened = opened.unionByName(sources.select("path")).distinct()
            rows = scan_snapshots(spark, paths, footers=sources, tolerant=True).drop("path")
            fresh = run_incremental(rows, todo, registry=reg, params=params, spine=spine, spine_rows=n_minutes, need=need, prune=False)
            lineage = lineage_manifest(files.select("path", "md5"), _dated(there), reg)
        for table, new in (("rows", fresh), ("lineage", lineage if fresh is not None else None)):
            old = store.read(table, set(out_slabs))
            if old is not None:
                old = old.join(replaced, "timestamp_int", "left_anti")
                new = old if new is None else new.unionByName(old, allowMissingColumns=True)
            if new is not None:
                changes[table] = new, out_slabs
        # a minute lies in the files' slab of its date; unnamed files have one of their own
        inside = store.slab_of("date").isin(changes["files"][1])
        changes["files"] = files.filter(inside), changes["files"][1]
        store.commit(changes)
    outcome = todo.join(good, "timestamp_int").select(F.col("path").alias("uri"), F.lit(True).alias("ok")).unionByName(failures.select("uri", F.lit(False).alias("ok")))
    folder = F.regexp_extract("uri", r"([^/]+)/[^/]+$", 1)  # the date folder that holds the file
    outcomes = run_summary(outcome.select(folder.alias("date"), "ok"))
    summary = todo.agg(F.count(F.lit(1)).alias("success_count")).select("success_count", F.lit(failures.count()).alias("failure_count"))
    return {"failures": failures, "written": todo, "manifest": store.read("lineage"), "outcomes": outcomes, "summary": summary, "opened": opened}
