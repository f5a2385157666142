"""Every registered query: (spark, sf_dir) -> DataFrame over the driver's tables.

Feature queries read the derived option chain (materialised once per data
folder); key/listing/work-list queries read object names derived from
``events``; file queries read the chain written as minute files.
"""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainfeatures.config import OFFSETS, FeatureParams
from chainfeatures.functions import timekeys as K
from chainfeatures.functions.frames import SEQ
from chainfeatures.operators import keys, quality, timeline, worklist
from chainfeatures.operators.offset import offset_tag
from chainfeatures.operators.stored_spine import read_spine
from chainfeatures.plans import jobs
from chainfeatures.plans.coverage import feature_coverage
from chainfeatures.plans.pipeline import build_spine, compute_features, minute_features, node_table, normalise_panel
from chainfeatures.plans.registry import FeatureSection, HistorySection, create_default_registry
from chainfeatures.plans.sinks import hadoop_exists, hadoop_touch, write_minute_files
from chainfeatures.plans.store import SlabStore
from chainfeatures.session import fresh_shared_path, materialize, tune_session
from chainfeatures.sources import checksums, fixtures, names, snapshots
from chainfeatures.sources.chain import CHAIN_COLUMNS, read_table

ROW_KEYS = ("timestamp_int", "expirDate", "strike")
URI_PREFIX = f"s3://{names.SOURCE_BUCKET}/{names.PREFIX}/"


def chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune_session(spark)
    return fixtures.chain_table(spark, sf_dir)


def registry_with(sections=None):
    reg = create_default_registry()
    if sections is not None:
        for name in list(reg.enabled):
            if name not in sections:
                reg.disable_section(name)
    return reg


def features(spark, sf_dir, sections=None) -> DataFrame:
    return compute_features(chain(spark, sf_dir), registry=registry_with(sections))


def all_features(spark, sf_dir):
    return features(spark, sf_dir)


def family(section: str, cols, per_minute: bool = False):
    def run(spark, sf_dir):
        if per_minute:  # from the spine alone: no row of the panel moves
            return minute_features(chain(spark, sf_dir), registry=registry_with({section})).select("timestamp_int", *cols)
        df = features(spark, sf_dir, {section})
        return df.select(*ROW_KEYS, *[F.col(f"`{c}`") for c in cols])
    return run


def section_rows(section: str):
    def run(spark, sf_dir):
        reg = registry_with({section})
        return features(spark, sf_dir, {section}).select(*ROW_KEYS, *[F.col(f"`{c}`") for c in reg.get_active_features()])
    return run


def sections_subset(spark, sf_dir):
    """Contract and underlying sections disabled: their windows vanish from the plan."""
    return features(spark, sf_dir, {"section_atm", "section_cross_sectional", "section_offset"})


def round_numerics_q(spark, sf_dir):
    from chainfeatures.functions.rounding import round_numerics
    return round_numerics(chain(spark, sf_dir), 3)


def feature_coverage_q(spark, sf_dir):
    return feature_coverage(all_features(spark, sf_dir))


# -- timeline --------------------------------------------------------------------

def _spine(spark, sf_dir):
    return timeline.minute_spine(normalise_panel(chain(spark, sf_dir)))


def minute_spine(spark, sf_dir):
    return _spine(spark, sf_dir).select("timestamp_int", SEQ, "stockPrice")


def queue_size(spark, sf_dir):
    return timeline.queue_size(_spine(spark, sf_dir), FeatureParams().window_size)


def last_n_window(spark, sf_dir):
    return timeline.last_n_window(_spine(spark, sf_dir), 5)


def positional_lag(spark, sf_dir):
    """CallIVMid 1 and 5 minutes back and PutMid 3 back, per contract; null
    when the contract is absent in exactly that minute."""
    c = normalise_panel(chain(spark, sf_dir))
    spine, n = build_spine(c)
    return timeline.positional_lag(timeline.attach_seq(c, spine, n), {"CallIVMid": (1, 5), "PutMid": (3,)},
                                   ("expirDate", "strike"), FeatureParams())


def atm_node(spark, sf_dir):
    n = node_table(chain(spark, sf_dir), registry_with({"section_atm"}))
    return n.select("timestamp_int", "expirDate", F.col("_atm_iv").alias("atm_CallIVMid"),
                    F.col("_atm_sp").alias("atm_CallSpreadPct"), F.col("_atm_gm").alias("atm_CallGamma"))


def offset_node(spark, sf_dir):
    n = node_table(chain(spark, sf_dir), registry_with({"section_offset"}))
    cols = []
    for o in OFFSETS:
        cols += [F.col(f"_iv_{offset_tag(o)}").alias(f"CallIVMid_{offset_tag(o)}"),
                 F.col(f"_sp_{offset_tag(o)}").alias(f"CallSpreadPct_{offset_tag(o)}")]
    return n.select("timestamp_int", "expirDate", *cols)


# -- names, keys, work lists ------------------------------------------------------

def _names(spark, sf_dir):
    tune_session(spark)
    return fixtures.names_table(spark, sf_dir)


def _named(spark, sf_dir):
    return keys.with_time_key(_names(spark, sf_dir), "name")


def time_key(spark, sf_dir):
    return _named(spark, sf_dir).select("event_id", "name", "date", "minute", "timestamp_int", "valid")


def time_key_valid(spark, sf_dir):
    return keys.valid_names(_names(spark, sf_dir), "name").select("event_id", "name", "timestamp_int")


def session_position(spark, sf_dir):
    v = keys.valid_names(_names(spark, sf_dir), "name")
    return keys.with_session_position(v, "minute").select(
        "event_id", "sequence_number", "hour", "minute_of_hour")


def path_parts(spark, sf_dir):
    return keys.with_path_parts(names.uri_variants(_names(spark, sf_dir)), "uri").select(
        "event_id", "uri", "bucket", "key", "uri_valid", "key_suffix", "date_folder")


def _listed(spark, sf_dir):
    """Source listing: every key ending in .parquet (names with a bad time key
    included -- they fail later, as files)."""
    return _named(spark, sf_dir).filter(F.col("key").endswith(".parquet"))


def _processed(spark, sf_dir):
    """Destination: valid minutes whose minute-of-hour is a multiple of 3."""
    return _named(spark, sf_dir).filter("valid AND CAST(substring(minute, 3, 2) AS INT) % 3 = 0")


def unprocessed(spark, sf_dir):
    return worklist.unprocessed(_listed(spark, sf_dir), _processed(spark, sf_dir))


def worklist_by_date(spark, sf_dir):
    return worklist.worklist_by_date(unprocessed(spark, sf_dir), URI_PREFIX)


def _available_spine(spark, sf_dir):
    """Spine of the valid listed minutes (no data needed: time keys only)."""
    avail = _listed(spark, sf_dir).filter("valid").select("timestamp_int", F.lit(None).cast("double").alias("stockPrice"))
    return timeline.minute_spine(avail)


def history_context(spark, sf_dir):
    todo = unprocessed(spark, sf_dir)
    targets = keys.valid_names(todo, "key_suffix").select("timestamp_int").distinct()
    return worklist.history_context(targets, materialize(_available_spine(spark, sf_dir)))


def chronology_gate(spark, sf_dir):
    tune_session(spark)
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts")
    shifted = F.col("ts") + F.expr("make_dt_interval(0, 0, CAST((event_id * 7919) % 5 - 2 AS INT), 0)")
    arrivals = ev.select("event_id", F.date_format("ts", "yyyyMMdd").alias("batch"),
                         K.timestamp_int_of(shifted).alias("timestamp_int"))
    return worklist.chronology_gate(arrivals, "batch", "event_id").select(
        "event_id", "batch", "timestamp_int", "accepted")


def run_summary(spark, sf_dir):
    todo = keys.with_time_key(unprocessed(spark, sf_dir), "key_suffix")
    return worklist.run_summary(todo.select(K.date_folder("key_suffix").alias("date"), F.col("valid").alias("ok")))


# -- files ---------------------------------------------------------------------

def _minute_root(spark, sf_dir):
    chain(spark, sf_dir)
    return fixtures.chain_minute_files(spark, sf_dir)


def snapshot_scan(spark, sf_dir):
    df = snapshots.scan_snapshots(spark, _minute_root(spark, sf_dir))
    return df.select(*CHAIN_COLUMNS)


def _stamp(path_col: str = "path"):
    """Date folder and minute of a file, from its path (the folder's own place depends on the session)."""
    return [F.regexp_extract(path_col, r"one-minute/(\d{8})/", 1).alias("date_folder"),
            F.regexp_extract(path_col, r"strikes_(\d{12})\.parquet$", 1).alias("stamp")]


def file_listing(spark, sf_dir):
    files = snapshots.list_files(spark, _minute_root(spark, sf_dir))
    return files.select(*_stamp(), (F.col("length") > 0).alias("has_bytes"), F.col("modificationTime").isNotNull().alias("has_time"))


def file_checksum(spark, sf_dir):
    """One checksum per file, 32 hexadecimal digits, and how many files have the same one: as many as have the same rows."""
    return _alike(snapshots.file_checksums(spark, _minute_root(spark, sf_dir)), "md5").select(
        *_stamp(), F.col("md5").rlike("^[0-9a-f]{32}$").alias("is_md5"), "files_alike")


def object_checksum(spark, sf_dir):
    """Checksums as of uploads in parts of 1 KiB: well formed with the right number of parts, equal where the rows are."""
    c = checksums.object_checksums(spark, _minute_root(spark, sf_dir), part_bytes=1024)
    form = F.regexp_extract("checksum", "^[0-9a-f]{32}-([0-9]+)$", 1) == F.ceil(F.col("length") / 1024).cast("string")
    return _alike(c, "checksum").select(*_stamp(), form.alias("is_composite"), "files_alike")


def _alike(files: DataFrame, checksum: str) -> DataFrame:
    return files.join(files.groupBy(checksum).agg(F.count(F.lit(1)).alias("files_alike")), checksum)


def file_footer_check(spark, sf_dir):
    """Footer-only check of every minute file: rows, fields, failures."""
    f = snapshots.file_footers(spark, _minute_root(spark, sf_dir))
    bad = snapshots.footer_failures(f).select("path", F.col("error").alias("failure"))
    n = F.size(F.from_json("fields", "array<array<string>>"))
    return f.join(bad, "path", "left").select(*_stamp(), "rows", n.alias("n_fields"), "failure")


def snapshot_quality(spark, sf_dir):
    """Quality of the scanned minutes, some of them spoilt: on the 11th of a month every row is there twice,
    on the 12th the first line number has no expiry, on the 14th prices differ."""
    p = snapshots.scan_snapshots(spark, _minute_root(spark, sf_dir))
    day = F.substring("date", 7, 2)
    p = p.withColumn("expirDate", F.when((day == "12") & (F.col("strike") == 1), F.lit(None)).otherwise(F.col("expirDate")))
    p = p.withColumn("stockPrice", F.when(day == "14", F.col("stockPrice") + F.col("strike")).otherwise(F.col("stockPrice")))
    return quality.minute_quality(p.unionByName(p.filter(day == "11")))


def snapshot_scan_mixed(spark, sf_dir):
    """A folder whose files differ: every third file lacks ``PutMid``, every fifth has an extra column,
    every seventh whole-number volumes, every eleventh lacks ``stockPrice`` (a failure)."""
    root = _mixed_root(spark, sf_dir)
    rows = snapshots.scan_snapshots(spark, root)
    return rows.select("timestamp_int", "expirDate", "strike", "stockPrice", "CallMid", "PutMid", "callVolume", "extra")


def _mixed_root(spark, sf_dir):
    from chainfeatures.session import shared_path

    root = shared_path(spark, "tables", f"mixed-{fixtures._tag(spark, sf_dir)}")
    if not hadoop_exists(spark, f"{root}/_READY"):
        day = F.floor(F.col("timestamp_int") / 10000) % 100
        for lacks_put, extra, whole, lacks_price in itertools.product((False, True), repeat=4):
            part = chain(spark, sf_dir).filter(((day % 3 == 0) == lacks_put) & ((day % 5 == 0) == extra) & ((day % 7 == 0) == whole) & ((day % 11 == 0) == lacks_price))
            if lacks_put:
                part = part.drop("PutMid")
            if extra:
                part = part.withColumn("extra", F.concat(F.lit("x"), F.col("expirDate")))
            if whole:
                part = part.withColumn("callVolume", F.col("callVolume").cast("long"))
            if lacks_price:
                part = part.drop("stockPrice")
            write_minute_files(part, root).write.format("noop").mode("overwrite").save()
        hadoop_touch(spark, f"{root}/_READY")
    return root


def lineage_manifest(spark, sf_dir):
    root = _minute_root(spark, sf_dir)
    minutes = snapshots.scan_snapshots(spark, root).select("timestamp_int", "date", "minute", "path").distinct()
    m = _alike(jobs.lineage_manifest(snapshots.file_checksums(spark, root), minutes), "source_data_checksum")
    return m.select("files_alike", "timestamp_int", "date", "minute", "feature_version_hash",
                    F.col("source_data_checksum").rlike("^[0-9a-f]{32}$").alias("has_checksum"),
                    F.col("processing_timestamp").endswith("Z").alias("utc"))


def enriched_roundtrip(spark, sf_dir):
    """Scan the minute files, compute every feature, commit them to a store (slabs of a month: the chain has one minute a day),
    read back what is committed."""
    panel = snapshots.scan_snapshots(spark, _minute_root(spark, sf_dir)).drop("path")
    dest = fresh_shared_path(spark, "enriched")
    SlabStore(spark, dest, slab_chars=6).commit({"rows": (compute_features(panel), None)})
    back = snapshots.scan_enriched(spark, dest)
    feats = create_default_registry().get_active_features()
    return back.select(*CHAIN_COLUMNS, *[F.col(f"`{c}`") for c in feats])


# -- jobs ---------------------------------------------------------------------------

def _newest_minute(panel: DataFrame) -> int:
    return panel.agg(F.max("timestamp_int")).first()[0]


def live_response(spark, sf_dir):
    c = chain(spark, sf_dir)
    rows, _ = jobs.run_live(c, _newest_minute(c))
    feats = create_default_registry().get_active_features()
    kinds = ", ".join(f"`{x}` {t}" for x, t in rows.dtypes)
    back = jobs.live_records(rows).select(F.from_json("record", kinds).alias("r")).select("r.*")  # what a client parses
    return back.select(*CHAIN_COLUMNS, *[F.col(f"`{x}`") for x in feats])


def live_metadata(spark, sf_dir):
    c = chain(spark, sf_dir)
    _, meta = jobs.run_live(c, _newest_minute(c))
    return meta.drop("processing_time_ms")


def incremental_features(spark, sf_dir):
    """New = minutes whose day of month is not a multiple of 3; everything
    else counts as already written.  Positions come from the stored spine."""
    c = chain(spark, sf_dir)
    new = c.select("timestamp_int").filter(F.substring("date", 7, 2).cast("int") % 3 != 0).distinct()
    spine, n = read_spine(fixtures.spine_store(spark, sf_dir))
    return jobs.run_incremental(c, new, spine=spine, spine_rows=n)


class PutGap(FeatureSection):
    """A plug-in section: the gap of the mids, and its change over two minutes."""

    name, level, lookback = "section_put_gap", "contract", 2
    feature_names = ("PutGap", "PutGapChange_L2")

    def columns(self, ctx):
        gap = "CallMid - PutMid"
        return {"PutGap": gap, "PutGapChange_L2": f"CASE WHEN {ctx.gate(2)} THEN ({gap}) - {ctx.contract.lag(gap, 2)} END"}


def plugin_section(spark, sf_dir):
    """A registry with one registered section of the user's own, and nothing else enabled."""
    reg = registry_with(set()).register_section("section_put_gap", PutGap()).enable_section("section_put_gap")
    return compute_features(chain(spark, sf_dir), registry=reg).select(*ROW_KEYS, *PutGap.feature_names)


class MedianMid(HistorySection):
    """A section that sorts its history: the (lower) median mid of a contract over this minute and the five before."""

    name, lookback, inputs = "section_median_mid", 5, ("CallMid",)
    feature_names = ("CallMidMedian_5",)

    def history(self, rows, params):
        import numpy as np
        import pandas as pd

        first, n = rows["minute_seq"].min(), self.lookback
        strikes, column = np.unique(rows["strike"], return_inverse=True)
        line = (rows["minute_seq"] - first).to_numpy()
        grid = np.full((n + line.max() + 1, len(strikes)), np.nan)  # a line for each position, absent contracts are missing
        grid[n + line, column] = rows["CallMid"]
        seen = np.sort(np.lib.stride_tricks.sliding_window_view(grid, n + 1, axis=0), axis=-1)  # missing ones last
        count = (~np.isnan(seen)).sum(-1)
        median = np.take_along_axis(seen, np.maximum(count - 1, 0)[..., None] // 2, -1)[..., 0]
        gated = np.minimum(rows["minute_seq"] - 1, params.window_size) >= n
        return pd.DataFrame({"CallMidMedian_5": np.where(gated, median[line, column], np.nan)}, index=rows.index)


def history_section(spark, sf_dir):
    """A registry with one history section of the user's own."""
    reg = registry_with(set()).register_section("section_median_mid", MedianMid()).enable_section("section_median_mid")
    return compute_features(chain(spark, sf_dir), registry=reg).select(*ROW_KEYS, *MedianMid.feature_names)


def streaming_features(spark, sf_dir):
    """Stream the chain's minute files through the live-ingestion query
    (several micro-batches), then read what it wrote."""
    from chainfeatures.streaming.ingest import start_stream

    root = _minute_root(spark, sf_dir)
    base = fresh_shared_path(spark, "stream")
    q = start_stream(spark, root, f"{base}/sink", f"{base}/state", f"{base}/checkpoint",
                     max_files_per_trigger=1000)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    back = spark.read.parquet(f"{base}/sink")
    feats = create_default_registry().get_active_features()
    return back.select(*CHAIN_COLUMNS, *[F.col(f"`{c}`") for c in feats])


QUERIES = {
    "all_features": all_features,
    "sections_subset": sections_subset,
    "round_numerics": round_numerics_q,
    "feature_coverage": feature_coverage_q,
    "minute_spine": minute_spine,
    "queue_size": queue_size,
    "last_n_window": last_n_window,
    "positional_lag": positional_lag,
    "atm_node": atm_node,
    "offset_node": offset_node,
    "atm_features": section_rows("section_atm"),
    "offset_features": section_rows("section_offset"),
    "time_key": time_key,
    "time_key_valid": time_key_valid,
    "session_position": session_position,
    "path_parts": path_parts,
    "unprocessed": unprocessed,
    "worklist_by_date": worklist_by_date,
    "history_context": history_context,
    "chronology_gate": chronology_gate,
    "run_summary": run_summary,
    "snapshot_scan": snapshot_scan,
    "file_listing": file_listing,
    "file_checksum": file_checksum,
    "object_checksum": object_checksum,
    "snapshot_scan_mixed": snapshot_scan_mixed,
    "plugin_section": plugin_section,
    "history_section": history_section,
    "snapshot_quality": snapshot_quality,
    "file_footer_check": file_footer_check,
    "lineage_manifest": lineage_manifest,
    "enriched_roundtrip": enriched_roundtrip,
    "live_response": live_response,
    "live_metadata": live_metadata,
    "incremental_features": incremental_features,
    "streaming_features": streaming_features,
}
