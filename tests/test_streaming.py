"""Streaming ingestion = batch recompute; late files are rejected."""

import os

from pyspark.sql import functions as F

from chainfeatures.plans.pipeline import compute_features
from chainfeatures.plans.registry import create_default_registry
from chainfeatures.plans.sinks import write_minute_files
from chainfeatures.sources.chain import derived_chain
from chainfeatures.streaming.ingest import start_stream
from testdata_paths import SF001

KEY = ["timestamp_int", "expirDate", "strike"]


def test_stream_equals_batch_and_rejects_late(spark, tmp_path):
    full = derived_chain(spark, SF001)
    minutes = sorted(r[0] for r in full.select("timestamp_int").distinct().collect())
    chain = full.filter(F.col("timestamp_int") < minutes[400]).cache()
    src = str(tmp_path / "src")
    write_minute_files(chain, src).write.format("noop").mode("overwrite").save()
    base = str(tmp_path / "run")
    q = start_stream(spark, src, f"{base}/sink", f"{base}/state", f"{base}/ckpt", max_files_per_trigger=150)
    q.awaitTermination()
    assert q.exception() is None
    got = spark.read.parquet(f"{base}/sink").drop("batch_id")
    feats = create_default_registry().get_active_features()
    exp = compute_features(chain)
    cols = KEY + feats
    assert got.count() == exp.count()
    diff = got.select(cols).exceptAll(exp.select(cols)).count()
    assert diff == 0
    # a late file (older than the newest written minute) is rejected, not featured
    late = chain.filter(F.col("timestamp_int") == chain.agg(F.min("timestamp_int")).first()[0])
    write_minute_files(late.withColumn("timestamp_int", F.lit(199201020000)), src + "_late").write.format("noop").mode("overwrite").save()
    for root, _, files in os.walk(src + "_late"):
        for f in files:
            if f.endswith(".parquet"):
                dest = os.path.join(src, "one-minute", "19920102")
                os.makedirs(dest, exist_ok=True)
                os.replace(os.path.join(root, f), os.path.join(dest, f))
    q = start_stream(spark, src, f"{base}/sink", f"{base}/state", f"{base}/ckpt", max_files_per_trigger=150)
    q.awaitTermination()
    assert spark.read.parquet(f"{base}/state/rejected").filter("timestamp_int = 199201020000").count() == 1
    assert spark.read.parquet(f"{base}/sink").filter("timestamp_int = 199201020000").count() == 0


def _panel(spark, n):
    full = derived_chain(spark, SF001)
    minutes = sorted(r[0] for r in full.select("timestamp_int").distinct().collect())[:n]
    return full.filter(F.col("timestamp_int").isin(minutes)), minutes


def _paths(spark, files):
    return spark.createDataFrame([("file:" + f,) for f in files], "path string")


def test_replays_change_nothing(spark, tmp_path, monkeypatch):
    """A batch that fails after any of its writes and is run again gives the tables of a batch that did not."""
    import chainfeatures.streaming.ingest as I

    chain, _ = _panel(spark, 30)
    src = str(tmp_path / "src")
    write_minute_files(chain, src).write.format("noop").mode("overwrite").save()
    files = sorted(os.path.join(d, f) for d, _, names in os.walk(src) for f in names if f.endswith(".parquet"))
    halves = files[:18], files[18:]
    tables = {}
    for broken in (0, 1, 2, 3):
        base = str(tmp_path / f"run{broken}")
        real, calls = I.write_batch, []

        def write(df, dest, epoch):
            real(df, dest, epoch)
            calls.append(dest)
            if len(calls) == broken:
                raise RuntimeError("lost")

        monkeypatch.setattr(I, "write_batch", write)
        for epoch, half in enumerate(halves):
            for _ in range(2):
                try:
                    I.process_batch(_paths(spark, half), epoch, f"{base}/sink", f"{base}/state")
                    break
                except RuntimeError:
                    pass
        if broken == 0:
            I.process_batch(_paths(spark, halves[1]), 1, f"{base}/sink", f"{base}/state")  # an outright replay
        monkeypatch.setattr(I, "write_batch", real)
        got = spark.read.parquet(f"{base}/sink")
        tables[broken] = sorted(map(str, got.select(sorted(got.columns)).collect())), sorted(
            tuple(r) for r in spark.read.parquet(f"{base}/state/positions").select("timestamp_int", "minute_seq").collect())
    assert all(t == tables[0] for t in tables.values()) and len(tables[0][1]) == 30


def test_invalid_files_are_rejected_once(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    import chainfeatures.streaming.ingest as I

    chain, minutes = _panel(spark, 12)
    src = str(tmp_path / "src")
    write_minute_files(chain, src).write.format("noop").mode("overwrite").save()
    files = sorted(os.path.join(d, f) for d, _, names in os.walk(src) for f in names if f.endswith(".parquet"))
    t = pq.read_table(files[3])
    pq.write_table(pa.concat_tables([t, t]), files[3])  # repeated keys
    t = pq.read_table(files[4])
    pq.write_table(t.set_column(t.schema.get_field_index("expirDate"), "expirDate", pa.array([None] * t.num_rows, pa.string())), files[4])
    open(files[5], "wb").write(b"broken")
    pq.write_table(pq.read_table(files[6]).drop(["strike"]), files[6])
    second = os.path.join(str(tmp_path), "src", "one-minute", "zz", os.path.basename(files[0]))
    os.makedirs(os.path.dirname(second))
    pq.write_table(pq.read_table(files[0]), second)
    base = str(tmp_path / "run")
    for _ in range(2):
        I.process_batch(_paths(spark, files + [second]), 0, f"{base}/sink", f"{base}/state")
    bad = {os.path.basename(r["path"]) + ("+" if "/zz/" in r["path"] else ""): r["error"] for r in spark.read.parquet(f"{base}/state/rejected").collect()}
    assert spark.read.parquet(f"{base}/state/rejected").count() == len(bad) == 5, bad
    assert set(bad) == {os.path.basename(files[k]) for k in (3, 4, 5, 6)} | {os.path.basename(files[0]) + "+"}
    good = chain.filter(~F.col("timestamp_int").isin([minutes[k] for k in (3, 4, 5, 6)]))
    feats = create_default_registry().get_active_features()
    got = spark.read.parquet(f"{base}/sink").select(KEY + feats)
    assert got.exceptAll(compute_features(good).select(KEY + feats)).count() == 0 and got.count() == good.count()


def test_what_a_batch_reads_does_not_grow(spark, tmp_path, monkeypatch):
    """Many small batches: each opens its own files, one tail and the look-back, and the result is that of one batch."""
    import chainfeatures.streaming.ingest as I

    chain, minutes = _panel(spark, 44)
    src = str(tmp_path / "src")
    write_minute_files(chain, src).write.format("noop").mode("overwrite").save()
    files = sorted(os.path.join(d, f) for d, _, names in os.walk(src) for f in names if f.endswith(".parquet"))
    base = str(tmp_path / "run")
    lookback = create_default_registry().max_lookback()
    opened, real = [], I.scan_snapshots
    monkeypatch.setattr(I, "scan_snapshots", lambda spark, paths, **kw: (opened.append(len(paths)), real(spark, paths, **kw))[1])
    cuts = [0, 32, 34, 36, 38, 40, 42, 44]
    for epoch, (a, b) in enumerate(zip(cuts, cuts[1:])):
        opened.clear()
        I.process_batch(_paths(spark, files[a:b]), epoch, f"{base}/sink", f"{base}/state")
        if epoch:
            assert opened == [2, lookback]
            assert spark.read.parquet(f"{base}/state/tail").filter(F.col("batch_id") == epoch).count() == lookback
            assert len([d for d in os.listdir(f"{base}/state/tail") if d.startswith("batch_id=")]) == 2
    feats = create_default_registry().get_active_features()
    got = spark.read.parquet(f"{base}/sink").select(KEY + feats)
    assert got.count() == chain.count() and got.exceptAll(compute_features(chain).select(KEY + feats)).count() == 0
