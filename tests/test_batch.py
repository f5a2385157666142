"""Batch job over a snapshot folder: bad names, empty files, missing
columns and duplicate keys fail per file; good minutes are written once."""

import os

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from chainfeatures.plans.jobs import run_batch
from chainfeatures.plans.sinks import write_minute_files
from chainfeatures.sources.chain import derived_chain
from chainfeatures.sources.snapshots import scan_enriched
from testdata_paths import SF001


def test_run_batch(spark, tmp_path):
    full = derived_chain(spark, SF001)
    minutes = sorted(r[0] for r in full.select("timestamp_int").distinct().collect())[:60]
    chain = full.filter(F.col("timestamp_int").isin(minutes))
    src = str(tmp_path / "src")
    write_minute_files(chain, src).write.format("noop").mode("overwrite").save()
    day = os.path.join(src, "one-minute", "20991231")
    os.makedirs(day)
    good = pq.read_table(os.path.join(src, "one-minute", str(minutes[0])[:8], f"strikes_{minutes[0]}.parquet"))
    pq.write_table(good.slice(0, 0), os.path.join(day, "strikes_209912310930.parquet"))          # empty
    pq.write_table(good.drop(["stockPrice"]), os.path.join(day, "strikes_209912310931.parquet"))  # missing column
    pq.write_table(pa.concat_tables([good, good]), os.path.join(day, "strikes_209912310932.parquet"))  # dup keys
    pq.write_table(good, os.path.join(day, "strikes_209912312460.parquet"))                      # bad name
    dest = str(tmp_path / "dest")
    res = run_batch(spark, src, dest)
    fails = {os.path.basename(r["uri"]): r["error"] for r in res["failures"].collect()}
    assert set(fails) == {"strikes_209912310930.parquet", "strikes_209912310931.parquet",
                          "strikes_209912310932.parquet", "strikes_209912312460.parquet"}, fails
    assert "Empty" in fails["strikes_209912310930.parquet"]
    assert "stockPrice" in fails["strikes_209912310931.parquet"]
    assert "Duplicate" in fails["strikes_209912310932.parquet"]
    s = res["summary"].first()
    assert (s["success_count"], s["failure_count"]) == (60, 4)
    assert scan_enriched(spark, dest).count() == chain.count()
    # second run: nothing new
    again = run_batch(spark, src, dest)
    assert again["summary"].first()["success_count"] == 0


def _files(src):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(src) for f in names if f.endswith(".parquet"))


def test_files_with_schemas_of_their_own(spark, tmp_path):
    """Missing optional, extra, whole-number and missing required columns, and broken files, in one batch:
    good minutes equal their single-file result, bad ones are reported, none decides for another."""
    from chainfeatures.plans.pipeline import compute_features
    from chainfeatures.plans.registry import create_default_registry
    from chainfeatures.sources.snapshots import scan_snapshots

    full = derived_chain(spark, SF001)
    minutes = sorted(r[0] for r in full.select("timestamp_int").distinct().collect())[:24]
    chain = full.filter(F.col("timestamp_int").isin(minutes))
    src = str(tmp_path / "with space" / "src")
    write_minute_files(chain, src).write.format("noop").mode("overwrite").save()
    files = _files(src)
    lacks = (0, 11, 23)
    for k in lacks:
        pq.write_table(pq.read_table(files[k]).drop(["PutMid"]), files[k])
    t = pq.read_table(files[5])
    pq.write_table(t.append_column("extra", pa.array(["e"] * t.num_rows)), files[5])
    t = pq.read_table(files[7])
    at = t.schema.get_field_index("callVolume")
    pq.write_table(t.set_column(at, "callVolume", t["callVolume"].cast(pa.int64())), files[7])
    pq.write_table(pq.read_table(files[1]).drop(["stockPrice"]), files[1])
    with open(files[2], "wb") as f:
        f.write(b"this is no parquet file")
    body = bytearray(open(files[3], "rb").read())
    body[4:200] = b"\xff" * 196  # the footer is sound, the pages are not
    open(files[3], "wb").write(bytes(body))
    dest = str(tmp_path / "dest")
    res = run_batch(spark, src, dest)
    bad = {os.path.basename(r["uri"]): r["error"] for r in res["failures"].collect()}
    assert set(bad) == {os.path.basename(files[k]) for k in (1, 2, 3)}, bad
    assert "stockPrice" in bad[os.path.basename(files[1])] and "unreadable" in bad[os.path.basename(files[2])]
    assert "Read" in bad[os.path.basename(files[3])]
    assert (res["summary"].first()["success_count"], res["summary"].first()["failure_count"]) == (21, 3)
    total = {r["date"]: r for r in res["outcomes"].collect()}
    assert total[None]["completed"] == 21 and total[None]["failed"] == 3 and total[None]["status"] == "partial"
    # the same minutes, clean but for what their files lack
    gone = [minutes[k] for k in (1, 2, 3)]
    clean = chain.filter(~F.col("timestamp_int").isin(gone)).withColumn(
        "PutMid", F.when(F.col("timestamp_int").isin([minutes[k] for k in lacks]), F.lit(None)).otherwise(F.col("PutMid")))
    feats = create_default_registry().get_active_features()
    key = ["timestamp_int", "expirDate", "strike"]
    got = scan_enriched(spark, dest)
    assert got.select(key + feats).exceptAll(compute_features(clean).select(key + feats)).count() == 0
    assert got.filter(F.col("PutMidReturn_L1").isNotNull()).count() > 0
    assert got.filter("extra = 'e'").count() == chain.filter(F.col("timestamp_int") == minutes[5]).count()
    scanned = scan_snapshots(spark, src, tolerant=True)
    assert dict(scanned.dtypes)["callVolume"] == "double"
    # lineage: one row per written minute, also after a second run over everything
    m = res["manifest"].toPandas()
    assert sorted(m["timestamp_int"]) == sorted(set(minutes) - set(gone)) and (m["source_data_checksum"].str.len() == 32).all()
    again = run_batch(spark, src, dest, new_only=False)
    assert again["manifest"].count() == 21


def test_several_prices_are_a_failure(spark):
    from chainfeatures.operators.quality import minute_quality

    rows = [(1, "e", 1.0, 0, 5.0), (1, "e", 2.0, 1, 5.0), (2, "e", 1.0, 0, 5.0), (2, "e", 2.0, 1, 5.5)]
    q = {r["timestamp_int"]: r["error"] for r in minute_quality(spark.createDataFrame(
        rows, "timestamp_int long, expirDate string, strike double, distance_to_atm int, stockPrice double")).collect()}
    assert q == {1: None, 2: "Several stockPrice values"}


def test_close_distances_are_no_ties(spark):
    from chainfeatures.plans.pipeline import node_table

    rows = [(1, "e", 1.0, 0.1 + 5e-7, 10.0, 0.3), (1, "e", 2.0, 0.1, 10.0, 0.4), (1, "e", 3.0, 0.1, 10.0, 0.5)]
    p = spark.createDataFrame(rows, "timestamp_int long, expirDate string, strike double, distance_to_atm double, stockPrice double, CallIVMid double")
    assert node_table(p).first()["_atm_iv"] == 0.4


def test_live_drops_invalid_history_without_replacement(spark):
    from chainfeatures.plans.jobs import live_envelope, run_live

    base = [202503010930 + k for k in range(20)]
    rows = [(t, str(t)[:8], "e", float(k), k, 5.0 + t % 7) for t in base for k in (0, 1)]
    rows += [(base[10], str(base[10])[:8], "e", 0.0, 0, 5.0 + base[10] % 7)]  # a repeated key
    p = spark.createDataFrame(rows, "timestamp_int long, date string, expirDate string, strike double, distance_to_atm int, stockPrice double")
    out, meta = run_live(p, base[19], history_minutes=12)
    m = meta.first()
    assert m["row_count"] == 2 and m["history_minutes_loaded"] == 12 and m["processing_time_ms"] >= 0  # 12 listed, one dropped, and itself
    import json
    r = json.loads(live_envelope(out, meta).first()["response"])
    assert len(r["data"]) == 2 and r["metadata"]["row_count"] == 2
