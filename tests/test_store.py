"""The batch job on its store: what is opened, late minutes, crashes, footers, the stored spine."""

import hashlib
import json
import os
import random
import subprocess
import sys

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from chainfeatures.operators import stored_spine
from chainfeatures.operators.timeline import minute_spine
from chainfeatures.plans import jobs
from chainfeatures.plans.jobs import run_batch
from chainfeatures.plans.pipeline import compute_features
from chainfeatures.plans.registry import create_default_registry
from chainfeatures.plans.sinks import write_minute_files
from chainfeatures.plans.store import SlabStore
from chainfeatures.session import materialize
from chainfeatures.sources.chain import derived_chain
from chainfeatures.sources.snapshots import file_checksums, file_footers, scan_enriched
from testdata_paths import SF001

KEY = ["timestamp_int", "expirDate", "strike"]


@pytest.fixture(scope="module")
def chain(spark):
    full = derived_chain(spark, SF001)
    minutes = sorted(r[0] for r in full.select("timestamp_int").distinct().collect())[:70]
    return materialize(full.filter(F.col("timestamp_int").isin(minutes)))


@pytest.fixture(scope="module")
def files(chain, tmp_path_factory):
    """Path of every minute's file, in time order, in a folder of their own."""
    src = str(tmp_path_factory.mktemp("all"))
    write_minute_files(chain, src).write.format("noop").mode("overwrite").save()
    return sorted(os.path.join(d, f) for d, _, names in os.walk(src) for f in names if f.endswith(".parquet"))


def put(src, paths):
    for p in paths:
        day = os.path.join(src, "one-minute", os.path.basename(p)[8:16])
        os.makedirs(day, exist_ok=True)
        with open(p, "rb") as a, open(os.path.join(day, os.path.basename(p)), "wb") as b:
            b.write(a.read())


def stamp(path):
    return int(os.path.basename(path)[8:20])


def equals_recompute(spark, dest, chain, minutes):
    cols = KEY + create_default_registry().get_active_features()
    want = compute_features(chain.filter(F.col("timestamp_int").isin(list(minutes)))).select(cols)
    got = scan_enriched(spark, dest).select(cols)
    assert got.count() == want.count() and got.exceptAll(want).count() == 0


def test_second_run_opens_the_new_file_and_its_look_back(spark, chain, files, tmp_path):
    src, dest = str(tmp_path / "src"), str(tmp_path / "dest")
    put(src, files[:69])
    first = run_batch(spark, src, dest, slab_chars=6)
    assert first["opened"].count() == 69
    put(src, files[69:])
    res = run_batch(spark, src, dest, slab_chars=6)
    lookback = create_default_registry().max_lookback()
    assert {os.path.basename(r["path"]) for r in res["opened"].collect()} == {os.path.basename(f) for f in files[69 - lookback:]}
    assert [r["timestamp_int"] for r in res["written"].collect()] == [stamp(files[69])]
    equals_recompute(spark, dest, chain, map(stamp, files))
    none = run_batch(spark, src, dest, slab_chars=6)
    assert none["opened"].count() == 0 and none["written"].count() == 0 and none["manifest"].count() == 70


def test_minutes_in_any_order_equal_a_recompute(spark, chain, files, tmp_path):
    """Old minutes backfilled at random, one removed, one replaced by another minute's rows, one spoilt."""
    src, dest = str(tmp_path / "src"), str(tmp_path / "dest")
    order = files[:]
    random.Random(4).shuffle(order)
    for part in (order[:30], order[30:33], order[33:]):
        put(src, part)
        run_batch(spark, src, dest, slab_chars=6)
    equals_recompute(spark, dest, chain, map(stamp, files))
    at = lambda k: os.path.join(src, "one-minute", str(stamp(files[k]))[:8], os.path.basename(files[k]))
    os.remove(at(20))  # a file of this test's own source folder
    t = pq.read_table(at(40))
    pq.write_table(pa.concat_tables([t, t]), at(40))
    new = pq.read_table(at(50)).to_pandas()
    new["CallMid"] += 1
    pq.write_table(pa.Table.from_pandas(new, preserve_index=False), at(50))
    res = run_batch(spark, src, dest, slab_chars=6)
    assert [os.path.basename(r["uri"]) for r in res["failures"].collect()] == [os.path.basename(files[40])]
    changed = chain.withColumn("CallMid", F.when(F.col("timestamp_int") == stamp(files[50]), F.col("CallMid") + 1).otherwise(F.col("CallMid")))
    equals_recompute(spark, dest, changed, [stamp(f) for k, f in enumerate(files) if k not in (20, 40)])
    touched = {r["timestamp_int"] for r in res["written"].collect()}
    assert stamp(files[19]) not in touched and stamp(files[21]) in touched and stamp(files[39]) in touched
    assert res["manifest"].count() == 68


def test_crash_at_any_step_shows_all_or_nothing(spark, files, tmp_path, monkeypatch):
    src, dest = str(tmp_path / "src"), str(tmp_path / "dest")
    put(src, files[:6])
    run_batch(spark, src, dest)
    before = sorted(map(str, scan_enriched(spark, dest).select(KEY).collect()))
    put(src, files[6:8])
    real = SlabStore.slab_of
    for broken in range(1, 60, 4):
        calls = []

        def slab_of(self, date):
            calls.append(1)
            if len(calls) == broken:
                raise RuntimeError("lost")
            return real(self, date)

        monkeypatch.setattr(SlabStore, "slab_of", slab_of)
        try:
            run_batch(spark, src, dest)
            break
        except RuntimeError:
            store = SlabStore(spark, dest)
            assert store.versions() == [1] and sorted(map(str, store.read("rows").select(KEY).collect())) == before
    monkeypatch.setattr(SlabStore, "slab_of", real)
    assert broken > 1 and SlabStore(spark, dest).versions() == [1, 2]
    assert scan_enriched(spark, dest).select("timestamp_int").distinct().count() == 8
    store = SlabStore(spark, dest)
    assert sorted(map(str, store.read("rows", version=1).select(KEY).collect())) == before  # readers keep their version
    store.vacuum(keep=1)
    assert store.versions() == [2] and scan_enriched(spark, dest).select("timestamp_int").distinct().count() == 8


def test_crash_between_data_and_log(spark, tmp_path):
    store = SlabStore(spark, str(tmp_path / "t"))
    rows = lambda *r: spark.createDataFrame(r, "timestamp_int long, date string, x int")
    store.commit({"a": (rows((202501010930, "20250101", 1), (202501020930, "20250102", 2)), None)})
    # data of version 2 written, its log not
    rows((202501020930, "20250102", 9)).withColumn("slab", F.col("date")).write.partitionBy("slab").parquet(str(tmp_path / "t" / "a" / "v=2"))
    assert {r["x"] for r in store.read("a").collect()} == {1, 2}
    store.commit({"a": (rows((202501020930, "20250102", 3)).withColumn("y", F.lit("n")), ["20250102"])})
    assert {(r["x"], r["y"]) for r in store.read("a").collect()} == {(1, None), (3, "n")}
    store.commit({"a": (rows().withColumn("y", F.lit("n")), ["20250101"]), "b": (rows((202501020930, "20250102", 5)), None)})
    assert {r["x"] for r in store.read("a").collect()} == {3} and store.slabs("b") == {"20250102": 1}
    with pytest.raises(ValueError):
        store.commit({"b": (rows().withColumn("x", F.lit("text")), ["20250102"])})
    assert store.read("nothing") is None


def test_stored_spine_equals_a_fresh_one(spark, tmp_path):
    r = random.Random(8)
    store = SlabStore(spark, str(tmp_path / "s"), 6)
    held = {}
    for turn in range(5):
        new = {r.choice([202501, 202502, 202503, 202412]) * 1000000 + r.randint(1, 28) * 10000 + 930 + r.randint(0, 29): float(r.randint(1, 9)) for _ in range(40)}
        gone = r.sample(sorted(held), min(len(held), 6)) if turn else []
        gone = [g for g in gone if g not in new]
        added = spark.createDataFrame(list(new.items()), "timestamp_int long, stockPrice double")
        removed = spark.createDataFrame([(g,) for g in gone], "timestamp_int long")
        slabs = sorted({str(t)[:6] for t in [*new, *gone]})
        store.commit({"spine": (materialize(stored_spine.merged(store, added, removed, slabs)), slabs)})
        before = sorted(held)
        held = {t: p for t, p in (held | new).items() if t not in gone}
        spine, n = stored_spine.read_spine(store)
        rows = spark.createDataFrame(list(held.items()), "timestamp_int long, stockPrice double")
        assert n == len(held) and sorted(map(tuple, spine.select("timestamp_int", "minute_seq", "stockPrice").collect())) == sorted(
            map(tuple, minute_spine(rows).select("timestamp_int", "minute_seq", "stockPrice").collect()))
        # what a change makes stale, by comparing the look-backs before and after
        now, look = sorted(held), 4
        back = lambda s: {t: s[max(0, k - look):k] for k, t in enumerate(s)}
        a, b = back(before), back(now)
        want = {t for t in now if t in new or t not in a or a[t] != b[t]}
        changed = spark.createDataFrame([(t,) for t in [*new, *gone]], "timestamp_int long")
        got = {x["timestamp_int"] for x in stored_spine.stale_minutes(spine, changed, look).collect()}
        assert want <= got and all(any(c in [t, *b[t]] for c in new) or any(t > g and sum(g < u < t for u in now) < look for g in gone) for t in got)


def test_footers_by_ranges(spark, files, tmp_path):
    src = str(tmp_path / "f")
    put(src, files[:5])
    big = os.path.join(src, "one-minute", "20990101", "strikes_209901010930.parquet")
    os.makedirs(os.path.dirname(big))
    body = open(files[0], "rb").read()
    for name, data in (("strikes_209901010931.parquet", b"PAR1"), ("strikes_209901010932.parquet", b"no parquet file at all"), ("strikes_209901010933.parquet", body[:-1])):
        open(os.path.join(os.path.dirname(big), name), "wb").write(data)
    columns = ["path", "length", "rows", "fields", "error"]
    by_range, by_spark = (sorted(map(str, file_footers(spark, src, ranged=k).select(columns).collect())) for k in (True, False))
    assert by_range == by_spark and len(by_range) == 8
    with open(big, "wb") as f:  # 3 GB long, nearly all of it a hole
        f.truncate(3 << 30)
        f.seek(0, 2)
        f.write(body)
    got = {os.path.basename(r["path"]): r for r in file_footers(spark, src).collect()}
    r = got[os.path.basename(big)]
    footer = int.from_bytes(body[-8:-4], "little")
    assert r["length"] == (3 << 30) + len(body) and r["rows"] == pq.read_metadata(files[0]).num_rows and r["read_bytes"] == footer + 8
    assert [f[0] for f in json.loads(r["fields"])] == pq.read_schema(files[0]).names
    assert got["strikes_209901010931.parquet"]["error"] and got["strikes_209901010932.parquet"]["read_bytes"] <= 8


def test_checksums_equal_hashlib(spark, files, tmp_path):
    src = str(tmp_path / "c")
    put(src, files[:4])
    got = {os.path.basename(r["path"]): r["md5"] for r in file_checksums(spark, src).collect()}
    assert got == {os.path.basename(f): hashlib.md5(open(f, "rb").read()).hexdigest() for f in files[:4]}


def test_worker_code_needs_no_installed_copy(tmp_path):
    """What travels to an executor loads where the library cannot be imported."""
    from pyspark import cloudpickle

    from chainfeatures.sources import snapshots

    path = tmp_path / "f.pkl"
    path.write_bytes(cloudpickle.dumps((snapshots._ranged, snapshots._tails)))
    code = f"import pickle; a, b = pickle.load(open({str(path)!r}, 'rb')); import sys; assert 'chainfeatures' not in sys.modules; print(list(a([])))"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=100)
    assert out.stdout.strip() == "[]", out.stderr
