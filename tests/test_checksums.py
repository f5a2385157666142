"""Object checksums against hashlib."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from chainfeatures.sources import checksums
from chainfeatures.sources.checksums import mismatched, object_checksums

PART = 1000


def stated(body: bytes, part: int | None, threshold: int | None = None) -> str:
    if part is None or len(body) < (part if threshold is None else threshold):
        return hashlib.md5(body).hexdigest()
    parts = [body[k:k + part] for k in range(0, len(body), part)]
    return hashlib.md5(b"".join(hashlib.md5(p).digest() for p in parts)).hexdigest() + f"-{len(parts)}"


@pytest.fixture(scope="module")
def bodies(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("objects"))
    sizes = {"one": 1, "below": PART - 1, "exact": PART, "above": PART + 1, "many": 25 * PART + 7, "copy of many": 25 * PART + 7, "ten": 10 * PART}
    out = {}
    for k, (name, n) in enumerate(sizes.items()):
        out[f"{name}.bin"] = bytes((i * (7 if "many" in name else 7 + 2 * k)) % 251 for i in range(n))
        with open(os.path.join(root, f"{name}.bin"), "wb") as f:
            f.write(out[f"{name}.bin"])
    return root, out


def by_name(df):
    return {os.path.basename(r["path"]).replace("%20", " "): r["checksum"] for r in df.collect()}


@pytest.mark.parametrize("ranged", [True, False])
@pytest.mark.parametrize("part,threshold", [(PART, None), (PART, 5 * PART), (PART, 0), (None, None), (10**6, None), (7, None)])
def test_equal_hashlib(spark, bodies, part, threshold, ranged):
    root, out = bodies
    got = by_name(object_checksums(spark, root, "*.bin", part_bytes=part, threshold=threshold, ranged=ranged))
    assert got == {name: stated(b, part, threshold) for name, b in out.items()}


def test_chunks_do_not_matter(spark, bodies, monkeypatch):
    root, out = bodies
    monkeypatch.setattr(checksums, "CHUNK_BYTES", 13)  # travels with the code
    assert by_name(object_checksums(spark, root, "*.bin", part_bytes=PART)) == {name: stated(b, PART) for name, b in out.items()}


def test_parts_of_a_file_are_rows_of_their_own(spark, bodies):
    plan = object_checksums(spark, bodies[0], "*.bin", part_bytes=PART)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(path" in plan and ", part#" in plan and "content" not in plan


def test_listed_files_empty_ones_and_changed_ones(spark, bodies):
    root, out = bodies
    files = spark.createDataFrame([(f"file:{root}/many.bin", len(out["many.bin"]))], "path string, length long")
    assert by_name(object_checksums(spark, root, files=files, part_bytes=PART)) == {"many.bin": stated(out["many.bin"], PART)}
    empty = files.withColumn("length", F.lit(0).cast("long"))
    assert by_name(object_checksums(spark, root, files=empty, part_bytes=PART)) == {"many.bin": hashlib.md5(b"").hexdigest()}
    assert object_checksums(spark, root, files=files.limit(0)).collect() == []
    with pytest.raises(Exception, match="file ends at byte"):
        object_checksums(spark, root, files=files.withColumn("length", F.col("length") + 1), part_bytes=PART).collect()
    with pytest.raises(ValueError):
        object_checksums(spark, root, part_bytes=0)


def test_mismatched(spark):
    have = spark.createDataFrame([("a", "11-2"), ("b", "22"), ("c", "33")], "path string, checksum string")
    told = spark.createDataFrame([("a", '"11-2"'), ("b", "23"), ("d", "44")], "path string, checksum string")
    assert sorted(map(tuple, mismatched(have, told).collect())) == [("b", "22", "23"), ("c", "33", None), ("d", None, "44")]
