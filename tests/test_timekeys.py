"""Time-key, session-position and path examples (file names from the
reference's documented examples plus broken variants)."""

import pytest
from pyspark.sql import functions as F

from chainfeatures.operators import keys


def _parse(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "path string")
    rows = keys.with_time_key(df, "path").collect()
    return {r["path"]: r for r in rows}


def test_valid_names(spark):
    got = _parse(spark, ["strikes_202503250935.parquet",
                         "s3://bucket/path/strikes_202503250935.parquet",
                         "one-minute/20240229/strikes_202402291200.parquet"])
    r = got["strikes_202503250935.parquet"]
    assert (r["date"], r["minute"], r["timestamp_int"], r["valid"]) == ("20250325", "0935", 202503250935, True)
    r = got["s3://bucket/path/strikes_202503250935.parquet"]
    assert (r["date"], r["minute"]) == ("20250325", "0935")
    assert got["one-minute/20240229/strikes_202402291200.parquet"]["valid"]  # leap day


@pytest.mark.parametrize("name", [
    "invalid_file.parquet", "strikes_202513010935.parquet", "strikes_202503252460.parquet",
    "strikes_202503251260.parquet", "xstrikes_202503250935.parquet", "strikes_202503250935.parquet.tmp",
    "strikes_202502300935.parquet", "strikes_000001010935.parquet", "strikes_20250325093.parquet",
    "strikes_2025032509355.parquet", ""])
def test_invalid_names(spark, name):
    r = _parse(spark, [name])[name]
    assert r["valid"] is False and r["date"] is None and r["timestamp_int"] is None


def test_session_position(spark):
    df = spark.createDataFrame([("0930",), ("1000",), ("1600",), ("0915",)], "minute string")
    out = {r["minute"]: (r["sequence_number"], r["hour"], r["minute_of_hour"])
           for r in keys.with_session_position(df, "minute").collect()}
    assert out == {"0930": (0, 9, 30), "1000": (30, 10, 0), "1600": (390, 16, 0), "0915": (-15, 9, 15)}


def test_path_parts(spark):
    df = spark.createDataFrame([("s3://src/one-minute/20250724/strikes_202507240931.parquet",),
                                ("one-minute/x.parquet",), ("s3://bucket",), ("s3://b/",)], "uri string")
    out = {r["uri"]: r for r in keys.with_path_parts(df, "uri").collect()}
    r = out["s3://src/one-minute/20250724/strikes_202507240931.parquet"]
    assert (r["bucket"], r["key"], r["uri_valid"]) == ("src", "one-minute/20250724/strikes_202507240931.parquet", True)
    assert r["key_suffix"] == "20250724/strikes_202507240931.parquet" and r["date_folder"] == "20250724"
    assert out["one-minute/x.parquet"]["uri_valid"] is False
    assert out["one-minute/x.parquet"]["key_suffix"] == "x.parquet"
    assert out["one-minute/x.parquet"]["date_folder"] == "unknown"
    assert out["s3://bucket"]["uri_valid"] is False
    assert (out["s3://b/"]["bucket"], out["s3://b/"]["key"]) == ("b", "")
