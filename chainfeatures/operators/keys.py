"""Time-key and path operators over a column of object names/paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainfeatures.functions import timekeys as K


def with_time_key(df: DataFrame, path_col: str = "path") -> DataFrame:
    """Add date, minute, timestamp_int, ts, valid parsed from ``path_col``.

    Three projections (raw pieces, validity, outputs) so each regex runs once
    per row and generated code stays small."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    s1 = df.select(*cols, *[c.alias(n) for n, c in K.time_key_parts(path_col).items()])
    s2 = s1.select("*", *[c.alias(n) for n, c in K.time_key_from_parts().items()])
    return s2.select(*cols, *[c.alias(n) for n, c in K.time_key_outputs().items()])


def valid_names(df: DataFrame, path_col: str = "path") -> DataFrame:
    return with_time_key(df, path_col).filter("valid")


def with_session_position(df: DataFrame, minute_col: str = "minute") -> DataFrame:
    sp = K.session_position(minute_col)
    return df.select("*", sp["sequence_number"].alias("sequence_number"),
                     sp["hour"].alias("hour"), sp["minute"].alias("minute_of_hour"))


def with_path_parts(df: DataFrame, uri_col: str = "uri") -> DataFrame:
    """bucket/key of an 's3://bucket/key' URI (null + uri_valid=false otherwise),
    the key suffix after its first '/', and the date folder of that suffix."""
    u = K.split_uri(uri_col)
    key = F.coalesce(u["key"], F.col(uri_col))
    suffix = K.key_suffix(key)
    return df.select("*", u["bucket"].alias("bucket"), u["key"].alias("key"), u["valid"].alias("uri_valid"),
                     suffix.alias("key_suffix"), K.date_folder(suffix).alias("date_folder"))
