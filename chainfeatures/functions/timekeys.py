"""Time keys taken from snapshot file names and object paths.

All functions return Columns, so name parsing runs inside the scan's codegen
stage; an invalid name gives null parts and ``valid = false`` instead of an
exception, and callers route such rows to quarantine.  The time key is parsed
in stages (``time_key_parts`` -> ``time_key_from_parts`` -> ``time_key_outputs``,
composed by ``operators.keys.with_time_key``) so no regex runs twice per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chainfeatures.config import FILE_NAME_PATTERN, MARKET_OPEN_HOUR, MARKET_OPEN_MINUTE


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def file_name(path) -> Column:
    """Last path segment (the whole string when it has no '/')."""
    return F.element_at(F.split(_c(path), "/"), -1)


def time_key_parts(path) -> dict:
    """Stage 1 of the time key: the raw pieces of the name (cheap to reuse)."""
    name = file_name(path)
    return {
        "_tk_match": name.rlike(FILE_NAME_PATTERN),
        "_tk_d": F.regexp_extract(name, FILE_NAME_PATTERN, 1),
        "_tk_m": F.regexp_extract(name, FILE_NAME_PATTERN, 2),
    }


def time_key_from_parts() -> dict:
    """Stage 2: date, minute, timestamp_int, ts, valid from the stage-1 columns.

    The name must match ``strikes_<8 digits><4 digits>.parquet``, the date be a
    real calendar date (year >= 1), the hour 0-23 and the minute 0-59.
    """
    d, m = F.col("_tk_d"), F.col("_tk_m")
    day = F.try_to_timestamp(d, F.lit("yyyyMMdd"))
    hh = F.substring(m, 1, 2).try_cast("int")
    mm = F.substring(m, 3, 2).try_cast("int")
    valid = F.coalesce(F.col("_tk_match") & day.isNotNull() & (F.substring(d, 1, 4).try_cast("int") >= 1)
                       & hh.between(0, 23) & mm.between(0, 59), F.lit(False))
    return {"_tk_valid": valid}


def time_key_outputs() -> dict:
    v, d, m = F.col("_tk_valid"), F.col("_tk_d"), F.col("_tk_m")
    return {
        "date": F.when(v, d),
        "minute": F.when(v, m),
        "timestamp_int": F.when(v, F.concat(d, m).try_cast("long")),
        "ts": F.when(v, F.try_to_timestamp(F.concat(d, m), F.lit("yyyyMMddHHmm"))),
        "valid": v,
    }


def timestamp_int_of(ts) -> Column:
    """yyyyMMddHHmm as a long, from a timestamp column."""
    return F.date_format(_c(ts), "yyyyMMddHHmm").try_cast("long")


def session_position(minute_str) -> Column:
    """Minutes since the 09:30 open (negative before it), hour and minute."""
    m = _c(minute_str)
    hh = F.substring(m, 1, 2).try_cast("int")
    mm = F.substring(m, 3, 2).try_cast("int")
    seq = hh * 60 + mm - F.lit(MARKET_OPEN_HOUR * 60 + MARKET_OPEN_MINUTE)
    return F.struct(seq.alias("sequence_number"), hh.alias("hour"), mm.alias("minute"))


def key_suffix(key) -> Column:
    """Part of an object key after its first '/', or the key itself."""
    k = _c(key)
    pos = F.instr(k, "/")
    return F.when(pos > 0, F.substring(k, pos + 1, F.length(k))).otherwise(k)


def date_folder(suffix) -> Column:
    """First segment of a 'date/file' key suffix, 'unknown' if it has one segment."""
    parts = F.split(_c(suffix), "/")
    return F.when(F.size(parts) >= 2, parts[0]).otherwise(F.lit("unknown"))


def split_uri(uri) -> Column:
    """struct(bucket, key, valid) for 's3://bucket/key'; anything else is invalid."""
    u = _c(uri)
    rest = F.substring(u, 6, F.length(u))
    pos = F.instr(rest, "/")
    ok = F.coalesce(u.startswith("s3://") & (pos > 0), F.lit(False))
    return F.struct(
        F.when(ok, F.substring(rest, 1, pos - 1)).alias("bucket"),
        F.when(ok, F.substring(rest, pos + 1, F.length(rest))).alias("key"),
        ok.alias("valid"),
    )
