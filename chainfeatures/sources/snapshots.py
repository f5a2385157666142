"""Snapshot files: listing, footers, scanning, checksums.

Two layouts are read:

* the reference layout ``<root>/one-minute/YYYYMMDD/strikes_YYYYMMDDHHMM.parquet``
  (time key in the file name, ``_metadata.file_path``), and
* the Spark-native layout written by ``plans.sinks.write_enriched``
  (``<root>/date=YYYYMMDD/...``).

Every file has a schema of its own: footers are read in parallel through Spark's
own file readers, files are grouped by schema, and each group is one
columnar scan cast to the known types.  No file's schema decides for another, and
an unreadable or incomplete file is a reported failure, never an ended job.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainfeatures.config import OPTIONAL_COLUMNS, REQUIRED_COLUMNS
from chainfeatures.session import materialize

FOOTER_SCHEMA = "path string, length long, rows long, fields string, error string, read_bytes long"
#: Types that known columns are read as; other columns keep the type of their files.
KNOWN_TYPES = {"expirDate": "string", **{c: "double" for c in ("stockPrice", "strike", *OPTIONAL_COLUMNS)}}


def _binary(spark: SparkSession, root: str | list[str], glob: str = "*.parquet") -> DataFrame:
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", glob).load(root))


def list_files(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """(path, length, modificationTime) of every file under ``root`` matching
    ``glob``; the file content is never read (column pruned).  Spark lists no files of length 0."""
    return _binary(spark, root, glob).select("path", "length", "modificationTime")


def file_checksums(spark: SparkSession, root: str, glob: str = "*.parquet", dates=None) -> DataFrame:
    """(path, length, md5) of each file: the MD5 of its bytes, which is the
    object-store ETag of a single-part upload.  ``dates`` prunes the files read."""
    files = _binary(spark, root, glob)
    if dates is not None:
        files = files.filter(in_dates(dates))
    return files.select("path", "length", F.md5("content").alias("md5"))


def in_dates(dates):
    """Predicate on the file path alone, so that files of other days are not opened."""
    return F.regexp_extract(F.col("_metadata.file_path"), r"strikes_(\d{8})\d{4}\.parquet$", 1).isin(sorted(dates))


def _plain_path():
    """The scanned file's path as the listing spells it (``_metadata`` escapes spaces and the like)."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def _footer(path: str, length: int, read) -> tuple:
    """One file's row from ``read(first byte, bytes)``: its last 8 bytes, then its footer, nothing else."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    from pyspark.sql.pandas.types import from_arrow_type

    got = 0
    try:
        end = read(max(0, length - 8), min(8, length))
        got = len(end)
        size = int.from_bytes(end[:4], "little")
        if length < 12 or end[4:] != b"PAR1" or size + 12 > length:
            raise pa.ArrowInvalid("no footer")
        tail = read(length - 8 - size, size)
        got += size
        f = pq.ParquetFile(pa.BufferReader(tail + end))
        fields = [[x.name, from_arrow_type(x.type).simpleString()] for x in f.schema_arrow]
        return path, length, f.metadata.num_rows, json.dumps(fields), None, got
    except (pa.ArrowException, ValueError, TypeError, NotImplementedError) as e:  # the bytes came, so this is the file's fault
        return path, length, None, None, f"unreadable: {type(e).__name__}", got


def _footer_frame(rows):
    import pandas as pd

    names = [c.split()[0] for c in FOOTER_SCHEMA.split(", ")]
    return pd.DataFrame(rows, columns=names).astype({"length": "Int64", "rows": "Int64", "read_bytes": "Int64"})


def _store_of(path: str):
    """pyarrow's file system for a path as Spark lists it, and the path there."""
    import pyarrow.fs as pafs

    scheme, _, rest = path.partition(":")
    if not rest or "/" in scheme or scheme == "file":
        return pafs.LocalFileSystem(), "/" + (rest if scheme == "file" else path).lstrip("/")
    authority, _, key = rest.lstrip("/").partition("/")
    fs, base = pafs.FileSystem.from_uri(f"{scheme}://{authority}/")
    return fs, f"{base.rstrip('/')}/{key}" if base.strip("/") else f"/{key}"


def _ranged(batches):
    """Footers by ranged reads: a failing store fails (and retries) the task."""
    for pdf in batches:
        rows = []
        for path, length in zip(pdf["path"], pdf["length"]):
            fs, at = _store_of(path)
            with fs.open_input_file(at) as f:
                rows.append(_footer(path, int(length), lambda first, n, f=f: f.read_at(n, first)))
        yield _footer_frame(rows)


def _tails(batches):
    """Footers of the tails that Spark's binary reader cut out."""
    for pdf in batches:
        rows = []
        for path, length, tail in zip(pdf["path"], pdf["length"], pdf["tail"]):
            first = int(length) - len(tail)
            rows.append(_footer(path, int(length), lambda at, n, t=tail, f=first: t[max(0, at - f):max(0, at - f) + n]))
        yield _footer_frame(rows)


def ranged_reads(root: str | list[str]) -> bool:
    """Whether pyarrow can open the store that holds ``root``."""
    import pyarrow as pa

    try:
        _store_of(root if isinstance(root, str) else root[0])
        return True
    except (pa.ArrowException, ValueError, OSError, NotImplementedError):
        return False


def file_footers(spark: SparkSession, root: str | list[str], files: DataFrame | None = None, ranged: bool | None = None) -> DataFrame:
    """(path, length, rows, fields, error, read_bytes) of every file (of ``files``: path, length), from its footer.

    Tasks read the last 8 bytes and the footer of their files, whatever the files' size.  Where pyarrow has no reader for
    the store, Spark's binary reader serves: it reads whole files (up to 2 GB), of which only the tail
    is handed to Python.  ``error`` tells of bytes that are no footer."""
    if ranged_reads(root) if ranged is None else ranged:
        files = list_files(spark, root) if files is None else files
        tasks = max(1, spark.sparkContext.defaultParallelism)
        return files.select("path", "length").repartition(4 * tasks, "path").mapInPandas(_ranged, FOOTER_SCHEMA)
    size = F.expr("CAST(conv(concat(hex(substring(content, -5, 1)), hex(substring(content, -6, 1)), "
                  "hex(substring(content, -7, 1)), hex(substring(content, -8, 1))), 16, 10) AS BIGINT)")
    content = _binary(spark, root).withColumn("_n", F.when(F.col("length") >= 12, size))
    if files is not None:
        content = content.join(files.select("path"), "path", "left_semi")
    whole = F.coalesce(F.col("_n") + 8 <= F.col("length"), F.lit(False))
    tail = F.when(whole, F.expr("substring(content, CAST(-(_n + 8) AS INT), CAST(_n + 8 AS INT))")).otherwise(F.expr("substring(content, -8, 8)"))
    return content.select("path", "length", tail.alias("tail")).mapInPandas(_tails, FOOTER_SCHEMA)


def footer_failures(footers: DataFrame) -> DataFrame:
    """Files that must not enter the queue: (path, error, error_type)."""
    names = F.transform(F.from_json("fields", "array<array<string>>"), lambda x: x[0])
    missing = F.array_except(F.array(*[F.lit(c) for c in REQUIRED_COLUMNS]), names)
    f = footers.withColumn("_missing", F.when(F.col("fields").isNotNull(), F.array_join(missing, ",")))
    error = (F.when(F.col("error").isNotNull(), F.col("error"))
             .when(F.col("rows") == 0, F.lit("Empty parquet file"))
             .when(F.col("_missing") != "", F.concat(F.lit("Missing required columns: "), F.col("_missing"))))
    kind = F.when(F.col("error").isNotNull(), F.lit("OSError")).otherwise(F.lit("ValueError"))
    return f.select("path", error.alias("error"), kind.alias("error_type")).filter(F.col("error").isNotNull())


def _out_types(schemas: list[list[list[str]]]) -> dict[str, str]:
    """One type for each column of all files: the known one, the common one, or a wider one."""
    seen: dict[str, set] = {}
    for fields in schemas:
        for name, kind in fields:
            seen.setdefault(name, set()).add(kind)
    numbers = {"tinyint", "smallint", "int", "bigint", "float", "double"}
    out = {}
    for name, kinds in seen.items():
        one = kinds.pop() if len(kinds) == 1 else None
        out[name] = KNOWN_TYPES.get(name) or one or ("double" if kinds <= numbers else "string")
    return out


def scan_snapshots(spark: SparkSession, root: str | list[str], footers: DataFrame | None = None, keep_invalid: bool = False,
                   dates=None, tolerant: bool = False) -> DataFrame:
    """Rows of every readable ``strikes_*.parquet`` snapshot under ``root`` with the time key taken
    from the file name: timestamp_int, date, minute, path, then the files' columns.

    Columns that only some files have are null elsewhere; extra columns pass through; known
    columns are read as doubles (``expirDate`` as a string) whatever the file holds.  Files
    that ``footer_failures`` reports are left out, as are names that are no time key (unless
    ``keep_invalid``).  ``dates`` limits the files opened to those days.  ``tolerant`` goes on past
    broken data pages; compare the rows read with the footers' then (``operators.quality.minute_facts``).

    Where all files agree, the folder is one scan; else each schema is a scan of its
    files.  The list of a group's files is what Spark's own file index holds on the driver."""
    footers = materialize(file_footers(spark, root)) if footers is None else footers
    bad = footer_failures(footers)
    good = footers.join(bad.select("path"), "path", "left_anti")
    groups = [r["fields"] for r in good.select("fields").distinct().collect()]  # distinct schemas
    from chainfeatures.operators.keys import with_time_key

    if not groups:
        schemas, sources = [[[c, KNOWN_TYPES.get(c, "double")] for c in REQUIRED_COLUMNS]], []
    else:
        schemas = [json.loads(g) for g in groups]
        one = len(groups) == 1 and bad.isEmpty()
        sources = [[root] if isinstance(root, str) else root] if one else [[r["path"] for r in good.filter(F.col("fields") == g).select("path").collect()] for g in groups]
    types = _out_types(schemas)
    out = None
    for fields, paths in zip(schemas, sources):
        reader = (spark.read.schema(", ".join(f"`{n}` {t}" for n, t in fields)).option("recursiveFileLookup", "true")
                  .option("pathGlobFilter", "*.parquet").option("ignoreCorruptFiles", str(tolerant).lower()))
        df = reader.parquet(*paths)
        if dates is not None:
            df = df.filter(in_dates(dates))
        df = df.select(_plain_path().alias("path"), *[F.col(f"`{n}`").cast(types[n]).alias(n) for n, _ in fields])
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        out = spark.createDataFrame([], "path string, " + ", ".join(f"`{n}` {t}" for n, t in types.items()))
    df = with_time_key(out, "path")
    if not keep_invalid:
        df = df.filter("valid")
    return df.select("timestamp_int", "date", "minute", "path", *[F.col(f"`{c}`") for c in types])


def scan_enriched(spark: SparkSession, root: str) -> DataFrame:
    """Enriched rows: the committed ones of a store (``plans.store``), or a folder with ``date`` (and ``minute``) as
    partition columns, so that filters on them prune directories."""
    from chainfeatures.plans.store import SlabStore

    store = SlabStore(spark, root)
    if store.exists():
        return store.read("rows")
    df = spark.read.parquet(root)
    return (df.withColumn("date", F.lpad(F.col("date").cast("string"), 8, "0"))
            .withColumn("minute", F.lpad(F.col("minute").cast("string"), 4, "0")))
