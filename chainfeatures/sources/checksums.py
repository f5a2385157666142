"""Checksums of files as object stores state them, in bounded memory and parallel within a file.

An object uploaded in one piece has the MD5 of its bytes; one uploaded in parts has the MD5 of its parts' MD5s (as
bytes, in order), a dash and the number of parts.  Every part is a row of its own: parts of one huge file spread over
the tasks, each is read by a ranged read a chunk at a time, and only 32 characters a part are shuffled to its file.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chainfeatures.sources.snapshots import _binary, _store_of, in_dates, list_files, ranged_reads

#: Bytes of a part, and bytes that a task holds at a time.
PART_BYTES, CHUNK_BYTES = 8 << 20, 1 << 20
PART_SCHEMA = "path string, length long, parts long, part long, md5 string"


def _digest(f, first: int, n: int) -> str:
    """MD5 of ``n`` bytes from ``first`` on; bytes that are not there fail the task (the file has changed)."""
    h, at, end = hashlib.md5(), first, first + n
    while at < end:
        piece = f.read_at(min(CHUNK_BYTES, end - at), at)
        if not piece:
            raise OSError(f"file ends at byte {at}, {end} expected")
        h.update(piece)
        at += len(piece)
    return h.hexdigest()


def _digests(batches):
    import pandas as pd

    for pdf in batches:
        out = []
        for path, first, n in zip(pdf["path"], pdf["first"], pdf["n"]):
            fs, at = _store_of(path)
            with fs.open_input_file(at) as f:
                out.append(_digest(f, int(first), int(n)))
        yield pd.DataFrame({"path": pdf["path"], "length": pdf["length"], "parts": pdf["parts"], "part": pdf["part"], "md5": out})


def _cut(files: DataFrame, part_bytes: int | None, threshold: int | None) -> DataFrame:
    """Adds ``parts``: the number of parts a file was uploaded in, 0 for one piece."""
    if part_bytes is None:
        return files.withColumn("parts", F.lit(0).cast("long"))
    if part_bytes < 1:
        raise ValueError("part_bytes must be positive")
    several = F.col("length") >= F.lit(part_bytes if threshold is None else threshold)
    return files.withColumn("parts", F.when(several, F.greatest(F.ceil(F.col("length") / F.lit(part_bytes)), F.lit(1))).otherwise(F.lit(0)).cast("long"))


def _joined(digests):
    """The checksum of a file from the MD5s of its parts in order."""
    return F.when(F.col("parts") == 0, digests[0]).otherwise(
        F.concat(F.md5(F.unhex(F.array_join(digests, ""))), F.lit("-"), F.col("parts").cast("string")))


def object_checksums(spark: SparkSession, root: str | list[str], glob: str = "*.parquet", dates=None, files: DataFrame | None = None,
                     part_bytes: int | None = PART_BYTES, threshold: int | None = None, ranged: bool | None = None) -> DataFrame:
    """(path, length, checksum) of every file under ``root`` (of ``files``: path, length).

    Files of ``threshold`` bytes (default: ``part_bytes``) or more count as uploaded in parts of ``part_bytes``,
    the last one shorter; smaller ones, and all where ``part_bytes`` is None, as uploaded in one piece, which one task
    reads from start to end.  A file of no bytes has the MD5 of nothing; no files give an empty table; files with equal
    bytes have equal checksums.  ``dates`` limits the files to snapshots of those days.  Where
    pyarrow has no reader for the store, Spark's binary reader serves (whole files, up to 2 GB each)."""
    if ranged_reads(root) if ranged is None else ranged:
        if files is None:
            files = _binary(spark, root, glob).filter(in_dates(dates)) if dates is not None else list_files(spark, root, glob)
        units = (_cut(files.select("path", "length"), part_bytes, threshold)
                 .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("parts") - 1, F.lit(0).cast("long"))))))
        step = F.lit(part_bytes or 0).cast("long")
        whole = F.col("parts") == 0
        units = (units.withColumn("first", F.when(whole, F.lit(0).cast("long")).otherwise(F.col("part") * step))
                 .withColumn("n", F.when(whole, F.col("length")).otherwise(F.least(step, F.col("length") - F.col("part") * step))))
        tasks = max(1, spark.sparkContext.defaultParallelism)
        sums = units.repartition(4 * tasks, "path", "part").mapInPandas(_digests, PART_SCHEMA)
        one = sums.groupBy("path", "length", "parts").agg(F.transform(F.array_sort(F.collect_list(F.struct("part", "md5"))), lambda x: x["md5"]).alias("_d"))
        return one.select("path", "length", _joined(F.col("_d")).alias("checksum"))
    content = _binary(spark, root, glob)
    if dates is not None:
        content = content.filter(in_dates(dates))
    if files is not None:
        content = content.join(files.select("path"), "path", "left_semi")
    step = part_bytes or 1
    pieces = F.expr(f"CASE WHEN parts = 0 THEN array(md5(content)) ELSE "
                    f"transform(sequence(0L, parts - 1), i -> md5(substring(content, CAST(i * {step} + 1 AS INT), {min(step, 2**31 - 1)}))) END")
    return _cut(content, part_bytes, threshold).select("path", "length", "parts", pieces.alias("_d")).select("path", "length", _joined(F.col("_d")).alias("checksum"))


def mismatched(checksums: DataFrame, stated: DataFrame) -> DataFrame:
    """(path, checksum, stated) of the files whose checksum is not the one a store or an earlier manifest states;
    ``stated``: (path, checksum).  Quotes around a stated one and its case do not count; a file on one side only has a null on the other."""
    plain = F.lower(F.regexp_replace("checksum", '^"|"$', ""))
    both = checksums.select("path", "checksum").join(stated.select("path", plain.alias("stated")), "path", "full_outer")
    return both.filter(~F.col("checksum").eqNullSafe(F.col("stated")))
