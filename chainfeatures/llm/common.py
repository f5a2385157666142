"""Shared helpers: input normalisation, tables in the shared folder, input size.

Conventions for every operator of this subpackage:

* an operator first projects the columns it needs to names of its own, so extra
  input columns, whatever they are called, never clash;
* a missing (null) text counts as empty;
* intermediates that cut lineage are Parquet tables in the folder named by
  ``spark.checkpoint.dir``; nothing is kept on an executor's own disk.
"""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The shared folder of the session (``spark.checkpoint.dir``); a folder of
    our own only where that setting is absent (local tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="chainfeatures-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


#: Rows for each file of a table whose size is known to be small, and files at least.
ROWS_PER_FILE, LEAST_FILES = 250_000, 8


def shared_table(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Lineage ends at the written files: an executor lost later costs a re-read,
    not a recomputation.  Where about ``rows`` rows are known to come, the table gets a
    number of files that fits them instead of one for each shuffle partition."""
    if rows is not None:
        df = df.coalesce(max(LEAST_FILES, rows // ROWS_PER_FILE))
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/chainfeatures-llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(col: str | None = "text"):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def text_bytes(docs: DataFrame, col: str = "text") -> tuple[int, int]:
    """(rows, UTF-8 bytes of the texts) of the whole table, one JVM-side pass."""
    r = docs.select(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col(col))).alias("b")).first()
    return int(r["n"]), int(r["b"] or 0)


def parts_for(total: int, per_part: int, least: int = 1) -> int:
    """How many parts of about ``per_part`` each hold ``total``: grows with the input."""
    return max(least, math.ceil(total / per_part))


def crc_mod(id_col: str, m: int):
    """crc32 of the id's text, modulo ``m`` (null for a null id)."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(m))


def arrow_batch_rows(spark: SparkSession, rows: int) -> None:
    """Rows per Arrow batch handed to Python: bounds what one worker holds."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


#: Bytes of one Arrow batch handed to Python: what a worker holds whatever the lengths of the texts.
BATCH_BYTES = 16 << 20


def bound_batches(spark: SparkSession) -> None:
    """Batches handed to Python end at ``BATCH_BYTES`` (one longer text is a batch of its own)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def discard(table: DataFrame) -> None:
    """Delete a ``shared_table`` that no later step reads."""
    spark = table.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles() if "/chainfeatures-llm/" in f}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
