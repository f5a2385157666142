"""Versioned tables of time slabs: what a commit does not name stays, what it names is seen at once or not at all.

A table is a set of *slabs* (all rows of one day, or of one month), each written by one version::

    <root>/<table>/v=<n>/slab=<s>/part-*.parquet
    <root>/_log/v=<n>/part-*.parquet and _SUCCESS

The log of version n has one row for each slab of each table: the version that wrote it and its rows.  A
commit writes the changed slabs under a new number and then the log; Spark's ``_SUCCESS`` marker of the log is
the commit.  Readers take the newest log that has one, so they never see half a commit, and a
crashed commit is overwritten by the next one.  One writer at a time; readers keep their version until ``vacuum``.
Only the log (one row for each slab) is ever on the driver.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOG_SCHEMA = "table string, slab string, version long, rows long, fields string"


class SlabStore:
    def __init__(self, spark: SparkSession, root: str, slab_chars: int = 8):
        """``slab_chars``: leading characters of ``date`` (YYYYMMDD) that name a slab: 8 for days, 6 for months."""
        self.spark, self.root, self.slab_chars = spark, root.rstrip("/"), slab_chars

    # -- log ------------------------------------------------------------------------------

    def _hadoop(self, path: str):
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        p, fs = self._hadoop(f"{self.root}/_log/v=*/_SUCCESS")
        return sorted(int(re.search(r"/v=(\d+)/", s.getPath().toString()).group(1)) for s in fs.globStatus(p) or [])

    def log(self, version: int | None = None) -> list:
        """Rows (table, slab, version, rows, fields) of a version, the newest by default."""
        if version is None:
            version = max(self.versions(), default=0)
        return self.spark.read.schema(LOG_SCHEMA).parquet(f"{self.root}/_log/v={version}").collect() if version else []

    def exists(self) -> bool:
        return bool(self.versions())

    def slabs(self, table: str, version: int | None = None) -> dict[str, int]:
        """Rows of every slab."""
        return {r["slab"]: r["rows"] for r in self.log(version) if r["table"] == table and r["slab"] is not None}

    # -- reading -----------------------------------------------------------------------------

    def read(self, table: str, slabs=None, version: int | None = None) -> DataFrame | None:
        """The committed rows, of some slabs only where named: partition filters, so other folders are not opened.
        None for a table that was never written."""
        mine = [r for r in self.log(version) if r["table"] == table]
        if not mine:
            return None
        fields = _joined([json.loads(f) for f in {r["fields"] for r in mine}])
        wanted: dict[int, list[str]] = {}
        for r in mine:
            if r["slab"] is not None and (slabs is None or r["slab"] in slabs):
                wanted.setdefault(r["version"], []).append(r["slab"])
        if not wanted:
            return self.spark.createDataFrame([], fields)
        base = f"{self.root}/{table}"
        df = self.spark.read.schema(T.StructType([*fields, T.StructField("v", T.LongType()), T.StructField("slab", T.StringType())])).option(
            "basePath", base).parquet(*[f"{base}/v={v}" for v in sorted(wanted)])
        keep = F.lit(False)
        for v, names in sorted(wanted.items()):
            keep = keep | ((F.col("v") == v) & F.col("slab").isin(sorted(names)))
        return df.filter(keep).drop("v", "slab")

    # -- writing -----------------------------------------------------------------------------

    def slab_of(self, date):
        return F.substring(date, 1, self.slab_chars)

    def commit(self, changes: dict[str, tuple[DataFrame, list[str] | None]], spread: tuple = ("rows",)) -> int:
        """Replace slabs of several tables in one step: ``{table: (rows with a date column, slabs)}``.

        All rows of the named slabs are replaced by the given ones (none left: the slab goes); None names
        every slab of the table.  The rows may be read from this very store.  Slabs of the tables ``spread`` are written by
        several tasks each; those of the others (a row for each minute or file) by one."""
        old = self.log()
        n = max([r["version"] for r in old] + self.versions(), default=0) + 1
        log = [tuple(r) for r in old if r["table"] not in changes]
        parts = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        for table, (df, slabs) in changes.items():
            kept = [r for r in old if r["table"] == table and r["slab"] is not None and slabs is not None and r["slab"] not in slabs]
            fields = _joined([json.loads(r["fields"]) for r in old if r["table"] == table] + [json.loads(df.schema.json())])
            rows = df.select("*", self.slab_of("date").alias("slab"))
            # the next two characters (hours of a day, days of a month) spread a slab over tasks; files are sorted by time
            piece = F.substring(F.lpad(F.col("timestamp_int").cast("string"), 12, "0"), self.slab_chars + 1, 2) if table in spread and "timestamp_int" in df.columns else F.lit("")
            order = ["slab"] + (["timestamp_int"] if "timestamp_int" in df.columns else [])
            path = f"{self.root}/{table}/v={n}"
            rows.repartition(parts, "slab", piece).sortWithinPartitions(*order).write.mode("overwrite").partitionBy("slab").parquet(path)
            written = self.spark.read.schema("slab string").parquet(path).groupBy("slab").count().collect()  # from the footers
            text = fields.json()
            log += [(table, None, n, 0, text)] + [(table, r["slab"], r["version"], r["rows"], text) for r in kept]
            log += [(table, r["slab"], n, r["count"], text) for r in written]
        self.spark.createDataFrame(log, LOG_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/_log/v={n}")
        return n

    def vacuum(self, keep: int = 2) -> None:
        """Delete the logs before the newest ``keep`` ones, and the slabs that only they name."""
        versions = self.versions()
        if len(versions) <= keep:
            return
        held = {(r["table"], r["slab"], r["version"]) for v in versions[-keep:] for r in self.log(v)}
        for v in versions[:-keep]:
            for r in self.log(v):
                if r["slab"] is not None and (r["table"], r["slab"], r["version"]) not in held:
                    p, fs = self._hadoop(f"{self.root}/{r['table']}/v={r['version']}/slab={r['slab']}")
                    fs.delete(p, True)
        for v in versions[:-keep]:
            p, fs = self._hadoop(f"{self.root}/_log/v={v}")
            fs.delete(p, True)


def _joined(schemas: list) -> T.StructType:
    """All fields of several schemas (as JSON values); a field has one type."""
    out: dict[str, T.StructField] = {}
    for s in schemas:
        for f in T.StructType.fromJson(s).fields:
            if f.name in out and out[f.name].dataType != f.dataType:
                raise ValueError(f"column {f.name}: {out[f.name].dataType.simpleString()} and {f.dataType.simpleString()}")
            out.setdefault(f.name, T.StructField(f.name, f.dataType, True))
    return T.StructType(list(out.values()))
