"""History-context selection and the per-minute sink, against brute force."""

import datetime as dt

from pyspark.sql import functions as F

from chainfeatures.operators import timeline
from chainfeatures.operators.worklist import history_context
from chainfeatures.plans.sinks import write_enriched
from chainfeatures.sources.snapshots import scan_enriched


def _ts(d: dt.datetime) -> int:
    return int(d.strftime("%Y%m%d%H%M"))


def test_history_context_brute_force(spark):
    base = dt.datetime(2025, 3, 1, 9, 30)
    stamps = []
    for day in (0, 1, 2, 6, 7, 13):  # gaps of several days
        for m in range(0, 50, 3):
            stamps.append(_ts(base + dt.timedelta(days=day, minutes=m)))
    avail = spark.createDataFrame([(t, 1.0) for t in stamps], "timestamp_int long, stockPrice double")
    spine = timeline.minute_spine(avail)
    targets = spark.createDataFrame([(t,) for t in stamps[::5]], "timestamp_int long")
    got = {}
    for r in history_context(targets, spine, max_minutes=20, days=5).collect():
        got.setdefault(r["timestamp_int"], []).append((r["back"], r["context_timestamp_int"]))
    for t in stamps[::5]:
        tdate = dt.datetime.strptime(str(t)[:8], "%Y%m%d").date()
        cands = sorted((s for s in stamps if s < t
                        and dt.datetime.strptime(str(s)[:8], "%Y%m%d").date() >= tdate - dt.timedelta(days=5)),
                       reverse=True)[:20]
        assert [c for _, c in sorted(got.get(t, []))] == cands, t


def test_enriched_sink_overwrites_only_its_minutes(spark, tmp_path):
    dest = str(tmp_path / "enriched")
    rows = [("20250301", "0930", 1.0), ("20250301", "0931", 2.0), ("20250302", "0930", 3.0)]
    write_enriched(spark.createDataFrame(rows, "date string, minute string, v double"), dest)
    write_enriched(spark.createDataFrame([("20250301", "0931", 20.0), ("20250301", "0931", 21.0)],
                                         "date string, minute string, v double"), dest)
    back = {(r["date"], r["minute"], r["v"]) for r in scan_enriched(spark, dest).collect()}
    assert back == {("20250301", "0930", 1.0), ("20250301", "0931", 20.0), ("20250301", "0931", 21.0),
                    ("20250302", "0930", 3.0)}
