"""Feature coverage report on an enriched table.

One aggregation pass computes rows / non-null rows / min / max of every
feature (partial aggregation per task, one small shuffle), then the single
result row is turned into one row per feature with ``stack``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chainfeatures.plans.registry import FeatureRegistry, create_default_registry


def feature_coverage(enriched: DataFrame, registry: FeatureRegistry | None = None) -> DataFrame:
    reg = registry or create_default_registry()
    pairs = reg.feature_sections()
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, (f, _) in enumerate(pairs):
        c = F.col(f"`{f}`")
        aggs += [F.count(c).alias(f"n{i}"), F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}")]
    one = enriched.agg(*aggs)
    stack = ", ".join(f"'{f}', '{s}', n{i}, lo{i}, hi{i}" for i, (f, s) in enumerate(pairs))
    return one.selectExpr(
        f"_rows AS rows", f"stack({len(pairs)}, {stack}) AS (feature, section, non_null, min_value, max_value)"
    ).select("feature", "section", "rows", "non_null", "min_value", "max_value")
