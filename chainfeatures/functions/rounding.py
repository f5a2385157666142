"""Half-even rounding that matches NumPy's ``round`` bit for bit.

NumPy rounds by ``rint(x * 10**d) / 10**d``; Spark's ``rint`` is Java's
``Math.rint`` (half-even), so the same two IEEE operations give the same double.
``bround`` rounds the decimal representation instead and differs on ties.
"+ 0.0" turns a negative zero into 0.0 (equal value, one spelling).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def half_even_sql(expr: str, decimals: int) -> str:
    scale = repr(float(10 ** decimals))
    return f"(rint(({expr}) * {scale}D) / {scale}D + 0.0D)"


def half_even(col, decimals: int):
    c = F.col(col) if isinstance(col, str) else col
    scale = float(10 ** decimals)
    return F.rint(c * F.lit(scale)) / F.lit(scale) + F.lit(0.0)


def round_numerics(df: DataFrame, decimals: int, columns=None) -> DataFrame:
    """Round every floating-point column (integers, strings, dates untouched)."""
    names = columns if columns is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    wanted = set(names)
    return df.select([
        F.expr(half_even_sql(f"CAST(`{f.name}` AS DOUBLE)", decimals)).alias(f.name)
        if f.name in wanted else F.col(f"`{f.name}`")
        for f in df.schema.fields])
