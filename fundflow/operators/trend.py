"""Period-over-period change."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundflow.functions.sqltext import ident


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pct_change(df: DataFrame, value: str, order_by: str, name: str = "pct_change",
               partition_by: Sequence[str] | None = None, scale: float = 100.0) -> DataFrame:
    """``(x / previous x - 1) * scale`` along ``order_by``; the first row is NULL.

    With ``partition_by`` each series is its own window partition (shuffled
    on those keys). Without it the series is global and Spark moves it to one
    partition: call it on an aggregated series (one row per period), never on
    raw rows.
    """
    part = f"PARTITION BY {', '.join(map(ident, partition_by))} " if partition_by else ""
    prev = f"lag({ident(value)}) OVER ({part}ORDER BY {ident(order_by)})"
    return df.withColumn(name, F.expr(f"(try_divide({ident(value)}, {prev}) - 1D) * CAST({scale!r} AS DOUBLE)"))


def avg_change(df: DataFrame, col: str, name: str = "avg_pct_change",
               by: Sequence[str] | None = None) -> DataFrame:
    """Mean of a change column, NULLs (the first period) skipped."""
    a = F.expr(f"avg({ident(col)})").alias(name)
    return df.groupBy(*by).agg(a) if by else df.agg(a)


def col_pct_change(new, base, digits: int = 1) -> Column:
    """Guarded change between two columns: NULL unless ``base > 0``.

    Rounded half-to-even (``bround``) to ``digits`` places.
    """
    if isinstance(new, str) and isinstance(base, str):
        n, b = ident(new), ident(base)
        return F.expr(f"CASE WHEN {b} > 0 THEN bround(100D * ({n} - {b}) / {b}, {digits}) END")
    b = _c(base)
    return F.when(b > 0, F.bround(F.lit(100.0) * (_c(new) - b) / b, digits))
