"""Aggregates with the NULL rules of the reference (missing values skipped, an
all-missing sum is 0)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundflow.functions.sqltext import ident


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sum0(c) -> Column:
    """Sum skipping NULLs; a group with no non-NULL value sums to 0, not NULL."""
    if isinstance(c, str):
        return F.expr(f"coalesce(sum({ident(c)}), 0D)")
    return F.coalesce(F.sum(c), F.lit(0.0))


def sum_across(cols: Sequence) -> Column:
    """One total over several columns *and* all rows of a group, NULLs skipped."""
    if all(isinstance(c, str) for c in cols):
        row = " + ".join(f"coalesce(CAST({ident(c)} AS DOUBLE), 0D)" for c in cols)
        return F.expr(f"coalesce(sum({row}), 0D)")
    row = reduce(lambda a, b: a + b, [F.coalesce(_c(c).cast("double"), F.lit(0.0)) for c in cols])
    return F.coalesce(F.sum(row), F.lit(0.0))


def sum_by(df: DataFrame, keys: Sequence[str], sums: dict[str, str]) -> DataFrame:
    """``{out_name: column}`` sums per group with ``sum0`` semantics."""
    return df.groupBy(*keys).agg(*[sum0(c).alias(n) for n, c in sums.items()])


def mean_by(df: DataFrame, keys: Sequence[str], value: str, name: str,
            drop_null_keys: bool = True) -> DataFrame:
    """Mean per group. Like pandas ``groupby`` the NULL-key groups are dropped by default."""
    src = df
    if drop_null_keys:
        src = src.filter(" AND ".join(f"{ident(k)} IS NOT NULL" for k in keys))
    return src.groupBy(*keys).agg(F.expr(f"avg({ident(value)})").alias(name))


def mean_of_means(df: DataFrame, outer: Sequence[str], inner: Sequence[str], value: str,
                  inner_name: str, outer_name: str) -> DataFrame:
    """Unweighted mean over ``inner`` groups of the per-group mean, per ``outer`` group.

    Two aggregations; the second runs on the (small) per-group result.
    """
    first = mean_by(df, list(outer) + list(inner), value, inner_name)
    return mean_by(first, outer, inner_name, outer_name)


def invalid_counts(df: DataFrame, keys: Sequence[str], value: str,
                   count_name: str = "n_rows", invalid_name: str = "n_invalid") -> DataFrame:
    """Rows and rows with a missing or negative ``value`` per group, in one pass."""
    v = ident(value)
    return df.groupBy(*keys).agg(F.expr("count(1)").alias(count_name),
                                 F.expr(f"count_if({v} IS NULL OR {v} < 0)").alias(invalid_name))
