"""Quality counts of a stage table from one pass over it.

A profile has, for each combination of a few keys (file, year, district, class), the
number of rows and of those that fail each check. It is small; every quality
table is an aggregate of it, and what depends on the keys alone (is there a rate?) is decided
on the profile, not on the rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

N_ROWS = "n_rows"


def profile(df: DataFrame, keys: Sequence[str], checks: Mapping[str, Column]) -> DataFrame:
    """``keys``, ``n_rows`` and a count for each check (a condition that a bad row meets; NULL: not bad).

    One aggregate with map-side combining: a file or year with a third of all rows costs a row a task.
    """
    clash = set(checks) & {*keys, N_ROWS}
    if clash:
        raise ValueError(f"checks named like keys: {sorted(clash)}")
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(N_ROWS), *[F.count_if(c).alias(n) for n, c in checks.items()])


def totals(found: DataFrame, by: Sequence[str], counts: Mapping[str, Column | str]) -> DataFrame:
    """Counts of a profile added up over the other keys (0, not NULL, over nothing)."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(n) for n, c in counts.items()]
    return found.groupBy(*by).agg(*sums) if by else found.agg(*sums)


def unlisted(found: DataFrame, keys: DataFrame, on: Sequence[str], out: str) -> DataFrame:
    """A profile with ``out``: its rows if their ``on`` values are in no row of ``keys``, else 0."""
    listed = keys.select(*on).distinct().withColumn("_listed", F.lit(True))
    j = found.join(listed, list(on), "left")
    return j.select(*found.columns, F.when(F.col("_listed"), F.lit(0)).otherwise(F.col(N_ROWS)).cast("bigint").alias(out))
