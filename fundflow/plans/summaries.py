"""Summaries that follow an incremental gather: only the changed years are summed again.

The store's rows of a year are summed into partial sums by (file year, file, keys), which lie
beside them, partitioned by file year. A gather that replaced some years replaces their
partials; the summary is the sum of all partials, a table of (files x keys) rows. A
full recomputation from the rows gives the same.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundflow.operators import agg
from fundflow.sources.incremental import GATHER, YEAR, Gathered, delete_folder


def refresh(gathered: Gathered, target: str, shares: Callable[[DataFrame], DataFrame], keys: Sequence[str],
            sums: Sequence[str]) -> DataFrame:
    """Bring the partial sums ``target`` up to date with a gather and return the summary: ``keys`` and ``sums``.

    ``shares`` makes rows with ``keys`` and ``sums`` of the store's rows (which keep ``FileYear`` and ``SourceFile``); it
    sees the rows of changed years only. Partials older than their rows (of a refresh that failed) are made again.
    """
    spark = gathered.rows.sparkSession
    made = _made(gathered, target)
    held = {r[0]: r[1] for r in gathered.rows.groupBy(YEAR).agg(F.max(GATHER)).collect()}
    years = sorted(y for y, number in held.items() if made.get(y) != number)
    by = [YEAR, GATHER, "SourceFile", *keys]
    if years:
        part = shares(gathered.rows.where(F.col(YEAR).isin(years)))
        part = part.groupBy(*by).agg(*[agg.sum0(c).alias(c) for c in sums])
        (part.hint("rebalance", YEAR).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(YEAR).parquet(target))
    for y in set(made) - set(held):
        delete_folder(spark, f"{target}/{YEAR}={y}")
    return spark.read.parquet(target).groupBy(*keys).agg(*[agg.sum0(c).alias(c) for c in sums])


def _made(gathered: Gathered, target: str) -> dict[int, int]:
    """Number of the gather that each year's partials are of."""
    spark = gathered.rows.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return {}
    return {r[0]: r[1] for r in spark.read.parquet(target).groupBy(YEAR).agg(F.max(GATHER)).collect()}
