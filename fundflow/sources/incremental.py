"""Gathering that reads only what changed.

A store is a folder with ``rows`` (Parquet, partitioned by the year in the file name) and
``manifest`` (a version for each gather). A gather compares the files found with the last
manifest; the years that a new, changed or vanished file belongs to are read again,
from all their files, and replace their partitions. Other years' files are not opened
(but for their fingerprint, with ``whole``), and their partitions not touched.

The manifest is written last: a gather that fails leaves the old one, and the next
does the same years again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundflow.sources import manifest as mf
from fundflow.sources.readers import read_manifest

YEAR, GATHER = "FileYear", "Gather"


@dataclass
class Gathered:
    """``rows`` of the store, the ``years`` that this gather replaced, those it took away (``gone``), and its number."""

    rows: DataFrame
    years: list[int]
    gone: list[int]
    number: int


def _versions(spark: SparkSession, folder: str) -> list[int]:
    """Numbers of the complete manifests in a folder."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    done = fs.globStatus(path(f"{folder}/version=*/_SUCCESS")) or []
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in done)


def delete_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder of shared storage (nothing happens if there is none)."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def gather_years(spark: SparkSession, folder: str, pattern: str | None, target: str, source: str = "file", whole: bool = False,
                 transform: Callable[[DataFrame], DataFrame] | None = None, null_token: str = "NA", sep: str = ",",
                 skip_bad_lines: bool = False) -> Gathered:
    """Bring the store ``target`` up to date with the files of ``folder`` and return its rows.

    Each row has ``FileYear`` (from its file's name; ``source='dir'``: its folder's) and ``Gather``, the number
    of the gather that wrote it. Files are told apart by size and time, with ``whole`` by their text (then all are
    read through). A file without a year in its name, or one of a changed year that can't be read, fails the
    gather before anything is written. ``transform`` works on the rows of the changed years.
    """
    seen = _versions(spark, f"{target}/manifest")
    number = seen[-1] + 1 if seen else 1
    before = mf.load(spark, f"{target}/manifest/version={seen[-1]}") if seen else None
    now = mf.build(spark, folder, pattern, source=source, whole=whole)
    year = mf.year_from_name("SourceFile").alias(YEAR)
    nameless = now.where(mf.year_from_name("SourceFile").isNull()).limit(1).collect()
    if nameless:
        raise ValueError(f"no year in the name of {nameless[0].path}")
    # Years, not files, come to the driver.
    changed = {r[0] for r in mf.changes(before, now).select(year).distinct().collect()}
    present = {r[0] for r in now.select(year).distinct().collect()}
    years, gone = sorted(changed & present), sorted(changed - present)
    rows = f"{target}/rows"
    if years:
        part = now.where(mf.year_from_name("SourceFile").isin(years))
        mf.first_error(part)
        df = read_manifest(spark, part, null_token, sep, source, skip_bad_lines)
        df = df if transform is None else transform(df)
        df = df.withColumns({GATHER: F.lit(number), YEAR: mf.year_from_name("SourceFile")})
        (df.hint("rebalance", YEAR).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(YEAR).parquet(rows))
        # A year whose files have no rows any more: nothing was written over its partition.
        held = spark.read.option("mergeSchema", True).parquet(rows)
        stale = held.where(F.col(YEAR).isin(years) & (F.col(GATHER) < number)).select(YEAR).distinct()
        for r in stale.collect():
            delete_folder(spark, f"{rows}/{YEAR}={r[0]}")
    for y in gone:
        delete_folder(spark, f"{rows}/{YEAR}={y}")
    mf.store(now, f"{target}/manifest/version={number}")
    if not present:
        raise FileNotFoundError(f"no files under {folder} matching {pattern!r}")
    return Gathered(spark.read.option("mergeSchema", True).parquet(rows), years, gone, number)
