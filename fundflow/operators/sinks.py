"""Sinks: delimited output, per-label report sets, stage tables, row counts."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fundflow.session import scratch_path


def write_csv(df: DataFrame, path: str, null_token: str = "", mode: str = "overwrite") -> None:
    """Delimited output with a header (overwrite by default)."""
    (df.write.mode(mode).option("header", True).option("nullValue", null_token)
     .option("emptyValue", '""').option("escape", '"').csv(path))


FOLDER = "Folder"


def unique_folders(df: DataFrame, label_col: str, key_col: str, out: str = FOLDER) -> DataFrame:
    """A folder name for each row: its label, or, where labels of different keys became equal (they
    are cut), the label with a digest of the key behind it. Only the distinct pairs are compared."""
    pairs = df.select(key_col, label_col).distinct()
    named = pairs.select(
        F.col(key_col).alias("_key"),
        F.expr(f"CASE WHEN count(1) OVER (PARTITION BY `{label_col}`) > 1 THEN concat(`{label_col}`, '_', "
               f"substring(md5(coalesce(CAST(`{key_col}` AS STRING), '')), 1, 8)) ELSE `{label_col}` END").alias(out))
    return df.join(named, F.col(key_col).eqNullSafe(F.col("_key")), "left").drop("_key")


def write_split(df: DataFrame, label_col: str, path: str, fmt: str = "parquet",
                mode: str = "overwrite", key_col: str | None = None) -> DataFrame:
    """'One output per label' in a single pass: ``path/<label_col>=<label>/``; returns what was written.

    With ``key_col`` (what the labels were made from) the folders are
    ``path/Folder=<name>/`` of :func:`unique_folders`, and the label stays a
    column: two keys whose cut labels are equal don't share a folder. ``df`` is then staged
    first, as its labels are compared before its rows are written: it runs once.

    The ``rebalance`` hint clusters rows by folder before the write, so a folder
    lands in few files instead of one per input partition, while AQE splits one
    that holds a large share of the rows over several tasks and
    coalesces the small ones (a hot label is never funnelled into one task).
    """
    by = label_col
    if key_col is not None:
        df, by = unique_folders(write_stage(df, scratch_path(df.sparkSession, "split")), label_col, key_col), FOLDER
    (df.hint("rebalance", by).write.mode(mode).partitionBy(by)
     .option("header", True).format(fmt).save(path))
    return df


def write_stage(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Materialise a stage as Parquet in shared storage and read it back.

    Cuts lineage (a lost executor recomputes from the stage table, not from
    the raw files) and is the hand-off between pipeline stages. With
    ``partition_by`` rows are clustered first, so a folder gets few files. What
    is read back has the columns, in order, and the types of ``df``: a padded
    code as partition key stays text.
    """
    out = df.hint("rebalance", *partition_by) if partition_by else df
    w = out.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def observe_rows(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """Attach a row counter filled in by the next action (no second pass)."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int, name: str | None = None) -> DataFrame:
    """A stage table dealt into ``buckets`` by ``keys`` and sorted by them, as a table of the session's catalog.

    Two tables with the same keys and number of buckets are joined (and grouped) on the keys without
    an exchange, as often as they are read: the shuffle is paid once, here. The rows lie under ``path``; ``name`` is
    the table's (default: a new one; see :func:`drop_bucketed`).
    """
    name = name or f"fundflow_{uuid.uuid4().hex[:16]}"
    (df.repartition(buckets, *keys).write.mode("overwrite").option("path", path).bucketBy(buckets, *keys)
     .sortBy(*keys).saveAsTable(name))
    return df.sparkSession.table(name).select(*df.columns)


def drop_bucketed(spark: SparkSession, name: str) -> None:
    """Forget a bucketed table; its rows stay under their path."""
    spark.sql(f"DROP TABLE IF EXISTS `{name}`")


MARKER = "_PUBLISHED"


def _files(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return p, p(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _markers(spark: SparkSession, out: str) -> list[str]:
    """Names of the markers of a report, oldest first: a number and the version that it shows."""
    p, fs = _files(spark, out)
    return sorted(s.getPath().getName() for s in fs.globStatus(p(f"{out}/{MARKER}/*-version-*")) or [])


def published(spark: SparkSession, out: str) -> str | None:
    """Folder of the published version of a report (None: none yet)."""
    markers = _markers(spark, out)
    return f"{out}/{markers[-1].split('-', 1)[1]}" if markers else None


def publish(df: DataFrame, out: str, label_col: str, key_col: str | None = None, fmt: str = "parquet") -> str:
    """SNK-2 as a whole: ``df`` as a total table and one folder per label, made visible together.

    ``df`` runs once, into ``<version>/Total``; the folders of ``<version>/by_label`` are written from that. An empty
    file, the marker that names the version, is created last: readers (:func:`published`, the newest marker) see the
    old report or the new one, never a part, and a run that fails leaves the old. What is older than the old
    version is then deleted; the old one stays for readers that are at it. One run publishes at a time.
    """
    spark = df.sparkSession
    p, fs = _files(spark, out)
    before = _markers(spark, out)
    version = f"version-{uuid.uuid4().hex[:16]}"
    total = f"{out}/{version}/Total"
    df.write.option("header", True).format(fmt).save(total)
    back = spark.read.option("header", True).schema(df.schema).format(fmt).load(total)
    by, split = label_col, back
    if key_col is not None:
        by, split = FOLDER, unique_folders(back, label_col, key_col)
    split.hint("rebalance", by).write.partitionBy(by).option("header", True).format(fmt).save(f"{out}/{version}/by_label")
    number = int(before[-1].split("-", 1)[0]) + 1 if before else 1
    if not fs.createNewFile(p(f"{out}/{MARKER}/{number:012d}-{version}")):
        raise OSError(f"cannot publish {out}/{version}")
    for old in before[:-1]:
        fs.delete(p(f"{out}/{MARKER}/{old}"), False)
    keep = {version, *(m.split("-", 1)[1] for m in before[-1:])}
    for s in fs.globStatus(p(f"{out}/version-*")):
        if s.getPath().getName() not in keep:
            fs.delete(s.getPath(), True)
    return f"{out}/{version}"
