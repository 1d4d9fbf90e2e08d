"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundflow.session import drop_scratch, scratch_path

#: Text taken into one working block inside a task (characters).
BLOCK_CHARS = 4_000_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole given table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts lineage: what follows re-reads the written table when an executor is
    lost, and the shuffle files that made it may go. The folder is scratch: :func:`unstage` deletes it, or
    ``fundflow.session.drop_scratch`` all of them, once nothing reads them any more.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    w = df.write
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _release(spark)
    return out


def unstage(df: DataFrame) -> None:
    """Delete the folder of a table made by :func:`staged` (not needed any more)."""
    for f in df.inputFiles()[:1]:
        folder = f.rsplit("/", 1)[0]
        if "/fundflow/llm-" in folder:
            drop_scratch(df.sparkSession, [folder])


def _release(spark: SparkSession) -> None:
    """Let Spark's context cleaner drop the shuffle files of finished stages
    now rather than at the driver's next collection of garbage."""
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()


def blocks(batches: Iterable[pd.DataFrame], text: str, limit: int = BLOCK_CHARS) -> Iterator[pd.DataFrame]:
    """Cut Arrow batches into blocks of about ``limit`` characters (a longer
    text is a block of its own; no text is cut)."""
    for pdf in batches:
        if not len(pdf):
            continue
        sizes = pdf[text].str.len().fillna(0).astype("int64").cumsum()
        for _, part in pdf.groupby(sizes // limit, sort=False):
            yield part


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file, as its package has it (or in the folder ``FUNDFLOW_TOKENIZERS``); the files
    are never part of the repository. Workers look for themselves: see :func:`local_tokenizer`."""
    folder = os.environ.get("FUNDFLOW_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return str(public_tokenizers.path(name))


def local_tokenizer(path: str) -> str:
    """A tokenizer file on this machine: the path itself, or where it isn't there, the package's file of that name."""
    return path if os.path.exists(path) else tokenizer_path(os.path.basename(path))


def give_back() -> None:
    """Return to the system what this worker's allocators keep for later: workers outlive tasks, and the next
    stage's memory is counted with it. For the end of a task, or of a batch of texts."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library: it has its own ways
        pass


_KEPT: list = []


def take_worker(name: str, forget: Callable[[], None] | None = None) -> None:
    """Called by an operator as its task begins: what another operator keeps in this worker (tables that serve its
    later tasks) is forgotten. ``forget`` empties what this one keeps."""
    if _KEPT and _KEPT[0] != name:
        if _KEPT[1] is not None:
            _KEPT[1]()
        give_back()
    _KEPT[:] = [name, forget]


def text_column(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text`` with a null text read as empty; other columns go."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
