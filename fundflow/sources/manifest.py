"""What a gather found: one row for each file, made in one pass and written down.

A manifest is a small Parquet table, ``path, SourceFile, size, modified, header, digest, error``.
Every file is opened once, on an executor, to make it; the error test, the distinct headers,
the paths of each header and the report of all files read the table, not the files.
Two manifests tell which files are new, changed or gone (:func:`changes`).
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.accumulators import Accumulator
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundflow.functions import clean
from fundflow.session import scratch_path

COLUMNS = ("path string, SourceFile string, size bigint, modified timestamp, header string, digest string, "
           "error string")


def decoded(path: Column) -> Column:
    """A path as it is called: percent escapes undone (a plus sign is no space)."""
    return F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _name_in(path: Column, level: str) -> Column:
    part = r"([^/]+)/[^/]+$" if level == "dir" else r"([^/]+)$"
    return F.regexp_extract(path, part, 1)


def source_file(level: str = "file") -> Column:
    """Provenance: the base file name, or the parent folder name (``level='dir'``)
    when each logical file is a Spark-written folder of part files."""
    return decoded(_name_in(F.col("_metadata.file_path"), level))


def year_from_name(name) -> Column:
    """First run of four digits in a file or folder name, as int (NULL if none)."""
    c = F.col(name) if isinstance(name, str) else name
    return clean.to_int(F.nullif(F.regexp_extract(c, r"(\d{4})", 1), F.lit("")))


def escape_glob(path: str) -> str:
    """A path whose glob characters stand for themselves."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def file_table(spark: SparkSession, path: str, pattern: str | None = None,
               recursive: bool = True) -> DataFrame:
    """``path, size, modified`` of the files under a folder matching the glob ``pattern``.

    Spark's own (parallel) file listing through the ``binaryFile`` source; no
    content is read, and nothing comes to the driver but Spark's own listing.
    """
    r = spark.read.format("binaryFile")
    if pattern:
        r = r.option("pathGlobFilter", pattern)
    if recursive:
        r = r.option("recursiveFileLookup", True)
    return r.load(path).select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def list_files(spark: SparkSession, path: str, pattern: str | None = None,
               recursive: bool = True) -> list[str]:
    """The paths of :func:`file_table` as a list."""
    return [row.path for row in file_table(spark, path, pattern, recursive).select("path").collect()]


def file_heads(files: DataFrame, whole: bool = False, opens: Accumulator | None = None) -> DataFrame:
    """``files`` (``path`` and other columns) with ``header, digest, error`` of each file, read on the executors.

    ``header`` is the whole first line, however long. ``error`` says why a file
    can't be read or decoded (else NULL): of its first line, or with ``whole``
    of all of it (compressed ones are unpacked), a block at a time; ``digest`` is then
    the SHA-256 of the text, else NULL. ``opens`` counts the files opened.
    """
    def heads(batches):
        # Self-contained (imports inside, no module globals): it is pickled by
        # value, so executors need not have this package on their Python path.
        import codecs
        import hashlib

        import pandas as pd
        import pyarrow as pa
        import pyarrow.fs as pafs

        def opened(path: str):
            if opens is not None:
                opens.add(1)
            if path.startswith("file:"):
                local = "/" + path[5:].lstrip("/")
                fs, inner = pafs.LocalFileSystem(), local
            else:
                fs, inner = pafs.FileSystem.from_uri(path)
            packed = "gzip" if path.endswith(".gz") else "bz2" if path.endswith(".bz2") else None
            return fs.open_input_stream(inner, compression=packed)

        def look(path: str):
            text, ended = codecs.getincrementaldecoder("utf-8-sig")(), False
            first, digest = [], hashlib.sha256()
            try:
                with opened(path) as fh:
                    while not ended or whole:
                        block = fh.read(1 << 16)
                        digest.update(block)
                        part = text.decode(block, not block)
                        if not ended:
                            line, mark, _ = part.partition("\n")
                            first.append(line)
                            ended = bool(mark)
                        if not block:
                            break
            except (OSError, UnicodeDecodeError, pa.ArrowException) as e:
                return None, None, f"{type(e).__name__}: {e}"[:500]
            header = "".join(first).rstrip("\r")
            if not header:
                return None, None, "EmptyFile: no header line"
            return header, digest.hexdigest() if whole else None, None

        for b in batches:
            rows = [look(p) for p in b["path"]]
            yield b.assign(**{c: pd.Series([r[i] for r in rows], index=b.index, dtype=object)
                              for i, c in enumerate(("header", "digest", "error"))})

    n = max(1, files.sparkSession.sparkContext.defaultParallelism)
    found = T.StructType([T.StructField(c, T.StringType()) for c in ("header", "digest", "error")])
    return files.repartition(n).mapInPandas(heads, T.StructType([*files.schema, *found]))


def build(spark: SparkSession, path: str | None = None, pattern: str | None = None, paths: Sequence[str] | None = None,
          years: Iterable[int] | None = None, source: str = "file", whole: bool = False,
          opens: Accumulator | None = None) -> DataFrame:
    """The manifest of the files under ``path`` matching ``pattern`` (or of ``paths``, without sizes and times),
    optionally only of those named for ``years`` (``source='dir'``: in folders named for them). Written to the
    shared scratch folder, so each file is opened once however often the manifest is used."""
    files = (spark.createDataFrame([(p, None, None) for p in paths], "path string, size bigint, modified timestamp")
             if paths is not None else file_table(spark, path, pattern))
    if years is not None:
        files = files.where(year_from_name(_name_in(F.col("path"), source)).isin([int(y) for y in years]))
    heads = file_heads(files, whole, opens)
    # A listing's path is as it is called; percent signs in it are the name's own.
    table = heads.select("path", _name_in(F.col("path"), source).alias("SourceFile"), "size", "modified",
                                             "header", "digest", "error")
    return store(table, scratch_path(spark, "manifest"))


def store(table: DataFrame, path: str) -> DataFrame:
    """Write a manifest and read it back."""
    # Few rows to a file; the files' heads are read by as many tasks as before.
    table.hint("rebalance").write.mode("overwrite").parquet(path)
    return load(table.sparkSession, path)


def load(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(COLUMNS).parquet(path)


def first_error(manifest: DataFrame) -> None:
    """Raise for a file that can't be read."""
    bad = manifest.where("error is not null").orderBy("path").limit(1).collect()
    if bad:
        raise OSError(f"cannot read {bad[0].path}: {bad[0].error}")


def sources_report(manifest: DataFrame, rows_per_source: DataFrame | None) -> DataFrame:
    """``SourceFile, seen, n_rows, error`` of every file (folder) of a manifest; ``rows_per_source`` counts rows by ``SourceFile``."""
    expected = manifest.groupBy("SourceFile").agg(F.max("error").alias("error"))
    if rows_per_source is None:
        return expected.select("SourceFile", F.lit(False).alias("seen"), F.lit(0).cast("bigint").alias("n_rows"), "error")
    return expected.join(rows_per_source, "SourceFile", "left").select(
        "SourceFile", F.col("error").isNull().alias("seen"), F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"),
        "error")


def fingerprint() -> Column:
    """What tells a file's state from another: its text's digest, or size and time where it wasn't read whole."""
    return F.coalesce(F.col("digest"), F.concat_ws(":", F.col("size").cast("string"), F.col("modified").cast("string")))


def changes(before: DataFrame | None, now: DataFrame) -> DataFrame:
    """``path, SourceFile, change`` of the files that are ``new``, ``changed`` or ``gone`` between two manifests."""
    new = now.select("path", F.col("SourceFile").alias("_now"), fingerprint().alias("_new"), F.lit(True).alias("_is"))
    if before is None:
        return new.select("path", F.col("_now").alias("SourceFile"), F.lit("new").alias("change"))
    old = before.select("path", F.col("SourceFile").alias("_before"), fingerprint().alias("_old"), F.lit(True).alias("_was"))
    both = old.join(new, "path", "full")
    change = (F.when(F.col("_was").isNull(), "new").when(F.col("_is").isNull(), "gone")
              .when(~F.col("_old").eqNullSafe(F.col("_new")), "changed"))
    return (both.select("path", F.coalesce("_now", "_before").alias("SourceFile"), change.alias("change"))
            .where("change is not null"))
