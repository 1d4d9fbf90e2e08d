"""File sources: by-name multi-file CSV, typed scans, malformed-line skipping.

Spark's multi-file CSV read aligns columns by *position* of the first file's
header. Yearly exports often reorder or add columns, so ``read_many`` groups
files by their header (from a manifest, which opens each file once on the executors) and
reads each group once, then unions by *name* with missing columns NULL. No
reader drops rows or files that it wasn't told to: ``read_many`` fails on a
file that can't be read, ``read_tolerant`` leaves it out and reports it; lines that are
skipped can be had from the same scan (``stage_lines``).
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundflow.functions import clean
from fundflow.sources import manifest as mf
from fundflow.sources.manifest import escape_glob, source_file


def _split_header(line: str, sep: str) -> list[str]:
    import csv
    return [c.strip() for c in next(csv.reader([line], delimiter=sep))]


def all_string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


CORRUPT_COL = "_line"
FIELDS_COL = "_fields"


def read_csv_text(spark: SparkSession, paths: Sequence[str] | str, columns: Sequence[str],
                  null_token: str = "NA", skip_bad_lines: bool = False, sep: str = ",",
                  source: str | None = "file", multiline: bool = False,
                  pattern: str | None = None, keep_lines: bool = False) -> DataFrame:
    """All-text CSV read with a header, ``null_token`` and blank text as NULL.

    An unreadable file fails the read (see :func:`read_tolerant` for the
    alternative). ``skip_bad_lines`` drops lines with more fields than the
    header (pandas ``on_bad_lines='skip'``), empty ones and missing-value
    tokens included, and keeps short lines padded with NULL: the text of every
    line whose field count is not the header's is kept aside, and its fields
    are counted outside quotes. With ``keep_lines`` they stay: ``_line`` has the text
    of such a line and ``_fields`` its number of fields (NULL for lines to be kept); see
    :func:`stage_lines`. ``multiline`` lets quoted fields hold line
    breaks; a file is then read by one task, so leave it off for files that
    need none. ``pattern`` selects files in a folder. Adds ``SourceFile``
    unless ``source`` is None.
    """
    fields = all_string_schema(columns)
    aside = skip_bad_lines or keep_lines
    if aside:
        fields = T.StructType([*fields, T.StructField(CORRUPT_COL, T.StringType())])
    reader = (spark.read.schema(fields).option("header", True).option("sep", sep).option("mode", "PERMISSIVE")
              .option("nullValue", null_token).option("multiLine", multiline).option("escape", '"'))
    if aside:
        # A pruned parser reads some fields only and can't count them.
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT_COL).option("columnPruning", False)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    df = reader.csv(list(paths) if not isinstance(paths, str) else paths)
    if aside:
        plain = F.regexp_replace(F.col(CORRUPT_COL), '"([^"]|"")*"', "")
        n = (F.length(plain) - F.length(F.replace(plain, F.lit(sep), F.lit(""))) + 1).cast("int")
        long = F.coalesce(n > len(columns), F.lit(False))
        df = (df.withColumns({FIELDS_COL: F.when(long, n), CORRUPT_COL: F.when(long, F.col(CORRUPT_COL))}) if keep_lines
              else df.filter(~long).drop(CORRUPT_COL))
    df = df.withColumns({c: clean.blank_to_null(c) for c in columns})
    if source:
        df = df.withColumn("SourceFile", source_file(source))
    return df


def files_for_years(paths: Sequence[str], years: Iterable[int], level: str = "file") -> list[str]:
    """Keep the files whose name (``level='dir'``: whose folder's name) carries one of ``years``
    (first 4-digit run). Works on the listing only, so files of other years are never opened."""
    wanted = {int(y) for y in years}
    at = -2 if level == "dir" else -1
    out = []
    for p in paths:
        parts = p.rstrip("/").split("/")
        m = re.search(r"(\d{4})", parts[at] if len(parts) >= -at else "")
        if m and int(m.group(1)) in wanted:
            out.append(p)
    return out


def stage_lines(lines: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Rows read with ``keep_lines``, as (kept, rejected), from one scan: they are written once, apart.

    ``kept`` has the rows without the two columns; ``rejected`` the lines with too many fields:
    ``SourceFile`` (if there), ``Line``, ``Fields``. Every line is in one of them.
    """
    own = [c for c in lines.columns if c not in (CORRUPT_COL, FIELDS_COL)]
    apart = lines.withColumn("_rejected", F.col(FIELDS_COL).isNotNull())
    apart.write.mode("overwrite").partitionBy("_rejected").parquet(path)
    back = lines.sparkSession.read.schema(apart.schema).parquet(path)
    names = [c for c in own if c == "SourceFile"]
    return (back.where("not _rejected").select(*own),
            back.where("_rejected").select(*names, F.col(CORRUPT_COL).alias("Line"), F.col(FIELDS_COL).alias("Fields")))


def read_manifest(spark: SparkSession, manifest: DataFrame, null_token: str = "NA", sep: str = ",", source: str = "file",
                  skip_bad_lines: bool = False, multiline: bool = False, keep_lines: bool = False,
                  folder: tuple[str, str | None] | None = None) -> DataFrame | None:
    """The readable files of a manifest stacked by column name (None: there are none); ``folder`` (path, pattern) if
    they are all of its files.

    The driver takes the distinct headers. With one header, a folder is read by
    its path; paths come to the driver only where headers differ (or files were
    chosen), to be read a header at a time. A line has too many fields by its own file's header.
    """
    def read(paths, header, pattern=None):
        return read_csv_text(spark, paths, _split_header(header, sep), null_token, skip_bad_lines, sep, source,
                             multiline, pattern, keep_lines)

    heads = manifest.where("error is null")
    headers = sorted(r.header for r in heads.select("header").distinct().collect())
    if len(headers) == 1 and folder is not None:
        return read(folder[0], headers[0], folder[1] or "*")
    out = None
    for h in headers:
        paths = sorted(r.path for r in heads.where(F.col("header") == h).select("path").collect())
        part = read([escape_glob(p) for p in paths], h)
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


def read_many(spark: SparkSession, path: str | None = None, pattern: str | None = None,
              null_token: str = "NA", sep: str = ",", source: str = "file",
              skip_bad_lines: bool = False, paths: Sequence[str] | None = None,
              years: Iterable[int] | None = None, multiline: bool = False, keep_lines: bool = False) -> DataFrame:
    """All files under ``path`` matching ``pattern`` (or the given ``paths``),
    stacked by column *name*; optionally only the files named for ``years``
    (with ``source='dir'``: in folders named for them).

    One Spark read per distinct header (few), each reading all of its files
    in parallel; the union fills columns missing from a group with NULL. A file
    that can't be read fails the gather, naming the file.
    """
    manifest = mf.build(spark, path, pattern, paths, years, source)
    mf.first_error(manifest)
    folder = (path, pattern) if paths is None and years is None else None
    out = read_manifest(spark, manifest, null_token, sep, source, skip_bad_lines, multiline, keep_lines, folder)
    if out is None:
        raise FileNotFoundError(f"no files under {path} matching {pattern!r} (years={years})")
    return out


def read_tolerant(spark: SparkSession, path: str, pattern: str | None = None, null_token: str = "NA",
                  sep: str = ",", source: str = "file", skip_bad_lines: bool = False,
                  years: Iterable[int] | None = None, multiline: bool = False) -> tuple[DataFrame | None, DataFrame]:
    """:func:`read_many` that leaves out files that can't be read or decoded, and reports every file.

    Returns the rows of the readable files (None if there are none) and the
    report: ``SourceFile, seen, n_rows, error`` with a row for each file found
    (a file of no bytes is not listed).
    Each file is read through once beforehand on the executors, so that a file
    that breaks off gives no rows rather than some.
    """
    manifest = mf.build(spark, path, pattern, None, years, source, whole=True)
    whole = years is None and manifest.where("error is not null").isEmpty()
    df = read_manifest(spark, manifest, null_token, sep, source, skip_bad_lines, multiline,
                       folder=(path, pattern) if whole else None)
    return df, mf.sources_report(manifest, ingest_audit(df) if df is not None else None)


def read_parquet_many(spark: SparkSession, paths: Sequence[str] | str, source: str = "file",
                      skip_unreadable: bool = False) -> DataFrame:
    """Parquet files stacked (schemas merged by name), provenance kept.

    An unreadable file fails the job, unless ``skip_unreadable``: a corrupt or
    vanished file then contributes no rows; compare the expected file list with
    ``ingest_audit`` / ``missing_sources`` to report it.
    """
    r = spark.read.option("mergeSchema", True)
    if skip_unreadable:
        r = r.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True)
    df = r.parquet(*([paths] if isinstance(paths, str) else list(paths)))
    return df.withColumn("SourceFile", source_file(source)) if source else df


def _cast(c: str, kind: str) -> Column:
    if kind == "number":
        return clean.parse_number(c)
    if kind in ("int", "integer", "bigint", "long", "smallint"):
        return clean.to_int(c, kind)
    if kind in ("double", "float"):
        return clean.to_num(c).try_cast(kind)
    return F.col(c).try_cast(kind)


def typed(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Cast text columns to types without raising: bad text -> NULL.

    Integers go through double so '2014.0' -> 2014; doubles treat NaN as NULL;
    ``"number"`` parses decorated text ('$1,234.50' -> 1234.5).
    """
    return df.withColumns({c: _cast(c, t) for c, t in schema.items()})


def bad_cast(c: str, kind: str) -> Column:
    """Whether a value is present as text but NULL after casting."""
    return F.col(c).isNotNull() & _cast(c, kind).isNull()


def bad_cast_counts(raw: DataFrame, typed_df_cols: dict[str, str]) -> DataFrame:
    """Per column: values present as text but NULL after casting (one pass)."""
    return raw.agg(*[F.count_if(bad_cast(c, t)).alias(c) for c, t in typed_df_cols.items()])


def ingest_audit(df: DataFrame, source_col: str = "SourceFile") -> DataFrame:
    """Rows per source file (one aggregation, no per-file loop)."""
    return df.groupBy(source_col).agg(F.count(F.lit(1)).alias("n_rows"))


def missing_sources(expected: DataFrame, seen: DataFrame, col: str = "SourceFile") -> DataFrame:
    """Expected files that contributed no rows (unreadable, skipped or empty)."""
    return expected.join(seen.select(col).distinct(), col, "left_anti")
