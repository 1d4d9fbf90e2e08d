"""Key tables and mapping tables: lists of codes as DataFrames, of any length.

The literal forms (``isin``, ``CASE``) suit a handful of codes known to the program. A
list that comes from data, or grows with it, is a table: membership is a semi or anti
join, a recode a dimension join. No hint: the planner broadcasts a table by its size
statistics (AQE by its real size) and shuffles it beyond the threshold.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundflow.functions.sqltext import ident
from fundflow.operators.combine import null_safe_join


def _check(df: DataFrame, table: DataFrame, on: Sequence[str]) -> None:
    missing = [c for c in on if c not in df.columns or c not in table.columns]
    if missing:
        raise ValueError(f"key columns not on both sides: {missing}")


def keep_keys(df: DataFrame, keys: DataFrame, on: Sequence[str], null_matches: bool = False) -> DataFrame:
    """FLT-2: rows whose ``on`` values are a row of ``keys`` (each once, however often it is listed).

    A missing value is in no list, as with ``IN``; with ``null_matches`` it is in a list that has a
    missing value in that place.
    """
    return _by_keys(df, keys, list(on), null_matches, "left_semi")


def drop_keys(df: DataFrame, keys: DataFrame, on: Sequence[str], null_matches: bool = False) -> DataFrame:
    """FLT-3: rows whose ``on`` values are no row of ``keys``. A row with a missing value stays
    (unless ``null_matches`` and the table lists it): a listed NULL never empties the result, as ``NOT IN`` would."""
    return _by_keys(df, keys, list(on), null_matches, "left_anti")


def _by_keys(df: DataFrame, keys: DataFrame, on: list[str], null_matches: bool, how: str) -> DataFrame:
    _check(df, keys, on)
    listed = keys.select(*on)
    if null_matches:
        return null_safe_join(df, listed, on, how)
    return df.join(listed, on, how).select(*df.columns)


def pairs_table(spark: SparkSession, pairs: Mapping[str, Sequence[str]], left: str, right: str) -> DataFrame:
    """A literal ``{left: [right, ...]}`` list as a key table."""
    return spark.createDataFrame([(a, b) for a, bs in pairs.items() for b in bs], f"{ident(left)} string, {ident(right)} string")


def mapping_table(spark: SparkSession, labels: Mapping[str, Sequence[str]], code: str, label: str) -> DataFrame:
    """Literal code sets ``{label: [codes]}`` as a mapping table (a code in several sets has the first one's label)."""
    seen: dict[str, str] = {}
    for name, codes in labels.items():
        for c in codes:
            seen.setdefault(c, name)
    return spark.createDataFrame(list(seen.items()), f"{ident(code)} string, {ident(label)} string")


def map_codes(df: DataFrame, mapping: DataFrame, on: Sequence[str], value: str, out: str | None = None,
              other: str | None = None, null_matches: bool = False) -> DataFrame:
    """SCL-9 / SCL-10: ``df`` with ``out`` (default: ``value``), the mapping's ``value`` for the row's ``on`` codes.

    A code that isn't mapped gets ``other`` (None: NULL, a recode; a label: SCL-10); one mapped to NULL gets NULL. Every
    row of ``df`` comes out once: a code mapped to two different values fails the query, naming the code; repeated
    equal rows of the mapping are one. The check rides on the aggregate that makes codes unique.
    """
    on, out = list(on), out or value
    _check(df, mapping, on)
    kind = mapping.schema[value].dataType
    code = " || ', ' || ".join(f"coalesce(CAST({ident(k)} AS STRING), 'NULL')" for k in on)
    v = ident(value)
    # NULL beside a value is a second value too.
    one = mapping.groupBy(*on).agg(
        F.expr(f"CASE WHEN min({v}) <> max({v}) OR (count({v}) > 0 AND count({v}) < count(1)) THEN CAST(raise_error("
               f"'map_codes: several values for code ' || {code}) AS {kind.simpleString()}) ELSE min({v}) END").alias("_value"),
        F.lit(True).alias("_mapped"))
    own = [F.col(f"`{c}`") for c in df.columns if c != out]
    if null_matches:
        joined = null_safe_join(df, one, on, "left")
    else:
        joined = df.join(one, on, "left")
    found = F.when(F.col("_mapped"), F.col("_value")).otherwise(F.lit(other).cast(kind))
    return joined.select(*own, found.alias(out))
