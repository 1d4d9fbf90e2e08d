"""Wide <-> long reshaping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fundflow.functions.sqltext import ident, lit


def to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str],
            names_to: str = "name", values_to: str = "value",
            value_type: str | None = "double") -> DataFrame:
    """Wide -> long (one output row per input row and value column; NULLs kept).

    ``stack`` in one projection: a narrow transformation, no shuffle, stays in
    the scan's stage.
    """
    pairs = ", ".join(f"{lit(v)}, " + (f"CAST({ident(v)} AS {value_type})" if value_type else ident(v))
                      for v in values)
    stack = f"stack({len(values)}, {pairs}) AS ({ident(names_to)}, {ident(values_to)})"
    return df.selectExpr(*[ident(i) for i in ids], stack)


#: Names that a wide table found by itself has at most.
MOST_NAMES = 1000


def discover_names(df: DataFrame, names_from: str, limit: int = MOST_NAMES) -> list:
    """The distinct non-missing values of a column, sorted: what a wide table's columns are made of.

    One aggregate over that column alone; ``limit`` + 1 values reach the driver at most, and more
    than ``limit`` raise (a schema that wide is a mistake, or needs :func:`to_long`).
    """
    found = [r[0] for r in df.select(names_from).where(F.col(names_from).isNotNull()).distinct().limit(limit + 1).collect()]
    if len(found) > limit:
        raise ValueError(f"{names_from} has more than {limit} distinct values")
    return sorted(found)


def to_wide(df: DataFrame, ids: Sequence[str], names_from: str, values: Sequence[str],
            names: Sequence | None = None, template: str = "{value}_{name}", agg: str = "sum",
            limit: int = MOST_NAMES) -> DataFrame:
    """Long -> wide: one column per (value, name) named by ``template``.

    ``names`` given: no job before the query's own. Without, they are found in the data first
    (:func:`discover_names`); a row with a missing name then gets no column, but its ``ids`` stay. Columns come out value-major: ``A_2022, A_2023, B_2022, B_2023``. Duplicate
    (ids, name) rows are combined with ``agg`` (default ``sum``); a missing
    cell stays NULL.

    Written as conditional aggregation, ``agg(CASE WHEN name = n THEN v END)``
    per cell, in a single ``groupBy(ids)``: one shuffle with map-side partial
    aggregation (Spark's ``pivot`` aggregates by (ids, name) first and then
    pivots, which costs a second shuffle).
    """
    if names is None:
        names = discover_names(df, names_from, limit)
        clash = [c for c in (template.format(value=v, name=n) for v in values for n in names) if c in ids]
        if clash:
            raise ValueError(f"names found in the data are id columns too: {clash}")
    fn = {"sum": "sum", "max": "max", "min": "min", "avg": "avg", "first": "first"}[agg]
    key = ident(names_from)
    cells = []
    for v in values:
        for n in names:
            val = f"CASE WHEN {key} = {_literal(n, df.schema[names_from].dataType)} THEN {ident(v)} END"
            call = f"first({val}, true)" if fn == "first" else f"{fn}({val})"
            cells.append(F.expr(call).alias(template.format(value=v, name=n)))
    return df.groupBy(*ids).agg(*cells) if cells else df.select(*ids).distinct()


def _literal(name, kind: T.DataType) -> str:
    """SQL text of a name; dates and the like by their text."""
    return lit(name) if isinstance(name, (str, int, float, bool)) else f"CAST({lit(str(name))} AS {kind.simpleString()})"
