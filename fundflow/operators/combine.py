"""Combining two keyed tables: outer combine with zero-fill, and reconciliation."""

from __future__ import annotations

from collections.abc import Sequence
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundflow.functions.sqltext import ident


def outer_combine(left: DataFrame, right: DataFrame, keys: Sequence[str],
                  fill: float | None = 0.0, total: str | None = None) -> DataFrame:
    """Full-outer combine of two keyed summaries, NULL keys matching each other.

    Expressed as ``union`` + ``groupBy`` rather than a full outer join: one
    shuffle with map-side partial aggregation, no sort-merge of both sides, and
    NULL keys group together (the null-safe match of a dplyr/pandas join).
    Each side must be unique on ``keys`` (both are summaries); a key that comes
    twice on one side fails the query, whatever the type of the values. A key
    present on one side only gets ``fill`` for the other side's values.
    ``total`` adds the row sum of all value columns.
    """
    keys = list(keys)
    lvals = [c for c in left.columns if c not in keys]
    rvals = [c for c in right.columns if c not in keys]
    clash = set(lvals) & set(rvals)
    if clash:
        raise ValueError(f"value columns on both sides: {sorted(clash)}")
    types = dict(left.dtypes) | dict(right.dtypes)
    vals = lvals + rvals

    def side(present: list[str], is_left: bool) -> str:
        cols = [ident(c) if c in present else f"CAST(NULL AS {types[c]}) AS {ident(c)}" for c in vals]
        counts = f"{int(is_left)} AS `_in_left`, {int(not is_left)} AS `_in_right`"
        return ", ".join([*map(ident, keys), *cols, counts])

    # A group has one row of each side at most, so ``max`` is that side's value.
    by = ", ".join(map(ident, keys))
    aggs = ", ".join([*(f"max({ident(c)}) AS {ident(c)}" for c in vals),
                      "sum(`_in_left`) AS `_in_left`", "sum(`_in_right`) AS `_in_right`"])
    grouped = (f"SELECT {by}, {aggs} FROM (SELECT {side(lvals, True)} FROM {{l}} "
               f"UNION ALL SELECT {side(rvals, False)} FROM {{r}}) GROUP BY {by}")
    # The check rides on the aggregate: no job of its own.
    shown = " || ', ' || ".join(f"coalesce(CAST({ident(k)} AS STRING), 'NULL')" for k in keys)
    unique = ("CASE WHEN greatest(`_in_left`, `_in_right`) > 1 THEN "
              f"CAST(raise_error('outer_combine: key occurs twice on one side: ' || {shown}) AS BOOLEAN) ELSE TRUE END")
    filled = [f"coalesce({ident(c)}, CAST({fill!r} AS {types[c]})) AS {ident(c)}" if fill is not None
              else ident(c) for c in vals]
    out = [*map(ident, keys), *filled]
    if total:
        out.append(" + ".join(f"coalesce({ident(c)}, CAST({fill!r} AS {types[c]}))" if fill is not None
                              else ident(c) for c in vals) + f" AS {ident(total)}")
    # One parameterised statement: a single JVM round trip for the whole plan.
    return left.sparkSession.sql(f"SELECT {', '.join(out)} FROM ({grouped}) WHERE {unique}", l=left, r=right)


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (pandas/dplyr key semantics).

    ``<=>`` is still an equi-join key for the planner (hash or sort-merge),
    never a nested loop. Key columns come out once, from the left side.
    """
    l, r = left.alias("_l"), right.alias("_r")
    cond = F.expr(" AND ".join(f"_l.{ident(k)} <=> _r.{ident(k)}" for k in keys))
    j = l.join(r, cond, how)
    if how in ("left_anti", "left_semi", "anti", "semi", "leftanti", "leftsemi"):
        return j
    rest = [f"_r.{ident(c)}" for c in right.columns if c not in keys]
    return j.selectExpr(*[f"_l.{ident(c)}" for c in left.columns], *rest)


MATCHED = "_matched"


def reconcile_marked(left: DataFrame, right: DataFrame, keys: Sequence[str],
                     null_keys: str = "unmatched") -> DataFrame:
    """``left`` with ``right``'s columns and the boolean ``_matched``: both outputs of
    :func:`reconcile` from one pass over both sides (write it once, then split by the mark).

    One left join, so each side is exchanged once on its keys; rows of ``left``
    without a partner come out once, with NULL right columns.
    """
    _check_null_keys(null_keys)
    marked = right.withColumn(MATCHED, F.lit(True))
    j = (null_safe_join(left, marked, keys, "left") if null_keys == "match"
         else left.join(marked, list(keys), "left").select(
             *left.columns, *[c for c in marked.columns if c not in keys]))
    return j.withColumn(MATCHED, F.coalesce(F.col(MATCHED), F.lit(False)))


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str],
              null_keys: str = "unmatched") -> tuple[DataFrame, DataFrame]:
    """Split ``left`` against ``right`` on ``keys``: (matched, unmatched).

    matched   = inner join, right columns appended (fans out if ``right``
                repeats a key, as a dataframe merge does);
    unmatched = rows of ``left`` whose key is absent from ``right`` (anti join).

    ``null_keys="unmatched"`` (default): a row with a missing key matches
    nothing. The joins are plain equalities, so the exchange that makes
    ``right``'s keys distinct (map-side partial aggregation: a hot key costs a
    row per task) also serves the anti join. ``"match"``: a missing key matches
    every missing key, as a dataframe merge has it; all pairs of such rows are
    in ``matched``, so keep it for sides that have few.
    """
    _check_null_keys(null_keys)
    keys = list(keys)
    right_keys = right.select(*keys).distinct()
    if null_keys == "match":
        return (null_safe_join(left, right, keys, "inner"),
                null_safe_join(left, right_keys, keys, "left_anti"))
    matched = left.join(right, keys, "inner").select(*left.columns, *[c for c in right.columns if c not in keys])
    return matched, left.join(right_keys, keys, "left_anti").select(*left.columns)


def _check_null_keys(null_keys: str) -> None:
    if null_keys not in ("unmatched", "match"):
        raise ValueError("null_keys: 'unmatched' or 'match'")
