"""Recoding helpers: code lists to labels, unknown codes to NULL or 'Other'.

Short maps compile to a CASE expression (stays inside whole-stage codegen).
For long maps join a dimension table; the planner broadcasts it by its size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundflow.functions.sqltext import ident, in_list, lit


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def recode(c, mapping: Mapping[str, str | None]) -> Column:
    """Map codes to new values; codes not in ``mapping`` (and NULL) -> NULL."""
    if isinstance(c, str):
        if not mapping:
            return F.expr("CAST(NULL AS STRING)")
        x = ident(c)
        arms = " ".join(f"WHEN {x} = {lit(k)} THEN CAST({lit(v)} AS STRING)" for k, v in mapping.items())
        return F.expr(f"CASE {arms} END")
    col = _c(c)
    expr = None
    for k, v in mapping.items():
        val = F.lit(v).cast("string")
        expr = F.when(col == F.lit(k), val) if expr is None else expr.when(col == F.lit(k), val)
    return expr if expr is not None else F.lit(None).cast("string")


def label_by_set(c, labels: Mapping[str, Sequence[str]], other: str | None = "Other") -> Column:
    """First label whose code set contains the value; otherwise ``other``.

    ``labels`` preserves order, like a chain of ``case_when`` branches. A NULL
    code matches no set and falls through to ``other``.
    """
    if isinstance(c, str):
        x = ident(c)
        arms = " ".join(f"WHEN {x} IN {in_list(codes)} THEN {lit(label)}"
                        for label, codes in labels.items() if codes)
        fallback = f"CAST({lit(other)} AS STRING)"
        return F.expr(f"CASE {arms} ELSE {fallback} END" if arms else fallback)
    col = _c(c)
    expr = None
    for label, codes in labels.items():
        cond = col.isin(list(codes))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    fallback = F.lit(other).cast("string")
    return fallback if expr is None else expr.otherwise(fallback)
