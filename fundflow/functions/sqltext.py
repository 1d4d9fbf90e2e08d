"""Quoting for the SQL-expression form of the column helpers.

Helpers given a column *name* build one ``expr(...)`` from SQL text: the
expression is then sent to the JVM in a single call instead of one call per
function node, which keeps plan construction cheap for wide queries.
"""

from __future__ import annotations


def ident(name: str) -> str:
    """Backtick-quoted identifier (``a.b`` stays qualified)."""
    return ".".join(f"`{p.replace('`', '``')}`" for p in name.split("."))


def lit(v) -> str:
    """SQL literal for a Python value."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return f"CAST('{v!r}' AS DOUBLE)"
    s = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{s}'"


def in_list(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"
