"""Cleaning helpers with the missing-value and text rules fixed once.

Spark 4 runs with ANSI mode on: a bad cast or a division by zero raises.
The rules below reproduce the spreadsheet/dataframe semantics the engine
follows instead (bad text -> NULL, pad without truncation, strip only at the
end, white space including tabs and newlines).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from fundflow.functions.sqltext import ident, lit

# Characters removed by whitespace trimming (space, tab, CR, LF, FF, VT).
WHITESPACE = " \t\r\n\f\u000b"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# SQL text of WHITESPACE, built from character codes (no escapes to interpret).
_WS_SQL = "concat(" + ", ".join(f"char({ord(ch)})" for ch in WHITESPACE) + ")"


def _s(c) -> str:
    """SQL text of a column name (the helpers' fast path)."""
    return ident(c)


def trim_ws_sql(x: str) -> str:
    return f"btrim({x}, {_WS_SQL})"


# Fixed value: text that is a number. A plain cast also takes what Java takes
# ('12d', '1f'), which is junk in a data file.
NUMERIC_TEXT = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?([Ii]nf|[Ii]nfinity)$"


def to_num_sql(x: str) -> str:
    t = trim_ws_sql(f"CAST({x} AS STRING)")
    return f"CASE WHEN {t} RLIKE {lit(NUMERIC_TEXT)} THEN try_cast({t} AS DOUBLE) END"


def zero_pad_sql(x: str, width: int = 3) -> str:
    s = f"CAST({x} AS STRING)"
    return f"lpad({s}, greatest(length({s}), {width}), '0')"


def prefix_sql(x: str, n: int = 3) -> str:
    return f"substring(CAST({x} AS STRING), 1, {n})"


def strip_literal_suffix_sql(x: str, suffix: str) -> str:
    """A literal suffix off the end, once. Of a plain column without a regular expression; an expression is
    written down once only, as every mention of it is evaluated (and again in filters inferred from join keys)."""
    if "(" in x:
        return f"regexp_replace({x}, {lit(re.escape(suffix) + chr(92) + 'z')}, '')"
    return (f"CASE WHEN endswith({x}, {lit(suffix)}) "
            f"THEN substring({x}, 1, length({x}) - {len(suffix)}) ELSE {x} END")


def drop_chars_sql(x: str, chars: str = "-") -> str:
    for ch in dict.fromkeys(chars):
        x = f"replace({x}, {lit(ch)}, '')"
    return x


def trim_ws(c) -> Column:
    """Trim spaces *and* tabs/newlines on both sides (plain ``trim`` drops spaces only)."""
    if isinstance(c, str):
        return F.expr(trim_ws_sql(_s(c)))
    return F.btrim(c, F.lit(WHITESPACE))


def blank_to_null(c) -> Column:
    """Empty or all-blank text becomes NULL."""
    if isinstance(c, str):
        x = _s(c)
        return F.expr(f"CASE WHEN {trim_ws_sql(x)} = '' THEN CAST(NULL AS STRING) ELSE {x} END")
    col = _c(c)
    return F.when(trim_ws(col) == F.lit(""), F.lit(None).cast("string")).otherwise(col)


def zero_pad(c, width: int = 3) -> Column:
    """Left-pad with zeros to ``width``; never shortens a longer code.

    ``lpad`` truncates ('1234' -> '123'), so it is applied only to short codes.
    Numbers are rendered as text first; NULL stays NULL.
    """
    if isinstance(c, str):
        return F.expr(zero_pad_sql(_s(c), width))
    s = c.cast("string")
    return F.lpad(s, F.greatest(F.length(s), F.lit(width)), "0")


def prefix(c, n: int = 3) -> Column:
    """First ``n`` characters."""
    if isinstance(c, str):
        return F.expr(prefix_sql(_s(c), n))
    return F.substring(c.cast("string"), 1, n)


_REGEX_META = set(".^$*+?()[]{}|\\")


def strip_suffix(c, pattern: str = "-00") -> Column:
    """Remove ``pattern`` at the end only (end-anchored, one match).

    A literal suffix is cut with ``endswith`` + ``substring`` (no regex
    engine per row); a pattern with regex syntax uses ``regexp_replace``.
    """
    if isinstance(c, str) and not (set(pattern) & _REGEX_META):
        return F.expr(strip_literal_suffix_sql(_s(c), pattern))
    col = _c(c)
    if not (set(pattern) & _REGEX_META):
        n = len(pattern)
        return F.when(col.endswith(F.lit(pattern)),
                      col.substr(F.lit(1), F.length(col) - F.lit(n))).otherwise(col)
    return F.regexp_replace(col, f"(?:{pattern})$", "")


def drop_chars(c, chars: str = "-") -> Column:
    """Remove every occurrence of each literal character in ``chars``."""
    if isinstance(c, str):
        return F.expr(drop_chars_sql(_s(c), chars))
    col = _c(c)
    for ch in dict.fromkeys(chars):
        col = F.replace(col, F.lit(ch), F.lit(""))
    return col


def nan_to_null(c) -> Column:
    """NaN -> NULL so that NULL-skipping aggregates also skip NaN."""
    if isinstance(c, str):
        return F.expr(f"nanvl(CAST({_s(c)} AS DOUBLE), CAST(NULL AS DOUBLE))")
    col = c.cast("double")
    return F.nanvl(col, F.lit(None).cast("double"))


def to_num(c) -> Column:
    """Text -> double; other text (blanks, NaN, a Java suffix as in '12d') becomes NULL (no error)."""
    if isinstance(c, str):
        return F.expr(to_num_sql(_s(c)))
    t = trim_ws(c.cast("string"))
    return F.when(t.rlike(NUMERIC_TEXT), t.try_cast("double"))


def to_int(c, int_type: str = "int") -> Column:
    """Text -> integer; '2014.0' -> 2014 through double (truncating toward zero).

    Plain integer text is cast directly first, so large keys keep full precision.
    """
    if isinstance(c, str):
        x = _s(c)
        direct = f"try_cast({trim_ws_sql(f'CAST({x} AS STRING)')} AS {int_type})"
        return F.expr(f"coalesce({direct}, try_cast({to_num_sql(x)} AS {int_type}))")
    direct = trim_ws(c.cast("string")).try_cast(int_type)
    return F.coalesce(direct, to_num(c).try_cast(int_type))


def strip_zeros_to_int(c) -> Column:
    """'0027' -> 27. Missing, blank, all-zero-free junk -> NULL instead of an error."""
    return to_int(c)


# Fixed value: the first number inside decorated text such as '$1,234.50 USD',
# '(12%)', '$.50' or '1e3' (optional minus, digits with grouping commas and
# optional decimals, or a leading point; optional exponent).
NUMBER_PATTERN = r"-?([0-9][0-9,]*[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"


def parse_number(c) -> Column:
    """Pull the first number out of decorated text; grouping commas dropped."""
    if isinstance(c, str):
        hit = f"regexp_extract(CAST({_s(c)} AS STRING), {lit(NUMBER_PATTERN)}, 0)"
        return F.expr(f"try_cast(nullif(replace({hit}, ',', ''), '') AS DOUBLE)")
    hit = F.regexp_extract(c.cast("string"), NUMBER_PATTERN, 0)
    return F.nullif(F.regexp_replace(hit, ",", ""), F.lit("")).try_cast("double")


def year_in_sql(col: str, years) -> str:
    """Pushable SQL predicate equivalent to ``year(col) IN years``.

    A function of the column cannot reach the Parquet reader; plain ranges on
    the raw date/timestamp can (row groups outside them are skipped).
    Consecutive years merge into one range: ``[y0-01-01, y1+1-01-01)``.
    """
    ys = sorted({int(y) for y in years})
    if not ys:
        return "FALSE"
    runs, start, prev = [], ys[0], ys[0]
    for y in ys[1:]:
        if y != prev + 1:
            runs.append((start, prev))
            start = y
        prev = y
    runs.append((start, prev))
    x = ident(col)
    return " OR ".join(f"({x} >= '{a:04d}-01-01' AND {x} < '{b + 1:04d}-01-01')" for a, b in runs)
