"""Output-label and display-text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sheet / table names are capped at 31 characters, and these are
# the characters removed from a title before it becomes a file name.
MAX_LABEL_LEN = 31
ILLEGAL_FILE_CHARS = r'[/\\?%*:|"<>]'


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_label(c, prefix: str = "", max_len: int = MAX_LABEL_LEN) -> Column:
    """``prefix`` + value with spaces removed, capped at ``max_len`` characters."""
    body = F.regexp_replace(_c(c), " ", "")
    return F.substring(F.concat(F.lit(prefix), body), 1, max_len)


def safe_file_name(c, suffix: str = "") -> Column:
    """Remove path-illegal characters from a title and append ``suffix``."""
    return F.concat(F.regexp_replace(_c(c), ILLEGAL_FILE_CHARS, ""), F.lit(suffix))


def currency_text(c, decimals: int = 2) -> Column:
    """'$1,234.50' / '-$1,234.50' text for a numeric column (the number is kept elsewhere)."""
    col = _c(c).cast("double")
    body = F.format_number(F.abs(col), decimals)
    return F.when(col < 0, F.concat(F.lit("-$"), body)).otherwise(F.concat(F.lit("$"), body))


def percent_text(c, decimals: int = 2) -> Column:
    """'12.34%' text."""
    return F.concat(F.format_string(f"%.{decimals}f", _c(c).cast("double")), F.lit("%"))
