"""Column-level helpers: each returns a ``Column`` built from Spark built-ins."""

from fundflow.functions.clean import (  # noqa: F401
    blank_to_null, drop_chars, nan_to_null, parse_number, prefix, strip_suffix,
    strip_zeros_to_int, to_int, to_num, trim_ws, zero_pad,
)
from fundflow.functions.labels import label_by_set, recode  # noqa: F401
from fundflow.functions.text import (  # noqa: F401
    currency_text, percent_text, safe_file_name, safe_label,
)
