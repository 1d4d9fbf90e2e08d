"""Relational building blocks (DataFrame in, DataFrame out)."""

from fundflow.operators.agg import (  # noqa: F401
    invalid_counts, mean_by, mean_of_means, sum0, sum_across, sum_by,
)
from fundflow.operators.combine import null_safe_join, outer_combine, reconcile, reconcile_marked  # noqa: F401
from fundflow.operators.rates import (  # noqa: F401
    apportion, assert_unique, duplicate_keys, expand_alias,
)
from fundflow.operators.reshape import to_long, to_wide  # noqa: F401
from fundflow.operators.trend import avg_change, col_pct_change, pct_change  # noqa: F401
