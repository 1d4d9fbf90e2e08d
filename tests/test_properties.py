"""Property tests: column helpers against plain-Python statements of the rules.

Each example is one DataFrame of many generated values (one Spark job per
example), so the properties cover many strings at modest cost.
"""

import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fundflow.functions import clean

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])
codes = st.lists(st.text(alphabet="-0123a ", min_size=0, max_size=9), min_size=1, max_size=60)


def run(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string").orderBy("i")
    by_col = [r[0] for r in df.select(expr(F.col("x"))).collect()]
    by_name = [r[0] for r in df.select(expr("x")).collect()]
    assert by_col == by_name
    return by_col


@SETTINGS
@given(values=codes)
def test_strip_suffix_literal_equals_regex(spark, values):
    fast = run(spark, values, lambda c: clean.strip_suffix(c, "-00"))
    slow = run(spark, values, lambda c: F.regexp_replace(F.col(c) if isinstance(c, str) else c, "-00$", ""))
    assert fast == slow == [re.sub(r"-00$", "", v) for v in values]


@SETTINGS
@given(values=codes)
def test_drop_chars_and_pad(spark, values):
    assert run(spark, values, lambda c: clean.drop_chars(c, "-")) == [v.replace("-", "") for v in values]
    padded = run(spark, values, lambda c: clean.zero_pad(c, 3))
    for v, p in zip(values, padded):
        assert p == (v if len(v) >= 3 else "0" * (3 - len(v)) + v)


@SETTINGS
@given(nums=st.lists(st.integers(min_value=-10**9, max_value=10**9), min_size=1, max_size=60),
       decimals=st.booleans())
def test_to_int_and_parse_number(spark, nums, decimals):
    text = [f"{n}.0" if decimals else f" {n} " for n in nums]
    assert run(spark, text, clean.to_int) == nums
    decorated = [f"${n:,} USD" for n in nums]
    assert run(spark, decorated, clean.parse_number) == [float(n) for n in nums]
