"""Column-rule tests."""

from pyspark.sql import functions as F

from fundflow.functions import clean, labels, text


def one_col(spark, values, expr, typ="string"):
    """Apply a helper through both forms (column name -> SQL text, Column ->
    function API); both must agree."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {typ}").orderBy("i")
    by_col = [r[0] for r in df.select(expr(F.col("x"))).collect()]
    by_name = [r[0] for r in df.select(expr("x")).collect()]
    assert by_col == by_name, (by_col, by_name)
    return by_col


def test_zero_pad_never_truncates(spark):
    assert one_col(spark, ["27", "170", "1234", None], lambda c: clean.zero_pad(c, 3)) == \
        ["027", "170", "1234", None]


def test_zero_pad_numbers(spark):
    assert one_col(spark, [5, 67, 1234], lambda c: clean.zero_pad(c, 3), "int") == ["005", "067", "1234"]


def test_strip_suffix_and_hyphens(spark):
    got = one_col(spark, ["027-000007-00", "067-000005-01", "027-00-00"],
                  lambda c: clean.drop_chars(clean.strip_suffix(c, "-00"), "-"))
    assert got == ["027000007", "06700000501", "02700"]


def test_parse_number(spark):
    got = one_col(spark, ["$1,234.50 USD", "(12%)", "-3.5", "none", None, "$.50", "-.5", "1e3", "2.5E-1x", "7e", "-,5", "5."],
                  clean.parse_number)
    assert got == [1234.5, 12.0, -3.5, None, None, 0.5, -0.5, 1000.0, 0.25, 7.0, 5.0, 5.0]


def test_to_int_through_double(spark):
    assert one_col(spark, ["2014", "2014.0", "x", None, " 7 "], clean.to_int) == [2014, 2014, None, None, 7]


def test_to_num_nan_and_junk(spark):
    assert one_col(spark, ["1.5", "NaN", "n/a", "", "12d", "1f", "3L", " -.5e1 ", "+7.", "."], clean.to_num) == \
        [1.5, None, None, None, None, None, None, -5.0, 7.0, None]


def test_trim_ws_tabs_newlines(spark):
    assert one_col(spark, ["JEFFERSON TWP\t", "\n JEFFERSON TWP  "], clean.trim_ws) == \
        ["JEFFERSON TWP", "JEFFERSON TWP"]


def test_recode_unknown_is_null(spark):
    m = {"Res/Ag": "ResAgr", "Com/Ind": "ComInd"}
    assert one_col(spark, ["Res/Ag", "Com/Ind", "Exempt", None], lambda c: labels.recode(c, m)) == \
        ["ResAgr", "ComInd", None, None]


def test_label_by_set_other(spark):
    lab = {"JU": ["170", "171"], "G": ["027"]}
    assert one_col(spark, ["171", "027", "999", None], lambda c: labels.label_by_set(c, lab)) == \
        ["JU", "G", "Other", "Other"]


def test_safe_label_cap(spark):
    got = one_col(spark, ["Jefferson Unincorporated", "Gahanna"],
                  lambda c: text.safe_label(c, "Combined_"))
    assert got == ["Combined_JeffersonUnincorporate", "Combined_Gahanna"]
    assert len(got[0]) == 31


def test_safe_file_name(spark):
    got = one_col(spark, ['a/b\\c?d%e*f:g|h"i<j>k'], lambda c: text.safe_file_name(c, ".png"))
    assert got == ["abcdefghijk.png"]


def test_currency_text(spark):
    assert one_col(spark, [1234.5, -2.0, 0.0], text.currency_text, "double") == \
        ["$1,234.50", "-$2.00", "$0.00"]


def test_col_pct_change_guarded(spark):
    from fundflow.operators.trend import col_pct_change
    df = spark.createDataFrame([(200.0, 250.0), (0.0, 5.0), (None, 5.0), (3.0, 3.15)], "b double, a double")
    got = [r[0] for r in df.select(col_pct_change("a", "b")).collect()]
    assert got == [25.0, None, None, 5.0]


def test_blank_to_null(spark):
    assert one_col(spark, ["", "  \t", "a", None, " b "], clean.blank_to_null) == [None, None, "a", None, " b "]


def test_year_in_sql_ranges(spark):
    assert clean.year_in_sql("d", [2014, 2015, 2017]) == (
        "(`d` >= '2014-01-01' AND `d` < '2016-01-01') OR (`d` >= '2017-01-01' AND `d` < '2018-01-01')")
    assert clean.year_in_sql("d", []) == "FALSE"
    df = spark.sql("SELECT explode(sequence(TIMESTAMP_NTZ'2013-12-31 23:59:59', "
                   "TIMESTAMP_NTZ'2018-01-01 00:00:00', INTERVAL 12 HOURS)) AS d")
    a = df.where(clean.year_in_sql("d", [2014, 2015, 2017])).count()
    b = df.where(F.year("d").isin(2014, 2015, 2017)).count()
    assert a == b > 0
