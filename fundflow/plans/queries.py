"""Registered queries over the driver's tables (one per inventory item group).

Each query is ``(spark, sf_dir) -> DataFrame`` and reads whole tables. Money
results are rounded to 2 decimals (means and changes to 6) only at the very
end, so the order in which a cluster adds doubles does not show.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundflow.functions import clean, labels, text
from fundflow.functions.sqltext import ident
from fundflow.operators import agg, combine, reshape, trend
from fundflow.operators.rates import expand_alias
from fundflow.plans import driver as dv
from fundflow.plans import pipeline as pl
from fundflow.plans.domain import DRIVER

Query = Callable[[SparkSession, str], DataFrame]


def _round(df: DataFrame, digits: int, cols: list[str] | None = None) -> DataFrame:
    cols = cols or [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.expr(f"round({ident(c)}, {digits})") for c in cols})


# ------------------------------------------------------------ apportion ---
def q_rate_left_join(spark, sf):
    """JN-1 + SET-2: fact rows matched / unmatched to a rate, per year and class."""
    r = dv.rates(spark, sf).select(*pl.KEY, "GeneralRate")
    j = dv.tif_fact(spark, sf).join(r, pl.KEY, "left")
    return (j.groupBy("TaxYear", "PropertyClass",
                      F.col("GeneralRate").isNotNull().alias("Matched"))
            .agg(F.sum("n_rows").cast("bigint").alias("n_rows")))


def _tif_apportioned(spark, sf, rates=None):
    rates = rates if rates is not None else dv.rates(spark, sf)
    return pl.apportion_sum_rates(dv.tif_fact(spark, sf), rates, DRIVER, "Amount")


def _abate_apportioned(spark, sf, rates=None):
    rates = rates if rates is not None else dv.rates(spark, sf)
    return pl.apportion_total_rate(dv.abatement_fact(spark, sf), rates, DRIVER, "Amount")


def _per_district(app):
    return (agg.sum_by(app, ["TaxYear", "TaxDistrict", "Municipality"],
                       {"General": "Lost_General", "Fire": "Lost_Fire", "Road": "Lost_Road"}))


def q_apportion_sum_rates(spark, sf):
    """CMP-1: shares by sum of rates, gated Road, summed per (year, district)."""
    return _round(_per_district(_tif_apportioned(spark, sf)), 2)


def q_apportion_total_rate(spark, sf):
    """CMP-2: shares by the published total, district from the parcel prefix."""
    return _round(_per_district(_abate_apportioned(spark, sf)), 2)


def q_fund_wide(spark, sf):
    """AGG-1: General/Fire/Road sums per (year, municipality)."""
    return _round(pl.fund_wide(_tif_apportioned(spark, sf), DRIVER), 2)


def _tif_long(spark, sf, rates=None):
    return pl.fund_summary(_tif_apportioned(spark, sf, rates), DRIVER, "Taxes_Diverted_TIF")


def _abate_long(spark, sf, rates=None):
    return pl.fund_summary(_abate_apportioned(spark, sf, rates), DRIVER, "Forgone_Revenue_Abatements")


def q_fund_long_filtered(spark, sf):
    """CMP-3 (flagship): apportion -> sums -> long -> drop inapplicable pairs."""
    return _round(_tif_long(spark, sf), 2)


def q_abatement_long(spark, sf):
    """CMP-3 on the abatement side (published-total denominator)."""
    return _round(_abate_long(spark, sf), 2)


def _combined(spark, sf):
    rates = dv.rates(spark, sf)          # one rate plan feeds both sides
    return pl.combined_loss(_tif_long(spark, sf, rates), _abate_long(spark, sf, rates))


def q_combined_loss(spark, sf):
    """CMP-4: outer combine of both loss kinds, zero-filled, with total."""
    return _round(_combined(spark, sf), 2)


def q_loss_series(spark, sf):
    """CMP-5: loss by (year, fund, municipality, loss type)."""
    return _round(pl.loss_series(_combined(spark, sf)), 2)


def q_chart_series(spark, sf):
    """CMP-11: chart-ready panels with title, file name and dollar text."""
    s = _round(pl.loss_series(_combined(spark, sf)), 2)
    return pl.chart_series(s)


def q_chart_panel(spark, sf):
    """FLT-4: one chart panel's data, by a conjunction of equalities."""
    s = pl.loss_series(_combined(spark, sf))
    panel = s.filter((F.col("Fund") == "Fire") & (F.col("LossType") == "Taxes_Diverted_TIF"))
    return _round(panel, 2)


def q_series_max(spark, sf):
    """AGG-8: global maximum of the plotted series."""
    return _round(pl.loss_series(_combined(spark, sf)).agg(F.max("Total_Loss").alias("y_max")), 2)


def q_invalid_loss_rows(spark, sf):
    """CMP-12 / AGG-10 on the loss table: flagged rows per (fund, loss type)."""
    return pl.invalid_loss_rows(_combined(spark, sf))


# -------------------------------------------------------- county totals ---
def q_cross_column_total(spark, sf):
    """CMP-6 / AGG-3: one total over four columns and all rows, NULLs skipped.

    The row total is linear, so it is pre-summed per (supplier, year) before
    the supplier join.
    """
    li = dv.table(spark, sf, "lineitem").selectExpr(
        "l_suppkey", "CAST(year(l_shipdate) AS INT) AS TaxYear", "l_extendedprice",
        "CASE WHEN l_returnflag <> 'R' THEN l_discount END AS l_discount",
        "CASE WHEN l_linestatus <> 'O' THEN l_tax END AS l_tax", "l_quantity")
    pre = (li.groupBy("l_suppkey", "TaxYear")
           .agg(agg.sum_across(["l_extendedprice", "l_discount", "l_tax", "l_quantity"])
                .alias("part_total")))
    j = pre.join(dv.suppliers(spark, sf), F.expr("l_suppkey = s_suppkey"))
    j = j.withColumn("TaxDistrict", clean.zero_pad("s_nationkey", 3))
    j = j.withColumn("Municipality", pl.municipality(DRIVER))
    out = pl.county_totals(j, ["part_total"])
    return _round(out, 2)


# ---------------------------------------------------- wide year compare ---
COMPARE_YEARS = [1996, 1997, 1998]


def q_parcel_wide_change(spark, sf):
    """CMP-7 / RSH-2 / SCL-15: per parcel, measures by year side by side + % change."""
    rows = (dv.order_rows(spark, sf, {
                "TotalPrice": "o_totalprice",
                "UrgentPrice": "CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice END"},
                years=COMPARE_YEARS)
            .selectExpr(f"{dv.parcel_id_sql('c_nationkey', 'o_custkey')} AS ParcelNumber",
                        "TaxYear", "TotalPrice", "UrgentPrice"))
    out = pl.parcel_year_compare(rows, "ParcelNumber", "TaxYear", ["TotalPrice", "UrgentPrice"],
                                 COMPARE_YEARS, "TotalPrice", "Total")
    money = [f"{m}_{y}" for m in ("TotalPrice", "UrgentPrice") for y in COMPARE_YEARS]
    return _round(out, 2, money)


COMPARE_DISTRICT = "005"


def q_parcel_long(spark, sf):
    """CMP-7 (long form) + PRJ-7 / FLT-4: one district's raw rows with decorated amounts, parsed, one row
    per parcel, year and amount."""
    rows = dv.order_rows(spark, sf, {
        "TotalPrice": "concat('$', format_number(o_totalprice, 2))",
        "UrgentPrice": "CASE WHEN o_orderpriority = '1-URGENT' THEN concat(format_number(o_totalprice, 2), ' USD') END"})
    raw = rows.selectExpr(f"{dv.parcel_id_sql('c_nationkey', 'o_custkey')} AS ParcelNumber", "CAST(TaxYear AS STRING) AS TaxYear",
                          "CAST(c_nationkey AS STRING) AS TaxDistrict", "TotalPrice", "UrgentPrice")
    _, long = pl.parcel_comparison(raw, COMPARE_DISTRICT, COMPARE_YEARS, ["TotalPrice", "UrgentPrice"], "TotalPrice", "Total")
    return long


def q_measure_long(spark, sf):
    """RSH-1: orders wide -> long over two measures (NULL values kept)."""
    o = dv.table(spark, sf, "orders").selectExpr(
        "o_orderkey", "o_totalprice AS TotalPrice",
        "CASE WHEN o_orderstatus = 'P' THEN o_totalprice END AS PendingPrice")
    return reshape.to_long(o, ["o_orderkey"], ["TotalPrice", "PendingPrice"], "Measure", "Amount")


# ------------------------------------------------------------ reconcile ---
def _norm_parcel_sql(raw_sql: str) -> str:
    """Reference normaliser: drop a trailing '-00', then every hyphen."""
    return clean.drop_chars_sql(clean.strip_literal_suffix_sql(raw_sql, "-00"), "-")


def _tif_parcels(spark, sf):
    o = dv.table(spark, sf, "orders")
    raw = f"concat({dv.split_id_sql('o_orderkey')}, '-00')"
    return o.selectExpr(f"{_norm_parcel_sql(raw)} AS ParcelNumber",
                        "CAST(year(o_orderdate) AS INT) AS TaxYear",
                        "o_totalprice AS DivertedTownship")


def _parcel_file_rows(spark, sf):
    li = dv.table(spark, sf, "lineitem")
    return li.selectExpr(f"{_norm_parcel_sql(dv.split_id_sql('l_orderkey'))} AS ParcelNumber",
                         "CAST(year(l_shipdate) AS INT) AS TaxYear",
                         "l_extendedprice AS TIFMLND", "l_quantity AS TIFMBLD")


def q_parcel_prepare(spark, sf):
    """PRJ-2/3 + SCL-3/4: build parcel ids, select/rename, strip '-00' then hyphens."""
    c = dv.table(spark, sf, "customer")
    raw = dv.parcel_id("c_nationkey", "c_custkey", "=" + clean.zero_pad_sql("c_custkey % 3", 2))
    return (c.select("c_custkey", "c_acctbal", "c_mktsegment", raw.alias("ParcelRaw"))
            .withColumnsRenamed({"c_acctbal": "AccountBalance", "c_mktsegment": "Segment"})
            .withColumn("ParcelNumber", clean.drop_chars(clean.strip_suffix("ParcelRaw", "-00"), "-")))


def q_reconcile_matched(spark, sf):
    """CMP-8 / JN-3: TIF rows joined to parcel-file rows on (parcel, year)."""
    m, _ = combine.reconcile(_tif_parcels(spark, sf), _parcel_file_rows(spark, sf),
                             ["ParcelNumber", "TaxYear"])
    return m


def q_reconcile_unmatched(spark, sf):
    """CMP-8 / JN-4 / SET-4: TIF rows whose (parcel, year) is in no parcel file."""
    _, u = combine.reconcile(_tif_parcels(spark, sf), _parcel_file_rows(spark, sf),
                             ["ParcelNumber", "TaxYear"])
    return u


# --------------------------------------------------------------- trends ---
TRIENNIAL_YEARS = [1995, 1998, 2001]


def _orders_by_priority(spark, sf, years=None):
    o = dv.table(spark, sf, "orders")
    if years is not None:                       # pushable date ranges, not year(...) IN
        o = o.where(clean.year_in_sql("o_orderdate", years))
    return o.selectExpr("o_orderpriority", "CAST(year(o_orderdate) AS INT) AS TaxYear", "o_totalprice")


def q_mean_by_group(spark, sf):
    """AGG-4: mean price per (priority, year); NULL keys dropped."""
    return _round(agg.mean_by(_orders_by_priority(spark, sf), ["o_orderpriority", "TaxYear"],
                              "o_totalprice", "avg_price"), 6)


def q_mean_of_means(spark, sf):
    """AGG-5 + FLT-2: triennial years, unweighted mean of per-priority means."""
    o = _orders_by_priority(spark, sf, TRIENNIAL_YEARS)
    return _round(agg.mean_of_means(o, ["TaxYear"], ["o_orderpriority"], "o_totalprice",
                                    "avg_price", "global_avg_price"), 6)


def _rate_trend(spark, sf):
    return pl.rate_trend(_orders_by_priority(spark, sf, TRIENNIAL_YEARS), "o_orderpriority", "TaxYear",
                         "o_totalprice", TRIENNIAL_YEARS, "avg_price", "global_avg_price",
                         "pct_change")


def q_pct_change_trend(spark, sf):
    """CMP-9 / WIN-1: % change of the global mean between triennial years."""
    return _round(_rate_trend(spark, sf), 6)


def q_avg_pct_change(spark, sf):
    """AGG-6 + SCL-18: average of the triennial % changes (first period skipped),
    with its '12.34%' display text."""
    avg = _round(trend.avg_change(_rate_trend(spark, sf), "pct_change"), 6)
    return avg.withColumn("avg_pct_change_text", text.percent_text("avg_pct_change", 2))


TREND_DISTRICTS = [0, 1, 2, 3, 24]      # the labelled (township) districts, as integers


def _value_rows(spark, sf):
    """Line values of the township districts: appraised (may be missing) and assessed.

    The districts filter suppliers by their integer key (pushed to the scan), and
    line items are semi-joined to the suppliers that are left before anything
    is aggregated.
    """
    li = dv.table(spark, sf, "lineitem").selectExpr(
        "l_suppkey", "CAST(year(l_shipdate) AS INT) AS TaxYear",
        "CASE WHEN l_linestatus <> 'O' THEN l_extendedprice END AS appraised",
        "l_extendedprice * (1D - l_discount) AS assessed")
    kept = dv.suppliers(spark, sf).where(F.col("s_nationkey").isin(TREND_DISTRICTS))
    return li.join(kept, F.expr("l_suppkey = s_suppkey"), "left_semi")


def _value_trend(spark, sf):
    return pl.value_trend(_value_rows(spark, sf), "TaxYear", ["appraised", "assessed"], 0.35)


def q_yearly_value_total(spark, sf):
    """CMP-10 / AGG-7 / SCL-13/16: yearly taxable value of the township districts."""
    return _round(_value_trend(spark, sf).select("TaxYear", "total_value"), 2)


def q_value_trend(spark, sf):
    """CMP-10 / WIN-1: yearly total with % change and the scaled unit column."""
    t = _value_trend(spark, sf).withColumn("total_value_millions", F.col("total_value") / F.lit(1e6))
    return _round(_round(t, 2, ["total_value"]), 6, ["pct_change", "total_value_millions"])


def q_trend_panels(spark, sf):
    """CMP-11 on both trend series: chart-ready rows with title, file name, scaled value and text."""
    rate = pl.trend_panel(_round(_rate_trend(spark, sf), 6), "TaxYear", "global_avg_price", "pct_change",
                          pl.TITLE_RATE_TREND)
    value = pl.trend_panel(_round(_value_trend(spark, sf), 6, ["pct_change"]), "TaxYear", "total_value", "pct_change",
                           pl.TITLE_VALUE_TREND, unit=1e6)
    return _round(rate.unionByName(value), 6, ["Value"])


def q_rate_coverage(spark, sf):
    """CMP-12: abatement rows per year and class, and how many find no rate."""
    return pl.rate_coverage(dv.abatement_fact(spark, sf), dv.rates(spark, sf))


# ------------------------------------------------------- scalar helpers ---
def q_recode_class(spark, sf):
    """SCL-9: return flag -> class, unknown -> NULL; rows per class."""
    li = dv.table(spark, sf, "lineitem")
    return (li.groupBy(labels.recode("l_returnflag", DRIVER.class_codes).alias("PropertyClass"))
            .agg(F.count(F.lit(1)).alias("n_rows")))


def q_label_district(spark, sf):
    """SCL-10: district -> municipality label, unknown -> Other; suppliers per label."""
    s = dv.table(spark, sf, "supplier")
    lab = labels.label_by_set(clean.zero_pad("s_nationkey", 3), DRIVER.district_labels,
                              DRIVER.other_label)
    return s.groupBy(lab.alias("Municipality")).agg(F.count(F.lit(1)).alias("n_suppliers"))


def q_code_normalise(spark, sf):
    """SCL-1/2/6: pad without truncation, prefix, strip zeros back to int."""
    s = dv.table(spark, sf, "supplier")
    n = dv.table(spark, sf, "nation").select("n_nationkey", "n_name")
    stub = dv.parcel_id("s_nationkey", "s_suppkey", None)
    return (s.join(n, F.col("s_nationkey") == F.col("n_nationkey"))
            .select("s_suppkey", "n_name",
                    clean.zero_pad("s_nationkey", 3).alias("DistrictCode"),
                    clean.zero_pad(F.col("s_suppkey") * 37, 3).alias("LongCode"),
                    stub.alias("ParcelStub"),
                    clean.prefix(stub, 3).alias("PrefixCode"),
                    clean.strip_zeros_to_int(clean.prefix(stub, 3)).alias("DistrictInt")))


def q_multi_col_clean(spark, sf):
    """PRJ-7 + SCL-8: decorate numbers as text, parse a list of columns back; among them amounts with
    a leading point, a sign before it, an exponent, and none at all."""
    c = dv.table(spark, sf, "customer").select(
        "c_custkey",
        F.concat(F.lit("$"), F.format_number("c_acctbal", 2), F.lit(" USD")).alias("AcctText"),
        F.concat(F.lit("#"), F.format_number(F.col("c_custkey").cast("double"), 0)).alias("KeyText"),
        F.expr("CASE c_custkey % 5 WHEN 0 THEN '$.50' WHEN 1 THEN concat('-.', c_custkey % 10) WHEN 2 THEN "
               "concat('about ', c_custkey, 'e3 each') WHEN 3 THEN concat('(', c_custkey, '.5e-1%)') "
               "ELSE 'none' END").alias("OddText"))
    cols = {"AcctText": "AcctValue", "KeyText": "KeyValue", "OddText": "OddValue"}
    return c.withColumns({out: clean.parse_number(src) for src, out in cols.items()})


def q_scope_filter(spark, sf):
    """FLT-1/6 + SCL-5: whitespace-padded text, equality after trimming tabs/newlines; an input without
    the scope column passes whole."""
    c = dv.table(spark, sf, "customer")
    k = F.col("c_custkey") % 3
    padded = (F.when(k == 0, F.concat("c_mktsegment", F.lit("\t")))
              .when(k == 1, F.concat(F.lit("  "), "c_mktsegment", F.lit("\n")))
              .otherwise(F.col("c_mktsegment")))
    scoped = pl.in_scope(c.select("c_custkey", "c_name", padded.alias("Segment")), "Segment", "BUILDING")
    bare = pl.in_scope(c.select("c_custkey", "c_name"), "Segment", "BUILDING")
    return (scoped.withColumn("Segment", clean.trim_ws("Segment")).withColumn("Input", F.lit("with"))
            .unionByName(bare.withColumn("Input", F.lit("without")), allowMissingColumns=True))


def q_alias_expand(spark, sf):
    """SET-2: alias-key expansion over supplier districts (rows of the source
    district copied under the alias); grows with the supplier table."""
    s = dv.table(spark, sf, "supplier").select(
        "s_suppkey", clean.zero_pad("s_nationkey", 3).alias("TaxDistrict"))
    return expand_alias(s, "TaxDistrict", DRIVER.rate_aliases)


def q_distinct_dims(spark, sf):
    """SET-3: distinct values of several dimensions, one table."""
    o = dv.table(spark, sf, "orders")
    c = dv.table(spark, sf, "customer")
    parts = [
        o.select(F.lit("priority").alias("Dimension"), F.col("o_orderpriority").alias("Value")),
        c.select(F.lit("segment").alias("Dimension"), F.col("c_mktsegment").alias("Value")),
        o.select(F.lit("year").alias("Dimension"), F.year("o_orderdate").cast("string").alias("Value")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def q_invalid_amounts(spark, sf):
    """FLT-5 / AGG-10: rows and invalid (missing or negative) balances per segment."""
    return agg.invalid_counts(dv.table(spark, sf, "customer"), ["c_mktsegment"], "c_acctbal")


def q_preview_topn(spark, sf):
    """SRT-1 / LIM-1 / SNK-5: first 6 rows by a unique multi-key sort."""
    o = dv.table(spark, sf, "orders")
    return (o.select("o_orderkey", "o_custkey", "o_totalprice",
                     F.year("o_orderdate").cast("int").alias("TaxYear"))
            .orderBy("o_custkey", "o_orderkey").limit(6))


def q_safe_labels(spark, sf):
    """SNK-3: capped sheet labels and file-name-safe titles."""
    s = dv.table(spark, sf, "supplier")
    n = dv.table(spark, sf, "nation").select("n_nationkey", "n_name")
    sheets = (s.join(n, F.col("s_nationkey") == F.col("n_nationkey"))
              .select(F.lit("supplier").alias("Source"), F.col("s_suppkey").alias("Id"),
                      text.safe_label(F.concat_ws(" ", "n_name", "s_name"), "CountyTot_").alias("Label")))
    p = dv.table(spark, sf, "part")
    files = p.select(F.lit("part").alias("Source"), F.col("p_partkey").alias("Id"),
                     text.safe_file_name(F.concat("p_brand", F.lit("/"), "p_type", F.lit(": "),
                                                  "p_name", F.lit("?")), ".png").alias("Label"))
    return sheets.unionByName(files)


QUERIES: dict[str, Query] = {
    "rate_left_join": q_rate_left_join,
    "apportion_sum_rates": q_apportion_sum_rates,
    "apportion_total_rate": q_apportion_total_rate,
    "fund_wide": q_fund_wide,
    "fund_long_filtered": q_fund_long_filtered,
    "abatement_long": q_abatement_long,
    "combined_loss": q_combined_loss,
    "loss_series": q_loss_series,
    "chart_series": q_chart_series,
    "chart_panel": q_chart_panel,
    "series_max": q_series_max,
    "invalid_loss_rows": q_invalid_loss_rows,
    "cross_column_total": q_cross_column_total,
    "parcel_wide_change": q_parcel_wide_change,
    "measure_long": q_measure_long,
    "parcel_prepare": q_parcel_prepare,
    "reconcile_matched": q_reconcile_matched,
    "reconcile_unmatched": q_reconcile_unmatched,
    "mean_by_group": q_mean_by_group,
    "mean_of_means": q_mean_of_means,
    "pct_change_trend": q_pct_change_trend,
    "avg_pct_change": q_avg_pct_change,
    "yearly_value_total": q_yearly_value_total,
    "value_trend": q_value_trend,
    "trend_panels": q_trend_panels,
    "rate_coverage": q_rate_coverage,
    "parcel_long": q_parcel_long,
    "recode_class": q_recode_class,
    "label_district": q_label_district,
    "code_normalise": q_code_normalise,
    "multi_col_clean": q_multi_col_clean,
    "scope_filter": q_scope_filter,
    "alias_expand": q_alias_expand,
    "distinct_dims": q_distinct_dims,
    "invalid_amounts": q_invalid_amounts,
    "preview_topn": q_preview_topn,
    "safe_labels": q_safe_labels,
}
