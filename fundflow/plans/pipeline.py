"""Composite jobs: the user-level operations of the engine.

Each takes and returns DataFrames; nothing is collected. Column names follow
the township study (TaxYear, TaxDistrict, PropertyClass, Municipality, Fund).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundflow.functions import clean, labels, text
from fundflow.functions.sqltext import ident, in_list, lit
from fundflow.operators import agg, combine, keys, profile, rates, reshape, trend
from fundflow.plans.domain import Domain
from fundflow.sources.readers import bad_cast

KEY = ["TaxYear", "TaxDistrict", "PropertyClass"]


# ----------------------------------------------------------------- rates ---
def prepare_rates(raw: DataFrame, dom: Domain) -> DataFrame:
    """Rate table with padded district codes, typed rates and alias rows added."""
    typed = raw.withColumns({
        "TaxYear": clean.to_int("TaxYear"),
        "TaxDistrict": clean.zero_pad("TaxDistrict", 3),
        **{c: clean.to_num(c) for c in [*dom.funds.values(), dom.total_rate] if c in raw.columns},
    })
    return rates.expand_alias(typed, "TaxDistrict", dom.rate_aliases)


def municipality(dom: Domain, district: str = "TaxDistrict") -> Column:
    return labels.label_by_set(district, dom.district_labels, dom.other_label)


def in_scope(df: DataFrame, column: str, value: str | None) -> DataFrame:
    """FLT-1 / FLT-6: rows whose trimmed ``column`` is ``value``; all rows if the input has no such
    column (or no value is asked for)."""
    if value is None or column not in df.columns:
        return df
    return df.filter(clean.trim_ws(column) == F.lit(value))


# ------------------------------------------------------------- apportion ---
def apportion_sum_rates(fact: DataFrame, rate_table: DataFrame, dom: Domain,
                        amount: str) -> DataFrame:
    """CMP-1: clean the fact's keys, join rates, split by share of the *sum* of rates.

    ``fact`` needs TaxYear, TaxDistrict, PropertyClass (already recoded) and
    ``amount``. Adds Lost_<fund> and Municipality.
    """
    gated = {dom.gated_fund: ("TaxDistrict", dom.gated_districts)}
    out = rates.apportion(fact, rate_table, KEY, amount, dom.funds, total=None, gated=gated)
    return out.withColumn("Municipality", municipality(dom))


def apportion_total_rate(fact: DataFrame, rate_table: DataFrame, dom: Domain,
                         amount: str) -> DataFrame:
    """CMP-2: as CMP-1 but the denominator is the published total rate column."""
    gated = {dom.gated_fund: ("TaxDistrict", dom.gated_districts)}
    out = rates.apportion(fact, rate_table, KEY, amount, dom.funds, total=dom.total_rate,
                          gated=gated)
    return out.withColumn("Municipality", municipality(dom))


def tif_fact(raw: DataFrame, dom: Domain, amount: str = "DivertedTownship") -> DataFrame:
    """Typed TIF rows: padded district, int year, recoded class, numeric amount."""
    return raw.withColumns({
        "TaxDistrict": clean.zero_pad("TaxDistrict", 3),
        "TaxYear": clean.to_int("TaxYear"),
        "PropertyClass": labels.recode("TaxRateType", dom.class_codes),
        amount: clean.to_num(amount),
    })


def abatement_fact(raw: DataFrame, dom: Domain, amount: str = "ForegoneTownship",
                   parcel: str = "ParcelNumber") -> DataFrame:
    """Typed abatement rows: district from the parcel prefix, constant class."""
    return raw.withColumns({
        "TaxDistrict": clean.zero_pad(clean.prefix(parcel, 3), 3),
        "TaxYear": clean.to_int("TaxYear"),
        "PropertyClass": F.lit(dom.default_class),
        amount: clean.to_num(amount),
    })


# ----------------------------------------------------------- fund summary ---
def fund_wide(apportioned: DataFrame, dom: Domain,
              keys: Sequence[str] = ("TaxYear", "Municipality"),
              prefix: str = "Lost_") -> DataFrame:
    """AGG-1: per (year, municipality) sum of each fund's share (all-missing -> 0)."""
    return agg.sum_by(apportioned, list(keys), {f: f"{prefix}{f}" for f in dom.funds})


def exclude_pairs(df: DataFrame, dom: Domain, fund_col: str = "Fund",
                  label_col: str = "Municipality") -> DataFrame:
    """FLT-3: drop fund x municipality pairs that do not apply."""
    f, m = ident(fund_col), ident(label_col)
    conds = [f"({f} = {lit(fund)} AND {m} IN {in_list(ms)})" for fund, ms in dom.excluded_pairs.items()]
    if not conds:
        return df
    # A NULL condition keeps the row (NULL label is not in any list).
    return df.where(f"NOT coalesce({' OR '.join(conds)}, FALSE)")


def fund_long(wide: DataFrame, dom: Domain, value_name: str,
              by: Sequence[str] = ("TaxYear", "Municipality"), excluded: DataFrame | None = None) -> DataFrame:
    """CMP-3 tail: wide fund sums -> long (Fund, value) -> drop inapplicable pairs: the domain's, or those of
    the table ``excluded`` (Fund, Municipality)."""
    long = reshape.to_long(wide, list(by), list(dom.funds), "Fund", value_name)
    return exclude_pairs(long, dom) if excluded is None else keys.drop_keys(long, excluded, ["Fund", "Municipality"])


def fund_summary(apportioned: DataFrame, dom: Domain, value_name: str, excluded: DataFrame | None = None) -> DataFrame:
    """CMP-3: apportioned rows -> sums -> long -> filtered."""
    return fund_long(fund_wide(apportioned, dom), dom, value_name, excluded=excluded)


# --------------------------------------------------------- combined loss ---
LOSS_KEYS = ["TaxYear", "Municipality", "Fund"]


def combined_loss(tif_long: DataFrame, abate_long: DataFrame,
                  tif_col: str = "Taxes_Diverted_TIF",
                  abate_col: str = "Forgone_Revenue_Abatements",
                  total_col: str = "Total_Forgone_and_Diverted") -> DataFrame:
    """CMP-4: outer combine on (year, municipality, fund), zero-fill, total."""
    return combine.outer_combine(tif_long.select(*LOSS_KEYS, tif_col),
                                 abate_long.select(*LOSS_KEYS, abate_col),
                                 LOSS_KEYS, fill=0.0, total=total_col)


def loss_long(combined: DataFrame, loss_cols: Sequence[str] = (
        "Taxes_Diverted_TIF", "Forgone_Revenue_Abatements")) -> DataFrame:
    return reshape.to_long(combined, LOSS_KEYS, list(loss_cols), "LossType", "Loss")


def loss_series(combined: DataFrame, loss_cols: Sequence[str] = (
        "Taxes_Diverted_TIF", "Forgone_Revenue_Abatements")) -> DataFrame:
    """CMP-5: long by loss type, summed per (year, fund, municipality, type)."""
    return (loss_long(combined, loss_cols)
            .groupBy("TaxYear", "Fund", "Municipality", "LossType")
            .agg(agg.sum0("Loss").alias("Total_Loss")))


# Chart title wording by loss type.
TITLE_TIF = " fund revenue diverted by TIFs by municipality"
TITLE_ABATEMENT = " fund revenue forgone from abatements by municipality"


def chart_series(series: DataFrame, tif_type: str = "Taxes_Diverted_TIF") -> DataFrame:
    """CMP-11: every fund x loss-type panel as one tidy table.

    Adds the panel title, the file name derived from it and the dollar text of
    the value; the numeric value is kept for the renderer.
    """
    title = F.concat(F.col("Fund"), F.when(F.col("LossType") == F.lit(tif_type), F.lit(TITLE_TIF))
                     .otherwise(F.lit(TITLE_ABATEMENT)))
    return (series.withColumn("Title", title)
            .withColumn("FileName", text.safe_file_name("Title", ".png"))
            .withColumn("LossText", text.currency_text(F.round("Total_Loss", 2), 2)))


# Chart titles of the trend panels.
TITLE_RATE_TREND = "Global average rate by triennial year"
TITLE_VALUE_TREND = "Taxable value of TIF parcels by year"


def trend_panel(t: DataFrame, year: str, value: str, change: str, title: str, unit: float = 1.0) -> DataFrame:
    """CMP-11 on a trend series: ``year, Value`` (in ``unit``), the change with its '12.34%' text, the
    panel's title and file name. The first period has no change and no text."""
    return t.select(
        F.col(year).alias("Year"), (F.col(value) / F.lit(unit)).alias("Value"), F.col(change).alias("PctChange"),
        F.when(F.col(change).isNotNull(), text.percent_text(change, 2)).alias("PctText"), F.lit(title).alias("Title"),
        text.safe_file_name(F.lit(title), ".png").alias("FileName"))


def invalid_loss_rows(combined: DataFrame) -> DataFrame:
    """CMP-12: per (fund, loss type) panel, rows with a missing or negative loss.

    Counted, not dropped: the plotted sums are built before this check.
    """
    return agg.invalid_counts(loss_long(combined), ["Fund", "LossType"], "Loss")


def rate_coverage(fact: DataFrame, rate_table: DataFrame, keys: Sequence[str] = KEY) -> DataFrame:
    """CMP-12: fact rows per (year, class) and how many found no rate.

    Rows without a rate silently become zero shares in the fund sums; this
    makes them visible. The rate side is reduced to its (few) keys first.
    """
    hit = rate_table.select(*keys).distinct().withColumn("_rated", F.lit(True))
    j = fact.select(*keys).join(hit, list(keys), "left")
    return (j.groupBy("TaxYear", "PropertyClass")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.count_if(F.col("_rated").isNull()).alias("n_unmatched")))


# Columns of a quality profile (CMP-12).
PROFILE_KEYS = ["SourceFile", *KEY]
INVALID = "n_invalid"


def stage_profile(raw: DataFrame, fact: Callable[[DataFrame], DataFrame], types: Mapping[str, str], amount: str) -> DataFrame:
    """CMP-12: every count of a stage table from one scan and one aggregate.

    ``raw`` has text columns and ``SourceFile``; ``fact`` types its keys and ``amount`` (:func:`tif_fact`,
    :func:`abatement_fact`). Per file and key: rows, values of each of ``types`` that don't cast
    (``bad_<column>``), and missing or negative amounts.
    """
    text_of = {c: f"_text_{c}" for c in types}
    rows = fact(raw.withColumns({alias: F.col(c) for c, alias in text_of.items()}))
    checks = {f"bad_{c}": bad_cast(text_of[c], t) for c, t in types.items()}
    return profile.profile(rows, PROFILE_KEYS, checks | {INVALID: F.col(amount).isNull() | (F.col(amount) < 0)})


def profile_tables(found: DataFrame, rate_table: DataFrame, types: Mapping[str, str]) -> dict[str, DataFrame]:
    """The quality tables of a profile (stage it first: each is an aggregate of it): ``rows_per_file``,
    ``rate_coverage``, ``bad_casts``, ``invalid_amounts`` (per file). Rates are looked up once for each key."""
    rated = profile.unlisted(found, rate_table, KEY, "n_unmatched")
    bad = profile.totals(found, [], {c: f"bad_{c}" for c in types})
    return {
        "rows_per_file": profile.totals(found, ["SourceFile"], {"n_rows": "n_rows"}),
        "rate_coverage": profile.totals(rated, ["TaxYear", "PropertyClass"], {"n_rows": "n_rows", "n_unmatched": "n_unmatched"}),
        "bad_casts": reshape.to_long(bad, [], list(types), "Column", "n_bad", value_type="bigint"),
        "invalid_amounts": profile.totals(found, ["SourceFile"], {"n_rows": "n_rows", INVALID: INVALID})}


def split_labels(df: DataFrame, label_col: str, prefix: str, out: str = "SheetLabel") -> DataFrame:
    """SNK-3 on a column: ``prefix`` + label without spaces, capped at 31."""
    return df.withColumn(out, text.safe_label(label_col, prefix))


# ---------------------------------------------------------- county totals ---
def county_totals(df: DataFrame, cols: Sequence[str],
                  keys: Sequence[str] = ("TaxYear", "Municipality"),
                  name: str = "Total_County_Diverted") -> DataFrame:
    """CMP-6: one total over several columns and all rows of each group."""
    return df.groupBy(*keys).agg(agg.sum_across(cols).alias(name))


# ------------------------------------------------------ year comparison ---
def parcel_year_compare(df: DataFrame, id_col: str, year_col: str,
                        measures: Sequence[str], years: Sequence[int],
                        change_measure: str, change_label: str | None = None,
                        agg_fn: str = "sum") -> DataFrame:
    """CMP-7: pivot measures to ``{measure}_{year}`` and add guarded % changes.

    One change column per consecutive pair of ``years`` for ``change_measure``:
    ``PctChange_<label>_<yy>_<yy>``.
    """
    wide = reshape.to_wide(df.select(id_col, year_col, *measures), [id_col], year_col,
                           measures, years, "{value}_{name}", agg_fn)
    label = change_label or change_measure
    ys = list(years)
    changes = {}
    for a, b in zip(ys, ys[1:]):
        name = f"PctChange_{label}_{str(a)[-2:]}_{str(b)[-2:]}"
        changes[name] = trend.col_pct_change(f"{change_measure}_{b}", f"{change_measure}_{a}")
    return wide.withColumns(changes)


def parcel_comparison(tif: DataFrame, district: str, years: Sequence[int], cols: Sequence[str],
                      change_measure: str, change_label: str,
                      id_col: str = "ParcelNumber") -> tuple[DataFrame, DataFrame]:
    """CMP-7 end to end on raw TIF rows: one district and a few years.

    Decorated amounts in ``cols`` are parsed to numbers (PRJ-7/SCL-8), rows
    are selected by district *and* year (FLT-4), and two shapes come back:
    long (one row per parcel, year and amount type) and wide
    (``{col}_{year}`` with guarded % changes of ``change_measure``).
    """
    typed = tif.withColumns({
        "TaxYear": clean.to_int("TaxYear"),
        "TaxDistrict": clean.zero_pad("TaxDistrict", 3),
        **{c: clean.parse_number(c) for c in cols},
    })
    sel = (typed.filter((F.col("TaxDistrict") == F.lit(district))
                        & F.col("TaxYear").isin(list(years)))
           .select(id_col, "TaxYear", *cols))
    long = reshape.to_long(sel, [id_col, "TaxYear"], list(cols), "DivertedType", "Amount")
    wide = parcel_year_compare(sel, id_col, "TaxYear", cols, years, change_measure, change_label)
    return wide, long


# ---------------------------------------------------------------- trends ---
def rate_trend(df: DataFrame, group: str, year: str, value: str, years: Sequence[int],
               inner_name: str = "avg_rate", outer_name: str = "global_avg_rate",
               change_name: str = "pct_change") -> DataFrame:
    """CMP-9: keep ``years``, mean per (group, year), mean of means per year, % change."""
    kept = df.filter(F.col(year).isin(list(years)))
    per_year = agg.mean_of_means(kept, [year], [group], value, inner_name, outer_name)
    return trend.pct_change(per_year, outer_name, year, change_name)


def value_trend(df: DataFrame, year: str, base_cols: Sequence[str], ratio: float,
                total_name: str = "total_value", change_name: str = "pct_change") -> DataFrame:
    """CMP-10: first non-missing base value x ratio, summed per year, % change."""
    base = F.coalesce(*[F.col(c) for c in base_cols])
    totals = (df.groupBy(year)
              .agg(agg.sum0(F.lit(ratio) * base).alias(total_name)))
    return trend.pct_change(totals, total_name, year, change_name)
