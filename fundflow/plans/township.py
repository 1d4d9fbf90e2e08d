"""End-to-end township job: yearly incentive files -> fund reports.

The study's whole workflow as one Spark application, stage by stage:

1. gather every yearly abatement file, keep the township's rows, stack by name;
2. the same for TIF files (parcel ids lose their ``-00`` suffix);
3. TIF losses by fund (share of the sum of rates, gated Road fund);
4. abatement losses by fund (share of the published total rate);
5. combined table (outer combine, zero-fill, total);
6. loss series and chart-ready panels, invalid-row counts, county totals;
7. side analyses: triennial fire-rate and TIF-value trends (the latter over the
   whole county's files), one district's
   parcel comparison across years, parcel-file <-> TIF reconciliation.

Every output is written as a total table plus one folder per municipality
label, in one pass each. Outputs are overwritten, so a re-run after a failure
is safe; the gathered inputs are materialised once (stage tables) and both
report branches read them. With ``--store`` the gathered rows are kept, and a later run
reads only the files of years that changed. With ``--tolerant`` a file that
can't be read is left out and reported (``quality/files``), instead of failing the job.

Usage::

    python -m fundflow.plans.township --abatements DIR --tifs DIR --rates FILE --out DIR
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundflow import sources
from fundflow.sources import schemas
from fundflow.functions import clean
from fundflow.operators import combine, sinks, trend
from fundflow.operators import rates as rates_op
from fundflow.plans import pipeline as pl
from fundflow.session import drop_scratch, scratch_path
from fundflow.plans.domain import (
    ASSESSMENT_RATIO, TOWNSHIP, TOWNSHIP_SCOPE, TOWNSHIP_TREND_DISTRICTS, TOWNSHIP_TREND_YEARS, Domain,
)

# File-name patterns of the yearly files and the county-level
# diversion columns summed into one county total.
ABATEMENT_PATTERN = "AbatementDetails*.csv"
TIF_PATTERN = "*[Tt][Ii][Ff]Details*.csv"
COUNTY_COLUMNS = ["DivertedCountyGen", "DivertedChildren", "DivertedADMH", "DivertedFCBDD",
                  "DivertedParks", "DivertedZoo", "DivertedSenior"]
PARCEL_PATTERN = "Parcel20*.csv"
PARCEL_COLUMNS = {"PARCEL ID": "ParcelNumber", "TIFMLND": "TIFMLND", "TIFMBLD": "TIFMBLD"}
# The parcel comparison of the study (district 027, 2022-2024, these
# diverted amounts; % change of the township amount).
COMPARE_DISTRICT = "027"
COMPARE_YEARS = [2022, 2023, 2024]
COMPARE_COLUMNS = ["DivertedTownship", "DivertedParks", "DivertedCityVillage", "DivertedZoo",
                   "DivertedChildren", "DivertedLibrary"]


def normalise_parcel(col: str, strip_suffix: bool = True):
    """Parcel id key: drop the '-00' suffix (optional) then every hyphen."""
    return clean.drop_chars(clean.strip_suffix(col, "-00") if strip_suffix else col, "-")


def parcel_files(spark: SparkSession, folder: str, pattern: str = PARCEL_PATTERN,
                 strip_suffix: bool = True) -> tuple[DataFrame, DataFrame]:
    """Yearly parcel files: malformed lines set aside, three columns kept and
    renamed, id normalised, tax year from the file name. With the rows come the rejected
    lines (file, text, number of fields), from the same scan."""
    lines = sources.read_many(spark, folder, pattern, keep_lines=True)
    raw, rejected = sources.stage_lines(lines, scratch_path(spark, "parcel-lines"))
    rows = (raw.select(*PARCEL_COLUMNS, "SourceFile")
            .withColumnsRenamed(PARCEL_COLUMNS)
            .withColumn("ParcelNumber", normalise_parcel("ParcelNumber", strip_suffix))
            .withColumn("TaxYear", sources.year_from_name("SourceFile")))
    return rows, rejected


def reconcile_parcels(tif: DataFrame, parcels: DataFrame) -> DataFrame:
    """TIF rows with their parcel-file rows on (parcel, year), marked ``_matched`` or not. Rows
    without a parcel id or year match nothing."""
    t = tif.withColumns({"ParcelNumber": normalise_parcel("ParcelNumber"),
                         "TaxYear": clean.to_int("TaxYear")})
    return combine.reconcile_marked(t, parcels.drop("SourceFile"), ["ParcelNumber", "TaxYear"])


def fire_rate_trend(spark: SparkSession, rates_path: str, years=TOWNSHIP_TREND_YEARS) -> DataFrame:
    """Triennial mean fire rate (mean of per-municipality means) and its % change."""
    raw = sources.read_csv_text(spark, rates_path, ["TaxYear", "Municipality", "TaxDistrict",
                                                    "PropertyClass", "GeneralRate", "FireRate",
                                                    "RoadRate", "TotalTownshipMillage"], source=None)
    df = raw.select(clean.to_int("TaxYear").alias("Year"), "Municipality",
                    clean.to_num("FireRate").alias("Effective_Rate"))
    return pl.rate_trend(df, "Municipality", "Year", "Effective_Rate", years,
                         "avg_fire_rate", "global_avg_fire_rate", "pct_change_global_fire_rate")


def tif_value_trend(tif: DataFrame, years=TOWNSHIP_TREND_YEARS,
                    districts=TOWNSHIP_TREND_DISTRICTS, ratio: float = ASSESSMENT_RATIO,
                    unit: float = 1e6) -> DataFrame:
    """Triennial taxable TIF value of the township districts and its % change, from the rows of
    all townships (the district alone decides).

    Appraised value, else assessed, times the assessment ratio, summed per
    year; ``unit`` scales the display column (a parameter, see README).
    """
    scoped = (tif.filter(F.col("TaxYear").isin(list(years)))
              .withColumn("_district", clean.strip_zeros_to_int("TaxDistrict"))
              .filter(F.col("_district").isin(list(districts)))
              .withColumns({c: clean.to_num(c) for c in ("AppraisedTotal", "AssessedTotal")}))
    t = pl.value_trend(scoped, "TaxYear", ["AppraisedTotal", "AssessedTotal"], ratio,
                       "total_tif_value", "pct_change")
    return t.withColumn("total_tif_value_units", F.col("total_tif_value") / F.lit(unit))


def _township_rows(raw: DataFrame, scope: str | None, strip_parcel_suffix: bool) -> DataFrame:
    raw = pl.in_scope(raw, "Township", scope)
    if strip_parcel_suffix and "ParcelNumber" in raw.columns:
        raw = raw.withColumn("ParcelNumber", clean.strip_suffix("ParcelNumber", "-00"))
    return raw


def gather(spark: SparkSession, folder: str, pattern: str, scope: str | None = TOWNSHIP_SCOPE,
           strip_parcel_suffix: bool = False, tolerant: bool = False, store: str | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Stages 1-2: all matching yearly files, text columns stacked by name,
    rows of the township only (when the files have a Township column).

    ``tolerant``: files that can't be read are left out, and the second result reports every file. ``store``: the rows
    are kept there, and only the years whose files changed since the last run are read.
    """
    if store is not None:
        if tolerant:
            raise ValueError("a store is brought up to date with all files or not at all: leave out tolerant")
        kept = sources.gather_years(spark, folder, pattern, store,
                                    transform=lambda raw: _township_rows(raw, scope, strip_parcel_suffix))
        return kept.rows.drop("FileYear", "Gather"), None
    if not tolerant:
        return _township_rows(sources.read_many(spark, folder, pattern), scope, strip_parcel_suffix), None
    raw, report = sources.read_tolerant(spark, folder, pattern)
    if raw is None:
        raise FileNotFoundError(f"no readable files under {folder} matching {pattern!r}")
    return _township_rows(raw, scope, strip_parcel_suffix), report


def value_rows(spark: SparkSession, folder: str, years=TOWNSHIP_TREND_YEARS,
               tolerant: bool = False) -> tuple[DataFrame | None, str | None]:
    """Rows of the whole county's TIF files named for ``years`` (only those are opened), with the
    columns of :func:`tif_value_trend`; or None and the reason why there are none."""
    try:
        raw = (sources.read_tolerant(spark, folder, TIF_PATTERN, years=years)[0] if tolerant
               else sources.read_many(spark, folder, TIF_PATTERN, years=years))
    except FileNotFoundError as e:
        return None, str(e)
    if raw is None:
        return None, f"no readable files of {list(years)}"
    need = ["TaxYear", "TaxDistrict", "AppraisedTotal", "AssessedTotal"]
    missing = [c for c in need if c not in raw.columns]
    if missing:
        return None, f"no columns {', '.join(missing)} in the files of {list(years)}"
    return raw.select(*need).withColumn("TaxYear", clean.to_int("TaxYear")), None


def read_rates(spark: SparkSession, path: str, dom: Domain = TOWNSHIP) -> DataFrame:
    cols = ["TaxYear", "Municipality", "TaxDistrict", "PropertyClass", *dom.funds.values(),
            dom.total_rate]
    return pl.prepare_rates(sources.read_csv_text(spark, path, cols, source=None), dom)


def _write(df: DataFrame, path: str, counts: dict, name: str) -> None:
    """CSV output with its row count recorded during the write (SNK-4)."""
    observed, obs = sinks.observe_rows(df, name)
    sinks.write_csv(observed, path)
    counts[name] = obs.get["rows"]


def _stage(df: DataFrame, path: str, counts: dict, name: str) -> DataFrame:
    """A stage table by tax year, its rows counted while it is written."""
    observed, obs = sinks.observe_rows(df.withColumn("TaxYear", clean.to_int("TaxYear")), name)
    staged = sinks.write_stage(observed, path, ["TaxYear"])
    counts[name] = obs.get["rows"]
    return staged


def _report(df: DataFrame, out: str, prefix: str, counts: dict, name: str) -> None:
    """Total table + one folder per municipality label (capped 31-char labels).

    The split reads the written total back instead of recomputing the report,
    so both outputs hold the same values.
    """
    total_path = f"{out}/{name}/Total"
    _write(df, total_path, counts, name)
    total = df.sparkSession.read.option("header", True).schema(df.schema).csv(total_path)
    sinks.write_split(pl.split_labels(total, "Municipality", prefix), "SheetLabel",
                      f"{out}/{name}/by_label", fmt="csv", key_col="Municipality")


def run(spark: SparkSession, abatement_dir: str, tif_dir: str, rates_path: str, out: str,
        dom: Domain = TOWNSHIP, scope: str | None = TOWNSHIP_SCOPE,
        parcel_dir: str | None = None, tolerant: bool = False, store: str | None = None) -> dict[str, int]:
    """Run all stages; returns the row count of each written table. A yearly file that can't be read
    fails the job, or with ``tolerant`` is left out and reported. An output that the inputs can't give (no files of
    the trend years, missing columns) is named in ``quality/missing_outputs`` with the reason. ``store`` keeps
    the gathered rows for incremental runs. Stage tables lie in the shared checkpoint folder and go at the end."""
    stage = scratch_path(spark, "township")
    counts: dict[str, int] = {}
    missing: list[tuple[str, str]] = []
    # Validate the (small) rate table before any heavy work: unique
    # (year, district, class) keeps the left joins from fanning out fact rows.
    rates = read_rates(spark, rates_path, dom)
    rates_op.assert_unique(rates, pl.KEY)
    ab, ab_files = gather(spark, abatement_dir, ABATEMENT_PATTERN, scope, tolerant=tolerant,
                          store=f"{store}/abatements" if store else None)
    tif, tif_files = gather(spark, tif_dir, TIF_PATTERN, scope, strip_parcel_suffix=True, tolerant=tolerant,
                            store=f"{store}/tifs" if store else None)
    # Stage tables partitioned by tax year: later year-scoped reads prune folders.
    ab = _stage(ab, f"{stage}/abatements_all_years", counts, "abatements_all_years")
    tif = _stage(tif, f"{stage}/tifs_all_years", counts, "tifs_all_years")

    tif_rows, ab_rows = pl.tif_fact(tif, dom), pl.abatement_fact(ab, dom)
    tif_long = pl.fund_summary(
        pl.apportion_sum_rates(tif_rows, rates, dom, "DivertedTownship"),
        dom, "Taxes_Diverted_TIF")
    ab_long = pl.fund_summary(
        pl.apportion_total_rate(ab_rows, rates, dom, "ForegoneTownship"),
        dom, "Forgone_Revenue_Abatements")

    # Data-quality tables (CMP-12): one scan of each stage table makes a profile, the tables are aggregates of it.
    q = f"{out}/quality"
    tables: dict[str, list[DataFrame]] = {}
    for label, raw, fact, kinds, amount in (("TIF", tif, pl.tif_fact, sources.TIF_TYPES, "DivertedTownship"),
                                            ("Abatement", ab, pl.abatement_fact, sources.ABATEMENT_TYPES, "ForegoneTownship")):
        # Every typed column the files carry (TaxYear is already typed in the stage).
        types = {c: t for c, t in schemas.present(kinds, raw.columns).items() if c != "TaxYear"}
        found = sinks.write_stage(pl.stage_profile(raw, lambda df, fact=fact: fact(df, dom), types, amount),
                                  f"{stage}/profile_{label}")
        for name, table in pl.profile_tables(found, rates, types).items():
            tables.setdefault(name, []).append(table.withColumn("Source", F.lit(label)))
    for name, (one, two) in tables.items():
        _write(one.unionByName(two), f"{q}/{name}", counts, f"quality/{name}")
    if tolerant:
        _write(tif_files.withColumn("Source", F.lit("TIF")).unionByName(ab_files.withColumn("Source", F.lit("Abatement"))),
               f"{q}/files", counts, "quality/files")
    _report(tif_long, out, "Final_", counts, "tif_by_fund")
    _report(ab_long, out, "Final_", counts, "abatements_by_fund")

    combined = pl.combined_loss(spark.read.option("header", True).schema(tif_long.schema)
                                .csv(f"{out}/tif_by_fund/Total"),
                                spark.read.option("header", True).schema(ab_long.schema)
                                .csv(f"{out}/abatements_by_fund/Total"))
    _report(combined, out, "Combined_", counts, "combined")

    series = pl.loss_series(combined)
    _write(pl.chart_series(series), f"{out}/chart_series", counts, "chart_series")
    _write(pl.invalid_loss_rows(combined), f"{out}/quality/invalid_loss_rows", counts,
           "quality/invalid_loss_rows")

    # Trends: fire rate from the rate table, TIF taxable value from the stage.
    fire = fire_rate_trend(spark, rates_path)
    _write(fire, f"{out}/trends/fire_rate", counts, "trends/fire_rate")
    _write(trend.avg_change(fire, "pct_change_global_fire_rate"), f"{out}/trends/fire_rate_avg",
           counts, "trends/fire_rate_avg")
    county, why = value_rows(spark, tif_dir, tolerant=tolerant)
    if county is None:
        missing += [("trends/tif_value", why), ("trends/tif_value_avg", why)]
    else:
        value = tif_value_trend(county)
        _write(value, f"{out}/trends/tif_value", counts, "trends/tif_value")
        _write(trend.avg_change(value, "pct_change"), f"{out}/trends/tif_value_avg", counts,
               "trends/tif_value_avg")

    # Parcel comparison of one district over a few years (wide + long).
    cmp_cols = [c for c in COMPARE_COLUMNS if c in tif.columns]
    if "DivertedTownship" not in cmp_cols:
        missing.append(("parcel_comparison", "no column DivertedTownship"))
    else:
        wide, long = pl.parcel_comparison(tif, COMPARE_DISTRICT, COMPARE_YEARS, cmp_cols,
                                          "DivertedTownship", "Township")
        _write(wide, f"{out}/parcel_comparison/wide", counts, "parcel_comparison/wide")
        _write(long, f"{out}/parcel_comparison/long", counts, "parcel_comparison/long")
        # (parcel, year) pairs that occur more than once were summed in the wide
        # form; each raw row gives one long row per amount type, so one type's
        # rows are the raw rows.
        one_type = long.where(F.col("DivertedType") == F.lit(cmp_cols[0]))
        _write(rates_op.duplicate_keys(one_type, ["ParcelNumber", "TaxYear"]),
               f"{q}/parcel_comparison_duplicates", counts, "quality/parcel_comparison_duplicates")

    # Parcel files <-> TIF reconciliation.
    if parcel_dir:
        # One pass over both sides; the two outputs are read off what it wrote.
        parcels, rejected = parcel_files(spark, parcel_dir)
        _write(rejected, f"{q}/rejected_lines", counts, "quality/rejected_lines")
        both = sinks.write_stage(reconcile_parcels(tif, parcels), f"{stage}/reconciled")
        hit = F.col(combine.MATCHED)
        _write(both.where(hit).drop(combine.MATCHED), f"{out}/reconcile/matched", counts, "matched")
        _write(both.where(~hit).select(*tif.columns), f"{out}/reconcile/unmatched", counts, "unmatched")

    present = [c for c in COUNTY_COLUMNS if c in tif.columns]
    typed_tif = tif.withColumns({
        "TaxDistrict": clean.zero_pad("TaxDistrict", 3), "TaxYear": clean.to_int("TaxYear"),
        **{c: clean.to_num(c) for c in present}})
    typed_tif = typed_tif.withColumn("Municipality", pl.municipality(dom))
    county = pl.county_totals(typed_tif, present or [F.lit(None).cast("double")])
    _report(county, out, "CountyTot_", counts, "county_totals")
    if not present:
        missing.append(("county_totals", "no county columns: all totals are 0"))
    _write(spark.createDataFrame(missing, "Output string, Reason string"), f"{q}/missing_outputs", counts, "quality/missing_outputs")
    drop_scratch(spark, [stage])
    return counts


def main(argv: list[str] | None = None) -> None:
    from fundflow.session import build_session
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--abatements", required=True)
    p.add_argument("--tifs", required=True)
    p.add_argument("--rates", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--scope", default=TOWNSHIP_SCOPE)
    p.add_argument("--tolerant", action="store_true", help="leave out files that can't be read, and report them")
    p.add_argument("--store", default=None, help="folder that keeps the gathered rows: later runs read changed years only")
    p.add_argument("--parcels", default=None, help="folder of yearly parcel files to reconcile")
    a = p.parse_args(argv)
    spark = build_session()
    for k, v in run(spark, a.abatements, a.tifs, a.rates, a.out, scope=a.scope,
                    parcel_dir=a.parcels, tolerant=a.tolerant, store=a.store).items():
        print(f"{k}: {v} rows")


if __name__ == "__main__":
    main()
