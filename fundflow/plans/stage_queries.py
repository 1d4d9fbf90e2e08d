"""Registered queries of the mechanisms behind the jobs: manifests and incremental gathers, rejected lines,
key and mapping tables, discovered columns, one-scan profiles, bucketed stages, published reports, exact sums.

All read whole driver tables. Where a mechanism follows changes, the query makes an
earlier state first (a year's file wrong, another missing), so that what it returns
is right only if the change was followed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundflow import sources
from fundflow.functions.sqltext import ident
from fundflow.operators import agg, combine, exact, keys, reshape, sinks
from fundflow.plans import driver as dv
from fundflow.plans import io_queries as io
from fundflow.plans import pipeline as pl
from fundflow.plans import queries as q
from fundflow.plans import summaries
from fundflow.plans.domain import DRIVER
from fundflow.session import scratch_path

# The year whose file is wrong at first, and the one that is missing.
CORRECTED_YEAR, LATE_YEAR = 1996, 2001


# ------------------------------------------------------ incremental gather ---
def _order_files(spark: SparkSession, sf: str, root: str, columns: dict[str, str], state: int) -> None:
    """Yearly folders of orders: first without the late year and with wrong prices in one, then as they should be."""
    o = dv.table(spark, sf, "orders").withColumn("_y", F.year("o_orderdate"))
    wrong = {"o_totalprice": F.when(F.col("_y") == CORRECTED_YEAR, 2 * F.col("o_totalprice")).otherwise(F.col("o_totalprice"))}
    if state == 1:
        o = o.where(F.col("_y") != LATE_YEAR).withColumns(wrong)
    else:
        o = o.where(F.col("_y").isin(CORRECTED_YEAR, LATE_YEAR))
    out = o.select(*[F.expr(sql).alias(c) for c, sql in columns.items()], F.col("_y").alias("Orders"))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("header", True)
     .option("nullValue", "NA").partitionBy("Orders").csv(root))


def _gathered(spark: SparkSession, sf: str, name: str, columns: dict[str, str], after=lambda gathered: gathered):
    """Two gathers of the orders' files, ``after`` each of them what follows."""
    root = scratch_path(spark, name)
    for state in (1, 2):
        _order_files(spark, sf, f"{root}/files", columns, state)
        last = after(sources.gather_years(spark, f"{root}/files", "*.csv", f"{root}/store", source="dir"), root)
    return last


def q_incremental_gather(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-1 / SRC-6: a corrected and a late file replace their years; the others stay as the first gather wrote them."""
    rows = _gathered(spark, sf, "incremental_gather", {"o_orderkey": "o_orderkey", "o_totalprice": "o_totalprice"},
                     lambda gathered, root: gathered.rows)
    return (sources.typed(rows, {"o_orderkey": "bigint", "o_totalprice": "double"})
            .select("o_orderkey", "o_totalprice", "FileYear", "Gather"))


def q_incremental_combine(spark: SparkSession, sf: str) -> DataFrame:
    """CMP-3 / CMP-4: abatement sums kept per file; the corrected and the late year are summed again, then combined."""
    columns = {"o_custkey": "o_custkey", "TaxYear": "_y", "o_totalprice": "o_totalprice"}
    rates = dv.rates(spark, sf)

    def shares(rows: DataFrame) -> DataFrame:
        o = sources.typed(rows, {"o_custkey": "bigint", "TaxYear": "int", "o_totalprice": "double"})
        j = o.join(dv.customers(spark, sf), F.expr("o_custkey = c_custkey"))
        fact = j.selectExpr("FileYear", "Gather", "SourceFile", "TaxYear + 1 AS TaxYear",
                            f"{dv.clean.zero_pad_sql('c_nationkey', 3)} AS TaxDistrict",
                            f"'{DRIVER.default_class}' AS PropertyClass", "o_totalprice AS Amount")
        return pl.apportion_total_rate(fact, rates, DRIVER, "Amount")

    funds = [f"Lost_{f}" for f in DRIVER.funds]
    wide = _gathered(spark, sf, "incremental_combine", columns, lambda gathered, root: summaries.refresh(
        gathered, f"{root}/partials", shares, ["TaxYear", "Municipality"], funds))
    wide = wide.withColumnsRenamed({f"Lost_{f}": f for f in DRIVER.funds})
    abate = pl.fund_long(wide, DRIVER, "Forgone_Revenue_Abatements")
    return q._round(pl.combined_loss(q._tif_long(spark, sf, rates), abate), 2)


# ------------------------------------------------------------ rejected lines ---
def q_rejected_lines(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-4: the lines kept (by key) and the lines rejected (their text and number of fields), from one scan."""
    path = io.malformed_export(spark, sf, "rejected_lines")
    lines = sources.read_csv_text(spark, path, ["c_custkey", "c_name", "c_nationkey"], source=None, keep_lines=True)
    kept, rejected = sources.stage_lines(lines, scratch_path(spark, "lines"))
    return (kept.select(F.lit("kept").alias("Outcome"), F.col("c_custkey").alias("Line"), F.lit(None).cast("int").alias("Fields"))
            .unionByName(rejected.withColumn("Outcome", F.lit("rejected"))))


# -------------------------------------------------------- keys and mappings ---
def q_keyed_exclusion(spark: SparkSession, sf: str) -> DataFrame:
    """FLT-2 / FLT-3: orders of the listed customers, without the listed (customer, priority) pairs; both lists grow
    with the customers, and the second has rows with a missing key."""
    o = dv.table(spark, sf, "orders").select("o_custkey", "o_orderpriority", "o_totalprice")
    c = dv.table(spark, sf, "customer")
    listed = c.where("c_mktsegment IN ('BUILDING', 'MACHINERY')").select(F.col("c_custkey").alias("o_custkey"))
    pairs = c.where("c_acctbal < 0").select(
        F.when(F.col("c_custkey") % 11 != 0, F.col("c_custkey")).alias("o_custkey"),
        F.explode(F.array(F.lit("1-URGENT"), F.lit("5-LOW"))).alias("o_orderpriority"))
    left = keys.drop_keys(keys.keep_keys(o, listed, ["o_custkey"]), pairs, ["o_custkey", "o_orderpriority"])
    return q._round(left.groupBy("o_custkey", "o_orderpriority").agg(
        F.count(F.lit(1)).alias("n_orders"), agg.sum0("o_totalprice").alias("total")), 2)


def q_fund_long_keyed(spark: SparkSession, sf: str) -> DataFrame:
    """FLT-3: the flagship with its fund x municipality exclusions as a key table."""
    pairs = keys.pairs_table(spark, DRIVER.excluded_pairs, "Fund", "Municipality")
    return q._round(pl.fund_summary(q._tif_apportioned(spark, sf), DRIVER, "Taxes_Diverted_TIF", pairs), 2)


def q_mapped_labels(spark: SparkSession, sf: str) -> DataFrame:
    """SCL-9 / SCL-10: line items labelled by a table of suppliers (some of them missing, each of the others twice):
    lines per label, unknown suppliers as Other."""
    s = dv.table(spark, sf, "supplier").where("s_acctbal >= 0").selectExpr(
        "s_suppkey AS l_suppkey", "concat('Nation ', s_nationkey) AS Label")
    li = dv.table(spark, sf, "lineitem").select("l_suppkey", "l_quantity")
    # Lines are summed by code before they are labelled: one row for each supplier.
    by_code = li.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n_rows"), agg.sum0("l_quantity").alias("quantity"))
    lab = keys.map_codes(by_code, s.unionByName(s), ["l_suppkey"], "Label", other="Other")
    return lab.groupBy("Label").agg(F.sum("n_rows").cast("bigint").alias("n_rows"), agg.sum0("quantity").alias("quantity"))


def q_wide_discovered(spark: SparkSession, sf: str) -> DataFrame:
    """RSH-2: per nation, order totals side by side for whatever years the orders have."""
    rows = dv.order_rows(spark, sf, {"TotalPrice": "o_totalprice"})
    rows = rows.groupBy("c_nationkey", "TaxYear").agg(agg.sum0("TotalPrice").alias("TotalPrice"))
    return q._round(reshape.to_wide(rows, ["c_nationkey"], "TaxYear", ["TotalPrice"]), 2)


# ------------------------------------------------------------------- profile ---
PROFILE_TYPES = {"Amount": "double", "Term": "int"}


def profile_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Abatement rows as text, some of it junk."""
    return dv.order_rows(spark, sf, {
        "Amount": "CASE o_orderkey % 5 WHEN 0 THEN 'n/a' WHEN 1 THEN NULL WHEN 2 THEN concat('-', o_totalprice) "
                  "ELSE CAST(o_totalprice AS STRING) END",
        "Term": "CASE WHEN o_orderkey % 3 = 0 THEN '10d' ELSE '12.0' END"}).selectExpr(
        f"{dv.parcel_id_sql('c_nationkey', 'o_custkey')} AS ParcelNumber", "CAST(TaxYear + 1 AS STRING) AS TaxYear",
        "Amount", "Term", "concat('Abatements', TaxYear, '.csv') AS SourceFile")


def q_quality_profile(spark: SparkSession, sf: str) -> DataFrame:
    """CMP-12: rows per file, rows without a rate, bad casts and invalid amounts, from one scan."""
    found = pl.stage_profile(profile_rows(spark, sf), lambda raw: pl.abatement_fact(raw, DRIVER, "Amount"), PROFILE_TYPES, "Amount")
    found = sinks.write_stage(found, scratch_path(spark, "quality_profile"))
    t = pl.profile_tables(found, dv.rates(spark, sf), PROFILE_TYPES)
    none = F.lit(None).cast("bigint")
    parts = [
        t["rows_per_file"].select(F.lit("file").alias("Check"), F.col("SourceFile").alias("Key"), "n_rows", none.alias("n_bad")),
        t["rate_coverage"].select(F.lit("rate"), F.concat_ws("/", F.col("TaxYear").cast("string"), "PropertyClass"),
                                  "n_rows", "n_unmatched"),
        t["bad_casts"].select(F.lit("cast"), "Column", none, "n_bad"),
        t["invalid_amounts"].select(F.lit("invalid"), "SourceFile", "n_rows", "n_invalid")]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


# ----------------------------------------------------------------- reconcile ---
def q_reconcile_marked(spark: SparkSession, sf: str) -> DataFrame:
    """CMP-8 in one pass: every TIF row with its parcel-file rows, marked matched or not."""
    return combine.reconcile_marked(q._tif_parcels(spark, sf), q._parcel_file_rows(spark, sf), ["ParcelNumber", "TaxYear"])


#: Buckets of the stage tables: rows of a bucket fit a task's memory; a parameter of the deployment.
BUCKETS = 16


def bucketed_sides(spark: SparkSession, sf: str, buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame]:
    """TIF rows and parcel-file rows as stage tables bucketed by parcel and year."""
    on = ["ParcelNumber", "TaxYear"]
    return tuple(sinks.write_bucketed(df, scratch_path(spark, "bucketed"), on, buckets)
                 for df in (q._tif_parcels(spark, sf), q._parcel_file_rows(spark, sf)))


def q_reconcile_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """JN-3 / JN-4 / CMP-8: both outputs over stage tables bucketed by the keys: no exchange when they are read."""
    left, right = bucketed_sides(spark, sf)
    matched, unmatched = combine.reconcile(left, right, ["ParcelNumber", "TaxYear"])
    return (matched.withColumn(combine.MATCHED, F.lit(True))
            .unionByName(unmatched.withColumn(combine.MATCHED, F.lit(False)), allowMissingColumns=True))


# ----------------------------------------------------------- report and money ---
def q_published_report(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-2: the combined loss published over an older, wrong version; what readers then find, by folder."""
    out = scratch_path(spark, "published_report")
    combined = pl.split_labels(q.q_combined_loss(spark, sf), "Municipality", "Combined_")
    old = combined.withColumn("Taxes_Diverted_TIF", -F.col("Taxes_Diverted_TIF")).where("Fund <> 'Fire'")
    sinks.publish(old, out, "SheetLabel", "Municipality")
    sinks.publish(combined, out, "SheetLabel", "Municipality")
    return spark.read.parquet(f"{sinks.published(spark, out)}/by_label").select(*combined.columns, "Folder")


def q_exact_fund_sums(spark: SparkSession, sf: str) -> DataFrame:
    """AGG-1 / AGG-3 / CMP-1 in decimals: amounts summed per supplier, year and class, shares in whole cents that add up
    to them, sums without any rounding at the end; as text, with the amount that found a rate."""
    li = dv.table(spark, sf, "lineitem").select(
        "l_suppkey", F.year("l_shipdate").alias("TaxYear"), "l_returnflag", exact.to_decimal("l_extendedprice").alias("price"))
    lines = li.groupBy("l_suppkey", "TaxYear", "l_returnflag").agg(exact.sum_exact("price").cast("decimal(18,2)").alias("Amount"))
    fact = (lines.join(dv.suppliers(spark, sf), F.expr("l_suppkey = s_suppkey"))
            .select("TaxYear", dv.clean.zero_pad("s_nationkey", 3).alias("TaxDistrict"),
                    dv.labels.recode("l_returnflag", DRIVER.class_codes).alias("PropertyClass"), "Amount"))
    app = exact.apportion_exact(fact, dv.rates(spark, sf), pl.KEY, "Amount", DRIVER.funds)
    app = app.withColumn("Municipality", pl.municipality(DRIVER)).withColumn(
        "Rated", F.when(F.col("Lost_General").isNotNull(), F.col("Amount")))
    sums = {**{f: f"Lost_{f}" for f in DRIVER.funds}, "Rated": "Rated"}
    out = app.groupBy("TaxYear", "Municipality").agg(*[exact.sum_exact(c).alias(n) for n, c in sums.items()])
    return out.select("TaxYear", "Municipality", *[F.col(ident(n)).cast("string").alias(n) for n in sums])


STAGE_QUERIES = {
    "incremental_gather": q_incremental_gather,
    "incremental_combine": q_incremental_combine,
    "rejected_lines": q_rejected_lines,
    "keyed_exclusion": q_keyed_exclusion,
    "fund_long_keyed": q_fund_long_keyed,
    "mapped_labels": q_mapped_labels,
    "wide_discovered": q_wide_discovered,
    "quality_profile": q_quality_profile,
    "reconcile_marked": q_reconcile_marked,
    "reconcile_bucketed": q_reconcile_bucketed,
    "published_report": q_published_report,
    "exact_fund_sums": q_exact_fund_sums,
}
