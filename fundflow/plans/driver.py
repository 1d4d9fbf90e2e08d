"""The township model mapped onto the TPC-H-like driver tables.

Row meaning is carried over, not the data:

* rates      nation x tax years 1995-2000 x classes {A, N}; nation 24 has no
             rates of its own and borrows nation 23's (alias expansion).
* TIF fact   lineitem joined to its supplier: year = ship year, district =
             supplier nation, class = return flag (R has none), amount =
             extended price. Ship year 2001 has no rates on purpose.
* abatement  orders joined to their customer: a parcel id
             ``<nation>-<custkey>-00`` whose prefix is the district, tax year =
             the year after the order's (so the first TIF year and the last
             abatement year have no partner in the combine), class constant,
             amount = total price.

Large-scale notes: the TIF fact is pre-aggregated to (supplier, year, flag)
*before* the supplier join (the apportioned shares are linear in the amount),
so the shuffle into the join carries one row per supplier-year-flag instead
of one per line item (~28x fewer), and a supplier holding a third of all
lines costs one row per task. Orders are joined to their customer first
(see ``order_rows``). No broadcast hints: dimensions are broadcast by the planner's
size threshold (and AQE's run-time sizes), shuffled beyond it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundflow.functions import clean, labels
from fundflow.functions.sqltext import ident, lit
from fundflow.operators import rates as rates_op
from fundflow.plans.domain import DRIVER

# Fixed values of the driver mapping (see module docstring).
RATE_YEARS = (1995, 2000)          # inclusive
RATE_CLASSES = ("A", "N")
NATION_WITHOUT_RATES = 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given Parquet table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def parcel_id_sql(district: str, key: str, suffix: str | None = "00", width: int = 6) -> str:
    """SQL text of a ``ddd-nnnnnn[-ss]`` parcel-style id from two columns
    (``suffix`` is literal text, or SQL text when it starts with ``=``)."""
    parts = [clean.zero_pad_sql(ident(district), 3), "'-'", clean.zero_pad_sql(ident(key), width)]
    if suffix is not None:
        parts += ["'-'", suffix[1:] if suffix.startswith("=") else lit(suffix)]
    return f"concat({', '.join(parts)})"


def parcel_id(district: str, key: str, suffix: str | None = "00", width: int = 6):
    """``ddd-nnnnnn[-ss]`` parcel-style id; parts are padded, never truncated."""
    return F.expr(parcel_id_sql(district, key, suffix, width))


def split_id_sql(key: str, width: int = 9) -> str:
    s = clean.zero_pad_sql(ident(key), width)
    return f"overlay({s} PLACING '-' FROM length({s}) - 5 FOR 0)"


def split_id(key: str, width: int = 9):
    """Order key as ``ddd-nnnnnn``: the last six digits after the first three (or more)."""
    return F.expr(split_id_sql(key, width))


def rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate table, unique on (TaxYear, TaxDistrict, PropertyClass), alias rows added.

    Years and classes are generated per nation row (``explode``), not by a
    cross join.
    """
    classes = ", ".join(lit(c) for c in RATE_CLASSES)
    base = (table(spark, sf_dir, "nation")
            .where(f"n_nationkey <> {NATION_WITHOUT_RATES}")
            .selectExpr("n_nationkey AS n",
                        f"explode(sequence({RATE_YEARS[0]}, {RATE_YEARS[1]})) AS TaxYear")
            .selectExpr("n", "TaxYear", f"explode(array({classes})) AS PropertyClass")
            .selectExpr(
                "TaxYear",
                f"{clean.zero_pad_sql('n', 3)} AS TaxDistrict",
                "PropertyClass",
                "1.0D + (n % 3) * 0.31D AS GeneralRate",
                "6.0D + ((7 * n + TaxYear) % 40) / 10.0D AS FireRate",
                "CASE WHEN n < 10 THEN 0.25D + (TaxYear % 4) * 0.7D ELSE 0.0D END AS RoadRate")
            .selectExpr("*", "GeneralRate + FireRate + RoadRate AS TotalTownshipMillage"))
    return rates_op.expand_alias(base, "TaxDistrict", DRIVER.rate_aliases)


def tif_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items reduced to (supplier, ship year, flag): amount and row count.

    Map-side partial aggregation runs in the scan stage.
    """
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy("l_suppkey", F.expr("CAST(year(l_shipdate) AS INT)").alias("TaxYear"),
                       "l_returnflag")
            .agg(F.expr("sum(l_extendedprice)").alias("Amount"), F.expr("count(1)").alias("n_rows")))


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier -> nation. No broadcast hint: the planner broadcasts it while its
    size statistics are under the threshold and shuffles it beyond."""
    return table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")


def tif_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TIF-like fact: TaxYear, TaxDistrict, PropertyClass, Amount, n_rows."""
    f = tif_lines(spark, sf_dir).join(suppliers(spark, sf_dir), F.expr("l_suppkey = s_suppkey"))
    return f.select(
        "TaxYear",
        clean.zero_pad("s_nationkey", 3).alias("TaxDistrict"),
        labels.recode("l_returnflag", DRIVER.class_codes).alias("PropertyClass"),
        "Amount", "n_rows")


def order_rows(spark: SparkSession, sf_dir: str, measures: dict | None = None,
               years=None) -> DataFrame:
    """Orders with their customer's nation: one row per order.

    Joined first, aggregated after: at TPC-H proportions a customer has ~1.4
    orders a year, so summing per (customer, year) before the join would save
    almost nothing and cost a second large shuffle. At scale this is one
    sort-merge join (orders shuffled once by customer); a customer holding a
    third of the orders is split over several tasks by AQE's skew join, and
    every later aggregation combines map-side. ``measures`` maps output name
    -> SQL expression over ``orders``; ``years`` keeps those order years with a
    date-range predicate the Parquet scan can skip row groups on.
    """
    measures = measures or {"Amount": "o_totalprice"}
    o = table(spark, sf_dir, "orders")
    if years is not None:
        o = o.where(clean.year_in_sql("o_orderdate", years))
    o = o.selectExpr(
        "o_custkey", "CAST(year(o_orderdate) AS INT) AS TaxYear",
        *[f"{sql} AS {ident(n)}" for n, sql in measures.items()])
    return o.join(customers(spark, sf_dir), F.expr("o_custkey = c_custkey"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")


def abatement_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Abatement-like fact: ParcelNumber, TaxYear, TaxDistrict (id prefix), class, Amount."""
    j = order_rows(spark, sf_dir)
    pid = parcel_id_sql("c_nationkey", "o_custkey")
    return j.selectExpr(
        f"{pid} AS ParcelNumber",
        "TaxYear + 1 AS TaxYear",
        f"{clean.zero_pad_sql(clean.prefix_sql(pid, 3), 3)} AS TaxDistrict",
        f"{lit(DRIVER.default_class)} AS PropertyClass",
        "Amount")
