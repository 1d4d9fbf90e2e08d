"""Invariants on the driver tables."""

import os

import pytest
from pyspark.sql import functions as F

from fundflow.operators import combine, rates
from fundflow.plans import driver as dv
from fundflow.plans import pipeline as pl
from fundflow.plans import queries as q
from fundflow.plans.domain import DRIVER

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def test_long_is_three_funds_minus_excluded(spark):
    app = q._tif_apportioned(spark, SF)
    wide = pl.fund_wide(app, DRIVER)
    long = pl.fund_summary(app, DRIVER, "v")
    excluded = wide.where(F.col("Municipality").isin(DRIVER.excluded_pairs["Road"])).count()
    assert long.count() == 3 * wide.count() - excluded


def test_rates_unique_and_alias_rows(spark):
    r = dv.rates(spark, SF)
    rates.assert_unique(r, pl.KEY)
    per = {row.TaxDistrict: row["count"] for row in r.groupBy("TaxDistrict").count().collect()}
    assert per["024"] == per["023"] == 12          # 6 years x 2 classes, alias copied
    assert r.count() == 300


def test_shares_add_up_to_amount_where_rated(spark):
    app = q._tif_apportioned(spark, SF)
    # Shares add back to the amount where no fund is dropped: gated districts
    # (Road kept) and districts without a road rate (nation >= 10).
    full = F.col("TaxDistrict").isin(DRIVER.gated_districts) | (F.col("TaxDistrict").cast("int") >= 10)
    gated = app.where(full & F.col("Lost_General").isNotNull())
    bad = gated.where(F.abs(F.col("Lost_General") + F.col("Lost_Fire") + F.col("Lost_Road") - F.col("Amount"))
                      > F.lit(1e-6) * F.abs(F.col("Amount")))
    assert gated.count() > 0 and bad.count() == 0


def test_reconcile_partitions_left_keys(spark):
    left, right = q._tif_parcels(spark, SF), q._parcel_file_rows(spark, SF)
    matched, unmatched = combine.reconcile(left, right, ["ParcelNumber", "TaxYear"])
    keys = ["ParcelNumber", "TaxYear"]
    m, u = matched.select(*keys).distinct(), unmatched.select(*keys).distinct()
    assert m.join(u, keys).count() == 0
    assert m.unionByName(u).distinct().count() == left.select(*keys).distinct().count()
    assert unmatched.count() + left.join(m, keys, "left_semi").count() == left.count()


def test_combined_zero_filled_totals(spark):
    comb = q._combined(spark, SF)
    assert comb.where(F.col("Taxes_Diverted_TIF").isNull() | F.col("Forgone_Revenue_Abatements").isNull()).count() == 0
    off = comb.where(F.abs(F.col("Total_Forgone_and_Diverted") - F.col("Taxes_Diverted_TIF")
                           - F.col("Forgone_Revenue_Abatements")) > 1e-6)
    assert off.count() == 0
