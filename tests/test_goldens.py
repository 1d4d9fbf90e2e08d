"""Golden tests G1-G4 (FIXTURES.md), values computed by hand from the study's data."""

import pytest
from pyspark.sql import functions as F

from fundflow.functions import clean
from fundflow.operators import rates as rates_op
from fundflow.plans import pipeline as pl
from fundflow.plans.domain import TOWNSHIP, TOWNSHIP_SCOPE

from tests import township as tw

# Expected G1 wide result
# (year, Gahanna General, Gahanna Fire, JU General, JU Fire, JU Road).
G1 = [
    (2014, 396.177725, 2437.772275, 178.890950, 1783.226313, 44.722737),
    (2015, 390.817959, 2220.472041, 117.643393, 1082.812729, 358.793878),
    (2016, 392.662230, 2227.017770, 1128.196483, 10365.835439, 3436.298078),
    (2017, 418.160071, 2121.679929, 1022.120774, 8401.455601, 2812.333624),
    (2018, 310.100101, 1574.179899, 975.091735, 8018.865798, 2685.722467),
    (2019, 316.788275, 1585.331725, 995.672914, 8072.029839, 2705.027247),
    (2020, 659.873900, 2809.756100, 1146.867018, 7911.079516, 2703.383466),
    (2021, 2459.047123, 10429.032877, 705.854918, 4849.619274, 1657.655807),
    (2022, 2312.923841, 12634.896159, 523.176964, 4629.925174, 1223.167862),
    (2023, 13590.818847, 56842.551153, 402.716224, 2728.613845, 746.939930),
    (2024, 26586.435593, 111817.214407, 402.459994, 2742.118914, 750.261092),
]

# Expected G3 wide result (year, municipality, General, Fire, Road).
G3 = [
    (2022, "Gahanna", 410.008785, 2589.991215, 0.0),
    (2022, "Jefferson Unincorporated", 95.933917, 971.016167, 233.049916),
    (2022, "Reynoldsburg", 0.0, 0.0, 0.0),
    (2023, "Columbus", 0.0, 0.0, 0.0),
    (2023, "Other", 0.0, 0.0, 0.0),
    (2025, "Jefferson Unincorporated", 0.0, 0.0, 0.0),
]


@pytest.fixture(scope="module")
def rates(spark):
    return pl.prepare_rates(tw.raw_rates(spark), TOWNSHIP).cache()


def abatement_apportioned(spark, rates):
    fact = pl.abatement_fact(tw.raw_abatements(spark), TOWNSHIP)
    return pl.apportion_total_rate(fact, rates, TOWNSHIP, "ForegoneTownship")


def tif_apportioned(spark, rates):
    raw = tw.raw_tifs(spark).filter(clean.trim_ws("Township") == TOWNSHIP_SCOPE)
    fact = pl.tif_fact(raw, TOWNSHIP)
    return pl.apportion_sum_rates(fact, rates, TOWNSHIP, "DivertedTownship")


def test_rates_expand_to_110_unique(rates):
    assert rates.count() == 110
    rates_op.assert_unique(rates, pl.KEY)
    assert rates.filter(F.col("TaxDistrict") == "171").count() == 22
    assert rates.filter(F.col("TaxDistrict") == "027").count() == 22


def test_g1_abatement_wide(spark, rates):
    wide = pl.fund_wide(abatement_apportioned(spark, rates), TOWNSHIP)
    got = {(r.TaxYear, r.Municipality): r for r in wide.collect()}
    assert len(got) == 22
    for y, gg, gf, jg, jf, jr in G1:
        g, j = got[(y, "Gahanna")], got[(y, "Jefferson Unincorporated")]
        assert g.General == pytest.approx(gg, abs=1e-6)
        assert g.Fire == pytest.approx(gf, abs=1e-6)
        assert g.Road == 0.0
        assert j.General == pytest.approx(jg, abs=1e-6)
        assert j.Fire == pytest.approx(jf, abs=1e-6)
        assert j.Road == pytest.approx(jr, abs=1e-6)


def test_g1_abatement_long(spark, rates):
    long = pl.fund_summary(abatement_apportioned(spark, rates), TOWNSHIP, "Forgone_Revenue_Abatements")
    assert long.count() == 55
    assert long.filter((F.col("Fund") == "Road") & (F.col("Municipality") == "Gahanna")).count() == 0
    total = long.agg(F.sum("Forgone_Revenue_Abatements")).first()[0]
    assert total == pytest.approx(341842.29, abs=1e-6)


def test_g2_fire_rate_trend(spark):
    raw = tw.raw_rates(spark)
    df = raw.select(F.col("TaxYear").cast("int").alias("Year"), "Municipality",
                    F.col("FireRate").cast("double").alias("Effective_Rate"))
    t = pl.rate_trend(df, "Municipality", "Year", "Effective_Rate", [2014, 2017, 2020, 2023],
                      "avg_fire_rate", "global_avg_fire_rate", "pct_change")
    rows = t.orderBy("Year").collect()
    assert [r.Year for r in rows] == [2014, 2017, 2020, 2023]
    assert rows[0].global_avg_fire_rate == pytest.approx(10.4767145, abs=1e-9)
    assert rows[0].pct_change is None
    assert rows[1].pct_change == pytest.approx(-14.081060431684001, abs=1e-9)
    assert rows[2].pct_change == pytest.approx(-12.342600918382097, abs=1e-9)
    assert rows[3].pct_change == pytest.approx(3.8330313866166366, abs=1e-9)
    from fundflow.operators.trend import avg_change
    assert avg_change(t, "pct_change").first()[0] == pytest.approx(-7.530209987816487, abs=1e-9)


def test_g3_tif_edge_cases(spark, rates):
    wide = pl.fund_wide(tif_apportioned(spark, rates), TOWNSHIP)
    got = {(r.TaxYear, r.Municipality): (r.General, r.Fire, r.Road) for r in wide.collect()}
    assert len(got) == len(G3)
    for y, m, g, f, r in G3:
        assert got[(y, m)] == pytest.approx((g, f, r), abs=1e-6)
    long = pl.fund_summary(tif_apportioned(spark, rates), TOWNSHIP, "Taxes_Diverted_TIF")
    assert long.count() == 15


def test_g4_combined(spark, rates):
    tif = pl.fund_summary(tif_apportioned(spark, rates), TOWNSHIP, "Taxes_Diverted_TIF")
    ab = pl.fund_summary(abatement_apportioned(spark, rates), TOWNSHIP, "Forgone_Revenue_Abatements")
    comb = pl.combined_loss(tif, ab)
    rows = comb.collect()
    assert len(rows) == 65
    for r in rows:
        assert r.Taxes_Diverted_TIF is not None and r.Forgone_Revenue_Abatements is not None
    ex = [r for r in rows if (r.TaxYear, r.Municipality, r.Fund) == (2022, "Gahanna", "General")][0]
    assert ex.Taxes_Diverted_TIF == pytest.approx(410.008785, abs=1e-6)
    assert ex.Forgone_Revenue_Abatements == pytest.approx(2312.923841, abs=1e-6)
    assert ex.Total_Forgone_and_Diverted == pytest.approx(2722.932626, abs=1e-6)


def test_apportion_invariant_shares_sum_to_amount(spark, rates):
    """General+Fire+Road = amount for gated districts with a rate (sum-of-rates mode)."""
    app = tif_apportioned(spark, rates)
    rows = app.filter(F.col("TaxDistrict").isin("170", "171") & F.col("Lost_General").isNotNull()).collect()
    assert rows
    for r in rows:
        assert r.Lost_General + r.Lost_Fire + r.Lost_Road == pytest.approx(r.DivertedTownship, rel=1e-12)
