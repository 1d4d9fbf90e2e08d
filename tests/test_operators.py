"""Reshape, combine, reconcile, trend operators on tiny frames."""

import pytest
from pyspark.sql import functions as F

from fundflow.operators import agg, combine, rates, reshape, trend


def test_to_wide_names_and_order(spark):
    df = spark.createDataFrame([("p", 2022, 1.0, 2.0), ("p", 2023, 3.0, 4.0), ("p", 2023, 1.0, None),
                                ("q", 2022, 5.0, None)], "id string, y int, A double, B double")
    w = reshape.to_wide(df, ["id"], "y", ["A", "B"], [2022, 2023])
    assert w.columns == ["id", "A_2022", "A_2023", "B_2022", "B_2023"]
    got = {r.id: tuple(r)[1:] for r in w.collect()}
    assert got["p"] == (1.0, 4.0, 2.0, 4.0)
    assert got["q"] == (5.0, None, None, None)


def test_to_wide_single_measure(spark):
    df = spark.createDataFrame([("p", 2022, 1.0)], "id string, y int, A double")
    w = reshape.to_wide(df, ["id"], "y", ["A"], [2022, 2023])
    assert w.columns == ["id", "A_2022", "A_2023"]


def test_to_long_keeps_nulls(spark):
    df = spark.createDataFrame([(1, 1.0, None)], "k int, a double, b double")
    rows = reshape.to_long(df, ["k"], ["a", "b"], "name", "v").collect()
    assert sorted((r.name, r.v) for r in rows) == [("a", 1.0), ("b", None)]


def test_outer_combine_null_keys_and_fill(spark):
    a = spark.createDataFrame([(1, "x", 1.0), (None, "y", 2.0)], "k int, m string, a double")
    b = spark.createDataFrame([(1, "x", 10.0), (None, "y", 20.0), (3, "z", 30.0)], "k int, m string, b double")
    out = combine.outer_combine(a, b, ["k", "m"], total="t")
    got = sorted((r.k if r.k is not None else -1, r.a, r.b, r.t) for r in out.collect())
    assert got == [(-1, 2.0, 20.0, 22.0), (1, 1.0, 10.0, 11.0), (3, 0.0, 30.0, 30.0)]


@pytest.mark.parametrize("kind", ["double", "float", "int", "smallint", "bigint", "decimal(18,2)", "string"])
def test_outer_combine_rejects_repeated_keys(spark, kind):
    a = spark.createDataFrame([(1, "1"), (2, "2"), (None, "3")], "k int, a string").selectExpr("k", f"CAST(a AS {kind}) a")
    b = spark.createDataFrame([(1, "4"), (1, "4")], "k int, b string").selectExpr("k", f"CAST(b AS {kind}) b")
    fill = None if kind == "string" else 0
    ok = combine.outer_combine(a, b.distinct(), ["k"], fill=fill)
    assert sorted((r.k or 0, int(r.a or 0), int(r.b or 0)) for r in ok.collect()) == [(0, 3, 0), (1, 1, 4), (2, 2, 0)]
    for left, right in ((a, b), (b.withColumnRenamed("b", "x"), a)):
        with pytest.raises(Exception, match="occurs twice"):
            combine.outer_combine(left, right, ["k"], fill=fill).collect()


def test_reconcile_partition_of_keys(spark):
    left = spark.createDataFrame([("a", 1), ("b", 1), ("a", 2), (None, 1)], "p string, y int")
    right = spark.createDataFrame([("a", 1, 9), ("a", 1, 8), (None, 1, 7), (None, 1, 6)], "p string, y int, v int")
    m, u = combine.reconcile(left, right, ["p", "y"])
    assert sorted((r.p, r.y, r.v) for r in m.collect()) == [("a", 1, 8), ("a", 1, 9)]
    assert sorted((r.p or "-", r.y) for r in u.collect()) == [("-", 1), ("a", 2), ("b", 1)]
    m, u = combine.reconcile(left, right, ["p", "y"], null_keys="match")
    assert sorted((r.p or "-", r.y, r.v) for r in m.collect()) == [("-", 1, 6), ("-", 1, 7), ("a", 1, 8), ("a", 1, 9)]
    assert sorted((r.p, r.y) for r in u.collect()) == [("a", 2), ("b", 1)]
    for null_keys in ("unmatched", "match"):
        m, u = combine.reconcile(left, right, ["p", "y"], null_keys)
        both = combine.reconcile_marked(left, right, ["p", "y"], null_keys)
        assert sorted(map(str, both.where("_matched").drop("_matched").collect())) == sorted(map(str, m.collect()))
        assert sorted(map(str, both.where("not _matched").select(*left.columns).collect())) == sorted(map(str, u.collect()))
    with pytest.raises(ValueError):
        combine.reconcile(left, right, ["p", "y"], "other")


def test_reconcile_exchanges_each_side_once(spark, capsys):
    left = spark.range(100).selectExpr("id % 7 as p", "id as y", "id as a")
    right = spark.range(100).selectExpr("id % 5 as p", "id as y", "id as b")
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for df in combine.reconcile(left, right, ["p", "y"]):
            df.explain()
            assert capsys.readouterr().out.count("Exchange hashpartitioning") == 2
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_sum0_and_sum_across(spark):
    df = spark.createDataFrame([("g", None, None), ("g", None, None), ("h", 1.0, None)], "k string, a double, b double")
    got = {r.k: (r.s, r.t) for r in df.groupBy("k").agg(agg.sum0("a").alias("s"),
                                                        agg.sum_across(["a", "b"]).alias("t")).collect()}
    assert got == {"g": (0.0, 0.0), "h": (1.0, 1.0)}


def test_mean_by_drops_null_keys(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 100.0)], "k string, v double")
    assert [tuple(r) for r in agg.mean_by(df, ["k"], "v", "m").collect()] == [("a", 2.0)]


def test_invalid_counts(spark):
    df = spark.createDataFrame([("a", -1.0), ("a", None), ("a", 2.0), ("b", 1.0)], "k string, v double")
    got = {r.k: (r.n_rows, r.n_invalid) for r in agg.invalid_counts(df, ["k"], "v").collect()}
    assert got == {"a": (3, 2), "b": (1, 0)}


def test_pct_change_partitioned(spark):
    df = spark.createDataFrame([("a", 1, 100.0), ("a", 2, 110.0), ("b", 1, 50.0), ("b", 2, 25.0)],
                               "g string, y int, v double")
    got = {(r.g, r.y): r.pc for r in trend.pct_change(df, "v", "y", "pc", ["g"]).collect()}
    assert got[("a", 1)] is None and got[("a", 2)] == pytest.approx(10.0)
    assert got[("b", 2)] == pytest.approx(-50.0)


def test_expand_alias_and_unique(spark):
    r = spark.createDataFrame([("170", 1.0), ("027", 2.0)], "d string, g double")
    e = rates.expand_alias(r, "d", {"171": "170", "172": "170"})
    assert sorted(x.d for x in e.collect()) == ["027", "170", "171", "172"]
    rates.assert_unique(e, ["d"])
    with pytest.raises(ValueError):
        rates.assert_unique(e.unionByName(r), ["d"])


def test_apportion_gated_and_zero_denominator(spark):
    fact = spark.createDataFrame([(2020, "170", "R", 100.0), (2020, "027", "R", 100.0),
                                  (2020, "170", None, 100.0), (2020, "999", "R", 100.0)],
                                 "TaxYear int, TaxDistrict string, PropertyClass string, amt double")
    rt = spark.createDataFrame([(2020, "170", "R", 1.0, 3.0, 1.0), (2020, "027", "R", 1.0, 1.0, 2.0),
                                (2020, "999", "R", 0.0, 0.0, 0.0)],
                               "TaxYear int, TaxDistrict string, PropertyClass string, g double, f double, r double")
    out = rates.apportion(fact, rt, ["TaxYear", "TaxDistrict", "PropertyClass"], "amt",
                          {"G": "g", "F": "f", "R": "r"}, gated={"R": ("TaxDistrict", ["170"])})
    got = {(r.TaxDistrict, r.PropertyClass): (r.Lost_G, r.Lost_F, r.Lost_R) for r in out.collect()}
    assert got[("170", "R")] == (20.0, 60.0, 20.0)
    assert got[("027", "R")] == (25.0, 25.0, 0.0)       # not gated: Road is 0
    assert got[("170", None)] == (None, None, None)     # no rate matched
    assert got[("999", "R")] == (None, None, 0.0)       # zero denominator -> NULL, no error


def test_parcel_comparison_and_value_trend(spark):
    from fundflow.plans import pipeline as pl
    from fundflow.plans import township as job
    rows = [("027-1", "2022", "027", "$1,000.00", "$5"), ("027-1", "2023", "27", "$1,250.00", None),
            ("027-1", "2024", "027", "$1,000.00", "$7"), ("027-2", "2022", "027", "0", "1"),
            ("027-2", "2023", "027", "10", "1"), ("170-9", "2022", "170", "99", "1"),
            ("027-2", "2023", "027", "5", None)]
    tif = spark.createDataFrame(rows, "ParcelNumber string, TaxYear string, TaxDistrict string, "
                                      "DivertedTownship string, DivertedZoo string")
    wide, long = pl.parcel_comparison(tif, "027", [2022, 2023, 2024], ["DivertedTownship", "DivertedZoo"],
                                      "DivertedTownship", "Township")
    got = {r.ParcelNumber: r for r in wide.collect()}
    assert set(got) == {"027-1", "027-2"}
    assert got["027-1"].PctChange_Township_22_23 == 25.0
    assert got["027-1"].PctChange_Township_23_24 == -20.0
    assert got["027-2"].PctChange_Township_22_23 is None          # base 0: guarded
    assert got["027-2"].DivertedTownship_2023 == 15.0             # duplicate (parcel, year) summed
    assert got["027-1"].DivertedZoo_2023 is None
    assert long.count() == 6 * 2

    vals = [("2014", "170", "100", "50"), ("2014", "0027", None, "40"), ("2017", "67", "300", None),
            ("2017", "999", "1000", "1000"), ("2016", "170", "5", "5"), ("2020", None, "1", "1")]
    t = spark.createDataFrame(vals, "TaxYear string, TaxDistrict string, AppraisedTotal string, "
                                    "AssessedTotal string").withColumn("TaxYear", F.col("TaxYear").cast("int"))
    out = {r.TaxYear: r for r in job.tif_value_trend(t).collect()}
    assert sorted(out) == [2014, 2017]
    assert out[2014].total_tif_value == pytest.approx(0.35 * 140)
    assert out[2017].total_tif_value == pytest.approx(0.35 * 300)
    assert out[2017].pct_change == pytest.approx((300 / 140 - 1) * 100)


def test_checkpoint_root_reads_session_setting(spark):
    from fundflow.session import checkpoint_root, scratch_path
    root = checkpoint_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    p1, p2 = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert p1 != p2 and p1.startswith(root + "/fundflow/x-")


def test_apportion_keeps_rates(spark):
    fact = spark.createDataFrame([(2020, "170", "R", 100.0)],
                                 "TaxYear int, TaxDistrict string, PropertyClass string, amt double")
    rt = spark.createDataFrame([(2020, "170", "R", 1.0, 3.0)],
                               "TaxYear int, TaxDistrict string, PropertyClass string, g double, f double")
    keys = ["TaxYear", "TaxDistrict", "PropertyClass"]
    out = rates.apportion(fact, rt, keys, "amt", {"G": "g", "F": "f"}, keep_rates=True).first()
    assert (out.Lost_G, out.Lost_F, out.g) == (25.0, 75.0, 1.0)


def test_write_stage_keeps_codes_and_columns(spark):
    from fundflow.operators import sinks
    from fundflow.session import scratch_path
    df = spark.createDataFrame([("027", 1), ("170", 2), (None, 3)], "TaxDistrict string, v int")
    got = sinks.write_stage(df.select("TaxDistrict", "v"), scratch_path(spark, "codes"), ["TaxDistrict"])
    assert got.columns == ["TaxDistrict", "v"] and dict(got.dtypes)["TaxDistrict"] == "string"
    assert sorted((r.TaxDistrict or "-", r.v) for r in got.collect()) == [("-", 3), ("027", 1), ("170", 2)]


def test_split_folders_of_equal_labels(spark):
    from fundflow.operators import sinks
    from fundflow.plans import pipeline as pl
    from fundflow.session import scratch_path
    names = ["Jefferson Unincorporated North", "Jefferson Unincorporated South", "Gahanna", None]
    df = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "m string, v int")
    path = scratch_path(spark, "split")
    written = sinks.write_split(pl.split_labels(df, "m", "Combined_"), "SheetLabel", path, key_col="m")
    rows = {r.v: r for r in spark.read.schema(written.schema).parquet(path).collect()}
    assert rows[0].SheetLabel == rows[1].SheetLabel and rows[0].Folder != rows[1].Folder
    assert rows[2].Folder == "Combined_Gahanna" and len(rows) == 4


def test_drop_scratch(spark):
    import os

    from fundflow.session import drop_scratch, local_path, scratch_path
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert os.path.isdir(local_path(path))
    drop_scratch(spark, [path])
    assert not os.path.isdir(local_path(path))
