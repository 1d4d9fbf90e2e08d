"""Manifests, incremental gathers and summaries, rejected lines, key and mapping tables, discovered columns,
profiles, bucketed stages, published reports, exact sums."""

import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fundflow import sources
from fundflow.operators import combine, exact, keys, profile, reshape, sinks
from fundflow.plans import pipeline as pl
from fundflow.plans import stage_queries as sq
from fundflow.plans import summaries
from fundflow.plans.domain import DRIVER, TOWNSHIP
from fundflow.plans import driver as dv
from fundflow.sources import manifest as mf

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


# ----------------------------------------------------------------- manifest ---
def test_each_file_is_opened_once(spark, tmp_path):
    for y in range(2010, 2016):
        write(f"{tmp_path}/Tif{y}.csv", f"A,B\n{y},1\n" if y % 2 else f"B,A\n1,{y}\n")
    (tmp_path / "Tif2016.csv").write_bytes(b"A\n\xff\n")
    opens = spark.sparkContext.accumulator(0)
    m = mf.build(spark, str(tmp_path), "Tif*.csv", whole=True, opens=opens)
    # The error test, the distinct headers, the paths of each, the report: all from the table.
    df = sources.read_manifest(spark, m)
    report = {r.SourceFile: (r.seen, r.n_rows, (r.error or "").split(":")[0])
              for r in mf.sources_report(m, sources.ingest_audit(df)).collect()}
    assert sorted(int(r.A) for r in df.collect()) == list(range(2010, 2016))
    assert report["Tif2016.csv"] == (False, 0, "UnicodeDecodeError") and report["Tif2011.csv"] == (True, 1, "")
    assert opens.value == 7
    with pytest.raises(OSError, match="Tif2016"):
        mf.first_error(m)
    assert {r.SourceFile: r.size for r in m.collect()}["Tif2010.csv"] == 11


def test_changes_between_manifests(spark, tmp_path):
    for name in ("a 2020.csv", "b2021.csv", "c2022.csv"):
        write(f"{tmp_path}/{name}", "A\n1\n")
    before = mf.build(spark, str(tmp_path), whole=True)
    assert {r.change for r in mf.changes(None, before).collect()} == {"new"}
    assert mf.changes(before, mf.build(spark, str(tmp_path), whole=True)).count() == 0
    write(f"{tmp_path}/a 2020.csv", "A\n2\n")  # same size: told by the text
    os.remove(f"{tmp_path}/b2021.csv")
    write(f"{tmp_path}/d2023.csv", "A\n3\n")
    now = mf.build(spark, str(tmp_path), whole=True)
    assert {r.SourceFile: r.change for r in mf.changes(before, now).collect()} == {
        "a 2020.csv": "changed", "b2021.csv": "gone", "d2023.csv": "new"}


# ------------------------------------------------------- incremental gather ---
def rows_of(gathered):
    return sorted((r.A, r.FileYear, r.Gather) for r in gathered.rows.collect())


def test_gather_replaces_changed_years_only(spark, tmp_path):
    files, store = f"{tmp_path}/files", f"{tmp_path}/store"
    for y in (2019, 2020, 2021):
        write(f"{files}/Tif{y}.csv", f"A\n{y}a\n")
    write(f"{files}/Tif2020 part 2.csv", "A\n2020b\n")
    first = sources.gather_years(spark, files, "Tif*.csv", store, whole=True)
    assert (first.years, first.gone, first.number) == ([2019, 2020, 2021], [], 1)
    kept = [f for f in os.listdir(f"{store}/rows/FileYear=2019") if f.startswith("part")]
    write(f"{files}/Tif2020 part 2.csv", "B,A\nx,2020c\n")  # other columns too
    write(f"{files}/Tif2022.csv", "A\n2022a\n")
    os.remove(f"{files}/Tif2021.csv")
    again = sources.gather_years(spark, files, "Tif*.csv", store, whole=True)
    assert (again.years, again.gone, again.number) == ([2020, 2022], [2021], 2)
    assert rows_of(again) == [("2019a", 2019, 1), ("2020a", 2020, 2), ("2020c", 2020, 2), ("2022a", 2022, 2)]
    assert kept == [f for f in os.listdir(f"{store}/rows/FileYear=2019") if f.startswith("part")]
    nothing = sources.gather_years(spark, files, "Tif*.csv", store, whole=True)
    assert (nothing.years, nothing.gone) == ([], []) and rows_of(nothing) == rows_of(again)


def test_failed_gather_leaves_the_store(spark, tmp_path):
    files, store = f"{tmp_path}/files", f"{tmp_path}/store"
    write(f"{files}/Tif2020.csv", "A\n1\n")
    sources.gather_years(spark, files, "*.csv", store)
    (tmp_path / "files" / "Tif2021.csv").write_bytes(b"\xff\xfeA\x00")
    with pytest.raises(OSError, match="Tif2021"):
        sources.gather_years(spark, files, "*.csv", store)
    assert os.listdir(f"{store}/manifest") == ["version=1"]
    write(f"{files}/Tif2021.csv", "A\n2\n")
    assert rows_of(sources.gather_years(spark, files, "*.csv", store)) == [("1", 2020, 1), ("2", 2021, 2)]
    # All rows of a year filtered away: its old rows go too.
    write(f"{files}/Tif2020.csv", "A\nnone\n")
    left = sources.gather_years(spark, files, "*.csv", store, transform=lambda df: df.where("A <> 'none'"))
    assert rows_of(left) == [("2", 2021, 2)]
    write(f"{files}/nameless.csv", "A\n2\n")
    with pytest.raises(ValueError, match="no year"):
        sources.gather_years(spark, files, "*.csv", store)


def test_summaries_follow_the_gather(spark, tmp_path):
    files, store, partials = f"{tmp_path}/files", f"{tmp_path}/store", f"{tmp_path}/partials"
    seen = []

    def shares(rows):
        seen.append(sorted(r[0] for r in rows.select("FileYear").distinct().collect()))
        return rows.select("FileYear", "Gather", "SourceFile", "K", F.col("V").cast("double").alias("V"))

    def refresh():
        gathered = sources.gather_years(spark, files, "*.csv", store, whole=True)
        got = summaries.refresh(gathered, partials, shares, ["K"], ["V"])
        whole = gathered.rows.groupBy("K").agg(F.sum(F.col("V").cast("double")).alias("V"))
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, whole.collect()))
        return {r.K: r.V for r in got.collect()}

    for y in (2019, 2020, 2021):
        write(f"{files}/T{y}.csv", f"K,V\na,{y}\nb,1\n")
    assert refresh() == {"a": 6060.0, "b": 3.0}
    write(f"{files}/T2020.csv", "K,V\na,5\n")
    write(f"{files}/T2022.csv", "K,V\nc,7\n")
    os.remove(f"{files}/T2021.csv")
    assert refresh() == {"a": 2024.0, "b": 1.0, "c": 7.0}
    assert seen == [[2019, 2020, 2021], [2020, 2022]]


# ----------------------------------------------------------- rejected lines ---
def test_kept_and_rejected_are_all_lines(spark, tmp_path):
    write(f"{tmp_path}/in/P2020.csv", 'A,B\n1,2\n1,2,3\n7\n"x,y",b\n9,9,\n"q,r",b,c\n')
    write(f"{tmp_path}/in/P2021.csv", "B,A,C\n1,2,3\n1,2,3,4,5\n")
    lines = sources.read_many(spark, f"{tmp_path}/in", "P*.csv", keep_lines=True)
    kept, rejected = sources.stage_lines(lines, f"{tmp_path}/out")
    assert sorted((r.A, r.B, r.SourceFile) for r in kept.collect()) == [
        ("1", "2", "P2020.csv"), ("2", "1", "P2021.csv"), ("7", None, "P2020.csv"), ("x,y", "b", "P2020.csv")]
    assert sorted(map(tuple, rejected.collect())) == [
        ("P2020.csv", '"q,r",b,c', 3), ("P2020.csv", "1,2,3", 3), ("P2020.csv", "9,9,", 3), ("P2021.csv", "1,2,3,4,5", 5)]
    assert "_line" not in kept.columns and kept.count() + rejected.count() == 8
    skipped = sources.read_many(spark, f"{tmp_path}/in", "P*.csv", skip_bad_lines=True)
    assert sorted(map(str, skipped.select(kept.columns).collect())) == sorted(map(str, kept.collect()))


# --------------------------------------------------------- keys and mappings ---
def test_key_tables(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "z"), (None, 1, "n"), ("b", None, "m"), ("a", 1, "x2")],
                               "k string, n int, v string")
    listed = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), (None, 1), ("q", 9)], "k string, n int")
    values = lambda d: sorted(r.v for r in d.collect())
    assert values(keys.keep_keys(df, listed, ["k", "n"])) == ["x", "x2"]
    assert values(keys.drop_keys(df, listed, ["k", "n"])) == ["m", "n", "y", "z"]
    assert values(keys.keep_keys(df, listed, ["k", "n"], null_matches=True)) == ["m", "n", "x", "x2"]
    assert values(keys.drop_keys(df, listed, ["k", "n"], null_matches=True)) == ["y", "z"]
    assert values(keys.drop_keys(df, listed.limit(0), ["k", "n"])) == values(df) and values(keys.keep_keys(df, listed.limit(0), ["k"])) == []
    assert keys.keep_keys(df, listed.withColumn("v", F.lit(1)), ["n"]).columns == ["k", "n", "v"]
    with pytest.raises(ValueError, match="key columns"):
        keys.keep_keys(df, listed, ["w"])


def test_exclusions_as_literals_and_as_table(spark):
    long = spark.createDataFrame([(f, m, 1.0) for f in ("General", "Fire", "Road", None) for m in ("Gahanna", "Columbus", "Other", None)],
                                 "Fund string, Municipality string, v double")
    table = keys.pairs_table(spark, TOWNSHIP.excluded_pairs, "Fund", "Municipality")
    assert sorted(map(str, pl.exclude_pairs(long, TOWNSHIP).collect())) == sorted(
        map(str, keys.drop_keys(long, table, ["Fund", "Municipality"]).collect()))


def test_mapping_tables(spark):
    df = spark.createDataFrame([("1", 10), ("2", 20), ("2", 21), ("9", 90), (None, 0), ("5", 50)], "code string, v int")
    m = spark.createDataFrame([("1", "one"), ("2", "two"), ("2", "two"), ("5", None), (None, "null")], "code string, label string")
    got = sorted((r.v, r.label) for r in keys.map_codes(df, m, ["code"], "label", other="Other").collect())
    assert got == [(0, "Other"), (10, "one"), (20, "two"), (21, "two"), (50, None), (90, "Other")]
    assert {r.v: r.L for r in keys.map_codes(df, m, ["code"], "label", out="L", null_matches=True).collect()} == {
        0: "null", 10: "one", 20: "two", 21: "two", 50: None, 90: None}
    for bad in ([("2", "zwei")], [("2", None)]):
        with pytest.raises(Exception, match="several values for code 2"):
            keys.map_codes(df, m.union(spark.createDataFrame(bad, m.schema)), ["code"], "label").collect()
    from fundflow.functions import labels
    table = keys.mapping_table(spark, TOWNSHIP.district_labels, "d", "label")
    d = spark.createDataFrame([(c,) for cs in TOWNSHIP.district_labels.values() for c in cs] + [("zz",), (None,)], "d string")
    assert sorted(map(str, d.select("d", labels.label_by_set("d", TOWNSHIP.district_labels, "Other").alias("label")).collect())) == \
        sorted(map(str, keys.map_codes(d, table, ["d"], "label", other="Other").collect()))


def test_discovered_names(spark):
    df = spark.createDataFrame([("p", 2022, 1.0), ("p", 2024, 2.0), ("q", 2022, 4.0), ("q", 2022, 5.0), ("r", None, 9.0)],
                               "id string, y int, v double")
    wide = reshape.to_wide(df, ["id"], "y", ["v"])
    assert wide.columns == ["id", "v_2022", "v_2024"]
    assert sorted(map(tuple, wide.collect())) == [("p", 1.0, 2.0), ("q", 9.0, None), ("r", None, None)]
    assert sorted(map(str, wide.collect())) == sorted(map(str, reshape.to_wide(df, ["id"], "y", ["v"], [2022, 2024]).collect()))
    with pytest.raises(ValueError, match="more than 1 distinct"):
        reshape.to_wide(df, ["id"], "y", ["v"], limit=1)
    dates = spark.sql("SELECT 1 AS id, DATE '2020-01-05' AS d, 3 AS v")
    assert reshape.to_wide(dates, ["id"], "d", ["v"]).first()["v_2020-01-05"] == 3
    with pytest.raises(ValueError, match="id columns"):
        reshape.to_wide(df.withColumn("v_2022", F.lit(1)), ["id", "v_2022"], "y", ["v"])
    assert reshape.to_wide(df.limit(0), ["id"], "y", ["v"]).columns == ["id"]


# ------------------------------------------------------------------ profile ---
def test_profile_is_the_four_tables_of_one_scan(spark, tmp_path):
    raw = spark.createDataFrame(
        [("f1", "2020", "027-1", "1.5", "12"), ("f1", "2020.0", "171-2", "x", "y"), ("f2", "2021", "027-3", "-2", None),
         ("f2", "2021", None, None, "3"), ("f2", "bad", "999-1", "4", "10d")],
        "SourceFile string, TaxYear string, ParcelNumber string, ForegoneTownship string, Term string")
    rates = spark.createDataFrame([(2020, "027", "ResAgr"), (2021, "027", "ResAgr")], "TaxYear int, TaxDistrict string, PropertyClass string")
    types = {"ForegoneTownship": "double", "Term": "int", "TaxYear": "int"}
    found = pl.stage_profile(raw, lambda df: pl.abatement_fact(df, TOWNSHIP), types, "ForegoneTownship")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") == 1 and plan.count("Aggregate") == 1
    got = pl.profile_tables(sinks.write_stage(found, f"{tmp_path}/profile"), rates, types)
    same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.select(a.columns).collect()))
    assert same(got["rows_per_file"], sources.ingest_audit(raw))
    assert same(got["rate_coverage"], pl.rate_coverage(pl.abatement_fact(raw, TOWNSHIP), rates))
    assert same(got["bad_casts"], reshape.to_long(sources.bad_cast_counts(raw, types), [], list(types), "Column", "n_bad", value_type="bigint"))
    assert sorted(map(tuple, got["invalid_amounts"].collect())) == [("f1", 2, 1), ("f2", 3, 2)]
    empty = pl.profile_tables(pl.stage_profile(raw.limit(0), lambda df: pl.abatement_fact(df, TOWNSHIP), types, "ForegoneTownship"), rates, types)
    assert sorted(map(tuple, empty["bad_casts"].collect())) == [("ForegoneTownship", 0), ("TaxYear", 0), ("Term", 0)]
    with pytest.raises(ValueError, match="named like keys"):
        profile.profile(raw, ["Term"], {"Term": F.lit(True)})


# --------------------------------------------------------- bucketed reconcile ---
@needs_tables
def test_bucketed_sides_join_without_an_exchange(spark):
    left, right = sq.bucketed_sides(spark, SF, 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        on = ["ParcelNumber", "TaxYear"]
        for df in (*combine.reconcile(left, right, on), combine.reconcile_marked(left, right, on)):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "SortMergeJoin" in plan and "Bucketed: true" in plan
        plain = combine.reconcile_marked(sq.q._tif_parcels(spark, SF), sq.q._parcel_file_rows(spark, SF), on)
        assert "Exchange" in plain._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, combine.reconcile_marked(left, right, on).collect())) == sorted(map(str, plain.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


# ------------------------------------------------------------------- publish ---
def test_publish_shows_all_or_nothing(spark, tmp_path):
    out = f"{tmp_path}/report"
    assert sinks.published(spark, out) is None
    runs = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda x: (runs.add(1), x)[1], "string")
    df = spark.createDataFrame([("a", "L"), ("b", "L"), ("c", "M")], "key string, SheetLabel string").coalesce(1)
    first = sinks.publish(df.withColumn("key", seen("key")), out, "SheetLabel", "key")
    assert runs.value == 3 and sinks.published(spark, out) == first  # each row once
    folders = {r.Folder for r in spark.read.parquet(f"{first}/by_label").collect()}
    assert len(folders) == 3 and "M" in folders
    boom = df.withColumn("key", F.expr("IF(key = 'c', CAST(raise_error('boom') AS STRING), key)"))
    with pytest.raises(Exception, match="boom"):
        sinks.publish(boom, out, "SheetLabel", "key")
    assert sinks.published(spark, out) == first and spark.read.parquet(f"{first}/Total").count() == 3
    second = sinks.publish(df.where("key <> 'a'"), out, "SheetLabel")
    assert sinks.published(spark, out) == second and spark.read.parquet(f"{second}/Total").count() == 2
    third = sinks.publish(df, out, "SheetLabel")
    kept = {d for d in os.listdir(out) if d.startswith("version-")}
    assert kept == {os.path.basename(second), os.path.basename(third)}


# ---------------------------------------------------------------- exact money ---
def test_exact_text_to_decimal(spark):
    df = spark.createDataFrame([("0.1",), (" 12345678901234.56 ",), ("1e3",), (".5",), ("-7",), ("x",), (None,), ("12d",), ("9" * 30,)], "t string")
    got = [r[0] for r in df.select(exact.to_decimal("t")).collect()]
    assert got[:5] == [Decimal("0.10"), Decimal("12345678901234.56"), Decimal("1000.00"), Decimal("0.50"), Decimal("-7.00")]
    assert got[5:] == [None] * 4


def test_shares_add_up_to_the_amount(spark):
    rates = spark.createDataFrame([(1, 1.0, 1.0, 1.0), (2, 0.1, 0.2, 0.7), (3, 0.0, 0.0, 0.0), (4, 7.775525, 1.5, None)],
                                  "k int, g double, f double, r double")
    amounts = ["0.01", "0.02", "100.00", "-100.00", "12345.67", "99999999999999.99", None]
    fact = spark.createDataFrame([(k, Decimal(a) if a else None) for k in (1, 2, 3, 4, 9) for a in amounts], "k int, amount decimal(18,2)")
    funds = {"G": "g", "F": "f", "R": "r"}
    rows = exact.apportion_exact(fact, rates, ["k"], "amount", funds).collect()
    assert len(rows) == 35
    for r in rows:
        parts = [r.Lost_G, r.Lost_F, r.Lost_R]
        if r.amount is None or r.k in (3, 4, 9):
            assert parts == [None] * 3
            continue
        assert sum(parts) == r.amount
        w = {1: [1, 1, 1], 2: [1, 2, 7]}[r.k]
        assert all(abs(p - r.amount * x / sum(w)) < Decimal("0.01") for p, x in zip(parts, w, strict=True))
    one = {str(r.amount): (str(r.Lost_G), str(r.Lost_F), str(r.Lost_R)) for r in rows if r.k == 1}
    assert one["0.01"] == ("0.01", "0.00", "0.00") and one["0.02"] == ("0.01", "0.01", "0.00")
    assert one["-100.00"] == ("-33.34", "-33.33", "-33.33")
    gated = exact.apportion_exact(fact, rates, ["k"], "amount", funds, {"R": ("k", [2])}).where("k = 9 OR k = 1")
    assert {str(r.Lost_R) for r in gated.collect()} == {"0.00"}


@needs_tables
def test_exact_sums_do_not_depend_on_partitions(spark):
    fact = dv.tif_fact(spark, SF).withColumn("Amount", F.col("Amount").cast("decimal(18,2)"))
    app = exact.apportion_exact(fact, dv.rates(spark, SF), pl.KEY, "Amount", DRIVER.funds)
    total = lambda n: app.repartition(n).agg(*[exact.sum_exact(f"Lost_{f}").cast("string") for f in DRIVER.funds]).first()
    assert total(1) == total(7) == total(40)
    rated = app.where("Lost_Fire IS NOT NULL").agg(exact.sum_exact("Amount")).first()[0]
    assert sum(Decimal(x) for x in total(3)) == rated
