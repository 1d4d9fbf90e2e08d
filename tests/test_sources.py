"""Readers: by-name stacking, malformed lines, NA tokens, file-name years."""

import os
import tempfile

import pytest

from pyspark.sql import functions as F

from fundflow import sources


def write(path, text):
    with open(path, "w") as fh:
        fh.write(text)


def test_read_many_aligns_by_name(spark):
    d = tempfile.mkdtemp(prefix="ff-many-")
    write(os.path.join(d, "Parcel2021.csv"), "PARCEL ID,TIFMLND,TIFMBLD\n027-1,10,20\n")
    write(os.path.join(d, "Parcel2022.csv"), "TIFMBLD,EXTRA,PARCEL ID,TIFMLND\n21,e,027-2,11\n")
    write(os.path.join(d, "notes.txt"), "ignore me\n")
    df = sources.read_many(spark, d, "Parcel20*.csv")
    rows = {r["PARCEL ID"]: r for r in df.collect()}
    assert set(rows) == {"027-1", "027-2"}
    assert rows["027-1"]["TIFMLND"] == "10" and rows["027-1"]["EXTRA"] is None
    assert rows["027-2"]["TIFMLND"] == "11" and rows["027-2"]["TIFMBLD"] == "21"
    assert rows["027-2"]["EXTRA"] == "e"
    assert rows["027-1"]["SourceFile"] == "Parcel2021.csv"
    years = {r.SourceFile: r.y for r in df.select("SourceFile", sources.year_from_name("SourceFile").alias("y")).collect()}
    assert years == {"Parcel2021.csv": 2021, "Parcel2022.csv": 2022}


def test_skip_bad_lines(spark):
    d = tempfile.mkdtemp(prefix="ff-bad-")
    p = os.path.join(d, "Parcel2023.csv")
    write(p, 'A,B,C,D\n1,2,3,4\n1,2,3,4,5\n7,8\n"x,y",b,c,d\n9,9,9,9,\n'
             '5,5,5,5,NA\n6,6,6,6,,y\n"q ""r, s""",b,c\n"q ""r, s""",b,c,d,e\n')
    df = sources.read_csv_text(spark, p, ["A", "B", "C", "D"], skip_bad_lines=True, source=None)
    rows = sorted(df.collect(), key=lambda r: r.A)
    # As pandas: whatever an extra field holds, the line goes; short lines stay.
    assert [tuple(r) for r in rows] == [("1", "2", "3", "4"), ("7", "8", None, None),
                                        ('q "r, s"', "b", "c", None), ("x,y", "b", "c", "d")]


def test_file_names_with_spaces_and_glob_characters(spark):
    d = tempfile.mkdtemp(prefix="ff-names-")
    write(os.path.join(d, "Parcel 2014.csv"), "A\n1\n")
    write(os.path.join(d, "Parcel+2015 [1].csv"), "A,B\n2,x\n")
    write(os.path.join(d, "Parcel 20%16{a}.csv"), "A\n3\n")
    df = sources.read_many(spark, d, "Parcel*.csv").select("A", "SourceFile", sources.year_from_name("SourceFile").alias("y"))
    assert sorted(tuple(r) for r in df.collect()) == [
        ("1", "Parcel 2014.csv", 2014), ("2", "Parcel+2015 [1].csv", 2015), ("3", "Parcel 20%16{a}.csv", None)]
    assert [r.A for r in sources.read_many(spark, d, "Parcel*.csv", years=[2015]).collect()] == ["2"]


def test_quoted_line_breaks(spark):
    d = tempfile.mkdtemp(prefix="ff-lines-")
    write(os.path.join(d, "t.csv"), 'A,B\n"x\ny",2\nz,3\n')
    rows = sources.read_many(spark, d, "t.csv", multiline=True).select("A", "B").collect()
    assert sorted(map(tuple, rows)) == [("x\ny", "2"), ("z", "3")]


def test_long_headers_are_read_whole(spark):
    d = tempfile.mkdtemp(prefix="ff-long-")
    names = [f"column_number_{i}_of_a_very_wide_export" for i in range(3000)]
    write(os.path.join(d, "w.csv"), ",".join(names) + "\n" + ",".join("1" * 3000) + "\n")
    heads = sources.file_heads(sources.file_table(spark, d, "*.csv")).first()
    assert heads.header.split(",") == names and heads.error is None


def test_broken_files_fail_or_are_reported(spark):
    import gzip
    d = tempfile.mkdtemp(prefix="ff-broken-")
    write(os.path.join(d, "a 2020.csv"), "A\n1\n2\n")
    with gzip.open(os.path.join(d, "b.csv.gz"), "wt") as fh:
        fh.write("A\n" + "3\n" * 50_000)
    whole = open(os.path.join(d, "b.csv.gz"), "rb").read()
    with gzip.open(os.path.join(d, "c.csv.gz"), "wt") as fh:
        fh.write("A\n9\n")
    open(os.path.join(d, "d.csv.gz"), "wb").write(whole[:len(whole) // 2])
    open(os.path.join(d, "e.csv"), "wb").write(b"A\n1\n\xff\xfe\n")
    open(os.path.join(d, "f.csv"), "wb").write(b"\xff\xfeA\x00")
    open(os.path.join(d, "g.csv"), "wb").write(b"\n1\n")
    with pytest.raises(OSError, match="cannot read"):
        sources.read_many(spark, d, "*.csv*")
    df, report = sources.read_tolerant(spark, d, "*.csv*")
    got = {r.SourceFile: (r.seen, r.n_rows, (r.error or "").split(":")[0]) for r in report.collect()}
    assert {k: v[:2] for k, v in got.items()} == {
        "a 2020.csv": (True, 2), "b.csv.gz": (True, 50_000), "c.csv.gz": (True, 1), "d.csv.gz": (False, 0),
        "e.csv": (False, 0), "f.csv": (False, 0), "g.csv": (False, 0)}
    assert got["e.csv"][2] == got["f.csv"][2] == "UnicodeDecodeError" and got["d.csv.gz"][2] and got["g.csv"][2] == "EmptyFile"
    assert df.count() == 50_003


def test_na_token_and_typed(spark):
    d = tempfile.mkdtemp(prefix="ff-na-")
    p = os.path.join(d, "t.csv")
    write(p, 'TaxYear,Amount,Name\n"2014.0",NA,"NA"\n2015,12.5,\n x ,n/a,ok\n')
    raw = sources.read_csv_text(spark, p, ["TaxYear", "Amount", "Name"], source=None)
    t = sources.typed(raw, {"TaxYear": "int", "Amount": "double"})
    assert [tuple(r) for r in t.collect()] == [(2014, None, None), (2015, 12.5, None), (None, None, "ok")]
    bad = sources.bad_cast_counts(raw, {"TaxYear": "int", "Amount": "double"}).first()
    assert (bad.TaxYear, bad.Amount) == (1, 1)


def test_ingest_audit_and_missing(spark):
    d = tempfile.mkdtemp(prefix="ff-audit-")
    write(os.path.join(d, "Tif2020.csv"), "A\n1\n2\n")
    write(os.path.join(d, "Tif2021.csv"), "A\n3\n")
    df = sources.read_many(spark, d, "Tif*.csv")
    audit = {r.SourceFile: r.n_rows for r in sources.ingest_audit(df).collect()}
    assert audit == {"Tif2020.csv": 2, "Tif2021.csv": 1}
    expected = spark.createDataFrame([("Tif2020.csv",), ("Tif2021.csv",), ("Tif2022.csv",)], "SourceFile string")
    assert [r.SourceFile for r in sources.missing_sources(expected, df).collect()] == ["Tif2022.csv"]


def test_parquet_many_skips_corrupt_file(spark):
    d = tempfile.mkdtemp(prefix="ff-pq-")
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string").coalesce(1) \
        .write.parquet(os.path.join(d, "Tif2021.parquet"))
    spark.createDataFrame([(3, "c", 1.5)], "k int, v string, x double").coalesce(1) \
        .write.parquet(os.path.join(d, "Tif2022.parquet"))
    bad_dir = os.path.join(d, "Tif2023.parquet")
    os.makedirs(bad_dir)
    write(os.path.join(bad_dir, "part-0.parquet"), "this is not parquet")
    paths = [os.path.join(d, f"Tif{y}.parquet") for y in (2021, 2022, 2023)]
    with pytest.raises(Exception):
        sources.read_parquet_many(spark, paths, source="dir").collect()
    df = sources.read_parquet_many(spark, paths, source="dir", skip_unreadable=True)
    assert sorted((r.k, r.x) for r in df.collect()) == [(1, None), (2, None), (3, 1.5)]
    seen = sources.ingest_audit(df)
    expected = spark.createDataFrame([(os.path.basename(p),) for p in paths], "SourceFile string")
    assert [r.SourceFile for r in sources.missing_sources(expected, seen).collect()] == ["Tif2023.parquet"]


def test_observe_rows_counts_during_write(spark):
    from fundflow.operators import sinks
    d = tempfile.mkdtemp(prefix="ff-obs-")
    df, obs = sinks.observe_rows(spark.range(123), "n")
    sinks.write_csv(df, os.path.join(d, "out"))
    assert obs.get["rows"] == 123


def test_year_subset_opens_only_named_years(spark):
    d = tempfile.mkdtemp(prefix="ff-years-")
    for y in (2014, 2015, 2017, 2020):
        write(os.path.join(d, f"TifDetails-TY{y}-2025-05-22.csv"), f"TaxYear,V\n{y},1\n")
    write(os.path.join(d, "TifDetails-TY2016-2025-05-22.csv"), "garbage\x00\x01")
    df = sources.read_many(spark, d, "TifDetails*.csv", years=[2014, 2017, 2020])
    assert sorted(int(r.TaxYear) for r in df.collect()) == [2014, 2017, 2020]
    assert sources.files_for_years(["/a/Parcel2019.csv", "/a/x.csv", "/a/Parcel2020.csv"], [2020]) == \
        ["/a/Parcel2020.csv"]


def test_typed_number_and_schemas(spark):
    df = spark.createDataFrame([("$1,234.50", "12", "x"), ("n/a", "7.0", "y")],
                               "DivertedLibrary string, TaxYear string, Township string")
    types = sources.schemas.present(sources.TIF_TYPES, df.columns)
    assert types == {"DivertedLibrary": "number", "TaxYear": "int"}
    rows = sources.typed(df, types).collect()
    assert [(r.DivertedLibrary, r.TaxYear, r.Township) for r in rows] == [(1234.5, 12, "x"), (None, 7, "y")]
    bad = sources.bad_cast_counts(df, types).first()
    assert (bad.DivertedLibrary, bad.TaxYear) == (1, 0)
