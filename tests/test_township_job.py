"""The end-to-end township job on files shaped like the study's yearly exports."""

import csv
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from fundflow.plans import township as job
from fundflow.session import scratch_path

from tests import township as tw


def write_csv(path, header, rows):
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(header)
        w.writerows(rows)


@pytest.fixture(scope="module")
def outputs(spark):
    base = tempfile.mkdtemp(prefix="ff-township-")
    ab_dir, tif_dir = os.path.join(base, "abatements"), os.path.join(base, "tifs")
    os.makedirs(ab_dir)
    os.makedirs(tif_dir)
    # Two abatement exports with different column order; plain rows of another township.
    early = [(str(y), p, "NA" if a is None else f"{a:.2f}", "JEFFERSON TWP")
             for y, p, a in tw.ABATEMENTS if y < 2020]
    late = [("JEFFERSON TWP ", f"{a:.2f}" if a is not None else "NA", p, str(y))
            for y, p, a in tw.ABATEMENTS if y >= 2020]
    write_csv(f"{ab_dir}/AbatementDetails-TY2014-2019.csv",
              ["TaxYear", "ParcelNumber", "ForegoneTownship", "Township"],
              early + [("2015", "999-000001-00", "5.00", "PLAIN TWP")])
    write_csv(f"{ab_dir}/AbatementDetails-TY2020-2024.csv",
              ["Township", "ForegoneTownship", "ParcelNumber", "TaxYear"], late)
    # TIF rows with parcel ids, county columns in one file only.
    tif_rows = [(y, t, d, r, a, f"{d}-00000{i}-00", "1.0", "n/a", "2.5")
                for i, (y, t, d, r, a) in enumerate(tw.TIFS)]
    write_csv(f"{tif_dir}/TifDetails-TY2022.csv",
              ["TaxYear", "Township", "TaxDistrict", "TaxRateType", "DivertedTownship",
               "ParcelNumber", "DivertedCountyGen", "DivertedZoo", "DivertedSenior"], tif_rows)
    # Files of trend years, with taxable values, for townships in and out of scope.
    values = ["TaxYear", "Township", "TaxDistrict", "TaxRateType", "DivertedTownship", "ParcelNumber",
              "AppraisedTotal", "AssessedTotal"]
    write_csv(f"{tif_dir}/TifDetails-TY2014.csv", values,
              [("2014", "PLAIN TWP", "170", "Res/Ag", "1", "p", "100", "1"), ("2014", "PLAIN TWP", "999", "Res/Ag", "1", "p", "7", "")])
    write_csv(f"{tif_dir}/TifDetails-TY2017.csv", values,
              [("2017", "PLAIN TWP", "027", "Res/Ag", "1", "p", "NA", "50"), ("2017", "PLAIN TWP ", "170", "Res/Ag", "1", "q", "100", "2")])
    rates_path = os.path.join(base, "Township_Rates.csv")
    write_csv(rates_path, tw.RATE_COLS, tw.rate_rows())
    parcel_dir = os.path.join(base, "parcels")
    os.makedirs(parcel_dir)
    with open(f"{parcel_dir}/Parcel2022.csv", "w") as fh:
        fh.write("PARCEL ID,TIFMLND,TIFMBLD,OTHER\n027-000000,100,200,x\n170-000002,1,2,y\n"
                 "170-000002,1,2,y,EXTRA\n999-999999,5,6,z\n170-000003,7\n")
    out = scratch_path(spark, "township_job")
    counts = job.run(spark, ab_dir, tif_dir, rates_path, out, parcel_dir=parcel_dir)
    return out, counts


def test_counts(outputs):
    _, counts = outputs
    assert counts["abatements_all_years"] == 36
    assert counts["tifs_all_years"] == 8          # PLAIN TWP row dropped
    assert counts["tif_by_fund"] == 15
    assert counts["abatements_by_fund"] == 55
    assert counts["combined"] == 65
    assert counts["chart_series"] == 2 * 65 and counts["quality/invalid_loss_rows"] == 6
    assert counts["trends/fire_rate"] == 4 and counts["parcel_comparison/wide"] == 2
    assert counts["quality/parcel_comparison_duplicates"] == 0


def test_stage_tables_lie_in_the_shared_folder_and_go(spark, outputs):
    out, _ = outputs
    from fundflow.session import checkpoint_root, local_path
    assert not os.path.exists(f"{out}/stage")
    shared = os.path.join(local_path(checkpoint_root(spark)), "fundflow")
    assert not [d for d in os.listdir(shared) if d.startswith("township-")]


def test_value_trend_reads_all_townships(spark, outputs):
    out, _ = outputs
    got = {int(r.TaxYear): float(r.total_tif_value)
           for r in spark.read.option("header", True).csv(f"{out}/trends/tif_value").collect()}
    # Rows of another township, in trend districts.
    assert got == {2014: pytest.approx(35.0), 2017: pytest.approx(0.35 * 150)}


def test_missing_or_broken_file_fails_the_job(spark, outputs, tmp_path):
    for name in ("ab", "tif"):
        (tmp_path / name).mkdir()
    (tmp_path / "ab" / "AbatementDetails 2015.csv").write_bytes(b"\xff\xfeT\x00")
    path = str(tmp_path / "rates.csv")
    write_csv(path, tw.RATE_COLS, tw.rate_rows())
    with pytest.raises(OSError, match="cannot read"):
        job.run(spark, str(tmp_path / "ab"), str(tmp_path / "tif"), path, scratch_path(spark, "broken"))


def test_split_labels_written(spark, outputs):
    out, _ = outputs
    labels = sorted(d for d in os.listdir(f"{out.replace('file:', '')}/combined/by_label") if "=" in d)
    assert "Folder=Combined_JeffersonUnincorporate" in labels
    assert "Folder=Combined_Gahanna" in labels
    g = spark.read.option("header", True).csv(f"{out}/combined/by_label/Folder=Combined_Gahanna")
    assert g.count() == 2 * 11 + 0  # General and Fire for 11 years (TIF rows add 2022 only)


def test_chart_series_and_county(spark, outputs):
    out, _ = outputs
    chart = spark.read.option("header", True).csv(f"{out}/chart_series")
    titles = {r.Title for r in chart.select("Title").distinct().collect()}
    assert "Road fund revenue diverted by TIFs by municipality" in titles
    assert "General fund revenue forgone from abatements by municipality" in titles
    county = spark.read.option("header", True).csv(f"{out}/county_totals/Total")
    got = {(r.TaxYear, r.Municipality): float(r.Total_County_Diverted) for r in county.collect()}
    # 2022 Gahanna: two TIF rows x (1.0 + NULL + 2.5)
    assert got[("2022", "Gahanna")] == pytest.approx(7.0)


def test_quality_tables(spark, outputs):
    out, _ = outputs
    cov = spark.read.option("header", True).csv(f"{out}/quality/rate_coverage")
    tif = {(r.TaxYear, r.PropertyClass): (int(r.n_rows), int(r.n_unmatched))
           for r in cov.filter(F.col("Source") == "TIF").collect()}
    # Exempt class (no rate), unknown district 999, and year 2025 find no rate.
    assert sum(u for _, u in tif.values()) == 3
    assert tif[("2025", "ResAgr")] == (1, 1)
    bad = {(r.Source, r.Column): int(r.n_bad)
           for r in spark.read.option("header", True).csv(f"{out}/quality/bad_casts").collect()}
    assert bad[("TIF", "DivertedTownship")] == 1
    assert bad[("Abatement", "ForegoneTownship")] == 0
    files = {(r.Source, r.SourceFile): int(r.n_rows)
             for r in spark.read.option("header", True).csv(f"{out}/quality/rows_per_file").collect()}
    assert files[("Abatement", "AbatementDetails-TY2014-2019.csv")] == 15
    assert files[("TIF", "TifDetails-TY2022.csv")] == 8


def test_side_analyses(spark, outputs):
    out, counts = outputs
    assert counts["matched"] == 2 and counts["unmatched"] == 6
    fire = {int(r.Year): r for r in spark.read.option("header", True).csv(f"{out}/trends/fire_rate").collect()}
    assert float(fire[2014].global_avg_fire_rate) == pytest.approx(10.4767145, abs=1e-9)
    assert float(fire[2017].pct_change_global_fire_rate) == pytest.approx(-14.081060431684001, abs=1e-9)
    avg = spark.read.option("header", True).csv(f"{out}/trends/fire_rate_avg").first()[0]
    assert float(avg) == pytest.approx(-7.530209987816487, abs=1e-9)
    wide = spark.read.option("header", True).csv(f"{out}/parcel_comparison/wide")
    assert "PctChange_Township_22_23" in wide.columns and "DivertedTownship_2024" in wide.columns
    assert wide.count() == 2


def test_duplicate_rate_keys_are_rejected(spark, tmp_path):
    rows = tw.rate_rows()
    path = str(tmp_path / "rates.csv")
    write_csv(path, tw.RATE_COLS, rows + rows[:1])
    empty = tmp_path / "none"
    empty.mkdir()
    with pytest.raises(ValueError, match="not unique"):
        job.run(spark, str(empty), str(empty), path, scratch_path(spark, "dup_rates"))


def test_tolerant_job_reports_files_and_missing_outputs(spark, tmp_path):
    ab, tif, out = tmp_path / "ab", tmp_path / "tif", scratch_path(spark, "tolerant")
    ab.mkdir()
    tif.mkdir()
    write_csv(f"{ab}/AbatementDetails 2020.csv", ["TaxYear", "ParcelNumber", "ForegoneTownship", "Township"],
              [("2020", "027-1-00", "5", "JEFFERSON TWP")])
    (ab / "AbatementDetails 2021.csv").write_bytes(b"\xff\xfeT\x00")
    write_csv(f"{tif}/TifDetails 2022.csv", ["TaxYear", "ParcelNumber", "DivertedTownship", "Township", "TaxDistrict", "TaxRateType"],
              [("2022", "027-2-00", "7", "JEFFERSON TWP", "027", "Res/Ag")])
    path = str(tmp_path / "rates.csv")
    write_csv(path, tw.RATE_COLS, tw.rate_rows())
    counts = job.run(spark, str(ab), str(tif), path, out, tolerant=True)
    read = lambda name: spark.read.option("header", True).csv(f"{out}/{name}").collect()
    files = {(r.Source, r.SourceFile): (r.seen, r.n_rows, (r.error or "").split(":")[0]) for r in read("quality/files")}
    assert files == {("Abatement", "AbatementDetails 2020.csv"): ("true", "1", ""),
                     ("Abatement", "AbatementDetails 2021.csv"): ("false", "0", "UnicodeDecodeError"),
                     ("TIF", "TifDetails 2022.csv"): ("true", "1", "")}
    why = {r.Output: r.Reason for r in read("quality/missing_outputs")}
    assert set(why) == {"trends/tif_value", "trends/tif_value_avg", "county_totals"} and "no readable files" in why["trends/tif_value"]
    assert counts["abatements_all_years"] == counts["tifs_all_years"] == 1 and "trends/tif_value" not in counts


def test_job_with_a_store_reads_changed_years_only(spark, tmp_path):
    ab, tif, store = tmp_path / "ab", tmp_path / "tif", f"{tmp_path}/store"
    ab.mkdir()
    tif.mkdir()
    row = lambda y, a: [(str(y), f"027-{y}-00", str(a), "JEFFERSON TWP")]
    head = ["TaxYear", "ParcelNumber", "ForegoneTownship", "Township"]
    for y in (2020, 2021):
        write_csv(f"{ab}/AbatementDetails {y}.csv", head, row(y, 5))
    write_csv(f"{tif}/TifDetails 2022.csv", ["TaxYear", "ParcelNumber", "DivertedTownship", "Township", "TaxDistrict", "TaxRateType"],
              [("2022", "027-2-00", "7", "JEFFERSON TWP", "027", "Res/Ag")])
    path = str(tmp_path / "rates.csv")
    write_csv(path, tw.RATE_COLS, tw.rate_rows())

    def totals(name, **more):
        out = scratch_path(spark, name)
        job.run(spark, str(ab), str(tif), path, out, **more)
        rows = spark.read.option("header", True).csv(f"{out}/combined/Total").collect()
        return sorted(tuple(r) for r in rows)

    totals("first", store=store)
    write_csv(f"{ab}/AbatementDetails 2021.csv", head, row(2021, 5000) + row(2021, 6))
    assert totals("second", store=store) == totals("plain")
    from fundflow.sources.incremental import GATHER, YEAR
    held = spark.read.parquet(f"{store}/abatements/rows").select(YEAR, GATHER).distinct().collect()
    assert {(r[0], r[1]) for r in held} == {(2020, 1), (2021, 2)}
