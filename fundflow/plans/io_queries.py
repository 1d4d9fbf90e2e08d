"""Registered source/sink queries.

Each exports a driver table to files in the shared scratch folder
(under ``spark.checkpoint.dir``), in the awkward shapes the sources must
handle, then reads them back through the engine's readers. The exports are
whole tables; the result is compared with SQL over the original table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundflow import sources
from fundflow.functions import clean
from fundflow.operators import reshape, sinks
from fundflow.plans import driver as dv
from fundflow.plans import pipeline as pl
from fundflow.plans import queries as q
from fundflow.session import scratch_path


def _csv_export(df: DataFrame, path: str, null_token: str = "NA", partition_by: str | None = None):
    w = df.write.mode("overwrite").option("header", True).option("nullValue", null_token)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.csv(path)


def q_ingest_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-1 / SET-1 / PRJ-5: two exports with different column order and one
    extra column, stacked by name, provenance kept."""
    root = scratch_path(spark, "ingest_by_name")
    c = dv.table(spark, sf, "customer")
    first = F.coalesce(F.col("c_nationkey") < 13, F.lit(False))     # a missing nation is in the second
    a = c.filter(first).select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    b = c.filter(~first).select(
        "c_mktsegment", "c_acctbal", F.concat(F.lit("C"), F.col("c_custkey")).alias("CustomerRef"),
        "c_name", "c_custkey", "c_nationkey")
    _csv_export(a, f"{root}/Customers_A.csv")
    _csv_export(b, f"{root}/Customers_B.csv")
    raw = sources.read_many(spark, root, "*.csv", source="dir")
    return sources.typed(raw, {"c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "double"})


_SUPPLIER_TYPES = {"s_suppkey": "bigint", "s_nationkey": "int", "s_acctbal": "double", "SinceYear": "int"}


def _supplier_text(spark: SparkSession, sf: str) -> DataFrame:
    """Supplier exported with 'NA' tokens and text years ('2014.0', junk), read back as text."""
    path = scratch_path(spark, "typed_scan")
    s = dv.table(spark, sf, "supplier")
    k = F.col("s_suppkey") % 4
    since = (F.when(k == 0, F.lit("2014.0")).when(k == 1, F.lit("x"))
             .otherwise((F.lit(1990) + F.col("s_suppkey") % 30).cast("string")))
    _csv_export(s.select("s_suppkey", "s_name", "s_nationkey",
                         # A Java suffix is no number: '12d' must not become 12.0.
                         F.when(k == 3, F.concat("s_suppkey", F.lit("d")))
                         .when(F.col("s_acctbal") >= 0, F.col("s_acctbal").cast("string")).alias("s_acctbal"),
                         since.alias("SinceYear")), path)
    cols = ["s_suppkey", "s_name", "s_nationkey", "s_acctbal", "SinceYear"]
    return sources.read_csv_text(spark, path, cols, null_token="NA", source=None)


def q_typed_scan(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-2 / SRC-3 / SCL-7: 'NA' tokens, text years like '2014.0' and junk, typed
    without errors."""
    return sources.typed(_supplier_text(spark, sf), _SUPPLIER_TYPES)


def q_bad_casts(spark: SparkSession, sf: str) -> DataFrame:
    """CMP-12: per column, values present as text that did not cast (one pass)."""
    counts = sources.bad_cast_counts(_supplier_text(spark, sf), _SUPPLIER_TYPES)
    return reshape.to_long(counts, [], list(_SUPPLIER_TYPES), "Column", "n_bad", value_type="bigint")


def malformed_export(spark: SparkSession, sf: str, name: str) -> str:
    """Customers as lines of text: one good line each (some short, some with commas inside quotes) and one with too
    many fields, whatever the extra ones hold: text, a missing-value token, nothing, several."""
    path = scratch_path(spark, name)
    c = dv.table(spark, sf, "customer")
    k = F.col("c_custkey")
    quoted = F.concat(F.lit('"'), "c_name", F.lit(', ""x"""'))
    good = F.when(k % 7 == 3, F.concat_ws(",", k, "c_name")).when(
        k % 7 == 4, F.concat_ws(",", k, quoted, "c_nationkey")).otherwise(
        F.concat_ws(",", k, "c_name", "c_nationkey"))
    # Every customer has a malformed line too.
    extra = (F.when(k % 5 == 0, F.lit("junk")).when(k % 5 == 1, F.lit("NA")).when(k % 5 == 2, F.lit(""))
             .when(k % 5 == 3, F.lit(",y")).otherwise(F.lit('"a,b",,')))
    bad = F.concat_ws(",", k, "c_name", "c_nationkey", extra)
    lines = c.select(good.alias("value")).unionByName(c.select(bad.alias("value")))
    # Raw lines: one text column named after the header line, written without quoting.
    (lines.select(F.col("value").alias("c_custkey,c_name,c_nationkey"))
     .write.mode("overwrite").option("header", True).option("sep", "|").option("quote", "").csv(path))
    return path


def q_bad_line_skip(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-4: lines with too many fields dropped, short lines kept with NULLs, commas inside quotes no separators."""
    path = malformed_export(spark, sf, "bad_line_skip")
    raw = sources.read_csv_text(spark, path, ["c_custkey", "c_name", "c_nationkey"],
                                skip_bad_lines=True, source=None)
    return sources.typed(raw, {"c_custkey": "bigint", "c_nationkey": "int"})


def _orders_by_year_export(spark: SparkSession, sf: str) -> str:
    """Yearly folders with a space (and a plus sign) in their names."""
    root = scratch_path(spark, "orders_by_year")
    o = dv.table(spark, sf, "orders").select(
        "o_orderkey", "o_totalprice",
        F.concat(F.lit("export + of "), F.year("o_orderdate").cast("string")).alias("Orders"))
    _csv_export(o, root, partition_by="Orders")
    return root


def q_year_from_file(spark: SparkSession, sf: str) -> DataFrame:
    """PRJ-6: the tax year is taken from each file's folder name, which has a space in it."""
    root = _orders_by_year_export(spark, sf)
    raw = sources.read_csv_text(spark, f"{root}/*/*.csv", ["o_orderkey", "o_totalprice"],
                                source="dir")
    return (sources.typed(raw, {"o_orderkey": "bigint", "o_totalprice": "double"})
            .withColumn("TaxYear", sources.year_from_name("SourceFile")))


def q_year_subset(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-6: only the folders named for the triennial years are opened."""
    root = _orders_by_year_export(spark, sf)
    raw = sources.read_many(spark, root, "*.csv", source="dir", years=q.TRIENNIAL_YEARS)
    return (sources.typed(raw, {"o_orderkey": "bigint", "o_totalprice": "double"})
            .withColumn("TaxYear", sources.year_from_name("SourceFile")))


def q_ingest_audit(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-8 / AGG-9: rows per source file, one aggregation."""
    df = q_year_from_file(spark, sf)
    return sources.ingest_audit(df).withColumn("TaxYear", sources.year_from_name("SourceFile"))


def q_ingest_tolerant(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-7: the yearly export with a broken and an undecodable file in it: the report of every file
    (rows, or why it gave none)."""
    root = _orders_by_year_export(spark, sf)
    o = dv.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    # Plain text is no gzip data, and UTF-16 text is no UTF-8.
    o.selectExpr("concat(o_orderkey, ',', o_totalprice) AS value").write.text(f"{root}/Orders=broken")
    _rename_parts(spark, f"{root}/Orders=broken", ".csv.gz")
    o.write.option("header", True).option("encoding", "UTF-16").csv(f"{root}/Orders=undecodable")
    _, report = sources.read_tolerant(spark, root, "part-*.csv*", source="dir")
    return report.selectExpr("SourceFile", "seen", "n_rows", "substring_index(error, ':', 1) AS error")


def _rename_parts(spark: SparkSession, folder: str, ending: str) -> None:
    """Give the part files of a folder another ending."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for part in fs.globStatus(path(f"{folder}/part-*")):
        fs.rename(part.getPath(), path(f"{part.getPath()}{ending}"))


def q_observed_write(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-4: row counts taken while the outputs are written, no second pass."""
    root = scratch_path(spark, "observed_write")
    o = dv.table(spark, sf, "orders")
    counts = []
    for name, df in (("orders", o), ("pending", o.where("o_orderstatus = 'P'")), ("none", o.where("o_orderkey < 0"))):
        observed, obs = sinks.observe_rows(df, name)
        sinks.write_csv(observed, f"{root}/{name}")
        counts.append((name, obs.get["rows"]))
    return spark.createDataFrame(counts, "Output string, n_rows bigint")


def q_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-1: header CSV written (overwrite) and read back typed."""
    path = scratch_path(spark, "csv_roundtrip")
    part = dv.table(spark, sf, "part")
    sinks.write_csv(part, path, null_token="NA")
    sinks.write_csv(part, path, null_token="NA")           # second write overwrites the first
    raw = sources.read_csv_text(spark, path, part.columns, source=None)
    return sources.typed(raw, {"p_partkey": "bigint", "p_size": "int", "p_retailprice": "double"})


def q_split_report(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-2 / SNK-3: combined loss written as one folder per municipality
    in a single pass, read back."""
    path = scratch_path(spark, "split_report")
    combined = pl.split_labels(q.q_combined_loss(spark, sf), "Municipality", "Combined_")
    written = sinks.write_split(combined, "SheetLabel", path, key_col="Municipality")
    return spark.read.schema(written.schema).parquet(path)


def q_split_collisions(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-2 / SNK-3: districts whose cut labels are equal keep folders of their own."""
    path = scratch_path(spark, "split_collisions")
    s = dv.table(spark, sf, "supplier").selectExpr(
        "s_suppkey", "CASE WHEN s_nationkey < 20 THEN concat('Jefferson Unincorporated Area ', s_nationkey) "
        "ELSE concat('District ', s_nationkey) END AS Area")
    written = sinks.write_split(pl.split_labels(s, "Area", "Combined_"), "SheetLabel", path, key_col="Area")
    return spark.read.schema(written.schema).parquet(path)


def q_stage_codes(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-5: a stage table partitioned by a padded code, read back with the code as text."""
    s = dv.table(spark, sf, "supplier").select(
        clean.zero_pad("s_nationkey", 3).alias("TaxDistrict"), "s_suppkey", "s_name")
    return sinks.write_stage(s, scratch_path(spark, "stage_codes"), ["TaxDistrict"])


def q_stage_handoff(spark: SparkSession, sf: str) -> DataFrame:
    """SRC-5: each loss summary materialised as a stage table in the shared
    folder (lineage cut), the combine reads the stage tables back."""
    root = scratch_path(spark, "stages")
    tif = sinks.write_stage(q._tif_long(spark, sf), f"{root}/tif_by_fund")
    abate = sinks.write_stage(q._abate_long(spark, sf), f"{root}/abatement_by_fund")
    return q._round(pl.combined_loss(tif, abate), 2)


IO_QUERIES = {
    "stage_handoff": q_stage_handoff,
    "ingest_by_name": q_ingest_by_name,
    "typed_scan": q_typed_scan,
    "bad_casts": q_bad_casts,
    "bad_line_skip": q_bad_line_skip,
    "year_from_file": q_year_from_file,
    "year_subset": q_year_subset,
    "ingest_audit": q_ingest_audit,
    "ingest_tolerant": q_ingest_tolerant,
    "observed_write": q_observed_write,
    "csv_roundtrip": q_csv_roundtrip,
    "split_report": q_split_report,
    "split_collisions": q_split_collisions,
    "stage_codes": q_stage_codes,
}
