"""Oracle SQL for the source/sink queries: the same rows computed from the
original tables (what a correct export + read-back must give)."""

from __future__ import annotations

from fundflow.plans.oracle import COMBINED, pad, year

_Y = year("o_orderdate")

IO_ORACLE_SQL: dict[str, str] = {
    "ingest_by_name": """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
       CASE WHEN c_nationkey < 13 THEN NULL ELSE 'C' || CAST(c_custkey AS VARCHAR) END AS CustomerRef,
       CASE WHEN c_nationkey < 13 THEN 'Customers_A.csv' ELSE 'Customers_B.csv' END AS SourceFile
FROM customer""",
    "typed_scan": """
SELECT s_suppkey, s_name, s_nationkey,
       CASE WHEN s_suppkey % 4 <> 3 AND s_acctbal >= 0 THEN s_acctbal END AS s_acctbal,
       CASE s_suppkey % 4 WHEN 0 THEN 2014 WHEN 1 THEN NULL
            ELSE CAST(1990 + s_suppkey % 30 AS INTEGER) END AS SinceYear
FROM supplier""",
    "bad_casts": """
SELECT 's_suppkey' AS "Column", CAST(0 AS BIGINT) AS n_bad
UNION ALL SELECT 's_nationkey', CAST(0 AS BIGINT)
UNION ALL SELECT 's_acctbal', count(*) FILTER (WHERE s_suppkey % 4 = 3) FROM supplier
UNION ALL SELECT 'SinceYear', count(*) FILTER (WHERE s_suppkey % 4 = 1) FROM supplier""",
    "bad_line_skip": """
SELECT c_custkey, c_name || CASE WHEN c_custkey % 7 = 4 THEN ', "x"' ELSE '' END AS c_name,
       CASE WHEN c_custkey % 7 = 3 THEN NULL ELSE c_nationkey END AS c_nationkey
FROM customer""",
    "year_from_file": f"""
SELECT o_orderkey, o_totalprice, 'Orders=export + of ' || CAST({_Y} AS VARCHAR) AS SourceFile, {_Y} AS TaxYear
FROM orders""",
    "ingest_audit": f"""
SELECT 'Orders=export + of ' || CAST({_Y} AS VARCHAR) AS SourceFile, count(*) AS n_rows, {_Y} AS TaxYear
FROM orders GROUP BY {_Y}""",
    "year_subset": f"""
SELECT o_orderkey, o_totalprice, 'Orders=export + of ' || CAST({_Y} AS VARCHAR) AS SourceFile, {_Y} AS TaxYear
FROM orders WHERE {_Y} IN (1995, 1998, 2001)""",
    "ingest_tolerant": f"""
SELECT 'Orders=export + of ' || CAST({_Y} AS VARCHAR) AS SourceFile, true AS seen, count(*) AS n_rows,
       CAST(NULL AS VARCHAR) AS error
FROM orders GROUP BY {_Y}
UNION ALL SELECT 'Orders=broken', false, 0, 'OSError'
UNION ALL SELECT 'Orders=undecodable', false, 0, 'UnicodeDecodeError'""",
    "observed_write": """
SELECT 'orders' AS Output, count(*) AS n_rows FROM orders
UNION ALL SELECT 'pending', count(*) FROM orders WHERE o_orderstatus = 'P'
UNION ALL SELECT 'none', 0""",
    "split_collisions": """
WITH s AS (
  SELECT s_suppkey, CASE WHEN s_nationkey < 20 THEN 'Jefferson Unincorporated Area ' || s_nationkey
                         ELSE 'District ' || s_nationkey END AS Area FROM supplier
), l AS (
  SELECT *, substr('Combined_' || replace(Area, ' ', ''), 1, 31) AS SheetLabel FROM s
)
SELECT s_suppkey, Area, SheetLabel,
       CASE WHEN (SELECT count(DISTINCT m.Area) FROM l m WHERE m.SheetLabel = l.SheetLabel) > 1
            THEN SheetLabel || '_' || substr(md5(Area), 1, 8) ELSE SheetLabel END AS Folder
FROM l""",
    "stage_codes": f"SELECT {pad('s_nationkey')} AS TaxDistrict, s_suppkey, s_name FROM supplier",
    "csv_roundtrip": "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
    "stage_handoff": COMBINED + """
SELECT TaxYear, Municipality, Fund, round(Taxes_Diverted_TIF, 2) AS Taxes_Diverted_TIF,
       round(Forgone_Revenue_Abatements, 2) AS Forgone_Revenue_Abatements,
       round(Total_Forgone_and_Diverted, 2) AS Total_Forgone_and_Diverted
FROM combined""",
    "split_report": COMBINED + """
SELECT TaxYear, Municipality, Fund, round(Taxes_Diverted_TIF, 2) AS Taxes_Diverted_TIF,
       round(Forgone_Revenue_Abatements, 2) AS Forgone_Revenue_Abatements,
       round(Total_Forgone_and_Diverted, 2) AS Total_Forgone_and_Diverted,
       substr('Combined_' || replace(Municipality, ' ', ''), 1, 31) AS SheetLabel,
       substr('Combined_' || replace(Municipality, ' ', ''), 1, 31) AS Folder
FROM combined""",
}
