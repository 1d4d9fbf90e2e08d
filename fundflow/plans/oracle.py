"""Oracle SQL (DuckDB dialect) for each registered query.

Written independently of the Spark code, at row level (no pre-aggregation),
over the driver's tables as views. Column names and roundings match the
Spark queries.
"""

from __future__ import annotations


def pad(expr: str, w: int = 3) -> str:
    s = f"CAST({expr} AS VARCHAR)"
    return f"(CASE WHEN length({s}) < {w} THEN lpad({s}, {w}, '0') ELSE {s} END)"


def muni(x: str) -> str:
    return (f"(CASE WHEN {x} IN ('000', '001', '002') THEN 'Core' WHEN {x} = '003' THEN 'B' "
            f"WHEN {x} = '024' THEN 'C' ELSE 'Other' END)")


def year(x: str) -> str:
    return f"CAST(year({x}) AS INTEGER)"


def split_id(x: str) -> str:
    s = pad(x, 9)
    return f"(substr({s}, 1, length({s}) - 6) || '-' || substr({s}, length({s}) - 5, 6))"


def norm(x: str) -> str:
    return f"replace(regexp_replace({x}, '-00$', ''), '-', '')"


RATES = f"""
rates_base AS (
  SELECT y.TaxYear, {pad('n.n_nationkey')} AS TaxDistrict, c.PropertyClass,
         1.0e0 + (n.n_nationkey % 3) * 0.31e0 AS GeneralRate,
         6.0e0 + ((7 * n.n_nationkey + y.TaxYear) % 40) / 10.0e0 AS FireRate,
         CASE WHEN n.n_nationkey < 10 THEN 0.25e0 + (y.TaxYear % 4) * 0.7e0 ELSE 0.0e0 END AS RoadRate
  FROM nation n
  CROSS JOIN (SELECT CAST(range AS INTEGER) AS TaxYear FROM range(1995, 2001)) y
  CROSS JOIN (VALUES ('A'), ('N')) c(PropertyClass)
  WHERE n.n_nationkey <> 24
),
rates_one AS (
  SELECT *, GeneralRate + FireRate + RoadRate AS TotalTownshipMillage FROM rates_base
),
rates AS (
  SELECT * FROM rates_one
  UNION ALL
  SELECT TaxYear, '024' AS TaxDistrict, PropertyClass, GeneralRate, FireRate, RoadRate,
         TotalTownshipMillage
  FROM rates_one WHERE TaxDistrict = '023'
)"""

TIF = f"""
tif AS (
  SELECT {year('l.l_shipdate')} AS TaxYear, {pad('s.s_nationkey')} AS TaxDistrict,
         CASE WHEN l.l_returnflag = 'A' THEN 'A' WHEN l.l_returnflag = 'N' THEN 'N' END AS PropertyClass,
         l.l_extendedprice AS Amount, 1 AS n_rows
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
tif_app AS (
  SELECT f.TaxYear, f.TaxDistrict, {muni('f.TaxDistrict')} AS Municipality,
         f.Amount * (r.GeneralRate / (r.GeneralRate + r.FireRate + r.RoadRate)) AS Lost_General,
         f.Amount * (r.FireRate / (r.GeneralRate + r.FireRate + r.RoadRate)) AS Lost_Fire,
         CASE WHEN f.TaxDistrict IN ('000', '001', '002')
              THEN f.Amount * (r.RoadRate / (r.GeneralRate + r.FireRate + r.RoadRate))
              ELSE 0.0e0 END AS Lost_Road
  FROM tif f LEFT JOIN rates r
    ON f.TaxYear = r.TaxYear AND f.TaxDistrict = r.TaxDistrict AND f.PropertyClass = r.PropertyClass
)"""

def _pid(cust: str) -> str:
    return f"{pad('c.c_nationkey')} || '-' || {pad(cust, 6)} || '-00'"


_PID = _pid("o.o_custkey")

ABATE = f"""
abate AS (
  SELECT {year('o.o_orderdate')} + 1 AS TaxYear,
         {pad(f"substr({_PID}, 1, 3)")} AS TaxDistrict,
         'A' AS PropertyClass, o.o_totalprice AS Amount
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
),
abate_app AS (
  SELECT f.TaxYear, f.TaxDistrict, {muni('f.TaxDistrict')} AS Municipality,
         f.Amount * (r.GeneralRate / r.TotalTownshipMillage) AS Lost_General,
         f.Amount * (r.FireRate / r.TotalTownshipMillage) AS Lost_Fire,
         CASE WHEN f.TaxDistrict IN ('000', '001', '002')
              THEN f.Amount * (r.RoadRate / r.TotalTownshipMillage) ELSE 0.0e0 END AS Lost_Road
  FROM abate f LEFT JOIN rates r
    ON f.TaxYear = r.TaxYear AND f.TaxDistrict = r.TaxDistrict AND f.PropertyClass = r.PropertyClass
)"""


def _wide_long(src: str, name: str, value: str) -> str:
    return f"""
{name}_wide AS (
  SELECT TaxYear, Municipality,
         coalesce(sum(Lost_General), 0.0e0) AS General,
         coalesce(sum(Lost_Fire), 0.0e0) AS Fire,
         coalesce(sum(Lost_Road), 0.0e0) AS Road
  FROM {src} GROUP BY TaxYear, Municipality
),
{name}_long AS (
  SELECT TaxYear, Municipality, 'General' AS Fund, General AS {value} FROM {name}_wide
  UNION ALL SELECT TaxYear, Municipality, 'Fire', Fire FROM {name}_wide
  UNION ALL SELECT TaxYear, Municipality, 'Road', Road FROM {name}_wide
            WHERE NOT (Municipality IN ('B', 'C'))
)"""


COMBINED = f"""WITH {RATES}, {TIF}, {ABATE},
{_wide_long('tif_app', 'tif', 'Taxes_Diverted_TIF')},
{_wide_long('abate_app', 'abate', 'Forgone_Revenue_Abatements')},
combined AS (
  SELECT coalesce(t.TaxYear, a.TaxYear) AS TaxYear,
         coalesce(t.Municipality, a.Municipality) AS Municipality,
         coalesce(t.Fund, a.Fund) AS Fund,
         coalesce(t.Taxes_Diverted_TIF, 0.0e0) AS Taxes_Diverted_TIF,
         coalesce(a.Forgone_Revenue_Abatements, 0.0e0) AS Forgone_Revenue_Abatements,
         coalesce(t.Taxes_Diverted_TIF, 0.0e0) + coalesce(a.Forgone_Revenue_Abatements, 0.0e0)
           AS Total_Forgone_and_Diverted
  FROM tif_long t FULL OUTER JOIN abate_long a
    ON t.TaxYear IS NOT DISTINCT FROM a.TaxYear
   AND t.Municipality IS NOT DISTINCT FROM a.Municipality
   AND t.Fund IS NOT DISTINCT FROM a.Fund
),
loss_long AS (
  SELECT TaxYear, Fund, Municipality, 'Taxes_Diverted_TIF' AS LossType, Taxes_Diverted_TIF AS Loss
  FROM combined
  UNION ALL
  SELECT TaxYear, Fund, Municipality, 'Forgone_Revenue_Abatements', Forgone_Revenue_Abatements
  FROM combined
),
series AS (
  SELECT TaxYear, Fund, Municipality, LossType, coalesce(sum(Loss), 0.0e0) AS Total_Loss
  FROM loss_long GROUP BY TaxYear, Fund, Municipality, LossType
)"""

_PER_DISTRICT = """
SELECT TaxYear, TaxDistrict, Municipality,
       round(coalesce(sum(Lost_General), 0.0e0), 2) AS General,
       round(coalesce(sum(Lost_Fire), 0.0e0), 2) AS Fire,
       round(coalesce(sum(Lost_Road), 0.0e0), 2) AS Road
FROM {src} GROUP BY TaxYear, TaxDistrict, Municipality"""

_ILLEGAL = r'[/\\?%*:|"<>]'

CHART = (COMBINED + """
SELECT TaxYear, Fund, Municipality, LossType, round(Total_Loss, 2) AS Total_Loss,
       Fund || CASE WHEN LossType = 'Taxes_Diverted_TIF'
                    THEN ' fund revenue diverted by TIFs by municipality'
                    ELSE ' fund revenue forgone from abatements by municipality' END AS Title,
       regexp_replace(Fund || CASE WHEN LossType = 'Taxes_Diverted_TIF'
                    THEN ' fund revenue diverted by TIFs by municipality'
                    ELSE ' fund revenue forgone from abatements by municipality' END,
                      '""" + _ILLEGAL + """', '', 'g') || '.png' AS FileName,
       CASE WHEN round(Total_Loss, 2) < 0 THEN '-$' ELSE '$' END
         || format('{:,.2f}', abs(round(Total_Loss, 2))) AS LossText
FROM series""")

_CROSS = f"""
SELECT {year('l.l_shipdate')} AS TaxYear, {muni(pad('s.s_nationkey'))} AS Municipality,
       round(coalesce(sum(coalesce(l_extendedprice, 0.0e0)
                        + coalesce(CASE WHEN l_returnflag <> 'R' THEN l_discount END, 0.0e0)
                        + coalesce(CASE WHEN l_linestatus <> 'O' THEN l_tax END, 0.0e0)
                        + coalesce(l_quantity, 0.0e0)), 0.0e0), 2) AS Total_County_Diverted
FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
GROUP BY 1, 2"""

_YEARS = [1996, 1997, 1998]


def _wide_sql() -> str:
    cols = []
    for m in ("TotalPrice", "UrgentPrice"):
        for y in _YEARS:
            cols.append(f"sum({m}) FILTER (WHERE TaxYear = {y}) AS {m}_{y}")
    outs = [f"round({m}_{y}, 2) AS {m}_{y}" for m in ("TotalPrice", "UrgentPrice") for y in _YEARS]
    for a, b in zip(_YEARS, _YEARS[1:]):
        # "+ 0.0" turns DuckDB's -0.0 (a small negative change rounded to zero)
        # into 0.0, as Spark's decimal-based bround returns; the value is unchanged.
        outs.append(f"CASE WHEN TotalPrice_{a} > 0 THEN round_even(100.0e0 * (TotalPrice_{b} - TotalPrice_{a})"
                    f" / TotalPrice_{a}, 1) + 0.0e0 END AS PctChange_Total_{str(a)[-2:]}_{str(b)[-2:]}")
    return f"""
WITH r AS (
  SELECT {_PID} AS ParcelNumber, {year('o.o_orderdate')} AS TaxYear,
         o.o_totalprice AS TotalPrice,
         CASE WHEN o.o_orderpriority = '1-URGENT' THEN o.o_totalprice END AS UrgentPrice
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE {year('o.o_orderdate')} IN ({', '.join(map(str, _YEARS))})
), w AS (
  SELECT ParcelNumber, {', '.join(cols)} FROM r GROUP BY ParcelNumber
)
SELECT ParcelNumber, {', '.join(outs)} FROM w"""


RECONCILE = f"""
WITH tifp AS (
  SELECT {norm(split_id('o_orderkey') + " || '-00'")} AS ParcelNumber,
         {year('o_orderdate')} AS TaxYear, o_totalprice AS DivertedTownship
  FROM orders
), parc AS (
  SELECT {norm(split_id('l_orderkey'))} AS ParcelNumber, {year('l_shipdate')} AS TaxYear,
         l_extendedprice AS TIFMLND, l_quantity AS TIFMBLD
  FROM lineitem
)"""

_TRI = "1995, 1998, 2001"
_MEANS = f"""
WITH m AS (
  SELECT {year('o_orderdate')} AS TaxYear, o_orderpriority, avg(o_totalprice) AS avg_price
  FROM orders
  WHERE {year('o_orderdate')} IN ({_TRI}) AND o_orderpriority IS NOT NULL
  GROUP BY 1, 2
), g AS (
  SELECT TaxYear, avg(avg_price) AS global_avg_price FROM m WHERE TaxYear IS NOT NULL GROUP BY 1
), t AS (
  SELECT TaxYear, global_avg_price,
         (global_avg_price / lag(global_avg_price) OVER (ORDER BY TaxYear) - 1.0e0) * 100.0e0 AS pct_change
  FROM g
)"""

_VALUE = f"""
WITH v AS (
  SELECT {year('l.l_shipdate')} AS TaxYear,
         0.35e0 * coalesce(CASE WHEN l_linestatus <> 'O' THEN l_extendedprice END,
                           l_extendedprice * (1.0e0 - l_discount)) AS taxable_value
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
  WHERE s.s_nationkey IN (0, 1, 2, 3, 24)
), t AS (
  SELECT TaxYear, coalesce(sum(taxable_value), 0.0e0) AS total_value FROM v GROUP BY 1
), p AS (
  SELECT TaxYear, total_value,
         (total_value / lag(total_value) OVER (ORDER BY TaxYear) - 1.0e0) * 100.0e0 AS pct_change
  FROM t
)"""

_WS = "' ' || chr(9) || chr(13) || chr(10) || chr(12) || chr(11)"
_PADDED = ("CASE c_custkey % 3 WHEN 0 THEN c_mktsegment || chr(9) "
           "WHEN 1 THEN '  ' || c_mktsegment || chr(10) ELSE c_mktsegment END")

_NUM = r"-?([0-9][0-9,]*[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"

_STUB = f"{pad('s.s_nationkey')} || '-' || {pad('s.s_suppkey', 6)}"

ORACLE_SQL: dict[str, str] = {
    "rate_left_join": f"""WITH {RATES}, {TIF}
SELECT f.TaxYear, f.PropertyClass, (r.GeneralRate IS NOT NULL) AS Matched,
       CAST(sum(f.n_rows) AS BIGINT) AS n_rows
FROM tif f LEFT JOIN rates r
  ON f.TaxYear = r.TaxYear AND f.TaxDistrict = r.TaxDistrict AND f.PropertyClass = r.PropertyClass
GROUP BY 1, 2, 3""",
    "apportion_sum_rates": f"WITH {RATES}, {TIF}" + _PER_DISTRICT.format(src="tif_app"),
    "apportion_total_rate": f"WITH {RATES}, {ABATE}" + _PER_DISTRICT.format(src="abate_app"),
    "fund_wide": f"""WITH {RATES}, {TIF}
SELECT TaxYear, Municipality,
       round(coalesce(sum(Lost_General), 0.0e0), 2) AS General,
       round(coalesce(sum(Lost_Fire), 0.0e0), 2) AS Fire,
       round(coalesce(sum(Lost_Road), 0.0e0), 2) AS Road
FROM tif_app GROUP BY TaxYear, Municipality""",
    "fund_long_filtered": f"""WITH {RATES}, {TIF}, {_wide_long('tif_app', 'tif', 'Taxes_Diverted_TIF')}
SELECT TaxYear, Municipality, Fund, round(Taxes_Diverted_TIF, 2) AS Taxes_Diverted_TIF FROM tif_long""",
    "abatement_long": f"""WITH {RATES}, {ABATE},
{_wide_long('abate_app', 'abate', 'Forgone_Revenue_Abatements')}
SELECT TaxYear, Municipality, Fund, round(Forgone_Revenue_Abatements, 2) AS Forgone_Revenue_Abatements
FROM abate_long""",
    "combined_loss": COMBINED + """
SELECT TaxYear, Municipality, Fund, round(Taxes_Diverted_TIF, 2) AS Taxes_Diverted_TIF,
       round(Forgone_Revenue_Abatements, 2) AS Forgone_Revenue_Abatements,
       round(Total_Forgone_and_Diverted, 2) AS Total_Forgone_and_Diverted
FROM combined""",
    "loss_series": COMBINED + """
SELECT TaxYear, Fund, Municipality, LossType, round(Total_Loss, 2) AS Total_Loss FROM series""",
    "chart_series": CHART,
    "chart_panel": COMBINED + """
SELECT TaxYear, Fund, Municipality, LossType, round(Total_Loss, 2) AS Total_Loss FROM series
WHERE Fund = 'Fire' AND LossType = 'Taxes_Diverted_TIF'""",
    "series_max": COMBINED + "\nSELECT round(max(Total_Loss), 2) AS y_max FROM series",
    "invalid_loss_rows": COMBINED + """
SELECT Fund, LossType, count(*) AS n_rows,
       count(*) FILTER (WHERE Loss IS NULL OR Loss < 0) AS n_invalid
FROM loss_long GROUP BY Fund, LossType""",
    "cross_column_total": _CROSS,
    "parcel_wide_change": _wide_sql(),
    "measure_long": """
SELECT o_orderkey, 'TotalPrice' AS Measure, o_totalprice AS Amount FROM orders
UNION ALL
SELECT o_orderkey, 'PendingPrice', CASE WHEN o_orderstatus = 'P' THEN o_totalprice END FROM orders""",
    "parcel_prepare": f"""
SELECT c_custkey, AccountBalance, Segment, ParcelRaw, {norm('ParcelRaw')} AS ParcelNumber
FROM (SELECT c_custkey, c_acctbal AS AccountBalance, c_mktsegment AS Segment,
             {pad('c_nationkey')} || '-' || {pad('c_custkey', 6)} || '-' || {pad('c_custkey % 3', 2)}
               AS ParcelRaw
      FROM customer)""",
    "reconcile_matched": RECONCILE + """
SELECT t.ParcelNumber, t.TaxYear, t.DivertedTownship, p.TIFMLND, p.TIFMBLD
FROM tifp t JOIN parc p
  ON t.ParcelNumber = p.ParcelNumber AND t.TaxYear = p.TaxYear""",
    "reconcile_unmatched": RECONCILE + """
SELECT t.* FROM tifp t
WHERE NOT EXISTS (SELECT 1 FROM parc p
                  WHERE p.ParcelNumber = t.ParcelNumber AND p.TaxYear = t.TaxYear)""",
    "mean_by_group": f"""
SELECT o_orderpriority, {year('o_orderdate')} AS TaxYear, round(avg(o_totalprice), 6) AS avg_price
FROM orders WHERE o_orderpriority IS NOT NULL AND o_orderdate IS NOT NULL
GROUP BY 1, 2""",
    "mean_of_means": _MEANS + "\nSELECT TaxYear, round(global_avg_price, 6) AS global_avg_price FROM g",
    "pct_change_trend": _MEANS + """
SELECT TaxYear, round(global_avg_price, 6) AS global_avg_price, round(pct_change, 6) AS pct_change FROM t""",
    "avg_pct_change": _MEANS + """
SELECT round(avg(pct_change), 6) AS avg_pct_change,
       format('{:.2f}', round(avg(pct_change), 6)) || '%' AS avg_pct_change_text
FROM t""",
    "yearly_value_total": _VALUE + "\nSELECT TaxYear, round(total_value, 2) AS total_value FROM p",
    "value_trend": _VALUE + """
SELECT TaxYear, round(total_value, 2) AS total_value, round(pct_change, 6) AS pct_change,
       round(total_value / 1e6, 6) AS total_value_millions
FROM p""",
    "trend_panels": _MEANS + ", " + _VALUE.split("WITH", 1)[1].replace("t AS (", "vt AS (").replace("FROM t", "FROM vt") + """
SELECT TaxYear AS Year, round(global_avg_price, 6) AS Value, round(pct_change, 6) AS PctChange,
       CASE WHEN pct_change IS NOT NULL THEN format('{:.2f}', round(pct_change, 6)) || '%' END AS PctText,
       'Global average rate by triennial year' AS Title, 'Global average rate by triennial year.png' AS FileName
FROM t
UNION ALL
SELECT TaxYear, round(total_value / 1e6, 6), round(pct_change, 6),
       CASE WHEN pct_change IS NOT NULL THEN format('{:.2f}', round(pct_change, 6)) || '%' END,
       'Taxable value of TIF parcels by year', 'Taxable value of TIF parcels by year.png'
FROM p""",
    "rate_coverage": f"""WITH {RATES}, {ABATE}
SELECT f.TaxYear, f.PropertyClass, count(*) AS n_rows, count(*) FILTER (WHERE r.TaxYear IS NULL) AS n_unmatched
FROM abate f LEFT JOIN rates r
  ON f.TaxYear = r.TaxYear AND f.TaxDistrict = r.TaxDistrict AND f.PropertyClass = r.PropertyClass
GROUP BY 1, 2""",
    "parcel_long": f"""
WITH r AS (
  SELECT {_PID} AS ParcelNumber, {year('o.o_orderdate')} AS TaxYear, round(o.o_totalprice, 2) AS TotalPrice,
         CASE WHEN o.o_orderpriority = '1-URGENT' THEN round(o.o_totalprice, 2) END AS UrgentPrice
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE c.c_nationkey = 5 AND {year('o.o_orderdate')} IN (1996, 1997, 1998)
)
SELECT ParcelNumber, TaxYear, 'TotalPrice' AS DivertedType, TotalPrice AS Amount FROM r
UNION ALL SELECT ParcelNumber, TaxYear, 'UrgentPrice', UrgentPrice FROM r""",
    "recode_class": """
SELECT CASE WHEN l_returnflag = 'A' THEN 'A' WHEN l_returnflag = 'N' THEN 'N' END AS PropertyClass,
       count(*) AS n_rows
FROM lineitem GROUP BY 1""",
    "label_district": f"""
SELECT {muni(pad('s_nationkey'))} AS Municipality, count(*) AS n_suppliers FROM supplier GROUP BY 1""",
    "code_normalise": f"""
SELECT s.s_suppkey, n.n_name, {pad('s.s_nationkey')} AS DistrictCode,
       {pad('s.s_suppkey * 37')} AS LongCode,
       {_STUB} AS ParcelStub,
       substr({_STUB}, 1, 3) AS PrefixCode,
       CAST(TRY_CAST(substr({_STUB}, 1, 3) AS DOUBLE) AS INTEGER) AS DistrictInt
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "multi_col_clean": """
SELECT c_custkey, AcctText, KeyText, OddText,
       TRY_CAST(replace(regexp_extract(AcctText, '""" + _NUM + """', 0), ',', '') AS DOUBLE) AS AcctValue,
       TRY_CAST(replace(regexp_extract(KeyText, '""" + _NUM + """', 0), ',', '') AS DOUBLE) AS KeyValue,
       CASE c_custkey % 5 WHEN 0 THEN 0.5e0 WHEN 1 THEN -(c_custkey % 10) / 10.0e0 WHEN 2 THEN c_custkey * 1000.0e0
            WHEN 3 THEN CAST(CAST(c_custkey AS VARCHAR) || '.5e-1' AS DOUBLE) END AS OddValue
FROM (SELECT c_custkey,
             '$' || format('{:,.2f}', c_acctbal) || ' USD' AS AcctText,
             '#' || format('{:,.0f}', CAST(c_custkey AS DOUBLE)) AS KeyText,
             CASE c_custkey % 5 WHEN 0 THEN '$.50' WHEN 1 THEN '-.' || (c_custkey % 10)
                  WHEN 2 THEN 'about ' || c_custkey || 'e3 each' WHEN 3 THEN '(' || c_custkey || '.5e-1%)'
                  ELSE 'none' END AS OddText
      FROM customer)""",
    "scope_filter": f"""
SELECT c_custkey, c_name, trim(({_PADDED}), {_WS}) AS Segment, 'with' AS Input
FROM customer WHERE trim(({_PADDED}), {_WS}) = 'BUILDING'
UNION ALL
SELECT c_custkey, c_name, NULL, 'without' FROM customer""",
    "alias_expand": f"""
SELECT s_suppkey, {pad('s_nationkey')} AS TaxDistrict FROM supplier
UNION ALL
SELECT s_suppkey, '024' AS TaxDistrict FROM supplier WHERE {pad('s_nationkey')} = '023'""",
    "distinct_dims": f"""
SELECT DISTINCT Dimension, Value FROM (
  SELECT 'priority' AS Dimension, o_orderpriority AS Value FROM orders
  UNION ALL SELECT 'segment', c_mktsegment FROM customer
  UNION ALL SELECT 'year', CAST({year('o_orderdate')} AS VARCHAR) FROM orders)""",
    "invalid_amounts": """
SELECT c_mktsegment, count(*) AS n_rows,
       count(*) FILTER (WHERE c_acctbal IS NULL OR c_acctbal < 0) AS n_invalid
FROM customer GROUP BY 1""",
    "preview_topn": f"""
SELECT o_orderkey, o_custkey, o_totalprice, {year('o_orderdate')} AS TaxYear
FROM orders ORDER BY o_custkey, o_orderkey LIMIT 6""",
    "safe_labels": """
SELECT 'supplier' AS Source, s.s_suppkey AS Id,
       substr('CountyTot_' || replace(n.n_name || ' ' || s.s_name, ' ', ''), 1, 31) AS Label
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
UNION ALL
SELECT 'part', p_partkey,
       regexp_replace(p_brand || '/' || p_type || ': ' || p_name || '?', '""" + _ILLEGAL + """', '', 'g') || '.png'
FROM part""",
}
