"""Oracle SQL of the stage queries, from the original tables."""

from __future__ import annotations

from fundflow.plans import oracle
from fundflow.plans.oracle import ABATE, COMBINED, RATES, muni, pad, year
from fundflow.plans.oracle_io import IO_ORACLE_SQL

_Y = year("o_orderdate")
_YEARS = range(1995, 2002)

_MARKED = oracle.RECONCILE + """
SELECT t.ParcelNumber, t.TaxYear, t.DivertedTownship, p.TIFMLND, p.TIFMBLD, p.ParcelNumber IS NOT NULL AS _matched
FROM tifp t LEFT JOIN parc p ON t.ParcelNumber = p.ParcelNumber AND t.TaxYear = p.TaxYear"""

_PROFILE = f"""WITH {RATES}, {ABATE}, r AS (
  SELECT {_Y} AS y, o_orderkey AS k, o_totalprice AS price FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)
SELECT 'file' AS "Check", 'Abatements' || y || '.csv' AS "Key", count(*) AS n_rows, CAST(NULL AS BIGINT) AS n_bad FROM r GROUP BY y
UNION ALL
SELECT 'rate', f.TaxYear || '/' || f.PropertyClass, count(*), count(*) FILTER (WHERE r.TaxYear IS NULL)
FROM abate f LEFT JOIN rates r
  ON f.TaxYear = r.TaxYear AND f.TaxDistrict = r.TaxDistrict AND f.PropertyClass = r.PropertyClass
GROUP BY f.TaxYear, f.PropertyClass
UNION ALL SELECT 'cast', 'Amount', NULL, count(*) FILTER (WHERE k % 5 = 0) FROM r
UNION ALL SELECT 'cast', 'Term', NULL, count(*) FILTER (WHERE k % 3 = 0) FROM r
UNION ALL SELECT 'invalid', 'Abatements' || y || '.csv', count(*), count(*) FILTER (WHERE k % 5 IN (0, 1) OR (k % 5 = 2 AND price > 0))
FROM r GROUP BY y"""

def _text(c: str) -> str:
    """Cents as text with two decimals."""
    s = f"CAST(coalesce(sum({c}), 0) AS VARCHAR)"
    p = f"lpad({s}, CAST(greatest(length({s}), 3) AS INTEGER), '0')"
    return f"substr({p}, 1, length({p}) - 2) || '.' || right({p}, 2) AS {c}"


# Cents and millionths of a rate as integers; the cents that rounding down leaves over go by remainder.
_EXACT = f"""WITH {RATES}, a AS (
  SELECT l.l_suppkey, {year('l.l_shipdate')} AS TaxYear, l.l_returnflag, CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18, 2))) * 100 AS HUGEINT) AS u
  FROM lineitem l GROUP BY ALL
), f AS (
  SELECT a.TaxYear, {pad('s.s_nationkey')} AS TaxDistrict, CASE WHEN l_returnflag IN ('A', 'N') THEN l_returnflag END AS PropertyClass, u
  FROM a JOIN supplier s ON a.l_suppkey = s.s_suppkey
), w AS (
  SELECT f.*, CAST(round(GeneralRate * 1e6) AS HUGEINT) AS g, CAST(round(FireRate * 1e6) AS HUGEINT) AS i,
    CAST(round(RoadRate * 1e6) AS HUGEINT) AS r
  FROM f LEFT JOIN rates ON f.TaxYear = rates.TaxYear AND f.TaxDistrict = rates.TaxDistrict AND f.PropertyClass = rates.PropertyClass
), p AS (
  SELECT *, u * g // (g + i + r) AS qg, u * i // (g + i + r) AS qi, u * r // (g + i + r) AS qr,
    u * g % (g + i + r) AS mg, u * i % (g + i + r) AS mi, u * r % (g + i + r) AS mr
  FROM w
), s AS (
  SELECT *, u - qg - qi - qr AS over_ FROM p
), x AS (
  SELECT TaxYear, {muni('TaxDistrict')} AS Municipality, CASE WHEN g IS NOT NULL THEN u END AS Rated,
    qg + CASE WHEN (mi > mg)::INT + (mr > mg)::INT < over_ THEN 1 ELSE 0 END AS General,
    qi + CASE WHEN (mg >= mi)::INT + (mr > mi)::INT < over_ THEN 1 ELSE 0 END AS Fire,
    qr + CASE WHEN (mg >= mr)::INT + (mi >= mr)::INT < over_ THEN 1 ELSE 0 END AS Road
  FROM s
)
SELECT TaxYear, Municipality, {', '.join(map(_text, ('General', 'Fire', 'Road', 'Rated')))} FROM x GROUP BY 1, 2"""

STAGE_ORACLE_SQL: dict[str, str] = {
    "incremental_gather": f"""
SELECT o_orderkey, o_totalprice, {_Y} AS FileYear, CASE WHEN {_Y} IN (1996, 2001) THEN 2 ELSE 1 END AS "Gather" FROM orders""",
    "incremental_combine": oracle.ORACLE_SQL["combined_loss"],
    "rejected_lines": """
SELECT 'kept' AS Outcome, CAST(c_custkey AS VARCHAR) AS Line, CAST(NULL AS INTEGER) AS Fields FROM customer
UNION ALL
SELECT 'rejected', c_custkey || ',' || c_name || ',' || c_nationkey || ',' ||
         CASE c_custkey % 5 WHEN 0 THEN 'junk' WHEN 1 THEN 'NA' WHEN 2 THEN '' WHEN 3 THEN ',y' ELSE '"a,b",,' END,
       CASE c_custkey % 5 WHEN 3 THEN 5 WHEN 4 THEN 6 ELSE 4 END
FROM customer""",
    "keyed_exclusion": """
SELECT o_custkey, o_orderpriority, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
WHERE c.c_mktsegment IN ('BUILDING', 'MACHINERY')
  AND NOT (c.c_acctbal < 0 AND c.c_custkey % 11 <> 0 AND o.o_orderpriority IN ('1-URGENT', '5-LOW'))
GROUP BY 1, 2""",
    "fund_long_keyed": oracle.ORACLE_SQL["fund_long_filtered"],
    "mapped_labels": """
SELECT CASE WHEN s.s_suppkey IS NULL THEN 'Other' ELSE 'Nation ' || s.s_nationkey END AS Label, count(*) AS n_rows,
       CAST(sum(l_quantity) AS DOUBLE) AS quantity
FROM lineitem l LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey AND s.s_acctbal >= 0
GROUP BY 1""",
    "wide_discovered": "SELECT c_nationkey, " + ", ".join(
        f"round(sum(CASE WHEN {_Y} = {y} THEN o_totalprice END), 2) AS TotalPrice_{y}" for y in _YEARS) + """
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1""",
    "quality_profile": _PROFILE,
    "reconcile_marked": _MARKED,
    "reconcile_bucketed": _MARKED,
    "published_report": IO_ORACLE_SQL["split_report"],
    "exact_fund_sums": _EXACT,
}
