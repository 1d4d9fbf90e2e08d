"""Money in decimals: exact sums, and shares that add up to the amount.

Sums of doubles depend on the order in which a cluster adds them; sums of decimals don't. A
share of an amount is rounded once, where it is made, to the currency's smallest unit:
the units that rounding down leaves over go to the shares with the greatest remainders (of equal ones to the first),
so the shares of a row add up to its amount to the last unit.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundflow.functions import clean
from fundflow.functions.sqltext import ident, in_list

#: Fixed value: plain decimal text, with or without a sign and a point.
DECIMAL_TEXT = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)$"
#: Digits of an amount in units, and of a rate in its own smallest unit.
AMOUNT, RATE_DIGITS = "decimal(18,0)", 6


def to_decimal(c: str, scale: int = 2) -> Column:
    """Plain numeric text (or a number) as decimal(18, ``scale``), half up beyond it; plain text takes no detour
    over double; other text and what doesn't fit is NULL."""
    t = clean.trim_ws(F.col(c).cast("string"))
    plain = t.rlike(DECIMAL_TEXT)
    return F.when(plain, t.try_cast(f"decimal(18,{scale})")).otherwise(clean.to_num(c).try_cast(f"decimal(18,{scale})"))


def sum_exact(c: str, scale: int = 2) -> Column:
    """Sum of decimals skipping NULLs, 0 over nothing: decimal(38, ``scale``); an overflow raises."""
    return F.expr(f"CAST(coalesce(sum({ident(c)}), 0) AS decimal(38,{scale}))")


def apportion_exact(fact: DataFrame, rates: DataFrame, keys: Sequence[str], amount: str, funds: Mapping[str, str],
                    gated: Mapping[str, tuple[str, Sequence[str]]] | None = None, scale: int = 2,
                    out_prefix: str = "Lost_") -> DataFrame:
    """CMP-1 in decimals: ``amount`` (decimal(18, ``scale``)) split over ``funds`` by share of the sum of their rates
    (taken to six digits).

    The shares add up to the amount. As in :func:`~fundflow.operators.rates.apportion`, a ``gated`` fund's share goes to
    listed codes only and is 0 elsewhere (its part of the amount is then no fund's); a missing rate or amount,
    or rates that sum to 0, give NULL shares (0 for a gated fund elsewhere). ``rates`` must be unique on ``keys``.
    """
    if any(c.startswith("_") for c in fact.columns):
        raise ValueError("column names of the fact must not begin with an underscore")
    names = list(funds)
    r = rates.select(*keys, *[F.expr(f"CAST(CAST({ident(c)} AS decimal(12,{RATE_DIGITS})) * {10 ** RATE_DIGITS} AS {AMOUNT})")
                              .alias(f"_w{i}") for i, c in enumerate(funds.values())])
    j = fact.join(r, list(keys), "left").select(
        *fact.columns, *[f"_w{i}" for i in range(len(names))],
        F.expr(f"CAST(abs({ident(amount)}) * {10 ** scale} AS {AMOUNT})").alias("_units"),
        F.expr("nullif(" + " + ".join(f"_w{i}" for i in range(len(names))) + f", CAST(0 AS {AMOUNT}))").alias("_all"))
    # Products of 18 digits fit 38; quotients are whole units.
    j = j.withColumns({f"_p{i}": F.expr(f"_units * _w{i}") for i in range(len(names))})
    j = j.withColumns({f"_q{i}": F.expr(f"_p{i} div _all") for i in range(len(names))})
    j = j.withColumns({f"_m{i}": F.expr(f"_p{i} - CAST(_q{i} AS {AMOUNT}) * _all") for i in range(len(names))}
                      | {"_over": F.expr("CAST(_units AS bigint) - (" + " + ".join(f"_q{i}" for i in range(len(names))) + ")")})
    shares = []
    for i, fund in enumerate(names):
        ahead = " + ".join([f"CAST(_m{k} {'>=' if k < i else '>'} _m{i} AS INT)" for k in range(len(names)) if k != i] or ["0"])
        units = f"(_q{i} + IF({ahead} < _over, 1, 0)) * sign({ident(amount)})"
        share = f"CAST(CAST({units} AS decimal(20,0)) / {10 ** scale} AS decimal(20,{scale}))"
        if gated and fund in gated:
            column, codes = gated[fund]
            share = f"CASE WHEN {ident(column)} IN {in_list(codes)} THEN {share} ELSE 0 END"
        shares.append(F.expr(f"CAST({share} AS decimal(20,{scale}))").alias(f"{out_prefix}{fund}"))
    return j.select(*fact.columns, *shares)
