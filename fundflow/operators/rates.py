"""Rate tables and apportionment of an amount over funds by rate share."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundflow.functions.sqltext import ident, in_list, lit

def expand_alias(rates: DataFrame, key: str, aliases: Mapping[str, str]) -> DataFrame:
    """Copy the rows of each source key under an alias key: ``{alias: source}``.

    One pass: every row explodes into itself plus its aliases (a source may
    feed several), so the rate table is scanned once, not once per copy.
    """
    if not aliases:
        return rates
    targets: dict[str, list[str]] = {}
    for alias, source in aliases.items():
        targets.setdefault(source, []).append(alias)
    k = ident(key)
    arms = " ".join(f"WHEN {k} = {lit(src)} THEN array({k}, {', '.join(lit(a) for a in al)})"
                    for src, al in targets.items())
    # NULL and unlisted keys stay one row each.
    return rates.withColumn(key, F.expr(f"explode(CASE {arms} ELSE array({k}) END)"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once (lazy; empty when ``keys`` is a key)."""
    return df.groupBy(*keys).count().filter(F.col("count") > 1)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    """Raise if ``keys`` is not unique: a left join to ``df`` would fan out."""
    dup = duplicate_keys(df, keys).limit(1).collect()
    if dup:
        raise ValueError(f"keys {list(keys)} are not unique, e.g. {dup[0].asDict()}")


def apportion(fact: DataFrame, rates: DataFrame, keys: Sequence[str], amount: str,
              funds: Mapping[str, str], total: str | None = None,
              gated: Mapping[str, tuple[str, Sequence[str]]] | None = None,
              out_prefix: str = "Lost_", keep_rates: bool = False) -> DataFrame:
    """Left-join ``fact`` to ``rates`` on ``keys`` and split ``amount`` over funds.

    ``funds`` maps fund name -> rate column. The denominator is the ``total``
    column when given (published total), else the sum of the fund rates (NULL
    if any is missing). ``gated`` maps fund -> (code column, codes): the fund
    share applies only to rows whose code is listed and is 0 elsewhere, even
    where no rate matched. Division never raises: a zero or missing
    denominator yields NULL, which NULL-skipping sums then ignore.

    Join strategy: no hint. A rate table is small by construction (years x
    districts x classes); Spark's planner broadcasts it from its size
    statistics (``autoBroadcastJoinThreshold``, in bytes) and AQE re-plans from
    the real size at run time; beyond the threshold it stays a shuffle join.
    """
    rate_cols = list(dict.fromkeys(list(funds.values()) + ([total] if total else [])))

    def f(c: str) -> str:
        return f"f.{ident(c)}"

    def r(c: str) -> str:
        return f"r.{ident(c)}"

    denom = r(total) if total else "(" + " + ".join(r(c) for c in funds.values()) + ")"
    shares = []
    for fund, rate_col in funds.items():
        share = f"{f(amount)} * try_divide({r(rate_col)}, {denom})"
        if gated and fund in gated:
            code_col, codes = gated[fund]
            share = f"CASE WHEN {f(code_col)} IN {in_list(codes)} THEN {share} ELSE 0D END"
        shares.append(f"{share} AS {ident(out_prefix + fund)}")
    cols = [f(c) for c in keys] + [f(c) for c in fact.columns if c not in keys]
    if keep_rates:
        cols += [r(c) for c in rate_cols if c not in fact.columns]
    on = " AND ".join(f"{f(k)} = {r(k)}" for k in keys)
    rate_side = f"SELECT {', '.join(map(ident, [*keys, *rate_cols]))} FROM {{rates}}"
    # One parameterised statement: a single JVM round trip for the whole plan.
    return fact.sparkSession.sql(
        f"SELECT {', '.join(cols + shares)} FROM {{fact}} f LEFT JOIN ({rate_side}) r ON {on}",
        fact=fact, rates=rates)
