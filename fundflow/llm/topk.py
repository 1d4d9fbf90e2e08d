"""Exact top-k inner products over vectors in order of falling length.

Components become integers, ``floor(scale * x)``, so scores are exact. The vectors are dealt into
*tiers* of falling length (and a tier into shards by a hash of the id). Queries go to
the first tier, whose answers give each query a bound, its k-th score; a later tier is asked
only by queries whose length times the tier's greatest length reaches their bound. In a
shard the vectors stand by falling length and are taken a block at a time:

* when a query's length times the block's greatest length is below its k-th
  score, the query is done: all that follow are shorter (Cauchy-Schwarz);
* else the vectors' first ``head`` coordinates, in a basis turned by the
  singular vectors of a sample, give a partial sum; the rest of the sum is at
  most the product of the two rests' lengths. Only vectors whose partial sum
  and bound together reach the k-th score are scored, in integers.

The basis is fitted on a bounded sample (``sample_rows``). Any turned basis
gives the same answers; the sample only decides how much is pruned.

Results: rows with a null id, or a vector that is null, empty or holds null or
non-finite components, take no part (zero vectors do); repeated rows (same id)
count once, with the smallest vector; fewer than ``k`` candidates give fewer rows; ties go to the smaller
id; an empty table or no query gives no rows. Scores are compared exactly, however large, within a
shard, and between shards as 64-bit integers; those beyond 64 bits are taken as the nearest 64-bit integer.
"""

from __future__ import annotations

import math
import operator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundflow.llm.common import staged
from fundflow.llm.vectors import QUERY_BLOCK, best, by_shard, one_row_per_id, ranked, to_all, vectors

SCALE = 256
#: Turned coordinates in the partial sum.
HEAD = 16
#: Vectors taken together.
STEP = 256
#: Rows that the turned basis is fitted on, at most.
SAMPLE_ROWS = 4096
#: Tiers of length, at most.
TIERS = 16
#: Sums up to here are exact in double precision.
EXACT = 2.0 ** 52
NONE = np.iinfo(np.int64).max


def turned_basis(points: np.ndarray) -> np.ndarray:
    """Right singular vectors of the sample, by falling singular value."""
    _, turn = np.linalg.eigh(points.T @ points)
    return turn[:, ::-1].copy()


class NormSorted:
    """One shard: integer vectors by falling length, and their turned heads."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, turn: np.ndarray | None, head: int = HEAD, step: int = STEP):
        length = _lengths(points)
        order = np.lexsort((ids, -length))
        self.ids, self.points, self.length, self.step = ids[order], points[order], length[order], step
        self.turn = np.eye(points.shape[1]) if turn is None else turn
        self.head = min(head, points.shape[1])
        self.front, self.rest = self._split(self.points)

    def _split(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        y = x @ self.turn
        return y[:, :self.head], _lengths(y[:, self.head:])

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, bounds: np.ndarray | None = None) -> list[tuple]:
        """(query_id, vec_id, score) of the ``k`` greatest; those below a query's bound may be left out."""
        n = len(queries)
        least = np.full(n, -np.inf) if bounds is None else np.where(np.isnan(bounds), -np.inf, bounds)
        length = _lengths(queries)
        front, rest = self._split(queries)
        exact = length.max(initial=0) * self.length.max(initial=0) < EXACT
        top = _Doubles(n, k) if exact else _Integers(n, k)
        live = np.arange(n)
        self.scored = 0
        for a in range(0, len(self.ids), self.step):
            b = a + self.step
            slack = 1e-9 * (length * self.length[a] + 1)
            kth = np.maximum(top.kth(), least)
            live = live[(length * self.length[a] + slack >= kth)[live]]
            if not len(live):
                break
            reach = front[live] @ self.front[a:b].T + rest[live][:, None] * self.rest[a:b][None, :]
            may = reach + slack[live][:, None] >= kth[live][:, None]
            may &= query_ids[live][:, None] != self.ids[a:b][None, :]
            cols = np.flatnonzero(may.any(axis=0))
            rows = may.any(axis=1)
            if not len(cols):
                continue
            self.scored += int(may.sum())
            top.take(live[rows], queries[live[rows]], self.points[a:b][cols], self.ids[a:b][cols], may[np.ix_(rows, cols)])
        return [(int(query_ids[j]), i, max(-2 ** 63, min(2 ** 63 - 1, s))) for j, i, s in top.rows()]


class _Doubles:
    """The ``k`` best answers of each query, scores exact in double precision."""

    def __init__(self, n: int, k: int):
        self.k, self.scores, self.ids = k, np.full((n, k), np.inf), np.full((n, k), NONE)  # scores negated

    def kth(self) -> np.ndarray:
        return -self.scores[:, -1]

    def take(self, at: np.ndarray, queries: np.ndarray, points: np.ndarray, ids: np.ndarray, may: np.ndarray) -> None:
        scores = np.where(may, -(queries @ points.T), np.inf)
        self.scores[at], self.ids[at] = best(np.hstack([self.scores[at], scores]),
                                             np.hstack([self.ids[at], np.where(may, ids[None, :], NONE)]), self.k)

    def rows(self) -> list[tuple]:
        return [(j, int(i), int(-s)) for j in range(len(self.ids)) for s, i in zip(self.scores[j], self.ids[j], strict=True) if i != NONE]


class _Integers:
    """As :class:`_Doubles`, for scores that need whole integers: close ones are told apart."""

    def __init__(self, n: int, k: int):
        self.k, self.best = k, [[] for _ in range(n)]  # (negated score, id), sorted

    def kth(self) -> np.ndarray:
        return np.array([-float(b[-1][0]) if len(b) == self.k else -np.inf for b in self.best])

    def take(self, at: np.ndarray, queries: np.ndarray, points: np.ndarray, ids: np.ndarray, may: np.ndarray) -> None:
        whole = [[int(c) for c in p] for p in points]
        for j, q, hits in zip(at.tolist(), queries, may, strict=True):
            a = [int(c) for c in q]
            found = [(-sum(map(operator.mul, a, whole[i])), int(ids[i])) for i in np.flatnonzero(hits).tolist()]
            self.best[j] = sorted(self.best[j] + found)[:self.k]

    def rows(self) -> list[tuple]:
        return [(j, i, -s) for j, found in enumerate(self.best) for s, i in found]


def _lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", x, x))


def top_products(df: DataFrame, is_query: Column, k: int = 5, scale: int = SCALE, id_col: str = "vec_id",
                 vec_col: str = "embedding", shard_rows: int | None = None, query_block: int = QUERY_BLOCK,
                 sample_rows: int = SAMPLE_ROWS, head: int = HEAD) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` greatest integer inner products of every row
    for which ``is_query`` (an expression over ``vec_id``) holds with all rows but itself."""
    base, n, shard_rows = one_row_per_id(vectors(df, id_col, vec_col, keep_zero=True), shard_rows)
    by_dim: dict[int, list] = {}
    for (v,) in base.select("v").limit(sample_rows).collect():
        by_dim.setdefault(len(v), []).append(v)
    turns = {d: turned_basis(np.array(vs)) for d, vs in by_dim.items()
             if np.abs(vs).max() < 1e100}

    def make(ids: np.ndarray, points: np.ndarray):
        shard = NormSorted(ids, np.floor(points * scale), turns.get(points.shape[1]), head)
        return lambda query_ids, queries, bounds: shard.search(query_ids, np.floor(queries * scale), k, bounds)

    dealt, tiers = _by_length(base, n, shard_rows, scale)
    shards = tiers[-1][0] + tiers[-1][1] if tiers else 1
    queries = base.where(is_query)

    def answers(vectors_: DataFrame, asked: DataFrame) -> DataFrame:
        return by_shard(vectors_, asked, shards, make, "long", query_block)

    if len(tiers) < 2:
        found = answers(dealt, to_all(queries, 0, shards))
    else:
        first = tiers[0][1]
        begun = staged(ranked(answers(dealt.where(F.col("shard") < first), to_all(queries, 0, first)), k, nearest=False), "products")
        # Queries with k answers have a bound; the others go everywhere.
        bound = begun.where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").cast("double").alias("bound"))
        later = ", ".join(f"struct({a} AS a, {a + parts - 1} AS b, {length!r}D AS length)" for a, parts, length in tiers[1:])
        asked = (queries.join(bound, "vec_id", "left").withColumn("length", F.expr(LENGTH.format(scale=scale)))
                 # A little more than Cauchy-Schwarz: lengths are rounded.
                 .withColumn("tier", F.explode(F.expr(f"filter(array({later}), t -> bound is null or "
                                                      "length * t.length * (1 + 1e-9D) + 1e-9D >= bound)")))
                 .select("vec_id", "v", "bound", F.explode(F.expr("sequence(tier.a, tier.b)")).alias("shard")))
        found = (begun.select("query_id", "vec_id", "score")
                 .union(answers(dealt.where(F.col("shard") >= first), asked)))
    return ranked(found, k, nearest=False).withColumn("rank", F.col("rank").cast("int"))


#: SQL of a vector's length in integer components (those beyond 1e15 are whole, or as good as).
LENGTH = ("sqrt(aggregate(transform(v, x -> if(abs(x * {scale}) < 1e15D, cast(floor(x * {scale}) as double), x * {scale})), "
          "0D, (s, y) -> s + y * y))")


def _by_length(base: DataFrame, n: int, shard_rows: int, scale: int) -> tuple[DataFrame, list[tuple[int, int, float]]]:
    """Vectors with their ``shard``, in tiers of falling length; and for each tier its first shard, how many shards it
    has, and its greatest length. Equal lengths are one tier, however many: a tier is dealt by a hash."""
    wanted = min(TIERS, math.ceil(n / shard_rows))
    sized = base.withColumn("length", F.expr(LENGTH.format(scale=scale)))
    cuts = sized.approxQuantile("length", [i / wanted for i in range(1, wanted)], 0.1 / wanted) if wanted > 1 else []
    above = " + ".join(f"CAST(length < {c!r}D AS INT)" for c in sorted(set(cuts))) or "0"
    sized = sized.withColumn("tier", F.expr(above))
    seen = sized.groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.max("length").alias("length")).orderBy("tier").collect()
    tiers, first = [], 0
    arms = []
    for r in seen:
        parts = math.ceil(r.n / shard_rows)
        tiers.append((first, parts, float(r.length)))
        arms.append(f"WHEN {r.tier} THEN {first} + pmod(xxhash64(vec_id), {parts})")
        first += parts
    shard = f"CAST(CASE tier {' '.join(arms)} END AS INT)" if arms else "0"
    return sized.select("vec_id", "v", F.expr(shard).alias("shard")), tiers
