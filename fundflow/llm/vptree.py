"""Nearest neighbours by vantage-point trees, one tree per shard.

A tree's node holds a vantage point and parts the other points by their
distance to it into a near and a far half, of which it keeps the least and the
greatest distance. At a node, a query's distance ``d`` to the vantage point
bounds its distance to a half by the triangle inequality (``low - d`` and
``d - high``). A half is skipped when ``factor`` times that bound is beyond the
query's k-th distance so far. Factor one skips only what can hold no nearer
point, so the search is exact; greater factors skip more and may miss points.

A block of queries goes down the tree together; at each node the queries part
into those that look into the near half first and those that begin far.

Results: see :func:`fundflow.llm.vectors.vectors` for the rows that take part;
fewer than ``k`` candidates give fewer rows; ties go to the smaller id; repeated rows
(same id) count once, with the smallest vector; an
empty table, or no query, gives no rows; other columns are left out.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundflow.llm.vectors import QUERY_BLOCK, best, by_shard, hashed_shards, one_row_per_id, ranked, to_all, vectors

#: Points in a leaf, at most.
LEAF = 128
#: Further candidates carried along, so that rounding can't change the last ranks.
SPARE = 6


class VPTree:
    """Vantage-point tree of one shard."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = LEAF):
        self.ids, self.points, self.leaf = ids, points, leaf
        self.root = self._build(np.arange(len(ids)), np.random.default_rng(len(ids)))

    def _build(self, rows: np.ndarray, rng: np.random.Generator) -> tuple:
        if len(rows) <= max(self.leaf, 2):  # a node needs a point on either side of its vantage point
            return (rows,)
        # Of a few points, the one whose distances spread most.
        tries = rng.choice(rows, min(len(rows), 5), replace=False)
        some = self.points[rng.choice(rows, min(len(rows), 64), replace=False)]
        vantage = max(tries, key=lambda t: float(np.std(_lengths(some - self.points[t]))))
        rest = rows[rows != vantage]
        d = _lengths(self.points[rest] - self.points[vantage])
        order = np.argsort(d, kind="stable")
        half = len(rest) // 2
        near, far = order[:half], order[half:]
        return (vantage, (d[near[0]], d[near[-1]]), (d[far[0]], d[far[-1]]),
                self._build(rest[near], rng), self._build(rest[far], rng))

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float) -> list[tuple]:
        """(query_id, vec_id, distance) of the ``k`` nearest, the query's own id left out."""
        n, keep = len(queries), k + SPARE
        found_d = np.full((n, keep), np.inf)
        found_i = np.full((n, keep), np.iinfo(np.int64).max)
        kth = np.full(n, np.inf)

        def take(at: np.ndarray, rows: np.ndarray, d: np.ndarray) -> None:
            d = np.where(query_ids[at][:, None] == self.ids[rows][None, :], np.inf, d)
            hit = (d <= kth[at][:, None]).any(axis=1)
            if not hit.any():
                return
            at, d = at[hit], d[hit]
            ids = np.where(np.isinf(d), np.iinfo(np.int64).max, np.broadcast_to(self.ids[rows], d.shape))
            found_d[at], found_i[at] = best(np.hstack([found_d[at], d]), np.hstack([found_i[at], ids]), keep)
            kth[at] = found_d[at, k - 1]

        def visit(node: tuple, at: np.ndarray) -> None:
            if not len(at):
                return
            if len(node) == 1:
                rows = node[0]
                for a in range(0, len(at), 64):
                    part = at[a:a + 64]
                    take(part, rows, _lengths(queries[part][:, None, :] - self.points[rows][None, :, :]))
                return
            vantage, *halves, near, far = node
            d = _lengths(queries[at] - self.points[vantage])
            take(at, np.array([vantage]), d[:, None])
            begins_near = d <= (halves[0][1] + halves[1][0]) / 2
            for first in (True, False):
                group, gd = at[begins_near == first], d[begins_near == first]
                for side in ((0, 1) if first else (1, 0)):
                    low, high = halves[side]
                    bound = np.maximum(low - gd, gd - high)
                    seen = factor * bound <= kth[group] * (1 + 1e-12) + 1e-12
                    visit((near, far)[side], group[seen])

        visit(self.root, np.arange(n))
        out = []
        order = np.argsort(self.ids)
        for j in range(n):
            ids = found_i[j][np.isfinite(found_d[j])]
            exact = _in_order(queries[j], self.points[order[np.searchsorted(self.ids, ids, sorter=order)]])
            for i in np.lexsort((ids, exact))[:k]:
                out.append((int(query_ids[j]), int(ids[i]), float(exact[i])))
        return out


def _lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("...i,...i->...", x, x))


def _in_order(query: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Euclidean distances, squares summed one component after the other."""
    total = np.zeros(len(points))
    for i in range(points.shape[1]):
        x = points[:, i] - query[i]
        total += x * x
    return np.sqrt(total)


def nearest(df: DataFrame, is_query: Column, k: int = 10, factor: float = 1.0, id_col: str = "vec_id",
            vec_col: str = "embedding", shard_rows: int | None = None, query_block: int = QUERY_BLOCK,
            leaf: int = LEAF) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest (Euclidean) rows found for every row
    for which ``is_query`` (an expression over ``vec_id``) holds, out of all rows but itself."""
    if factor < 1:
        raise ValueError("factor: 1 (exact) or more")
    base, n, shard_rows = one_row_per_id(vectors(df, id_col, vec_col, keep_zero=False), shard_rows)
    dealt, shards = hashed_shards(base, n, shard_rows)

    def make(ids: np.ndarray, points: np.ndarray):
        tree = VPTree(ids, points, leaf)
        return lambda query_ids, queries, bounds: tree.search(query_ids, queries, k, factor)

    answers = by_shard(dealt, to_all(base.where(is_query), 0, shards), shards, make, "double", query_block)
    return ranked(answers, k, nearest=True).withColumn("rank", F.col("rank").cast("int"))
