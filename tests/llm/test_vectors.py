"""Nearest neighbours and top products against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fundflow.llm import topk, vptree

SCHEMA = "vec_id long, embedding array<float>, score string, v int"


def rows(n=300, dim=8, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)).astype(np.float32)
    x[50:60] = x[40]  # ties
    out = [(i, x[i].tolist(), "s", 1) for i in range(n)]
    nan, inf = float("nan"), float("inf")
    out += [(1000, None, "s", 1), (1001, [None] * dim, "s", 1), (1002, [nan] * dim, "s", 1), (1003, [inf] + [0.0] * (dim - 1), "s", 1),
            (1100, [0.0] * dim, "s", 1), (None, x[0].tolist(), "s", 1), (1200, [], None, None), (1300, [1.0, 2.0], None, None),
            out[7], out[100], out[100]]  # repeated rows
    return out


def clean(table, zero):
    got = {}
    for i, v, *_ in table:
        if i is None or not v or any(c is None or not np.isfinite(c) for c in v) or (not zero and not any(v)):
            continue
        got[i] = np.array(v, np.float64)
    return got


def brute(table, every, k, products):
    vs = clean(table, products)
    if products:
        vs = {i: np.floor(256 * v) for i, v in vs.items()}
    out = []
    for q, a in vs.items():
        if q % every:
            continue
        found = sorted(((-float(a @ b) if products else float(np.sqrt(sum((a - b) ** 2)))), i)
                       for i, b in vs.items() if i != q and len(a) == len(b))
        out += [(q, r + 1, i, abs(s) if not products else int(-s)) for r, (s, i) in enumerate(found[:k])]
    return out


def frame(spark, table):
    return spark.createDataFrame(table, SCHEMA)


def test_exact_nearest(spark):
    table = rows()
    got = vptree.nearest(frame(spark, table), F.col("vec_id") % 10 == 0, k=10, shard_rows=60, query_block=7, leaf=8).collect()
    want = brute(table, 10, 10, False)
    assert sorted((r[0], r[1], r[2]) for r in got) == sorted(w[:3] for w in want)
    scores = {w[:3]: w[3] for w in want}
    assert all(r[3] == pytest.approx(scores[tuple(r[:3])], rel=1e-12, abs=1e-12) for r in got)


def test_relaxed_pruning_keeps_recall_and_visits_less(spark):
    table = rows(2000, 6, 5)
    want = {w[:1] + w[2:3] for w in brute(table, 50, 10, False)}
    got = vptree.nearest(frame(spark, table), F.col("vec_id") % 50 == 0, k=10, factor=1.5, shard_rows=700, leaf=8).collect()
    assert len({(r[0], r[2]) for r in got} & want) >= 0.9 * len(want)
    points = np.array(list({i: v for i, v in clean(table, False).items() if len(v) == 6}.values()))
    seen = []
    for factor in (1.0, 3.0):
        tree = vptree.VPTree(np.arange(len(points)), points, 8)
        calls, real = [0], vptree._lengths

        def counted(x, calls=calls, real=real):
            calls[0] += x.size
            return real(x)

        vptree._lengths = counted
        try:
            tree.search(np.arange(5), points[:5], 10, factor)
        finally:
            vptree._lengths = real
        seen.append(calls[0])
    assert seen[1] < seen[0]
    with pytest.raises(ValueError):
        vptree.nearest(frame(spark, table), F.col("vec_id") == 0, factor=0.5)


def test_exact_products(spark):
    table = rows()
    got = topk.top_products(frame(spark, table), F.col("vec_id") % 10 == 0, k=5, shard_rows=60, query_block=7, head=3).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute(table, 10, 5, True))


def test_products_beyond_double_precision(spark):
    table = [(i, [3e6 + i, 1e5 * i], "s", 1) for i in range(20)]
    got = topk.top_products(frame(spark, table), F.col("vec_id") == 0, k=3).collect()
    f = lambda i: [int(np.floor(256 * np.float64(np.float32(c)))) for c in table[i][1]]
    want = sorted((-sum(a * b for a, b in zip(f(0), f(i), strict=True)), i) for i in range(1, 20))[:3]
    assert [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"])] == [(i, -s) for s, i in want]


def test_close_scores_beyond_double_precision(spark):
    """Scores of 2^56 + i, less than 64 bits: told apart one by one, over tiers and shards too."""
    table = [(i, [2.0 ** 20, i / 256], "s", 1) for i in range(120)]
    for shard_rows in (None, 7):
        got = topk.top_products(frame(spark, table), F.col("vec_id") == 0, k=5, shard_rows=shard_rows).collect()
        # The query's second component is 0: all equal but for ids; so ask one that tells them apart.
        assert [r["vec_id"] for r in sorted(got, key=lambda r: r["rank"])] == [1, 2, 3, 4, 5]
        got = topk.top_products(frame(spark, table), F.col("vec_id") == 1, k=5, shard_rows=shard_rows).collect()
        want = [(i, (2 ** 28) ** 2 + i) for i in (119, 118, 117, 116, 115)]
        assert [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"])] == want


def test_tiers_of_length_prune_and_stay_exact(spark):
    """Lengths that differ much: later tiers are asked by few. Equal lengths: one tier in several shards."""
    rng = np.random.default_rng(4)
    x = (rng.normal(size=(600, 8)) * (10 ** rng.uniform(-2, 2, 600))[:, None]).astype(np.float32)
    table = [(i, v.tolist(), "s", 1) for i, v in enumerate(x)] + [(1000 + i, [0.0] * 8, "s", 1) for i in range(90)]
    got = topk.top_products(frame(spark, table), F.col("vec_id") % 10 == 0, k=5, shard_rows=40).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute(table, 10, 5, True))
    shard = topk.NormSorted(np.arange(600), np.floor(256 * x.astype(np.float64)), None, 3, 16)
    shard.search(np.arange(600), shard.points[:1].repeat(600, 0), 5)
    assert 0 < shard.scored < 0.5 * 600 * 600


def test_small_leaves(spark):
    table = rows(120, 3, 8)
    for leaf in (1, 2, 4):
        got = vptree.nearest(frame(spark, table), F.col("vec_id") % 10 == 0, k=3, leaf=leaf).collect()
        assert sorted((r[0], r[1], r[2]) for r in got) == sorted(w[:3] for w in brute(table, 10, 3, False))


def test_an_id_with_very_many_rows(spark):
    table = rows(110, 4, 9) + [(7, [float(i), 0.0, 0.0, 0.0], "s", 1) for i in range(3, 400)]
    want = [r for r in table if r[0] != 7] + [(7, min(r[1] for r in table if r[0] == 7), "s", 1)]
    got = vptree.nearest(frame(spark, table), F.col("vec_id") % 10 == 0, k=5, shard_rows=20).collect()
    assert sorted((r[0], r[1], r[2]) for r in got) == sorted(w[:3] for w in brute(want, 10, 5, False))


def test_few_rows_and_none(spark):
    few = frame(spark, rows()[:3])
    assert vptree.nearest(few, F.col("vec_id") == 0, k=10).count() == 2
    assert topk.top_products(few, F.col("vec_id") == 0, k=10).count() == 2
    none = frame(spark, [])
    assert vptree.nearest(none, F.col("vec_id") == 0).count() == 0
    assert topk.top_products(none, F.col("vec_id") == 0).count() == 0
