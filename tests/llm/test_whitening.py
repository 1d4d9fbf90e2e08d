"""Whitening against a plain eigendecomposition."""

import numpy as np
import pytest

from fundflow.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n string, component int"


def plain(vectors, components=16):
    """n, deviations and whitened rows (columns up to sign), explained shares; the fit on distinct integer vectors."""
    x = np.floor(64 * np.array(vectors, np.float32).astype(np.float64)).astype(np.int64) + 1_000_000
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(axis=0)
    c = (n * u - s) / n
    e, q = np.linalg.eigh(c.T @ c / n)
    keep = np.flatnonzero(e > 1e-12 * e[-1])[::-1][:components]
    return n, ((n * x - s) ** 2).sum(axis=1), (n * x - s) / n @ q[:, keep] / np.sqrt(e[keep]), e[keep] / e.sum()


def rows(n, dim, seed):
    rng = np.random.default_rng(seed)
    x = (rng.normal(size=(n, dim)) * np.linspace(0.2, 3, dim)).astype(np.float32)
    x[n // 2:n // 2 + n // 6] = x[0]  # copies
    return x


def test_secular_equation_and_deflation():
    rng = np.random.default_rng(1)
    for trial in range(60):
        d = int(rng.integers(1, 12))
        q, _ = np.linalg.qr(rng.normal(size=(d, d)))
        values = np.sort(rng.choice([0.0, 1.0, 1.0, 2.0, 1e-9, 1e6], d) if trial % 2 else rng.normal(size=d) ** 2)
        v = rng.normal(size=d) * 10.0 ** rng.integers(-6, 4)
        v = q[:, 0] * 3 if trial % 7 == 0 else v
        e, w = whitening.rank_one(values, q, v)
        m = q @ np.diag(values) @ q.T + np.outer(v, v)
        size = np.abs(m).max() + 1e-300
        assert np.abs(w.T @ w - np.eye(d)).max() < 1e-12
        assert np.abs(w @ np.diag(e) @ w.T - m).max() < 1e-12 * size and (np.diff(e) >= 0).all()


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_spectra_by_rank_one_updates(block):
    x = np.floor(64 * rows(90, 9, 2)).astype(np.int64) + 1_000_000
    parts = []
    for some in (x[:1], x[1:50], x[50:]):
        s = whitening.Spectrum(9)
        for a in range(0, len(some), block):
            s.add(some[a:a + block])
        parts.append(s)
    whole = parts[0]
    for s in parts[1:]:
        whole.merge(s)
    c = x - x.mean(axis=0)
    assert whole.n == 90 and whole.total == x.sum(axis=0).tolist()
    assert np.allclose(whole.values, np.linalg.eigvalsh(c.T @ c), rtol=1e-10)
    assert np.abs(whole.vectors.T @ whole.vectors - np.eye(9)).max() < 1e-11


@pytest.mark.parametrize("fan,block", [(16, 512), (2, 5)])
def test_as_plain(spark, monkeypatch, fan, block):
    monkeypatch.setattr(whitening, "FAN", fan)
    x = rows(240, 20, 3)
    nan, inf = float("nan"), float("inf")
    table = [(i, v.tolist(), "s", 1) for i, v in enumerate(x)]
    bad = [(900, None, "s", 1), (901, [nan] * 20, "s", 1), (902, [1.0] * 19 + [None], "s", 1), (903, [inf] * 20, "s", 1), (904, [], "s", 1)]
    table += [*bad, table[7], table[7], (None, x[9].tolist(), None, None)]
    got = whitening.whiten(spark.createDataFrame(table, SCHEMA).repartition(7), block=block).toPandas()
    n, deviation, white, explained = plain(x)
    assert (got["n"] == n).all() and n < 240 and len(got) == 16 * 243 and not got["vec_id"].isin(range(900, 905)).any()
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9
    one = got.dropna(subset="vec_id").drop_duplicates(["vec_id", "component"]).sort_values(["vec_id", "component"])
    assert [int(d) for d in one[one["component"] == 1]["deviation"]] == deviation.tolist()
    w = one["whitened"].to_numpy().reshape(240, 16)
    sign = np.sign((w * white).sum(axis=0))
    assert np.abs(w - white * sign).max() < 1e-8
    assert np.allclose(one["explained"].to_numpy().reshape(240, 16), explained, rtol=1e-9)
    assert len(got[got["vec_id"] == 7]) == 48 and got["vec_id"].isna().sum() == 16


def test_few_dimensions_few_rows_and_lengths(spark):
    table = [(1, [1.0, 2.0], None, 0), (2, [3.0, 2.0], None, 0), (3, [5.0, 2.0], None, 0), (4, [1.0], None, 0), (5, [2.0], None, 0),
             (6, [7.0, 7.0, 7.0], None, 0)]
    got = {(r.vec_id, r.component): r for r in whitening.whiten(spark.createDataFrame(table, SCHEMA)).collect()}
    assert set(got) == {(i, 1) for i in (1, 2, 3, 4, 5)}  # no variance in the second dimension, nor in one vector
    assert [got[i, 1].whitened for i in (1, 2, 3)] == pytest.approx([-np.sqrt(1.5), 0, np.sqrt(1.5)])
    assert got[4, 1].n == 2 and got[1, 1].explained == 1
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0


def test_exact_beyond_64_bits(spark):
    table = [(1, [3e12], None, 0), (2, [-2e12], None, 0), (3, [1e30], None, 0)]
    got = {r.vec_id: int(r.deviation) for r in whitening.whiten(spark.createDataFrame(table, SCHEMA)).collect()}
    x = [int(np.floor(64 * float(np.float32(v[0])))) for _, v, *_ in table[:2]] + [2 ** 50]
    x = [max(-2 ** 50, min(2 ** 50, c)) + 1_000_000 for c in x]
    assert got == {i + 1: (3 * c - sum(x)) ** 2 for i, c in enumerate(x)}
