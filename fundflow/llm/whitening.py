"""Whitening of vectors by an incremental eigendecomposition.

Components become integers (``floor(scale * c) + offset``), so counts, sums and deviations are
exact; the spectrum is that of each distinct integer vector once.

1. *Rank-one updates.* A partition keeps the eigenvalues and eigenvectors of the scatter matrix
   of what it has seen, about its mean. A vector adds a rank-one term: the new eigenvalues are the
   roots of a secular equation, between the old ones, and the new eigenvectors follow from them.
   Entries that the term doesn't touch, and equal eigenvalues (turned so that the term touches
   one of them only), are *deflated*: they stay. Vectors are taken ``block`` at a time, centred
   about the block's mean: the rows of the triangle of its QR factorisation have the same scatter as
   the block and are at most as many as dimensions; they are the updates, and the way between the means
   is one more.
2. *Combining.* A spectrum is added to another by successive rank-one updates, one for each of its
   eigenvectors and one for the means; ``FAN`` at a time in a task, in rounds, until one is left.
3. *Rayleigh-Ritz.* The covariance of all vectors in the basis found, summed over all partitions, is
   decomposed; it turns the basis into eigenvectors to double precision.

A last pass measures the covariance of what was whitened. What comes to the driver are matrices of
the vectors' dimension.

Results: rows with a vector that is null or empty, or holds null or non-finite entries, are left out; a
null id comes back as null; repeated rows come back as often, and count once in the fit; vectors of
another length have a fit of their own; components without variance (1e-12 of the greatest) are left out, so a
single vector gives no rows; an empty table gives none; other columns are left out. Entries beyond 2^50
are taken as 2^50. A deviation beyond 38 digits is null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundflow.llm.common import staged, unstage

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
#: Vectors whose scatter becomes rank-one updates together.
BLOCK = 512
#: Spectra combined in a task.
FAN = 16
#: Entries are kept within these bounds, so that a block's sums are exact in 64 bits.
BOUND = 2 ** 50
NO_VARIANCE = 1e-12
EPS = np.finfo(np.float64).eps


def secular_roots(d: np.ndarray, z2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of ``1 + sum(z2 / (d - x))``, one above each of the rising, distinct ``d``; and the matrix of
    ``d[i] - root[j]`` (row j), which is exact where the difference of the two rounded numbers isn't.

    Each root is sought from the nearer of its two poles, by interpolation with both poles, inside a
    bracket that every step narrows.
    """
    k = len(d)
    at = np.arange(k)
    gap = np.append(np.diff(d), z2.sum())
    middle = d + gap / 2
    right = 1 + (z2 / (d - middle[:, None])).sum(axis=1) < 0
    right[-1] = False
    origin = d[at + right]
    shift = d - origin[:, None]
    lo, hi = np.where(right, -gap / 2, 0.0), np.where(right, 0.0, gap / 2)
    hi[-1] = gap[-1]
    below = at[None, :] <= at[:, None]
    after = np.append(shift[at[:-1], at[1:]], np.inf)  # the pole to the right; the last root has none
    t = (lo + hi) / 2
    for _ in range(80):
        delta = shift - t[:, None]
        terms = z2 / delta
        f = 1 + terms.sum(axis=1)
        slope = terms / delta
        left = np.where(below, slope, 0).sum(axis=1)
        other = slope.sum(axis=1) - left
        done = np.abs(f) <= 4 * EPS * (1 + np.abs(terms).sum(axis=1))
        if done.all():
            break
        lo, hi = np.where(f < 0, t, lo), np.where(f < 0, hi, t)
        p = shift[at, at] - t
        with np.errstate(all="ignore"):
            q = after - t
            a = (p + q) * f - p * q * (left + other)
            b = p * q * f
            c = f - p * left - q * other
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            step[-1] = p[-1] + p[-1] ** 2 * left[-1] / (f[-1] - p[-1] * left[-1])
            new = t + step
        inside = (new > lo) & (new < hi)
        new = np.where(inside, new, (lo + hi) / 2)
        if ((new == t) | done).all():
            break
        t = np.where(done, t, new)
    return origin + t, shift - t[:, None]


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors (columns) of ``vectors diag(values) vectors' + v v'``."""
    z = vectors.T @ v
    size = float(z @ z)
    if not size > 0:
        return values, vectors
    small = 8 * EPS * max(float(np.abs(values).max()), size)
    live, vectors = [], vectors.copy()
    for i in np.flatnonzero(np.abs(z) * np.sqrt(size) > small).tolist():
        if live and values[i] - values[live[-1]] <= small:
            j = live.pop()
            r = np.hypot(z[i], z[j])
            c, s = z[i] / r, z[j] / r
            z[i], z[j] = r, 0.0
            vectors[:, [j, i]] = vectors[:, [j, i]] @ np.array([[c, s], [-s, c]])
        live.append(i)
    if not live:
        return values, vectors
    live = np.array(live)
    d = values[live]
    roots, delta = secular_roots(d, z[live] ** 2)
    # The term that has exactly these roots: the eigenvectors made from it are orthogonal.
    between = d[:, None] - d
    np.fill_diagonal(between, 1.0)
    exact = np.copysign(np.sqrt(np.abs(np.prod(-delta / between, axis=0))), z[live])
    turn = exact / delta
    turn /= np.sqrt((turn ** 2).sum(axis=1))[:, None]
    vectors[:, live] = vectors[:, live] @ turn.T
    values = values.copy()
    values[live] = roots
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


class Spectrum:
    """Count, exact sums, and the eigenvalues and eigenvectors of the scatter about the mean."""

    def __init__(self, dim: int):
        self.n, self.total = 0, [0] * dim
        self.values, self.vectors = np.zeros(dim), np.eye(dim)

    def mean(self) -> np.ndarray:
        """From OFFSET, so that what is near it keeps its digits."""
        return np.array([(t - OFFSET * self.n) / self.n for t in self.total])

    def _update(self, rows: np.ndarray) -> None:
        for v in rows:
            self.values, self.vectors = rank_one(self.values, self.vectors, v)

    def _count(self, n: int, total: list[int]) -> None:
        """Add the way between the means, and the counts."""
        if self.n:
            way = np.array([(t - OFFSET * n) / n for t in total]) - self.mean()
            self._update(way[None, :] * np.sqrt(self.n * n / (self.n + n)))
        self.n += n
        self.total = [a + b for a, b in zip(self.total, total, strict=True)]

    def add(self, x: np.ndarray) -> None:
        """A block of integer vectors."""
        total = [int(t) for t in x.sum(axis=0)]
        y = (x - OFFSET).astype(np.float64)
        y -= np.array([(t - OFFSET * len(x)) / len(x) for t in total])
        self._update(np.linalg.qr(y, mode="r") if len(x) > x.shape[1] else y)
        self._count(len(x), total)

    def merge(self, other: Spectrum) -> None:
        self._update((other.vectors * np.sqrt(np.maximum(other.values, 0))).T)
        self._count(other.n, other.total)


_SPECTRUM = "dim int, part long, n long, total array<string>, vals array<double>, vecs array<double>"


def _row(dim: int, part: int, s: Spectrum) -> dict:
    return {"dim": dim, "part": part, "n": s.n, "total": [str(t) for t in s.total],
            "vals": s.values.tolist(), "vecs": s.vectors.ravel().tolist()}


def _spectrum(r) -> Spectrum:
    s = Spectrum(r.dim)
    s.n, s.total = int(r.n), [int(t) for t in r.total]
    s.values, s.vectors = np.array(r.vals, np.float64), np.array(r.vecs, np.float64).reshape(r.dim, r.dim)
    return s


def _by_dim(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[int, np.ndarray, pa.RecordBatch]]:
    """Dimension, integer vectors and the rows they are of, ``rows`` at most together."""
    for batch in batches:
        sizes = np.asarray(batch.column("dim"))
        for dim in np.unique(sizes).tolist():
            same = batch.take(pa.array(np.flatnonzero(sizes == dim)))
            for a in range(0, same.num_rows, rows):
                part = same.slice(a, rows)
                yield dim, np.asarray(part.column("x").flatten()).reshape(-1, dim), part


def _fit(fit: DataFrame, block: int) -> list[Spectrum]:
    """One spectrum for each dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        of: dict[int, Spectrum] = {}
        held: dict[int, list[np.ndarray]] = {}
        for dim, x, _ in _by_dim(batches, block):
            waiting = held.setdefault(dim, [])
            waiting.append(x)
            if sum(map(len, waiting)) >= block:
                of.setdefault(dim, Spectrum(dim)).add(np.concatenate(waiting))
                waiting.clear()
        for dim, waiting in held.items():
            if waiting:
                of.setdefault(dim, Spectrum(dim)).add(np.concatenate(waiting))
        part = TaskContext.get().partitionId()
        if of:
            yield pa.RecordBatch.from_pylist([_row(dim, part, s) for dim, s in of.items()], schema=schema)

    schema = pa.schema([("dim", pa.int32()), ("part", pa.int64()), ("n", pa.int64()), ("total", pa.list_(pa.string())),
                        ("vals", pa.list_(pa.float64())), ("vecs", pa.list_(pa.float64()))])

    def combine(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = list(pdf.sort_values("part").itertuples(index=False))
        s = _spectrum(rows[0])
        for r in rows[1:]:
            s.merge(_spectrum(r))
        return pd.DataFrame([_row(rows[0].dim, rows[0].part // FAN, s)])

    spectra = staged(fit.mapInArrow(run, _SPECTRUM), "spectra")
    while (most := spectra.groupBy("dim").count().agg(F.max("count")).first()[0] or 0) > 1:
        by = F.floor(F.col("part") / FAN)
        before = spectra
        spectra = staged(spectra.groupBy("dim", by).applyInPandas(combine, _SPECTRUM), "spectra")
        unstage(before)
        del most
    return [_spectrum(r) for r in spectra.collect()]


def _centred(x: np.ndarray, n: int, total: list[int]) -> tuple[np.ndarray, np.ndarray | list[int]]:
    """``x`` less the mean, rounded once; and the exact sum of squares of ``n x - total`` by row."""
    shifted = x - OFFSET
    sums = [t - OFFSET * n for t in total]
    most = n * int(np.abs(shifted).max(initial=0)) + max(abs(t) for t in sums)
    if most >= 2 ** 62:
        whole = shifted.astype(object) * n - np.array(sums, object)
        return (whole / n).astype(np.float64), (whole ** 2).sum(axis=1).tolist()
    whole = shifted * n - np.array(sums, np.int64)
    if x.shape[1] * most ** 2 >= 2 ** 63:
        return whole / n, (whole.astype(object) ** 2).sum(axis=1).tolist()
    return whole / n, (whole ** 2).sum(axis=1).tolist()


def _products(fit: DataFrame, bases: dict[int, tuple[int, list[int], np.ndarray]]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each dimension the covariance and the mean of the vectors in a basis (its columns)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for dim, x, _ in _by_dim(batches, 4096):
            n, total, basis = bases[dim]
            y = _centred(x, n, total)[0] @ basis
            sums[dim] = sums.get(dim, 0) + np.vstack([y.T @ y, y.sum(axis=0)])
        if sums:
            yield pa.RecordBatch.from_pydict({"dim": list(sums), "m": [m.ravel().tolist() for m in sums.values()]},
                                             schema=pa.schema([("dim", pa.int32()), ("m", pa.list_(pa.float64()))]))

    cells = (fit.mapInArrow(run, "dim int, m array<double>").select("dim", F.posexplode("m").alias("at", "v"))
             .groupBy("dim", "at").agg(F.sum("v").alias("v")).toPandas())
    out = {}
    for dim, part in cells.groupby("dim"):
        n, _, basis = bases[dim]
        k = basis.shape[1]
        m = part.sort_values("at")["v"].to_numpy().reshape(k + 1, k) / n
        out[int(dim)] = (m[:-1] - np.outer(m[-1], m[-1]), m[-1])
    return out


@dataclass
class Whitening:
    """A fitted whitening of vectors of one dimension."""

    n: int
    total: list[int]
    #: Eigenvectors (columns) by falling eigenvalue, eigenvalues, each one's share of the trace.
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def matrix(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)


def fit(rows: DataFrame, components: int = COMPONENTS, block: int = BLOCK) -> dict[int, Whitening]:
    """Fitted on distinct rows ``x, dim`` (see :func:`integer_rows`), by dimension."""
    spectra = {len(s.total): s for s in _fit(rows, block)}
    covariance = _products(rows, {d: (s.n, s.total, s.vectors) for d, s in spectra.items()})
    out = {}
    for d, s in spectra.items():
        values, turn = np.linalg.eigh(covariance[d][0])
        keep = np.flatnonzero(values > NO_VARIANCE * max(values[-1], 0))[::-1][:components] if values[-1] > 0 else []
        vectors = s.vectors @ turn[:, keep]
        if len(keep):
            vectors /= np.sqrt((vectors ** 2).sum(axis=0))
            sign = vectors[np.abs(vectors).argmax(axis=0), np.arange(len(keep))]
            vectors = vectors * np.sign(sign)
        out[d] = Whitening(s.n, s.total, vectors, values[keep], values[keep] / values.sum() if len(keep) else values[:0])
    full = {d: (w.n, w.total, w.matrix()) for d, w in out.items() if len(w.values)}
    if full:
        for d, (c, _) in _products(rows.where(F.col("dim").isin(list(full))), full).items():
            out[d].identity_error = float(np.abs(c - np.eye(len(c))).max())
    return out


def integer_rows(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE,
                 offset: int = OFFSET) -> DataFrame:
    """``vec_id, dim, x`` (integer components) of the rows that take part."""
    v = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    ok = "v is not null and size(v) > 0 and not exists(v, c -> c is null or isnan(c) or abs(c) = double('infinity'))"
    x = f"transform(v, c -> cast(floor(greatest(least({scale} * c, {BOUND}D), -{BOUND}D)) as long) + {offset})"
    return v.where(ok).selectExpr("vec_id", "size(v) as dim", f"{x} as x")


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", components: int = COMPONENTS,
           block: int = BLOCK) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of each row and component.

    ``deviation`` (decimal) is the exact sum over dimensions of ``(n x - S)^2``; ``whitened`` the row less the
    mean, on the component, over the root of its eigenvalue; ``explained`` the eigenvalue's share of the trace.
    """
    rows = integer_rows(df, id_col, vec_col)
    distinct = staged(rows.select("x", "dim").distinct(), "vectors")
    models = fit(distinct, components, block)
    unstage(distinct)
    widest = Decimal(10) ** 38

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, x, part in _by_dim(batches, 1024):
            w = models[dim]
            centred, deviation = _centred(x, w.n, w.total)
            y = centred @ w.matrix()
            k = y.shape[1]
            ends = pa.array(np.arange(0, (len(x) + 1) * k, k) if k else np.zeros(len(x) + 1), pa.int32())
            exact = [Decimal(int(v)) for v in deviation]
            yield pa.RecordBatch.from_arrays([
                part.column("vec_id"), pa.array(np.full(len(x), w.n)),
                pa.array([v if v < widest else None for v in exact], pa.decimal128(38, 0)),
                pa.ListArray.from_arrays(ends, pa.array(y.ravel())),
                pa.ListArray.from_arrays(ends, pa.array(np.tile(w.explained, len(x)))),
                pa.array(np.full(len(x), w.identity_error))], names=names)

    names = ["vec_id", "n", "deviation", "ws", "es", "identity_error"]
    kinds = "vec_id long, n long, deviation decimal(38,0), ws array<double>, es array<double>, identity_error double"
    return (rows.mapInArrow(run, kinds).select("*", F.posexplode("ws").alias("at", "whitened"))
            .selectExpr("vec_id", "at + 1 as component", "n", "deviation", "whitened", "es[at] as explained", "identity_error"))
