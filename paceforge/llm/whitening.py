"""Whitening of embeddings by a bidiagonal qd solver.

Entries become whole numbers first, so that counts, sums and distances from the mean are exact. Every task reduces its centred rows
block by block to one triangular factor (QR), and factors meet in groups of bounded bytes until one is left; its
size is that of the dimension, not of the table. There Householder reflections make it bidiagonal, the differential qd
transform with shifts (dqds) finds the singular values to high relative accuracy, and a twisted factorisation of each finds its direction:
forward and backward factors meet at the row where the residual is smallest. No covariance matrix is ever formed.
A last pass over the table measures how far the whitened rows are from unit covariance.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paceforge.llm.common import chunks, stored

#: Whole numbers are floor(STEPS * entry) + ORIGIN.
TOP, STEPS, ORIGIN = 8, 1024, 100_000
#: Entries are below this, so that their whole numbers are exact as doubles.
LARGEST = 2.0**40
#: Bytes of triangular factors that meet in one task, about.
MEETING_BYTES = 32_000_000
EPS = float(np.finfo(float).eps)
#: Singular values closer than this, relatively, have their directions made orthogonal to one another.
CLUSTER = 1e-3


# --- the solver ----------------------------------------------------------------------------------


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, v): diagonal and upper diagonal of u' r v, by Householder reflections, and the right reflections in all."""
    m = np.array(r, float)
    n = len(m)
    v = np.eye(n)

    def mirror(x: np.ndarray) -> tuple[np.ndarray, float]:
        size = float(np.linalg.norm(x))
        w = x.copy()
        w[0] += size if x[0] >= 0 else -size
        length = float(w @ w)
        return w, 2 / length if length else 0.0

    for k in range(n):
        w, f = mirror(m[k:, k])
        m[k:, k:] -= np.outer(f * w, w @ m[k:, k:])
        if k < n - 2:
            w, f = mirror(m[k, k + 1 :])
            m[k:, k + 1 :] -= np.outer(m[k:, k + 1 :] @ w, f * w)
            v[:, k + 1 :] -= np.outer(v[:, k + 1 :] @ w, f * w)
    return np.diag(m).copy(), np.diag(m, 1).copy(), v


def _transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One differential qd step; the pivots come last."""
    d = q[0] - shift
    new_q, new_e, pivots = [], [], [d]
    for i in range(len(e)):
        top = d + e[i]
        ratio = q[i + 1] / top if top else 1.0
        new_q.append(top)
        new_e.append(e[i] * ratio)
        d = d * ratio - shift
        pivots.append(d)
    new_q.append(d)
    return new_q, new_e, pivots


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix, rising.

    The shift is the bound that the pivots of an unshifted step give (the inverse of the sum of their inverses), which never passes
    the smallest value; a step that rounding makes negative is taken again with half of it. Negligible entries split the work.
    """
    size = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    if not size:
        return np.zeros(len(a))
    small = (8 * EPS) ** 2
    found: list[float] = []
    work = [([float(x) for x in (a / size) ** 2], [float(x) for x in (b / size) ** 2], 0.0)]
    while work:
        q, e, sigma = work.pop()
        for _ in range(60 * len(q) + 60):
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= small * (sigma + min(q[i], q[i + 1]))), None)
            if cut is not None:
                work.append((q[: cut + 1], e[:cut], sigma))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if len(q) == 1:
                found.append(sigma + q[0])
                break
            if len(q) == 2:
                most = (q[0] + e[0] + q[1] + float(np.hypot(q[0] - q[1] + e[0], 2 * np.sqrt(q[1]) * np.sqrt(e[0])))) / 2
                found += [sigma + q[0] * (q[1] / most), sigma + most]
                break
            if 1.5 * q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            q, e, pivots = _transform(q, e, 0.0)
            least = min(pivots)
            shift = 1 / sum(1 / p for p in pivots) if least > 0 and all(1 / p < np.inf for p in pivots) else 0.0
            while shift > EPS * EPS * (sigma + least):
                moved = _transform(q, e, shift)
                if min(moved[2]) >= 0:
                    q, e, sigma = moved[0], moved[1], sigma + shift
                    break
                shift /= 2
        else:
            raise ArithmeticError("the qd steps did not converge")
    return np.sort(np.array(found)) * size**2


def twisted(a: np.ndarray, b: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray]:
    """(residuals, forward and backward multipliers) of b' b - value: a twist at row k leaves ``residuals[k]`` there alone."""
    n = len(a)
    tiny = np.finfo(float).tiny / EPS
    a = np.where(a == 0, EPS * max(np.abs(a).max(), np.abs(b).max(initial=0.0), tiny), a)
    d, low = a * a, np.append(b / a[:-1], 0.0)
    forward, backward = np.zeros(n), np.zeros(n)
    s, p = np.zeros(n), np.zeros(n)
    s[0] = -value
    for i in range(n - 1):
        pivot = s[i] + d[i] or tiny
        forward[i] = d[i] * low[i] / pivot
        s[i + 1] = forward[i] * low[i] * s[i] - value
    p[-1] = d[-1] - value
    for i in range(n - 2, -1, -1):
        pivot = d[i] * low[i] ** 2 + p[i + 1] or tiny
        ratio = d[i] / pivot
        backward[i] = low[i] * ratio
        p[i] = p[i + 1] * ratio - value
    return s + p + value, np.stack([forward, backward])


def _direction(factors: np.ndarray, twist: int) -> np.ndarray:
    """The unit vector that a factorisation twisted at a row sends to that row alone."""
    forward, backward = factors
    z = np.zeros(forward.shape)
    z[twist] = 1.0
    for i in range(twist - 1, -1, -1):
        z[i] = -forward[i] * z[i + 1]
    for i in range(twist, len(z) - 1):
        z[i + 1] = -backward[i] * z[i]
    z /= np.abs(z).max()
    return z / np.linalg.norm(z)


def _apart(z: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):
        for o in others:
            z = z - (o @ z) * o
    return z


def directions(r: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, v): the ``top`` largest squares of singular values of ``r``, falling, and their right unit vectors as columns.

    Values that are zero to double precision are left out. Rows of a bidiagonal block share nothing with those of another, so
    equal values in two of them are orthogonal as they are; close ones of one block are made orthogonal.
    """
    n = len(r)
    if not n or not np.any(r):
        return np.empty(0), np.empty((n, 0))
    size = float(np.abs(r).max())
    a, b, v = bidiagonal(r / size)
    norm = float(np.hypot(np.linalg.norm(a), np.linalg.norm(b)))
    ends = [0, *(np.flatnonzero(np.abs(b) <= n * EPS * norm) + 1).tolist(), n]
    blocks = [(i, j) for i, j in zip(ends, ends[1:])]
    values = [(x, i, j) for i, j in blocks for x in dqds(a[i:j], b[i : j - 1]).tolist()]
    values.sort(key=lambda t: (-t[0], t[1]))
    least = (n * EPS) ** 2 * values[0][0]
    values = [t for t in values[:top] if t[0] > least]
    columns: list[np.ndarray] = []
    for k, (x, i, j) in enumerate(values):
        near = [columns[m][i:j] for m in range(k) if values[m][1] == i and values[m][0] - x <= CLUSTER * x]
        residuals, factors = twisted(a[i:j], b[i : j - 1], x)
        order = np.argsort(np.abs(residuals), kind="stable")
        z = _direction(factors, int(order[0]))
        if near:
            for twist in order[:32]:
                z = _apart(_direction(factors, int(twist)), near)
                if np.linalg.norm(z) > 0.1:
                    break
            z = z / np.linalg.norm(z)
            upper = np.diag(a[i:j]) + np.diag(b[i : j - 1], 1)
            matrix = upper.T @ upper - x * (1 - 4 * EPS) * np.eye(j - i)
            for _ in range(2):
                z = _apart(np.linalg.lstsq(matrix, z, rcond=None)[0], near)
                z = z / np.linalg.norm(z)
        full = np.zeros(n)
        full[i:j] = z
        columns.append(full)
    return np.array([t[0] for t in values]) * size**2, v @ np.array(columns).T


# --- rows ----------------------------------------------------------------------------------------


def whole(column: pa.Array, steps: int, origin: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, x) for each length of vector: the usable rows of a column and their entries as whole numbers."""
    column = column.cast(pa.list_(pa.float64()))
    offsets = column.offsets.to_numpy()
    entries = column.values.to_numpy(zero_copy_only=False).astype(float)
    lengths = np.where(column.is_null().to_numpy(zero_copy_only=False), -1, np.diff(offsets))
    for d in np.unique(lengths[lengths >= 0]).tolist():
        rows = np.flatnonzero(lengths == d)
        part = entries[offsets[rows][:, None] + np.arange(d)]
        usable = (np.abs(part) < LARGEST).all(axis=1)
        yield rows[usable], np.floor(steps * part[usable]).astype(np.int64) + origin


@dataclass(frozen=True)
class Whitening:
    """What the fit list gives: its size, whole sums and floor of means, and for each component direction, spread and share."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    spreads: np.ndarray
    shares: np.ndarray
    steps: int
    origin: int
    identity_error: float = 0.0

    @property
    def floors(self) -> tuple[np.ndarray, np.ndarray]:
        """Means as whole parts and what is left over, in n-ths."""
        pairs = [divmod(s, self.n) for s in self.sums]
        return np.array([p[0] for p in pairs], np.int64), np.array([p[1] for p in pairs], np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        whole_part, rest = self.floors
        return (x - whole_part) - rest / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / self.spreads

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)^2, exact; None where no long can hold it."""
        whole_part, rest = self.floors
        gap = x - whole_part
        most = float(np.abs(gap).max(initial=0)) + 1
        if (most * self.n) ** 2 * max(1, x.shape[1]) < 2.0**62:
            away = self.n * gap - rest
            return (away * away).sum(axis=1).tolist()
        left = rest.tolist()
        found = [sum((self.n * g - r) ** 2 for g, r in zip(row, left)) for row in gap.tolist()]
        return [f if f < 2**63 else None for f in found]


def _rows(batches: Iterator[pa.RecordBatch], d: int, steps: int, origin: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(batch, rows, x) of the usable vectors of ``d`` entries."""
    for piece in chunks(batches):
        for rows, x in whole(piece.column(piece.num_columns - 1), steps, origin):
            if x.shape[1] == d and len(rows):
                yield piece, rows, x


def _sums(vectors: DataFrame, steps: int, origin: int) -> tuple[int, list[int]]:
    """Number of usable vectors of the commonest length (the longer one of two) and their sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}

        def flush() -> pa.RecordBatch:
            out = [pa.array(list(found), pa.int32()), pa.array([f[0] for f in found.values()], pa.int64()), pa.array([f[1].tolist() for f in found.values()], pa.list_(pa.int64()))]
            found.clear()
            return pa.RecordBatch.from_arrays(out, ["d", "n", "sums"])

        for piece in chunks(batches):
            for rows, x in whole(piece.column(0), steps, origin):
                own = found.setdefault(x.shape[1], [0, 0])
                own[0] += len(rows)
                own[1] = own[1] + x.sum(axis=0)
            if len(found) > 64:
                yield flush()
        yield flush()

    parts = stored(vectors.mapInArrow(run, "d int, n long, sums array<long>").where("n > 0"))
    best = parts.groupBy("d").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if best is None:
        return 0, []
    own = parts.where(F.col("d") == best.d).select(F.posexplode("sums").alias("place", "part"))
    return best.n, [row.total for row in own.groupBy("place").agg(F.sum("part").alias("total")).orderBy("place").collect()]


def _triangle(vectors: DataFrame, centre: Whitening) -> np.ndarray:
    """The triangular factor of all centred rows."""
    d = len(centre.sums)

    def reduced(held: np.ndarray, more: np.ndarray) -> np.ndarray:
        r = np.linalg.qr(np.concatenate([held, more]), mode="r")
        return np.concatenate([r, np.zeros((d - len(r), d))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((0, d))
        for _, _, x in _rows(batches, d, centre.steps, centre.origin):
            held = reduced(held, centre.centred(x))
        if len(held):
            out = [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([held.ravel().tolist()], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(out, ["part", "r"])

    meeting = max(2, min(64, MEETING_BYTES // (8 * d * d)))

    def meet(key: tuple, found: pd.DataFrame) -> pd.DataFrame:
        held = np.zeros((0, d))
        for r in found.sort_values("part")["r"]:
            held = reduced(held, np.asarray(r, float).reshape(d, d))
        return pd.DataFrame({"part": [key[0]], "r": [held.ravel()]})

    schema = "part long, r array<double>"
    factors = stored(vectors.mapInArrow(run, schema))
    last = factors.agg(F.max("part")).first()[0] or 0
    while last:
        last //= meeting
        factors = stored(factors.groupBy(F.floor(F.col("part") / meeting).cast("long").alias("group")).applyInPandas(meet, schema))
    return np.asarray(factors.first().r, float).reshape(d, d)


def _identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest entry of the whitened rows' covariance minus the identity."""
    d, k = len(model.sums), len(model.spreads)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((k + 1, k))
        for _, _, x in _rows(batches, d, model.steps, model.origin):
            w = model.whitened(x)
            held += np.concatenate([w.sum(axis=0)[None], w.T @ w])
        yield pa.RecordBatch.from_arrays([pa.array([held.ravel().tolist()], pa.list_(pa.float64()))], ["sums"])

    parts = vectors.mapInArrow(run, "sums array<double>").select(F.posexplode("sums").alias("place", "part"))
    found = parts.groupBy("place").agg(F.sum("part").alias("total")).orderBy("place").collect()
    sums = np.array([row.total for row in found]).reshape(k + 1, k) / model.n
    return float(np.abs(sums[1:] - np.outer(sums[0], sums[0]) - np.eye(k)).max())


def fit(vectors: DataFrame, embedding: str = "embedding", top: int = TOP, steps: int = STEPS, origin: int = ORIGIN) -> Whitening | None:
    """The whitening of all usable vectors; None if there are none.

    Null vectors, and those that hold a null, a number that isn't finite or one beyond ``LARGEST``, are not usable. Vectors
    of another length than the commonest are left out. Repeated rows count each. ``top`` components at most: those of zero spread have no
    whitened form and are left out, so equal vectors alone give none.
    """
    only = vectors.select(F.col(embedding).alias("embedding"))
    n, sums = _sums(only, steps, origin)
    if not n or not sums:
        return None
    empty = np.empty(0)
    centre = Whitening(n, sums, np.empty((len(sums), 0)), empty, empty, steps, origin)
    r = _triangle(only, centre)
    values, v = directions(r, top)
    model = Whitening(n, sums, v, np.sqrt(values / n), values / max(float((r * r).sum()), np.finfo(float).tiny), steps, origin)
    if not len(values):
        return model
    return Whitening(n, sums, v, model.spreads, model.shares, steps, origin, _identity_error(only, model))


def whiten(vectors: DataFrame, model: Whitening | None, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row for each usable vector and component.

    Rows that ``fit`` calls not usable give none. A missing vec_id stays missing, and repeated rows are returned each. Components count from 1 by
    falling spread; deviation, the sum of (n x - S)^2, is NULL where no long can hold it.
    """
    own = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("embedding"))
    kind = own.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.spreads):
        return vectors.sparkSession.createDataFrame([], schema)
    d, k = len(model.sums), len(model.spreads)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, rows, x in _rows(batches, d, model.steps, model.origin):
            m = len(rows)
            again = np.repeat(np.arange(m), k)
            out = [
                piece.column(0).take(pa.array(rows[again])),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, model.n, np.int64)),
                pa.array(model.deviations(x), pa.int64()).take(pa.array(again)),
                pa.array(model.whitened(x).ravel()),
                pa.array(np.tile(model.shares, m)),
                pa.array(np.full(m * k, model.identity_error)),
            ]
            yield pa.RecordBatch.from_arrays(out, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return own.mapInArrow(run, schema)
