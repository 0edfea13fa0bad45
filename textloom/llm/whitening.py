"""Whitening of vectors through singular values of their centred rows.

Entries become whole numbers, so that counts, sums and deviations are exact. The fit uses each
distinct vector once. Its centred rows are never multiplied with each other as a whole: every task reduces
its rows, block by block, to a triangle R by QR, and triangles are stacked and reduced again until one is
left, whose singular values are those of all rows. The rest is as small as R: Householder reflections make
it bidiagonal, differential quotient-difference steps with shifts (dqds) find the squared singular values
to high relative accuracy, and for each of them a twisted factorisation of the tridiagonal product gives
the direction, taken where the two halves of the factorisation meet with the least remainder.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField, StructType

from textloom.llm.common import default_parallelism, stored

#: An entry c becomes floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Numbers of a block of rows.
BLOCK = 1 << 20
#: Eigenvalues nearer than this share of themselves form a cluster, whose directions are made orthogonal.
CLUSTER = 1e-5
_EPS = np.finfo(float).eps


def whole(vector: Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """The vector in whole numbers; null if it is null, empty, or holds null or an entry that is not finite."""
    as_double = F.transform(vector, lambda c: c.cast("double"))
    sound = F.forall(as_double, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when((F.size(vector) > 0) & sound, F.transform(as_double, lambda c: F.floor(c * scale).cast("bigint") + shift))


@dataclass(frozen=True)
class Whitening:
    """n vectors with sums per dimension; eigenvalues of their covariance, falling; directions as columns."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    directions: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float]:
        return (self.values / self.trace).tolist()

    def apply(self, x: np.ndarray) -> np.ndarray:
        return _centred(x, self.n, self.sums) @ (self.directions / np.sqrt(self.values))

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - sums)^2, exact; None where 64 bits cannot hold it."""
        base = np.array([s // self.n for s in self.sums])
        rest = np.array([s % self.n for s in self.sums])
        reach = self.n * (float(np.abs(x - base).max(initial=0)) + 1)
        if reach * reach * len(self.sums) < 2.0 ** 62:
            d = self.n * (x - base) - rest
            return (d * d).sum(axis=1).tolist()
        found = [sum((self.n * int(v) - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x]
        return [v if v < 1 << 63 else None for v in found]


def _centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """x - sums / n, with the whole part of the mean taken off before anything is rounded."""
    return (x - np.array([s // n for s in sums])) - np.array([s % n / n for s in sums])


def _rows(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def _blocks(x: np.ndarray) -> Iterator[np.ndarray]:
    step = max(1, BLOCK // max(1, x.shape[1]))
    yield from (x[k:k + step] for k in range(0, len(x), step))


def _sums(table: DataFrame, d: int) -> tuple[int, tuple[int, ...]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(d, np.int64)
        for b in batches:
            x = _rows(b.column(0), d)
            n, total = n + len(x), total + x.sum(axis=0)
        if n:
            yield pa.record_batch([pa.array(np.append(np.arange(d), -1)), pa.array(np.append(total, n))], ["at", "v"])

    found = {r["at"]: r["v"] for r in table.mapInArrow(run, "at bigint, v bigint").groupBy("at").agg(F.sum("v").alias("v")).collect()}
    return found[-1], tuple(found[k] for k in range(d))


def triangle(table: DataFrame, d: int, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """R of the QR factorisation of all centred rows."""
    def reduced(r: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.linalg.qr(np.vstack([r, rows]), mode="r")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for b in batches:
            for x in _blocks(_rows(b.column(0), d)):
                r = reduced(r, _centred(x, n, sums))
        if len(r):
            yield pa.record_batch([pa.array([r.tobytes()], pa.binary())], ["r"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, d))
        for b in batches:
            for cell in b.column(0):
                r = reduced(r, np.frombuffer(cell.as_buffer(), np.float64).reshape(-1, d))
        if len(r):
            yield pa.record_batch([pa.array([r.tobytes()], pa.binary())], ["r"])

    found = table.mapInArrow(first, "r binary")
    # Stacks of stacks: no task reduces more than some dozens of triangles.
    for parts in (4096, 64, 1):
        if parts < 64 or default_parallelism(table.sparkSession) > parts:
            found = found.repartition(parts).mapInArrow(merge, "r binary")
    r = np.zeros((d, d))
    last = np.frombuffer(found.first()["r"], np.float64).reshape(-1, d)
    r[:len(last)] = last
    return r


def bidiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, upper neighbours and right factor w of u' a w, by Householder reflections from both sides."""
    a, d = a.copy(), a.shape[1]
    w = np.eye(d)

    def mirror(x: np.ndarray) -> tuple[np.ndarray, float]:
        size = float(np.linalg.norm(x))
        v = x.copy()
        if size == 0:
            return v, 0.0
        v[0] += np.copysign(size, x[0])
        return v, 2.0 / float(v @ v)

    for k in range(d):
        v, beta = mirror(a[k:, k])
        a[k:, k:] -= beta * np.outer(v, v @ a[k:, k:])
        if k + 2 <= d - 1:
            v, beta = mirror(a[k, k + 1:])
            a[k:, k + 1:] -= beta * np.outer(a[k:, k + 1:] @ v, v)
            w[:, k + 1:] -= beta * np.outer(w[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), w


def _dqds(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One step on q (squared diagonal) and e (squared neighbours): both anew, and the values d on the way."""
    n, d = len(q), q[0] - shift
    qq, ee, steps = [0.0] * n, [0.0] * (n - 1), [d]
    for i in range(n - 1):
        qq[i] = d + e[i]
        if qq[i] == 0.0:
            d = q[i + 1] - shift
        else:
            t = q[i + 1] / qq[i]
            ee[i], d = e[i] * t, d * t - shift
        steps.append(d)
    qq[-1] = d
    return qq, ee, steps


def squared_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of a bidiagonal matrix, falling.

    A step without shift gives in d the reciprocals of the diagonal of the inverse product, so one over the sum
    of 1/d is a shift that never passes the least value, and takes at least its n-th part away.
    """
    q, e = [float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in above]
    found: list[float] = []
    waiting = [(q, e, 0.0)] if q else []
    while waiting:
        q, e, taken = waiting.pop()
        while len(q) > 1:
            small = [k for k in range(len(e)) if e[k] <= _EPS * _EPS * (taken + min(q[k], q[k + 1])) or e[k] < 1e-290]
            if small:
                k = small[-1]
                waiting.append((q[:k + 1], e[:k], taken))
                q, e = q[k + 1:], e[k + 1:]
                continue
            if q[0] < q[-1]:  # the least values go to the end
                q, e = q[::-1], e[::-1]
            q, e, d = _dqds(q, e, 0.0)
            shift = 1.0 / sum(1.0 / x for x in d) if min(d) > 1e-290 else 0.0
            while shift > 0:
                trial = _dqds(q, e, shift)
                if min(trial[2]) >= 0:
                    q, e, taken = trial[0], trial[1], taken + shift
                    break
                shift = shift * 0.5 if shift > _EPS * taken else 0.0
        found.append(q[0] + taken)
    return np.array(sorted(found, reverse=True))


class Twisted:
    """Both factorisations of the tridiagonal product less a value, which meet in a twist."""

    def __init__(self, diagonal: np.ndarray, above: np.ndarray, value: float) -> None:
        n = len(diagonal)
        tiny = max(float(np.abs(diagonal).max(initial=0)), float(np.abs(above).max(initial=0)), 1e-150) * _EPS
        b = np.where(np.abs(diagonal) < tiny, tiny, diagonal)
        d, l = b * b, above / b[:-1]  # noqa: E741
        least = tiny * tiny * _EPS
        self.down, self.low = np.empty(n), np.empty(n - 1)
        s, remainder = np.empty(n), -value
        for i in range(n):
            s[i] = remainder
            self.down[i] = remainder + d[i]
            if abs(self.down[i]) < least:
                self.down[i] = least
            if i < n - 1:
                self.low[i] = d[i] * l[i] / self.down[i]
                remainder = self.low[i] * l[i] * remainder - value
        self.up = np.empty(n - 1)
        p = np.empty(n)
        p[-1] = d[-1] - value
        for i in range(n - 2, -1, -1):
            under = d[i] * l[i] * l[i] + p[i + 1]
            if abs(under) < least:
                under = least
            self.up[i] = l[i] * d[i] / under
            p[i] = p[i + 1] * d[i] / under - value
        self.gamma = s + p + value

    def vector(self) -> np.ndarray:
        r = int(np.argmin(np.abs(self.gamma)))
        z = np.zeros(len(self.gamma))
        z[r] = 1.0
        for i in range(r - 1, -1, -1):
            z[i] = -self.low[i] * z[i + 1]
        for i in range(r, len(z) - 1):
            z[i + 1] = -self.up[i] * z[i]
        return z / np.linalg.norm(z)

    def solve(self, x: np.ndarray) -> np.ndarray:
        """The product less the value, inverted, by the factorisation from the top."""
        y = x.copy()
        for i in range(len(y) - 1):
            y[i + 1] -= self.low[i] * y[i]
        y /= self.down
        for i in range(len(y) - 2, -1, -1):
            y[i] -= self.low[i] * y[i + 1]
        return y / np.linalg.norm(y)


def directions(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """Unit eigenvectors of the product for the first `count` values. In a cluster a vector is freed of those before it;
    where nothing certain is left, as for equal values, inverse iteration from another start gives one."""
    out, rng, start = np.zeros((len(diagonal), count)), np.random.default_rng(3), 0
    for k in range(count):
        if k and values[k - 1] - values[k] > CLUSTER * values[k - 1]:
            start = k
        factors = Twisted(diagonal, above, float(values[k]))
        before = out[:, start:k]
        free = lambda z: z - before @ (before.T @ z)  # noqa: B023, E731
        z = free(free(factors.vector()))
        if np.linalg.norm(z) < 0.1:
            z = rng.normal(size=len(z))
            for _ in range(4):
                z = free(z)
                z = factors.solve(z / np.linalg.norm(z))
            z = free(free(z))
        out[:, k] = z / np.linalg.norm(z)
    return out


def fit(table: DataFrame, components: int) -> Whitening | None:
    """The whitening of the rows of `table`, one column x of whole vectors of one length; None without rows.

    Directions in which the rows do not differ, up to rounding, cannot be whitened and are left out.
    """
    d = table.select(F.size("x").alias("d")).first()
    if d is None:
        return None
    n, sums = _sums(table, d["d"])
    r = triangle(table, d["d"], n, sums)
    diagonal, above, w = bidiagonal(r)
    squared = squared_values(diagonal, above)
    # The trace as a sum of squares of R, so that it holds what is not among the components too.
    trace = float((r * r).sum()) / n
    certain = int((squared > (squared[0] * len(squared) * _EPS) * 16 * _EPS * len(squared)).sum()) if squared[0] > 0 else 0
    count = min(components, certain)
    return Whitening(n, sums, squared[:count] / n, w @ directions(diagonal, above, squared, count), trace)


def identity_error(table: DataFrame, model: Whitening) -> float | None:
    """The largest entry, without sign, of the covariance of the whitened rows less the identity."""
    k, d = len(model.values), len(model.sums)
    if not k:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for b in batches:
            for x in _blocks(_rows(b.column(0), d)):
                w = model.apply(x)
                total += np.vstack([w.sum(axis=0), w.T @ w])
        yield pa.record_batch([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["at", "v"])

    found = table.mapInArrow(run, "at bigint, v double").groupBy("at").agg(F.sum("v").alias("v")).orderBy("at").collect()
    total = np.array([r["v"] for r in found]).reshape(k + 1, k) / model.n
    return float(np.abs(total[1:] - np.outer(total[0], total[0]) - np.eye(k)).max())


RESULT = [StructField("n", LongType()), StructField("deviation", LongType()), StructField("whitened", ArrayType(DoubleType())),
          StructField("explained", ArrayType(DoubleType())), StructField("identity_error", DoubleType())]


def whiten(df: DataFrame, vector: str = "embedding", components: int = 16, scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """The rows of `df` that take part, with n, deviation, whitened, explained and identity_error.

    Rows whose vector is null or empty, or holds null or an entry that is not finite, take no part; nor do
    those whose length is not the most frequent one (of equally frequent ones the shortest). Repeated rows
    stay, but each distinct vector is fitted once. whitened and explained have one entry per component, at
    most `components`, and fewer where the vectors fill fewer directions: none for a single distinct vector.
    Signs of components are free, but one for all rows. deviation is null where 64 bits cannot hold it. An
    empty table gives an empty result. Columns named like a result are replaced.
    """
    kept = [f for f in df.schema.fields if f.name not in {r.name for r in RESULT}]
    # In a struct of its own, the caller's columns meet no name of these.
    rows = df.select(whole(F.col(vector), scale, shift).alias("x"), F.struct(*[F.col(f"`{f.name}`") for f in kept]).alias("row"))
    rows = rows.where("x IS NOT NULL")
    distinct = stored(rows.select("x").distinct(), "whitening-vectors")
    lengths = distinct.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), "d").first()
    d = lengths["d"] if lengths else 0
    distinct, rows = distinct.where(F.size("x") == d), rows.where(F.size("x") == d)
    model = fit(distinct, components)
    error = identity_error(distinct, model) if model else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows or model is None:
                continue
            x = _rows(b.column(0), d)
            w, size, k = model.apply(x), b.num_rows, len(model.values)
            ends = pa.array(np.arange(size + 1, dtype=np.int32) * k)
            found = [pa.array(np.full(size, model.n)), pa.array(model.deviation(x), pa.int64()),
                     pa.ListArray.from_arrays(ends, pa.array(w.ravel(), pa.float64())),
                     pa.ListArray.from_arrays(ends, pa.array(model.explained * size, pa.float64())),
                     pa.array([error] * size, pa.float64())]
            yield pa.record_batch([*b.column(1).flatten(), *found], [*(f.name for f in kept), *(f.name for f in RESULT)])

    return rows.mapInArrow(run, StructType([*kept, *RESULT]))
