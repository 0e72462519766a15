"""Whitening of embeddings along leading components found by spectrum slicing.

The covariance of the distinct vectors is summed on Spark; the rest works on that one
matrix, whose size depends on the dimensions alone. An LDL' factorisation of
``V - s I`` has as many negative pivots as V has eigenvalues below s (Sylvester's law of
inertia). Halving intervals by that count isolates the k-th largest eigenvalue, Rayleigh
quotient iteration then converges cubically to it, and the counts on both sides of the
result certify that it is the k-th. An interval that cannot be split any more holds a
multiple eigenvalue; its vectors are kept orthogonal to each other.

Defined results. Rows whose vector is null, or holds null or non-finite entries, or an
entry whose 256-fold leaves a long, take no part, nor do vectors of another length than the
most frequent one (of equally frequent ones the smallest). Repeated rows are returned as often as they
stand. Components whose eigenvalue is zero up to rounding cannot be scaled to one and are
left out, so fewer than four come out for few dimensions or few distinct vectors.
``deviation`` is null where it exceeds a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written

SCALE = 256
COMPONENTS = 4
ZERO = 1e-12               # eigenvalues below this share of the trace count as zero
_LONG = float(1 << 62)


def negative_pivots(matrix: np.ndarray) -> int:
    """Negative eigenvalues of a symmetric matrix, by LDL' with 1 x 1 and 2 x 2 pivots."""
    a = np.array(matrix, float)
    n, below, k = len(a), 0, 0
    alpha = (1 + np.sqrt(17)) / 8       # the pivot choice of Bunch and Kaufman bounds the growth
    tiny = np.finfo(float).tiny
    while k < n:
        size, swap = 1, k
        if k < n - 1:
            column = np.abs(a[k + 1:, k])
            r = k + 1 + int(column.argmax())
            most = column[r - k - 1]
            if max(most, abs(a[k, k])) > 0 and abs(a[k, k]) < alpha * most:
                row = np.abs(a[r, k:])
                row[r - k] = 0
                other = row.max()
                if abs(a[k, k]) * other >= alpha * most * most:
                    pass
                elif abs(a[r, r]) >= alpha * other:
                    swap = r
                else:
                    size, swap = 2, r
        at = k + size - 1
        if swap != at:
            a[[at, swap], k:] = a[[swap, at], k:]
            a[:, [at, swap]] = a[:, [swap, at]]
        if size == 1:
            pivot = a[k, k]
            below += pivot < 0
            if abs(pivot) > tiny and k < n - 1:
                step = a[k + 1:, k] / pivot
                a[k + 1:, k + 1:] -= np.outer(step, a[k, k + 1:])
        else:
            block = a[k:k + 2, k:k + 2]
            det, trace = block[0, 0] * block[1, 1] - block[0, 1] * block[1, 0], block[0, 0] + block[1, 1]
            below += 1 if det < 0 else 2 * (trace < 0)
            if k < n - 2:
                a[k + 2:, k + 2:] -= a[k + 2:, k:k + 2] @ np.linalg.solve(block, a[k:k + 2, k + 2:])
        k += size
    return int(below)


def _slice(matrix: np.ndarray, k: int, width: float) -> tuple[float, float]:
    """An interval (low, high] with the k-th largest eigenvalue alone, or one narrower than ``width``."""
    n = len(matrix)
    radius = np.abs(matrix).sum(1).max()
    low, high = -radius - width, radius + width
    above_low, above_high = n, 0                  # eigenvalues above each end
    while above_low - above_high > 1 and high - low > width:
        middle = (low + high) / 2
        above = n - negative_pivots(matrix - middle * np.eye(n))
        if above >= k:
            low, above_low = middle, above
        else:
            high, above_high = middle, above
    return low, high


def _narrowed(matrix: np.ndarray, k: int, low: float, high: float) -> tuple[float, float]:
    middle = (low + high) / 2
    if len(matrix) - negative_pivots(matrix - middle * np.eye(len(matrix))) >= k:
        return middle, high
    return low, middle


def _solve(matrix: np.ndarray, shift: float, b: np.ndarray, scale: float) -> np.ndarray:
    """The direction of (matrix - shift I)^-1 b; a singular shift is moved by a rounding error."""
    for nudge in (0.0, 4 * np.finfo(float).eps * scale, 1e-13 * scale):
        try:
            x = np.linalg.solve(matrix - (shift + nudge) * np.eye(len(matrix)), b)
        except np.linalg.LinAlgError:
            continue
        size = np.linalg.norm(x)
        if np.isfinite(size) and size > 0:
            return x / size
    return b


def leading_pairs(matrix: np.ndarray, most: int = COMPONENTS) -> list[tuple[float, np.ndarray]]:
    """Up to ``most`` (eigenvalue, unit vector) pairs by falling eigenvalue, zero ones left out."""
    n, trace = len(matrix), float(np.trace(matrix)) if len(matrix) else 0.0
    pairs: list[tuple[float, np.ndarray]] = []
    if not n or not trace > 0:
        return pairs
    width = 64 * np.finfo(float).eps * trace
    for k in range(1, min(most, n) + 1):
        low, high = _slice(matrix, k, width)
        if high <= ZERO * trace:
            break
        x = np.cos(np.arange(1, n + 1) * (k + 0.5))       # any start that is not orthogonal to the vector
        while True:
            found = _rayleigh(matrix, x, low, high, [v for _, v in pairs], trace)
            if found is not None or high - low <= width:
                break
            low, high = _narrowed(matrix, k, low, high)
        value, x = found if found is not None else _inverse(matrix, x, (low + high) / 2, [v for _, v in pairs], trace)
        if value <= ZERO * trace:
            break
        slack = 1e-10 * trace
        above = n - negative_pivots(matrix - (value + slack) * np.eye(n))
        upto = n - negative_pivots(matrix - (value - slack) * np.eye(n))
        if not above < k <= upto:
            raise ArithmeticError(f"eigenvalue {value} is not number {k}: {above} above, {upto} up to it")
        pairs.append((value, x))
    return pairs


def _apart(x: np.ndarray, known: list[np.ndarray]) -> np.ndarray:
    """Unit vector along what of ``x`` is orthogonal to the known ones."""
    for _ in range(2):
        for v in known:
            x = x - (v @ x) * v
    return x / np.linalg.norm(x)


def _inverse(matrix, x, shift, known, scale):
    for _ in range(6):
        x = _apart(_solve(matrix, shift, _apart(x, known), scale), known)
    return float(x @ matrix @ x), x


def _rayleigh(matrix, x, low, high, known, scale):
    """Rayleigh quotient iteration that must stay in (low, high]; None if it leaves."""
    _, x = _inverse(matrix, x, (low + high) / 2, known, scale)
    for _ in range(12):
        value = float(x @ matrix @ x)
        if not low < value <= high:
            return None
        if np.linalg.norm(matrix @ x - value * x) <= 8 * np.finfo(float).eps * scale:
            return value, x
        x = _apart(_solve(matrix, value, x, scale), known)
    return None


def usable(vectors: DataFrame, vector: str = "embedding") -> tuple[DataFrame, int]:
    """Rows that take part with ``__x``, the scaled integers, and their number of dimensions."""
    v = F.transform(F.col(vector), lambda c: F.floor(c.cast("double") * SCALE))
    good = F.col(vector).isNotNull() & F.forall(
        vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double") * SCALE) < F.lit(_LONG)), F.lit(False)))
    rows = vectors.where(good)
    lengths = rows.groupBy(F.size(vector).alias("d")).count().orderBy(F.desc("count"), "d").head(1)
    d = lengths[0]["d"] if lengths else 0
    return rows.where(F.size(vector) == d).withColumn("__x", v), d


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return np.asarray(batch.column("__x").flatten(), np.int64).reshape(len(batch), d)


def _added(parts: DataFrame, value: str) -> dict[int, list]:
    """Sum of arrays per ``row``; the parts of a task are one row each, so a group has one per task."""
    def add(pdf):
        pdf = pdf.sort_values("task")
        total = np.sum(np.stack(pdf[value].to_numpy()), axis=0)
        return pdf.head(1).assign(**{value: [total.tolist()]})

    return {r["row"]: r[value] for r in parts.groupBy("row").applyInPandas(add, parts.schema).collect()}


def integer_sums(distinct: DataFrame, d: int) -> tuple[int, list[int]]:
    """(n, S): how many vectors, and the exact sum of each dimension."""
    def add(batches):
        n, total = 0, [0] * d
        for batch in batches:
            x = _matrix(batch, d)
            most = int(np.abs(x).max(initial=0))
            small = most * max(1, len(x)) < 1 << 62
            total = [t + int(s) for t, s in zip(total, x.sum(0) if small else x.astype(object).sum(0))]
            n += len(x)
        yield pa.RecordBatch.from_pydict({"dim": pa.array([*range(d), d], pa.int32()), "s": pa.array([str(t) for t in [*total, n]])})

    sums = distinct.select("__x").mapInArrow(add, "dim int, s string").groupBy("dim").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    got = {r["dim"]: int(r["s"]) for r in sums.collect()}
    return got.get(d, 0), [got.get(i, 0) for i in range(d)]


def _second_moments(distinct: DataFrame, mean: np.ndarray, along: np.ndarray | None = None) -> np.ndarray:
    """Sum of the outer products of the centred vectors, or of their projections on ``along``."""
    d, size = len(mean), len(mean) if along is None else along.shape[1]

    def add(batches):
        total = np.zeros((size, size))
        for batch in batches:
            y = _matrix(batch, d) - mean
            y = y if along is None else y @ along
            total += y.T @ y
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_pydict({"task": pa.array([task] * size, pa.int32()), "row": pa.array(range(size), pa.int32()),
                                          "part": pa.array(list(total), pa.list_(pa.float64()))})

    rows = _added(distinct.select("__x").mapInArrow(add, "task int, row int, part array<double>"), "part")
    return np.array([rows.get(i, [0.0] * size) for i in range(size)])


class Whitening:
    """Mean, components and scales that were fitted; ``transform`` applies them."""

    def __init__(self, distinct: DataFrame, d: int, components: int = COMPONENTS):
        self.d = d
        self.n, self.sums = integer_sums(distinct, d)
        self.mean = np.array([s / self.n for s in self.sums]) if self.n else np.zeros(d)
        covariance = _second_moments(distinct, self.mean) / self.n if self.n and d else np.zeros((0, 0))
        covariance = (covariance + covariance.T) / 2
        pairs = leading_pairs(covariance, components)
        self.values = np.array([e for e, _ in pairs])
        self.trace = float(np.trace(covariance)) if len(covariance) else 0.0
        self.along = np.array([v / np.sqrt(e) for e, v in pairs]).T if pairs else np.zeros((d, 0))
        self.identity_error = 0.0
        if pairs:
            white = _second_moments(distinct, self.mean, self.along) / self.n
            self.identity_error = float(np.abs(white - np.eye(len(pairs))).max())

    def transform(self, rows: DataFrame, keep: tuple[str, ...] = ("vec_id",)) -> DataFrame:
        """One row per row and component: ``keep``, component, n, deviation, whitened, explained, identity_error."""
        model, d, k = self, self.d, len(self.values)
        schema = rows.select(*keep).schema
        for name, kind in (("component", "integer"), ("n", "long"), ("deviation", "long"), ("whitened", "double"),
                           ("explained", "double"), ("identity_error", "double")):
            schema = schema.add(name, kind)

        def run(batches):
            for batch in batches:
                x = _matrix(batch, d)
                white = (x - model.mean) @ model.along
                m = len(x) * k
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(pa.array(np.repeat(np.arange(len(x)), k))) for c in keep),
                     pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                     pa.array(np.full(m, model.n, np.int64)),
                     pa.array([v for v in model.deviations(x) for _ in range(k)], pa.int64()),
                     pa.array(white.ravel()), pa.array(np.tile(model.values / (model.trace or 1.0), len(x))),
                     pa.array(np.full(m, model.identity_error))], names=schema.names)

        return rows.select(*keep, "__x").mapInArrow(run, schema)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exact."""
        if not x.size:
            return [0] * len(x)
        far = self.n * int(np.abs(x).max()) + max(abs(s) for s in self.sums)
        if far * far * self.d < 1 << 62:
            gap = self.n * x - np.array(self.sums, np.int64)
            return (gap * gap).sum(1).tolist()
        out = [sum((self.n * a - s) ** 2 for a, s in zip(row, self.sums)) for row in x.tolist()]
        return [v if v < 1 << 63 else None for v in out]


def fit(rows: DataFrame, d: int, components: int = COMPONENTS) -> Whitening:
    """Fitted on each distinct ``__x`` once."""
    return Whitening(written(rows.select("__x").distinct(), "whitening-fit"), d, components)


def op13_spectrum_slicing(spark, sf_dir: str) -> DataFrame:
    rows, d = usable(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))
    return fit(rows, d).transform(rows)
