"""Embedding whitening by Chebyshev-filtered subspace iteration.

A component c of a vector counts as the whole number floor(64 c) + 1000000.  The fit list holds
every distinct whole vector once; it is written as blocks of integers, so each pass reads it as
arrays.  Its covariance V is never formed: a pass takes a block Q of `components` + `GUARD`
columns to every block of rows, adds up centred XᵀXQ, and sums the tasks' d rows by dimension,
so the driver gets d rows however many tasks there are.

Each round runs the three-term Chebyshev recurrence, one pass a degree, on the interval of the
unwanted spectrum: from a lower bound of the spectrum (a few Lanczos steps, less their residual)
to the smallest Ritz value of the block.  Values inside are damped, those above grow by the
degree.  The block then gets an orthonormal basis (QR) and is rotated by Rayleigh-Ritz.  Rounds
end when the residual of every wanted pair is certified: |Vq - eq| <= `TOLERANCE` e, or, where
rounding forbids that, no longer shrinks and is at most `ACCEPTED` e + `ROUNDING` e1.  In every round the last guard column is drawn anew, so a direction that the
start missed is found.

Centring is exact: sums are whole numbers, S = n base + rest, and x - S/n = (x - base) - rest/n.

Rows whose vector is null, empty, holds null, NaN, infinite entries or entries of 2**50 and more
take no part, nor do rows of another length than the commonest (of equally common, the longest).
Directions without variance (eigenvalue at most `FLAT` times the largest) have no whitened
values and are left out, so there may be fewer components than asked for, or none.  Rows with
equal ids or vectors get a result each.  `deviation` is null where it does not fit a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from .store import forget, kept, packed, unpacked

COMPONENTS = 16
GUARD = 16
LANCZOS = 8
FIRST_DEGREE, MAX_DEGREE = 8, 32
MAX_ROUNDS = 60
TOLERANCE = 1e-13
ACCEPTED = 1e-10
ROUNDING = 1e-14
FLAT = 1e-12
SPREAD = 1e12
SEED = 12
BLOCK_BYTES = 1 << 22

_SCALE, _SHIFT = 64, 1_000_000
_LARGEST = float(1 << 50)
_LOW_BITS = 24


def whole_numbers(vector: str) -> Column:
    """The vector as whole numbers; null where it takes no part."""
    values = F.col(vector).cast("array<double>")
    sound = F.forall(values, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < _LARGEST))
    whole = F.transform(values, lambda c: F.floor(c * _SCALE) + F.lit(_SHIFT).cast("long"))
    return F.when(sound & (F.size(values) > 0), whole)


def _commonest_length(rows: DataFrame) -> int:
    lengths = rows.groupBy(F.size("_x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return lengths[0].d if lengths else 0


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.int64, copy=False).reshape(-1, dim)


def _blocks(dim: int):
    rows = max(1, BLOCK_BYTES // (8 * dim))

    def task(batches):
        for batch in batches:
            x = _matrix(batch.column("_x"), dim)
            for low in range(0, len(x), rows):
                yield pa.RecordBatch.from_arrays([pa.array([x[low : low + rows].tobytes()], pa.binary())], names=["block"])

    return task


def _read(batch: pa.RecordBatch, dim: int):
    for block in batch.column("block"):
        yield np.frombuffer(block.as_buffer(), np.int64).reshape(-1, dim)


def _sums(dim: int):
    def task(batches):
        total = np.zeros((3, dim), np.int64)
        for batch in batches:
            for x in _read(batch, dim):
                total[0] += len(x)
                total[1] += (x >> _LOW_BITS).sum(axis=0)
                total[2] += (x & (1 << _LOW_BITS) - 1).sum(axis=0)
        if total[0, 0]:
            columns = [pa.array(np.arange(dim)), *[pa.array(t) for t in total]]
            yield pa.RecordBatch.from_arrays(columns, names=["i", "n", "high", "low"])

    return task


def centred(x: np.ndarray, base: np.ndarray, part: np.ndarray) -> np.ndarray:
    """x less its mean, which is `base` + `part`."""
    return (x - base).astype(np.float64) - part


def _products(dim: int, base: np.ndarray, part: np.ndarray, block: np.ndarray):
    def task(batches):
        total, seen = np.zeros(block.shape), False
        for batch in batches:
            for x in _read(batch, dim):
                c, seen = centred(x, base, part), True
                total += c.T @ (c @ block)
        if seen:
            rows = pa.FixedSizeListArray.from_arrays(pa.array(total.ravel()), block.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim)), rows], names=["i", "row"])

    return task


def _traces(dim: int, base: np.ndarray, part: np.ndarray):
    def task(batches):
        total = sum(float(np.square(centred(x, base, part)).sum()) for batch in batches for x in _read(batch, dim))
        yield pa.RecordBatch.from_arrays([pa.array([total])], names=["t"])

    return task


class _Covariance:
    """Products with the covariance of the fit list, a pass over its blocks each."""

    def __init__(self, points: DataFrame, dim: int):
        self.points, self.dim, self.passes = points, dim, 0
        sums = points.mapInArrow(_sums(dim), "i long, n long, high long, low long").groupBy("i")
        found = sorted(sums.agg(F.sum("n").alias("n"), F.sum("high").alias("high"), F.sum("low").alias("low")).collect())
        self.n = found[0].n
        self.sums = [(r.high << _LOW_BITS) + r.low for r in found]
        self.base = np.array([s // self.n for s in self.sums], np.int64)
        self.part = np.array([s % self.n / self.n for s in self.sums])

    def trace(self) -> float:
        parts = self.points.mapInArrow(_traces(self.dim, self.base, self.part), "t double")
        return parts.agg(F.sum("t").alias("t")).first().t / self.n

    def times(self, block: np.ndarray) -> np.ndarray:
        self.passes += 1
        task = _products(self.dim, self.base, self.part, block)
        rows = self.points.mapInArrow(task, "i long, row array<double>").groupBy("i")
        added = rows.agg(F.expr(f"array({', '.join(f'sum(row[{j}])' for j in range(block.shape[1]))}) AS row"))
        product = np.zeros(block.shape)
        for r in added.collect():
            product[r.i] = r.row
        return product / self.n


def _lower_bound(covariance, rng) -> float:
    """A bound below the spectrum: the least Ritz value of a few Lanczos steps, less its residual."""
    steps = min(LANCZOS, covariance.dim)
    basis = [rng.standard_normal(covariance.dim)]
    basis[0] /= np.linalg.norm(basis[0])
    product = []
    for _ in range(steps):
        w = covariance.times(basis[-1][:, None])[:, 0]
        product.append(w)
        q = np.array(basis)
        for _ in range(2):
            w = w - q.T @ (q @ w)
        size = np.linalg.norm(w)
        if size <= 1e-12 * np.linalg.norm(product[-1]):
            break
        basis.append(w / size)
    q, vq = np.array(basis[: len(product)]), np.array(product)
    values, turn = np.linalg.eigh((q @ vq.T + vq @ q.T) / 2)
    ritz = turn[:, 0]
    return max(0.0, values[0] - np.linalg.norm(ritz @ vq - values[0] * (ritz @ q)))


def _rayleigh_ritz(q: np.ndarray, vq: np.ndarray):
    """Values (falling), vectors and their products with V inside the span of `q`."""
    h = q.T @ vq
    values, turn = np.linalg.eigh((h + h.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], q @ turn, vq @ turn


def _filtered(covariance, q, vq, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial of V on `q` that is small on [low, high], scaled to one at `top`."""
    half, centre = (high - low) / 2, (high + low) / 2
    sigma = first = half / (top - centre)
    before, now = q, (vq - centre * q) * (sigma / half)
    for _ in range(degree - 1):
        onward = 1 / (2 / first - sigma)
        after = (covariance.times(now) - centre * now) * (2 * onward / half) - (sigma * onward) * before
        before, now, sigma = now, after, onward
    return now


def _degree(values: np.ndarray, wanted: int, low: float, high: float, need: float, most: int) -> int:
    """The degree at which the last wanted value outgrows the damped ones by `need`.

    Bounded so that the largest value does not outgrow the last wanted by more than `SPREAD`.
    """
    half, centre = (high - low) / 2, (high + low) / 2
    rates = np.arccosh(np.maximum((values[[0, wanted - 1]] - centre) / half, 1 + 1e-12))
    degree = np.log(2 * need) / max(rates[1], 1e-3)
    apart = rates[0] - rates[1]
    if apart > 0:
        degree = min(degree, np.log(SPREAD) / apart)
    return int(np.clip(np.ceil(degree), 2, most))


def leading(covariance, components: int = COMPONENTS, guard: int = GUARD, seed: int = SEED):
    """The leading eigenpairs (values falling, vectors as columns), certified by their residuals."""
    rng, dim = np.random.default_rng(seed), covariance.dim
    width = min(dim, components + guard)
    low = _lower_bound(covariance, rng) if width < dim else 0.0
    q = np.linalg.qr(rng.standard_normal((dim, width)))[0]
    best = np.inf
    for turn in range(MAX_ROUNDS):
        values, q, vq = _rayleigh_ritz(q, covariance.times(q))
        if values[0] <= 0:
            return values[:0], q[:, :0]
        wanted = max(1, int((values[:components] > FLAT * values[0]).sum()))
        residuals = np.linalg.norm(vq[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0)
        error = float((residuals / np.maximum(values[:wanted], FLAT * values[0])).max())
        # rounding in a product is relative to the largest value: no residual falls below that
        settled = (residuals <= ACCEPTED * values[:wanted] + ROUNDING * values[0]).all()
        if error <= TOLERANCE or (settled and error > best / 2):
            keep = values[:wanted] > FLAT * values[0]
            return values[:wanted][keep], q[:, :wanted][:, keep]
        best = min(best, error)
        low = min(low, max(values[-1], 0.0))
        # the least Ritz value is that of the column drawn anew
        high = max(values[max(wanted, width - 2) if width > wanted else -1], low + 1e-9 * values[0])
        # the Ritz values of the random start say little about the cut
        most = MAX_DEGREE if turn else FIRST_DEGREE
        degree = _degree(values, wanted, low, high, 10 * error / TOLERANCE, most)
        # equal values outgrow nothing; the block then turns inside their common space only
        top = max(values[0], high * (1 + 1e-9))
        y = _filtered(covariance, q, vq, low, high, top, degree)
        y /= np.maximum(np.linalg.norm(y, axis=0), 1e-300)
        y[:, -1] = rng.standard_normal(dim)
        q = np.linalg.qr(y)[0]
    raise RuntimeError(f"eigenpairs are not certified after {MAX_ROUNDS} rounds: residual {best:.1e}")


def _whiten(dim: int, n: int, sums: list[int], base, part, scaled: np.ndarray):
    rest = np.array([s - n * int(b) for s, b in zip(sums, base)], np.int64)

    def task(batches):
        for batch in batches:
            x = _matrix(batch.column("_x"), dim)
            white = centred(x, base, part) @ scaled
            about = np.square((x - base).astype(np.float64) * n - rest).sum(axis=1)
            fits = about < 2.0**62
            exact = np.where(fits[:, None], x - base, 0) * np.int64(n) - rest
            deviation = np.square(exact).sum(axis=1)
            rows = pa.FixedSizeListArray.from_arrays(pa.array(white.ravel()), white.shape[1]).cast(pa.list_(pa.float64()))
            columns = [batch.column("_doc"), pa.array(deviation, pa.int64(), mask=~fits), rows]
            yield pa.RecordBatch.from_arrays(columns, names=["_doc", "deviation", "_white"])

    return task


def whiten(
    rows: DataFrame,
    vector_column: str = "embedding",
    carry: list[str] | None = None,
    components: int = COMPONENTS,
    guard: int = GUARD,
) -> DataFrame:
    """A row per row that takes part and component, with the columns of `rows` (or `carry`) and

    `component` (from 1, by falling variance), `n` (size of the fit list), `deviation` (squared
    distance from the mean, times n squared), `whitened`, `explained` (share of all variance) and
    `identity_error` (largest entry of |covariance of the whitened fit list - identity|, from
    another pass over it).  These replace columns of the same name.
    """
    wanted = rows.select(*[f"`{c}`" for c in carry or rows.columns])
    named = rows.select(F.col(f"`{vector_column}`").alias("_v"), F.struct(*[F.col(f"`{c}`") for c in wanted.columns]).alias("_doc"))
    sound = named.select("_doc", whole_numbers("_v").alias("_x")).where("_x is not null")
    added = ("component", "n", "deviation", "whitened", "explained", "identity_error")
    dim = _commonest_length(sound)
    sound = sound.where(F.size("_x") == dim)
    values = []
    if dim:
        points = kept(sound.select("_x").distinct().mapInArrow(_blocks(dim), "block binary"), "points")
        covariance = _Covariance(points, dim)
        values, vectors = leading(covariance, min(components, dim), guard)
    if not len(values):
        types = "component int, n long, deviation long, whitened double, explained double, identity_error double"
        none = packed(wanted).limit(0).select("_doc", *[F.lit(None).cast(t.split()[1]).alias(t.split()[0]) for t in types.split(", ")])
        return unpacked(none, wanted, *added)
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    scaled = vectors / np.sqrt(values)
    identity = float(np.abs(scaled.T @ covariance.times(scaled) - np.eye(len(values))).max())
    explained = values / covariance.trace()
    forget(points)

    layout = named.select("_doc").schema.add("deviation", "long").add("_white", ArrayType(DoubleType()))
    task = _whiten(dim, covariance.n, covariance.sums, covariance.base, covariance.part, scaled)
    white = sound.mapInArrow(task, layout).select("_doc", "deviation", F.posexplode("_white").alias("_at", "whitened"))
    shares = F.array(*[F.lit(float(s)) for s in explained])
    result = white.select(
        "_doc",
        (F.col("_at") + 1).alias("component"),
        F.lit(covariance.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("_at")).alias("explained"),
        F.lit(identity).alias("identity_error"),
    )
    return unpacked(result, wanted, *added)
