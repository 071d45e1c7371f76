"""Whitening by Chebyshev-filtered subspace iteration.

Vectors stay where they are; a pass over them gives V Q for a thin matrix Q, V
being the covariance: every task centres its vectors, multiplies them by Q and
then by themselves, and Spark adds up one row for each dimension. A filter is a
Chebyshev recurrence of such passes that damps the spectrum below the wanted
components. QR and a Rayleigh-Ritz step follow, until the residuals are at the
rounding of the passes, and a Lanczos run on the complement of what was found
shows that no larger eigenvalue was missed. A block that does not settle is
enlarged, at last to all dimensions, where the first step is exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.vectors import floored, in_blocks, usable
from gridloom.session import materialized

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
DEGREE = 8  # passes of one filter
LANCZOS = 10  # passes that estimate an end of the spectrum
ROUNDS = 12  # filters before the block is enlarged
SETTLED = 1e-13  # residual over the largest eigenvalue at which a pair is final
CERTAIN = 1e-9  # and what it must reach at all
RANK = 1e-12  # smaller shares of the trace are no component
_BLOCKS = "ids array<long>, x binary"
_OUT = (
    "vec_id long, component int, n long, deviation long, whitened double, "
    "explained double, identity_error double"
)


class Centred:
    """Vectors of one length, in blocks, and sums over them by passes."""

    def __init__(self, vectors: DataFrame, key: str, vector: str):
        rows = materialized(
            usable(vectors, vector).select(
                F.col(key).cast("long").alias("vec_id"),
                F.expr(floored(vector, SCALE, SHIFT)).alias("x"),
            )
        )
        lengths = rows.groupBy(F.size("x").alias("dims")).count().where("dims > 0")
        most = lengths.orderBy(F.desc("count"), F.desc("dims")).first()
        self.n, self.dims = (most["count"], most["dims"]) if most else (0, 0)
        if not self.n:
            return
        self.blocks = materialized(
            in_blocks(rows.where(F.size("x") == self.dims), self.dims, _BLOCKS, _block)
        )
        whole = self.summed(lambda row, x: x.sum(axis=0)[:, None], self.dims, 1, "long")
        self.sums = whole[:, 0]

    def summed(self, part: Callable, rows: int, columns: int, kind: str = "double") -> np.ndarray:
        """The sum over all blocks of ``part(row, x)``, a matrix of this shape. A
        task sends the sum of its own blocks, one row of the matrix a row."""
        dims = self.dims
        target = np.int64 if kind == "long" else np.float64

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((rows, columns), target)
            for batch in batches:
                for row in batch.to_pylist():
                    total += part(row, np.frombuffer(row["x"], "<i8").reshape(-1, dims))
            cells = {"i": pa.array(range(rows), pa.int32())}
            cells |= {f"c{k}": pa.array(total[:, k]) for k in range(columns)}
            yield pa.RecordBatch.from_pydict(cells)

        names = [f"c{k}" for k in range(columns)]
        schema = ", ".join(["i int", *(f"{c} {kind}" for c in names)])
        found = self.blocks.mapInArrow(add, schema).groupBy("i")
        out = np.zeros((rows, columns), target)
        for row in found.agg(*(F.sum(c).alias(c) for c in names)).collect():  # rows x columns
            out[row["i"]] = [row[c] for c in names]
        return out

    def deviations(self):
        """n * x - S of a block, exact; centred vectors are these over n."""
        n, sums = self.n, self.sums

        def off(x):
            if n * int(np.abs(x).max(initial=0)) >= 1 << 62:
                raise OverflowError("n * x does not fit into whole numbers of 64 bits")
            return n * x - sums

        return off

    def covariance_times(self, q: np.ndarray) -> np.ndarray:
        n, deviations = self.n, self.deviations()

        def part(_, x):
            centred = deviations(x) / n
            return centred.T @ (centred @ q)

        return self.summed(part, self.dims, q.shape[1]) / n

    def trace(self) -> float:
        n, deviations = self.n, self.deviations()
        total = self.summed(lambda _, x: np.square(deviations(x) / n).sum()[None, None], 1, 1)
        return float(total[0, 0]) / n


def _block(others: list, x: np.ndarray) -> dict:
    return {"ids": others[0].to_pylist(), "x": x.astype("<i8").tobytes()}


def lanczos(times: Callable, start: np.ndarray, steps: int) -> tuple[np.ndarray, float]:
    """Ritz values of a Krylov space, and the norm of what it leaves out: ends of
    the spectrum lie at most about that far beyond them."""
    basis = [start / np.linalg.norm(start)]
    diagonal, off = [], []
    rest = 0.0
    for _ in range(min(steps, len(start))):
        w = times(basis[-1][:, None])[:, 0]
        diagonal.append(float(w @ basis[-1]))
        for _ in range(2):  # twice is enough
            w = w - np.array(basis).T @ (np.array(basis) @ w)
        rest = float(np.linalg.norm(w))
        if rest <= 1e-12 * max(map(abs, diagonal)):
            rest = 0.0
            break
        off.append(rest)
        basis.append(w / rest)
    inner = off[: len(diagonal) - 1]
    return np.linalg.eigvalsh(np.diag(diagonal) + np.diag(inner, 1) + np.diag(inner, -1)), rest


def chebyshev_filter(times: Callable, q: np.ndarray, low: float, high: float, degree: int):
    """The Chebyshev polynomial of ``degree`` of the operator on ``q``: at most 1
    inside [low, high] and steeply growing above, scaled to stay finite."""
    centre, half = (low + high) / 2, (high - low) / 2
    before, now = q, (times(q) - centre * q) / half
    for _ in range(degree - 1):
        before, now = now, 2 * (times(now) - centre * now) / half - before
        size = np.abs(now).max()
        before, now = before / size, now / size
    return now


def _ritz(times: Callable, q: np.ndarray):
    """Ritz values (falling), vectors, and residual norms in the span of ``q``."""
    vq = times(q)
    small = q.T @ vq
    values, turn = np.linalg.eigh((small + small.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    vectors = q @ turn
    return values, vectors, np.linalg.norm(vq @ turn - vectors * values, axis=0)


def top_eigenpairs(times: Callable, dims: int, wanted: int, seed: int = 7):
    """The ``wanted`` largest eigenvalues, falling, and unit eigenvectors of a
    symmetric positive semidefinite operator given by ``times(q)``."""
    rng = np.random.default_rng(seed)
    block = min(dims, 3 * wanted)
    ends, rest = lanczos(times, rng.standard_normal(dims), LANCZOS)
    low = max(0.0, float(ends[0]) - rest)
    q = np.linalg.qr(rng.standard_normal((dims, block)))[0]
    while True:
        values, vectors, residuals = _ritz(times, q)
        before = np.inf
        for _ in range(ROUNDS):
            worst = residuals[:wanted].max() / max(values[0], 1e-300)
            if worst <= SETTLED or worst <= CERTAIN and worst > before / 2 or block == dims:
                break
            before = worst
            # an interval of some width, for spectra that are flat or end at 0
            high = max(float(values[-1]), low + 1e-3 * float(values[0]))
            q = chebyshev_filter(times, vectors, low, high, DEGREE)
            q = np.linalg.qr(q)[0]
            values, vectors, residuals = _ritz(times, q)
        found = vectors[:, :wanted]
        if block == dims or worst <= CERTAIN and _complete(times, found, values[wanted - 1], rng):
            return values[:wanted], found
        block = min(dims, 2 * block)
        more = rng.standard_normal((dims, block - vectors.shape[1]))
        q = np.linalg.qr(np.hstack([vectors, more]))[0]


def _complete(times: Callable, found: np.ndarray, least: float, rng) -> bool:
    """Whether the operator has nothing above ``least`` beside ``found``."""

    def rest_of(q):
        q = q - found @ (found.T @ q)
        q = times(q)
        return q - found @ (found.T @ q)

    ends, _ = lanczos(rest_of, rest_of(rng.standard_normal((len(found), 1)))[:, 0], LANCZOS)
    return float(ends[-1]) <= least * (1 + 1e-9)


def whitened_components(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: the
    first principal components of all vectors, each with variance 1.

    Entries count as x = floor(1024 * entry) + 100000. All vectors with finite
    entries are the fit list; null ones and those with a null or non-finite entry
    give no rows, nor do vectors of another length than the most frequent one (the
    longer, at ties), empty ones among them. Repeated rows and keys and null keys
    count and are returned as they come. Components are numbered by falling
    variance, at most as many as dimensions; one without variance (a single
    vector, equal vectors, dependent dimensions) cannot be scaled and is left out.
    Equal variances share their plane in some orthonormal way. The entry of an
    eigenvector that is largest in size is positive. ``deviation`` is an exact
    whole number; where it exceeds 64 bits the job fails. An empty table gives no
    rows; other columns are not read, whatever their names.
    """
    spark = vectors.sparkSession
    data = Centred(vectors, key, vector)
    trace = data.trace() if data.n else 0.0
    if not trace > 0:
        return spark.createDataFrame([], _OUT)
    count = min(components, data.dims)
    values, axes = top_eigenpairs(data.covariance_times, data.dims, count)
    keep = values > RANK * trace
    values, axes = values[keep], axes[:, keep]
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(len(values))])
    n, dims, count, deviations = data.n, data.dims, len(values), data.deviations()
    scaled, share = axes / np.sqrt(values), values / trace

    def whitened(x):
        return deviations(x) / n @ scaled

    mean = data.summed(lambda _, x: whitened(x).sum(axis=0)[:, None], count, 1)[:, 0] / n

    def spread(_, x):
        w = whitened(x) - mean
        return w.T @ w

    error = float(np.abs(data.summed(spread, count, count) / n - np.eye(count)).max())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                x = np.frombuffer(row["x"], "<i8").reshape(-1, dims)
                off = deviations(x)
                if dims * int(np.abs(off).max()) ** 2 >= 1 << 63:
                    off = off.astype(object)  # Arrow refuses a sum beyond 64 bits
                total = np.square(off).sum(axis=1).tolist()
                ids = pa.array(row["ids"], pa.int64())
                each = np.repeat(np.arange(len(x)), count)
                number = np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))
                yield pa.RecordBatch.from_pydict(
                    {
                        "vec_id": ids.take(pa.array(each)),
                        "component": pa.array(number),
                        "n": pa.array(np.full(len(each), n, np.int64)),
                        "deviation": pa.array(total, pa.int64()).take(pa.array(each)),
                        "whitened": pa.array(whitened(x).ravel()),
                        "explained": pa.array(share[number - 1]),
                        "identity_error": pa.array(np.full(len(each), error)),
                    }
                )

    return data.blocks.mapInArrow(rows, _OUT)
