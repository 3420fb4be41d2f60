"""Embedding whitening by Chebyshev-filtered subspace iteration.

Vectors become whole numbers and are packed into blocks once. Every product with the covariance is
one pass over the blocks: each task adds up (X - mean)ᵀ((X - mean) Q) of its blocks for the few
columns of Q, and only such sums come to the driver; the covariance itself is never formed. A
short Lanczos run bounds the spectrum. Then a Chebyshev polynomial of the covariance, by its
three-term recurrence, damps the unwanted part of the spectrum in a block of columns, QR and
Rayleigh-Ritz turn the block, and its smallest Ritz value is the next edge of the unwanted part,
until the residuals of the wanted components certify them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chirplake.llm.common import checkpoint

COMPONENTS = 8
SCALE, SHIFT = 1024.0, 100_000
# Entries whose scaled value is beyond this are dropped like infinite ones: sums of a block stay exact.
LARGEST = float(1 << 52)
# Columns of the block beyond the wanted ones, as a share of the wanted and at least.
EXTRA_COLUMNS = 16
DEGREE = 10
LANCZOS_STEPS = 8
MOST_ROUNDS = 60
# Residual over the largest eigenvalue: certified below the first; below the second, if rounding
# lets it shrink no further.
CERTIFIED, AT_ROUNDING = 1e-14, 1e-11
# Eigenvalues below this share of the largest count as zero, and their components have no scale.
NO_VARIANCE = 1e-12
# A pass has tasks of this many bytes of blocks, and smaller ones while cores would idle.
TASK_BYTES, LEAST_TASK_BYTES = 64 << 20, 1 << 20
PARTIALS_TO_DRIVER = 256

_BLOCK = "dim int, n long, width int, ids array<bigint>, x binary"
_RESULT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors of a batch as one block for each length: whole numbers, one row after the other."""
    for batch in batches:
        ids, vectors = batch.column("id"), batch.column("vector")
        chosen = np.flatnonzero(vectors.is_valid().to_numpy(zero_copy_only=False))
        lists = vectors.take(pa.array(chosen))
        offsets = lists.offsets.to_numpy()
        # An entry that is null reads as NaN, so one test finds both.
        values = lists.values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
        lengths = np.diff(offsets)
        for dim in np.unique(lengths[lengths > 0]):
            rows = np.flatnonzero(lengths == dim)
            entries = values[offsets[rows][:, None] + np.arange(dim)]
            with np.errstate(over="ignore", invalid="ignore"):
                scaled = np.floor(entries * SCALE)
                good = (np.abs(scaled) < LARGEST).all(axis=1)
            if not good.any():
                continue
            x = scaled[good].astype(np.int64) + SHIFT
            width = 4 if np.abs(x).max() < 1 << 31 else 8
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([int(dim)], pa.int32()),
                    pa.array([len(x)], pa.int64()),
                    pa.array([width], pa.int32()),
                    pa.array([ids.take(pa.array(chosen[rows[good]])).to_pylist()], pa.list_(pa.int64())),
                    pa.array([x.astype(f"<i{width}").tobytes()], pa.binary()),
                ],
                names=["dim", "n", "width", "ids", "x"],
            )


@dataclass(frozen=True)
class Blocks:
    """Stored blocks, and the number of tasks that a pass over them has."""

    frame: DataFrame
    tasks: int


def integer_blocks(rows: DataFrame, key: str, vector: str) -> Blocks:
    """Blocks of the usable vectors of ``rows``, stored once for all passes.

    Left out are vectors that are null or hold a null, NaN, infinite or huge entry, empty
    ones, and, as there is one covariance, those of another length than most have (of equally
    frequent lengths the smallest counts).
    """
    slim = rows.select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector")
    )
    blocks = checkpoint(slim.mapInArrow(_pack, _BLOCK))
    dims = blocks.groupBy("dim").agg(F.sum("n").alias("n"), F.sum(F.octet_length("x")).alias("bytes"))
    most = dims.orderBy(F.desc("n"), "dim").first()
    if most is None:
        return Blocks(blocks, 0)
    cores = rows.sparkSession.sparkContext.defaultParallelism
    tasks = max(-(-most["bytes"] // TASK_BYTES), min(cores, -(-most["bytes"] // LEAST_TASK_BYTES)))
    return Blocks(blocks.where(F.col("dim") == most["dim"]).coalesce(int(tasks)), int(tasks))


def _rows_of(batch: pa.RecordBatch) -> Iterator[tuple[list, np.ndarray]]:
    """(ids, whole numbers as a table) of each block of a batch."""
    columns = (batch.column(name) for name in ("ids", "dim", "width", "x"))
    for ids, dim, width, x in zip(*columns, strict=True):
        numbers = np.frombuffer(x.as_buffer(), f"<i{width.as_py()}").reshape(-1, dim.as_py())
        yield ids, numbers


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per dimension the sums of the upper and the lower bits, which no number of rows makes overflow."""
    upper = lower = None
    for batch in batches:
        for _, x in _rows_of(batch):
            x = x.astype(np.int64, copy=False)
            high, low = (x >> 26).sum(0), (x & ((1 << 26) - 1)).sum(0)
            upper, lower = (high, low) if upper is None else (upper + high, lower + low)
    if upper is not None:
        place = np.arange(len(upper), dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(place), pa.array(upper), pa.array(lower)], names=["place", "upper", "lower"]
        )


def exact_sums(blocks: Blocks) -> tuple[int, list[int]]:
    """Number of vectors, and the sum of each dimension."""
    n = blocks.frame.agg(F.sum("n")).first()[0] or 0
    places = blocks.frame.mapInArrow(_sums, "place int, upper long, lower long").groupBy("place")
    rows = places.agg(F.sum("upper").alias("upper"), F.sum("lower").alias("lower")).collect()
    sums = {row["place"]: (row["upper"] << 26) + row["lower"] for row in rows}
    return n, [sums[place] for place in range(len(sums))]


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for part in batch.column("part"):
            values = np.frombuffer(part.as_buffer())
            total = values.copy() if total is None else total + values
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])


def _fold(blocks: Blocks, of_block: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all blocks of an array of fixed size; tasks add up theirs first."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for _, x in _rows_of(batch):
                part = of_block(x)
                total = part if total is None else total + part
        if total is not None:
            parts = pa.array([np.ascontiguousarray(total).tobytes()], pa.binary())
            yield pa.RecordBatch.from_arrays([parts], names=["part"])

    parts = blocks.frame.mapInArrow(fold, "part binary")
    if blocks.tasks > PARTIALS_TO_DRIVER:
        parts = parts.repartition(PARTIALS_TO_DRIVER).mapInArrow(_added, "part binary")
    return sum(np.frombuffer(row["part"]) for row in parts.collect())


@dataclass(frozen=True)
class Whitening:
    """Mean and leading components of integer vectors; ``vectors`` has one component in each column."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    passes: int

    @property
    def mean(self) -> np.ndarray:
        return np.array([total / self.n for total in self.sums])


class _Covariance:
    """The covariance of the blocks as a product with columns; counts its passes."""

    def __init__(self, blocks: Blocks, n: int, mean: np.ndarray) -> None:
        self.blocks, self.n, self.mean, self.passes = blocks, n, mean, 0

    def __call__(self, columns: np.ndarray) -> np.ndarray:
        mean = self.mean

        def product(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return centred.T @ (centred @ columns)

        self.passes += 1
        return _fold(self.blocks, product).reshape(columns.shape) / self.n

    def trace(self) -> float:
        mean = self.mean
        self.passes += 1
        return float(_fold(self.blocks, lambda x: np.array([((x - mean) ** 2).sum()]))[0] / self.n)


def _bounds(apply: Callable, start: np.ndarray, steps: int) -> tuple[float, float]:
    """Lower and upper bound of the spectrum by a Lanczos run from one column."""
    basis = [start / np.linalg.norm(start)]
    diagonal, beside = [], []
    for _ in range(steps):
        w = apply(basis[-1][:, None])[:, 0]
        diagonal.append(float(w @ basis[-1]))
        for _ in range(2):
            w = w - np.array(basis).T @ (np.array(basis) @ w)
        beside.append(float(np.linalg.norm(w)))
        if beside[-1] <= 1e-12 * abs(diagonal[0]):
            break
        basis.append(w / beside[-1])
    size = len(diagonal)
    inner = np.diag(diagonal) + np.diag(beside[: size - 1], 1) + np.diag(beside[: size - 1], -1)
    ritz, turned = np.linalg.eigh(inner)
    # A Ritz value is this near to an eigenvalue; the outer ones lie inside the spectrum by about that.
    slack = np.abs(beside[size - 1] * turned[-1])
    return max(0.0, ritz[0] - slack[0]), ritz[-1] + slack[-1]


def _filtered(apply: Callable, block: np.ndarray, degree: int, low: float, cut: float, top: float) -> np.ndarray:
    """A Chebyshev polynomial of the covariance times the block: small between low and cut, 1 at top."""
    half, middle = (cut - low) / 2, (cut + low) / 2
    first = half / (top - middle)
    sigma, before = first, block
    now = (apply(block) - middle * block) * (sigma / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        ahead = (apply(now) - middle * now) * (2 * following / half) - (sigma * following) * before
        before, now, sigma = now, ahead, following
    return now


def leading(apply: Callable, dim: int, wanted: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a positive semidefinite product and their unit vectors, certified."""
    width = min(dim, wanted + max(EXTRA_COLUMNS, wanted))
    wanted = min(wanted, dim)
    if width == dim:
        whole = apply(np.eye(dim))
        values, vectors = np.linalg.eigh((whole + whole.T) / 2)
        return values[::-1][:wanted], vectors[:, ::-1][:, :wanted]
    rng = np.random.default_rng(seed)
    low, _ = _bounds(apply, rng.standard_normal(dim), LANCZOS_STEPS)
    block = np.linalg.qr(rng.standard_normal((dim, width)))[0]
    best = np.inf
    for _ in range(MOST_ROUNDS):
        product = apply(block)
        inner = block.T @ product
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, product = block @ turn, product @ turn
        apart = np.linalg.norm(product - block * values, axis=0)[:wanted].max()
        scale = max(values[0], np.finfo(float).tiny)
        if apart <= CERTIFIED * scale or (apart <= AT_ROUNDING * scale and apart > best / 4):
            return values[:wanted], block[:, :wanted]
        best = min(best, apart)
        cut = values[-1]
        if cut <= NO_VARIANCE * scale:
            # The block holds all there is; one product more leaves nothing else in it.
            block = np.linalg.qr(product + NO_VARIANCE * block * scale)[0]
            continue
        low = min(low, 0.999 * cut)
        block = np.linalg.qr(_filtered(apply, block, DEGREE, low, cut, values[0]))[0]
    raise ArithmeticError(f"components not certified: residual {best / scale:.1e} of the largest eigenvalue")


def fit_blocks(blocks: Blocks, components: int = COMPONENTS) -> Whitening | None:
    """Mean and components of all blocks; None without vectors."""
    n, sums = exact_sums(blocks)
    if not n:
        return None
    covariance = _Covariance(blocks, n, np.array([total / n for total in sums]))
    trace = covariance.trace()
    if trace <= 0:
        return Whitening(n, sums, np.zeros(0), np.zeros((len(sums), 0)), 0.0, covariance.passes)
    values, vectors = leading(covariance, len(sums), components)
    kept = values > NO_VARIANCE * values[0]
    values, vectors = values[kept], vectors[:, kept]
    # Either sign will do; the largest entry is made positive.
    strongest = vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])]
    return Whitening(n, sums, values, vectors * np.sign(strongest), trace, covariance.passes)


def identity_error(blocks: Blocks, model: Whitening) -> float:
    """Largest entry of the whitened vectors' covariance less the identity, by one more pass."""
    mean, turn = model.mean, model.vectors / np.sqrt(model.values)
    size = len(model.values)
    if not size:
        return 0.0

    def moments(x: np.ndarray) -> np.ndarray:
        z = (x - mean) @ turn
        return np.vstack((z.T @ z, z.sum(0)))

    found = _fold(blocks, moments).reshape(size + 1, size) / model.n
    return float(np.abs(found[:-1] - np.outer(found[-1], found[-1]) - np.eye(size)).max())


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sums of (n x - S)² by row; None where a long cannot hold it."""
    reach = n * int(np.abs(x).max()) + max(map(abs, sums))
    if reach < 1 << 62:
        apart = n * x.astype(np.int64) - np.array(sums, np.int64)
        if int(np.abs(apart).max()) ** 2 * x.shape[1] < 1 << 63:
            return (apart * apart).sum(1).tolist()
    apart = n * x.astype(object) - np.array(sums, object)
    exact = (apart * apart).sum(1).tolist()
    return [value if value < 1 << 63 else None for value in exact]


def whitened_rows(blocks: Blocks, model: Whitening, error: float) -> DataFrame:
    """One row for each vector and component."""
    n, sums, mean = model.n, model.sums, model.mean
    turn = model.vectors / np.sqrt(model.values)
    explained = model.values / model.trace if model.trace else model.values
    size = len(model.values)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, x in _rows_of(batch):
                count = len(x)
                repeated = np.repeat(np.arange(count), size)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.values.take(pa.array(repeated)),
                        pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), count)),
                        pa.array(np.full(count * size, n, np.int64)),
                        pa.array(_deviations(x, n, sums), pa.int64()).take(pa.array(repeated)),
                        pa.array(((x - mean) @ turn).ravel()),
                        pa.array(np.tile(explained, count)),
                        pa.array(np.full(count * size, error)),
                    ],
                    names=[field.split()[0] for field in _RESULT.split(", ")],
                )

    return blocks.frame.mapInArrow(rows, _RESULT)


def whiten(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of every usable vector.

    Entries c become x = floor(1024 c) + 100000. ``n`` counts the vectors used, ``deviation`` is the exact
    sum over the dimensions of (n x - S)² (null where a long cannot hold it), ``whitened`` the centred vector
    along a component over the root of its eigenvalue, ``explained`` the eigenvalue over the trace.

    Unusable vectors (see ``integer_blocks``) give no rows. A null id stays null and repeated rows
    count and come out as often as they are there. Components without variance have no scale and are
    left out, so equal vectors only, a single one, or an empty table give no rows. Among equal eigenvalues
    any basis is as good; the start is seeded, so runs over equal blocks agree. A long vector is
    held whole, as are as many columns of its length as the filter has. Other columns play no part.
    """
    blocks = integer_blocks(rows, key, vector)
    model = fit_blocks(blocks, components)
    if model is None:
        return blocks.frame.mapInArrow(lambda batches: iter(()), _RESULT)
    return whitened_rows(blocks, model, identity_error(blocks, model))
