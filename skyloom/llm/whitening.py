"""Embedding whitening: Chebyshev-filtered subspace iteration over distributed centred products."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from skyloom.llm.common import read_table, register
from skyloom.session import stored

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
LARGEST = 2.0**52  # of |64 c|; beyond it neighbouring doubles are more than one step apart
LANCZOS_STEPS = 10
MOST_DEGREE, MOST_GAIN = 8, 1e12  # of a filter; the gain keeps small components above the rounding of large ones
TOLERANCE = 1e-13  # residual of a certified component, relative to the largest eigenvalue
ROUNDS = 200
VECTORS_AT_ONCE = 4_096


@dataclass
class Fit:
    """Components of the fit list: ``vectors`` (dimensions, components), eigenvalues falling."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    residual: float
    passes: int


def usable(embeddings: DataFrame, column: str) -> tuple[DataFrame, int]:
    """Rows whose vector has the commonest length (of equally common ones the largest) and only entries that count, and that length."""
    entry = lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double") * SCALE) >= LARGEST)
    good = embeddings.where(F.col(column).isNotNull() & ~F.coalesce(F.exists(column, entry), F.lit(False)))
    lengths = good.groupBy(F.size(column).alias("size")).count().agg(F.max(F.struct("count", "size"))["size"].alias("size")).first()["size"]
    return good.where(F.size(column) == F.lit(lengths or 0)), lengths or 0


def _widened(x: np.ndarray) -> tuple[int, bytes]:
    """The shifted entries in the narrowest of three integer widths, with that width."""
    most = int(np.abs(x).max(initial=0))
    width = 2 if most < 2**15 else 4 if most < 2**31 else 8
    return width, x.astype(f"<i{width}").tobytes()


def _block(width: int, data: bytes, dims: int) -> np.ndarray:
    return np.frombuffer(data, f"<i{width}").reshape(-1, dims)


def blocks(rows: DataFrame, column: str, dims: int) -> DataFrame:
    """The vectors as blocks (ids, width, data): x - SHIFT, row after row, as little-endian integers."""
    schema = pa.schema([("ids", pa.list_(pa.int64())), ("width", pa.int32()), ("data", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, VECTORS_AT_ONCE):
                batch = whole.slice(at, VECTORS_AT_ONCE)
                flat = batch.column("v").flatten().to_numpy(zero_copy_only=False)
                width, data = _widened(np.floor(SCALE * flat.astype(np.float64)).astype(np.int64))
                ids = pa.ListArray.from_arrays(pa.array([0, batch.num_rows], pa.int32()), batch.column("vec_id"))
                yield pa.RecordBatch.from_arrays([ids, pa.array([width], pa.int32()), pa.array([data], pa.binary())], schema=schema)

    wanted = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("v"))
    return wanted.mapInArrow(pack, "ids array<long>, width int, data binary") if dims else rows.sparkSession.createDataFrame([], "ids array<long>, width int, data binary")


def totals(packed: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of x of every dimension."""
    schema = pa.schema([("i", pa.int32()), ("n", pa.int64()), ("s", pa.int64())])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for width, data in zip(batch.column("width").to_pylist(), batch.column("data").to_pylist()):
                x = _block(width, data, dims).astype(np.int64)
                # 2^10 entries below 2^52 add up to less than 2^63
                for at in range(0, len(x), 1_024):
                    part = x[at:at + 1_024]
                    yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array([len(part)] * dims, pa.int64()), pa.array(part.sum(axis=0))], schema=schema)

    sums = packed.select("width", "data").mapInArrow(add, "i int, n long, s long")
    found = {r["i"]: (r["n"], int(r["s"])) for r in sums.groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()}
    if not found:
        return 0, []
    n = found[0][0]
    return n, [found[i][1] + n * SHIFT for i in range(dims)]


class Covariance:
    """Products of the covariance of the blocks with a few vectors; every product is one pass over the blocks."""

    def __init__(self, packed: DataFrame, n: int, sums: list[int]):
        self.packed, self.n, self.dims, self.passes = packed.select("width", "data"), n, len(sums), 0
        # the exact mean of x - SHIFT: a whole part and a fraction
        self.mean = np.array([s // n - SHIFT + (s % n) / n for s in sums])
        self.trace = 0.0

    def times(self, q: np.ndarray) -> np.ndarray:
        """V q, from partial sums of (x - mean) ((x - mean)' q); the trace of V comes along.

        Each task adds up its blocks and sends one row for every dimension, which Spark sums
        before and after the shuffle: what reaches the driver does not grow with the data.
        """
        dims, k, mean = self.dims, q.shape[1], self.mean
        names = [f"c{j}" for j in range(k + 1)]
        schema = pa.schema([("i", pa.int32()), *((c, pa.float64()) for c in names)])

        def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((dims, k + 1))
            for batch in batches:
                for width, data in zip(batch.column("width").to_pylist(), batch.column("data").to_pylist()):
                    x = _block(width, data, dims) - mean
                    total[:, :k] += x.T @ (x @ q)
                    total[:, k] += (x * x).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), *(pa.array(c) for c in total.T)], schema=schema)

        parts = self.packed.mapInArrow(multiply, f"i int, {', '.join(f'{c} double' for c in names)}")
        rows = parts.groupBy("i").agg(*[F.sum(c).alias(c) for c in names]).collect()
        self.passes += 1
        out = np.zeros((dims, k + 1))
        for r in rows:
            out[r["i"]] = r[1:]
        out /= self.n
        self.trace = float(out[:, k].sum())
        return out[:, :k]


def lower_end(cov: Covariance, rng: np.random.Generator) -> float:
    """An estimate of the smallest eigenvalue that is rather too small, by a few Lanczos steps with full orthogonalisation."""
    v = rng.normal(size=cov.dims)
    basis, diagonal, beside = [v / np.linalg.norm(v)], [], []
    for _ in range(min(LANCZOS_STEPS, cov.dims)):
        w = cov.times(basis[-1][:, None])[:, 0]
        diagonal.append(float(basis[-1] @ w))
        for _ in range(2):
            w -= sum((u @ w) * u for u in basis)
        size = float(np.linalg.norm(w))
        beside.append(size)
        if size <= 1e-12 * cov.trace:
            break
        basis.append(w / size)
    inner = np.diag(diagonal) + np.diag(beside[:-1], 1) + np.diag(beside[:-1], -1)
    values, vectors = np.linalg.eigh(inner)
    return max(0.0, float(values[0] - abs(beside[-1] * vectors[-1, 0]))) if beside[-1] > 1e-12 * cov.trace else 0.0


def fit(packed: DataFrame, dims: int, components: int = COMPONENTS) -> Fit | None:
    """The first components of the covariance of all blocks, each certified by its residual; None without a vector.

    A block of vectors, half as many again as there are components, goes through a Chebyshev
    polynomial of the covariance that is small on the unwanted end of the spectrum, from a Lanczos
    estimate of its lower end to the smallest Ritz value of the block; then come QR and a
    Rayleigh-Ritz step, whose products also begin the next filter. It ends when every wanted
    component v with value e has |V v - e v| of at most ``TOLERANCE`` times the largest value.
    """
    n, sums = totals(packed, dims)
    if not n:
        return None
    cov = Covariance(packed, n, sums)
    wanted = min(components, dims)
    width = min(dims, wanted + max(8, wanted // 2))
    rng = np.random.default_rng(7)
    q = np.linalg.qr(rng.normal(size=(dims, width)))[0]
    product = cov.times(q)
    low = lower_end(cov, rng) if width < dims else 0.0
    for _ in range(ROUNDS):
        inner = q.T @ product
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, product = q @ turn, product @ turn
        residual = float(np.linalg.norm(product - q * values, axis=0)[:wanted].max())
        top = max(float(values[0]), 0.0)
        if residual <= max(TOLERANCE * top, 1e-300):
            keep = [j for j in range(wanted) if values[j] > 1e-12 * top]
            return Fit(n, sums, q[:, keep], values[keep], cov.trace, residual, cov.passes)
        # the interval to damp; it ends below the last wanted value even if many values are equal
        high = min(float(values[-1]), float(values[wanted - 1]) - 0.05 * max(float(values[wanted - 1]) - low, 0.0))
        high = max(high, low + 1e-9 * top)
        centre, half = (low + high) / 2, (high - low) / 2
        reach = max((top - centre) / half, 1 + 1e-9)
        degree = int(np.clip(np.log(MOST_GAIN) / np.log(reach + np.sqrt(reach * reach - 1)), 1, MOST_DEGREE))
        # three-term recurrence, scaled so that the largest component keeps its size
        sigma = first = 1 / reach
        old, new = q, (product - centre * q) * (sigma / half)
        for _ in range(degree - 1):
            following = 1 / (2 / first - sigma)
            old, new = new, (cov.times(new) - centre * new) * (2 * following / half) - (sigma * following) * old
            sigma = following
        q = np.linalg.qr(new)[0]
        product = cov.times(q)
    raise RuntimeError(f"components not certified: residual {residual} of {top}")


def whitener(found: Fit) -> np.ndarray:
    return found.vectors / np.sqrt(found.values)


def identity_error(packed: DataFrame, found: Fit) -> float:
    """Largest absolute entry of the covariance of the whitened vectors minus the identity, from one more pass over them."""
    white, mean = whitener(found), Covariance(packed, found.n, found.sums).mean
    dims, k = white.shape
    names = [f"c{j}" for j in range(k + 1)]
    schema = pa.schema([("i", pa.int32()), *((c, pa.float64()) for c in names)])

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k + 1))
        for batch in batches:
            for width, data in zip(batch.column("width").to_pylist(), batch.column("data").to_pylist()):
                w = (_block(width, data, dims) - mean) @ white
                total[:, :k] += w.T @ w
                total[:, k] += w.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), *(pa.array(c) for c in total.T)], schema=schema)

    parts = packed.select("width", "data").mapInArrow(gram, f"i int, {', '.join(f'{c} double' for c in names)}")
    sums = np.zeros((k, k + 1))
    for r in parts.groupBy("i").agg(*[F.sum(c).alias(c) for c in names]).collect():
        sums[r["i"]] = r[1:]
    sums /= found.n
    centre = sums[:, k]
    return float(np.abs(sums[:, :k] - np.outer(centre, centre) - np.eye(k)).max())


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum over dimensions of (n x - S)^2 in whole numbers; null where a long cannot hold it."""
    rest = [s - n * SHIFT for s in sums]
    largest = max(max(abs(int(x[:, i].max()) * n - r), abs(int(x[:, i].min()) * n - r)) for i, r in enumerate(rest))
    if largest * largest * len(rest) < 2**63 and int(np.abs(x).max()) * n < 2**62:
        d = x * n - np.array(rest, np.int64)
        return pa.array((d * d).sum(axis=1), pa.int64())
    out = [sum((int(v) * n - r) ** 2 for v, r in zip(row, rest)) for row in x]
    return pa.array([v if v < 2**63 else None for v in out], pa.int64())


def whitened_rows(packed: DataFrame, found: Fit, error: float) -> DataFrame:
    """One row for each vector and component."""
    white, mean = whitener(found), Covariance(packed, found.n, found.sums).mean
    dims, k = white.shape
    n, sums, share = found.n, found.sums, found.values / found.trace
    schema = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])

    def show(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, width, data in zip(batch.column("ids"), batch.column("width").to_pylist(), batch.column("data").to_pylist()):
                x = _block(width, data, dims).astype(np.int64)
                many = len(x)
                each = pa.array(np.repeat(np.arange(many), k))
                yield pa.RecordBatch.from_arrays([
                    ids.values.take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), many)), pa.array(np.full(many * k, n)),
                    _deviations(x, n, sums).take(each), pa.array(((x - mean) @ white).ravel()), pa.array(np.tile(share, many)), pa.array(np.full(many * k, error)),
                ], schema=schema)

    return packed.mapInArrow(show, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")


def whiten(embeddings: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Whitened vectors (vec_id, component, n, deviation, whitened, explained, identity_error).

    Rows whose vector is null or holds a null, NaN, infinite or enormous (64 c of 2^52 or more)
    entry are left out, and so are vectors that do not have the commonest length. Every entry
    becomes x = floor(64 c) + 1,000,000; the covariance of x has divisor n. ``deviation`` is
    exact and null where it exceeds a long. Components without variance (below 1e-12 of the
    largest) have no whitened form and do not appear: n equal vectors, one vector and an empty table
    give an empty result. Repeated rows and null vec_ids count and return like any other; of equal
    eigenvalues the order is open. Other columns are not read.
    """
    rows, dims = usable(embeddings, column)
    packed = stored(blocks(rows, column, dims))
    found = fit(packed, dims, components)
    if found is None or not len(found.values):
        return embeddings.sparkSession.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    return whitened_rows(packed, found, identity_error(packed, found))


@register("op11_whitening")
def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(read_table(spark, folder, "embeddings"))
