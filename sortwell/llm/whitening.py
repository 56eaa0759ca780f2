"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the covariance are found without ever forming it. A pass over the centred
rows gives VQ = XᵀXQ/n for a block Q of `BLOCK_TIMES` times as many columns as wanted: every task
multiplies its rows in batches, and the partial sums, one small matrix per task, are added up in Spark.
A Chebyshev polynomial of V, by its three-term recurrence with one pass a step, damps the part of the
spectrum below the block's smallest Ritz value and raises the rest. Then come QR and Rayleigh-Ritz, and
so on until the wanted pairs are certified: their residuals are down to rounding, or no longer fall, and
a last filter whose spare columns start anew, orthogonal to what was found, changes no eigenvalue.

The lower end of the spectrum counts as 0, which is a bound for every covariance. The polynomial's degree
is bounded so that it raises the first wanted direction at most `MOST_RAISE` times as much as the last
one: otherwise rounding in that direction would drown the last.

Rows are whole numbers x, sums S and deviations n*x - S are exact, and rows are centred before they are
multiplied. With double precision this leaves the eigenvectors as exact as their gaps allow.

The driver holds d x block numbers, d being the number of dimensions; nothing in it grows with the rows.

Defined results: rows whose vector is null, is empty, or holds nulls, non-finite entries or entries
beyond the reach of a long (2^53) are left out, and so are those of another length than most (of the larger one
of two that are as frequent). Repeated rows count and are returned as often as they come. Components whose
eigenvalue is 0 but for rounding are left out, so equal rows, one row or none give no result. Equal
eigenvalues have any basis of their space, the same for all rows. Only the key and the vector are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sortwell.llm.common import settled

COMPONENTS = 8
BLOCK_TIMES = 4
MAX_DEGREE = 12
MOST_RAISE = 1e8
# Residuals relative to the largest eigenvalue: what is aimed at, and what is accepted where they no longer fall.
AIM, ACCEPTED = 2e-14, 1e-11
# An eigenvalue below this part of the largest one is 0 but for rounding.
ZERO = 1e-12
MAX_ROUNDS = 400
SCALE, SHIFT = 1024, 100_000
PARTITION_BYTES = 16 << 20


@dataclass
class Rows:
    """Settled rows (key, x) and their exact sums."""

    data: DataFrame
    n: int
    sums: list[int]

    @property
    def dims(self) -> int:
        return len(self.sums)


def whole_numbers(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """key, x: the usable vectors as whole numbers."""
    entries = F.transform(vector, lambda c: c.cast("double"))
    fits = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float(1 << 53))
    usable = rows.select(F.col(key).alias("key"), entries.alias("v")).where(F.forall("v", fits) & (F.size("v") > 0))
    return usable.select("key", F.transform("v", lambda c: F.floor(SCALE * c).cast("bigint") + SHIFT).alias("x"))


def matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def prepared(rows: DataFrame, key: str, vector: str) -> Rows | None:
    usable = whole_numbers(rows, key, vector)
    lengths = usable.groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("d"))
    most = lengths.first()
    if most is None:
        return None
    usable = usable.where(F.size("x") == most.d)
    # Every pass reads all rows, so they should not lie in many tiny partitions.
    wanted = max(rows.sparkSession.sparkContext.defaultParallelism, -(-most.n * most.d * 8 // PARTITION_BYTES))
    if usable.rdd.getNumPartitions() > wanted:
        usable = usable.coalesce(wanted)
    data = settled(usable)
    exact = data.select(F.posexplode("x").alias("at", "x")).groupBy("at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("s"))
    return Rows(data, most.n, [int(r.s) for r in sorted(exact.collect(), key=lambda r: r["at"])])


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: Python's whole numbers where a long does not hold it."""
    reach = max(n * int(np.abs(x).max(initial=0)), max(map(abs, sums), default=0))
    kind = np.int64 if reach < 1 << 61 else object
    return n * x.astype(kind) - np.array(sums, dtype=kind)


def summed(rows: Rows, partial, length: int) -> np.ndarray:
    """The sum over all rows of `partial(y)`, an array of `length` numbers for a batch of centred rows."""
    n, sums, dims = rows.n, rows.sums, rows.dims

    def run(stream):
        total = np.zeros(length)
        for batch in stream:
            if batch.num_rows:
                total += partial(centred(matrix(batch.column(0), dims), n, sums).astype(np.float64) / n)
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["part"])

    parts = rows.data.select("x").mapInArrow(run, "part array<double>")
    added = parts.select(F.posexplode("part").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(length)
    out[added.column("at").to_numpy()] = added.column("v").to_numpy()
    return out


def covariance_times(rows: Rows, block: np.ndarray) -> np.ndarray:
    """VQ, by one pass."""
    return summed(rows, lambda y: (y.T @ (y @ block)).ravel(), block.size).reshape(block.shape) / rows.n


def chebyshev(t: float, degree: int) -> float:
    return float(np.cosh(degree * np.arccosh(t))) if t > 1 else 1.0


def degree_for(values: np.ndarray, wanted: int, cut: float) -> int:
    first, last = 2 * values[0] / cut - 1, 2 * values[wanted - 1] / cut - 1
    degree = 1
    while degree < MAX_DEGREE and chebyshev(first, degree + 1) <= MOST_RAISE * chebyshev(last, degree + 1):
        degree += 1
    return degree


def filtered(times, block: np.ndarray, image: np.ndarray, degree: int, cut: float, top: float) -> np.ndarray:
    """The Chebyshev polynomial of V that is small on [0, cut], scaled to 1 at `top`, times the block.

    `image` is V times the block, known from Rayleigh-Ritz.
    """
    half = cut / 2
    scale = first = half / (top - half)
    before, now = block, (image - half * block) * (scale / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - scale)
        before, now = now, (times(now) - half * now) * (2 * following / half) - scale * following * before
        scale = following
    return now


def rayleigh_ritz(times, block: np.ndarray):
    """Eigenvalues, falling, vectors in the block's space, and V times these."""
    basis, _ = np.linalg.qr(block / np.maximum(np.linalg.norm(block, axis=0), 1e-300))
    image = times(basis)
    inner = basis.T @ image
    values, turn = np.linalg.eigh((inner + inner.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], basis @ turn, image @ turn


def leading_pairs(times, dims: int, wanted: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Certified leading eigenvalues and eigenvectors of a covariance V given by `times(Q)` = VQ."""
    draw = np.random.default_rng(seed)
    wanted = min(wanted, dims)
    size = min(dims, BLOCK_TIMES * wanted)
    values, block, image = rayleigh_ritz(times, draw.standard_normal((dims, size)))
    worst, probed = np.inf, None
    for _ in range(MAX_ROUNDS):
        top = values[0]
        if top <= 0:
            return np.zeros(0), np.zeros((dims, 0))
        residuals = np.linalg.norm(image - block * values, axis=0)[:wanted] / top
        found = float(residuals.max())
        done = found <= AIM or (found <= ACCEPTED and found > 0.5 * worst)
        if done and (size == dims or (probed is not None and np.abs(values[:wanted] - probed).max() <= 10 * ACCEPTED * top)):
            kept = values[:wanted] > ZERO * top
            return values[:wanted][kept], block[:, :wanted][:, kept]
        worst = min(worst, found)
        cut = max(values[-1], 1e-6 * top)
        degree = degree_for(values, wanted, cut)
        if done:
            # Fresh spare columns would bring up whatever the block has missed.
            probed = values[:wanted].copy()
            block = np.concatenate([block[:, :wanted], draw.standard_normal((dims, size - wanted))], axis=1)
            block, _ = np.linalg.qr(block)
            image = times(block)
        values, block, image = rayleigh_ritz(times, filtered(times, block, image, degree, cut, top))
    raise RuntimeError(f"no convergence: residual {worst:.1e} of the largest eigenvalue")


def principal_axes(rows: Rows, wanted: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    return leading_pairs(lambda block: covariance_times(rows, block), rows.dims, wanted)


def identity_error(rows: Rows, axes: np.ndarray) -> tuple[float, float]:
    """Largest entry by which the covariance of the whitened rows differs from the identity, and the
    sum of all eigenvalues, by one pass."""
    k = axes.shape[1]

    def partial(y: np.ndarray) -> np.ndarray:
        z = y @ axes
        return np.concatenate([z.sum(axis=0), (z.T @ z).ravel(), [(y * y).sum()]])

    total = summed(rows, partial, k + k * k + 1) / rows.n
    mean, square = total[:k], total[k:-1].reshape(k, k)
    return float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max()), float(total[-1])


def whitened(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """key, component, n, deviation (decimal), whitened, explained, identity_error: a row for each usable
    row of `rows` and component."""
    key_type = rows.schema[key].dataType.simpleString()
    schema = (f"key {key_type}, component int, n bigint, deviation string, whitened double, explained double, "
              "identity_error double")
    own = prepared(rows, key, vector)
    values, axes = (np.zeros(0), None) if own is None else principal_axes(own, components)
    if not len(values):
        found = rows.sparkSession.createDataFrame([], schema)
    else:
        axes = axes / np.sqrt(values)
        error, trace = identity_error(own, axes)
        n, sums, dims, k = own.n, own.sums, own.dims, len(values)

        def run(stream):
            for batch in stream:
                rows = batch.num_rows
                if not rows:
                    continue
                y = centred(matrix(batch.column(1), dims), n, sums)
                z = (y.astype(np.float64) / n) @ axes
                far = [str(sum(v * v for v in line)) for line in y.tolist()]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(np.repeat(np.arange(rows), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, n, dtype=np.int64)),
                    pa.array(far, pa.string()).take(pa.array(np.repeat(np.arange(rows), k))),
                    pa.array(z.ravel()), pa.array(np.tile(values / trace, rows)), pa.array(np.full(rows * k, error)),
                ], names=["key", "component", "n", "deviation", "whitened", "explained", "identity_error"])

        found = own.data.mapInArrow(run, schema)
    return found.withColumn("deviation", F.col("deviation").try_cast("decimal(38,0)"))


def whitening_report(rows: DataFrame) -> DataFrame:
    """vec_id, component, n, deviation (long, null where it does not fit one), whitened, explained, identity_error."""
    found = whitened(rows)
    return found.select(
        F.col("key").alias("vec_id"), "component", "n", F.col("deviation").try_cast("bigint").alias("deviation"),
        "whitened", "explained", "identity_error",
    )
