"""Whitening of embeddings: components of unit variance without correlation.

Vectors are put on a grid of whole numbers, x = floor(64 c) + 1 000 000, and every distinct x is fitted once (copies are
combined before the shuffle). The spectrum of their covariance comes from ``spectrum.py``:

1. Every partition starts from an empty spectrum and makes a centred rank-one update per vector.
2. States (one of d + d + d * d numbers per partition) are merged in a tree, ``FAN_IN`` at a time, each by as many rank-one
   updates as it has directions, until one is left.
3. Rayleigh-Ritz refinement: all vectors are projected on the directions found, the small matrix of their products is summed
   over the partitions in the same kind of tree, and its eigenvectors turn the directions. What rounding the many
   updates left, and any dependence on the order of the rows, goes with it.

Only states and matrices of d by d numbers reach the driver, one at a time. An update costs in the order of d * d * d
operations, a millisecond at 64 dimensions.

Cases: vectors that are null, or that hold null or non-finite entries or ones of 2**40 and more in size, have no result;
if lengths differ, only vectors of the commonest length (of several, the longest) have one, empty ones never; directions without
variance (relative 1e-12) are no components, so a single distinct vector has none; a ``deviation`` beyond 64 bits is null; repeated
rows and null ids are rows of their own; other columns are not looked at; no rows give no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paysignal.llm.spectrum import Spectrum
from paysignal.session import stage

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16
FAN_IN = 8
LEAST_VARIANCE = 1e-12
VECTORS_A_TASK = 20_000
_LIMIT = float(1 << 40)
_ROWS = 4096


@dataclass(frozen=True)
class Whitening:
    """Fitted on ``n`` distinct grid vectors: their exact sums (less ``OFFSET`` an entry), unit components as columns with
    falling variances, the variance of all directions, and the largest error of the whitened covariance."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    variances: np.ndarray
    total: float
    identity_error: float
    before: Spectrum | None  # the merged spectrum, as it was before the refinement

    @property
    def size(self) -> int:
        return len(self.sums)

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def project(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) @ self.components / np.sqrt(self.variances)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums over dimensions of (n x - S) squared."""
        sums = np.array([int(s) for s in self.sums], dtype=object)
        about = ((self.n * x.astype(np.float64) - sums.astype(np.float64)) ** 2).sum(axis=1)
        wide = (sums % (1 << 64)).astype(np.uint64)
        away = x.astype(np.uint64) * np.uint64(self.n) - wide  # modulo 2**64, as are squares and sums
        exact = (away * away).sum(axis=1)
        out: list[int | None] = [int(v) for v in exact]
        for i in np.flatnonzero(about > 9e18):
            value = sum((self.n * int(v) - s) ** 2 for v, s in zip(x[i], self.sums, strict=True))
            out[i] = value if value < 1 << 63 else None
        return out


def grid(vector: Column) -> Column:
    """Whole numbers less ``OFFSET``; null where the vector has no result."""
    entries = vector.cast("array<double>")
    fine = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(_LIMIT)))
    return F.when(F.coalesce(fine, F.lit(False)) & (F.size(entries) > 0), F.transform(entries, lambda c: F.floor(c * F.lit(float(SCALE)))))


def _matrix(batch: pa.RecordBatch, column: str, size: int) -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


_STATE = "place int, n long, sums binary, state binary"


def _state_batch(n: int, sums: np.ndarray, state: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "place": pa.array([TaskContext.get().partitionId()], pa.int32()), "n": pa.array([n], pa.int64()),
        "sums": pa.array([sums.astype("<i8").tobytes()], pa.binary()), "state": pa.array([state], pa.binary())})


def _combined(states: DataFrame, merge: Callable[[pd.DataFrame], tuple[int, bytes, bytes]], name: str):
    """One state out of one per partition, ``FAN_IN`` at a time; None if there are none."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("place")
        n, sums, state = merge(group)
        return pd.DataFrame({"place": [group["place"].iloc[0] // FAN_IN], "n": [n], "sums": [sums], "state": [state]}).astype({"place": "int32"})

    states = stage(states, name)
    left = states.agg(F.max("place")).first()[0]
    while left:
        states = stage(states.groupBy(F.floor(F.col("place") / FAN_IN)).applyInPandas(run, _STATE), name)
        left //= FAN_IN
    return states.first()


def _spectrum(vectors: DataFrame, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, sums = Spectrum.empty(size), np.zeros(size, dtype=np.int64)
        for batch in batches:
            rows = _matrix(batch, "x", size)
            sums += rows.sum(axis=0)
            for row in rows.astype(np.float64):
                state.add(row)
        if state.n:
            yield _state_batch(state.n, sums, state.to_bytes())

    def merge(group: pd.DataFrame) -> tuple[int, bytes, bytes]:
        whole, sums = Spectrum.empty(size), np.zeros(size, dtype=np.int64)
        for n, s, state in zip(group["n"], group["sums"], group["state"], strict=True):
            whole.merge(Spectrum.from_bytes(int(n), size, state))
            sums += np.frombuffer(s, dtype="<i8")
        return whole.n, sums.astype("<i8").tobytes(), whole.to_bytes()

    found = _combined(vectors.mapInArrow(run, _STATE), merge, "spectra")
    return Spectrum.from_bytes(found.n, size, found.state), [int(s) for s in np.frombuffer(found.sums, dtype="<i8")]


def _products(vectors: DataFrame, size: int, project: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """Sum over all vectors of the products of the projected (centred) vector with itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((width, width)), 0
        for batch in batches:
            rows = _matrix(batch, "x", size)
            for lo in range(0, len(rows), _ROWS):
                found = project(rows[lo : lo + _ROWS].astype(np.float64))
                total += found.T @ found
            n += len(rows)
        if n:
            yield _state_batch(n, np.empty(0), total.astype("<f8").tobytes())

    def merge(group: pd.DataFrame) -> tuple[int, bytes, bytes]:
        total = sum(np.frombuffer(s, dtype="<f8") for s in group["state"])
        return int(group["n"].sum()), b"", total.astype("<f8").tobytes()

    found = _combined(vectors.mapInArrow(run, _STATE), merge, "products")
    return np.frombuffer(found.state, dtype="<f8").reshape(width, width).copy()


def fit(rows: DataFrame, vector_column: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """None if no row has a usable vector."""
    spark = rows.sparkSession
    plain = rows.select(grid(F.col(vector_column)).alias("x")).filter("x IS NOT NULL")
    every = stage(plain.distinct(), "fit_list")
    lengths = plain.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.agg(F.max(F.struct("n", "d")).alias("m")).first().m
    if most is None:
        return None
    size = most.d
    vectors = every.filter(F.size("x") == size)
    tasks = max(spark.sparkContext.defaultParallelism, -(-most.n // VECTORS_A_TASK))
    vectors = stage(vectors.repartition(tasks, "x"), "fit_list")

    spectrum, sums = _spectrum(vectors, size)
    n = spectrum.n
    mean = np.array([s / n for s in sums])
    directions = spectrum.vectors[:, ::-1]
    covariance = _products(vectors, size, lambda x: (x - mean) @ directions, size) / n
    values, turned = np.linalg.eigh((covariance + covariance.T) / 2)
    values, turned = values[::-1], turned[:, ::-1]
    keep = min(components, int((values > LEAST_VARIANCE * max(float(values[0]), 0.0)).sum()) if values[0] > 0 else 0)
    axes, total = directions @ turned[:, :keep], float(values.sum())
    axes /= np.linalg.norm(axes, axis=0)
    model = Whitening(n, tuple(sums), axes, values[:keep].copy(), total, 0.0, spectrum)
    if not keep:
        return model
    white = _products(vectors, size, model.project, keep) / n
    return Whitening(n, model.sums, axes, model.variances, total, float(np.abs(white - np.eye(keep)).max()), spectrum)


def apply(
    rows: DataFrame, model: Whitening | None, vector_column: str = "embedding", whitened: str = "whitened",
    deviation: str = "deviation",
) -> DataFrame:
    """``rows`` that have a result, with the whitened vector (array of doubles) and its deviation (long)."""
    kept = rows.drop(whitened, deviation)
    usable = kept.withColumn("_grid", grid(F.col(vector_column)))
    size = model.size if model else 0
    usable = usable.filter(F.col("_grid").isNotNull() & (F.size("_grid") == size))
    schema = kept.limit(0).withColumn(whitened, F.lit(None).cast("array<double>")).withColumn(deviation, F.lit(None).cast("long")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, "_grid", size)
            white = model.project(x.astype(np.float64))
            lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * white.shape[1], pa.array(white.ravel()))
            names = [*batch.schema.names[:-1], whitened, deviation]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], lists, pa.array(model.deviations(x), pa.int64())], names=names)

    return usable.mapInArrow(run, schema)


def component_rows(rows: DataFrame, model: Whitening | None, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """A row per vector and component: id, component (from 1), n, deviation, whitened, explained, identity_error."""
    applied = apply(rows.select(id_column, vector_column), model, vector_column).drop(vector_column)
    parted = applied.select(id_column, "deviation", F.posexplode("whitened").alias("_i", "whitened"))
    shares = [float(v) for v in model.variances / model.total] if model and len(model.variances) else [0.0]
    explained = F.array(*(F.lit(s) for s in shares))
    return parted.select(
        id_column, (F.col("_i") + 1).cast("int").alias("component"), F.lit(model.n if model else 0).cast("long").alias("n"), "deviation",
        "whitened", F.get(explained, F.col("_i")).alias("explained"), F.lit(model.identity_error if model else 0.0).alias("identity_error"))
