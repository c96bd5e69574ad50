"""Whitening by Chebyshev-filtered subspace iteration.

The covariance matrix is never formed: a pass over the vectors multiplies it with a block of BLOCK columns, each vector
centred first, partial products summed per task and then by position. A polynomial of such passes, by the Chebyshev
recurrence, damps the part of the spectrum below the block's smallest Ritz value; QR and Rayleigh-Ritz follow, until the
residuals certify the leading eigenvectors. The driver holds matrices of dimension times BLOCK and nothing that grows
with the number of vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

#: Components, columns of the block (guards included), degree of the filter, and units in which entries are counted.
COMPONENTS, BLOCK, DEGREE, SCALE = 4, 32, 10, 256
#: Residual, as a share of the largest eigenvalue, that certifies an eigenvector, and filters that may be tried for it.
TOLERANCE, ROUNDS = 2e-14, 60
#: Sums are carried in two parts, since squares may have more digits than a decimal.
PART = 10**18
#: Share of the variance under which a component counts as none.
NOTHING = 1e-13


class Fit(NamedTuple):
    """What whitening needs: vectors n, sums by dimension, eigenvectors as columns, eigenvalues, trace, and the identity's error."""

    n: int
    sums: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    error: float


def clean(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """vec_id and x: entries in units of 1/SCALE, rounded down. Rows without a vector, or with null or non-finite entries, go.

    Where lengths differ, shorter vectors count as zero behind their end.
    """
    v = F.col(column)
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    x = vectors.where(v.isNotNull() & ~bad).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(v, lambda c: F.floor(c.cast("double") * SCALE)).alias("x"))
    x = stored(x, "vectors")
    size = x.agg(F.max(F.size("x")).alias("most"), F.min(F.size("x")).alias("least")).first()
    if size["most"] == size["least"]:
        return x
    return x.select("vec_id", F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(size["most"]) - F.size("x"))).alias("x"))


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch["x"].flatten().to_numpy()
    return flat.reshape(batch.num_rows, len(flat) // batch.num_rows if batch.num_rows else 0)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact sums of a task, as multiples of PART and rests: at place 0 the vectors, then by dimension the entries, then their squares."""
    total = None
    for b in batches:
        x = _rows(b)
        wide = x.size and float(np.abs(x.astype(np.float64)).max()) ** 2 * len(x) >= 2**62
        x = x.astype(object) if wide else x
        part = np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)]).astype(object)
        total = part if total is None else total + part
    if total is not None:
        parts = [pa.array([Decimal(v) for v in p], pa.decimal128(38, 0)) for p in zip(*(divmod(int(v), PART) for v in total), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), *parts], names=["place", "high", "low"])


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exact: in 64 bits where they hold the squares' sum, else as Python's integers."""
    most = n * (int(np.abs(x.astype(np.float64)).max()) + 1 if x.size else 0) + max(map(abs, sums), default=0)
    if most * most * max(1, x.shape[1]) < 2**63:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _multiplied(fit: DataFrame, n: int, sums: list[int], by: np.ndarray, squared: bool = False) -> np.ndarray:
    """The covariance times `by`; squared: the covariance of the vectors' products with `by`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            centred = (_deviations(_rows(b), n, sums) / n).astype(np.float64)
            product = centred @ by
            part = (product if squared else centred).T @ product
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(total.size), pa.int32()), pa.array(total.ravel(), pa.float64())], names=["place", "value"])

    out = np.zeros(by.shape[1] ** 2 if squared else by.size)
    for r in fit.mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).collect():
        out[r["place"]] = r["value"]
    return (out / n).reshape(-1, by.shape[1])


def leading(times: Callable[[np.ndarray], np.ndarray], size: int, k: int, block: int = BLOCK, degree: int = DEGREE) -> tuple[np.ndarray, np.ndarray]:
    """The k leading eigenvalues and eigenvectors of a positive semidefinite matrix that only `times` knows."""
    block = min(size, max(block, k))
    q = np.linalg.qr(np.random.default_rng(0).standard_normal((size, block)))[0]
    best = np.inf
    for _ in range(ROUNDS):
        product = times(q)
        small = q.T @ product
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, product = q @ turn, product @ turn
        top = max(values[0], 0.0)
        worst = np.linalg.norm(product[:, :k] - q[:, :k] * values[:k], axis=0).max()
        if worst <= TOLERANCE * top or top == 0:
            return values[:k], q[:, :k]
        if worst > best / 2 and worst <= 100 * TOLERANCE * top:  # rounding is all that is left
            return values[:k], q[:, :k]
        best = min(best, worst)
        edge = max(values[-1], 1e-6 * top)
        middle = half = edge / 2
        first = scale = half / (top - middle)
        before, now = q, (product - middle * q) * (first / half)
        for _ in range(degree - 1):
            after = 1 / (2 / first - scale)
            before, now = now, (times(now) - middle * now) * (2 * after / half) - before * (scale * after)
            scale = after
        q = np.linalg.qr(now)[0]
    raise RuntimeError(f"no certificate after {ROUNDS} filters: residual {best:g}")


def fitted(x: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """The whitening of each distinct vector once; None where there is none."""
    fit = stored(x.select("x").distinct(), "fit-list")
    moments = fit.mapInArrow(_moments, "place int, high decimal(38,0), low decimal(38,0)").groupBy("place").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    sums = {r["place"]: int(r["high"]) * PART + int(r["low"]) for r in moments.collect()}
    if not sums or len(sums) < 3:
        return None
    n, size = sums[0], (len(sums) - 1) // 2
    s, squares = [sums[1 + i] for i in range(size)], [sums[1 + size + i] for i in range(size)]
    trace = sum(n * q - t * t for q, t in zip(squares, s, strict=True)) / n**2
    values, vectors = leading(lambda q: _multiplied(fit, n, s, q), size, min(components, size))
    real = values > NOTHING * max(trace, 0.0)
    error = 0.0
    if real.any():
        scaled = vectors[:, real] / np.sqrt(values[real])
        error = float(np.abs(_multiplied(fit, n, s, scaled, squared=True) - np.eye(int(real.sum()))).max())
    return Fit(n, s, vectors, np.where(real, values, 0.0), trace, error)


def whitened(vectors: DataFrame, components: int = COMPONENTS, column: str = "embedding") -> DataFrame:
    """A row for each vector that `clean` keeps and each component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Components are the leading eigenvectors of the covariance of distinct vectors; there are as many as asked for, or as
    many as dimensions. Where a component has no variance, whitened is null and explained 0 (null where nothing varies). deviation
    is null where it exceeds 64 bits. Equal eigenvalues leave the choice of their vectors open. Repeated rows each have their
    rows here and count once in the fit; null ids are values like others; other columns are ignored. Vectors without
    entries, and empty tables, give no rows.
    """
    x = clean(vectors, column)
    fit = fitted(x, components)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if fit is None:
        return x.sparkSession.createDataFrame([], schema)
    n, sums, _, values, trace, error = fit
    k = len(values)
    scaled = fit.vectors / np.sqrt(np.where(values > 0, values, np.nan))
    explained = values / trace if trace else np.full(k, np.nan)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d = _deviations(_rows(b), n, sums)
            far = [int(v) if v < 2**63 else None for v in (d * d).sum(axis=1)]
            out = (d / n).astype(np.float64) @ scaled
            rows = len(out)
            at = pa.array(np.repeat(np.arange(rows), k))
            each = lambda v, t: pa.array(np.tile(v, rows), t, from_pandas=True)
            columns = [b["vec_id"].take(at), each(np.arange(1, k + 1), pa.int32()), pa.array([n] * rows * k, pa.int64()), pa.array(far, pa.int64()).take(at), pa.array(out.ravel(), pa.float64(), from_pandas=True), each(explained, pa.float64()), pa.array([error] * rows * k, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return x.mapInArrow(run, schema)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))
