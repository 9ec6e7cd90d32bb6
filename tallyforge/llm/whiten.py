"""Embedding whitening from an exact integer scatter.

An entry c becomes the integer x = floor(64 c) + OFFSET. The fit list holds each distinct x vector once. Its sums and cross-products are
gathered in whole numbers of any size: the shift OFFSET is subtracted again, blocks of rows are cut into limbs so small that their
products add up exactly in doubles, and the totals of a partition are cut into digits that Spark sums by matrix cell. On the driver,
which holds one matrix for each number of dimensions, n XᵀX - S Sᵀ is formed exactly; only then is it turned into doubles and
decomposed by eigh.

Defined results: vectors that are null, empty or hold a null or a value that is not finite take no part. Vectors of another number of
dimensions are a fit list of their own. A direction without variance (an eigenvalue not above dimensions times the rounding unit of the
largest) has explained 0 and no whitened value, and identity_error leaves it out. deviation is null where it needs more than 64 bits;
deviation_text has it at any size. Rows that repeat an id each give their rows. No vectors, no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, small_batches

#: Fixed values of the contract: what an entry is multiplied by, and what is added to its floor.
SCALE, OFFSET = 64, 1_000_000
#: Limbs of LIMB bits; the products of BLOCK rows of limbs sum below 2**53.
LIMB, BLOCK = 18, 1 << 16
#: Totals are summed by Spark in digits of this many bits; 2**31 partitions fit a long.
DIGIT = 32
COMPONENTS = 16
#: From here on a double times SCALE is a whole number.
WHOLE = float(1 << 47)


@dataclass
class Fit:
    """What whitening needs for one number of dimensions; sums are those of x - OFFSET, values count in `unit`."""

    n: int
    sums: np.ndarray
    unit: int
    axes: np.ndarray
    eigen: np.ndarray
    explained: np.ndarray
    identity_error: float | None = None


def usable(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(vec_id, q): the vectors that take part; q = floor(64 c) / 64, which doubles hold exactly."""
    v = F.col(vec_col).cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    kept = df.select(F.col(id_col).alias("vec_id"), v.alias("vec")).where(F.coalesce(F.size("vec") > 0, F.lit(False)) & F.coalesce(fine, F.lit(False)))
    return kept.select("vec_id", F.transform("vec", lambda c: F.when(F.abs(c) < WHOLE, F.floor(F.when(F.abs(c) < WHOLE, c).otherwise(0.0) * SCALE).cast("double") / SCALE).otherwise(c)).alias("q"))


def integers(q: np.ndarray) -> np.ndarray:
    """x - OFFSET of each entry: int64 where all fit, else Python integers."""
    if np.abs(q).max(initial=0.0) < WHOLE:
        return (q * SCALE).astype(np.int64)
    out = np.empty(q.shape, object)
    out.reshape(-1)[:] = [int(c * SCALE) if abs(c) < WHOLE else int(c) * SCALE for c in q.reshape(-1).tolist()]
    return out


def limbs(x: np.ndarray) -> list[np.ndarray]:
    """Doubles t0, t1, ... below 2**LIMB in size with x = t0 + t1 2**LIMB + ..."""
    out = []
    while np.abs(x).max(initial=0) >= 1 << LIMB:
        out.append((x & ((1 << LIMB) - 1)).astype(np.float64))
        x = x >> LIMB
    return out + [x.astype(np.float64)]


def exact_scatter(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The column sums and XᵀX of integer rows, as Python integers."""
    d = x.shape[1]
    sums, cross = np.zeros(d, object), np.zeros((d, d), object)
    for lo in range(0, len(x), BLOCK):
        parts = limbs(x[lo : lo + BLOCK])
        for i, a in enumerate(parts):
            sums += np.array([int(s) << (LIMB * i) for s in a.sum(axis=0)], object)
            for j, b in enumerate(parts):
                cross += np.array([int(c) << (LIMB * (i + j)) for c in (a.T @ b).reshape(-1)], object).reshape(d, d)
    return sums, cross


def digits(v: int) -> list[int]:
    """v in digits of DIGIT bits, least first; the last has the sign."""
    out = []
    while not -(1 << DIGIT) < v < 1 << DIGIT:
        out.append(v & ((1 << DIGIT) - 1))
        v >>= DIGIT
    return out + [v]


def _by_size(batch: pa.RecordBatch, name: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) for each number of dimensions in a batch."""
    col = batch.column(name)
    sizes = col.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = col.flatten().to_numpy(zero_copy_only=False)
    starts = np.cumsum(sizes) - sizes
    for d in np.unique(sizes):
        rows = np.nonzero(sizes == d)[0]
        yield rows, flat[starts[rows][:, None] + np.arange(d)]


def _scatter_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(d, i, j, k, v): digit k of a partition's cell i, j; j = -1: the sum of column i; i = -1: the rows."""
    total: dict[int, list] = {}
    for batch in batches:
        for _, q in _by_size(batch, "q"):
            sums, cross = exact_scatter(integers(q))
            t = total.setdefault(q.shape[1], [0, 0, 0])
            t[0], t[1], t[2] = t[0] + len(q), t[1] + sums, t[2] + cross
    for d, (n, sums, cross) in total.items():
        cells = [(d, -1, -1, 0, n)]
        cells += [(d, i, -1, k, v) for i in range(d) for k, v in enumerate(digits(int(sums[i])))]
        cells += [(d, i, j, k, v) for i in range(d) for j in range(i, d) for k, v in enumerate(digits(int(cross[i, j])))]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*cells), [pa.int32()] * 4 + [pa.int64()])], ["d", "i", "j", "k", "v"])


def decompose(n: int, sums: np.ndarray, cross: np.ndarray) -> Fit:
    """Exact n XᵀX - S Sᵀ, then doubles (in units, should they be out of range), then eigh."""
    exact = n * cross - np.outer(sums, sums)
    d, trace = len(sums), int(sum(exact[i, i] for i in range(len(sums))))
    unit = 1 << max(0, (trace.bit_length() - 2 * n.bit_length() - 600) // 2)
    cov = np.array([int(c) / (n * n * unit * unit) for c in exact.reshape(-1)]).reshape(d, d)
    eigen, axes = np.linalg.eigh(cov)
    eigen, axes = eigen[::-1][:COMPONENTS], axes[:, ::-1][:, :COMPONENTS]
    eigen = np.where(eigen > d * np.finfo(np.float64).eps * max(eigen[0], 0.0), eigen, 0.0)
    return Fit(n, sums, unit, axes, eigen, eigen / max(trace / (n * n * unit * unit), np.finfo(np.float64).tiny))


def centred(q: np.ndarray, fit: Fit) -> np.ndarray:
    """n x - S, exact: int64 where it and the sum of its squares fit, else Python integers."""
    x = integers(q)
    most = fit.n * int(np.abs(x).max(initial=0)) + max(abs(int(s)) for s in fit.sums)
    if x.dtype != object and q.shape[1] * most * most < 1 << 63:
        return fit.n * x - fit.sums.astype(np.int64)
    return fit.n * x.astype(object) - fit.sums


def whitened(c: np.ndarray, fit: Fit) -> np.ndarray:
    """Rows of n x - S projected on the components over sqrt(e); NaN where e is 0."""
    mean_free = c / fit.n if c.dtype != object else np.array([int(v) / (fit.n * fit.unit) for v in c.reshape(-1)]).reshape(c.shape)
    if c.dtype != object and fit.unit > 1:
        mean_free = mean_free / fit.unit
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(fit.eigen > 0, mean_free @ fit.axes / np.sqrt(fit.eigen), np.nan)


def _covariance_cells(fits: dict[int, Fit]):
    """(d, i, j, v): a partition's part of whitened's cross-products; j = -1: of its sums."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, q in _by_size(batch, "q"):
                d, n = q.shape[1], len(q)
                w = whitened(centred(q, fits[d]), fits[d])
                mean = w.mean(axis=0)
                cross = (w - mean).T @ (w - mean) + n * np.outer(mean, mean)
                k = len(mean)
                i, j = np.meshgrid(np.arange(k), np.arange(-1, k), indexing="ij")
                v = np.concatenate([n * mean[:, None], cross], axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(v.size, d, np.int32)), pa.array(i.reshape(-1).astype(np.int32)), pa.array(j.reshape(-1).astype(np.int32)), pa.array(v.reshape(-1))], ["d", "i", "j", "v"])

    return cells


def fit(vectors: DataFrame) -> dict[int, Fit]:
    """The fit of each number of dimensions over the distinct vectors, with the error that whitening them leaves."""
    each = checkpointed(vectors.select("q").distinct())  # copies go where they lie, before anything moves
    cells: dict[int, dict] = {}
    for d, i, j, k, v in each.mapInArrow(_scatter_cells, "d int, i int, j int, k int, v long").groupBy("d", "i", "j", "k").agg(F.sum("v").alias("v")).collect():
        at = cells.setdefault(d, {})
        at[i, j] = at.get((i, j), 0) + (v << (DIGIT * k))
    fits = {}
    for d, at in cells.items():
        cross = np.array([at[min(i, j), max(i, j)] for i in range(d) for j in range(d)], object).reshape(d, d)
        fits[d] = decompose(at[-1, -1], np.array([at[i, -1] for i in range(d)], object), cross)
    left: dict[int, list[float]] = {}
    rows = each.mapInArrow(_covariance_cells(fits), "d int, i int, j int, v double").groupBy("d", "i", "j").agg(F.sum("v").alias("v")).collect()
    mean = {(d, i): v / fits[d].n for d, i, j, v in rows if j < 0}
    for d, i, j, v in rows:
        if j >= 0 and not np.isnan(v):
            left.setdefault(d, []).append(abs(v / fits[d].n - mean[d, i] * mean[d, j] - (i == j)))
    for d, errors in left.items():
        fits[d].identity_error = float(max(errors))
    return fits


def _project(fits: dict[int, Fit]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, q in _by_size(batch, "q"):
                fit = fits[q.shape[1]]
                c = centred(q, fit)
                deviation = [int(v) for v in (c * c).sum(axis=1)]
                w = whitened(c, fit)
                m, k = w.shape
                again = np.repeat(np.arange(m), k)
                fits_long = pa.array([v if v < 1 << 63 else None for v in deviation], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(at[again])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, fit.n, np.int64)),
                        fits_long.take(pa.array(again)), pa.array(w.reshape(-1), mask=np.isnan(w.reshape(-1))), pa.array(np.tile(fit.explained, m)),
                        pa.array([fit.identity_error] * (m * k), pa.float64()), pa.array([str(v) for v in deviation], pa.string()).take(pa.array(again)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "deviation_text"],
                )

    return rows


def whiten(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error, deviation_text of each vector that takes part."""
    vectors = small_batches(usable(df, id_col, vec_col))
    kind = vectors.schema["vec_id"].dataType.simpleString()
    out = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_text string"
    return vectors.mapInArrow(_project(fit(vectors)), out)
