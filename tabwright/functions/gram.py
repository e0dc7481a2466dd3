"""Cross-product matrices of many columns, summed in blocks of columns inside the tasks.

An aggregate with one expression a pair of columns outgrows generated code at a
few dozen columns. Here a task multiplies its rows as matrices and hands on one
row for each pair of column blocks; these are summed in two rounds, so that no
group holds the sums of all tasks. Tasks, and in the end the driver, hold
numbers by the square of the number of columns, whatever the rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import observed

BLOCK = 256
SALTS = 32
# Numbers handed to Python at a time.
BATCH_CELLS = 1 << 20

Blocks = dict[tuple[int, int], np.ndarray]


def _added(total: Blocks, key: tuple[int, int], value: np.ndarray) -> None:
    if key in total:
        total[key] += value
    else:
        total[key] = value


def _rows(total: Blocks) -> Iterator[pa.RecordBatch]:
    for (i, j), v in total.items():
        kinds = [pa.array([i], pa.int32()), pa.array([j], pa.int32()), pa.array([list(v.shape)], pa.list_(pa.int32())), pa.array([np.ascontiguousarray(v, float).tobytes()], pa.binary())]
        yield pa.RecordBatch.from_arrays(kinds, names=["i", "j", "shape", "v"])


def _read(i: int, j: int, shape: Sequence[int], v: bytes) -> tuple[tuple[int, int], np.ndarray]:
    return (i, j), np.frombuffer(v).reshape(shape).copy()


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: Blocks = {}
    for b in batches:
        for i, j, shape, v in zip(*(c.to_pylist() for c in b.columns), strict=True):
            _added(total, *_read(i, j, shape, v))
    yield from _rows(total)


def as_rows(df: DataFrame, cols: Sequence[str], *more: Column) -> DataFrame:
    """One array a row: ``cols`` as doubles, missing as NaN, then ``more``."""
    return df.select(F.array(*[F.coalesce(observed(df, c), F.lit(float("nan"))) for c in cols], *more).alias("x"))


def summed_blocks(rows: DataFrame, width: int, contribute: Callable[[np.ndarray], Iterable[tuple[tuple[int, int], np.ndarray]]]) -> Blocks:
    """The sums by key of the blocks that ``contribute`` makes of matrices of rows (arrays of ``width``); one job."""
    step = max(1, BATCH_CELLS // max(width, 1))

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Blocks = {}
        for b in batches:
            whole = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            for start in range(0, len(whole), step):
                for key, value in contribute(whole[start : start + step]):
                    _added(total, key, value)
        yield from _rows(total)

    schema = "i int, j int, shape array<int>, v binary"
    found = rows.mapInArrow(partial, schema).withColumn("salt", F.spark_partition_id() % SALTS)
    near = found.repartition("i", "j", "salt").drop("salt").mapInArrow(_add_up, schema)
    last = near.repartition("i", "j").mapInArrow(_add_up, schema)
    return dict(_read(r.i, r.j, r.shape, bytes(r.v)) for r in last.collect())


def _spans(width: int) -> list[slice]:
    return [slice(start, min(start + BLOCK, width)) for start in range(0, width, BLOCK)]


def means(df: DataFrame, cols: Sequence[str], complete: bool) -> tuple[np.ndarray, np.ndarray]:
    """Means and counts of the known values; ``complete``: over the rows in which all are known."""

    def contribute(x: np.ndarray):
        known = ~np.isnan(x)
        if complete:
            x = x[known.all(axis=1)]
            yield (0, 0), np.stack([x.sum(axis=0), np.full(x.shape[1], float(len(x)))])
        else:
            yield (0, 0), np.stack([np.where(known, x, 0.0).sum(axis=0), known.sum(axis=0).astype(float)])

    total = summed_blocks(as_rows(df, cols), len(cols), contribute).get((0, 0), np.zeros((2, len(cols))))
    return np.where(total[1] > 0, total[0] / np.maximum(total[1], 1.0), 0.0), total[1]


def complete_products(df: DataFrame, cols: Sequence[str], shift: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """X'X of ``[1, cols - shift]`` over complete rows, and ``[0, shift]``; the shift is the means, which take a pass of their own, unless given."""
    shift = means(df, cols, complete=True)[0] if shift is None else shift
    width = len(cols) + 1
    spans = _spans(width)

    def contribute(x: np.ndarray):
        x = x[~np.isnan(x).any(axis=1)] - shift
        x = np.column_stack([np.ones(len(x)), x])
        for i, a in enumerate(spans):
            for j, b in enumerate(spans[i:], i):
                yield (i, j), x[:, a].T @ x[:, b]

    found = summed_blocks(as_rows(df, cols), len(cols), contribute)
    out = np.zeros((width, width))
    for (i, j), v in found.items():
        out[spans[i], spans[j]], out[spans[j], spans[i]] = v, v.T
    return out, np.concatenate([[0.0], shift])


def weighted_products(rows: DataFrame, width: int) -> np.ndarray:
    """X'WX of arrays of ``width`` numbers followed by a weight."""
    spans = _spans(width)

    def contribute(x: np.ndarray):
        x, w = x[:, :-1], x[:, -1:]
        for i, a in enumerate(spans):
            for j, b in enumerate(spans[i:], i):
                yield (i, j), (x[:, a] * w).T @ x[:, b]

    out = np.zeros((width, width))
    for (i, j), v in summed_blocks(rows, width + 1, contribute).items():
        out[spans[i], spans[j]], out[spans[j], spans[i]] = v, v.T
    return out


def third_moments(df: DataFrame, cols: Sequence[str], mean: np.ndarray, white: np.ndarray) -> tuple[float, float]:
    """Squared norm of the mean third-moment tensor of the whitened complete rows, and the mean of their squared length squared.

    The tensor is summed as one matrix a column, so it takes the cube of the number of columns.
    """
    width = len(cols)

    def contribute(x: np.ndarray):
        z = (x[~np.isnan(x).any(axis=1)] - mean) @ white.T
        for i in range(width):
            yield (i, 0), (z * z[:, i : i + 1]).T @ z
        yield (-1, 0), np.array([float(len(z)), float(((z * z).sum(axis=1) ** 2).sum())])

    found = summed_blocks(as_rows(df, cols), width, contribute)
    n, fourth = found.get((-1, 0), np.zeros(2))
    if not n:
        return float("nan"), float("nan")
    return float(sum((v * v).sum() for (i, _), v in found.items() if i >= 0) / n**2), float(fourth / n)


class Pairwise:
    """Over the rows in which both columns of a pair are known: ``n`` rows, ``mean[a, b]`` and ``square[a, b]`` of a (centred), ``product``."""

    def __init__(self, df: DataFrame, cols: Sequence[str]):
        self.shift, self.known = means(df, cols, complete=False)
        shift, width = self.shift, len(cols)
        spans = _spans(width)

        def contribute(x: np.ndarray):
            seen = (~np.isnan(x)).astype(float)
            x = np.where(seen > 0, x - shift, 0.0)
            for i, a in enumerate(spans):
                for j, b in enumerate(spans[i:], i):
                    xa, xb, sa, sb = x[:, a], x[:, b], seen[:, a], seen[:, b]
                    yield (i, j), np.stack([sa.T @ sb, xa.T @ xb, xa.T @ sb, sa.T @ xb, (xa * xa).T @ sb, sa.T @ (xb * xb)])

        found = summed_blocks(as_rows(df, cols), width, contribute)
        n, self.product, total, square = (np.zeros((width, width)) for _ in range(4))
        for (i, j), v in found.items():
            a, b = spans[i], spans[j]
            for to, ab, ba in ((n, 0, 0), (self.product, 1, 1), (total, 2, 3), (square, 4, 5)):
                to[a, b], to[b, a] = v[ab], v[ba].T
        self.n = n
        with np.errstate(divide="ignore", invalid="ignore"):
            self.mean = total / n
            self.centred = self.product - total * self.mean.T
            self.spread = square - total * self.mean

    def covariance(self) -> np.ndarray:
        """Sample covariances; NaN where fewer than two rows know both."""
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.n > 1, self.centred / (self.n - 1), np.nan)

    def correlation(self) -> np.ndarray:
        with np.errstate(divide="ignore", invalid="ignore"):
            out = self.centred / np.sqrt(self.spread * self.spread.T)
        return np.clip(np.where(self.n > 1, out, np.nan), -1.0, 1.0)
