"""Helpers shared by the operators: shared folders, saved tables and a distributed logistic fit."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; a local session without that setting gets one of its own."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read again, so that lost executors cost no recomputation."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Hand long texts to Python in Arrow batches of at most ``rows`` rows, so that a task holds few of them at a time.

    A setting of the session, lowered only if it is larger.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)


@contextmanager
def larger_batches(spark: SparkSession, rows: int = 10000) -> Iterator[None]:
    """Hand rows of a few numbers to Python in batches of at least ``rows`` rows in what is run inside; then the setting is as before."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if 0 < int(before) < rows:
        spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def free_name(df: DataFrame, wish: str) -> str:
    """``wish``, with underscores before it until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while wish.lower() in taken:
        wish = "_" + wish
    return wish


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, all else kept."""
    return F.translate(text, UPPER, UPPER.lower())


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _sparse(idx: pd.Series, val: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.fromiter((len(x) for x in idx), np.int64, len(idx))
    rows = np.repeat(np.arange(len(idx)), lengths)
    empty = not lengths.sum()
    return rows, (np.zeros(0, np.int64) if empty else np.concatenate(list(idx)).astype(np.int64)), (np.zeros(0) if empty else np.concatenate(list(val)).astype(float))


def margins(idx: pd.Series, val: pd.Series, weights: np.ndarray) -> np.ndarray:
    """Linear score of each sparse row; the last weight is the intercept."""
    rows, cols, vals = _sparse(idx, val)
    return np.bincount(rows, vals * weights[cols], minlength=len(idx)) + weights[-1]


def minimized(cost, start: np.ndarray, rounds: int, memory: int = 10) -> np.ndarray:
    """L-BFGS: ``cost`` gives value and gradient, at most ``rounds`` times; a step that does not lower the value enough is halved."""
    x, (value, grad), pairs, calls = start, cost(start), [], 1
    while calls < rounds and np.abs(grad).max() > 1e-7:
        d, alphas = grad.copy(), []
        for s, y in reversed(pairs):
            alphas.append(s @ d / (s @ y))
            d -= alphas[-1] * y
        d *= pairs[-1][0] @ pairs[-1][1] / (pairs[-1][1] @ pairs[-1][1]) if pairs else 1.0
        for (s, y), alpha in zip(pairs, reversed(alphas), strict=True):
            d += (alpha - y @ d / (s @ y)) * s
        step = 1.0
        while calls < rounds:
            after, calls = cost(x - step * d), calls + 1
            if after[0] <= value - 1e-4 * step * (grad @ d):
                break
            step /= 2
        else:
            return x
        s, y = -step * d, after[1] - grad
        if s @ y > 1e-12:
            pairs = [*pairs, (s, y)][-memory:]
        x, (value, grad) = x + s, after
    return x


def fit_logistic(sample: DataFrame, dim: int, rounds: int = 30, l2: float = 1e-5) -> np.ndarray:
    """Weights (``dim`` and an intercept) of a logistic regression.

    ``sample`` has ``idx array<int>``, ``val array<double>`` of length 1 at most and a soft label ``y`` in [0, 1]; it is
    bounded by its caller and best read from a table of a few files. Each of at most ``rounds`` passes has every partition sum its loss and
    gradient; the driver adds these vectors of ``dim + 1`` numbers and takes a quasi-Newton step. Without rows all weights are zero.
    """

    def gradient(weights: np.ndarray):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total, n, loss = np.zeros(dim + 1), 0, 0.0
            for b in batches:
                rows, cols, vals = _sparse(b.idx, b.val)
                z, y = np.bincount(rows, vals * weights[cols], minlength=len(b)) + weights[-1], b.y.to_numpy()
                loss += float((np.logaddexp(0, z) - y * z).sum())
                miss = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - y
                total[:dim] += np.bincount(cols, vals * miss[rows], minlength=dim)
                total[dim] += miss.sum()
                n += len(b)
            if n:
                yield pd.DataFrame({"n": [n], "loss": [loss], "g": [total.tobytes()]})

        return run

    def cost(weights: np.ndarray) -> tuple[float, np.ndarray]:
        parts = sorted(sample.mapInPandas(gradient(weights), "n long, loss double, g binary").collect(), key=lambda p: bytes(p.g))
        n = max(sum(p.n for p in parts), 1)
        g = sum((np.frombuffer(p.g) for p in parts), np.zeros(dim + 1)) / n
        bare = np.append(weights[:-1], 0)
        return sum(p.loss for p in parts) / n + l2 / 2 * float(bare @ bare), g + l2 * bare

    return minimized(cost, np.zeros(dim + 1), rounds)


def bounded_sample(df: DataFrame, key: Column, bound: int, n: int) -> DataFrame:
    """About ``bound`` of the ``n`` rows, chosen by a hash of ``key``, which must be unique; all of them if there are no more."""
    if n <= bound:
        return df
    return df.filter(F.pmod(F.xxhash64(key, F.lit("sample")), F.lit(1 << 30)) < int(bound / n * (1 << 30)))
