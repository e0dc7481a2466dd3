"""Dimensionality reduction from aggregated moments, and structure checks.

Every projection is ``(center, scale, weights)`` fitted on the driver from a
p x p matrix that Spark aggregates, then one dot product per row and component.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.recommendation import ALS
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import as_numbers, evenly, hash_unit
from ..functions.ordering import number_array
from ..session import cut_lineage
from . import models
from .profile import raw_moments

# Variance target, gates and vote weights.
VARIANCE_SHARE = 0.90
ROWS_PER_FEATURE = 5
MAX_CONDITION = 1e6
CV_WEIGHT = 2


@dataclass
class Projection:
    """A fitted linear projection of named columns."""

    technique: str
    cols: list[str]
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    explained: float | None = None

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """``<technique>_C<i>`` columns, plus those kept."""
        z = F.array(*[(F.col(f"`{c}`").cast("double") - float(m)) / float(s) for c, m, s in zip(self.cols, self.center, self.scale)])
        staged = df.select(*keep, z.alias("__z"))
        return staged.select(*keep, *[_dot("__z", w).alias(f"{self.technique}_C{i + 1}") for i, w in enumerate(self.weights.T)])


def _dot(vec: str, w: np.ndarray) -> Column:
    return F.aggregate(F.zip_with(vec, number_array([float(x) for x in w]), lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)


def _rows(df: DataFrame, cols: Sequence[str]) -> RowMatrix:
    vec = VectorAssembler(inputCols=list(cols), outputCol="v").transform(as_numbers(df, cols).dropna()).select("v")
    return RowMatrix(MLUtils.convertVectorColumnsFromML(vec, "v"))


def moments(df: DataFrame, cols: Sequence[str]) -> tuple[np.ndarray, np.ndarray, int]:
    """Means, population covariance and row count.

    A few columns are one aggregate; many go through the JVM row matrix, whose
    p x p sums are combined in a tree.
    """
    if len(cols) <= 24:
        mean, centred, n = raw_moments(df, cols)
        return mean, centred / n, int(n)
    mat = _rows(df, cols)
    stats = mat.computeColumnSummaryStatistics()
    n = int(stats.count())
    return np.asarray(stats.mean()), mat.computeCovariance().toArray() * (n - 1) / n, n


def standardizer(mean: np.ndarray, cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sd = np.sqrt(np.diag(cov))
    return mean, np.where(sd > 0, sd, 1.0)


def scree(df: DataFrame, cols: Sequence[str], share: float = VARIANCE_SHARE) -> DataFrame:
    """``(component, explained, cumulative, needed)`` of standardized columns."""
    mean, cov, _ = moments(df, cols)
    _, sd = standardizer(mean, cov)
    vals = np.clip(np.linalg.eigvalsh(cov / np.outer(sd, sd))[::-1], 0, None)
    part = vals / vals.sum()
    cum = np.cumsum(part)
    k = int(np.argmax(cum >= share - 1e-12)) + 1
    return df.sparkSession.createDataFrame([(i + 1, float(p), float(c), i < k) for i, (p, c) in enumerate(zip(part, cum))], "component int, explained double, cumulative double, needed boolean")


def pca(df: DataFrame, cols: Sequence[str], share: float = VARIANCE_SHARE) -> Projection:
    """Standardized principal components: the smallest number that reaches ``share`` of the variance."""
    mean, cov, _ = moments(df, cols)
    mean, sd = standardizer(mean, cov)
    vals, vecs = np.linalg.eigh(cov / np.outer(sd, sd))
    vals, vecs = np.clip(vals[::-1], 0, None), vecs[:, ::-1]
    cum = np.cumsum(vals) / vals.sum()
    k = int(np.argmax(cum >= share - 1e-12)) + 1
    signs = np.sign(vecs[np.abs(vecs).argmax(axis=0), range(len(vals))])
    return Projection("PCA", list(cols), mean, sd, (vecs * signs)[:, :k], float(cum[k - 1]))


def truncated_svd(df: DataFrame, cols: Sequence[str], k: int = 300) -> Projection:
    """Right singular vectors of the uncentred matrix, up to ``k``."""
    k = min(k, len(cols))
    v = _rows(df, cols).computeSVD(k, computeU=False).V.toArray()
    v = v * np.sign(v[np.abs(v).argmax(axis=0), range(v.shape[1])])
    mean, cov, _ = moments(df, cols)
    return Projection("SVD", list(cols), np.zeros(len(cols)), np.ones(len(cols)), v, float(np.trace(v.T @ cov @ v) / np.trace(cov)))


def discriminant(df: DataFrame, cols: Sequence[str], target: str) -> Projection:
    """Linear discriminants, classes - 1 at most: within scatter is total minus between, both from grouped means."""
    full = as_numbers(df, cols, [target]).dropna()
    mean, cov, n = moments(full, cols)
    per = full.groupBy(target).agg(F.count(F.lit(1)).alias("n"), *[F.avg(f"`{c}`").alias(f"m{i}") for i, c in enumerate(cols)]).collect()
    sb = np.zeros((len(cols), len(cols)))
    for r in per:
        d = np.array([r[f"m{i}"] for i in range(len(cols))]) - mean
        sb += r["n"] * np.outer(d, d)
    sw = n * cov - sb
    sw += np.eye(len(cols)) * 1e-9 * np.trace(sw) / len(cols)
    l_inv = np.linalg.inv(np.linalg.cholesky(sw))
    vals, vecs = np.linalg.eigh(l_inv @ sb @ l_inv.T)
    k = min(len(per) - 1, len(cols))
    w = l_inv.T @ vecs[:, ::-1][:, :k]
    w = w / np.linalg.norm(w, axis=0)
    top = np.clip(vals[::-1], 0, None)
    return Projection("LDA", list(cols), mean, np.ones(len(cols)), w, float(top[:k].sum() / max(top.sum(), 1e-300)))


def pls(df: DataFrame, cols: Sequence[str], target: str, k: int = 10) -> Projection:
    """Partial least squares for one numeric target, deflating X'X and X'y instead of the rows."""
    names = [*cols, target]
    mean, cov, _ = moments(df, names)
    center, sd = standardizer(mean, cov)
    c = cov / np.outer(sd, sd)
    p = len(cols)
    xx, xy = c[:p, :p].copy(), c[:p, p].copy()
    ws, ps = [], []
    for _ in range(min(k, p)):
        norm = np.linalg.norm(xy)
        if norm < 1e-12:
            break
        w = xy / norm
        tt = float(w @ xx @ w)
        if tt < 1e-12:
            break
        load = xx @ w / tt
        q = float(xy @ w) / tt
        xx = xx - tt * np.outer(load, load)
        xy = xy - tt * q * load
        ws.append(w), ps.append(load)
    w, load = np.array(ws).T, np.array(ps).T
    rot = w @ np.linalg.inv(load.T @ w)
    return Projection("PLS", list(cols), center[:p], sd[:p], rot)


def random_projection(df: DataFrame, cols: Sequence[str], k: int, seed: int = 42) -> Projection:
    rng = np.random.default_rng(seed)
    p = len(cols)
    return Projection("RP", list(cols), np.zeros(p), np.ones(p), rng.normal(0, 1 / np.sqrt(k), (p, k)))


def nmf(df: DataFrame, cols: Sequence[str], key: str, k: int = 5, iterations: int = 10, seed: int = 42) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Row factors, column factors and ``(frobenius_error)`` of a non-negative factorization of (row, column, value).

    The factorization numbers rows by 32-bit integers, so a key outside that range is refused.
    """
    fits = F.col(key).between(-(1 << 31), (1 << 31) - 1)
    row = F.when(F.col(key).isNull() | fits, F.col(key)).otherwise(F.raise_error(F.lit("row keys must fit 32 bits; number the rows first")))
    long = as_numbers(df, cols, [row.cast("int").alias("row")]).select("row", F.posexplode(F.array(*[F.col(f"`{c}`") for c in cols])).alias("col", "value")).dropna()
    model = ALS(rank=k, maxIter=iterations, regParam=1e-3, nonnegative=True, userCol="row", itemCol="col", ratingCol="value", seed=seed).fit(long)
    err = model.transform(long).agg(F.sqrt(F.sum(F.pow(F.col("value") - F.col("prediction"), 2))).alias("frobenius_error"))
    return model.userFactors, model.itemFactors, err


def gates(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(gate, value, passed)``: no nulls, two features, five rows per feature, condition number."""
    row = df.agg(F.count(F.lit(1)), *[F.count(f"`{c}`") for c in cols]).first()
    n = row[0]
    gone = sum(n - v for v in row[1:])
    _, cov, _ = moments(df, cols)
    cond = float(np.linalg.cond(cov))
    rows = [
        ("no_nulls", float(gone), gone == 0),
        ("features", float(len(cols)), len(cols) >= 2),
        ("rows_per_feature", n / len(cols), n >= ROWS_PER_FEATURE * len(cols)),
        ("condition_number", min(cond, 1e300), cond <= MAX_CONDITION),
    ]
    return df.sparkSession.createDataFrame(rows, "gate string, value double, passed boolean")


def reconstruction_error(df: DataFrame, proj: Projection) -> float:
    """Mean squared error of rebuilding standardized rows from the projection, in closed form from the covariance."""
    _, cov, _ = moments(df, proj.cols)
    c = cov / np.outer(proj.scale, proj.scale)
    w = proj.weights
    back = np.linalg.pinv(w)
    r = np.eye(len(proj.cols)) - w @ back
    return float(np.trace(r.T @ c @ r) / len(proj.cols))


def cv_score(df: DataFrame, fit: Callable[[DataFrame], Projection], target: str, key: str, folds: int = 3, family: str = "logistic", task: str = "class", seed: int = 42) -> float:
    """Mean held-out score of a model on the projection; reducer and model are fitted anew on the other folds of each fold.

    The folds are drawn from the row key, so all techniques meet the same rows.
    """
    cut = cut_lineage(df.withColumn("__fold", F.floor(hash_unit(key, seed=seed) * folds).cast("int")))
    judge = MulticlassClassificationEvaluator(metricName="accuracy") if task == "class" else RegressionEvaluator(metricName="r2")
    total = 0.0
    for k in range(folds):
        known, held = cut.filter(F.col("__fold") != k).drop("__fold"), cut.filter(F.col("__fold") == k).drop("__fold")
        proj = fit(known)
        reduced = [proj.transform(d.withColumn("__y", F.col(target)), ["__y"]) for d in (known, held)]
        names = [c for c in reduced[0].columns if c != "__y"]
        steps = models.stages(names, (), "__y" if task == "class" else None)
        ready = [d if task == "class" else d.withColumn("label", F.col("__y").cast("double")) for d in reduced]
        fitted = Pipeline(stages=[*steps, models.estimator(family, task)]).fit(ready[0])
        total += float(judge.evaluate(fitted.transform(ready[1])))
    return total / folds


def borda(scores: DataFrame) -> DataFrame:
    """``(technique, points)`` from ``(technique, metric, value)``: best value gets most points.

    Reconstruction error ranks downwards; a cross-validated score counts double.
    """
    value = F.when(F.col("metric") == "reconstruction_error", -F.col("value")).otherwise(F.col("value"))
    w = Window.partitionBy("metric").orderBy(value)
    points = (F.rank().over(w) - 1) * F.when(F.col("metric") == "cv_score", CV_WEIGHT).otherwise(1)
    return scores.withColumn("points", points).groupBy("technique").agg(F.sum("points").cast("long").alias("points")).orderBy(F.desc("points"), "technique")


def kmeans_elbow(df: DataFrame, cols: Sequence[str], ks: Sequence[int] = tuple(range(2, 11)), seed: int = 42, parallelism: int = 4) -> DataFrame:
    """``(k, cost, silhouette)`` on standardized complete rows; ``parallelism`` values of k run at a time."""
    vec = VectorAssembler(inputCols=list(cols), outputCol="__raw").transform(evenly(as_numbers(df, cols).dropna()))
    ready = StandardScaler(inputCol="__raw", outputCol="features", withMean=True).fit(vec).transform(vec).select("features").cache()

    def judged(k: int) -> tuple[int, float, float]:
        model = KMeans(k=k, seed=seed).fit(ready)
        return k, float(model.summary.trainingCost), float(ClusteringEvaluator().evaluate(model.transform(ready)))

    with ThreadPool(parallelism) as pool:
        rows = pool.map(inheritable_thread_target(df.sparkSession)(judged), list(ks), chunksize=1)
    ready.unpersist()
    return df.sparkSession.createDataFrame(rows, "k int, cost double, silhouette double")


def hopkins(df: DataFrame, cols: Sequence[str], key: str, probes: int = 100, seed: int = 42) -> DataFrame:
    """One row ``(hopkins)``: near 1 for clustered data, near 0.5 for none.

    A fixed number of sampled and uniform probes (the statistic's own sample size)
    meets every row once; tasks emit only the two smallest distances per probe.
    Uniform probes use their first neighbour, sampled ones the second.
    """
    names = list(cols)
    data = as_numbers(df, names, [F.col(key)]).dropna()
    taken = data.orderBy(F.xxhash64(F.col(key), F.lit(seed))).limit(probes).select(*names).toPandas().to_numpy()
    span = data.agg(*[F.min(f"`{c}`") for c in names], *[F.max(f"`{c}`") for c in names]).first()
    lo, hi = np.array(span[: len(names)]), np.array(span[len(names) :])
    even = np.random.default_rng(seed).uniform(lo, hi, (len(taken), len(names)))
    both = np.vstack([taken, even])

    def nearest(batches):
        best = np.full((len(both), 2), np.inf)
        for pdf in batches:
            x = pdf[names].to_numpy()
            for s in range(0, len(x), 4096):
                d = np.sqrt(((both[:, None, :] - x[None, s : s + 4096, :]) ** 2).sum(axis=2))
                best = np.sort(np.hstack([best, d]), axis=1)[:, :2]
        yield pd.DataFrame({"probe": np.repeat(np.arange(len(both)), 2), "dist": best.ravel()})

    found = data.select(*names).mapInPandas(nearest, "probe int, dist double")
    two = found.groupBy("probe").agg(F.min("dist").alias("d1"), F.array_sort(F.collect_list("dist")).alias("ds"))  # two per task
    m = len(taken)
    d = two.select("probe", F.when(F.col("probe") < m, F.get("ds", F.lit(1))).otherwise(F.get("ds", F.lit(0))).alias("d"))
    u = F.sum(F.when(F.col("probe") >= m, F.col("d")))
    return d.agg((u / F.sum("d")).alias("hopkins"))
