"""Group comparisons, intervals, resampling and normality."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import gram, ordering, special
from ..functions.columns import agg_long, as_numbers, melt, numeric_cols, observed
from .profile import raw_moments


def group_intervals(df: DataFrame, cats: Sequence[str], target: str) -> DataFrame:
    """``(feature, group, mean, ci_lower, ci_upper, std_dev, n)`` of the target per category."""
    data = df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in cats], observed(df, target).alias("__y")).filter(F.col("__y").isNotNull())
    long = data.unpivot(["__y"], list(cats), "feature", "group").filter(F.col("group").isNotNull())
    stats = long.groupBy("feature", "group").agg(
        F.avg("__y").alias("mean"), F.stddev_pop("__y").alias("std_dev"), F.count(F.lit(1)).alias("n")
    )
    q = ordering.quantiles(long, "__y", [0.025, 0.975], ["feature", "group"], ["feature"])
    q = q.select("feature", "group", F.get("q", F.lit(0)).alias("ci_lower"), F.get("q", F.lit(1)).alias("ci_upper"))
    return stats.join(q, ["feature", "group"])


def t_tests(df: DataFrame, target: str, cols: Sequence[str] | None = None, equal_var: bool = False, classes: Sequence | None = None) -> DataFrame:
    """``(feature, t, dof, p)`` between two target classes (the first two in order), by p.

    Welch by default, pooled variances with ``equal_var``.
    """
    names = list(cols or numeric_cols(df, exclude=[target]))
    a, b = classes or sorted(r[0] for r in df.select(target).dropna().distinct().orderBy(target).limit(2).collect())
    per = agg_long(df.filter(F.col(target).isin(a, b)), names, {"n": F.count, "m": F.avg, "v": F.var_samp}, [target])
    side = lambda v, s: per.filter(F.col(target) == v).select("feature", *[F.col(c).cast("double").alias(c + s) for c in ("n", "m", "v")])
    two = side(a, "1").join(side(b, "2"), "feature")
    n1, n2, v1, v2 = (F.col(c) for c in ("n1", "n2", "v1", "v2"))
    if equal_var:
        dof = n1 + n2 - 2
        se = F.sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / dof * (1 / n1 + 1 / n2))
    else:
        se = F.sqrt(v1 / n1 + v2 / n2)
        dof = F.pow(v1 / n1 + v2 / n2, 2) / (F.pow(v1 / n1, 2) / (n1 - 1) + F.pow(v2 / n2, 2) / (n2 - 1))
    out = two.select("feature", F.try_divide(F.col("m1") - F.col("m2"), se).alias("t"), dof.alias("dof"))
    return out.withColumn("p", special.on_results(special.t_sf2)("t", "dof")).orderBy("p", "feature")


def normal_intervals(df: DataFrame, cols: Sequence[str] | None = None, level: float = 0.95) -> DataFrame:
    """Mean plus and minus the normal quantile times the sample deviation."""
    z = round(special.norm_ppf(0.5 + level / 2), 12)
    out = agg_long(df, list(cols or numeric_cols(df)), {"m": F.avg, "s": F.stddev_samp})
    return out.select("feature", (F.col("m") - z * F.col("s")).alias("lower"), (F.col("m") + z * F.col("s")).alias("upper"))


# Random numbers held at a time.
DRAWS = 1 << 20


def uniforms(keys: np.ndarray, draws: int) -> np.ndarray:
    """Uniform numbers in [0, 1) for each key and draw: the mixed sum of the key and a multiple of a fixed odd number."""
    with np.errstate(over="ignore"):
        z = keys.astype(np.uint64)[:, None] + np.arange(1, draws + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53)


def poisson_weights(keys: np.ndarray, means: np.ndarray, draws: int) -> np.ndarray:
    """Poisson draws (key, draw) by the inverse of the distribution function, tabled once for each distinct mean over the span that doubles tell from 0 and 1."""
    out = np.empty((len(keys), draws))
    u = uniforms(keys, draws)
    for mean in np.unique(means):
        reach = 10 * math.sqrt(mean) + 40
        low = max(0, math.floor(mean - reach))
        k = np.arange(low, math.ceil(mean + reach) + 1)
        steps = np.log(mean) - np.log(np.maximum(k[1:], 1))
        logs = np.concatenate([[0.0], np.cumsum(steps)])
        share = np.exp(logs + low * math.log(mean) - mean - math.lgamma(low + 1))
        at = means == mean
        out[at] = low + np.searchsorted(np.cumsum(share), u[at], "left")
    return out


def bootstrap_ci(df: DataFrame, cols: Sequence[str] | None = None, n_iter: int = 1000, level: float = 0.95, min_rows: int = 30, seed: int = 42) -> DataFrame:
    """Percentile bootstrap of mean and median per column; NULL for a column with fewer than ``min_rows`` values.

    Mean: a value seen c times gets a Poisson(c) weight in each resample, which is a
    function of the value and the resample's number, so only ``n_iter`` sums per task are
    shuffled. Median: the middle order statistic of a resample is the data
    quantile at a Beta-distributed rank, so its resamples are ``n_iter`` exact
    quantiles and need no resampled data at all.
    """
    names = list(cols or numeric_cols(df))
    counts = melt(df, names).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    sizes = {r["feature"]: r["n"] for r in counts.groupBy("feature").agg(F.sum("n").alias("n")).collect() if r["n"] >= min_rows}
    few = [(c, None, None, None, None) for c in names if c not in sizes]
    short = df.sparkSession.createDataFrame(few, "feature string, mean_lower double, mean_upper double, median_lower double, median_upper double")
    if not sizes:
        return short
    code = {c: i for i, c in enumerate(names)}

    def weights(batches):
        total: dict[str, np.ndarray] = {}
        for pdf in batches:
            for feature, part in pdf.groupby("feature"):
                acc = total.setdefault(feature, np.zeros((2, n_iter)))
                for start in range(0, len(part), max(1, DRAWS // n_iter)):
                    rows = part.iloc[start : start + max(1, DRAWS // n_iter)]
                    w = poisson_weights(rows["key"].to_numpy(np.uint64), rows["n"].to_numpy(np.int64), n_iter)
                    acc += np.stack([w.sum(axis=0), rows["value"].to_numpy() @ w])
        for feature, acc in total.items():
            yield pd.DataFrame({"feature": feature, "b": np.arange(n_iter), "w": acc[0], "wx": acc[1]})

    # Draws are numbered hashes of the value's text, so no partitioning changes them.
    codes = F.create_map(*[F.lit(x) for c, i in code.items() for x in (c, str(i))])[F.col("feature")]
    text = F.concat_ws("|", F.lit(str(seed)), codes, F.col("value").cast("string"))
    wanted = counts.filter(F.col("feature").isin(*sizes)).withColumn("key", F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long"))
    sums = wanted.mapInPandas(weights, "feature string, b long, w double, wx double").groupBy("feature", "b").agg(
        F.try_divide(F.sum("wx"), F.sum("w")).alias("m")
    )
    tail = (1 - level) / 2
    means = sums.groupBy("feature").agg(F.percentile("m", [tail, 1 - tail]).alias("q")).select(
        "feature", F.get("q", F.lit(0)).alias("mean_lower"), F.get("q", F.lit(1)).alias("mean_upper")
    )
    rows = []
    for c, n in sizes.items():
        rng = np.random.default_rng([seed, code[c]])
        m = (n + 1) // 2
        u = rng.beta(m, n - m + 1, n_iter)
        ranks = [np.ceil(u * n)]
        if n % 2 == 0:
            ranks.append(np.ceil((u + (1 - u) * rng.beta(1, n - m, n_iter)) * n))
        # Percentiles of the resampled medians are medians at percentile ranks.
        both = np.mean(np.vstack(ranks), axis=0) - 1
        rows.append((c, [float(x) / max(n - 1, 1) for x in np.clip(np.percentile(both, [100 * tail, 100 - 100 * tail]), 0, n - 1)]))
    qs = sorted({q for _, pair in rows for q in pair})
    table = ordering.quantiles(melt(df, list(sizes)), "value", qs, ["feature"], ["feature"])
    low = {c: qs.index(p[0]) for c, p in rows}
    high = {c: qs.index(p[1]) for c, p in rows}
    at = lambda where: F.create_map(*[F.lit(x) for kv in where.items() for x in kv])[F.col("feature")]
    medians = table.select("feature", F.get("q", at(low)).alias("median_lower"), F.get("q", at(high)).alias("median_upper"))
    return means.join(medians, "feature").unionByName(short)


def _skew_z(g1: float, n: float) -> float:
    y = g1 * math.sqrt((n + 1) * (n + 3) / (6.0 * (n - 2)))
    b2 = 3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2.0) * (n + 5) * (n + 7) * (n + 9))
    w2 = math.sqrt(2 * (b2 - 1)) - 1
    a = math.sqrt(2.0 / (w2 - 1))
    return math.asinh(y / a) / math.sqrt(0.5 * math.log(w2))


def _kurt_z(g2: float, n: float) -> float:
    mean = 3.0 * (n - 1) / (n + 1)
    var = 24.0 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5))
    x = (g2 + 3 - mean) / math.sqrt(var)
    b1 = 6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * math.sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6.0 + 8.0 / b1 * (2.0 / b1 + math.sqrt(1 + 4.0 / (b1 * b1)))
    d = 1 + x * math.sqrt(2 / (a - 4.0))
    part = math.copysign(abs((1 - 2.0 / a) / d) ** (1 / 3), d) if d else 0.0
    return (1 - 2 / (9.0 * a) - part) / math.sqrt(2 / (9.0 * a))


def normality(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(feature, n, jb, jb_p, k2, k2_p)``: Jarque-Bera and the skew-kurtosis omnibus, from one pass of moments."""
    m = agg_long(df, list(cols or numeric_cols(df)), {"n": lambda c: F.count(c).cast("double"), "g1": F.skewness, "g2": F.kurtosis})
    jb = F.col("n") / 6 * (F.col("g1") * F.col("g1") + F.col("g2") * F.col("g2") / 4)
    k2 = special.on_results(lambda n, g1, g2: _skew_z(g1, n) ** 2 + _kurt_z(g2, n) ** 2 if n >= 20 else math.nan)
    out = m.withColumn("jb", jb).withColumn("k2", k2("n", "g1", "g2"))
    return out.select("feature", F.col("n").cast("long").alias("n"), "jb", F.exp(-F.col("jb") / 2).alias("jb_p"), "k2", F.exp(-F.col("k2") / 2).alias("k2_p"))


def mardia(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Multivariate skewness and kurtosis with p values.

    With whitened rows z, b1 is the squared norm of the mean third-moment tensor
    and b2 the mean of |z|^4, so one pass of sums replaces the n x n form.
    """
    mean, centred, n = raw_moments(df, cols)
    p = len(cols)
    white = np.linalg.inv(np.linalg.cholesky(centred / n))
    b1, b2 = gram.third_moments(df, cols, mean, white)
    stat = n * b1 / 6
    dof = p * (p + 1) * (p + 2) / 6
    zk = (b2 - p * (p + 2)) / math.sqrt(8 * p * (p + 2) / n)
    rows = [(int(n), b1, float(stat), float(special.chi2_sf(stat, dof)), b2, float(zk), float(2 * (1 - special.norm_cdf(abs(zk)))))]
    return df.sparkSession.createDataFrame(rows, "n long, skewness double, skew_stat double, skew_p double, kurtosis double, kurt_z double, kurt_p double")


def linear_fit(df: DataFrame, y: str, xs: Sequence[str]) -> tuple[float, dict[str, float]]:
    """Least squares by the normal equations of one aggregate: intercept and slopes."""
    mean, centred, _ = raw_moments(df, [*xs, y])
    k = len(xs)
    beta = np.linalg.lstsq(centred[:k, :k], centred[:k, k], rcond=None)[0]
    return float(mean[k] - beta @ mean[:k]), {c: float(b) for c, b in zip(xs, beta)}


def residual(y: str, intercept: float, slopes: dict[str, float]):
    fit = F.lit(intercept)
    for c, b in slopes.items():
        fit = fit + F.col(f"`{c}`") * b
    return F.col(f"`{y}`") - fit


def breusch_pagan(df: DataFrame, y: str, xs: Sequence[str]) -> DataFrame:
    """``(lm, lm_p, f, f_p)``: squared residuals regressed on the design."""
    data = as_numbers(df, [*xs, y]).dropna()
    b0, slopes = linear_fit(data, y, xs)
    sq = data.withColumn("__e2", F.pow(residual(y, b0, slopes), 2))
    mean, centred, n = raw_moments(sq, [*xs, "__e2"])
    k = len(xs)
    g = np.linalg.lstsq(centred[:k, :k], centred[:k, k], rcond=None)[0]
    r2 = float(g @ centred[:k, k] / centred[k, k])
    lm = n * r2
    f = (r2 / k) / ((1 - r2) / (n - k - 1))
    return df.sparkSession.createDataFrame(
        [(float(lm), float(special.chi2_sf(lm, k)), float(f), float(special.f_sf(f, k, n - k - 1)))], "lm double, lm_p double, f double, f_p double"
    )
