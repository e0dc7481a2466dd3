"""Outlier rules, multivariate detectors, votes and treatment."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import gram, ordering, special
from ..functions.columns import agg_long, as_numbers, evenly, melt, observed
from ..session import cut_lineage
from . import neighbors
from .hypothesis import linear_fit, residual
from .profile import corrected_kurtosis, corrected_skew, feature_quantiles, raw_moments

# Rule cutoffs and the limits of the detector choice.
IQR_K, WIDE_K = 1.5, 2.0
Z_LIMIT, MOD_Z_LIMIT, MOD_Z_FACTOR = 3.0, 3.5, 0.6745
LOW_PCT, HIGH_PCT = 0.01, 0.99
MULTI_CI = 0.975
CONTAMINATION = 0.01
MAX_FLAGGED = 0.05
LOF_NEIGHBOURS = 20
GAUSS_SKEW, GAUSS_KURT, GAUSS_SHARE, ROWS_PER_COLUMN = 1.0, 5.0, 0.60, 5
VOTES = 3
RULES = ("iqr", "zscore", "modz", "tukey", "percentile")


def fit_fences(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Plan table ``(feature, q1, q3, p1, p99, median, mad, mean, std)``."""
    q = feature_quantiles(df, cols, [LOW_PCT, 0.25, 0.5, 0.75, HIGH_PCT])
    rows = {r["feature"]: r["q"] for r in q.collect()}
    moments = {r["feature"]: r for r in agg_long(df, cols, {"mean": F.avg, "std": F.stddev_pop}).collect()}
    med = F.create_map(*[F.lit(x) for c, v in rows.items() for x in (c, v[2])]) if rows else None
    spread = {}
    if med is not None:
        gaps = melt(df, list(rows)).withColumn("gap", F.abs(F.col("value") - med[F.col("feature")]))
        spread = {r["feature"]: r["q"][0] for r in ordering.quantiles(gaps, "gap", [0.5], ["feature"], ["feature"]).collect()}
    out = [(c, v[1], v[3], v[0], v[4], v[2], spread[c], moments[c]["mean"], moments[c]["std"]) for c, v in rows.items()]
    return df.sparkSession.createDataFrame(
        out, "feature string, q1 double, q3 double, p1 double, p99 double, median double, mad double, mean double, std double"
    )


def rule_flag(x: Column, plan: Mapping, rule: str) -> Column:
    """Whether ``x`` breaks one rule; missing values never do."""
    q1, q3 = plan["q1"], plan["q3"]
    if rule in ("iqr", "tukey"):
        k = IQR_K if rule == "iqr" else WIDE_K
        hit = (x < q1 - k * (q3 - q1)) | (x > q3 + k * (q3 - q1))
    elif rule == "zscore":
        hit = (F.abs(x - plan["mean"]) / plan["std"] > Z_LIMIT) if plan["std"] else F.lit(False)
    elif rule == "modz":
        hit = (F.abs(MOD_Z_FACTOR * (x - plan["median"]) / plan["mad"]) > MOD_Z_LIMIT) if plan["mad"] else F.lit(False)
    elif rule == "percentile":
        hit = (x < plan["p1"]) | (x > plan["p99"])
    else:
        raise ValueError(f"unknown rule: {rule}")
    return F.coalesce(hit, F.lit(False))


def _plans(plan: DataFrame | Mapping) -> dict:
    return dict(plan) if isinstance(plan, Mapping) else {r["feature"]: r.asDict() for r in plan.collect()}


def flag_columns(df: DataFrame, plan: DataFrame | Mapping, rule: str) -> DataFrame:
    """``<col>_outlier`` 0/1 per fitted column."""
    return df.withColumns({f"{c}_outlier": rule_flag(observed(df, c), p, rule).cast("int") for c, p in _plans(plan).items()})


def rule_counts(df: DataFrame, plan: DataFrame | Mapping) -> DataFrame:
    """``(feature, rule, n)`` for every rule and column in one pass."""
    cells = [(c, r, rule_flag(observed(df, c), p, r)) for c, p in _plans(plan).items() for r in RULES]
    one = df.agg(*[F.count_if(f).alias(f"x{i}") for i, (_, _, f) in enumerate(cells)])
    rows = [F.struct(F.lit(c).alias("feature"), F.lit(r).alias("rule"), F.col(f"x{i}").alias("n")) for i, (c, r, _) in enumerate(cells)]
    return one.select(F.inline(F.array(*rows)))


def votes(df: DataFrame, plan: DataFrame | Mapping, vote_mode: str = "any", threshold: int = VOTES, multi: Column | None = None) -> DataFrame:
    """One 0/1 (or summed) column per rule, ``total_votes`` and ``is_outlier``.

    ``any``: a rule votes once per row however many columns break it.
    ``per_column``: votes add up over columns. ``multi`` is the verdict of a
    multivariate detector.
    """
    plans = _plans(plan)
    out = {}
    for r in RULES:
        flags = [rule_flag(observed(df, c), p, r).cast("int") for c, p in plans.items()]
        out[r] = reduce(lambda a, b: a + b, flags, F.lit(0)) if vote_mode == "per_column" else (F.greatest(*flags) if len(flags) > 1 else flags[0])
    if multi is not None:
        out["multivariate"] = multi.cast("int")
    voted = df.withColumns(out)
    total = reduce(lambda a, b: a + b, [F.col(n) for n in out])
    return voted.withColumn("total_votes", total).withColumn("is_outlier", F.col("total_votes") >= threshold)


def winsorize(df: DataFrame, plan: DataFrame | Mapping) -> DataFrame:
    """Every numeric column of every row clipped to its p1 and p99."""
    out = {}
    for c, p in _plans(plan).items():
        x = observed(df, c)
        out[c] = F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(p["p1"])), F.lit(p["p99"])))
    return df.withColumns(out)


def clip_counts(df: DataFrame, plan: DataFrame | Mapping) -> DataFrame:
    plans = _plans(plan)
    one = df.agg(*[F.count_if((observed(df, c) < p["p1"]) | (observed(df, c) > p["p99"])).alias(f"x{i}") for i, (c, p) in enumerate(plans.items())])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"x{i}").alias("n_clipped")) for i, c in enumerate(plans)])))


def treat(df: DataFrame, plan: DataFrame | Mapping, cap: bool | None = None, model_family: str | None = None, threshold: int = VOTES) -> DataFrame:
    """Winsorize (``cap=True``, or a linear or bayesian family unless ``cap=False``), drop voted rows, or leave."""
    if cap is True or (model_family in ("linear", "bayesian") and cap is not False):
        return winsorize(df, plan)
    if cap is None:
        return df
    return votes(df, plan, threshold=threshold).filter(~F.col("is_outlier")).select(*df.columns)


def flag_new(df: DataFrame, treated: DataFrame, cols: Sequence[str], threshold: int = VOTES) -> DataFrame:
    """New rows judged by fences of the treated training set, votes adding up over columns."""
    return votes(df, fit_fences(treated, cols), "per_column", threshold).drop(*RULES)


def _quadratic(z: Sequence[Column], a: np.ndarray) -> Column:
    total = F.lit(0.0)
    for i in range(len(z)):
        for j in range(i, len(z)):
            total = total + float(a[i, j] * (1 if i == j else 2)) * z[i] * z[j]
    return total


def mahalanobis(df: DataFrame, cols: Sequence[str], ci: float = MULTI_CI) -> DataFrame:
    """Complete rows with ``md2`` (squared distance under the empirical covariance) and ``is_outlier``."""
    mean, centred, n = raw_moments(df, cols)
    inv = np.linalg.pinv(centred / n)
    full = df.dropna(subset=list(cols))
    z = [F.col(f"`{c}`").cast("double") - float(m) for c, m in zip(cols, mean)]
    limit = special.chi2_ppf(ci, len(cols))
    return full.withColumn("md2", _quadratic(z, inv)).withColumn("is_outlier", F.col("md2") > limit)


def _gaps(x: np.ndarray, loc: np.ndarray, inverse: np.ndarray) -> np.ndarray:
    z = x - loc
    return ((z @ inverse) * z).sum(axis=1)


def _random_starts(rows: DataFrame, n: int, p: int, starts: int, seed: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Mean and covariance of ``starts`` groups of p + 1 different rows, those of the smallest hashes: the same rows on any cluster."""
    wanted = starts * (p + 1)
    key = F.xxhash64(F.lit(seed), "x")
    share = min(1.0, 64 * wanted / max(n, 1))
    while True:
        low = rows.filter(F.pmod(key, F.lit(1 << 40)) < int(share * (1 << 40))) if share < 1 else rows
        found = [r.x for r in low.select("x").distinct().orderBy(key, "x").limit(wanted).collect()]
        if len(found) == wanted or share >= 1:
            break
        share = min(1.0, 16 * share)
    groups = [np.array(found[i : i + p + 1]) for i in range(0, len(found) - p, p + 1)]
    return [(g.mean(axis=0), np.cov(g, rowvar=False, bias=True).reshape(p, p)) for g in groups]


def _ranked(d: np.ndarray) -> np.ndarray:
    """The bits of each number as an unsigned one of the same order; both zeros are one, and not a number comes last."""
    bits = (d + 0.0).view(np.uint64)
    return np.where(bits >> np.uint64(63), ~bits, bits | np.uint64(1 << 63))


def _cuts(rows: DataFrame, width: int, distances: Callable[[np.ndarray], Sequence[np.ndarray]], share: float) -> list[float]:
    """The exact linear-interpolated ``share`` quantile of each of the ``distances`` of matrices of rows.

    Four rounds, each one pass over the rows, fix 16 bits of the two values beside each position: tasks count the numbers that begin like them by
    their next 16 bits, so they hold and hand on the same few numbers whatever the rows.
    """
    n, begun = None, {}
    for step in range(4):
        low, shift = 16 * step, np.uint64(48 - 16 * step)
        wanted = sorted({(i, head) for (i, _), (head, _) in begun.items()})

        def contribute(x: np.ndarray, low=low, shift=shift, wanted=wanted):
            for i, d in enumerate(distances(x)):
                bits = _ranked(np.ascontiguousarray(d, float))
                for k, (_, head) in enumerate([(i, 0)] if not low else wanted):
                    if low and wanted[k][0] != i:
                        continue
                    some = bits if not low else bits[bits >> np.uint64(64 - low) == np.uint64(head)]
                    yield (i, k), np.bincount(((some >> shift) & np.uint64(0xFFFF)).astype(np.int64), minlength=1 << 16).astype(float)

        counts = gram.summed_blocks(rows, width, contribute)
        if not low:
            n = {i: int(c.sum()) for (i, _), c in counts.items()}
            ends = {i: share * (m - 1) for i, m in n.items()}
            begun = {(i, end): (0, int(f(at))) for i, at in ends.items() for end, f in enumerate((math.floor, math.ceil))}
        found = {}
        for (i, end), (head, at) in begun.items():
            upto = np.cumsum(counts[(i, 0 if not low else wanted.index((i, head)))])
            slot = int(np.searchsorted(upto, at, side="right"))
            found[(i, end)] = (head << 16 | slot, at - (int(upto[slot - 1]) if slot else 0))
        begun = found
    out = []
    for i, at in sorted(ends.items()):
        bits = np.array([begun[(i, end)][0] for end in (0, 1)], np.uint64)
        below, above = np.where(bits >> np.uint64(63), bits & np.uint64((1 << 63) - 1), ~bits).view(float)
        out.append(float(below + (above - below) * (at - math.floor(at))))
    return out


def _concentrate(rows: DataFrame, estimates: Sequence[tuple[np.ndarray, np.ndarray]], share: float) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """For every estimate: mean, covariance and its log determinant of the ``share`` of the rows nearest to it; all estimates together."""
    p = len(estimates[0][0])
    fixed = [(loc, np.linalg.pinv(cov)) for loc, cov in estimates]

    cut = _cuts(rows, p, lambda x: [_gaps(x, *f) for f in fixed], share)

    def contribute(x: np.ndarray):
        for i, f in enumerate(fixed):
            near = x[_gaps(x, *f) <= cut[i]]
            near = np.column_stack([np.ones(len(near)), near])
            yield (i, 0), near.T @ near

    sums = gram.summed_blocks(rows, p, contribute)
    out = []
    for i in range(len(fixed)):
        s = sums[(i, 0)]
        mean = s[0, 1:] / s[0, 0]
        cov = s[1:, 1:] / s[0, 0] - np.outer(mean, mean)
        sign, size = np.linalg.slogdet(cov)
        out.append((mean, cov, float(size) if sign > 0 else -np.inf))
    return out


def minimum_determinant(df: DataFrame, cols: Sequence[str], starts: int = 10, keep: int = 3, max_steps: int = 30, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance of the half of the complete rows whose covariance has the smallest determinant found.

    Starts are the medians with quartile spreads, and ``starts`` groups of p + 1
    rows. All take two concentration steps, the ``keep`` best go on until their
    determinant stops falling. A step of all starts is one exact distance
    quantile a start and one blocked product over all rows.
    """
    names, p = list(cols), len(cols)
    work = cut_lineage(evenly(as_numbers(df.dropna(subset=names), names)))
    n = work.count()
    quartiles = {r["feature"]: r["q"] for r in feature_quantiles(work, names, [0.25, 0.5, 0.75]).collect()}
    middle = np.array([quartiles[c][1] for c in names])
    spread = np.array([max((quartiles[c][2] - quartiles[c][0]) / 1.349, 1e-6) for c in names])
    rows = work.select(F.array(*[(F.col(f"`{c}`") - float(a)) / float(b) for c, a, b in zip(names, middle, spread)]).alias("x"))
    share = ((n + p + 1) // 2 - 1) / max(n - 1, 1)
    now = [(loc, cov, np.inf) for loc, cov in [(np.zeros(p), np.eye(p)), *_random_starts(rows, n, p, starts, seed)]]
    for _ in range(2):
        now = _concentrate(rows, [e[:2] for e in now], share)
    going = sorted(now, key=lambda e: e[2])[:keep]
    best = going[0]
    for _ in range(max_steps):
        after = _concentrate(rows, [e[:2] for e in going], share)
        best = min([best, *after], key=lambda e: e[2])
        going = [b for a, b in zip(going, after) if b[2] < a[2] - 1e-9]
        if not going:
            break
    return middle + spread * best[0], best[1] * np.outer(spread, spread)


def robust_mahalanobis(df: DataFrame, cols: Sequence[str], ci: float = MULTI_CI, max_steps: int = 30, starts: int = 10, seed: int = 0) -> DataFrame:
    """``md2`` under the minimum-determinant covariance, after consistency correction and one reweighting.

    Where half of the rows lie in one plane that covariance has no inverse, and the one of all rows is taken.
    """
    names = list(cols)
    p = len(names)
    full = df.dropna(subset=names)
    work = cut_lineage(evenly(as_numbers(full, names)))
    shift = lambda m: [F.col(f"`{c}`") - float(v) for c, v in zip(names, m)]
    loc, cov = minimum_determinant(work, names, starts=starts, max_steps=max_steps, seed=seed)
    d = work.withColumn("__d", _quadratic(shift(loc), np.linalg.pinv(cov)))
    middle = ordering.quantiles(d, "__d", [0.5]).first()["q"][0]
    if np.linalg.matrix_rank(cov, hermitian=True) < p or not middle:
        return mahalanobis(full, names, ci)
    factor = middle / special.chi2_ppf(0.5, p)
    limit = special.chi2_ppf(ci, p)
    mean, centred, m = raw_moments(d.filter(F.col("__d") / factor < limit), names)
    cov2 = centred / m
    d2 = work.withColumn("__d", _quadratic(shift(mean), np.linalg.pinv(cov2)))
    factor2 = ordering.quantiles(d2, "__d", [0.5]).first()["q"][0] / special.chi2_ppf(0.5, p)
    z = [F.col(f"`{c}`").cast("double") - float(v) for c, v in zip(names, mean)]
    return full.withColumn("md2", _quadratic(z, np.linalg.pinv(cov2 * factor2))).withColumn("is_outlier", F.col("md2") > limit)


def local_outliers(df: DataFrame, cols: Sequence[str], key: str, contamination: float = CONTAMINATION, k: int = LOF_NEIGHBOURS) -> DataFrame:
    """``(key, lof, is_outlier)`` of complete rows; the cutoff is the contamination quantile over rows."""
    scored = cut_lineage(neighbors.local_outlier_factor(df, cols, key, k))
    data = as_numbers(df, cols, [key]).dropna()
    vec = F.array(*[F.col(f"`{c}`") + 0.0 for c in cols])
    rows = data.select(key, vec.alias("vec")).join(scored.select("vec", "lof"), "vec")
    cut = ordering.quantiles(rows, "lof", [1 - contamination]).first()["q"][0]
    return rows.select(key, "lof", (F.col("lof") > cut).alias("is_outlier"))


def _path_norm(n: np.ndarray) -> np.ndarray:
    n = np.asarray(n, dtype=float)
    out = np.where(n == 2, 1.0, 0.0)
    big = n > 2
    out[big] = 2 * (np.log(n[big] - 1) + np.euler_gamma) - 2 * (n[big] - 1) / n[big]
    return out


def fit_forest(df: DataFrame, cols: Sequence[str], key: str, trees: int = 100, sample: int = 256, seed: int = 42) -> list[pd.DataFrame]:
    """Isolation trees as node tables; one task per tree on its own bounded sample.

    The rows with the smallest keyed hashes form the pool (``trees * sample`` rows
    at most), whatever the input size.
    """
    names = list(cols)
    data = as_numbers(df, names, [F.xxhash64(F.col(key), F.lit(seed)).alias("__h")]).dropna()
    pool = data.orderBy("__h").limit(trees * sample)
    jobs = pool.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
    n_pool = pool.count()
    if n_pool > sample:
        share = max(sample / n_pool, 1.0 / trees)
        jobs = jobs.filter(F.pmod(F.xxhash64("__h", "tree"), F.lit(1_000_000)) < int(share * 1.3 * 1_000_000) + 1)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        rng = np.random.default_rng([seed, tree])
        x = pdf.sort_values("__h")[names].to_numpy()
        x = x[rng.permutation(len(x))[:sample]]
        depth = int(np.ceil(np.log2(max(len(x), 2))))
        nodes: list[list[float]] = []

        def build(idx: np.ndarray, level: int) -> int:
            at = len(nodes)
            nodes.append([tree, at, -1, 0.0, -1, -1, float(len(idx)), float(level)])
            lo, hi = x[idx].min(axis=0), x[idx].max(axis=0)
            open_cols = np.flatnonzero(hi > lo)
            if level < depth and len(idx) > 1 and len(open_cols):
                f = int(rng.choice(open_cols))
                t = float(rng.uniform(lo[f], hi[f]))
                left = x[idx, f] < t
                nodes[at][2:4] = [f, t]
                nodes[at][4] = build(idx[left], level + 1) if left.any() else -1
                nodes[at][5] = build(idx[~left], level + 1)
                if nodes[at][4] < 0:
                    nodes[at][2] = -1
            return at

        build(np.arange(len(x)), 0)
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "cut", "left", "right", "size", "depth"])

    kind = "tree double, node double, feature double, cut double, left double, right double, size double, depth double"
    model = jobs.groupBy("tree").applyInPandas(grow, kind).toPandas()
    return [t.sort_values("node").reset_index(drop=True) for _, t in model.groupby("tree")]


def forest_scores(df: DataFrame, cols: Sequence[str], key: str, forest: list[pd.DataFrame], sample: int = 256) -> DataFrame:
    """``(key, score)`` of complete rows: 2^(-mean path / expected path), higher is stranger."""
    packed = [
        (t["feature"].to_numpy(int), t["cut"].to_numpy(), t["left"].to_numpy(int), t["right"].to_numpy(int), (t["depth"] + _path_norm(t["size"].to_numpy())).to_numpy())
        for t in forest
    ]
    size = max(float(t["size"].iloc[0]) for t in forest)
    names = list(cols)
    scale = float(_path_norm(np.array([size]))[0]) or 1.0

    def score(batches):
        for pdf in batches:
            x = pdf[names].to_numpy(dtype=float)
            total = np.zeros(len(x))
            for feature, cut, left, right, path in packed:
                at = np.zeros(len(x), dtype=int)
                for _ in range(64):
                    f = feature[at]
                    live = f >= 0
                    if not live.any():
                        break
                    go = x[np.arange(len(x)), np.maximum(f, 0)] < cut[at]
                    at = np.where(live, np.where(go, left[at], right[at]), at)
                total += path[at]
            yield pd.DataFrame({key: pdf[key], "score": np.power(2.0, -total / len(packed) / scale)})

    return as_numbers(df, names, [F.col(key).cast("long").alias(key)]).dropna().mapInPandas(score, f"{key} long, score double")


def isolation_outliers(df: DataFrame, cols: Sequence[str], key: str, contamination: float = CONTAMINATION, trees: int = 100, sample: int = 256, seed: int = 42) -> DataFrame:
    scored = cut_lineage(forest_scores(df, cols, key, fit_forest(df, cols, key, trees, sample, seed), sample))
    cut = ordering.quantiles(scored, "score", [1 - contamination]).first()["q"][0]
    return scored.withColumn("is_outlier", F.col("score") > cut)


def multivariate_outliers(df: DataFrame, cols: Sequence[str], key: str, local: bool = False) -> tuple[str, DataFrame]:
    """The detector that fits the data's shape, as ``(method, (key, is_outlier))``.

    More columns than rows: forest. Enough rows and near-Gaussian columns:
    Mahalanobis, with the robust covariance if it flags too many. Else, if the
    caller asks for it by ``local``, the local factor. A detector flagging more than 5% gives way to the forest.
    """
    names = list(cols)
    full = as_numbers(df, names, [key]).dropna()
    n = full.count()
    p = len(names)
    if n < 3 or p == 0:
        return "none", full.select(key, F.lit(False).alias("is_outlier"))
    share = lambda t: t.agg(F.avg(F.col("is_outlier").cast("double"))).first()[0] or 0.0
    if p < n:
        shape = agg_long(full, names, {"s": corrected_skew, "k": corrected_kurtosis}).collect()
        gauss = sum(1 for r in shape if r["s"] is not None and r["k"] is not None and abs(r["s"]) < GAUSS_SKEW and abs(r["k"]) < GAUSS_KURT) / p
        if n >= ROWS_PER_COLUMN * p and gauss >= GAUSS_SHARE:
            out = mahalanobis(full, names)
            if share(out) > MAX_FLAGGED:
                out = robust_mahalanobis(full, names)
            if share(out) <= MAX_FLAGGED:
                return "mahalanobis", out.select(key, "is_outlier")
        if local:
            out = local_outliers(full, names, key)
            if share(out) <= MAX_FLAGGED:
                return "lof", out.select(key, "is_outlier")
    return "isolation", isolation_outliers(full, names, key).select(key, "is_outlier")


def full_votes(df: DataFrame, cols: Sequence[str], key: str, threshold: int = VOTES, local: bool = False) -> DataFrame:
    """Rule votes plus the vote of the chosen multivariate detector."""
    _, multi = multivariate_outliers(df, cols, key, local)
    joined = df.join(multi.withColumnRenamed("is_outlier", "__multi"), key, "left")
    return votes(joined, fit_fences(df, cols), "any", threshold, F.coalesce("__multi", F.lit(False))).drop("__multi")


def residual_outliers(df: DataFrame, y: str, x: str, limit: float = 3.0) -> DataFrame:
    """Rows whose residual of y on x exceeds ``limit`` deviations."""
    a, slopes = linear_fit(df, y, [x])
    out = df.withColumn("residual", residual(y, a, slopes))
    sigma = out.agg(F.stddev_pop("residual")).scalar()
    return out.withColumn("is_outlier", F.abs("residual") > limit * sigma)


def component_outliers(df: DataFrame, cols: Sequence[str], k: int = 2, ci: float = MULTI_CI) -> DataFrame:
    """Mahalanobis distance among the first ``k`` principal components of standardized columns."""
    names = list(cols)
    stats = {r["feature"]: r for r in agg_long(df, names, {"m": F.avg, "s": F.stddev_pop}).collect()}
    full = df.dropna(subset=names)
    z = full.withColumns({f"__z{i}": (F.col(f"`{c}`") - stats[c]["m"]) / (stats[c]["s"] or 1.0) for i, c in enumerate(names)})
    vec = VectorAssembler(inputCols=[f"__z{i}" for i in range(len(names))], outputCol="__v").transform(z)
    pcs = PCA(k=k, inputCol="__v", outputCol="__p").fit(vec).transform(vec)
    arr = pcs.withColumn("__a", vector_to_array("__p"))
    flat = arr.withColumns({f"pc{i + 1}": F.get("__a", F.lit(i)) for i in range(k)})
    keep = [*df.columns, *[f"pc{i + 1}" for i in range(k)]]
    return mahalanobis(flat.select(*keep), [f"pc{i + 1}" for i in range(k)], ci)


def replace_with_median(df: DataFrame, plan: DataFrame | Mapping, rule: str = "iqr") -> DataFrame:
    """Flag columns kept, flagged values replaced by the median."""
    plans = _plans(plan)
    flagged = flag_columns(df, plans, rule)
    return flagged.withColumns({c: F.when(F.col(f"{c}_outlier") == 1, F.lit(p["median"])).otherwise(observed(df, c)) for c, p in plans.items()})
