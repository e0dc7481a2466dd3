"""Scalers, power and quantile transforms, and the choice between them."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import special
from ..functions.columns import agg_long, as_numbers, numeric_cols, observed
from .profile import feature_quantiles

# Selection cutoffs, the small offset of the reciprocal, and landmark count.
ROBUST_SKEW, ROBUST_KURT, STANDARD_SKEW = 1.0, 5.0, 0.5
ALPHA_SIMPLE, SKEW_SIMPLE = 0.05, 0.75
ALPHA_ENHANCED, SKEW_ENHANCED = 0.10, 0.5
CELL_SWITCH = 1_000_000
GLOBAL_SHARE = 0.90
LANDMARKS = 1000
EPS = 1e-9
BOXCOX_GRID = (-2.0, -1.0, -0.5, 0.0, 0.5, 1.0, 2.0)

PRE = {
    "none": lambda x: x,
    "log1p": lambda x: F.when(x >= 0, F.log1p(x)),
    "sqrt": lambda x: F.when(x >= 0, F.sqrt(x)),
    "cbrt": F.cbrt,
    "reciprocal": lambda x: F.try_divide(F.lit(1.0), x + EPS),
}
EXTRA_PRE = {"exp": F.exp, "square": lambda x: x * x, "cube": lambda x: x * x * x}


def scaler_parameters(df: DataFrame, cols: Sequence[str], scaler: str) -> DataFrame:
    """Plan table ``(feature, center, scale)`` of one scaler; a zero scale becomes 1."""
    if scaler == "robust":
        q = feature_quantiles(df, cols, [0.25, 0.5, 0.75])
        out = q.select("feature", F.get("q", F.lit(1)).alias("center"), (F.get("q", F.lit(2)) - F.get("q", F.lit(0))).alias("scale"))
    else:
        center, scale = {
            "standard": (F.avg, F.stddev_pop),
            "minmax": (F.min, lambda c: F.max(c) - F.min(c)),
            "maxabs": (lambda c: F.min(F.lit(0.0)), lambda c: F.max(F.abs(c))),
        }[scaler]
        out = agg_long(df, cols, {"center": center, "scale": scale})
    return out.withColumn("scale", F.when(F.col("scale") == 0, 1.0).otherwise(F.col("scale")))


def scale(df: DataFrame, cols: Sequence[str], scaler: str = "standard", plan: DataFrame | None = None) -> DataFrame:
    fitted = {r["feature"]: r for r in (plan or scaler_parameters(df, cols, scaler)).collect()}
    return df.withColumns({c: (observed(df, c) - fitted[c]["center"]) / fitted[c]["scale"] for c in cols if c in fitted and fitted[c]["center"] is not None})


def row_normalize(df: DataFrame, cols: Sequence[str], norm: str = "l2") -> DataFrame:
    """Each row divided by its own L1 or L2 length; a zero row stays."""
    xs = [observed(df, c) for c in cols]
    size = reduce(lambda a, b: a + b, [F.abs(x) if norm == "l1" else x * x for x in xs])
    size = size if norm == "l1" else F.sqrt(size)
    return df.withColumns({c: F.when(size == 0, x).otherwise(x / size) for c, x in zip(cols, xs)})


def apply_function(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    fn = {**PRE, **EXTRA_PRE}[name]
    return df.withColumns({f"{c}_{name}": fn(observed(df, c)) for c in cols})


def validity(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(feature, boxcox_ok, root_ok, reciprocal_ok)`` from one pass of minimum and near-zero counts."""
    out = agg_long(df, cols, {"low": F.min, "zeros": lambda c: F.count_if(F.abs(c) <= 1e-8)})
    return out.select("feature", (F.col("low") > 0).alias("boxcox_ok"), (F.col("low") >= 0).alias("root_ok"), (F.col("zeros") == 0).alias("reciprocal_ok"))


def boxcox(x: Column, lam: float) -> Column:
    good = F.when(x > 0, x)
    return F.ln(good) if abs(lam) < 1e-12 else (F.pow(good, F.lit(lam)) - 1) / lam


def yeo_johnson(x: Column, lam: float) -> Column:
    up = F.log1p(x) if abs(lam) < 1e-12 else (F.pow(x + 1, F.lit(lam)) - 1) / lam
    down = -F.log1p(-x) if abs(lam - 2) < 1e-12 else -(F.pow(1 - x, F.lit(2 - lam)) - 1) / (2 - lam)
    return F.when(x >= 0, up).otherwise(F.when(x < 0, down))


def _profiles(x: np.ndarray, lams: np.ndarray, kind: str) -> tuple[float, np.ndarray]:
    """Sum of the log Jacobian factors of known values, and their transforms, a row for each candidate lambda."""

    def raised(logs: np.ndarray, powers: np.ndarray) -> np.ndarray:
        flat = powers == 0
        return np.where(flat[:, None], logs, (np.exp(np.outer(powers, logs)) - 1) / np.where(flat, 1.0, powers)[:, None])

    with np.errstate(all="ignore"):
        if kind == "boxcox":
            logs = np.log(x[x > 0])
            return float(logs.sum()), raised(logs, lams)
        up, down = np.log1p(x[x >= 0]), np.log1p(-x[x < 0])
        return float(up.sum() - down.sum()), np.hstack([raised(up, lams), -raised(down, 2 - lams)])


def _likelihoods(df: DataFrame, jobs: Mapping[str, Sequence[float]], kind: str) -> dict[str, list[float]]:
    """Profile log likelihood of every candidate lambda of every column, one scan.

    A task raises whole batches for all candidates together and hands on counts, means and squared gaps, a row for each column.
    """
    grids = [np.array(grid, float) for grid in jobs.values()]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = [[0, 0.0, (0, np.zeros(len(g)), np.zeros(len(g)))] for g in grids]
        for b in batches:
            for at, lams, c in zip(total, grids, b.columns, strict=True):
                x = b[c].dropna().to_numpy(float)
                jac, y = _profiles(x, lams, kind)
                at[0], at[1] = at[0] + len(x), at[1] + jac
                if y.shape[1]:
                    with np.errstate(all="ignore"):
                        mean = y.mean(axis=1)
                        at[2] = _merged(at[2], (y.shape[1], mean, ((y - mean[:, None]) ** 2).sum(axis=1)))
        yield pd.DataFrame([(i, n, j, m[0], m[1], m[2]) for i, (n, j, m) in enumerate(total)], columns=["i", "n", "j", "used", "mean", "gap"])

    parts = df.select(*[observed(df, c).alias(f"x{i}") for i, c in enumerate(jobs)]).mapInPandas(run, "i int, n long, j double, used long, mean array<double>, gap array<double>").collect()
    out = {}
    for i, (c, grid) in enumerate(jobs.items()):
        mine = [r for r in parts if r["i"] == i]
        n, jac = sum(r["n"] for r in mine), sum(r["j"] for r in mine)
        used, _, gap = reduce(_merged, [(r["used"], np.array(r["mean"], float), np.array(r["gap"], float)) for r in mine if r["used"]], (0, 0.0, np.zeros(len(grid))))
        v = gap / max(used, 1)
        out[c] = [float((at - 1) * jac - n / 2 * math.log(u)) if u > 0 and math.isfinite(u) else -math.inf for at, u in zip(grid, v, strict=True)]
    return out


def _merged(a: tuple, b: tuple) -> tuple:
    """Count, means and squared gaps of two parts together."""
    if not a[0]:
        return b
    n, apart = a[0] + b[0], b[1] - a[1]
    return n, a[1] + apart * (b[0] / n), a[2] + b[2] + apart * apart * (a[0] * b[0] / n)


def best_lambda(df: DataFrame, cols: Sequence[str], kind: str = "boxcox", grid: Sequence[float] | None = None) -> dict[str, float]:
    """Maximum-likelihood lambda per column: shrinking grids, one pass each, then a parabola.

    With ``grid`` only its values are tried.
    """
    jobs = {c: list(grid or np.linspace(-4, 4, 17)) for c in cols}
    step = 0.5
    best: dict[str, float] = {}
    for turn in range(1 if grid else 4):
        scores = _likelihoods(df, jobs, kind)
        for c, lls in scores.items():
            k = int(np.argmax(lls))
            best[c] = float(jobs[c][k])
            if not grid and turn == 3 and 0 < k < len(lls) - 1:
                a, b, d = lls[k - 1], lls[k], lls[k + 1]
                if a - 2 * b + d < 0:
                    best[c] += 0.5 * (a - d) / (a - 2 * b + d) * (jobs[c][1] - jobs[c][0])
        jobs = {c: list(np.linspace(best[c] - step, best[c] + step, 17)) for c in cols}
        step /= 8
    return best


def power_transform(df: DataFrame, cols: Sequence[str], kind: str = "boxcox", lambdas: Mapping[str, float] | None = None, standardize: bool | None = None) -> DataFrame:
    """Box-Cox, or Yeo-Johnson (then standardized by default)."""
    lams = dict(lambdas) if lambdas else best_lambda(df, cols, kind)
    fn = boxcox if kind == "boxcox" else yeo_johnson
    out = df.withColumns({c: fn(observed(df, c), lams[c]) for c in cols})
    return scale(out, cols) if (kind == "yeo" if standardize is None else standardize) else out


def landmarks(df: DataFrame, cols: Sequence[str], count: int = LANDMARKS) -> dict[str, list[float]]:
    """Evenly spaced quantiles per column, at most ``count`` numbers each."""
    sizes = agg_long(df, cols, {"n": F.count}).agg(F.max("n")).first()[0] or 0
    k = int(min(count, max(2, sizes)))
    return {r["feature"]: list(r["q"]) for r in feature_quantiles(df, cols, list(np.linspace(0, 1, k))).collect()}


def _rank_map(x: Column, marks: Sequence[float], normal: bool = False) -> Column:
    """Position of x among the landmarks as a share in [0, 1], ties in the middle, or its normal quantile; both searches go over whole batches."""
    m = np.array(marks, float)

    @F.pandas_udf("double")
    def place(values: pd.Series) -> pd.Series:
        v = values.to_numpy(float)
        lo, hi = np.searchsorted(m, v, "left"), np.searchsorted(m, v, "right")
        left, right = m[np.maximum(lo - 1, 0)], m[np.minimum(lo, len(m) - 1)]
        with np.errstate(all="ignore"):
            inside = np.where(lo < hi, (lo + hi - 1) / 2, lo - 1 + (v - left) / (right - left)) / (len(m) - 1)
        u = np.where(np.isnan(v), np.nan, np.where(v <= m[0], 0.0, np.where(v >= m[-1], 1.0, inside)))
        # As with least and greatest of columns, a missing value takes the lower limit.
        return pd.Series(special.norm_ppf_array(np.fmin(np.fmax(u, 1e-7), 1 - 1e-7)) if normal else u)

    return place(x)


def quantile_transform(df: DataFrame, cols: Sequence[str], output: str = "normal", marks: Mapping[str, Sequence[float]] | None = None) -> DataFrame:
    """Rank map onto a uniform or normal shape."""
    fitted = dict(marks) if marks else landmarks(df, cols)
    out = {}
    for c in cols:
        out[c] = _rank_map(observed(df, c), fitted[c], output == "normal")
    return df.withColumns(out)


def shape_scores(df: DataFrame, jobs: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """``(feature, method, skew, p)`` of every candidate column expression, one aggregate.

    p is the Jarque-Bera p value from the same moments; a constant scores p 1, skew 0.
    """
    made = [(c, m, e) for c, ms in jobs.items() for m, e in ms.items()]
    cells = [F.struct(F.lit(c).alias("feature"), F.lit(m).alias("method"), F.col(f"e{i}").alias("e")) for i, (c, m, _) in enumerate(made)]
    rows = df.select(*[e.alias(f"e{i}") for i, (_, _, e) in enumerate(made)]).select(F.inline(F.array(*cells)))
    out = rows.groupBy("feature", "method").agg(F.count("e").cast("double").alias("n"), F.skewness("e").alias("s"), F.kurtosis("e").alias("k"))
    ok = F.col("s").isNotNull() & ~F.isnan("s")
    p = F.exp(-F.col("n") / 12 * (F.col("s") * F.col("s") + F.col("k") * F.col("k") / 4))
    return out.select("feature", "method", F.when(ok, F.abs("s")).otherwise(0.0).alias("skew"), F.when(ok, p).otherwise(1.0).alias("p"))


def global_scaler(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row ``(scaler, max_skew, max_kurt)``: robust for heavy tails, standard for symmetry, else min-max."""
    m = agg_long(df, list(cols or numeric_cols(df)), {"s": F.skewness, "k": F.kurtosis})
    m = m.agg(F.max(F.abs(F.coalesce("s", F.lit(0.0)))).alias("max_skew"), F.max(F.abs(F.coalesce("k", F.lit(0.0)))).alias("max_kurt"))
    pick = F.when((F.col("max_skew") > ROBUST_SKEW) | (F.col("max_kurt") > ROBUST_KURT), "robust").when(F.col("max_skew") < STANDARD_SKEW, "standard").otherwise("minmax")
    return m.select(pick.alias("scaler"), "max_skew", "max_kurt")


def _valid_pre(df: DataFrame, cols: Sequence[str]) -> dict[str, list[str]]:
    ok = {r["feature"]: r for r in validity(df, cols).collect()}
    return {
        c: ["none", "cbrt"] + (["log1p", "sqrt"] if ok[c]["root_ok"] else []) + (["reciprocal"] if ok[c]["reciprocal_ok"] else []) for c in cols
    }


def best_pre(df: DataFrame, cols: Sequence[str], alpha: float = ALPHA_ENHANCED, max_skew: float = SKEW_ENHANCED) -> DataFrame:
    """``(feature, method, p, skew, passed)``: first good closed-form function, else the best (p, -skew).

    Affine scalers change neither skewness nor normality, so only the functions compete.
    """
    valid = _valid_pre(df, cols)
    jobs = {c: {m: PRE[m](observed(df, c)) for m in PRE if m in valid[c]} for c in cols}
    order = F.create_map(*[F.lit(x) for i, m in enumerate(PRE) for x in (m, i)])
    s = shape_scores(df, jobs).withColumn("passed", (F.col("p") > alpha) & (F.col("skew") < max_skew))
    rank = F.struct(
        F.col("passed").cast("int").alias("a"),
        F.when(F.col("passed"), -order[F.col("method")]).otherwise(0).alias("b"),
        F.col("p").alias("c"),
        (-F.col("skew")).alias("d"),
        (-order[F.col("method")]).alias("e"),
    )
    return s.groupBy("feature").agg(F.max_by(F.struct("method", "p", "skew", "passed"), rank).alias("r")).select("feature", "r.*")


def extra_choice(df: DataFrame, cols: Sequence[str], alpha: float = ALPHA_SIMPLE, max_skew: float = SKEW_SIMPLE) -> DataFrame:
    """``(feature, method, lambda, p, skew)`` among none, boxcox, yeo and quantile by (p, -skew).

    A column that already looks normal keeps ``none``.
    """
    return _extra_choice(df, cols, alpha, max_skew)[0]


def _extra_choice(df: DataFrame, cols: Sequence[str], alpha: float = ALPHA_SIMPLE, max_skew: float = SKEW_SIMPLE) -> tuple[DataFrame, dict[str, list[float]]]:
    """The choice and the landmarks that the quantile transform was judged with."""
    names = list(cols)
    ok = {r["feature"]: r["boxcox_ok"] for r in validity(df, names).collect()}
    positive = [c for c in names if ok[c]]
    lam_b = best_lambda(df, positive, "boxcox") if positive else {}
    lam_y = best_lambda(df, names, "yeo")
    marks = landmarks(df, names)
    jobs: dict[str, dict[str, Column]] = {}
    for c in names:
        x = observed(df, c)
        jobs[c] = {"none": x, "yeo": yeo_johnson(x, lam_y[c])}
        if c in lam_b:
            jobs[c]["boxcox"] = boxcox(x, lam_b[c])
        jobs[c]["quantile"] = _rank_map(x, marks[c], True)
    s = shape_scores(df, jobs)
    fine = (F.col("method") == "none") & (F.col("p") > alpha) & (F.col("skew") < max_skew)
    rank = F.struct(fine.cast("int").alias("a"), F.col("p").alias("b"), (-F.col("skew")).alias("c"))
    best = s.groupBy("feature").agg(F.max_by(F.struct("method", "p", "skew"), rank).alias("r")).select("feature", "r.*")
    lam = lambda d: F.create_map(*[F.lit(x) for kv in d.items() for x in kv])[F.col("feature")] if d else F.lit(None).cast("double")
    return best.select("feature", "method", F.when(F.col("method") == "boxcox", lam(lam_b)).when(F.col("method") == "yeo", lam(lam_y)).alias("lambda"), "p", "skew"), marks


def mode_switch(df: DataFrame, cols: Sequence[str], cells: int = CELL_SWITCH) -> str:
    """A report only: ``enhanced`` below ``cells`` rows x columns, else ``simple``; no fit is steered by it."""
    limit = math.ceil(cells / max(len(cols), 1))
    return "enhanced" if df.select(*cols[:1]).limit(limit).count() * len(cols) < cells else "simple"


def global_plan(df: DataFrame, cols: Sequence[str], share: float = GLOBAL_SHARE) -> DataFrame:
    """``(method, pass_share, use_global)``: the function most columns pass with, usable for all if ``share`` pass."""
    valid = _valid_pre(df, cols)
    common = [m for m in PRE if all(m in valid[c] for c in cols)]
    s = shape_scores(df, {c: {m: PRE[m](observed(df, c)) for m in common} for c in cols})
    passed = ((F.col("p") > ALPHA_ENHANCED) & (F.col("skew") < SKEW_ENHANCED)).cast("double")
    per = s.groupBy("method").agg(F.avg(passed).alias("pass_share"), F.avg("p").alias("mean_p"), (-F.avg("skew")).alias("neg_skew"))
    best = per.agg(F.max_by(F.struct("method", "pass_share"), F.struct("pass_share", "mean_p", "neg_skew")).alias("r")).select("r.*")
    return best.withColumn("use_global", F.col("pass_share") >= share)


def fit_plan(df: DataFrame, cols: Sequence[str] | None = None, mode: str = "enhanced") -> DataFrame:
    """Plan table ``(feature, pre, extra, lambda, landmarks, center, scale, p, skew)``.

    Simple mode: one scaler for all plus the best extra transform per column.
    Enhanced mode: the best closed-form function per column, then the extra
    transform, then standardization. All parameters are stored.
    """
    names = list(cols or numeric_cols(df))
    pre = {c: "none" for c in names}
    if mode == "enhanced":
        pre |= {r["feature"]: r["method"] for r in best_pre(df, names).collect()}
    staged = as_numbers(df, names).select(*[PRE[pre[c]](F.col(f"`{c}`")).alias(c) for c in names])
    choice, marks = _extra_choice(staged, names)
    extra = {r["feature"]: r for r in choice.collect()}
    marks = {c: marks[c] for c in names if extra[c]["method"] == "quantile"}
    scaler = "standard" if mode == "enhanced" else global_scaler(df, names).first()["scaler"]
    shaped = staged.select(*[_extra(F.col(f"`{c}`"), extra[c]["method"], extra[c]["lambda"], marks.get(c)).alias(c) for c in names])
    par = {r["feature"]: r for r in scaler_parameters(shaped, names, scaler).collect()}
    rows = [
        (c, pre[c], extra[c]["method"], extra[c]["lambda"], marks.get(c), scaler, par[c]["center"], par[c]["scale"], extra[c]["p"], extra[c]["skew"]) for c in names
    ]
    return df.sparkSession.createDataFrame(
        rows, "feature string, pre string, extra string, lambda double, landmarks array<double>, scaler string, center double, scale double, p double, skew double"
    )


def _extra(x: Column, method: str, lam: float | None, marks: Sequence[float] | None) -> Column:
    if method == "boxcox":
        return boxcox(x, lam)
    if method == "yeo":
        return yeo_johnson(x, lam)
    if method == "quantile":
        return _rank_map(x, marks, True)
    return x


def apply_plan(df: DataFrame, plan: DataFrame) -> DataFrame:
    out = {}
    for r in plan.collect():
        if r["feature"] in df.columns:
            x = _extra(PRE[r["pre"]](observed(df, r["feature"])), r["extra"], r["lambda"], r["landmarks"])
            out[r["feature"]] = (x - F.lit(r["center"])) / F.lit(r["scale"])
    return df.withColumns(out)


def polynomial(df: DataFrame, cols: Sequence[str], degree: int = 2) -> DataFrame:
    """Powers up to ``degree`` and pairwise products and sums, under derived names."""
    out = {f"{c}^{d}": F.pow(observed(df, c), F.lit(float(d))) for c in cols for d in range(2, degree + 1)}
    for i, a in enumerate(cols):
        for b in cols[i + 1 :]:
            out[f"{a}*{b}"] = observed(df, a) * observed(df, b)
            out[f"{a}+{b}"] = observed(df, a) + observed(df, b)
    return df.withColumns(out)
