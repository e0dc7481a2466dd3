"""Fitted families, goodness of fit, probability transforms and the copula."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ordering, special
from ..functions.columns import as_numbers, melt, observed
from ..session import cut_lineage
from .profile import cross_products

# The candidate families of both variants and their support.
FAMILIES = ("norm", "lognorm", "gamma", "beta", "weibull_min", "expon", "pareto", "t", "cauchy", "rayleigh", "triang")
SHORT_FAMILIES = ("norm", "lognorm", "gamma", "beta", "weibull_min")
POSITIVE = ("lognorm", "gamma", "weibull_min", "expon", "pareto", "rayleigh")
UNIT = ("beta", "triang")
T_DEGREES = (2.0, 3.0, 5.0, 10.0, 30.0)


def cdf_array(family: str, p: Sequence[float], x: np.ndarray) -> np.ndarray:
    """Distribution function of a fitted family on an array."""
    if family == "norm":
        return np.array([special.norm_cdf((v - p[0]) / p[1]) for v in x])
    if family == "lognorm":
        return np.array([special.norm_cdf((math.log(v) - p[0]) / p[1]) if v > 0 else 0.0 for v in x])
    if family == "gamma":
        return np.array([special.gamma_p(p[0], v / p[1]) if v > 0 else 0.0 for v in x])
    if family == "beta":
        return np.array([special.beta_i(p[0], p[1], v) for v in x])
    if family == "weibull_min":
        return 1 - np.exp(-np.power(np.maximum(x, 0) / p[1], p[0]))
    if family == "expon":
        return 1 - np.exp(-np.maximum(x - p[0], 0) / p[1])
    if family == "pareto":
        return np.where(x >= p[0], 1 - np.power(p[0] / np.maximum(x, p[0]), p[1]), 0.0)
    if family == "t":
        z = (x - p[1]) / p[2]
        half = np.array([special.beta_i(p[0] / 2, 0.5, p[0] / (p[0] + v * v)) / 2 for v in z])
        return np.where(z >= 0, 1 - half, half)
    if family == "cauchy":
        return 0.5 + np.arctan((x - p[0]) / p[1]) / math.pi
    if family == "rayleigh":
        return 1 - np.exp(-np.maximum(x, 0) ** 2 / (2 * p[0] ** 2))
    lo, mode, hi = p
    left = (x - lo) ** 2 / max((hi - lo) * (mode - lo), 1e-300)
    right = 1 - (hi - x) ** 2 / max((hi - lo) * (hi - mode), 1e-300)
    return np.clip(np.where(x <= mode, left, right), 0, 1)


def cdf_column(family: str, parameters: Sequence[float]) -> Callable[[Column], Column]:
    """The same as a vectorized Column function; it runs once per distinct value."""
    fixed = list(parameters)

    @F.pandas_udf("double")
    def cdf(v: pd.Series) -> pd.Series:
        return pd.Series(cdf_array(family, fixed, v.to_numpy(dtype=float)))

    return cdf


def _newton_gamma(s: float) -> float:
    k = (3 - s + math.sqrt((s - 3) ** 2 + 24 * s)) / (12 * s)
    for _ in range(50):
        step = (math.log(k) - special.digamma(k) - s) / (1 / k - special.trigamma(k))
        k = max(k - step, 1e-6)
        if abs(step) < 1e-12 * k:
            break
    return k


def _newton_beta(m: float, v: float, ml: float, mr: float) -> tuple[float, float]:
    t = max(m * (1 - m) / v - 1, 0.1) if v > 0 else 1.0
    a, b = m * t, (1 - m) * t
    for _ in range(100):
        g = np.array([special.digamma(a) - special.digamma(a + b) - ml, special.digamma(b) - special.digamma(a + b) - mr])
        tri = special.trigamma(a + b)
        h = np.array([[special.trigamma(a) - tri, -tri], [-tri, special.trigamma(b) - tri]])
        da, db = np.linalg.solve(h, g)
        a, b = max(a - da, a / 4), max(b - db, b / 4)
        if abs(da) + abs(db) < 1e-12 * (a + b):
            break
    return a, b


# Points of the sketch from which the iterated families start; their estimates come from all rows.
START_POINTS = 1000
MODES = 20
MAX_ROUNDS = 40
SMALLEST_VARIANCE = 1e-12


@dataclass
class _Student:
    """Location and squared scale of a t family of ``nu`` degrees on the way to its greatest likelihood."""

    nu: float
    mu: float
    s2: float
    loglik: float = -math.inf
    safe: tuple[float, float] | None = None
    before: tuple[float, float] | None = None
    done: bool = False

    def constant(self) -> float:
        return math.lgamma((self.nu + 1) / 2) - math.lgamma(self.nu / 2) - 0.5 * math.log(self.nu * math.pi * self.s2)

    def step(self, n: float, s: Sequence[float]) -> None:
        """A Newton step in (mu, ln s2), or the weighted means where the curvature or the likelihood speaks against it.

        ``s``: sums of ln(1 + u), q, r q, u q, u q^2 and r q^2, with r the gap to mu, u = r^2 / (nu s2), q = 1 / (1 + u).
        """
        tail, q, rq, uq, uqq, rqq = s
        loglik = n * self.constant() - (self.nu + 1) / 2 * tail
        if self.before and self.safe and loglik < self.loglik - 1e-10 * n:
            (self.mu, self.s2), self.before = self.safe, None
            return
        a = (self.nu + 1) / (self.nu * self.s2)
        g = np.array([a * rq, -n / 2 + (self.nu + 1) / 2 * uq])
        h = np.array([[a * (2 * uqq - q), -a * rqq], [-a * rqq, -(self.nu + 1) / 2 * uqq]])
        self.loglik, self.safe = loglik, (self.mu + rq / q, max((self.nu + 1) * self.s2 * uq / n, SMALLEST_VARIANCE))
        if h[0, 0] < 0 and np.linalg.det(h) > 0:
            move = -np.linalg.solve(h, g)
            gain = float(g @ move) / 2
            self.before = (self.mu, self.s2)
            self.mu, self.s2 = self.mu + float(move[0]), max(self.s2 * math.exp(min(max(float(move[1]), -2.0), 2.0)), SMALLEST_VARIANCE)
            self.done = gain <= 1e-10 * n
            self.loglik += gain if self.done else 0.0
        else:
            self.before = None
            self.mu, self.s2 = self.safe
        self.done = self.done or self.s2 <= SMALLEST_VARIANCE


@dataclass
class _Weibull:
    """Shape, scale in units of the largest value, and likelihood, on the way to its maximum."""

    k: float
    scale: float = 1.0
    loglik: float = -math.inf
    done: bool = False

    def step(self, n: float, hi: float, ml: float, s: Sequence[float]) -> None:
        """A Newton step of the profile likelihood, which is concave; ``s``: means of y^k, y^k ln y and y^k ln^2 y, with y = x / hi."""
        a1, a2 = s[1] / s[0], s[2] / s[0]
        spread = max(a2 - a1 * a1, 0.0)
        slope, bend = 1 / self.k - a1 + ml - math.log(hi), 1 / self.k**2 + spread
        move = min(max(slope / bend, -0.75 * self.k), 3 * self.k)
        gain = slope * move - bend * move * move / 2
        self.loglik = n * (math.log(self.k) - math.log(s[0]) - self.k * math.log(hi) + (self.k - 1) * ml - 1 + gain)
        log_mean = math.log(s[0]) + a1 * move + spread * move * move / 2
        self.k += move
        self.scale, self.done = math.exp(log_mean / self.k), abs(gain) <= 1e-12


def _start_student(x: np.ndarray, nu: float) -> _Student:
    low, mu, high = np.quantile(x, [0.25, 0.5, 0.75])
    s2 = max(((high - low) / 2) ** 2, SMALLEST_VARIANCE)
    for _ in range(100):
        w = (nu + 1) / (nu + (x - mu) ** 2 / s2)
        mu = float((w * x).sum() / w.sum())
        s2 = max(float((w * (x - mu) ** 2).mean()), SMALLEST_VARIANCE)
    return _Student(nu, float(mu), s2)


def _start_weibull(x: np.ndarray) -> _Weibull:
    hi, logs = float(x.max()), np.log(x)
    out = _Weibull(math.pi / math.sqrt(6) / max(float(logs.std()), 1e-9))
    for _ in range(100):
        y = np.exp(out.k * (logs - math.log(hi)))
        out.step(len(x), hi, float(logs.mean()), [float((y * (logs - math.log(hi)) ** j).mean()) for j in range(3)])
        if out.done:
            break
    return _Weibull(out.k)


def _base_sums(df: DataFrame, cols: Sequence[str]) -> dict:
    """Sufficient statistics and a sketch of every column, from one scan."""
    x = F.col("value")
    pos, inside = F.when(x > 0, x), F.when((x > 0) & (x < 1), x)
    points = F.percentile_approx(x, [(i + 0.5) / START_POINTS for i in range(START_POINTS)])
    sums = {
        "n": F.count(x), "m": F.avg(x), "v": F.var_pop(x), "lo": F.min(x), "hi": F.max(x), "xx": F.sum(x * x),
        "ml": F.avg(F.ln(pos)), "vl": F.var_pop(F.ln(pos)), "mr": F.avg(F.ln(1 - inside)), "points": points,
    }
    return {r["feature"]: r for r in melt(df, cols).groupBy("feature").agg(*[c.alias(name) for name, c in sums.items()]).collect()}


def _round_sums(df: DataFrame, base: dict, students: dict[str, list[_Student]], weibulls: dict[str, _Weibull], modes: Sequence[str]) -> dict:
    """All sums of a round for all columns, from one scan: a task sums whole batches and hands on a row for each column."""
    cols = sorted({*students, *weibulls, *modes})
    ends = {c: (float(base[c]["lo"]), float(base[c]["hi"])) for c in cols}
    fixed = {c: [(s.nu, s.mu, s.s2) for s in students.get(c, [])] for c in cols}
    shape = {c: weibulls[c].k for c in cols if c in weibulls}

    def sums(c: str, x: np.ndarray) -> list[float]:
        lo, hi = ends[c]
        span, out = hi - lo, []
        for nu, mu, s2 in fixed[c]:
            r = x - mu
            u = r * r / (nu * s2)
            q = 1 / (1 + u)
            out += [float(e.sum()) for e in (np.log1p(u), q, r * q, u * q, u * q * q, r * q * q)]
        if c in shape:
            y = x[x / hi > 0] / hi
            power, logs = np.power(y, shape[c]), np.log(y)
            out += [float(len(y)), *(float(e.sum()) for e in (power, power * logs, power * logs * logs))]
        if c in modes:
            for i in range(1, MODES):
                left = i / MODES
                up = 2 * (x - lo + span * 1e-9) / (span * span * left)
                out.append(float(np.log(np.where(x <= lo + span * left, up, 2 * (hi - x + span * 1e-9) / (span * span * (1 - left)))).sum()))
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: list = [0.0] * len(cols)
        for b in batches:
            with np.errstate(all="ignore"):
                total = [t + np.array(sums(c, b[n].dropna().to_numpy(float))) for t, c, n in zip(total, cols, b.columns, strict=True)]
        yield pd.DataFrame({"i": range(len(cols)), "s": [np.atleast_1d(t) for t in total], "seen": [np.ndim(t) > 0 for t in total]})

    parts = df.select(*[observed(df, c).alias(f"x{i}") for i, c in enumerate(cols)]).mapInPandas(run, "i int, s array<double>, seen boolean").filter("seen").collect()
    out = {}
    for i, c in enumerate(cols):
        s = np.sum([p["s"] for p in parts if p["i"] == i], axis=0).tolist()
        names = [f"t{k}_{j}" for k in range(len(fixed[c])) for j in range(6)] + ["n", "w0", "w1", "w2"] * (c in shape) + [f"m{k}" for k in range(1, MODES)] * (c in modes)
        out[c] = dict(zip(names, s, strict=True))
        out[c] |= {f"w{j}": out[c][f"w{j}"] / out[c]["n"] for j in range(3)} if c in shape else {}
    return out


def _closed_forms(ok: Sequence[str], s) -> list[tuple[str, list[float], float]]:
    """The families whose greatest likelihood follows from the sufficient statistics."""
    n, m, v, lo, hi = s["n"], s["m"], s["v"], s["lo"], s["hi"]
    out: list[tuple[str, list[float], float]] = []
    if "norm" in ok:
        out.append(("norm", [m, math.sqrt(v)], -n / 2 * (math.log(2 * math.pi * v) + 1)))
    if "lognorm" in ok and s["vl"]:
        out.append(("lognorm", [s["ml"], math.sqrt(s["vl"])], -n * s["ml"] - n / 2 * (math.log(2 * math.pi * s["vl"]) + 1)))
    if "gamma" in ok and math.log(m) - s["ml"] > 0:
        k = _newton_gamma(math.log(m) - s["ml"])
        th = m / k
        out.append(("gamma", [k, th], (k - 1) * n * s["ml"] - n * m / th - n * k * math.log(th) - n * math.lgamma(k)))
    if "beta" in ok and lo > 0 and hi < 1:
        a, b = _newton_beta(m, v, s["ml"], s["mr"])
        out.append(("beta", [a, b], n * ((a - 1) * s["ml"] + (b - 1) * s["mr"] - math.lgamma(a) - math.lgamma(b) + math.lgamma(a + b))))
    if "expon" in ok and m > lo:
        out.append(("expon", [lo, m - lo], -n * math.log(m - lo) - n))
    if "pareto" in ok and s["ml"] > math.log(lo):
        al = 1 / (s["ml"] - math.log(lo))
        out.append(("pareto", [lo, al], n * math.log(al) + n * al * math.log(lo) - (al + 1) * n * s["ml"]))
    if "rayleigh" in ok:
        s2 = s["xx"] / (2 * n)
        out.append(("rayleigh", [math.sqrt(s2)], n * s["ml"] - n * math.log(s2) - n))
    return out


def _fit_columns(df: DataFrame, cols: Sequence[str], families: Sequence[str], min_rows: int) -> dict[str, list[tuple[str, list[float], float]]]:
    """(family, parameters, log likelihood) by column.

    One scan gives the sufficient statistics of all columns, and a sketch whose
    points start the t and Weibull families close to their maximum. Each further
    scan is one Newton round over all columns and families at once (two or three
    as a rule); the first of them also has the likelihoods of the triangles.
    """
    base = {c: s for c, s in _base_sums(df, cols).items() if s["n"] >= max(min_rows, 1) and s["v"]}
    ok = {c: [f for f in families if not (f in POSITIVE and s["lo"] <= 0) and not (f in UNIT and (s["lo"] < 0 or s["hi"] > 1))] for c, s in base.items()}
    students, weibulls = {}, {}
    for c, s in base.items():
        points = np.array(s["points"], dtype=float)
        if "cauchy" in ok[c] or "t" in ok[c]:
            students[c] = [_start_student(points, nu) for nu in ([1.0] if "cauchy" in ok[c] else []) + (list(T_DEGREES) if "t" in ok[c] else [])]
        if "weibull_min" in ok[c]:
            weibulls[c] = _start_weibull(points)
    modes, triangles = [c for c in base if "triang" in ok[c]], {}
    for _ in range(MAX_ROUNDS):
        open_students = {c: left for c, all_of in students.items() if (left := [s for s in all_of if not s.done])}
        open_weibulls = {c: w for c, w in weibulls.items() if not w.done}
        if not (open_students or open_weibulls or modes):
            break
        for c, r in _round_sums(df, base, open_students, open_weibulls, modes).items():
            for i, student in enumerate(open_students.get(c, [])):
                student.step(base[c]["n"], [r[f"t{i}_{j}"] for j in range(6)])
            if c in open_weibulls:
                open_weibulls[c].step(base[c]["n"], base[c]["hi"], base[c]["ml"], [r[f"w{j}"] for j in range(3)])
            if c in modes:
                triangles[c] = [r[f"m{i}"] for i in range(1, MODES)]
        modes = []
    out = {}
    for c, s in base.items():
        found = _closed_forms(ok[c], s)
        if c in weibulls:
            found.append(("weibull_min", [weibulls[c].k, s["hi"] * weibulls[c].scale], weibulls[c].loglik))
        t = [s for s in students.get(c, []) if s.nu > 1]
        found += [("cauchy", [s.mu, math.sqrt(s.s2)], s.loglik) for s in students.get(c, []) if s.nu == 1]
        if t:
            best = max(t, key=lambda s: s.loglik)
            found.append(("t", [best.nu, best.mu, math.sqrt(best.s2)], best.loglik))
        if c in triangles:
            i = int(np.argmax(triangles[c]))
            found.append(("triang", [s["lo"], s["lo"] + (s["hi"] - s["lo"]) * (i + 1) / MODES, s["hi"]], triangles[c][i]))
        out[c] = [(f, [float(q) for q in p], float(ll)) for f, p, ll in found if math.isfinite(ll)]
    return out


PARAMETERS = {"norm": 2, "lognorm": 3, "gamma": 3, "beta": 4, "weibull_min": 3, "expon": 2, "pareto": 3, "t": 3, "cauchy": 2, "rayleigh": 2, "triang": 3}


def fit_families(df: DataFrame, cols: Sequence[str], families: Sequence[str] = FAMILIES, min_rows: int = 50) -> DataFrame:
    """``(feature, family, parameters, loglik, aic)`` of every admissible family; AIC = 2k - 2LL."""
    found = _fit_columns(df, cols, families, min_rows)
    rows = [(c, f, p, ll, 2.0 * PARAMETERS[f] - 2 * ll) for c in cols for f, p, ll in found.get(c, [])]
    return df.sparkSession.createDataFrame(rows, "feature string, family string, parameters array<double>, loglik double, aic double")


def best_fit(df: DataFrame, cols: Sequence[str], families: Sequence[str] = FAMILIES, min_rows: int = 50) -> DataFrame:
    """The family with the smallest AIC per column, with its KS distance, p value and Anderson-Darling statistic.

    A column with fewer than ``min_rows`` values, or that no family admits, has a row of NULLs.
    """
    fits = fit_families(df, cols, families, min_rows).collect()
    parts = []
    for c in cols:
        mine = [r for r in fits if r["feature"] == c]
        if not mine:
            parts.append(df.sparkSession.createDataFrame([(c, None, None, None, None, None, None)], "feature string, family string, parameters array<double>, aic double, ks double, ks_p double, anderson double"))
            continue
        r = min(mine, key=lambda t: t["aic"])
        fam, par = r["family"], list(r["parameters"])
        gof = goodness(df, c, cdf_column(fam, par))
        parts.append(gof.select(F.lit(c).alias("feature"), F.lit(fam).alias("family"), F.array(*[F.lit(p) for p in par]).alias("parameters"), F.lit(r["aic"]).alias("aic"), "ks", "ks_p", "anderson"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def goodness(df: DataFrame, c: str, cdf: Callable[[Column], Column]) -> DataFrame:
    """``(n, ks, ks_p, anderson)`` against any distribution function.

    Both statistics need only the counts up to each distinct value: a value at
    positions a+1..b adds (b^2 - a^2) ln F and ((n-a)^2 - (n-b)^2) ln(1 - F).
    """
    data = df.select(observed(df, c).alias("x"))
    cum = ordering.cumulative_counts(data, "x")
    n, b = F.col("__cum__all"), F.col("__cum")
    rows = cum.withColumn("a", b - F.col("__n")).withColumn("f", cdf(F.col("x")))
    a = F.col("a")
    clipped = F.least(F.greatest(F.col("f"), F.lit(1e-9)), F.lit(1 - 1e-9))
    s = (b * b - a * a) * F.ln(clipped) + (F.pow(n - a, 2) - F.pow(n - b, 2)) * F.ln(1 - clipped)
    one = rows.agg(F.max(n).alias("n"), F.max(F.greatest(b / n - F.col("f"), F.col("f") - a / n)).alias("ks"), F.sum(s).alias("s"))
    p = special.on_results(special.ks_one_sample_p)("ks", "n")
    return one.select(F.col("n").cast("long").alias("n"), "ks", p.alias("ks_p"), (-F.col("n") - F.col("s") / F.col("n")).alias("anderson"))


def ecdf(df: DataFrame, c: str, out: str | None = None) -> DataFrame:
    """``<col>_pit``: share of known values at or below the row's value."""
    name = out or f"{c}_pit"
    marked = df.withColumn("__x", observed(df, c))
    cum = ordering.cumulative_counts(marked.select("__x"), "__x").select(F.col("__x").alias("__v"), (F.col("__cum") / F.col("__cum__all")).alias(name))
    return marked.join(cum, F.col("__x") == F.col("__v"), "left").drop("__x", "__v")


def parametric_pit(df: DataFrame, c: str, cdf: Callable[[Column], Column]) -> DataFrame:
    return df.withColumn(f"{c}_pit", cdf(observed(df, c)))


def normal_scores(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``<col>_z``: normal quantile of the average rank over n + 1, complete rows."""
    base = out = as_numbers(df, cols).dropna()
    for c in cols:
        ranks = ordering.average_rank(base.select(F.col(f"`{c}`").alias("__x")), "__x")
        z = special.norm_ppf_col(F.col("__rank") / (F.col("__cum__all") + 1))
        out = out.join(ranks.select(F.col("__x"), z.alias(f"{c}_z")), F.col(f"`{c}`") == F.col("__x")).drop("__x")
    return out


def gaussian_copula(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, float]:
    """``(a, b, corr)`` of the normal scores and the copula log likelihood, from one cross-product matrix."""
    names = [f"{c}_z" for c in cols]
    m, means = cross_products(cut_lineage(normal_scores(df, cols).select(*names)), names)
    n = m[0, 0]
    g = m[1:, 1:] + n * np.outer(means[1:], means[1:])
    d = m[0, 1:] / n
    centred = m[1:, 1:] - n * np.outer(d, d)
    sd = np.sqrt(np.diag(centred))
    r = centred / np.outer(sd, sd)
    sign, logdet = np.linalg.slogdet(r)
    loglik = float(-n / 2 * logdet - 0.5 * np.trace((np.linalg.pinv(r) - np.eye(len(cols))) @ g))
    rows = [(a, b, float(r[i, j])) for i, a in enumerate(cols) for j, b in enumerate(cols) if i < j]
    return df.sparkSession.createDataFrame(rows, "a string, b string, corr double"), loglik


def qq_points(df: DataFrame, c: str, points: int = 1000) -> DataFrame:
    """``(p, theoretical, sample, pp)``: normal against sample quantiles, and the fitted CDF at them."""
    ps = [(i + 0.5) / points for i in range(points)]
    q = ordering.quantiles(df.select(observed(df, c).alias("x")), "x", ps)
    rows = q.select(F.posexplode("q").alias("i", "sample")).withColumn("p", (F.col("i") + 0.5) / points)
    s = df.agg(F.struct(F.avg(observed(df, c)).alias("m"), F.stddev_samp(observed(df, c)).alias("s"))).scalar()
    return rows.select("p", special.norm_ppf_col(F.col("p")).alias("theoretical"), "sample", special.norm_cdf_col((F.col("sample") - s["m"]) / s["s"]).alias("pp"))
