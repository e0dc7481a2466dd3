"""Missing-value mechanism, candidate fills, choice and application.

Fitted state is a plan table ``(feature, kind, strategy, value)``; drawing fills
take a unique numeric row key, so the same row gets the same draw on every retry.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import gram, ordering, special
from ..functions.columns import agg_long, as_numbers, hash_unit, is_missing, numeric_cols, observed
from ..session import cut_lineage
from . import neighbors
from .profile import feature_quantiles, missingness
from .drift import ks_two_sample

# Fill marks and cutoffs.
MISSING, RARE = "__MISSING__", "__RARE__"
ALPHA = 0.05
MAX_NULL_SHARE = 0.90
RARE_SHARE = 0.01
MIN_VARIANCE_RATIO, MAX_COVARIANCE_CHANGE = 0.5, 0.2


def null_patterns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct not-null flag rows ``n0, n1, ...`` with their weight."""
    flags = df.select(*[(~is_missing(df, c)).cast("double").alias(f"n{i}") for i, c in enumerate(cols)])
    return flags.groupBy(*flags.columns).agg(F.count(F.lit(1)).cast("double").alias("weight"))


def mechanism(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(feature, fraction_missing, p_value, mechanism)``.

    A logit of "is missing" on the not-null flags of the other columns, fitted on
    the weighted pattern table; MCAR when the largest Wald p value is above 0.05.
    """
    names = list(cols or df.columns)
    patterns = cut_lineage(null_patterns(df, names))
    n = patterns.agg(F.sum("weight")).first()[0] or 0.0
    gone = patterns.agg(*[F.sum((1 - F.col(f"n{i}")) * F.col("weight")) for i in range(len(names))]).first()
    rows = []
    together = gram.weighted_products(patterns.select(F.array(*[f"n{i}" for i in range(len(names))], "weight").alias("x")), len(names))
    for i, c in enumerate(names):
        share = (gone[i] or 0.0) / n if n else 0.0
        others = [j for j in range(len(names)) if j != i]
        if share == 0.0:
            rows.append((c, 0.0, None, "no_nas"))
            continue
        if not others or share == 1.0:
            rows.append((c, float(share), None, "undetermined"))
            continue
        design = patterns.select((1 - F.col(f"n{i}")).alias("label"), array_to_vector(F.array(*[F.col(f"n{j}") for j in others])).alias("features"), "weight")
        model = LogisticRegression(weightCol="weight", regParam=1.0 / n, standardization=False, maxIter=100).fit(design)
        inv = np.linalg.inv(together[np.ix_(others, others)] + 1e-6 * np.eye(len(others)))
        ps = []
        for coef, var in zip(model.coefficients.toArray(), np.diag(inv)):
            ps.append(1.0 if var <= 0 else 2 * (1 - special.norm_cdf(abs(coef / math.sqrt(var)))))
        p = float(max(ps))
        rows.append((c, float(share), p, "MCAR" if p > ALPHA else "MAR/MNAR"))
    return df.sparkSession.createDataFrame(rows, "feature string, fraction_missing double, p_value double, mechanism string")


def little_test(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(statistic, dof, p_value, mechanism)`` over numeric columns with nulls.

    Per null pattern the mean of its known columns is compared with the
    available-case mean under the available-case covariance.
    """
    spark = df.sparkSession
    rates = {r["feature"]: r["null_rate"] for r in missingness(df, list(cols or numeric_cols(df))).collect()}
    names = [c for c, r in rates.items() if r > 0]
    schema = "statistic double, dof double, p_value double, mechanism string"
    if len(names) < 2:
        return spark.createDataFrame([(None, None, None, "too_few_nas")], schema)
    data = as_numbers(df, names)
    both = gram.Pairwise(df, names)
    mu, cov = both.shift, np.nan_to_num(both.covariance())
    pattern = F.concat(*[F.when(F.col(f"`{c}`").isNotNull(), "1").otherwise("0") for c in names])
    groups = data.groupBy(pattern.alias("pattern")).agg(F.count(F.lit(1)).alias("n"), F.array(*[F.avg(f"`{c}`") for c in names]).alias("m"))

    def distance(batches):
        for pdf in batches:
            out = []
            for pat, n, m in zip(pdf["pattern"], pdf["n"], pdf["m"]):
                seen = np.array([ch == "1" for ch in pat])
                if not seen.any():
                    out.append((0.0, 0.0))
                    continue
                d = np.array(m, dtype=float)[seen] - mu[seen]
                out.append((float(n * d @ np.linalg.pinv(cov[np.ix_(seen, seen)]) @ d), float(seen.sum())))
            yield pd.DataFrame(out, columns=["d2", "k"])

    total = groups.mapInPandas(distance, "d2 double, k double").agg(F.sum("d2").alias("statistic"), (F.sum("k") - len(names)).alias("dof"))
    out = total.withColumn("p_value", special.on_results(special.chi2_sf)("statistic", "dof"))
    return out.withColumn("mechanism", F.when(F.col("p_value") > ALPHA, "MCAR").otherwise("MAR/MNAR"))


def high_null_columns(df: DataFrame, max_share: float = MAX_NULL_SHARE) -> list[str]:
    return sorted(r["feature"] for r in missingness(df).filter(F.col("null_rate") > max_share).collect())


def drop_high_null(df: DataFrame, max_share: float = MAX_NULL_SHARE) -> DataFrame:
    return df.drop(*high_null_columns(df, max_share))


def fill_values(df: DataFrame, values: dict[str, float | str]) -> DataFrame:
    """Constants for missing cells; NaN counts as missing."""
    return df.withColumns({c: F.when(is_missing(df, c), F.lit(v)).otherwise(F.col(f"`{c}`")) for c, v in values.items()})


def column_means(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    return {r["feature"]: r["m"] for r in agg_long(df, cols, {"m": F.avg}).collect() if r["m"] is not None}


def column_medians(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    return {r["feature"]: r["q"][0] for r in feature_quantiles(df, cols, [0.5]).collect()}


def mean_fill(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return fill_values(df, column_means(df, cols))


def median_fill(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return fill_values(df, column_medians(df, cols))


def level_counts(df: DataFrame, c: str) -> DataFrame:
    return df.filter(~is_missing(df, c)).groupBy(F.col(f"`{c}`").alias("level")).agg(F.count(F.lit(1)).alias("n"))


def mode_value(df: DataFrame, c: str):
    """Most frequent value, the smallest among ties; None for an empty column."""
    top = level_counts(df, c).orderBy(F.desc("n"), "level").limit(1).collect()
    return top[0]["level"] if top else None


def mode_fill(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    found = {c: mode_value(df, c) for c in cols}
    return fill_values(df, {c: MISSING if v is None else v for c, v in found.items()})


def constant_fill(df: DataFrame, cols: Sequence[str], value: float | str = MISSING) -> DataFrame:
    return fill_values(df, {c: value for c in cols})


def random_fill(df: DataFrame, c: str, key: str, seed: int = 42, donors: DataFrame | None = None, empty: float | str = 0.0) -> DataFrame:
    """Each missing cell draws one observed value with replacement.

    Observed rows are numbered in key order; a missing row draws a number from
    its own key, and one equi-join (unique on the donor side) fetches the value.
    """
    base = donors if donors is not None else df
    known = base.filter(~is_missing(base, c)).select(F.col(key).alias("__k"), F.col(f"`{c}`").alias("__donor"))
    numbered = ordering.row_index(known, "__k", None).select("__rn", "__donor")
    n = known.agg(F.count(F.lit(1))).scalar()
    gone = is_missing(df, c)
    wanting = df.filter(gone).withColumn("__want", F.floor(hash_unit(key, seed=seed) * n).cast("long") + 1)
    value = F.coalesce("__donor", F.lit(empty).cast(df.schema[c].dataType))
    drawn = wanting.join(numbered, F.col("__want") == F.col("__rn"), "left").withColumn(c, value)
    return df.filter(~gone).unionByName(drawn.select(*df.columns))


def knn_fill(df: DataFrame, cols: Sequence[str], key: str, k: int = 5, donors: DataFrame | None = None) -> DataFrame:
    """Mean of the ``k`` nearest donors by Euclidean distance over the columns that the row knows.

    One definition at any size: for each pattern of missing columns the donors of a column are the rows that know it and all columns the
    pattern knows, so the distance is a metric and the neighbour search can prune. Equal donor vectors are one point with the mean of their
    values; ties go to the smaller key. A row that knows nothing, or finds no donor, takes the column mean. Integer ``key``.
    """
    names = list(cols)
    base = donors if donors is not None else df
    means = column_means(base, names)
    flags = [is_missing(df, c) for c in names]
    patterns = [tuple(r) for r in df.select(*[f.alias(f"m{i}") for i, f in enumerate(flags)]).distinct().collect()]
    numbers = df.withColumns({c: observed(df, c) for c in names})
    out = None
    for pattern in patterns:
        here = F.lit(True)
        for f, gone in zip(flags, pattern):
            here = here & (f if gone else ~f)
        part = numbers.filter(here)
        seen = [c for c, gone in zip(names, pattern) if not gone]
        for c in (c for c, gone in zip(names, pattern) if gone):
            if seen:
                asked = neighbors.points(part, seen, key)
                known = as_numbers(base, [*seen, c], [F.col(key).alias("__key")]).dropna()
                vec = F.array(*[F.col(f"`{o}`") + 0.0 for o in seen]).alias("vec")
                given = cut_lineage(known.groupBy(vec).agg(F.min("__key").alias("pid"), F.count(F.lit(1)).alias("copies"), F.avg(f"`{c}`").alias("__value")))
                near = neighbors.knn(asked, given.select("vec", "pid", "copies"), k)
                found = near.join(given.select(F.col("pid").alias("did"), "__value"), "did").groupBy("qid").agg((F.sum(F.col("weight") * F.col("__value")) / F.sum("weight")).alias("__new"))
                found = asked.join(found, asked["pid"] == found["qid"]).select(F.col("vec").alias("__vec"), "__new")
                mine = F.array(*[F.col(f"`{o}`") + 0.0 for o in seen])
                part = part.withColumn("__at", mine).join(found, F.col("__at") == F.col("__vec"), "left").withColumn(c, F.coalesce("__new", F.lit(means.get(c)))).drop("__at", "__vec", "__new")
            else:
                part = part.withColumn(c, F.lit(means.get(c)).cast("double"))
        out = part if out is None else out.unionByName(part)
    return (out if out is not None else numbers).select(*df.columns)


def mice_fill(df: DataFrame, cols: Sequence[str], key: str, rounds: int = 10, seed: int = 42, ridge: float = 1e-6) -> DataFrame:
    """Chained equations: each column in turn is redrawn from a ridge regression on the others.

    One step is one sum of products (normal equations over the rows where the column
    was observed) and one projection; lineage is cut after every round. Noise
    comes from the row key, so retries repeat the same draw.
    """
    names = list(cols)
    rates = {r["feature"]: r["null_rate"] for r in missingness(df, names).collect()}
    todo = [c for c in names if 0 < rates[c] < 1]
    if not todo or len(names) < 2:
        return mean_fill(df, todo)
    means = column_means(df, names)
    flagged = df.withColumns({f"__gone_{i}": is_missing(df, c) for i, c in enumerate(todo)})
    work = flagged.withColumns({c: F.coalesce(observed(df, c), F.lit(means.get(c, 0.0))) for c in names})
    for step in range(rounds):
        for i, c in enumerate(todo):
            others = [o for o in names if o != c]
            xs = [F.lit(1.0)] + [F.col(f"`{o}`") - F.lit(means.get(o, 0.0)) for o in others]
            at = np.array([means.get(o, 0.0) for o in others] + [means[c]])
            whole, _ = gram.complete_products(work.filter(~F.col(f"__gone_{i}")), [*others, c], at)
            g, xy, yy = whole[:-1, :-1], whole[:-1, -1], whole[-1, -1]
            scale = np.where(np.diag(g) > 0, np.diag(g), 1.0)
            inv = np.linalg.inv(g + np.diag(ridge * scale))
            beta = inv @ xy
            sigma2 = max(float(yy - beta @ xy) / max(g[0, 0] - len(xs), 1.0), 0.0)
            rng = np.random.default_rng([seed, step, i])
            beta = rng.multivariate_normal(beta, sigma2 * inv, method="svd")
            u1, u2 = hash_unit(key, seed=seed + 1000 * step + 2 * i), hash_unit(key, seed=seed + 1000 * step + 2 * i + 1)
            noise = F.sqrt(-2 * F.ln(1 - u1)) * F.cos(2 * math.pi * u2) * math.sqrt(sigma2)
            guess = F.lit(means[c]) + noise
            for b, x in zip(beta, xs):
                guess = guess + float(b) * x
            work = work.withColumn(c, F.when(F.col(f"__gone_{i}"), guess).otherwise(F.col(f"`{c}`")))
        work = cut_lineage(work)
    return work.select(*df.columns)


def candidate_scores(df: DataFrame, c: str, candidates: dict[str, DataFrame], cols: Sequence[str]) -> DataFrame:
    """``(method, ks_p, variance_ratio, covariance_change)`` of filled versions of one column.

    Each candidate frame is ``df`` with column ``c`` filled. The covariance change
    is the relative L1 change of the column's covariance row over complete rows.
    """
    names = list(cols)
    parts = []

    def row_stats(frame: DataFrame, tag: str) -> DataFrame:
        data = as_numbers(frame, names)
        full = F.lit(True)
        for o in names:
            full = full & F.col(f"`{o}`").isNotNull()
        only = lambda o: F.when(full, F.col(f"`{o}`"))
        return data.agg(
            F.var_pop(f"`{c}`").alias("v"), F.count_if(full).alias("complete"), F.array(*[F.covar_pop(only(c), only(o)) for o in names]).alias("cov")
        ).select(F.lit(tag).alias("method"), "*")

    before = row_stats(df, "before").select(F.col("v").alias("v0"), F.col("complete").alias("n0"), F.col("cov").alias("cov0"))
    for method, frame in candidates.items():
        parts.append(row_stats(frame, method))
        orig = df.select(F.lit(method).alias("method"), F.lit(0).alias("side"), observed(df, c).alias("value"))
        new = frame.select(F.lit(method).alias("method"), F.lit(1).alias("side"), observed(frame, c).alias("value"))
        parts.append(orig.unionByName(new))
    stats, values = parts[0], parts[1]
    for i in range(2, len(parts), 2):
        stats, values = stats.unionByName(parts[i]), values.unionByName(parts[i + 1])
    ks = ks_two_sample(values, "value", "side", ["method"]).select("method", F.col("p_value").alias("ks_p"))
    change = F.aggregate(
        F.zip_with("cov", "cov0", lambda a, b: F.abs(a - b) / (F.abs(b) + 1e-9)), F.lit(0.0), lambda s, x: s + x
    )
    enough = (F.col("n0") >= max(5, len(names))) & (F.col("complete") >= 5)
    one = F.lit(1)
    joined = stats.withColumn("__k", one).join(F.broadcast(before.withColumn("__k", one)), "__k").join(ks, "method", "left")
    return joined.select(
        "method",
        F.coalesce("ks_p", F.lit(0.0)).alias("ks_p"),
        F.when(F.col("v0") > 0, F.col("v") / F.col("v0")).alias("variance_ratio"),
        F.when(enough, change).alias("covariance_change"),
    )


def choose_candidate(scores: DataFrame, min_ratio: float = MIN_VARIANCE_RATIO, max_change: float = MAX_COVARIANCE_CHANGE) -> DataFrame:
    """One row: the method passing both limits with the largest (ks_p, ratio, -change); else ``fallback_mean``."""
    ratio, change = F.col("variance_ratio"), F.col("covariance_change")
    ok = F.coalesce(ratio >= min_ratio, F.lit(True)) & F.coalesce(change <= max_change, F.lit(True))
    best = scores.filter(ok).agg(F.max_by("method", F.struct("ks_p", "variance_ratio", (-change).alias("c"))).alias("method"))
    return best.select(F.coalesce("method", F.lit("fallback_mean")).alias("method"))


def common_levels(df: DataFrame, c: str, cutoff: float = RARE_SHARE) -> list[str]:
    """Levels at or above ``cutoff``: at most 1 / cutoff of them."""
    counts = level_counts(df, c)
    total = counts.agg(F.sum("n")).scalar()
    return sorted(r["level"] for r in counts.filter(F.col("n") / total >= cutoff).collect())


def collapse_rare(df: DataFrame, cols: Sequence[str], cutoff: float = RARE_SHARE) -> DataFrame:
    out = {}
    for c in cols:
        keep = common_levels(df, c, cutoff)
        here = F.col(f"`{c}`")
        out[c] = F.when(here.isNull() | (here.isin(*keep) if keep else F.lit(False)), here).otherwise(RARE)
    return df.withColumns(out)


def categorical_scores(df: DataFrame, c: str, key: str, seed: int = 42) -> DataFrame:
    """``(strategy, score)``: 1 minus the summed share change over the original levels."""
    before = level_counts(df, c).withColumnRenamed("n", "n0")
    drawn = level_counts(random_fill(df, c, key, seed, empty=MISSING), c).withColumnRenamed("n", "n2")
    mode = mode_value(df, c)
    both = before.join(drawn, "level", "left").withColumn("n2", F.coalesce("n2", F.lit(0)))
    size = df.agg(F.count(F.lit(1))).scalar()
    n0 = before.agg(F.sum("n0")).scalar()
    gone = size - n0
    p = F.col("n0") / n0
    hit = F.when(F.col("level") == F.lit(mode), gone).otherwise(0) if mode is not None else F.lit(0)
    gaps = both.agg(
        F.sum(F.abs(p - (F.col("n0") + hit) / size)).alias("mode"),
        F.sum(F.abs(p - F.col("n0") / size)).alias("constant"),
        F.sum(F.abs(p - F.col("n2") / size)).alias("random"),
    )
    names = ["mode", "constant", "random"]
    return gaps.select(F.inline(F.array(*[F.struct(F.lit(i).alias("rank"), F.lit(s).alias("strategy"), (1 - F.coalesce(s, F.lit(0.0))).alias("score")) for i, s in enumerate(names)])))


def choose_categorical(scores: DataFrame) -> DataFrame:
    """Best score; ties go to mode, then constant, then random."""
    return scores.agg(F.max_by("strategy", F.struct("score", (-F.col("rank")).alias("r"))).alias("strategy"))


def fit_plan(
    df: DataFrame,
    key: str,
    cols: Sequence[str] | None = None,
    max_null_share: float = MAX_NULL_SHARE,
    rare_share: float = RARE_SHARE,
    numeric_methods: Sequence[str] = ("mean", "median", "random"),
    seed: int = 42,
) -> DataFrame:
    """Plan table ``(feature, kind, strategy, number, text)`` for every column except the key.

    Columns above the null limit are dropped; numeric columns get the best scored
    candidate of ``numeric_methods`` (``knn`` and ``mice`` too, when named); text
    columns have rare levels collapsed, then the best strategy.
    """
    names = [c for c in (cols or df.columns) if c != key]
    rates = {r["feature"]: r["null_rate"] for r in missingness(df, names).collect()}
    rows: list[tuple] = [(c, "any", "drop", None, None) for c in names if rates[c] > max_null_share]
    live = [c for c in names if rates[c] <= max_null_share]
    nums = [c for c in live if c in numeric_cols(df)]
    frame = df.select(key, *live)
    gaps = [c for c in nums if rates[c] > 0]
    means, medians = (column_means(frame, gaps), column_medians(frame, gaps)) if gaps else ({}, {})
    models = {}
    if gaps and "knn" in numeric_methods:
        models["knn"] = cut_lineage(knn_fill(frame, nums, key))
    if gaps and "mice" in numeric_methods:
        models["mice"] = mice_fill(frame, nums, key, seed=seed)
    for c in gaps:
        made = {}
        if "mean" in numeric_methods:
            made["mean"] = fill_values(frame, {c: means[c]})
        if "median" in numeric_methods:
            made["median"] = fill_values(frame, {c: medians[c]})
        if "random" in numeric_methods:
            made["random"] = random_fill(frame, c, key, seed)
        made |= {m: f for m, f in models.items()}
        method = choose_candidate(candidate_scores(frame, c, made, nums)).first()[0]
        rows.append((c, "numeric", method, medians[c] if method == "median" else means[c], None))
    rows += [(c, "numeric", "none", None, None) for c in nums if rates[c] == 0]
    for c in [c for c in live if isinstance(df.schema[c].dataType, T.StringType)]:
        slim = collapse_rare(frame.select(key, c), [c], rare_share)
        keep = "\x1f".join(common_levels(frame, c, rare_share))
        rows.append((c, "levels", "collapse", None, keep))
        if rates[c] == 0:
            rows.append((c, "text", "none", None, None))
            continue
        strategy = choose_categorical(categorical_scores(slim, c, key, seed)).first()[0]
        value = mode_value(slim, c) if strategy == "mode" else MISSING
        rows.append((c, "text", strategy, None, value or MISSING))
    return df.sparkSession.createDataFrame(rows, "feature string, kind string, strategy string, number double, text string")


def apply_plan(df: DataFrame, plan: DataFrame, key: str, donors: DataFrame | None = None, seed: int = 42) -> DataFrame:
    """The stored drops and fills on any frame; drawing and model strategies need the training rows as ``donors``."""
    steps = [r for r in plan.collect()]
    out = df.drop(*[r["feature"] for r in steps if r["strategy"] == "drop"])
    have = set(out.columns)
    for r in steps:
        if r["strategy"] == "collapse" and r["feature"] in have:
            keep = r["text"].split("\x1f") if r["text"] else []
            here = F.col(f"`{r['feature']}`")
            fix = F.when(here.isNull() | (here.isin(*keep) if keep else F.lit(False)), here).otherwise(RARE)
            out = out.withColumn(r["feature"], fix)
            if donors is not None:
                donors = donors.withColumn(r["feature"], fix)
    fixed = {r["feature"]: r["number"] if r["kind"] == "numeric" else r["text"] for r in steps if r["strategy"] in ("mean", "median", "fallback_mean", "mode", "constant")}
    out = fill_values(out, {c: v for c, v in fixed.items() if c in have})
    nums = [r["feature"] for r in steps if r["kind"] == "numeric" and r["feature"] in have]
    for method in ("knn", "mice"):
        mine = [r["feature"] for r in steps if r["strategy"] == method and r["feature"] in have]
        if mine and method == "knn":
            filled = knn_fill(df.select(key, *nums), nums, key, donors=donors)
        elif mine:  # the chain is run over the donors and the new rows together; only the new rows are taken
            both = df.select(key, *nums).withColumn("__new", F.lit(1))
            if donors is not None:
                both = both.unionByName(donors.join(df.select(key), key, "left_anti").select(key, *nums).withColumn("__new", F.lit(0)))
            filled = mice_fill(both, nums, key, seed=seed).filter("__new = 1")
        if mine:
            got = filled.select(F.col(key).alias("__key"), *[F.col(f"`{c}`").alias(f"__f_{c}") for c in mine])
            out = out.join(got, F.col(key) == F.col("__key")).withColumns({c: F.col(f"__f_{c}") for c in mine}).drop("__key", *[f"__f_{c}" for c in mine])
    for r in steps:
        if r["strategy"] == "random" and r["feature"] in have:
            out = random_fill(out, r["feature"], key, seed, donors, 0.0 if r["kind"] == "numeric" else MISSING)
    return out


def missing_flags(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({f"{c}_missing_flag": is_missing(df, c).cast("int") for c in cols})


def simple_fill(df: DataFrame, word: str = "missing") -> DataFrame:
    """Median for numbers, one word for text."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    gaps = [r["feature"] for r in missingness(df, numeric_cols(df)).filter(F.col("null_rate") > 0).collect()] if numeric_cols(df) else []
    out = median_fill(df, gaps) if gaps else df
    return constant_fill(out, texts, word)
