"""Health report and univariate profile."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import gram, ordering
from ..functions.columns import agg_long, as_numbers, is_missing, melt, melt_text, null_safe_join, numeric_cols, text_cols

# Up to this many column pairs go as expressions of one aggregate; more would outgrow generated code.
MAX_PAIRS = 200


def _ranked(df: DataFrame, order: Sequence, top: int | None) -> DataFrame:
    """All rows, or the first ``top`` in ``order`` when the caller asks for a top list."""
    return df if top is None else df.orderBy(*order).limit(top)


def regime(df: DataFrame) -> DataFrame:
    """Rows, columns, their ratio as text and which of the two is larger."""
    p = len(df.columns)
    n = F.col("n_rows")
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows",
        F.lit(p).alias("n_cols"),
        F.format_string("%d/%d=%.2f", F.lit(p), n, F.lit(p) / n).alias("ratio"),
        F.when(n < p, "p>>n").when(n > p, "n>>p").otherwise("p=n").alias("regime"),
    )


def missingness(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(feature, null_rate)`` of every column in one pass."""
    names = list(cols or df.columns)
    one = df.agg(*[F.avg(is_missing(df, c).cast("double")).alias(f"r{i}") for i, c in enumerate(names)])
    return one.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"r{i}").alias("null_rate")) for i, c in enumerate(names)]))
    )


def missingness_report(df: DataFrame, top: int | None = None) -> DataFrame:
    """Columns with their null rates (the ``top`` by rate, if given) and, beside them, the mean over all columns."""
    rates = missingness(df)
    overall = rates.agg(F.avg("null_rate").alias("overall_rate"))
    return _ranked(rates, [F.desc("null_rate"), "feature"], top).withColumn("overall_rate", overall.scalar())


def type_counts(df: DataFrame) -> DataFrame:
    kinds = [f.dataType.simpleString() for f in df.schema]
    rows = sorted((k, kinds.count(k)) for k in set(kinds))
    return df.sparkSession.createDataFrame(rows, "dtype string, n_cols int")


def corrected_skew(c: Column) -> Column:
    n = F.count(c).cast("double")
    return F.when(n >= 3, F.try_divide(F.skewness(c) * F.sqrt(n * (n - 1)), n - 2))


def corrected_kurtosis(c: Column) -> Column:
    n = F.count(c).cast("double")
    return F.when(n >= 4, F.try_divide((n - 1) * ((n + 1) * F.kurtosis(c) + 6), (n - 2) * (n - 3)))


def skew_report(df: DataFrame, top: int | None = None) -> DataFrame:
    out = agg_long(df, numeric_cols(df), {"skew": corrected_skew})
    return _ranked(out, [F.desc("skew"), "feature"], top)


def cardinality(df: DataFrame, top: int | None = None, cols: Sequence[str] | None = None) -> DataFrame:
    """Exact distinct values of text columns, nulls aside."""
    cells = melt_text(df, list(cols or text_cols(df))).filter(F.col("value").isNotNull())
    levels = cells.groupBy("feature", "value").agg(F.lit(1).alias("one"))
    out = levels.groupBy("feature").agg(F.count(F.lit(1)).alias("n_distinct"))
    return _ranked(out, [F.desc("n_distinct"), "feature"], top)


def feature_quantiles(df: DataFrame, cols: Sequence[str], qs: Sequence[float]) -> DataFrame:
    """``(feature, q)`` exact quantiles of many columns together."""
    return ordering.quantiles(melt(df, cols), "value", qs, ["feature"], ["feature"])


def fences(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> dict[str, tuple[float, float]]:
    """Quartile fences per column: a few numbers, fitted once and used as constants."""
    out = {}
    for r in feature_quantiles(df, cols, [0.25, 0.75]).collect():
        q1, q3 = r["q"]
        out[r["feature"]] = (q1 - k * (q3 - q1), q3 + k * (q3 - q1))
    return out


def iqr_outlier_counts(df: DataFrame, top: int | None = None, cols: Sequence[str] | None = None, k: float = 1.5) -> DataFrame:
    """``(feature, n_outliers)`` of every numeric column."""
    names = list(cols or numeric_cols(df))
    cut = fences(df, names, k)
    data = as_numbers(df, names)
    flags = {c: (F.col(f"`{c}`") < cut[c][0]) | (F.col(f"`{c}`") > cut[c][1]) for c in names if c in cut}
    one = data.agg(*[F.count_if(f).alias(f"o{i}") for i, f in enumerate(flags.values())])
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"o{i}").alias("n_outliers")) for i, c in enumerate(flags)]
    return _ranked(one.select(F.inline(F.array(*rows))), [F.desc("n_outliers"), "feature"], top)


def pearson_pairs(df: DataFrame, cols: Sequence[str], threshold: float = 0.0) -> DataFrame:
    """``(a, b, corr)`` over pairwise complete rows: few pairs in one aggregate, many from blocked products in two passes over the rows."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    if len(pairs) > MAX_PAIRS:
        corr = gram.Pairwise(df, cols).correlation()
        at = np.argwhere(np.triu(~np.isnan(corr) & (np.abs(corr) > threshold if threshold > 0 else True), 1))
        names = np.array(list(cols), dtype=object)
        found = pd.DataFrame({"a": names[at[:, 0]], "b": names[at[:, 1]], "corr": corr[at[:, 0], at[:, 1]]})
        return df.sparkSession.createDataFrame(found, "a string, b string, corr double")
    data = as_numbers(df, cols)
    both = lambda x, y: (F.when(F.col(f"`{y}`").isNotNull(), F.col(f"`{x}`")), F.when(F.col(f"`{x}`").isNotNull(), F.col(f"`{y}`")))
    one = data.agg(*[F.corr(*both(a, b)).alias(f"c{i}") for i, (a, b) in enumerate(pairs)], F.lit(0))
    rows = [F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"c{i}").alias("corr")) for i, (a, b) in enumerate(pairs)]
    if not rows:
        return df.sparkSession.createDataFrame([], "a string, b string, corr double")
    out = one.select(F.inline(F.array(*rows))).filter(F.col("corr").isNotNull() & ~F.isnan("corr"))
    return out.filter(F.abs("corr") > threshold) if threshold > 0 else out


def collinear_pairs(df: DataFrame, threshold: float = 0.9, cols: Sequence[str] | None = None, top: int | None = None) -> DataFrame:
    """``(a, b, corr)`` of every pair of numeric columns beyond ``threshold``."""
    pairs = pearson_pairs(df, list(cols or numeric_cols(df)), threshold)
    return _ranked(pairs.select("a", "b", F.abs("corr").alias("corr")), [F.desc("corr"), "a", "b"], top)


def cross_products(df: DataFrame, cols: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """X'X of ``[1, cols]`` over complete rows, a (k+1) square matrix, and the shifts.

    Shifted by the column means first, so that large offsets do not cost digits;
    the matrix is returned for the shifted columns. A few columns take one aggregate,
    many go by blocked products.
    """
    k = len(cols) + 1
    cells = [(i, j) for i in range(k) for j in range(i, k)]
    if len(cells) > MAX_PAIRS:
        return gram.complete_products(df, cols)
    data = as_numbers(df, cols).dropna()
    shift = data.agg(*[F.avg(f"`{c}`") for c in cols]).first()
    xs = [F.lit(1.0)] + [F.col(f"`{c}`") - F.lit(m if m is not None else 0.0) for c, m in zip(cols, shift)]
    m = np.zeros((k, k))
    row = data.agg(*[F.sum(xs[i] * xs[j]).alias(f"s{i}_{j}") for i, j in cells]).first()
    for (i, j), v in zip(cells, row):
        m[i, j] = m[j, i] = v or 0.0
    return m, np.array([0.0] + [s or 0.0 for s in shift])


def raw_moments(df: DataFrame, cols: Sequence[str]) -> tuple[np.ndarray, np.ndarray, float]:
    """Column means, centred cross-product matrix and complete-row count."""
    m, means = cross_products(df, cols)
    n = m[0, 0]
    d = m[0, 1:] / n if n else m[0, 1:]
    return means[1:] + d, m[1:, 1:] - n * np.outer(d, d), n


def vif(df: DataFrame, cols: Sequence[str] | None = None, intercept: bool = False, top: int | None = None) -> DataFrame:
    """Variance inflation: the regressions behind it all come from one k x k matrix.

    Without an intercept R2 is uncentred, as in a regression through the origin.
    """
    names = list(cols or numeric_cols(df))
    mean, centred, n = raw_moments(df, names)
    gram = centred if intercept else centred + n * np.outer(mean, mean)
    d = np.sqrt(np.diag(gram))
    d[d == 0] = 1.0
    inv = np.linalg.pinv(gram / np.outer(d, d), rcond=1e-14)
    rows = sorted(((c, float(inv[i, i])) for i, c in enumerate(names)), key=lambda r: (-r[1], r[0]))[:top]
    return df.sparkSession.createDataFrame(rows, "feature string, vif double")


def shares(df: DataFrame, name: str) -> DataFrame:
    """``(value, n, share)`` of the known values of one column."""
    counts = df.filter(F.col(name).isNotNull()).groupBy(F.col(name).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / counts.agg(F.sum("n")).scalar())


def date_check(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(feature, parsed_rate, first, last)`` of date columns, in one pass."""
    aggs, rows = [], []
    for i, c in enumerate(cols):
        ts = F.col(f"`{c}`").try_cast("timestamp")
        aggs += [F.avg(ts.isNotNull().cast("double")).alias(f"p{i}"), F.min(ts).alias(f"a{i}"), F.max(ts).alias(f"z{i}")]
        rows.append(
            F.struct(F.lit(c).alias("feature"), F.col(f"p{i}").alias("parsed_rate"), F.col(f"a{i}").alias("first"), F.col(f"z{i}").alias("last"))
        )
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def describe_numeric(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std, min, quartiles, max and missing per numeric column."""
    names = list(cols or numeric_cols(df))
    basic = agg_long(
        df,
        names,
        {
            "count": F.count,
            "mean": F.avg,
            "std": F.stddev_samp,
            "min": F.min,
            "max": F.max,
            "missing": lambda c: F.count_if(c.isNull()),
        },
    )
    q = feature_quantiles(df, names, [0.25, 0.5, 0.75]).select(
        "feature", F.get("q", F.lit(0)).alias("p25"), F.get("q", F.lit(1)).alias("p50"), F.get("q", F.lit(2)).alias("p75")
    )
    return basic.join(F.broadcast(q), "feature", "left")


def describe_text(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """count, unique, top (first in order among ties), freq and missing per other column."""
    names = list(cols or text_cols(df))
    levels = melt_text(df, names).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("value").isNotNull()
    best = levels.filter(known).groupBy("feature").agg(F.max("n").alias("freq"))
    top = levels.join(F.broadcast(best), "feature").filter(known & (F.col("n") == F.col("freq")))
    top = top.groupBy("feature").agg(F.min("value").alias("top"), F.first("freq").alias("freq"))
    per = levels.groupBy("feature").agg(
        F.sum(F.when(known, F.col("n")).otherwise(0)).alias("count"),
        F.count_if(known).alias("unique"),
        F.sum(F.when(known, 0).otherwise(F.col("n"))).alias("missing"),
    )
    return per.join(F.broadcast(top), "feature", "left")


def basic_profile(df: DataFrame) -> DataFrame:
    """``(feature, dtype, n_rows, n_cols, n_missing, n_unique)``: one grouped pass over all columns."""
    levels = melt_text(df, df.columns).select("feature", F.when(F.length("value") > 64, F.sha2("value", 256)).otherwise(F.col("value")).alias("value"))
    levels = levels.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    per = levels.groupBy("feature").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("n_missing"),
        F.count("value").alias("n_unique"),
    )
    kinds = F.create_map(*[F.lit(x) for f in df.schema for x in (f.name, f.dataType.simpleString())])
    return per.select("feature", kinds[F.col("feature")].alias("dtype"), "n_rows", F.lit(len(df.columns)).alias("n_cols"), "n_missing", "n_unique")


def size_estimate(df: DataFrame) -> int:
    """Bytes the optimizer expects; stands where a local frame would report its memory."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())


def value_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    cells = melt_text(df, list(cols or text_cols(df))).filter(F.col("value").isNotNull())
    return cells.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))


def shape_moments(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Population skewness and excess kurtosis; 0 for a constant column."""
    flat = lambda c, f: F.when(F.min(c) == F.max(c), 0.0).otherwise(f(c))
    return agg_long(
        df, list(cols or numeric_cols(df)), {"skewness": lambda c: flat(c, F.skewness), "kurtosis": lambda c: flat(c, F.kurtosis)}
    )


def column_tags(moments: DataFrame, entropy: DataFrame, drift: DataFrame, fits: DataFrame | None = None) -> DataFrame:
    """``(feature, tags)`` from per-column results; each input has one row per feature.

    ``drift`` has columns ``psi`` and ``jsd``, ``entropy`` has ``entropy``, and
    ``fits`` lists the numeric features with a fitted family.
    """
    all_rows = moments.join(entropy, "feature", "full").join(drift.select("feature", "psi", "jsd"), "feature", "left")
    skew, kurt, ent = F.abs("skewness"), F.abs("kurtosis"), F.col("entropy")
    unfit = F.lit(None).cast("string")
    if fits is not None:
        known = fits.select("feature", F.lit(True).alias("fitted")).distinct()
        all_rows = all_rows.join(known, "feature", "left")
        unfit = F.when(F.col("skewness").isNotNull() & F.col("fitted").isNull(), "no_best_fit_found")
    tags = F.array(
        F.when(skew > 2, "extreme_skew").when(skew > 1, "moderate_skew"),
        F.when(kurt > 5, "extreme_kurtosis").when(kurt > 3, "moderate_kurtosis"),
        F.when(ent < 0.2, "very_low_entropy").when(ent < 1.0, "low_entropy"),
        unfit,
        F.when((F.col("psi") > 0.3) | (F.col("jsd") > 0.2), "high_drift").when((F.col("psi") > 0.1) | (F.col("jsd") > 0.1), "moderate_drift"),
    )
    return all_rows.select("feature", F.array_join(F.array_compact(tags), ",").alias("tags"))


def missing_by_class(df: DataFrame, target: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Null rate of each column in each target class, one grouped pass."""
    names = [c for c in (cols or df.columns) if c != target]
    one = df.groupBy(target).agg(*[F.avg(is_missing(df, c).cast("double")).alias(f"r{i}") for i, c in enumerate(names)])
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"r{i}").alias("null_rate")) for i, c in enumerate(names)]
    return one.select(target, F.inline(F.array(*rows)))


def equal_width_bin(value: Column, low: Column, high: Column, bins: int) -> Column:
    """1-based bin of equal width, the last one closed on the right; a constant column fills the middle bin."""
    width = (high - low) / bins
    raw = F.floor(F.try_divide(value - low, width)).cast("int") + 1
    return F.when(high == low, F.lit(bins // 2 + 1)).otherwise(F.least(F.greatest(raw, F.lit(1)), F.lit(bins)))


def histogram(df: DataFrame, cols: Sequence[str], bins: int, keys: Sequence[str] = ()) -> DataFrame:
    """``(keys..., feature, bin, n, lo, hi)``: non-empty equal-width bins over each column's own range."""
    long = melt(df, cols, keys)
    span = agg_long(df, cols, {"lo": F.min, "hi": F.max}, keys)
    joined = null_safe_join(long, F.broadcast(span) if not keys else span, [*keys, "feature"])
    binned = joined.withColumn("bin", equal_width_bin(F.col("value"), F.col("lo"), F.col("hi"), bins))
    return binned.groupBy(*keys, "feature", "bin").agg(F.count(F.lit(1)).alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))


def target_distribution(df: DataFrame, target: str, max_classes: int = 10, bins: int = 10) -> DataFrame:
    """Class bars up to ``max_classes`` distinct values, otherwise a histogram."""
    few = df.select(target).distinct().limit(max_classes + 1).count() <= max_classes
    numeric = isinstance(df.schema[target].dataType, T.NumericType)
    if few or not numeric:
        return shares(df, target).select(F.col("value").cast("string").alias("bar"), "n")
    return histogram(df, [target], bins).select(F.col("bin").cast("string").alias("bar"), "n")


def target_correlations(df: DataFrame, target: str, cols: Sequence[str] | None = None) -> DataFrame:
    """``(feature, corr)`` with the target, strongest positive first."""
    names = list(cols or numeric_cols(df, exclude=[target]))
    data = as_numbers(df, [*names, target])
    one = data.agg(*[F.corr(F.when(F.col(f"`{target}`").isNotNull(), F.col(f"`{c}`")), F.when(F.col(f"`{c}`").isNotNull(), F.col(f"`{target}`"))).alias(f"c{i}") for i, c in enumerate(names)])
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"c{i}").alias("corr")) for i, c in enumerate(names)]
    return one.select(F.inline(F.array(*rows))).orderBy(F.desc_nulls_last("corr"), "feature")


def health_report(df: DataFrame, target: str | None = None, dates: Sequence[str] = (), batch: str | None = None) -> dict[str, DataFrame]:
    """All sections of the health report by name."""
    out = {"dimensionality": regime(df), "missingness": missingness_report(df), "dtypes": type_counts(df)}
    if numeric_cols(df):
        out |= {"skewness": skew_report(df), "outliers": iqr_outlier_counts(df)}
    if len(numeric_cols(df)) > 1:
        out |= {"collinearity": collinear_pairs(df), "vif": vif(df)}
    if text_cols(df):
        out["cardinality"] = cardinality(df)
    if target in df.columns:
        out["imbalance"] = shares(df, target)
    if dates:
        out["date_issues"] = date_check(df, [c for c in dates if c in df.columns])
    if batch in df.columns:
        out["batch_distribution"] = shares(df, batch)
    return out
