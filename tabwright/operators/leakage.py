"""Leakage checks between features, target and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import agg_long, melt, melt_text, numeric_cols, observed, text_cols
from .association import bin_column, quantile_bins
from .evaluate import auc
from .profile import target_correlations

# Flag limits.
CORR_LIMIT, AUC_LIMIT = 0.99, 0.99


def is_classification(df: DataFrame, target: str) -> bool:
    numeric = isinstance(df.schema[target].dataType, T.NumericType)
    return not numeric or df.select(target).dropna().distinct().limit(3).count() <= 2


def high_correlation(df: DataFrame, target: str, cols: Sequence[str] | None = None, limit: float = CORR_LIMIT) -> DataFrame:
    return target_correlations(df, target, cols).filter(F.abs("corr") >= limit)


def constant_groups(df: DataFrame, target: str, cols: Sequence[str] | None = None, bins: int = 10) -> DataFrame:
    """``(feature, value, n)``: values (or deciles of numbers with more than ten) that know one target class only."""
    names = [c for c in (cols or df.columns) if c != target]
    nums = [c for c in names if c in numeric_cols(df)]
    many = []
    if nums:
        near = df.agg(*[F.approx_count_distinct(observed(df, c), 0.01).alias(c) for c in nums]).first()
        close = [c for c in nums if near[c] < 2 * bins]
        exact = df.agg(*[F.count_distinct(observed(df, c)).alias(c) for c in close]).first() if close else {}
        many = [c for c in nums if c not in close or exact[c] > bins]
    edges = quantile_bins(df, many, bins) if many else {}
    cells = [
        F.struct(F.lit(c).alias("feature"), (bin_column(observed(df, c), edges[c]) if c in many else F.col(f"`{c}`").cast("string")).alias("value"), F.col(target).alias("y"))
        for c in names
    ]
    rows = df.select(F.inline(F.array(*cells))).filter(F.col("value").isNotNull())
    levels = rows.groupBy("feature", "value", "y").agg(F.count(F.lit(1)).alias("n"))
    return levels.groupBy("feature", "value").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).filter(F.col("k") == 1).drop("k")


def feature_auc(df: DataFrame, label: str, numeric: Sequence[str] | None = None, categorical: Sequence[str] | None = None, limit: float = AUC_LIMIT) -> DataFrame:
    """``(feature, auc, leaky)`` of a 0/1 label.

    Numbers are scaled to [0, 1] with nulls at 0.5 and ranked. A level dummy has
    AUC = (1 + tpr - fpr) / 2, so categories need counts only; the best level counts.
    """
    nums = [c for c in (numeric_cols(df) if numeric is None else numeric) if c != label]
    cats = [c for c in (text_cols(df) if categorical is None else categorical) if c != label]
    parts = []
    if nums:
        span = agg_long(df, nums, {"lo": F.min, "hi": F.max}).filter(F.col("lo") < F.col("hi"))
        long = melt(df, nums, [label], drop_missing=False).join(F.broadcast(span), "feature")
        scaled = F.coalesce((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo") + 1e-9), F.lit(0.5))
        parts.append(auc(long.select("feature", label, scaled.alias("s")), label, "s", ["feature"]))
    if cats:
        y = F.col(label) == 1
        levels = melt_text(df, cats, [label]).groupBy("feature", "value").agg(F.count_if(y).alias("p"), F.count_if(~y).alias("q"))
        total = levels.groupBy("feature").agg(F.sum("p").alias("pp"), F.sum("q").alias("qq"))
        rate = (1 + F.try_divide(F.col("p"), F.col("pp")) - F.try_divide(F.col("q"), F.col("qq"))) / 2
        parts.append(levels.filter(F.col("value").isNotNull()).join(F.broadcast(total), "feature").groupBy("feature").agg(F.max(rate).alias("auc")))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return out.withColumn("leaky", F.coalesce(F.col("auc") >= limit, F.lit(False)))


def separation_auc(train: DataFrame, test: DataFrame, numeric: Sequence[str] | None = None, categorical: Sequence[str] | None = None, limit: float = AUC_LIMIT) -> DataFrame:
    """How well each feature alone tells test rows from training rows."""
    both = train.withColumn("__is_test", F.lit(0)).unionByName(test.withColumn("__is_test", F.lit(1)))
    return feature_auc(both, "__is_test", numeric, categorical, limit)


def unseen_levels(train: DataFrame, test: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(feature, value)`` of test levels that the training set lacks."""
    names = [c for c in (cols or text_cols(train)) if c in test.columns]
    levels = lambda df: melt_text(df, names).filter(F.col("value").isNotNull()).distinct()
    return levels(test).join(levels(train), ["feature", "value"], "left_anti")


def timestamp_auc(df: DataFrame, ts: str, label: str) -> DataFrame:
    t = df.select(F.unix_micros(F.col(ts).cast("timestamp")).alias("t"), F.col(label))
    return auc(t, label, "t").withColumn("leaky", F.col("auc") >= AUC_LIMIT)


def future_ratio(df: DataFrame, ts: str, reference: str) -> DataFrame:
    """Share of timestamps after the reference timestamp."""
    return df.agg(F.avg((F.col(ts) > F.col(reference)).cast("double")).alias("future_ratio"))
