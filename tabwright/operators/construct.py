"""Feature construction: group, pair, text, date and window features."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ordering
from ..functions.columns import null_safe_join, numeric_cols, observed
from ..session import cut_lineage
from .association import is_regression, mutual_information
from .profile import target_correlations

AGGREGATES: dict[str, Callable[[Column], Column]] = {
    "mean": F.avg,
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "std": F.stddev_samp,
    "var": F.var_samp,
    "count": F.count,
    "nunique": F.count_distinct,
}


# A prime just above 2^32: products of a factor and a code stay inside 64 bits.
MINHASH_PRIME = 4294967311


def group_aggregates(df: DataFrame, spec: Mapping[str, Mapping[str, Sequence[str]]]) -> DataFrame:
    """``{key: {column: [functions]}}`` as ``<key>_<column>_<function>``, joined back on the key.

    Grouped and joined rather than windowed: partial aggregation absorbs a hot
    key, and the join splits it.
    """
    out = df
    for key, cols in spec.items():
        per = df.groupBy(key).agg(*[AGGREGATES[f](F.col(c)).alias(f"{key}_{c}_{f}") for c, fs in cols.items() for f in fs])
        out = out.join(per.filter(F.col(key).isNotNull()), key, "left")
    return out


def ratio(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    return df.withColumns({f"{a}_div_{b}": F.try_divide(observed(df, a), observed(df, b)) for a, b in pairs})


def difference(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    return df.withColumns({f"{a}_minus_{b}": observed(df, a) - observed(df, b) for a, b in pairs})


def cross(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """``<a>_x_<b>`` joined text and its SHA-256."""
    out = {}
    for a, b in pairs:
        text = F.concat_ws("_", F.col(a).cast("string"), F.col(b).cast("string"))
        out |= {f"{a}_x_{b}": text, f"{a}_x_{b}_hash": F.sha2(text, 256)}
    return df.withColumns(out)


def minhash_permutations(permutations: int = 128, seed: int = 42) -> list[tuple[int, int]]:
    """Factor and shift of each permutation c -> (factor * c + shift) modulo ``MINHASH_PRIME``."""
    rng = np.random.default_rng(seed)
    return list(zip(rng.integers(1, 2**31, permutations).tolist(), rng.integers(0, 2**31, permutations).tolist()))


def minhash(df: DataFrame, text: str, permutations: int = 128, out: str | None = None, seed: int = 42) -> DataFrame:
    """Signature of ``permutations`` minima of permuted token codes (32 bits of MD5); a text without tokens gets NULL."""
    words = F.array_distinct(F.filter(F.split(F.lower(F.col(text)), r"\s+"), lambda w: w != ""))
    codes = F.transform(words, lambda w: F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("long"))
    factors, shifts = (ordering.number_array(list(v)).cast("array<bigint>") for v in zip(*minhash_permutations(permutations, seed)))
    minima = lambda c: F.zip_with(factors, shifts, lambda a, b: F.array_min(F.transform(c, lambda x: (a * x + b) % MINHASH_PRIME)))
    # The codes are bound once by transform; a plain reference would repeat them for every permutation.
    signature = F.get(F.transform(F.array(codes), lambda c: F.when(F.size(c) > 0, minima(c))), F.lit(0))
    return df.withColumn(out or f"{text}_minhash", signature)


def frequency_count(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``<col>_count``: rows that share the value."""
    out = df
    for c in cols:
        per = df.groupBy(c).agg(F.count(F.lit(1)).alias(f"{c}_count"))
        out = null_safe_join(out, per, [c], "left")
    return out


def text_stats(df: DataFrame, text: str) -> DataFrame:
    words = F.filter(F.split(F.col(text), r"\s+"), lambda w: w != "")
    return df.withColumns(
        {
            f"{text}_chars": F.length(text),
            f"{text}_words": F.size(words),
            f"{text}_unique_words": F.size(F.array_distinct(words)),
            f"{text}_punct": F.length(text) - F.length(F.translate(F.col(text), ".,;:!?", "")),
        }
    )


def date_difference(df: DataFrame, a: str, b: str, out: str | None = None) -> DataFrame:
    """Whole days of a - b, rounded down."""
    seconds = F.unix_micros(F.col(a).cast("timestamp")) - F.unix_micros(F.col(b).cast("timestamp"))
    return df.withColumn(out or f"{a}_minus_{b}_days", F.floor(seconds / F.lit(86_400_000_000)))


def rolling(df: DataFrame, cols: Sequence[str], window: int, order: str, keys: Sequence[str] = (), tie: str | None = None) -> DataFrame:
    """``<col>_roll<w>_mean`` and ``_std`` over the last ``window`` rows."""

    def build(w):
        frame = w.rowsBetween(-(window - 1), 0)
        return {f"{c}_roll{window}_{n}": f(observed(df, c)).over(frame) for c in cols for n, f in (("mean", F.avg), ("std", F.stddev_samp))}

    return ordering.row_window(df, order, build, back=window - 1, keys=keys, tie=tie).drop("__rn")


def custom_columns(df: DataFrame, makers: Mapping[str, Callable[[DataFrame], Column]]) -> DataFrame:
    """Named columns from callables of the frame; a vectorized ``pandas_udf`` is a Column too."""
    return df.withColumns({n: f(df) for n, f in makers.items()})


def custom_steps(df: DataFrame, steps: Sequence[Callable[[DataFrame], DataFrame]]) -> DataFrame:
    for step in steps:
        df = df.transform(step)
    return df


def score_features(df: DataFrame, target: str, new_cols: Sequence[str], min_score: float = 0.0) -> DataFrame:
    """``(feature, score, applied, reason)``: absolute correlation for a regression target, else MI."""
    if is_regression(df, target):
        nums = [c for c in new_cols if c in numeric_cols(df)]
        s = target_correlations(df, target, nums).select("feature", F.abs("corr").alias("score"))
    else:
        s = mutual_information(df, target, new_cols, regression=False).select("feature", F.col("mi").alias("score"))
    ok = F.coalesce(F.col("score") >= min_score, F.lit(False))
    sign = F.when(ok, ">=").otherwise("<")
    return s.select("feature", "score", ok.alias("applied"), F.format_string("score %.4f %s threshold %s", F.col("score"), sign, F.lit(str(min_score))).alias("reason"))


def keep_scored(df: DataFrame, decisions: DataFrame) -> DataFrame:
    gone = [r["feature"] for r in decisions.filter(~F.col("applied")).collect()]
    return df.drop(*gone)


def lags(df: DataFrame, c: str, steps: Sequence[int], order: str, keys: Sequence[str] = (), tie: str | None = None, backfill: bool = False) -> DataFrame:
    """``<col>_lag<k>``; with ``backfill`` the leading gap takes the next known value."""
    out = ordering.row_window(df, order, lambda w: {f"{c}_lag{k}": F.lag(c, k).over(w) for k in steps}, back=max(steps), keys=keys, tie=tie).drop("__rn")
    if backfill:
        for k in steps:
            name = f"{c}_lag{k}"
            out = ordering.carry(cut_lineage(out), name, order, "__filled", keys, tie, forward=False).drop(name).withColumnRenamed("__filled", name)
    return out


def propagate(df: DataFrame, flag: str, ahead: int, order: str, keys: Sequence[str] = (), tie: str | None = None) -> DataFrame:
    """``<flag>_active``: 1 on the flagged row and the ``ahead`` rows after it."""
    return ordering.row_window(df, order, lambda w: {f"{flag}_active": F.max(flag).over(w.rowsBetween(-ahead, 0))}, back=ahead, keys=keys, tie=tie).drop("__rn")


def days_since(df: DataFrame, c: str, reference: Column) -> DataFrame:
    return df.withColumn(f"days_since_{c}", F.datediff(reference, F.col(c)))
