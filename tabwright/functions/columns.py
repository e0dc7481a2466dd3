"""Column roles, the missing test, and fused wide-to-long aggregation."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Above this many aggregate expressions a wide agg outgrows generated-code
# limits, and the long form (one row per cell) is used instead.
MAX_WIDE_EXPRESSIONS = 400
# Rows in a partition beyond which rows are dealt out anew before a fit.
PART_ROWS = 200_000


def numeric_cols(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def text_cols(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    kinds = (T.StringType, T.BooleanType)
    return [f.name for f in df.schema if isinstance(f.dataType, kinds) and f.name not in exclude]


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, and NaN for floating columns."""
    kind = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def observed(df: DataFrame, name: str) -> Column:
    """The value as double, missing as NULL."""
    return F.when(~is_missing(df, name), F.col(f"`{name}`").cast("double"))


def as_numbers(df: DataFrame, cols: Sequence[str], keep: Sequence[str | Column] = ()) -> DataFrame:
    """Only ``cols`` as doubles with NaN turned into NULL, plus ``keep``."""
    return df.select(*keep, *[observed(df, c).alias(c) for c in cols])


def evenly(df: DataFrame, most: int = PART_ROWS) -> DataFrame:
    """``df`` as it is, or dealt out evenly where a partition holds over ``most`` rows, as a file of few row groups gives; every fit reads its rows many times."""
    sizes = df.groupBy(F.spark_partition_id().alias("part")).count().agg(F.max("count"), F.sum("count")).first()
    return df if (sizes[0] or 0) <= most else df.repartition(-(-sizes[1] // (most // 2)))


def melt(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (), drop_missing: bool = True) -> DataFrame:
    """Numeric columns as ``(keep..., feature, value)`` rows."""
    out = as_numbers(df, cols, keep).unpivot(list(keep), list(cols), "feature", "value")
    return out.filter(F.col("value").isNotNull()) if drop_missing else out


def melt_text(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Any columns as ``(keep..., feature, value)`` rows with text values, nulls kept."""
    cells = [
        F.when(~is_missing(df, c), F.col(f"`{c}`").cast("string")).alias(c) for c in cols
    ]
    return df.select(*keep, *cells).unpivot(list(keep), list(cols), "feature", "value")


def agg_long(
    df: DataFrame,
    cols: Sequence[str],
    metrics: Mapping[str, Callable[[Column], Column]],
    keys: Sequence[str] = (),
) -> DataFrame:
    """Metrics of many numeric columns in one pass, as ``(keys..., feature, metric...)``.

    A wide aggregate is one scan with map-side combine and no row blow-up; very
    wide frames go through the long form so that generated code stays small.
    """
    if len(cols) * len(metrics) > MAX_WIDE_EXPRESSIONS:
        long = melt(df, cols, keys, drop_missing=False)
        return long.groupBy(*keys, "feature").agg(*[f(F.col("value")).alias(m) for m, f in metrics.items()])
    wide = as_numbers(df, cols, keys)
    aggs = [
        f(F.col(f"`{c}`")).alias(f"{i}__{m}") for i, c in enumerate(cols) for m, f in metrics.items()
    ]
    one = wide.groupBy(*keys).agg(*aggs) if keys else wide.agg(*aggs)
    rows = [
        F.struct(F.lit(c).alias("feature"), *[F.col(f"{i}__{m}").alias(m) for m in metrics])
        for i, c in enumerate(cols)
    ]
    return one.select(*keys, F.inline(F.array(*rows)))


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys meet; the right copies of the keys are dropped."""
    renamed = right.select(
        *[F.col(f"`{k}`").alias(f"__r{i}") for i, k in enumerate(keys)],
        *[c for c in right.columns if c not in keys],
    )
    on = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(f"__r{i}")) for i, k in enumerate(keys)])
    return left.join(renamed, on, how).drop(*[f"__r{i}" for i in range(len(keys))])


def rounded(df: DataFrame, digits: int = 6, skip: Sequence[str] = ()) -> DataFrame:
    """Every double column rounded, for stable comparison."""
    return df.select(
        *[
            F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType) and f.name not in skip
            else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def hash_unit(*cols: Column | str, seed: int = 42) -> Column:
    """A seeded draw in [0, 1) from row keys: the same on every retry."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") if isinstance(c, str) else c.cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def try_divide(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def xlogx(c: Column) -> Column:
    return F.when(c > 0, c * F.ln(c)).otherwise(F.lit(0.0))
