"""Batch correction, reshaping and combining of measurement matrices.

Matrices are long: ``(feature, sample, batch, value)``. Wide gene tables have
thousands of columns and no natural row order, and the long form groups by
feature and batch with map-side combine.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import numeric_cols


def remove_batch_means(df: DataFrame, feature: str = "feature", batch: str = "batch", value: str = "value") -> DataFrame:
    """The feature-and-batch mean moved onto the feature mean."""
    per = df.groupBy(feature, batch).agg(F.sum(value).alias("__s"), F.count(value).alias("__n"))
    whole = per.groupBy(feature).agg((F.sum("__s") / F.sum("__n")).alias("__g"))
    offset = per.join(whole, feature).select(feature, batch, (F.col("__s") / F.col("__n") - F.col("__g")).alias("__off"))
    return df.join(offset, [feature, batch]).withColumn(value, F.col(value) - F.col("__off")).drop("__off")


def combat(df: DataFrame, feature: str = "feature", batch: str = "batch", value: str = "value", covariate: str | None = None, iterations: int = 60) -> DataFrame:
    """Additive and multiplicative batch effects removed with empirical Bayes shrinkage across features.

    ``covariate`` names a categorical column whose group means are kept. Moments
    per (feature, batch) and prior moments per batch are small grouped tables; the
    posterior of each (feature, batch) uses its moments only, so it is solved on
    that table and joined back.
    """
    eff = [feature, batch]
    if covariate is None:
        per = df.groupBy(*eff).agg(F.sum(value).alias("s"), F.count(value).cast("double").alias("n"))
        grand = per.groupBy(feature).agg((F.sum("s") / F.sum("n")).alias("alpha"))
        fit = df.join(grand, feature).withColumn("__keep", F.col("alpha"))
        mean = per.select(feature, batch, (F.col("s") / F.col("n")).alias("__bm"))
    else:
        # Additive model batch + covariate by least squares over the cell means of each feature.
        cells = df.groupBy(feature, batch, covariate).agg(F.avg(value).alias("m"), F.count(value).cast("double").alias("n"))

        def solve(pdf: pd.DataFrame) -> pd.DataFrame:
            bs, cs = sorted(pdf[batch].unique()), sorted(pdf[covariate].unique())
            x = np.zeros((len(pdf), len(bs) + len(cs) - 1))
            x[np.arange(len(pdf)), [bs.index(b) for b in pdf[batch]]] = 1.0
            for r, c in enumerate(pdf[covariate]):
                if cs.index(c):
                    x[r, len(bs) + cs.index(c) - 1] = 1.0
            w = np.sqrt(pdf["n"].to_numpy())
            beta = np.linalg.lstsq(x * w[:, None], pdf["m"].to_numpy() * w, rcond=None)[0]
            share = np.array([pdf.loc[pdf[batch] == b, "n"].sum() for b in bs])
            alpha = float(beta[: len(bs)] @ share / share.sum())
            cov = x[:, len(bs) :] @ beta[len(bs) :]
            out = pdf[[feature, batch, covariate]].copy()
            out["__keep"], out["__bm"] = alpha + cov, x @ beta
            return out

        types = {f.name: f.dataType.simpleString() for f in df.schema}
        solved = cells.groupBy(feature).applyInPandas(solve, f"`{feature}` {types[feature]}, `{batch}` {types[batch]}, `{covariate}` {types[covariate]}, __keep double, __bm double")
        fit = df.join(solved, [feature, batch, covariate])
        mean = None
    if mean is not None:
        fit = fit.join(mean, eff)
    resid = fit.withColumn("__r", F.col(value) - F.col("__bm"))
    var = resid.groupBy(feature).agg(F.avg(F.col("__r") * F.col("__r")).alias("__v"))
    z = fit.join(var, feature).withColumn("__sd", F.sqrt("__v")).withColumn("__z", F.try_divide(F.col(value) - F.col("__keep"), F.col("__sd")))
    mom = z.groupBy(*eff).agg(F.avg("__z").alias("g"), F.var_samp("__z").alias("d"), F.count("__z").cast("double").alias("n"), F.sum(F.col("__z") * F.col("__z")).alias("zz"))
    prior = mom.groupBy(batch).agg(F.avg("g").alias("gb"), F.var_samp("g").alias("t2"), F.avg("d").alias("dm"), F.var_samp("d").alias("dv"))
    table = mom.join(F.broadcast(prior), batch)

    def posterior(batches):
        for pdf in batches:
            g, d, n, zz = (pdf[c].to_numpy(dtype=float) for c in ("g", "d", "n", "zz"))
            gb, t2, dm, dv = (pdf[c].to_numpy(dtype=float) for c in ("gb", "t2", "dm", "dv"))
            with np.errstate(divide="ignore", invalid="ignore"):
                a = np.where(dv > 0, (2 * dv + dm**2) / dv, 1e6)
                b = np.where(dv > 0, (dm * dv + dm**3) / dv, dm * 1e6)
                gs, ds = g.copy(), np.where(np.isfinite(d) & (d > 0), d, 1.0)
                for _ in range(iterations):
                    gs = np.where(t2 > 0, (t2 * n * g + ds * gb) / (t2 * n + ds), gb)
                    ss = zz - 2 * gs * n * g + n * gs**2
                    ds = (0.5 * ss + b) / (n / 2 + a - 1)
            yield pdf[[feature, batch]].assign(__gs=gs, __ds=ds)

    types = {f.name: f.dataType.simpleString() for f in df.schema}
    post = table.mapInPandas(posterior, f"`{feature}` {types[feature]}, `{batch}` {types[batch]}, __gs double, __ds double")
    fixed = z.join(post, eff)
    new = F.col("__keep") + F.col("__sd") * F.coalesce((F.col("__z") - F.col("__gs")) / F.sqrt("__ds"), F.lit(0.0))
    return fixed.withColumn(value, new).select(*df.columns)


def collapse_probes(values: DataFrame, mapping: DataFrame, probe: str, gene: str, cols: Sequence[str] | None = None) -> DataFrame:
    """Known probes only, joined to their gene, averaged per gene."""
    known = values.join(mapping.select(probe).distinct(), probe, "left_semi")
    names = list(cols or [c for c in numeric_cols(values) if c != probe])
    return known.join(mapping.select(probe, gene).distinct(), probe).groupBy(gene).agg(*[F.avg(c).alias(c) for c in names])


def parse_annotation(c: Column, separator: str = "//", step: int = 5, start: int = 1) -> Column:
    """Every ``step``-th part from ``start``, trimmed, alphabetic ones only, distinct."""
    parts = F.transform(F.split(c, separator), lambda p: F.trim(p))
    nth = F.filter(parts, lambda p, i: i % step == start)
    return F.array_distinct(F.filter(nth, lambda p: p.rlike("^[A-Za-z]+$")))


def transpose_long(df: DataFrame, key: str, cols: Sequence[str], name: str = "sample") -> DataFrame:
    """Rows become columns: unpivot, then pivot on the key, whose levels must be few enough to be columns."""
    long = df.unpivot([key], list(cols), name, "value")
    return long.groupBy(name).pivot(key).agg(F.first("value"))


def label_from_title(df: DataFrame, title: str, rules: Mapping[str, str], out: str = "label") -> DataFrame:
    """First rule whose substring occurs in the title; rows without one are dropped."""
    low = F.lower(F.col(title))
    expr = reduce(lambda e, kv: (F.when if e is None else e.when)(low.contains(kv[0].lower()), kv[1]), rules.items(), None)
    return df.withColumn(out, expr).filter(F.col(out).isNotNull())


def union_common(frames: Sequence[DataFrame]) -> DataFrame:
    """Rows of all frames over their common columns, in the order of the first."""
    common = [c for c in frames[0].columns if all(c in f.columns for f in frames[1:])]
    return reduce(lambda a, b: a.unionByName(b), [f.select(*common) for f in frames])


def melt(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name: str = "variable", value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(cols), name, value)


def log2_normalize(df: DataFrame, cols: Sequence[str], limit: float = 100.0) -> DataFrame:
    """log2(x + 1) for all columns if the largest value exceeds ``limit``."""
    top = df.agg(F.greatest(*[F.max(c) for c in cols], F.lit(float("-inf")))).scalar()
    return df.withColumns({c: F.when(top > limit, F.log2(F.col(c) + 1)).otherwise(F.col(c).cast("double")) for c in cols})
