"""Association between columns: rank and linear correlation, tables, information."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import ordering, special
from ..functions.columns import agg_long, as_numbers, melt, melt_text, numeric_cols, observed, text_cols, xlogx
from ..session import cut_lineage
from .profile import equal_width_bin, feature_quantiles, histogram, target_correlations

REGRESSION_DISTINCT = 20


def correlation_ratio(df: DataFrame, cat: str, cols: Sequence[str]) -> DataFrame:
    """1 - (sum n_g var_g / N) / var_total with sample variances, at least 0."""
    data = as_numbers(df, cols, [cat]).filter(F.col(cat).isNotNull())
    per = agg_long(data, cols, {"n": F.count, "m": F.avg, "v": F.var_samp}, [cat])
    n = F.sum("n")
    whole = agg_long(data, cols, {"total": F.var_samp})
    out = per.groupBy("feature").agg((F.sum(F.col("n") * F.coalesce("v", F.lit(0.0))) / n).alias("within"))
    eta = F.greatest(F.lit(0.0), 1 - F.try_divide(F.col("within"), F.col("total")))
    return out.join(F.broadcast(whole), "feature").select("feature", eta.alias("eta_squared"))


def contingency(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """``(a, b, va, vb, n)`` for many column pairs in one grouped pass."""
    cells = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{a}`").cast("string").alias("va"), F.col(f"`{b}`").cast("string").alias("vb"))
        for a, b in pairs
    ]
    rows = df.select(F.inline(F.array(*cells))).filter(F.col("va").isNotNull() & F.col("vb").isNotNull())
    return rows.groupBy("a", "b", "va", "vb").agg(F.count(F.lit(1)).cast("double").alias("n"))


def chi_square(table: DataFrame, keys: Sequence[str] = ("a", "b"), row: str = "va", col: str = "vb") -> DataFrame:
    """``(keys..., n, rows, cols, chi2, dof)`` of contingency counts.

    Empty cells need no rows: sum (O-E)^2/E equals n (sum O^2/(r c) - 1). A 2 x 2
    table gets the Yates correction.
    """
    keys = list(keys)
    r = table.groupBy(*keys, row).agg(F.sum("n").alias("r"))
    c = table.groupBy(*keys, col).agg(F.sum("n").alias("c"))
    rs = r.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.sum(1 / F.col("r")).alias("ir"), F.sum("r").alias("n_all"))
    cs = c.groupBy(*keys).agg(F.count(F.lit(1)).alias("cols"), F.sum(1 / F.col("c")).alias("ic"))
    if keys:
        full = table.join(r, [*keys, row]).join(c, [*keys, col])
        part = full.groupBy(*keys).agg(
            F.sum(F.col("n") * F.col("n") / (F.col("r") * F.col("c"))).alias("s"),
            F.max_by(F.struct("n", "r", "c"), "n").alias("cell"),
        )
        out = part.join(rs, keys).join(cs, keys)
    else:
        full = table.join(r, row).join(c, col)
        part = full.agg(
            F.sum(F.col("n") * F.col("n") / (F.col("r") * F.col("c"))).alias("s"), F.max_by(F.struct("n", "r", "c"), "n").alias("cell")
        )
        one = F.lit(1).alias("__k")
        out = part.select(one, "*").join(rs.select(one, "*"), "__k").join(cs.select(one, "*"), "__k").drop("__k")
    n = F.col("n_all")
    gap = F.abs(F.col("cell.n") - F.col("cell.r") * F.col("cell.c") / n)
    yates = F.pow(gap - F.least(F.lit(0.5), gap), 2) * n * F.col("ir") * F.col("ic")
    plain = F.greatest(F.lit(0.0), n * (F.col("s") - 1))
    two = (F.col("rows") == 2) & (F.col("cols") == 2)
    return out.select(
        *keys, n.alias("n"), "rows", "cols", F.when(two, yates).otherwise(plain).alias("chi2"), ((F.col("rows") - 1) * (F.col("cols") - 1)).alias("dof")
    )


def cramers_v(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    names = list(cols or text_cols(df))
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]
    chi = chi_square(contingency(df, pairs)).filter((F.col("rows") > 1) & (F.col("cols") > 1))
    v = F.sqrt(F.col("chi2") / F.col("n") / (F.least("rows", "cols") - 1))
    return chi.select("a", "b", v.alias("cramers_v"))


def pair_information(table: DataFrame, keys: Sequence[str] = ("a", "b"), row: str = "va", col: str = "vb") -> DataFrame:
    """``(keys..., n, hx, hy, mi)`` in nats from counts; MI = H(x) + H(y) - H(x, y), so no joins of cells."""
    keys = list(keys)

    def h(levels: Sequence[str], name: str) -> DataFrame:
        counts = table.groupBy(*keys, *levels).agg(F.sum("n").alias("n"))
        return counts.groupBy(*keys).agg(F.sum("n").alias(f"n_{name}"), F.sum(xlogx(F.col("n"))).alias(f"s_{name}"))

    out = h([row, col], "xy").join(h([row], "x"), keys).join(h([col], "y"), keys)
    n = F.col("n_xy")
    ent = lambda s: F.greatest(F.lit(0.0), F.ln(n) - F.col(s) / n)
    return out.select(*keys, n.alias("n"), ent("s_x").alias("hx"), ent("s_y").alias("hy"), F.greatest(F.lit(0.0), ent("s_x") + ent("s_y") - ent("s_xy")).alias("mi"))


def theils_u(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(a, b, u)`` = MI(a, b) / H(a) for both directions; 1 when H(a) is 0."""
    names = list(cols or text_cols(df))
    info = pair_information(contingency(df, [(a, b) for i, a in enumerate(names) for b in names[i + 1 :]]))
    u = lambda h: F.when(F.col(h) == 0, 1.0).otherwise(F.col("mi") / F.col(h))
    both = F.array(
        F.struct(F.col("a").alias("a"), F.col("b").alias("b"), u("hx").alias("u")),
        F.struct(F.col("b").alias("a"), F.col("a").alias("b"), u("hy").alias("u")),
    )
    return info.select(F.inline(both))


# Classes that may become columns of one table.
MAX_CLASSES = 5000


def _cells(df: DataFrame, x: str, y: str) -> DataFrame:
    data = df.select(observed(df, x).alias("x"), observed(df, y).alias("y")).dropna()
    return data.groupBy("x", "y").agg(F.count(F.lit(1)).cast("double").alias("n"))


def spearman(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """``(a, b, rho)``: correlation of average ranks over pairwise complete rows.

    All pairs go together: equal value pairs are combined first, both sides of every
    pair are ranked in one run over counts per distinct value, and the mean rank
    is known in advance, so only sums are left.
    """
    known = {c: observed(df, c) for pair in pairs for c in pair}
    rows = [F.struct(F.lit(i).alias("pair"), known[a].alias("x"), known[b].alias("y")) for i, (a, b) in enumerate(pairs)]
    long = df.select(F.inline(F.array(*rows))).filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    cells = cut_lineage(long.groupBy("pair", "x", "y").agg(F.count(F.lit(1)).cast("double").alias("n")))
    sides = cells.select("pair", F.inline(F.array(*[F.struct(F.lit(s).alias("side"), F.col(s).alias("value"), "n") for s in ("x", "y")])))
    counts = cut_lineage(sides.groupBy("pair", "side", "value").agg(F.sum("n").alias("n")))
    keys = ["pair", "side"]
    run = ordering.running(counts, "value", {"c": F.col("n")}, keys, keys)
    ranks = cut_lineage(run.select(*keys, "value", (F.col("c") - (F.col("n") - 1) / 2 - (F.col("c__all") + 1) / 2).alias("rank")))
    of = lambda s: ranks.filter(F.col("side") == s).select("pair", F.col("value").alias(s), F.col("rank").alias(f"r{s}"))
    full = cells.join(of("x"), ["pair", "x"]).join(of("y"), ["pair", "y"])
    n = F.col("n")
    sums = full.groupBy("pair").agg(*[F.sum(n * F.col(f"r{a}") * F.col(f"r{b}")).alias(a + b) for a, b in ("xy", "xx", "yy")])
    names = df.sparkSession.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "pair int, a string, b string")
    return F.broadcast(names).join(sums, "pair", "left").select("a", "b", F.try_divide(F.col("xy"), F.sqrt(F.col("xx") * F.col("yy"))).alias("rho"))


def _discordance(group: np.ndarray, x: np.ndarray, y: np.ndarray, w: np.ndarray, bits: int) -> float:
    """Weighted concordant minus discordant pairs inside each group of cells with digits x and y under 2^bits; ties count nothing.

    Two cells of different x part at the highest bit in which their x differ: bit by bit,
    the cells with 1 look up the cells with 0 of the same higher bits and smaller or larger y.
    """
    score, base = 0.0, 1 << bits
    for bit in range(bits):
        part = group * base + (x >> (bit + 1))
        order = np.argsort(part * base + y, kind="stable")
        part, place, weight, one = part[order], (part * base + y)[order], w[order], (x[order] >> bit) & 1 == 1
        zeros = np.concatenate([[0.0], np.cumsum(np.where(one, 0.0, weight))])
        at = lambda v, side="left": zeros[np.searchsorted(place, v, side)]
        below = at(place[one]) - at(part[one] * base)
        above = at((part[one] + 1) * base) - at(place[one], "right")
        score += float(np.sum(weight[one] * (below - above)))
    return score


def kendall(df: DataFrame, x: str, y: str, bits: int = 8) -> DataFrame:
    """``(a, b, tau)``: tau-b by levels, without comparing all pairs and without a group that grows.

    Equal (x, y) pairs are combined, and both values become positions among the
    distinct ones, read as digits of ``bits`` bits. Two rows part on each axis at one digit;
    so for every pair of levels the rows are summed by their digits at these levels inside groups of
    equal higher digits, and each group is a grid of at most 4^bits cells, whatever the input.
    There are as many levels on an axis as its number of distinct values has digits.
    """
    cells = cut_lineage(_cells(df, x, y))
    placed, tops = cells, {}
    for c in ("x", "y"):
        index = ordering.dense_index(cells.select(c).distinct(), c, f"i{c}")
        tops[c] = -(-max(int(index.agg(F.max(f"i{c}")).first()[0] or 0), 1).bit_length() // bits)
        placed = placed.join(index, c)
    placed = cut_lineage(placed.select("ix", "iy", "n"))
    mask = (1 << bits) - 1

    def score(batches):
        held, names = None, ["gx", "gy"]
        for b in batches:
            b = b if held is None else pd.concat([held, b], ignore_index=True)
            last = (b[names] == b[names].iloc[-1]).all(axis=1) if len(b) else pd.Series([], dtype=bool)
            held, b = b[last], b[~last]
            if len(b):
                yield pd.DataFrame({"s": [_grids(b, bits)]})
        if held is not None and len(held):
            yield pd.DataFrame({"s": [_grids(held, bits)]})

    parts = []
    for lx in range(tops["x"]):
        for ly in range(tops["y"]):
            sx, sy = bits * lx, bits * ly
            digits = [
                F.shiftright("ix", sx + bits).alias("gx"), F.shiftright("iy", sy + bits).alias("gy"),
                F.shiftright("ix", sx).bitwiseAND(mask).alias("dx"), F.shiftright("iy", sy).bitwiseAND(mask).alias("dy"),
            ]
            grid = placed.groupBy(*digits).agg(F.sum("n").alias("n"))
            group = Window.partitionBy("gx", "gy")
            differs = [F.min(c).over(group) < F.max(c).over(group) for c in ("dx", "dy")]
            # The window leaves each group in one piece; most groups of the low levels are single cells and go here.
            mixed = grid.withColumn("__mixed", differs[0] & differs[1]).filter("__mixed").drop("__mixed")
            parts.append(mixed.mapInPandas(score, "s double"))
    scores = parts[0]
    for p in parts[1:]:
        scores = scores.unionByName(p)
    total = scores.agg(F.coalesce(F.sum("s"), F.lit(0.0)).alias("score"))
    ties = lambda c: cells.groupBy(c).agg(F.sum("n").alias("n")).agg(F.sum(F.col("n") * (F.col("n") - 1) / 2)).scalar()
    n = cells.agg(F.sum("n")).scalar()
    pairs = n * (n - 1) / 2
    tau = F.try_divide(F.col("score"), F.sqrt((pairs - ties("x")) * (pairs - ties("y"))))
    return total.select(F.lit(x).alias("a"), F.lit(y).alias("b"), tau.alias("tau"))


def _grids(cells: pd.DataFrame, bits: int) -> float:
    edge = (cells[["gx", "gy"]].diff() != 0).any(axis=1)
    return _discordance(edge.cumsum().to_numpy(np.int64), cells["dx"].to_numpy(np.int64), cells["dy"].to_numpy(np.int64), cells["n"].to_numpy(), bits)


def target_correlation_tests(df: DataFrame, target: str, cols: Sequence[str] | None = None) -> DataFrame:
    """``(feature, method, corr, t, p)``: point-biserial up to two classes, else Pearson."""
    names = list(cols or numeric_cols(df, exclude=[target]))
    binary = df.select(target).dropna().distinct().limit(3).count() <= 2
    low = df.agg(F.min(target)).scalar()
    coded = df.withColumn(target, (F.col(target) != low).cast("double")) if binary else df
    n = agg_long(coded.dropna(subset=[target]), names, {"n": F.count})
    out = target_correlations(coded, target, names).join(F.broadcast(n), "feature")
    r = F.col("corr")
    t = r * F.sqrt(F.try_divide(F.col("n") - 2, 1 - r * r))
    p = special.on_results(lambda stat, size: special.t_sf2(stat, size - 2))
    return out.withColumn("t", t).select(
        "feature", F.lit("point_biserial" if binary else "pearson").alias("method"), "corr", "t", p("t", F.col("n").cast("double")).alias("p")
    )


def quantile_bins(df: DataFrame, cols: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Distinct inner edges of equal-frequency bins, a few numbers per column."""
    cuts = [i / bins for i in range(1, bins)]
    return {r["feature"]: sorted(set(r["q"])) for r in feature_quantiles(df, cols, cuts).collect()}


def bin_column(value: Column, edges: Sequence[float]) -> Column:
    """Number of edges below the value, as text; NULL stays NULL."""
    if not edges:
        return F.when(value.isNotNull(), "0")
    total = (value > F.lit(edges[0])).cast("int")
    for e in edges[1:]:
        total = total + (value > F.lit(e)).cast("int")
    return total.cast("string")


def is_regression(df: DataFrame, target: str, distinct: int = REGRESSION_DISTINCT) -> bool:
    if not isinstance(df.schema[target].dataType, T.NumericType):
        return False
    return df.select(target).dropna().distinct().limit(distinct + 1).count() > distinct


def mutual_information(df: DataFrame, target: str, cols: Sequence[str] | None = None, bins: int = 10, regression: bool | None = None) -> DataFrame:
    """``(feature, mi)`` in nats between each feature and the target.

    Numeric features (and a numeric target with many values) enter as
    equal-frequency bins, others as they are; nulls are left out pairwise.
    """
    names = [c for c in (cols or df.columns) if c != target]
    nums = [c for c in names if c in numeric_cols(df)]
    regression = is_regression(df, target) if regression is None else regression
    edges = quantile_bins(df, [*nums, *([target] if regression else [])], bins) if nums or regression else {}
    y = bin_column(observed(df, target), edges[target]) if regression else F.col(target).cast("string")
    cells = [
        F.struct(F.lit(c).alias("feature"), (bin_column(observed(df, c), edges.get(c, [])) if c in nums else F.col(f"`{c}`").cast("string")).alias("x"), y.alias("y"))
        for c in names
    ]
    rows = df.select(F.inline(F.array(*cells))).filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    counts = rows.groupBy("feature", "x", "y").agg(F.count(F.lit(1)).cast("double").alias("n"))
    return pair_information(counts, ["feature"], "x", "y").select("feature", "mi")


def anova_f(df: DataFrame, target: str, cols: Sequence[str] | None = None) -> DataFrame:
    """``(feature, f, p)``: between over within mean squares across target classes."""
    names = list(cols or numeric_cols(df, exclude=[target]))
    per = agg_long(df.filter(F.col(target).isNotNull()), names, {"n": F.count, "m": F.avg, "v": F.var_samp}, [target]).filter(F.col("n") > 0)
    grand = per.groupBy("feature").agg((F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("g"))
    sums = per.join(F.broadcast(grand), "feature").groupBy("feature").agg(
        F.sum(F.col("n") * F.pow(F.col("m") - F.col("g"), 2)).alias("ssb"),
        F.sum(F.coalesce((F.col("n") - 1) * F.col("v"), F.lit(0.0))).alias("ssw"),
        (F.count(F.lit(1)) - 1).cast("double").alias("d1"),
        (F.sum("n") - F.count(F.lit(1))).cast("double").alias("d2"),
    )
    f = F.try_divide(F.try_divide(F.col("ssb"), F.col("d1")), F.try_divide(F.col("ssw"), F.col("d2")))
    return sums.withColumn("f", f).select("feature", "f", special.on_results(special.f_sf)("f", "d1", "d2").alias("p"))


def dependency_scores(df: DataFrame, target: str, cols: Sequence[str] | None = None, gap: float = 0.2, max_classes: int = 10) -> DataFrame:
    """``(feature, pearson, rho, method, score)``: MI where ranks and values disagree, else F."""
    names = list(cols or numeric_cols(df, exclude=[target]))
    linear = target_correlations(df, target, names)
    ranks = spearman(df, [(c, target) for c in names]).select(F.col("a").alias("feature"), "rho")
    mi = mutual_information(df, target, names)
    if is_regression(df, target, max_classes):
        n = agg_long(df.dropna(subset=[target]), names, {"n": F.count})
        r2 = F.col("corr") * F.col("corr")
        f = linear.join(F.broadcast(n), "feature").select("feature", F.try_divide(r2 * (F.col("n") - 2), 1 - r2).alias("f"))
    else:
        f = anova_f(df, target, names).select("feature", "f")
    out = linear.join(ranks, "feature").join(mi, "feature").join(f, "feature")
    bent = F.abs(F.col("rho") - F.col("corr")) > gap
    return out.select(
        "feature",
        F.col("corr").alias("pearson"),
        "rho",
        F.when(bent, "mutual_info").otherwise("f_test").alias("method"),
        F.when(bent, F.col("mi")).otherwise(F.col("f")).alias("score"),
    )


def conditional_table(df: DataFrame, cat: str, target: str, classes: Sequence[str] | None = None) -> DataFrame:
    """P(target | category) with one column per class and ``__count``; classes must be few."""
    known = df.select(cat, F.col(target).cast("string").alias("__t")).filter(F.col(cat).isNotNull() & F.col("__t").isNotNull())
    levels = list(classes) if classes else sorted(r[0] for r in known.select("__t").distinct().limit(MAX_CLASSES + 1).collect())
    if len(levels) > MAX_CLASSES:
        raise ValueError(f"{target} has more than {MAX_CLASSES} classes: name the ones you want")
    per = known.groupBy(cat).agg(*[F.count_if(F.col("__t") == v).alias(f"__c{i}") for i, v in enumerate(levels)], F.count(F.lit(1)).alias("__count"))
    return per.select(cat, *[(F.col(f"__c{i}") / F.col("__count")).alias(v) for i, v in enumerate(levels)], "__count")


def entropy_bits(df: DataFrame, cols: Sequence[str], bins: int = 20) -> DataFrame:
    """Entropy in bits over equal-width bin shares."""
    h = histogram(df, cols, bins).groupBy("feature").agg(F.sum("n").cast("double").alias("n"), F.sum(xlogx(F.col("n").cast("double"))).alias("s"))
    return h.select("feature", ((F.ln("n") - F.col("s") / F.col("n")) / F.ln(F.lit(2.0))).alias("entropy"))


def entropy_nats(df: DataFrame, cols: Sequence[str] | None = None, bins: int = 20) -> DataFrame:
    """``(feature, entropy)`` with 1e-9 inside the logarithm.

    Text columns, and numbers with fewer than ``bins`` distinct values, by value
    shares; other numbers by the density of ``bins`` equal-width bins.
    """
    names = list(cols or df.columns)
    nums = [c for c in names if c in numeric_cols(df)]
    words = [c for c in names if c not in nums]
    eps = F.lit(1e-9)
    parts = []
    if nums:
        few = df.agg(*[F.approx_count_distinct(observed(df, c), 0.01).alias(c) for c in nums]).first()
        # The sketch only rules columns out; near the cutoff the exact count decides.
        close = [c for c in nums if few[c] < 2 * bins]
        exact = df.agg(*[F.count_distinct(observed(df, c)).alias(c) for c in close]).first() if close else {}
        small = [c for c in close if exact[c] < bins]
        words += small
        wide = [c for c in nums if c not in small]
        if wide:
            span = agg_long(df, wide, {"lo": F.min, "hi": F.max})
            long = melt(df, wide).join(F.broadcast(span), "feature")
            b = long.withColumn("bin", equal_width_bin(F.col("value"), F.col("lo"), F.col("hi"), bins))
            counts = b.groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
            total = counts.groupBy("feature").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("used"))
            density = F.col("n") / F.col("all") / ((F.col("hi") - F.col("lo")) / bins) + eps
            d = counts.join(F.broadcast(total), "feature").withColumn("d", F.coalesce(density, eps))
            sums = d.groupBy("feature").agg(
                (F.sum("d") + (F.lit(bins) - F.max("used")) * eps).alias("s"),
                (F.sum(F.col("d") * F.ln("d")) + (F.lit(bins) - F.max("used")) * eps * F.ln(eps)).alias("l"),
            )
            parts.append(sums.select("feature", (F.ln("s") - F.col("l") / F.col("s")).alias("entropy")))
    if words:
        levels = melt_text(df, words).filter(F.col("value").isNotNull()).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
        total = levels.groupBy("feature").agg(F.sum("n").alias("all"))
        p = F.col("n") / F.col("all")
        parts.append(levels.join(F.broadcast(total), "feature").groupBy("feature").agg((-F.sum(p * F.ln(p + eps))).alias("entropy")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
