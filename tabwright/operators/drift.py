"""Drift between a reference and a new sample, alerts and monitoring rules."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import ordering, special
from ..functions.columns import as_numbers, hash_unit, melt, melt_text, numeric_cols, observed, text_cols
from ..session import cut_lineage
from .association import chi_square
from .profile import feature_quantiles, histogram

# Bins, floors and alert limits.
PSI_BINS = 10
EMPTY_BIN = 1e-8
KS_ALPHA, CHI2_ALPHA = 0.05, 0.05
PSI_LIMIT, WASSERSTEIN_LIMIT, CLASSIFIER_LIMIT = 0.1, 0.1, 0.7
MISSING = "__MISSING__"


def sided(ref: DataFrame, new: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(side, feature, value)`` of numeric columns, side 0 for the reference."""
    part = lambda df, s: melt(df, cols).select(F.lit(s).alias("side"), "feature", "value")
    return part(ref, 0).unionByName(part(new, 1))


def _cdf_steps(long: DataFrame, value: str, side: str, keys: Sequence[str]) -> DataFrame:
    """Both empirical distribution functions at every distinct value: ``(keys, value, f, g, n, m)``."""
    s = F.col(side)
    counts = long.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(
        F.count_if(s == 0).cast("double").alias("__a"), F.count_if(s == 1).cast("double").alias("__b")
    )
    cum = ordering.running(cut_lineage(counts), value, {"__ca": F.col("__a"), "__cb": F.col("__b")}, keys, keys)
    return cum.select(
        *keys,
        value,
        F.try_divide(F.col("__ca"), F.col("__ca__all")).alias("f"),
        F.try_divide(F.col("__cb"), F.col("__cb__all")).alias("g"),
        F.col("__ca__all").alias("n"),
        F.col("__cb__all").alias("m"),
    )


def ks_two_sample(long: DataFrame, value: str, side: str, keys: Sequence[str]) -> DataFrame:
    """``(keys, statistic, p_value, drift)`` with the asymptotic p value."""
    return _ks(_cdf_steps(long, value, side, keys), keys)


def _ks(steps: DataFrame, keys: Sequence[str]) -> DataFrame:
    out = steps.groupBy(*keys).agg(F.max(F.abs(F.col("f") - F.col("g"))).alias("statistic"), F.max("n").alias("n"), F.max("m").alias("m"))
    p = special.on_results(special.ks_two_sample_p)("statistic", "n", "m")
    return out.withColumn("p_value", p).select(*keys, "statistic", "p_value", (F.col("p_value") < KS_ALPHA).alias("drift"))


def wasserstein(long: DataFrame, value: str, side: str, keys: Sequence[str]) -> DataFrame:
    """``(keys, wasserstein)``: area between the two distribution functions.

    Inside an ordered bucket the next value is a lead; the gap between buckets is
    closed from the bucket borders, so no global sort is needed.
    """
    return _area(cut_lineage(_cdf_steps(long, value, side, keys)), value, keys)


def _area(steps: DataFrame, value: str, keys: Sequence[str]) -> DataFrame:
    cut = ordering.with_bucket(steps, value, keys)
    w = Window.partitionBy(*keys, "__bucket").orderBy(value)
    gap = F.abs(F.col("f") - F.col("g"))
    inner = cut.select(*keys, "__bucket", value, gap.alias("gap"), F.lead(value).over(w).alias("next"))
    per = inner.groupBy(*keys, "__bucket").agg(
        F.sum(F.coalesce(F.col("gap") * (F.col("next") - F.col(value)), F.lit(0.0))).alias("area"),
        F.min(value).alias("first"),
        F.max(F.struct(F.col(value).alias("v"), F.col("gap").alias("gap"))).alias("last"),
    )
    across = Window.partitionBy(*keys).orderBy("__bucket")
    per = per.withColumn("bridge", F.coalesce(F.col("last.gap") * (F.lead("first").over(across) - F.col("last.v")), F.lit(0.0)))
    return per.groupBy(*keys).agg((F.sum("area") + F.sum("bridge")).alias("wasserstein"))


def psi_bins(ref: DataFrame, cols: Sequence[str], bins: int = PSI_BINS) -> dict[str, list[float]]:
    """Quantile edges of the reference, ends included."""
    cuts = [i / bins for i in range(bins + 1)]
    return {r["feature"]: list(r["q"]) for r in feature_quantiles(ref, cols, cuts).collect()}


def _edge_bin(value: Column, edges: Sequence[float]) -> Column:
    """0-based bin, closed on the left, the last closed on both sides; NULL outside the edges."""
    at = F.lit(-1)
    for e in edges[:-1]:
        at = at + (value >= F.lit(e)).cast("int")
    # The right end belongs to the last bin that is not empty by width.
    last = max((i for i in range(len(edges) - 1) if edges[i] < edges[-1]), default=len(edges) - 2)
    at = F.when(value == F.lit(edges[-1]), F.lit(max(last, len(edges) - 2))).otherwise(at)
    return F.when((value >= F.lit(edges[0])) & (value <= F.lit(edges[-1])), at)


def bin_counts(df: DataFrame, edges: Mapping[str, Sequence[float]], keys: Sequence[str] = ()) -> DataFrame:
    """``(keys, feature, bin, n)`` in reference bins; values outside have a NULL bin."""
    cells = [F.struct(F.lit(c).alias("feature"), observed(df, c).alias("v"), _edge_bin(observed(df, c), e).alias("bin")) for c, e in edges.items()]
    rows = df.select(*keys, F.inline(F.array(*cells))).filter(F.col("v").isNotNull())
    return rows.groupBy(*keys, "feature", "bin").agg(F.count(F.lit(1)).alias("n"))


def psi_from_counts(ref: DataFrame, new: DataFrame, bins: int = PSI_BINS) -> DataFrame:
    """``(feature, psi)`` from two bin-count tables; an empty bin is 1e-8, the divisor is the full size."""
    share = lambda t, name: t.join(
        F.broadcast(t.groupBy("feature").agg(F.sum("n").alias("all"))), "feature"
    ).filter(F.col("bin").isNotNull()).select("feature", "bin", (F.col("n") / F.col("all")).alias(name))
    grid = ref.select("feature").distinct().select("feature", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    both = grid.join(share(ref, "p"), ["feature", "bin"], "left").join(share(new, "q"), ["feature", "bin"], "left").fillna(EMPTY_BIN, ["p", "q"])
    return both.groupBy("feature").agg(F.sum((F.col("p") - F.col("q")) * F.ln(F.col("p") / F.col("q"))).alias("psi"))


def psi(ref: DataFrame, new: DataFrame, cols: Sequence[str], bins: int = PSI_BINS) -> DataFrame:
    edges = psi_bins(ref, cols, bins)
    return psi_from_counts(bin_counts(ref, edges), bin_counts(new, edges), bins)


def divergences(ref: DataFrame, new: DataFrame, cols: Sequence[str], bins: int = 20) -> DataFrame:
    """``(feature, jsd, psi, kl)`` of equal-width density histograms, each over its own range, plus 1e-9."""
    # A side alone has a handful of ranges, which are broadcast; keyed by side its rows would meet them in one task for each column.
    one = lambda df, s: histogram(df, cols, bins).withColumn("side", F.lit(s))
    h = cut_lineage(one(ref, 0).unionByName(one(new, 1)))
    total = h.groupBy("side", "feature").agg(F.sum("n").alias("all"))
    dens = h.join(F.broadcast(total), ["side", "feature"]).select(
        "side", "feature", "bin", F.try_divide(F.col("n") / F.col("all"), (F.col("hi") - F.col("lo")) / bins).alias("d")
    )
    grid = total.select("feature").distinct().select("feature", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    side = lambda s, name: dens.filter(F.col("side") == s).select("feature", "bin", F.col("d").alias(name))
    eps = F.lit(1e-9)
    pq = grid.join(side(0, "p"), ["feature", "bin"], "left").join(side(1, "q"), ["feature", "bin"], "left").fillna(0.0, ["p", "q"])
    pq = pq.withColumns({"p": F.col("p") + eps, "q": F.col("q") + eps})
    p, q = F.col("p"), F.col("q")
    # The mixture terms carry the floor twice; each relative entropy normalizes its inputs.
    pe, qe = p + eps, q + eps
    me = (pe + qe) / 2
    tot = pq.withColumns({"pe": pe, "qe": qe, "me": me})
    sums = tot.groupBy("feature").agg(F.sum("p").alias("sp"), F.sum("q").alias("sq"), F.sum("pe").alias("spe"), F.sum("qe").alias("sqe"), F.sum("me").alias("sme"))
    rel = lambda a, sa, b, sb: F.sum(F.col(a) / F.col(sa) * F.ln(F.col(a) / F.col(sa) / (F.col(b) / F.col(sb))))
    return tot.join(F.broadcast(sums), "feature").groupBy("feature").agg(
        (rel("pe", "spe", "me", "sme") / 2 + rel("qe", "sqe", "me", "sme") / 2).alias("jsd"),
        F.sum((p - q) * F.ln(p / q)).alias("psi"),
        rel("p", "sp", "q", "sq").alias("kl"),
    )


def head_and_rest(df: DataFrame, order: str, tie: str | None = None, share: float = 0.1) -> tuple[DataFrame, DataFrame]:
    """The first ``share`` of the rows in ``order`` and the others."""
    numbered = ordering.row_index(df, order, tie)
    first = F.col("__rn") <= F.floor(F.col("__rn__all") * share)
    return numbered.filter(first).drop("__rn", "__rn__all"), numbered.filter(~first).drop("__rn", "__rn__all")


def chi_square_drift(ref: DataFrame, new: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(feature, statistic, p_value, drift)``: level counts of both samples as a 2 x k table."""
    part = lambda df, s: melt_text(df, cols).select(F.lit(s).alias("side"), "feature", F.coalesce("value", F.lit(MISSING)).alias("level"))
    both = part(ref, "ref").unionByName(part(new, "new"))
    counts = both.groupBy("feature", "side", "level").agg(F.count(F.lit(1)).cast("double").alias("n"))
    chi = chi_square(counts, ["feature"], "side", "level").withColumn("dof", F.col("dof").cast("double"))
    p = F.when(F.col("dof") > 0, special.on_results(lambda x, d: special.chi2_sf(x, d) if d > 0 else 1.0)("chi2", "dof")).otherwise(1.0)
    out = chi.withColumn("p_value", p)
    return out.select("feature", F.col("chi2").alias("statistic"), "p_value", (F.col("p_value") < CHI2_ALPHA).alias("drift"))


def schema_skew(ref: DataFrame, new: DataFrame) -> DataFrame:
    missing = [(c, "missing") for c in ref.columns if c not in new.columns]
    added = [(c, "added") for c in new.columns if c not in ref.columns]
    return ref.sparkSession.createDataFrame(missing + added, "feature string, change string")


def drift_report(ref: DataFrame, new: DataFrame, numeric: Sequence[str] | None = None, categorical: Sequence[str] | None = None) -> DataFrame:
    """``(feature, kind, ks, ks_p, psi, wasserstein, chi2, chi2_p, drift)``, one row per feature."""
    shared = [c for c in ref.columns if c in new.columns]
    nums = [c for c in numeric_cols(ref) if c in shared] if numeric is None else list(numeric)
    cats = [c for c in text_cols(ref) if c in shared] if categorical is None else list(categorical)
    parts = []
    null = lambda name: F.lit(None).cast("double").alias(name)
    if nums:
        steps = cut_lineage(_cdf_steps(sided(ref, new, nums), "value", "side", ["feature"]))
        out = _ks(steps, ["feature"]).join(psi(ref, new, nums), "feature").join(_area(steps, "value", ["feature"]), "feature")
        hit = F.col("drift") | (F.col("psi") >= PSI_LIMIT) | (F.col("wasserstein") >= WASSERSTEIN_LIMIT)
        parts.append(
            out.select("feature", F.lit("numeric").alias("kind"), F.col("statistic").alias("ks"), F.col("p_value").alias("ks_p"), "psi", "wasserstein", null("chi2"), null("chi2_p"), hit.alias("drift"))
        )
    if cats:
        chi = chi_square_drift(ref, new, cats)
        parts.append(
            chi.select("feature", F.lit("categorical").alias("kind"), null("ks"), null("ks_p"), null("psi"), null("wasserstein"), F.col("statistic").alias("chi2"), F.col("p_value").alias("chi2_p"), "drift")
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def alerts(report: DataFrame, skew: DataFrame | None = None) -> DataFrame:
    """``(alert)`` names of every drifted feature, and of a schema change."""
    out = report.filter("drift").select(F.concat(F.lit("data_drift_"), "kind", F.lit("_"), "feature").alias("alert"))
    if skew is not None:
        out = out.unionByName(skew.limit(1).select(F.lit("train_serve_skew").alias("alert")))
    return out


def drift_share(report: DataFrame) -> DataFrame:
    """Share of drifted columns."""
    return report.agg(F.avg(F.col("drift").cast("double")).alias("drift_share"))


def target_drift(ref: DataFrame, new: DataFrame, target: str) -> DataFrame:
    """Two-sample test for a numeric target, chi-square for a class."""
    if isinstance(ref.schema[target].dataType, T.NumericType):
        return ks_two_sample(sided(ref, new, [target]), "value", "side", ["feature"])
    return chi_square_drift(ref, new, [target])


def prediction_drift(ref: DataFrame, new: DataFrame, score: str) -> DataFrame:
    """``(feature, ks, ks_p, psi, wasserstein, drift)`` of one score column."""
    return drift_report(ref, new, [score], []).drop("kind", "chi2", "chi2_p")


def performance_drift(ref: DataFrame, new: DataFrame, label: str, prediction: str) -> DataFrame:
    """Accuracy on both samples and whether it fell."""
    acc = lambda df: df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double"))).scalar()
    one = ref.sparkSession.range(1).select(acc(ref).alias("reference_score"), acc(new).alias("new_score"))
    return one.withColumn("drift", F.col("new_score") < F.col("reference_score"))


def classifier_drift(ref: DataFrame, new: DataFrame, cols: Sequence[str], key: str, trees: int = 20, seed: int = 42, limit: float = CLASSIFIER_LIMIT) -> DataFrame:
    """A forest that tells reference rows from new rows: ``(auc, drift)`` on a held-out 30% of each side."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    from pyspark.ml.feature import VectorAssembler

    part = lambda df, s: as_numbers(df, cols, [key]).withColumn("label", F.lit(float(s)))
    both = part(ref, 0).unionByName(part(new, 1)).fillna(0.0, list(cols))
    held = hash_unit(key, "label", seed=seed) >= 0.7
    ready = VectorAssembler(inputCols=list(cols), outputCol="features").transform(both)
    model = RandomForestClassifier(numTrees=trees, maxDepth=5, seed=seed).fit(ready.filter(~held))
    auc = float(BinaryClassificationEvaluator().evaluate(model.transform(ready.filter(held))))
    return ref.sparkSession.createDataFrame([(auc, auc > limit)], "auc double, drift boolean")


def retrain_decision(alert_rows: DataFrame, target_score: float | None = None, limit: float = 0.3) -> DataFrame:
    """``(n_alerts, target_score, retrain)``: any alert, or a target score above ``limit``."""
    score = F.lit(target_score).cast("double")
    return alert_rows.agg(F.count(F.lit(1)).alias("n_alerts")).select(
        "n_alerts", score.alias("target_score"), ((F.col("n_alerts") > 0) | F.coalesce(score > limit, F.lit(False))).alias("retrain")
    )


def append_history(report: DataFrame, path: str, run_id: str) -> None:
    """One more run in the drift history."""
    report.withColumn("run_id", F.lit(run_id)).withColumn("run_at", F.current_timestamp()).write.mode("append").parquet(path)


def history_trend(history: DataFrame) -> DataFrame:
    """Change of each feature's PSI against its previous run (one row per run and feature)."""
    w = Window.partitionBy("feature").orderBy("run_id")
    return history.select("run_id", "feature", "psi", (F.col("psi") - F.lag("psi").over(w)).alias("psi_change"), "drift")


def rolling_performance(df: DataFrame, ts: str, label: str, prediction: str, score: str, days: int = 7) -> DataFrame:
    """Per day: accuracy, its mean over the last ``days`` days, score mean, deviation and quartiles.

    Rows are aggregated per day first, so the window runs over the calendar only.
    """
    day = F.to_date(ts)
    base = df.select(day.alias("day"), (F.col(label) == F.col(prediction)).cast("double").alias("ok"), F.col(score).alias("s"))
    per = base.groupBy("day").agg(F.avg("ok").alias("accuracy"), F.avg("s").alias("score_mean"), F.stddev_samp("s").alias("score_std"))
    q = ordering.quantiles(base, "s", [0.25, 0.5, 0.75], ["day"])
    w = Window.orderBy(F.unix_date("day")).rangeBetween(-(days - 1), 0)
    return per.withColumn("rolling_accuracy", F.avg("accuracy").over(w)).join(q.withColumnRenamed("q", "score_quartiles"), "day")


def probabilistic_alerts(
    fits: DataFrame | None = None,
    entropy: DataFrame | None = None,
    mi: DataFrame | None = None,
    intervals: DataFrame | None = None,
    importance: DataFrame | None = None,
) -> DataFrame:
    """``(alert)``: poor fit (KS > 0.2), entropy < 0.5, MI < 0.01, interval width < 0.1, importance < 0.005."""
    parts = []
    add = lambda df, cond, label: parts.append(df.filter(cond).select(F.concat(F.lit(label), "feature").alias("alert")))
    if fits is not None:
        add(fits, F.col("ks") > 0.2, "KS drift: ")
    if entropy is not None:
        add(entropy, F.col("entropy") < 0.5, "Entropy collapse: ")
    if mi is not None:
        add(mi, F.col("mi") < 0.01, "Low MI: ")
    if intervals is not None:
        add(intervals, F.col("upper") - F.col("lower") < 0.1, "Predictive collapse: ")
    if importance is not None:
        add(importance, F.col("importance") < 0.005, "Low feature importance: ")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def page_hinkley(df: DataFrame, value: str, order: str, tie: str | None = None, delta: float = 0.005, threshold: float = 50.0) -> DataFrame:
    """Rows with the Page-Hinkley statistic in closed running form: ``(..., ph, drift)``.

    The running mean, the running sum of deviations and its running minimum are
    prefix operations, each taken over ordered buckets. Lineage is cut between
    them, as every prefix pass reads its input several times.
    """
    sums = cut_lineage(ordering.running(df, order, {"__s": F.col(value), "__c": F.lit(1)}, tie=tie).drop("__s__all", "__c__all"))
    dev = sums.withColumn("__d", F.col(value) - F.col("__s") / F.col("__c") - delta)
    total = cut_lineage(ordering.running(dev.drop("__s"), order, {"__m": F.col("__d")}, tie=tie).drop("__m__all", "__d"))
    low = running_min(total, "__m", order, tie)
    out = low.withColumn("ph", F.col("__m") - F.least(F.lit(0.0), F.col("__low")))
    return out.withColumn("drift", F.col("ph") > threshold).drop("__m", "__low", "__c")


def running_min(df: DataFrame, value: str, order: str, tie: str | None = None, out: str = "__low") -> DataFrame:
    cut = ordering.with_bucket(df, order, tie=tie)
    cols = [F.col(order)] + ([F.col(tie)] if tie else [])
    local = Window.partitionBy("__bucket").orderBy(*cols).rowsBetween(Window.unboundedPreceding, 0)
    lows = cut.groupBy("__bucket").agg(F.min(value).alias("__b"))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    lows = lows.select("__bucket", F.min("__b").over(before).alias("__prev"))
    joined = cut.withColumn("__here", F.min(value).over(local)).join(F.broadcast(lows), "__bucket")
    return joined.withColumn(out, F.least("__here", "__prev")).drop("__here", "__prev", "__bucket")


def ddm(df: DataFrame, error: str, order: str, tie: str | None = None, warn: float = 2.0, drift: float = 3.0, min_rows: int = 30) -> DataFrame:
    """Drift detection on a 0/1 error: rows with ``p``, ``s`` and level ``stable | warning | drift``.

    The running error rate is a prefix sum; the best (p + s) so far is a running
    minimum that carries its own p and s along in a struct.
    """
    sums = cut_lineage(ordering.running(df, order, {"__e": F.col(error), "__n": F.lit(1)}, tie=tie).drop("__e__all", "__n__all"))
    p = F.col("__e") / F.col("__n")
    rows = sums.withColumn("p", p).withColumn("s", F.sqrt(F.col("p") * (1 - F.col("p")) / F.col("__n")))
    best = F.when(F.col("__n") >= min_rows, F.struct((F.col("p") + F.col("s")).alias("ps"), F.col("p").alias("bp"), F.col("s").alias("bs")))
    low = running_min(rows.withColumn("__best", best), "__best", order, tie)
    now = F.col("p") + F.col("s")
    level = (
        F.when(F.col("__n") < min_rows, "stable")
        .when(now > F.col("__low.bp") + drift * F.col("__low.bs"), "drift")
        .when(now > F.col("__low.bp") + warn * F.col("__low.bs"), "warning")
        .otherwise("stable")
    )
    return low.withColumn("level", level).drop("__e", "__n", "__best", "__low")


def mmd(ref: DataFrame, new: DataFrame, cols: Sequence[str], features: int = 128, gamma: float | None = None, seed: int = 42) -> DataFrame:
    """Squared kernel mean difference by random Fourier features of standardized columns.

    Two vectors of ``features`` means are aggregated, however many rows there are.
    """
    names = list(cols)
    gamma = 1.0 / len(names) if gamma is None else gamma
    rng = np.random.default_rng(seed)
    w = rng.normal(0.0, math.sqrt(2 * gamma), (features, len(names)))
    b = rng.uniform(0, 2 * math.pi, features)
    data = as_numbers(ref, names).withColumn("side", F.lit(0)).unionByName(as_numbers(new, names).withColumn("side", F.lit(1))).dropna()
    stats = data.filter("side = 0").agg(*[F.avg(f"`{c}`") for c in names], *[F.stddev_pop(f"`{c}`") for c in names]).first()
    k = len(names)
    z = data.select("side", *[((F.col(f"`{c}`") - stats[i]) / (stats[k + i] or 1.0)).alias(f"z{i}") for i, c in enumerate(names)])
    aggs = []
    for f in range(features):
        dot = F.lit(float(b[f]))
        for i in range(k):
            dot = dot + float(w[f, i]) * F.col(f"z{i}")
        aggs.append(F.avg(F.cos(dot)).alias(f"f{f}"))
    means = z.groupBy("side").agg(*aggs)
    long = means.unpivot(["side"], [f"f{f}" for f in range(features)], "f", "m")
    diff = long.groupBy("f").agg(F.sum(F.when(F.col("side") == 0, F.col("m")).otherwise(-F.col("m"))).alias("d"))
    return diff.agg((2.0 / features * F.sum(F.col("d") * F.col("d"))).alias("mmd2"))
