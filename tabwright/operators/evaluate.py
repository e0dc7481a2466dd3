"""Metrics, curves, gates and comparisons of predictions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ordering
from ..functions.columns import null_safe_join
from ..session import cut_lineage


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``(label, prediction, n)``."""
    return df.groupBy(F.col(label).cast("string").alias("label"), F.col(prediction).cast("string").alias("prediction")).agg(F.count(F.lit(1)).cast("double").alias("n"))


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``(label, tp, support, predicted, precision, recall, f1)``; a zero division is 0."""
    c = confusion(df, label, prediction)
    true = c.groupBy("label").agg(F.sum("n").alias("support"), F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0.0)).alias("tp"))
    pred = c.groupBy(F.col("prediction").alias("label")).agg(F.sum("n").alias("predicted"))
    both = true.join(pred, "label", "full").fillna(0.0, ["support", "tp", "predicted"])
    zero = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    out = both.withColumn("precision", zero(F.col("tp"), F.col("predicted"))).withColumn("recall", zero(F.col("tp"), F.col("support")))
    return out.withColumn("f1", zero(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")))


def classification_metrics(df: DataFrame, label: str, prediction: str, positive: str | None = None) -> DataFrame:
    """One row: accuracy, macro and weighted precision, recall and F1, and F1 of ``positive`` if named."""
    r = class_report(df, label, prediction)
    n = F.sum("support")
    w = lambda c: F.sum(F.col(c) * F.col("support")) / n
    aggs = [
        (F.sum("tp") / n).alias("accuracy"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
        F.avg("f1").alias("f1_macro"),
        w("precision").alias("precision_weighted"),
        w("recall").alias("recall_weighted"),
        w("f1").alias("f1_weighted"),
    ]
    if positive is not None:
        aggs.append(F.coalesce(F.max(F.when(F.col("label") == positive, F.col("f1"))), F.lit(0.0)).alias("f1_binary"))
    return r.agg(*aggs)


def log_loss(df: DataFrame, label: str, probability: str, eps: float = 1e-15) -> DataFrame:
    p = F.least(F.greatest(F.col(probability), F.lit(eps)), F.lit(1 - eps))
    return df.agg(F.avg(-F.when(F.col(label) == 1, F.ln(p)).otherwise(F.ln(1 - p))).alias("log_loss"))


def regression_metrics(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """One row: mae, mse, rmse, r2, mape, in one aggregate."""
    y = F.col(label).cast("double")
    e = y - F.col(prediction)
    # R2 about the label mean without a second pass: total variance times n.
    one = df.agg(
        F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"), F.var_pop(F.when(e.isNotNull(), y)).alias("v"), F.avg(F.try_divide(F.abs(e), F.abs(y))).alias("mape")
    )
    return one.select("mae", "mse", F.sqrt("mse").alias("rmse"), (1 - F.try_divide(F.col("mse"), F.col("v"))).alias("r2"), "mape")


def improvement(df: DataFrame, label: str, model: str, baseline: str, task: str = "regression") -> DataFrame:
    """``(metric, model, baseline, delta)`` of two prediction columns."""
    fn = regression_metrics if task == "regression" else classification_metrics
    long = lambda p, name: (lambda m: m.unpivot([], m.columns, "metric", name))(fn(df, label, p))
    return long(model, "model").join(long(baseline, "baseline"), "metric").withColumn("delta", F.col("model") - F.col("baseline"))


def binary_rates(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """tp, fp, tn, fn, sensitivity and specificity of 0/1 columns."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    one = df.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"), F.count_if(~y & ~p).alias("tn"), F.count_if(y & ~p).alias("fn"))
    return one.select(
        "*",
        F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")).alias("sensitivity"),
        F.try_divide(F.col("tn"), F.col("tn") + F.col("fp")).alias("specificity"),
    )


def roc_points(df: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """``(keys, threshold, tp, fp, tpr, fpr, precision)`` at every distinct score, from running counts."""
    y = F.col(label)
    counts = df.filter(F.col(score).isNotNull() & y.isNotNull()).groupBy(*keys, (-F.col(score)).alias("__neg")).agg(
        F.sum((y == 1).cast("double")).alias("__p"), F.sum((y != 1).cast("double")).alias("__q")
    )
    cum = ordering.running(cut_lineage(counts), "__neg", {"tp": F.col("__p"), "fp": F.col("__q")}, keys, keys)
    return cum.select(
        *keys,
        (-F.col("__neg")).alias("threshold"),
        "tp",
        "fp",
        F.try_divide(F.col("tp"), F.col("tp__all")).alias("tpr"),
        F.try_divide(F.col("fp"), F.col("fp__all")).alias("fpr"),
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
    )


def auc(df: DataFrame, label: str, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """``(keys, auc)`` by average ranks: ties count one half; NULL with a single class."""
    y = F.col(label)
    counts = df.filter(F.col(score).isNotNull() & y.isNotNull()).groupBy(*keys, F.col(score).alias("__s")).agg(
        F.sum((y == 1).cast("double")).alias("__p"), F.count(F.lit(1)).cast("double").alias("__n")
    )
    cum = ordering.running(cut_lineage(counts), "__s", {"__c": F.col("__n")}, keys, keys)
    rank = F.col("__c") - (F.col("__n") - 1) / 2
    out = cum.groupBy(*keys).agg(F.sum(F.col("__p") * rank).alias("r"), F.sum("__p").alias("p"), F.sum("__n").alias("n"))
    return out.select(*keys, F.try_divide(F.col("r") - F.col("p") * (F.col("p") + 1) / 2, F.col("p") * (F.col("n") - F.col("p"))).alias("auc"))


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    """Area under the precision-recall steps: each distinct score adds its recall gain times precision."""
    y = F.col(label)
    counts = df.filter(F.col(score).isNotNull()).groupBy((-F.col(score)).alias("__neg")).agg(F.sum((y == 1).cast("double")).alias("__p"), F.count(F.lit(1)).cast("double").alias("__n"))
    cum = ordering.running(cut_lineage(counts), "__neg", {"tp": F.col("__p"), "all": F.col("__n")})
    return cum.agg((F.sum(F.col("__p") * F.col("tp") / F.col("all")) / F.max("tp__all")).alias("average_precision"))


def apply_threshold(df: DataFrame, probability: str, threshold: float = 0.5, out: str = "prediction") -> DataFrame:
    return df.withColumn(out, (F.col(probability) > threshold).cast("int"))


def threshold_sweep(df: DataFrame, label: str, probability: str, thresholds: Sequence[float] = (0.5, 0.6)) -> DataFrame:
    """``(threshold, tp, fp, tn, fn, accuracy)`` of all cuts in one pass."""
    y, p = F.col(label) == 1, F.col(probability)
    aggs = []
    for i, t in enumerate(thresholds):
        hit = p > t
        aggs += [F.count_if(y & hit).alias(f"tp{i}"), F.count_if(~y & hit).alias(f"fp{i}"), F.count_if(~y & ~hit).alias(f"tn{i}"), F.count_if(y & ~hit).alias(f"fn{i}")]
    rows = [F.struct(F.lit(float(t)).alias("threshold"), *[F.col(f"{n}{i}").alias(n) for n in ("tp", "fp", "tn", "fn")]) for i, t in enumerate(thresholds)]
    out = df.agg(*aggs).select(F.inline(F.array(*rows)))
    return out.withColumn("accuracy", (F.col("tp") + F.col("tn")) / (F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")))


def calibration(df: DataFrame, label: str, probability: str, bins: int = 10) -> DataFrame:
    """``(bin, n, mean_predicted, observed_rate)`` of equal-width probability bins."""
    b = F.least(F.floor(F.col(probability) * bins), F.lit(bins - 1)).cast("int")
    return df.groupBy(b.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(probability).alias("mean_predicted"), F.avg((F.col(label) == 1).cast("double")).alias("observed_rate")
    )


def brier(df: DataFrame, label: str, probability: str) -> DataFrame:
    return df.agg(F.avg(F.pow(F.col(probability) - (F.col(label) == 1).cast("double"), 2)).alias("brier"))


def group_rates(df: DataFrame, group: str, label: str, prediction: str) -> DataFrame:
    """Selection, true-positive and false-positive rate per group."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    share = lambda cond, base: F.try_divide(F.count_if(cond), F.count_if(base))
    return df.groupBy(group).agg(F.count(F.lit(1)).alias("n"), share(p, F.lit(True)).alias("selection_rate"), share(y & p, y).alias("tpr"), share(~y & p, ~y).alias("fpr"))


def promotion_gate(metrics: Mapping[str, float], checks: Mapping[str, bool], spark, reference: Mapping[str, float] | None = None, train_limit: float = 0.9, test_limit: float = 0.9, max_train_drop: float = 0.1, max_test_drop: float = 0.05, ignore_checks: bool = False, warnings_as_errors: bool = False, n_warnings: int = 0) -> DataFrame:
    """One row ``(promote, reasons)`` from train and test accuracy, failed checks and the drop against a reference model."""
    why = []
    if metrics["train"] < train_limit:
        why.append("train accuracy below limit")
    if metrics["test"] < test_limit:
        why.append("test accuracy below limit")
    if not ignore_checks:
        why += [f"check failed: {n}" for n, ok in sorted(checks.items()) if not ok]
    if reference is not None:
        if reference["train"] - metrics["train"] > max_train_drop:
            why.append("train accuracy dropped")
        if reference["test"] - metrics["test"] > max_test_drop:
            why.append("test accuracy dropped")
    if warnings_as_errors and n_warnings:
        why.append("warnings")
    return spark.createDataFrame([(not why, why)], "promote boolean, reasons array<string>")


def frame_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """``(side, n)`` of rows found on one side only (with their multiplicity); no rows means equal."""
    left = a.exceptAll(b.select(*a.columns)).agg(F.count(F.lit(1)).alias("n")).select(F.lit("left_only").alias("side"), "n")
    right = b.select(*a.columns).exceptAll(a).agg(F.count(F.lit(1)).alias("n")).select(F.lit("right_only").alias("side"), "n")
    return left.unionByName(right).filter(F.col("n") > 0)


def residuals(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.withColumn("residual", F.col(label) - F.col(prediction))


def align_schema(df: DataFrame, expected: Sequence[str], fill: Mapping[str, float] | float = 0.0) -> DataFrame:
    """Expected numeric columns in order; absent ones, and nulls, take the stored mean or a constant."""
    value = lambda c: fill.get(c, 0.0) if isinstance(fill, Mapping) else fill
    return df.select(*[F.coalesce(F.col(f"`{c}`").cast("double") if c in df.columns else F.lit(None).cast("double"), F.lit(float(value(c)))).alias(c) for c in expected])


def hard_vote(df: DataFrame, predictions: Sequence[str], out: str = "vote") -> DataFrame:
    """Most frequent prediction; the smallest among ties."""
    votes = F.array(*[F.col(c) for c in predictions])
    best = F.array_max(F.transform(votes, lambda v: F.struct(F.size(F.filter(votes, lambda x: x == v)).alias("n"), (-v.cast("double")).alias("v"))))
    return df.withColumn(out, -best["v"])


def soft_vote(df: DataFrame, probabilities: Sequence[str], weights: Sequence[float] | None = None, out: str = "probability_vote") -> DataFrame:
    """Weighted mean of class probability arrays."""
    w = list(weights or [1.0] * len(probabilities))
    size = F.size(probabilities[0])
    total = F.transform(F.sequence(F.lit(0), size - 1), lambda i: sum((F.get(F.col(p), i) * x for p, x in zip(probabilities, w)), F.lit(0.0)) / sum(w))
    return df.withColumn(out, total).withColumn("vote", F.array_position(out, F.array_max(out)) - 1)


def trial_summary(trials: DataFrame, family: str = "family", score: str = "score", top: int = 5) -> tuple[DataFrame, DataFrame]:
    """Mean score per model family, and the ``top`` trials."""
    return trials.groupBy(family).agg(F.avg(score).alias("mean_score"), F.count(F.lit(1)).alias("n")), trials.orderBy(F.desc(score)).limit(top)
