"""Fits that read their rows often: rows dealt out evenly, nothing fitted or counted twice, no work repeated through lineage."""

import numpy as np
import pytest

from tabwright.functions.columns import evenly
from tabwright.operators import distributions, drift, models, outliers, reduce, select
from tabwright.plans import training_prep


def sample(spark, n=240):
    return spark.range(n).selectExpr("id", "cast(id % 17 as double) AS a", "cast((id * 7) % 31 as double) AS b", "cast(id % 5 as double) AS c", "int(id % 17 + (id * 7) % 31 > 22) AS y")


def test_a_large_partition_is_dealt_out(spark):
    one = spark.range(1000, numPartitions=1)
    sizes = [r["count"] for r in evenly(one, 100).groupBy("id").count().limit(0).collect()] + evenly(one, 100).rdd.glom().map(len).collect()
    assert sum(sizes) == 1000 and max(sizes) <= 100
    assert evenly(one, 1000) is one and evenly(one.limit(0), 1) is not None


def test_vectors_of_one_large_partition(spark):
    df = spark.range(300_000, numPartitions=1).selectExpr("id", "cast(id as double) AS a", "cast(id % 7 as double) AS t")
    out = models.vectors(df, ["a"], "t", task="regression", keep=["id"])
    assert out.rdd.getNumPartitions() > 1 and out.count() == 300_000


def test_residual_blend_fits_on_rows_dealt_out(spark, monkeypatch):
    """The forest keeps its rows by partition, so no partition of them may grow with the file."""
    sizes, made = [], models.estimator
    monkeypatch.setattr(models, "evenly", lambda df: evenly(df, 100))

    class Fitted:
        def __init__(self, model):
            self.model = model

        def fit(self, df):
            sizes.append(df.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect())
            return self.model.fit(df)

    monkeypatch.setattr(models, "estimator", lambda *a: Fitted(made(*a)))
    out = models.residual_blend(sample(spark, 1000).coalesce(1), ["a", "b"], "c", "id", (0, 5)).collect()
    assert len(out) == 1000 and all(0 <= r.prediction <= 5 for r in out)
    assert len(sizes) == 1 and sum(sizes[0]) == 1000 and max(sizes[0]) <= 100


def test_elbow_and_covariance_deal_their_rows_out(spark, monkeypatch):
    seen = []
    for module in (reduce, outliers):
        monkeypatch.setattr(module, "evenly", lambda df: seen.append(1) or df)
    costs = {r.k: r.cost for r in reduce.kmeans_elbow(sample(spark), ["a", "b"], (2, 3)).collect()}
    outliers.robust_mahalanobis(sample(spark), ["a", "b"], starts=1, max_steps=1)
    assert len(seen) == 3 and costs[3] < costs[2]


def test_sequential_selection_fits_each_fold_of_each_set_once(spark, monkeypatch):
    fits, made = [], models.estimator
    monkeypatch.setattr(models, "estimator", lambda *a: fits.append(1) or made(*a))
    known = {}
    kept = [select.sequential_selection(sample(spark), ["a", "b", "c"], "y", 2, forward=way, known=known) for way in (True, False)]
    assert kept == [["a", "b"]] * 2
    assert len(fits) == 3 * len(known) and len(known) == 6


def test_permutation_importance_is_the_same_at_any_parallelism(spark):
    runs = [{r.feature: r.importance for r in models.permutation_importance(sample(spark), ["a", "b", "c"], "y", "id", repeats=2, parallelism=p).collect()} for p in (1, 3)]
    assert runs[0] == runs[1] and runs[0]["c"] < runs[0]["a"]


def test_prepared_parts_hang_on_no_lineage(spark):
    parts, _ = training_prep.prepare(sample(spark), "id", "y")
    plan = parts["train"]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_divergences_join_no_rows_by_side(spark, monkeypatch):
    plain = drift.histogram
    monkeypatch.setattr(drift, "histogram", lambda df, cols, bins, keys=(): plain(df, cols, bins, keys) if not keys else 1 / 0)
    df = sample(spark)
    got = {r.feature: r for r in drift.divergences(df.filter("id < 120"), df.filter("id >= 120"), ["a", "b"], 4).collect()}
    p, q = (np.histogram([r.a for r in half.collect()], 4, density=True)[0] + 1e-9 for half in (df.filter("id < 120"), df.filter("id >= 120")))
    assert abs(got["a"].psi - ((p - q) * np.log(p / q)).sum()) < 1e-9


def test_report_counts_its_distributions_once(spark, monkeypatch):
    calls, plain = [], drift._cdf_steps
    monkeypatch.setattr(drift, "_cdf_steps", lambda *a: calls.append(1) or plain(*a))
    df = sample(spark)
    report = {r.feature: r for r in drift.drift_report(df.filter("id < 120"), df.selectExpr("id", "a + 1 AS a", "b", "c", "y"), ["a", "b"], []).collect()}
    assert len(calls) == 1 and report["a"].wasserstein > report["b"].wasserstein


def test_round_sums_leave_a_row_a_column(spark):
    x = np.random.default_rng(5).gamma(2.0, 3.0, 400)
    df = spark.createDataFrame([(float(v),) for v in x] + [(None,)], "x double").repartition(7)
    base = {"x": {"lo": float(x.min()), "hi": float(x.max())}}
    got = distributions._round_sums(df, base, {"x": [distributions._Student(3.0, 5.0, 4.0)]}, {"x": distributions._Weibull(1.5)}, ["x"])["x"]
    u, y = (x - 5) ** 2 / 12, x / x.max()
    assert np.isclose(got["t0_0"], np.log1p(u).sum()) and np.isclose(got["t0_5"], ((x - 5) / (1 + u) ** 2).sum())
    assert np.isclose(got["w1"], (y**1.5 * np.log(y)).mean()) and len([k for k in got if k.startswith("m")]) == distributions.MODES - 1


def test_distance_quantiles_are_exact_and_no_row_is_repeated_a_start(spark, monkeypatch):
    """The cuts of all starts come from counts by leading bits, in four passes of bounded results; rows are not exploded by start."""
    rng = np.random.default_rng(31)
    x = np.concatenate([rng.normal(size=(3000, 2)), np.round(rng.normal(size=(500, 2))), rng.normal(size=(7, 2)) * 1e200])
    rows = spark.createDataFrame([(r.tolist(),) for r in x], "x array<double>")
    of = lambda m: [m[:, 0], m[:, 1] ** 2, np.abs(m).sum(axis=1)]
    for share in (0.5, 0.3133):
        np.testing.assert_allclose(outliers._cuts(rows, 2, of, share), [np.quantile(d, share) for d in of(x)], rtol=1e-13)
    monkeypatch.setattr(outliers.ordering, "quantiles", lambda *a, **k: pytest.fail("quantiles of repeated rows"))
    mean, cov, size = outliers._concentrate(rows, [(np.zeros(2), np.eye(2))], 0.5)[0]
    near = x[(x**2).sum(axis=1) <= np.quantile((x**2).sum(axis=1), 0.5)]
    np.testing.assert_allclose(mean, near.mean(axis=0), atol=1e-12)
    np.testing.assert_allclose(cov, np.cov(near, rowvar=False, bias=True), atol=1e-12)
