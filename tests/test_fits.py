"""Families fitted together, and the minimum-determinant covariance from many starts, against plain numpy."""

import math

import numpy as np
import pandas as pd
import pytest

from tabwright.operators import distributions, outliers


def loglik(family, p, x):
    if family == "weibull_min":
        return (math.log(p[0]) - p[0] * math.log(p[1]) + (p[0] - 1) * np.log(x) - (x / p[1]) ** p[0]).sum()
    nu, mu, s = (1.0, *p) if family == "cauchy" else p
    const = math.lgamma((nu + 1) / 2) - math.lgamma(nu / 2) - 0.5 * math.log(nu * math.pi * s * s)
    return (const - (nu + 1) / 2 * np.log1p((x - mu) ** 2 / (nu * s * s))).sum()


@pytest.fixture(scope="module")
def columns(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame(
        {
            "w": 2.0 * rng.weibull(0.7, 4000), "t": rng.standard_t(2, 4000) * 3 - 40, "skew": rng.lognormal(1, 1.5, 4000), "tri": rng.triangular(0, 0.3, 1, 4000),
            "big": 1e9 + rng.normal(0, 1e3, 4000), "tied": np.where(rng.uniform(size=4000) < 0.3, 7.0, rng.normal(5, 2, 4000)), "narrow": rng.weibull(60.0, 4000) * 5,
        }
    )
    return pdf, spark.createDataFrame(pdf).repartition(4)


def test_iterated_families_reach_their_maximum_in_four_scans(columns, monkeypatch):
    pdf, df = columns
    scans = []
    for name in ("_base_sums", "_round_sums"):
        whole = getattr(distributions, name)
        monkeypatch.setattr(distributions, name, lambda *a, f=whole: scans.append(1) or f(*a))
    found = distributions.fit_families(df, list(pdf.columns)).collect()
    assert len(scans) <= 4
    seen = set()
    for r in found:
        if r["family"] in ("weibull_min", "t", "cauchy"):
            x, p = pdf[r["feature"]].to_numpy(), list(r["parameters"])
            at = loglik(r["family"], p, x)
            assert r["loglik"] == pytest.approx(at, rel=1e-8, abs=1e-4)
            for i in range(r["family"] == "t", len(p)):
                for step in (-1e-3, 1e-3):
                    other = list(p)
                    other[i] += step * (p[-1] if r["family"] != "weibull_min" else p[i])
                    assert loglik(r["family"], other, x) < at + 1e-7
            seen.add((r["feature"], r["family"]))
    assert len(seen) >= 2 * len(pdf.columns)
    best = {}
    for r in found:
        if r["feature"] not in best or r["aic"] < best[r["feature"]][1]:
            best[r["feature"]] = (r["family"], r["aic"])
    assert [best[c][0] for c in ("w", "t", "skew", "narrow")] == ["weibull_min", "t", "lognorm", "weibull_min"]


def test_columns_without_a_fit(spark):
    df = spark.createDataFrame([(1.0, None, float("nan"))] * 60 + [(1.0, 2.0, 3.0)], "same double, rare double, nan double")
    assert distributions.fit_families(df, ["same", "rare", "nan"]).count() == 0
    assert distributions.fit_families(df.limit(0), ["same"]).count() == 0
    assert [r["family"] for r in distributions.best_fit(df, ["same", "rare"]).collect()] == [None, None]


def steps_from(x, loc, cov, steps):
    h = (len(x) + x.shape[1] + 1) // 2
    for _ in range(steps):
        z = x - loc
        near = x[np.argsort(((z @ np.linalg.inv(cov)) * z).sum(axis=1), kind="stable")[:h]]
        loc, cov = near.mean(axis=0), np.cov(near, rowvar=False, bias=True)
    return loc, cov, np.linalg.slogdet(cov)[1]


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(5)
    good = rng.normal(size=(800, 3)) @ np.array([[2.0, 1.5, 0.0], [0.0, 0.4, 0.0], [0.0, 0.3, 5.0]])
    bad = rng.normal([4.0, -4.0, 9.0], 0.05, (200, 3))
    x = np.vstack([good, bad])
    return x, spark.createDataFrame(pd.DataFrame({"id": range(1000), "a": x[:, 0], "b": x[:, 1], "c": x[:, 2]})).repartition(5)


def test_concentration_steps_by_brute_force(spark, planted):
    x, df = planted
    rows = df.selectExpr("array(a, b, c) AS x")
    rng = np.random.default_rng(1)
    starts = [(g.mean(axis=0), np.cov(g, rowvar=False, bias=True) + np.eye(3) * 0.1) for g in (x[rng.choice(1000, 6)] for _ in range(4))]
    share = ((1000 + 3 + 1) // 2 - 1) / 999
    found = starts
    for _ in range(3):
        found = outliers._concentrate(rows, [e[:2] for e in found], share)
    for start, (loc, cov, size) in zip(starts, found, strict=True):
        want = steps_from(x, *start, 3)
        np.testing.assert_allclose(loc, want[0], atol=1e-8)
        np.testing.assert_allclose(cov, want[1], atol=1e-8)
        assert size == pytest.approx(want[2], abs=1e-8)


def test_a_planted_cluster_of_a_fifth_is_found(planted):
    x, df = planted
    found = {r["id"]: r["is_outlier"] for r in outliers.robust_mahalanobis(df, ["a", "b", "c"]).collect()}
    assert all(found[i] for i in range(800, 1000))
    assert sum(found[i] for i in range(800)) < 60
    loc, cov = outliers.minimum_determinant(df, ["a", "b", "c"])
    again = outliers.minimum_determinant(df.repartition(3, "id"), ["a", "b", "c"])
    np.testing.assert_allclose(cov, again[1], rtol=1e-8)
    rng = np.random.default_rng(2)
    tries = [steps_from(x, g.mean(axis=0), np.cov(g, rowvar=False, bias=True) + np.eye(3) * 1e-9, 30)[2] for g in (x[rng.choice(1000, 4, replace=False)] for _ in range(100))]
    assert np.linalg.slogdet(cov)[1] <= min(tries) + 1e-2  # the least of a hundred starts run to their end


def test_few_or_repeated_rows(spark):
    df = spark.createDataFrame([(1.0, 2.0)] * 40 + [(float(i), float(i * i)) for i in range(30)], "a double, b double")
    rows = outliers.robust_mahalanobis(df, ["a", "b"]).collect()
    assert len(rows) == 70
