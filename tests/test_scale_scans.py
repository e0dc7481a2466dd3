"""Scans of the power and quantile transforms: whole batches in a task, few numbers out of it."""

import math

import numpy as np

from tabwright.functions import special
from tabwright.operators import scale


def test_likelihoods_are_those_of_the_plain_formula(spark):
    x = [float(v) for v in np.random.default_rng(3).lognormal(1.0, 0.7, 500)]
    df = spark.createDataFrame([(v,) for v in [*x, None, -2.0]], "x double").repartition(5)
    got = scale._likelihoods(df, {"x": [0.0, 0.5, -1.0]}, "boxcox")["x"]
    good = np.array(x)
    for lam, ll in zip([0.0, 0.5, -1.0], got, strict=True):
        y = np.log(good) if lam == 0 else (good**lam - 1) / lam
        assert math.isclose(ll, (lam - 1) * np.log(good).sum() - 501 / 2 * math.log(y.var()), rel_tol=1e-9)
    signed = np.array([*x, -2.0])
    y = np.where(signed >= 0, np.log1p(np.abs(signed)), -((1 + np.abs(signed)) ** 2 - 1) / 2)
    jac = (np.sign(signed) * np.log1p(np.abs(signed))).sum()
    assert math.isclose(scale._likelihoods(df, {"x": [0.0]}, "yeo")["x"][0], -jac - 501 / 2 * math.log(y.var()), rel_tol=1e-9)


def test_no_candidate_makes_a_row(spark):
    """A task hands on one row for each column; before, every value became a row for every candidate."""
    df = spark.range(1000, numPartitions=3).selectExpr("cast(id + 1 as double) AS x")
    x = df.select("x").toPandas().x.to_numpy()
    jac, y = scale._profiles(x, np.linspace(-4, 4, 17), "boxcox")
    assert y.shape == (17, 1000) and math.isclose(jac, np.log(x).sum())


def test_landmarks_stand_in_no_expression(spark):
    df = spark.range(200).selectExpr("cast(id as double) AS x")
    out = scale.quantile_transform(df, ["x"], marks={"x": [i + 1 / 3 for i in range(1000)]})
    assert len(out._jdf.queryExecution().analyzed().toString()) < 5000
    near = [special.norm_ppf(min(max((v - 1 / 3) / 999, 1e-7), 1 - 1e-7)) for v in range(200)]
    assert np.allclose([r.x for r in out.orderBy("x").collect()], sorted(near), atol=1e-6)
