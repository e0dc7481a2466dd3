"""Blocked products against numpy, and a wide table of the size of the largest recorded report."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabwright.functions import gram
from tabwright.operators import hypothesis, impute, profile


@pytest.fixture(scope="module")
def gaps(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(1e6, 3.0, (400, 30)) @ np.diag(np.linspace(1, 2, 30))
    x[:, 1] = x[:, 0] * 0.5 + rng.normal(size=400)
    x[:, 29] = 4.0  # constant
    x[rng.uniform(size=x.shape) < 0.1] = np.nan
    pdf = pd.DataFrame(x, columns=[f"c{i}" for i in range(30)])
    return pdf, spark.createDataFrame(pdf).repartition(5)


@pytest.mark.parametrize("block", [7, 256])
def test_pairs_with_missing_cells(gaps, monkeypatch, block):
    pdf, df = gaps
    monkeypatch.setattr(gram, "BLOCK", block)
    both = gram.Pairwise(df, list(pdf.columns))
    want = pdf.corr()
    want[pdf.std() == 0], want.loc[:, pdf.std() == 0] = np.nan, np.nan
    np.testing.assert_allclose(both.correlation(), want, atol=1e-7)
    np.testing.assert_allclose(both.covariance(), pdf.cov(), rtol=1e-6, atol=1e-6)
    m, shift = gram.complete_products(df, list(pdf.columns)[:5])
    rows = pdf.iloc[:, :5].dropna().to_numpy()
    ones = np.column_stack([np.ones(len(rows)), rows - shift[1:]])
    np.testing.assert_allclose(m, ones.T @ ones, rtol=1e-9, atol=1e-6)
    np.testing.assert_allclose(shift[1:], rows.mean(axis=0))


def test_both_ways_agree(gaps, monkeypatch):
    pdf, df = gaps
    found = []
    for limit in (0, 1000):
        monkeypatch.setattr(profile, "MAX_PAIRS", limit)
        found.append(profile.pearson_pairs(df, list(pdf.columns)[:12], 0.01).toPandas().sort_values(["a", "b"]).reset_index(drop=True))
        found.append(profile.vif(df.fillna(0.0), list(pdf.columns)[:8], intercept=True).toPandas())
    pd.testing.assert_frame_equal(found[0], found[2])
    pd.testing.assert_frame_equal(found[1], found[3], rtol=1e-6)


def test_no_rows_and_one_column(spark):
    empty = spark.createDataFrame([], "a double, b double")
    assert np.isnan(gram.Pairwise(empty, ["a", "b"]).correlation()).all()
    assert gram.complete_products(empty, ["a", "b"])[0].sum() == 0
    assert profile.pearson_pairs(spark.createDataFrame([(1.0,)], "a double"), ["a"]).collect() == []


def test_third_moments(spark):
    rng = np.random.default_rng(2)
    x = rng.gamma(2.0, size=(300, 4))
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abcd")))
    row = hypothesis.mardia(df, list("abcd")).first()
    z = x - x.mean(axis=0)
    g = z @ np.linalg.inv(z.T @ z / len(x)) @ z.T
    assert np.isclose(row.skewness, (g**3).mean()) and np.isclose(row.kurtosis, (np.diag(g) ** 2).mean())


def test_little_and_mechanism_on_many_columns(gaps):
    pdf, df = gaps
    some = list(pdf.columns)[:25]
    little = impute.little_test(df, some).first()
    mu, cov, d2, k = pdf[some].mean().to_numpy(), pdf[some].cov().to_numpy(), 0.0, 0
    for pattern, rows in pdf[some].groupby(pdf[some].notna().apply(tuple, axis=1)):
        seen = np.array(pattern)
        if seen.any():
            d = rows.mean().to_numpy()[seen] - mu[seen]
            d2, k = d2 + len(rows) * d @ np.linalg.pinv(cov[np.ix_(seen, seen)]) @ d, k + seen.sum()
    assert np.isclose(little.statistic, d2, rtol=1e-5) and little.dof == k - len(some)


def test_as_wide_as_the_largest_report(spark, sf):
    """271 rows of 1,943 columns made of the vectors, under ten jobs, equal to numpy."""
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").filter("vec_id < 271")
    wide = vectors.select(*[(F.get("embedding", F.lit(i % 64)) * (1 + i // 64) + F.sin(F.col("vec_id") * F.lit(0.01 * (i + 1)))).cast("double").alias(f"g{i}") for i in range(1943)])
    wide = spark.createDataFrame(wide.toPandas())
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("wide-pairs", "correlations of 1,943 columns")
    try:
        found = profile.pearson_pairs(wide, wide.columns, 0.95).toPandas()
        jobs = len(tracker.getJobIdsForGroup("wide-pairs"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    corr = np.corrcoef(wide.toPandas().to_numpy().T)
    at = np.argwhere(np.triu(np.abs(corr) > 0.95, 1))
    assert jobs < 10
    assert {(f"g{a}", f"g{b}") for a, b in at} == set(zip(found["a"], found["b"]))
    place = found["a"].str[1:].astype(int), found["b"].str[1:].astype(int)
    np.testing.assert_allclose(found["corr"], corr[place], atol=1e-8)


def test_poisson_weights_have_the_distribution():
    keys = np.arange(200, dtype=np.uint64) * np.uint64(0x1234567)
    for mean in (1, 3, 50, 40_000):
        w = hypothesis.poisson_weights(keys, np.full(200, mean), 500)
        assert abs(w.mean() / mean - 1) < 6 / np.sqrt(mean * w.size) and abs(w.var() / mean - 1) < 0.05
        assert w.min() >= 0 and (w == np.rint(w)).all()
    both = hypothesis.poisson_weights(keys, np.where(np.arange(200) % 2 == 0, 1, 7), 40)
    np.testing.assert_array_equal(both[::2], hypothesis.poisson_weights(keys[::2], np.ones(100), 40))
