"""Order statistics against pandas, with ties, a hot value and keys."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabwright.functions import ordering


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(1)
    n = 5000
    v = np.where(rng.uniform(size=n) < 0.35, 7.0, np.round(rng.normal(0, 10, n), 1))
    pdf = pd.DataFrame({"id": np.arange(n), "k": rng.choice(["a", "b", "c"], n, p=[0.8, 0.15, 0.05]), "v": v})
    return pdf, spark.createDataFrame(pdf).cache()


@pytest.mark.parametrize("method", ["memory", "brackets", "buckets"])
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_quantiles(data, method, keys):
    pdf, df = data
    qs = [0.0, 0.01, 0.25, 0.5, 0.777, 1.0]
    got = {tuple(r)[:-1]: r["q"] for r in ordering.quantiles(df, "v", qs, keys, method=method).collect()}
    groups = {(k,): g for k, g in pdf.groupby("k")} if keys else {(): pdf}
    assert set(got) == set(groups)
    for k, g in groups.items():
        assert np.allclose(got[k], np.quantile(g["v"], qs), rtol=1e-12)


def test_many_quantiles(data):
    pdf, df = data
    qs = list(np.linspace(0, 1, 201))
    assert np.allclose(ordering.quantiles(df, "v", qs).first()["q"], np.quantile(pdf["v"], qs))


def test_average_rank_and_row_index(data):
    pdf, df = data
    ranks = {r["v"]: r["__rank"] for r in ordering.average_rank(df, "v").collect()}
    assert np.allclose(pdf["v"].map(ranks), pdf["v"].rank())
    rn = ordering.row_index(df, "v", "id", ["k"]).toPandas().sort_values("id")
    want = pdf.sort_values(["v", "id"]).groupby("k").cumcount().sort_index() + 1
    assert (rn["__rn"].to_numpy() == want.to_numpy()).all()


def test_row_window_and_carry_in_small_chunks(data, monkeypatch):
    pdf, df = data
    monkeypatch.setattr(ordering, "CHUNK_ROWS", 64)
    out = ordering.row_window(df, "v", lambda w: {"m": F.avg("id").over(w.rowsBetween(-9, 0)), "n": F.lead("id", 2).over(w)}, back=9, ahead=2, tie="id").toPandas()
    out = out.sort_values(["v", "id"])
    s = pdf.sort_values(["v", "id"])["id"]
    assert np.allclose(out["m"], s.rolling(10, min_periods=1).mean())
    assert np.allclose(out["n"].iloc[:-2].astype(float), s.shift(-2).iloc[:-2])
    sparse = df.withColumn("x", F.when(F.col("id") % 97 == 0, F.col("id")))
    for forward in (True, False):
        c = ordering.carry(sparse, "x", "v", "y", tie="id", forward=forward).toPandas().sort_values(["v", "id"])
        want = c["x"].ffill() if forward else c["x"].bfill()
        assert all((math.isnan(a) and math.isnan(b)) or a == b for a, b in zip(c["y"], want))


def test_dense_index(data, spark):
    pdf, df = data
    got = {r["v"]: r["__ix"] for r in ordering.dense_index(df.select("v").distinct(), "v").collect()}
    assert got == {v: i for i, v in enumerate(sorted(pdf["v"].unique()))}


@pytest.mark.parametrize("keys", [[], ["k"]])
def test_two_levels_of_buckets(spark, keys):
    """Over 10,000 buckets, with a hot value, missing values and ties, against pandas."""
    rng = np.random.default_rng(3)
    n = 60_000
    v = np.where(rng.uniform(size=n) < 0.35, 7.0, rng.normal(0, 10, n))
    v[rng.uniform(size=n) < 0.02] = np.nan
    pdf = pd.DataFrame({"id": np.arange(n), "k": rng.choice(["a", "b"], n, p=[0.9, 0.1]), "v": v, "w": rng.integers(0, 9, n).astype(float)})
    df = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    cut = ordering.with_bucket(df, "v", keys, "id", levels=2)
    assert cut.select("__bucket").distinct().count() > 10_000
    got = ordering.running(df, "v", {"s": F.col("w")}, keys, keys, "id", levels=2).toPandas().set_index("id").sort_index()
    order = pdf.sort_values(["v", "id"], na_position="first")
    want = (order.groupby("k")["w"].cumsum() if keys else order["w"].cumsum()).sort_index()
    assert np.allclose(got["s"], want)
    assert np.allclose(got["s__all"], pdf.groupby("k")["w"].transform("sum") if keys else pdf["w"].sum())


def test_levels_follow_the_rows(spark, monkeypatch):
    df = spark.range(4000).select(F.col("id").cast("double").alias("v"))
    assert ordering.with_bucket(df, "v").agg(F.max("__bucket")).first()[0] < 511
    monkeypatch.setattr(ordering, "BUCKET_ROWS", 5)
    assert ordering.with_bucket(df, "v").select("__bucket").distinct().count() > 3000
    assert ordering.row_index(df, "v", None).filter(F.col("__rn") != F.col("v") + 1).count() == 0
    found = ordering.carry(df.withColumn("x", F.when(F.col("v") % 100 == 0, F.col("v"))), "x", "v", "y")
    assert found.filter(F.col("y") != F.floor(F.col("v") / 100) * 100).count() == 0
