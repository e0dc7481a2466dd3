"""Exact neighbours and what is built on them, against brute force."""

import numpy as np
import pandas as pd
import pytest

from tabwright.operators import association, neighbors, splits


@pytest.fixture(scope="module")
def cloud(spark):
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(0, 1, (300, 2)), rng.normal(6, 0.2, (150, 2)), np.tile([[1.5, 1.5]], (120, 1))])
    pdf = pd.DataFrame({"id": np.arange(len(x)), "a": x[:, 0], "b": x[:, 1], "y": (np.arange(len(x)) % 5 == 0).astype(int)})
    return pdf, spark.createDataFrame(pdf).cache()


@pytest.mark.parametrize("block", [40, 4096])
def test_knn_matches_brute_force(cloud, monkeypatch, block):
    pdf, df = cloud
    monkeypatch.setattr(neighbors, "BLOCK_ROWS", block)
    k = 6
    pts = neighbors.points(df, ["a", "b"], "id")
    got = neighbors.knn(None, pts, k, skip_self=True).toPandas()
    x = pdf[["a", "b"]].to_numpy()
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    near = np.sort(d, axis=1)[:, :k]
    total = got.assign(s=got["dist"] * got["weight"]).groupby("qid").agg(s=("s", "sum"), w=("weight", "sum"))
    assert (total["w"] == k).all()
    assert np.allclose(total["s"], near[total.index].sum(axis=1))


def test_smote_balances_inside_the_minority(cloud):
    pdf, df = cloud
    out = splits.smote(df, ["a", "b"], "y", "id").toPandas()
    assert out["y"].value_counts().nunique() == 1
    new = out[out["synthetic"]]
    few = pdf[pdf["y"] == 1]
    assert (new["y"] == 1).all()
    assert new["a"].between(few["a"].min() - 1e-9, few["a"].max() + 1e-9).all()
    again = splits.smote(df, ["a", "b"], "y", "id").toPandas()
    cols = ["a", "b", "y", "synthetic"]
    assert np.allclose(out.sort_values(cols)[["a", "b"]], again.sort_values(cols)[["a", "b"]])


def test_near_miss_keeps_the_closest(cloud):
    pdf, df = cloud
    out = splits.near_miss(df, ["a", "b"], "y", "id").toPandas()
    few, rest = pdf[pdf["y"] == 1], pdf[pdf["y"] == 0]
    d = np.sqrt(((rest[["a", "b"]].to_numpy()[:, None] - few[["a", "b"]].to_numpy()[None]) ** 2).sum(axis=2))
    mean = np.sort(d, axis=1)[:, :3].mean(axis=1)
    kept = out[out["y"] == 0]
    assert len(kept) == len(few) and (out["y"] == 1).sum() == len(few)
    score = dict(zip(rest["id"], mean))
    assert np.isclose(sum(score[i] for i in kept["id"]), np.sort(mean)[: len(few)].sum())


def test_kendall_with_ties(spark):
    rng = np.random.default_rng(5)
    n = 700
    x = np.where(rng.uniform(size=n) < 0.4, 3, rng.integers(0, 40, n)).astype(float)
    y = np.round(x * 0.3 + rng.normal(0, 4, n), 0)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y}))
    s = np.sign(x[:, None] - x[None]) * np.sign(y[:, None] - y[None])
    want = s.sum() / np.sqrt(np.abs(np.sign(x[:, None] - x[None])).sum() * np.abs(np.sign(y[:, None] - y[None])).sum())
    for bits in (8, 3, 1):  # one, two or three, and six or more levels
        assert np.isclose(association.kendall(df, "x", "y", bits).first()["tau"], want)


def test_kendall_batches_end_inside_a_grid(spark):
    rng = np.random.default_rng(6)
    df = spark.createDataFrame(pd.DataFrame({"x": rng.integers(0, 900, 4000).astype(float), "y": np.where(rng.uniform(size=4000) < 0.35, 5.0, rng.integers(0, 900, 4000))}))
    want = association.kendall(df, "x", "y", 10).first()["tau"]  # one level
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert np.isclose(association.kendall(df, "x", "y", 4).first()["tau"], want, rtol=1e-12)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
