import math

import numpy as np
from pyspark.sql import functions as F

from tabwright.llm import topk


def brute(rows, every=20, k=20):
    """Each query row against every row of another id, repeated rows and all, in whole numbers of any size held at 64 bits."""
    whole = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in whole:
        if q % every == 0:
            scores = [(-min(max(sum(x * y for x, y in zip(a, b, strict=False)), -(1 << 63)), (1 << 63) - 1), i) for i, b in whole if i != q]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def found(df, **kw):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.nearest(df, **kw).collect())


def test_embeddings_in_several_trees(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    want = brute([(r.vec_id, r.embedding) for r in df.collect()])
    assert found(df) == want
    assert found(df, tree_rows=200, page=16, block=7) == want


def test_corner_cases(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(1, 60)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(100, 400)]  # equal vectors: ties to the smaller id
    rows += [(0, [1.0, float("nan"), 0.0, 0.0]), (20, None), (500, [float("inf")] * 4), (None, [1.0] * 4), (501, [1.0, None, 0.0, 0.0]), (502, [1.0]), (502, [1.0]), (503, [])]
    rows += rows[25:45] * 3  # repeated rows, queries among them
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1)).withColumn("score", F.lit("x"))
    assert found(df) == brute(rows)
    assert found(df, tree_rows=150, page=8, block=3) == brute(rows)
    assert found(df, tree_rows=20, page=8, block=3, pivots=4) == brute(rows)
    assert found(df.limit(0)) == []
    assert found(spark.createDataFrame([(20, [1.0])], "vec_id long, embedding array<float>")) == []


def test_large_components(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=3)]) for i in range(1, 90)]
    rows += [(90, [3e7, -2.0, 1.0]), (100, [3e7, 3e7, 0.0]), (100, [3e7, 3e7, 0.0]), (101, [-1e30, 1.0, 1.0]), (120, [2e30, 0.5, -1.0]), (121, [5e8, 1.0, 0.0]), (140, [1.0, 1e12, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert found(df) == brute(rows)
    assert found(df, tree_rows=25, page=8, block=2) == brute(rows)


def test_far_trees_are_left_out(spark, monkeypatch):
    """Clusters in different directions: a query's bar keeps it from the trees of the others."""
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in 5 * np.eye(6)[i % 6] + 0.1 * rng.normal(size=6)]) for i in range(1, 1200)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    written = {}
    plain = topk.saved

    def counting(table, name):
        out = plain(table, name)
        written.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(topk, "saved", counting)
    assert found(df, tree_rows=200, page=32) == brute(rows)
    queries, asked_again = written["queries"][0], written["queries"][-1]
    assert written["m-trees"][0] >= 6 and asked_again < queries * (written["m-trees"][0] - 1)


def test_tree_holds_its_bounds():
    rng = np.random.default_rng(2)
    points = np.vstack([rng.normal(size=(900, 6)), np.zeros((300, 6))])
    root = topk.build(points, np.arange(len(points)), 64)
    seen = []

    def walk(node):
        if node.rows is not None:
            assert len(node.rows) <= 64
            d = topk.apart(points[node.rows], node.centre)
            np.testing.assert_allclose(d, node.to_centre)
            seen.extend(node.rows.tolist())
            rows = node.rows
        else:
            rows = np.concatenate([walk(c) for c in node.children])
            np.testing.assert_allclose(node.to_centre, [np.sqrt(((c.centre - node.centre) ** 2).sum()) for c in node.children])
        assert topk.apart(points[rows], node.centre).max() <= node.radius + 1e-9
        return rows

    walk(root)
    assert sorted(seen) == list(range(len(points)))
