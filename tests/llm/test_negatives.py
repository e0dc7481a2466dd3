import math

import numpy as np
from pyspark.sql import functions as F

from tabwright.llm import negatives, queries

LIMIT = (1 << 63) - 1


def brute(rows, every=100, positives=5, k=10, factor=256):
    whole = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole.append((i, [math.floor(factor * float(np.float32(x))) for x in v], label))
    out = []
    for a, av, al in whole:
        if a % every:
            continue
        scored = [(-max(min(sum(x * y for x, y in zip(av, v, strict=False)), LIMIT), -LIMIT - 1), i, label) for i, v, label in whole]
        for p, pid, _ in sorted(x for x in scored if x[2] == al and x[1] != a)[:positives]:
            inside = sorted((s, i) for s, i, label in scored if label != al and 30 * -p <= 100 * -s <= 90 * -p)[:k]
            out += [(a, pid, n, i, -p, -s) for n, (s, i) in enumerate(inside, 1)]
    return sorted(out)


def found(df, **kw):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in negatives.mined(df, **kw).collect())


def test_whole_table(spark, sf):
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in queries.op13_negatives(spark, sf).collect())
    assert got == brute(rows)


def test_corner_cases(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.normal(size=4)], i % 3) for i in range(1, 90)]
    rows += [(i, [0.5, 0.5, 0.25, 0.5], i % 2) for i in range(95, 250)]  # equal vectors: ties to the smaller id
    rows += [(10, [0.9, 0.5, 0.5, 0.5], 1)] * 3 + [(7, [1.0, 0.2, 0.1, 0.3], 1)] * 2  # repeated rows, an anchor among them
    rows += [(20, None, 1), (30, [1.0, None, 1.0, 1.0], 1), (40, [float("nan")] * 4, 1), (50, [float("inf")] * 4, 1), (None, [1.0] * 4, 1), (60, [1.0] * 4, None), (70, [1.0], 2), (80, [], 2)]
    rows += [(300, [3e7, 1.0, -3e7, 2.0], 1), (301, [2e7, 5.0, 0.0, 1.0], 1), (302, [1e7, 5.0, 0.0, 1.0], 0), (310, [3e14, 0.0, 0.0, 0.0], 0), (311, [1e15, 0.0, 0.0, 0.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3).withColumn("row", F.lit("x")).withColumn("v", F.lit(1)).withColumn("slot", F.lit(2))
    want = brute(rows, every=10)
    assert found(df, every=10) == want and len(want) > 100
    assert found(df, every=10, block=4) == want
    assert found(df.limit(0)) == []
    assert found(spark.createDataFrame([(100, [1.0], 1)], "vec_id long, embedding array<float>, label int")) == []


def test_bounds_spare_work_and_lose_nothing():
    """Rows in tight groups around the anchors: few scores are computed beside the root's, and all inside the windows are found."""
    rng = np.random.default_rng(9)
    centres = np.rint(rng.normal(size=(8, 16)) * 300)
    points = np.rint(np.repeat(centres, 40, axis=0) + rng.normal(size=(320, 16)) * 2)
    rows = np.rint(np.repeat(centres, 50, axis=0) + rng.normal(size=(400, 16)) * 2)
    tree = negatives.Tree(points)
    assert sorted(tree.order) == list(range(320)) and all(tree.parent[j] in tree.order[:n] for n, j in enumerate(tree.order) if n)
    np.testing.assert_allclose(tree.edge[tree.order[1:]], [np.linalg.norm(points[j] - points[tree.parent[j]]) for j in tree.order[1:]])
    scores = rows @ points.T
    windows = [(float(np.quantile(s, 0.9)), float(np.quantile(s, 0.95))) for s in scores.T]
    seen, computed = set(), 0
    for j, at, exact in tree.walk(rows, lambda j: (np.ones(400, bool), *windows[j])):
        np.testing.assert_array_equal(exact, scores[at, j])
        seen |= {(j, int(i)) for i in at}
        computed += len(at)
    assert seen >= {(j, i) for j, (a, b) in enumerate(windows) for i in range(400) if a <= scores[i, j] <= b}
    assert computed < 0.3 * scores.size
