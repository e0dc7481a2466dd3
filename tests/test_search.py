"""Random search, the vote of eleven methods, and scores of projections inside folds."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabwright.functions.columns import hash_unit
from tabwright.operators import models, reduce, select


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(8)
    n = 500
    x = rng.normal(size=(n, 4))
    y = (x[:, 0] + 0.8 * x[:, 1] + rng.normal(0, 0.4, n) > 0.3).astype(int)
    pdf = pd.DataFrame(x, columns=list("abcd")).assign(y=y, id=np.arange(n))
    return spark.createDataFrame(pdf).cache()


SPACES = {
    "decision_tree": {"maxDepth": ("int", 2, 4), "impurity": ("choice", ["gini", "entropy"])},
    "logistic": {"regParam": ("log", 1e-3, 0.1), "elasticNetParam": ("uniform", 0.0, 1.0)},
}


def test_draws_follow_seed_and_number():
    drawn = models.draw_trials(SPACES, 40, 3)
    assert drawn == models.draw_trials(SPACES, 40, 3) and drawn[:7] == models.draw_trials(SPACES, 7, 3) and drawn != models.draw_trials(SPACES, 40, 4)
    trees = [p for f, p in drawn if f == "decision_tree"]
    lines = [p for f, p in drawn if f == "logistic"]
    assert {p["maxDepth"] for p in trees} == {2, 3, 4} and {p["impurity"] for p in trees} == {"gini", "entropy"}
    assert all(1e-3 <= p["regParam"] <= 0.1 and 0 <= p["elasticNetParam"] <= 1 for p in lines)
    with pytest.raises(ValueError):
        models.draw_trials({"logistic": {"regParam": ("normal", 0, 1)}}, 1)


def test_search_is_repeatable_and_beats_the_baseline(spark, data, tmp_path):
    u = hash_unit("id")
    known, valid, held = data.filter(u < 0.6), data.filter((u >= 0.6) & (u < 0.8)), data.filter(u >= 0.8)
    model, trials = models.random_search(known, valid, list("abcd"), "y", SPACES, 5, str(tmp_path / "trials"))
    _, again = models.random_search(known, valid, list("abcd"), "y", SPACES, 5)
    first = trials.toPandas().sort_values("trial", ignore_index=True)
    pd.testing.assert_frame_equal(first, again.toPandas().sort_values("trial", ignore_index=True))
    pd.testing.assert_frame_equal(first, spark.read.parquet(str(tmp_path / "trials")).toPandas().sort_values("trial", ignore_index=True))
    assert first["chosen"].sum() == 1 and first.loc[first["chosen"], "score"].item() == first["score"].max()
    right = models.score(held, model, list("abcd")).agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
    share = held.agg(F.avg("y")).first()[0]
    assert right > max(share, 1 - share) + 0.1


def test_no_row_is_judged_by_a_model_that_saw_it(spark, data):
    """Labels drawn at random: whatever is in reach of the meta model, held-out accuracy stays near one half."""
    noise = data.withColumn("y", (hash_unit("id", seed=9) < 0.5).cast("int"))
    out = models.stack(noise, list("abcd"), "y", "id", ("decision_tree",), folds=2)
    assert out.count() == 500 and out.select("id").distinct().count() == 500
    assert abs(out.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0] - 0.5) < 0.12


def test_eleven_methods_vote(data):
    kept = select.selected_by_methods(data, list("abcd"), "y", "id", 2)
    assert len(kept) == 11
    for method in ("mutual_information", "f_test", "recursive_elimination", "permutation"):
        assert {"a", "b"} <= set(kept[method]), method
    table = {r.feature: r for r in select.vote(kept, list("abcd"), data.sparkSession).collect()}
    assert table["a"].kept and table["b"].kept and table["a"].votes > table["c"].votes


def test_score_of_a_projection_inside_folds(data):
    whole = reduce.cv_score(data, lambda d: reduce.pca(d, list("abcd"), 0.999), "y", "id")
    blind = reduce.cv_score(data, lambda d: reduce.pca(d, ["c", "d"], 0.999), "y", "id")
    assert whole > 0.8 > blind + 0.1
    seen = []
    reduce.cv_score(data, lambda d: seen.append(d.count()) or reduce.random_projection(d, list("abcd"), 2), "y", "id", folds=4)
    assert len(seen) == 4 and sum(500 - n for n in seen) == 500
