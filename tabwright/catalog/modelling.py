"""Queries on distributions, selection, reduction and models."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.columns import hash_unit, rounded
from ..operators import distributions as X
from ..operators import evaluate as V
from ..operators import models as M
from ..operators import reduce as R
from ..operators import select as S
from .derived import LINEITEM_NULLS, lineitem_nulls
from .profiling import MEASURES
from .association import anova_sql, mi_all
from .registry import query, table
from .sources_quality import scratch


def li(spark, sf):
    return table(spark, sf, "lineitem")


def flat(spark, sf):
    """The components of each embedding as columns."""
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", "label", *[F.get("embedding", F.lit(i)).cast("double").alias(f"e{i}") for i in range(64)])


E64 = [f"e{i}" for i in range(64)]


@query("d18_best_fit")
def d18(spark, sf):
    return X.best_fit(table(spark, sf, "events"), ["value"])


@query("d18_family_scores")
def d18f(spark, sf):
    return X.fit_families(table(spark, sf, "orders"), ["o_totalprice"])


STUDENTS = ", ".join(f"({nu})" for nu in (1.0, *X.T_DEGREES))


@query(
    "d18_family_order",
    f"""WITH RECURSIVE e AS (SELECT CAST(o_totalprice AS DOUBLE) AS x FROM orders WHERE o_totalprice IS NOT NULL),
    s AS (SELECT count(*) AS n, avg(x) AS m, var_pop(x) AS v, min(x) AS lo, max(x) AS hi, avg(x * x) AS xx, avg(ln(x)) AS ml, var_pop(ln(x)) AS vl, median(x) AS med,
                 quantile_cont(x, 0.75) - quantile_cont(x, 0.25) AS iqr FROM e),
    weibull(i, k) AS (SELECT 0, 1.0::DOUBLE UNION ALL
        SELECT i + 1, k + greatest(least((1 / k - a1 / a0 + lm) / (1 / (k * k) + a2 / a0 - (a1 / a0) ** 2), k), -k / 2)
        FROM (SELECT i, k, any_value(ml - ln(hi)) AS lm, avg((x / hi) ** k) AS a0, avg((x / hi) ** k * ln(x / hi)) AS a1, avg((x / hi) ** k * ln(x / hi) ** 2) AS a2
              FROM weibull, e, s WHERE i < 30 GROUP BY i, k)),
    student(i, nu, mu, s2) AS (SELECT 0, nu::DOUBLE, med, (iqr / 2) ** 2 FROM s, (VALUES {STUDENTS}) t(nu) UNION ALL
        SELECT i + 1, nu, wx / w, (wxx - 2 * (wx / w) * wx + (wx / w) ** 2 * w) / n
        FROM (SELECT i, nu, count(*) AS n, sum(f) AS w, sum(f * z) AS wx, sum(f * z * z) AS wxx
              FROM (SELECT i, nu, x AS z, (nu + 1) / (nu + (x - mu) ** 2 / s2) AS f FROM student, e WHERE i < 150) GROUP BY i, nu)),
    tails AS (SELECT nu, any_value(n) * (lgamma((nu + 1) / 2) - lgamma(nu / 2) - 0.5 * ln(nu * pi() * any_value(s2))) - (nu + 1) / 2 * sum(ln(1 + (x - mu) ** 2 / (nu * s2))) AS ll
              FROM student, e, s WHERE i = 150 GROUP BY nu),
    scored(family, k, ll) AS (
        SELECT 'norm', 2, -n / 2 * (ln(2 * pi() * v) + 1) FROM s UNION ALL
        SELECT 'lognorm', 3, -n * ml - n / 2 * (ln(2 * pi() * vl) + 1) FROM s UNION ALL
        SELECT 'expon', 2, -n * ln(m - lo) - n FROM s UNION ALL
        SELECT 'pareto', 3, n * -ln(ml - ln(lo)) + n * ln(lo) / (ml - ln(lo)) - (1 / (ml - ln(lo)) + 1) * n * ml FROM s UNION ALL
        SELECT 'rayleigh', 2, n * ml - n * ln(xx / 2) - n FROM s UNION ALL
        SELECT 'weibull_min', 3, any_value(n) * (ln(k) - ln(avg((x / hi) ** k)) - k * ln(any_value(hi)) + (k - 1) * any_value(ml) - 1) FROM weibull, e, s WHERE i = 30 GROUP BY k UNION ALL
        SELECT 'cauchy', 2, ll FROM tails WHERE nu = 1 UNION ALL
        SELECT 't', 3, max(ll) FROM tails WHERE nu > 1)
    SELECT 'o_totalprice' AS feature, family, round(2 * k - 2 * ll, 2) AS aic, CAST(row_number() OVER (ORDER BY 2 * k - 2 * ll) AS INTEGER) AS place FROM scored""",
)
def d18o(spark, sf):
    fits = X.fit_families(table(spark, sf, "orders"), ["o_totalprice"], [f for f in X.FAMILIES if f not in ("gamma", *X.UNIT)])
    place = F.row_number().over(Window.partitionBy("feature").orderBy("aic"))
    return fits.select("feature", "family", F.round("aic", 2).alias("aic"), place.alias("place"))


@query(
    "d19_anderson_darling",
    """WITH e AS (SELECT value AS v FROM events), m AS (SELECT avg(v) AS m, count(*) AS n FROM e),
    s AS (SELECT least(greatest(1 - exp(-v / m), 1e-9), 1 - 1e-9) AS f, row_number() OVER (ORDER BY v) AS i, row_number() OVER (ORDER BY v DESC) AS j, n FROM e, m)
    SELECT any_value(n) AS n, round(-any_value(n) - sum((2 * i - 1) * ln(f) + (2 * j - 1) * ln(1 - f)) / any_value(n), 4) AS anderson, round(max(greatest(i / n - f, f - (i - 1) / n)), 9) AS ks FROM s""",
)
def d19(spark, sf):
    ev = table(spark, sf, "events")
    mean = ev.agg(F.avg("value")).scalar()
    g = X.goodness(ev.withColumn("z", F.col("value") / mean), "z", lambda x: 1 - F.exp(-x))
    return g.select("n", F.round("anderson", 4).alias("anderson"), F.round("ks", 9).alias("ks"))


@query("d20_pit", "SELECT event_id, round(cume_dist() OVER (ORDER BY value), 9) AS value_pit FROM events")
def d20(spark, sf):
    return rounded(X.ecdf(table(spark, sf, "events").select("event_id", "value"), "value").drop("value"), 9)


@query("d21_quantile_uniform")
def d21(spark, sf):
    from ..operators.scale import quantile_transform

    return quantile_transform(table(spark, sf, "events").select("event_id", "value"), ["value"], "uniform")


@query("d22_copula")
def d22(spark, sf):
    corr, loglik = X.gaussian_copula(li(spark, sf), ["l_quantity", "l_extendedprice", "l_discount"])
    return corr.withColumn("loglik", F.lit(loglik))


@query("d23_hopkins")
def d23(spark, sf):
    return R.hopkins(table(spark, sf, "customer"), ["c_acctbal", "c_nationkey"], "c_custkey")


@query("d26_scree")
def d26(spark, sf):
    return R.scree(li(spark, sf), MEASURES)


@query("d27_kmeans_elbow")
def d27(spark, sf):
    return R.kmeans_elbow(table(spark, sf, "customer"), ["c_acctbal", "c_nationkey"], range(2, 11))


QQ = ", ".join(str((i + 0.5) / 50) for i in range(50))


@query("d31_qq_points", f"SELECT round(unnest([{QQ}])::DOUBLE, 9) AS p, round(unnest(quantile_cont(value, [{QQ}])), 6) AS sample FROM events")
def d31(spark, sf):
    return X.qq_points(table(spark, sf, "events"), "value", 50).select(F.round("p", 9).alias("p"), F.round("sample", 6).alias("sample"))


def urgent(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_custkey", F.dayofyear("o_orderdate").alias("doy"), (F.col("o_totalprice") + F.col("o_custkey") * 50 > 250000).cast("int").alias("y"))


UCOLS = ["o_totalprice", "o_custkey", "doy"]


def parts(df, key, *bounds, seed=42):
    """Rows cut by a hash of the key at the bounds: what was fitted on one part is judged on another."""
    u = hash_unit(key, seed=seed)
    return [df.filter((u >= a) & (u < b)) for a, b in zip((0.0, *bounds), (*bounds, 1.0), strict=True)]


@query("d32_permutation_importance")
def d32(spark, sf):
    return M.permutation_importance(urgent(spark, sf), UCOLS, "y", "o_orderkey")


@query("k1_mi_filter", f"SELECT feature, mi AS score FROM ({mi_all(MEASURES, 'l_returnflag', 'lineitem')}) WHERE mi > 0")
def k1(spark, sf):
    return rounded(S.mi_filter(li(spark, sf), "l_returnflag", MEASURES), 9)


@query("k2_f_filter", "SELECT feature, f AS score FROM (" + " UNION ALL ".join(anova_sql(c, "l_returnflag", "lineitem") for c in MEASURES) + ") ORDER BY f DESC LIMIT 2")
def k2(spark, sf):
    return rounded(S.f_filter(li(spark, sf), "l_returnflag", MEASURES, 2), 5)


@query("k3_variance_filter", "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, round(var_pop({c}), 4) AS score FROM lineitem" for c in MEASURES) + ") WHERE score > 1")
def k3(spark, sf):
    return rounded(S.variance_filter(li(spark, sf), MEASURES, 1.0), 4)


@query("k4_correlation_filter", "SELECT unnest(CASE WHEN abs(corr(l_extendedprice, l_extendedprice * (1 - l_discount))) >= 0.9 THEN ['l_discount', 'l_quantity'] ELSE [] END) AS feature FROM lineitem")
def k4(spark, sf):
    d = li(spark, sf).withColumn("net", F.col("l_extendedprice") * (1 - F.col("l_discount")))
    kept = S.correlation_filter(d, ["l_extendedprice", "net", "l_discount", "l_quantity"])
    return spark.createDataFrame([(c,) for c in kept], "feature string")


@query("k5_tree_importance")
def k5(spark, sf):
    return S.importance_filter(M.tree_importance(urgent(spark, sf), UCOLS, "y"))


@query("k6_permutation_filter")
def k6(spark, sf):
    return S.importance_filter(M.permutation_importance(urgent(spark, sf), UCOLS, "y", "o_orderkey"))


@query("k7_sparse_filter")
def k7(spark, sf):
    return S.sparse_filter(urgent(spark, sf), UCOLS, "y")


@query("k8_recursive_elimination")
def k8(spark, sf):
    return spark.createDataFrame([(c,) for c in S.recursive_elimination(urgent(spark, sf), UCOLS, "y", 2)], "feature string")


@query("k9_sequential_selection")
def k9(spark, sf):
    d = urgent(spark, sf)
    known: dict = {}
    rows = [(way, c) for way in ("forward", "backward") for c in S.sequential_selection(d, UCOLS, "y", 2, forward=way == "forward", known=known)]
    return spark.createDataFrame(rows, "direction string, feature string")


@query("k10_vote")
def k10(spark, sf):
    return S.vote_of_methods(urgent(spark, sf), UCOLS, "y", "o_orderkey", 2)


@query("k11_missing_filter", f"SELECT feature FROM (SELECT 'qty' AS feature, avg((qty IS NULL)::INT) AS r FROM {LINEITEM_NULLS} UNION ALL SELECT 'ghost', avg((ghost IS NULL)::INT) FROM {LINEITEM_NULLS} UNION ALL SELECT 'flag', avg((flag IS NULL)::INT) FROM {LINEITEM_NULLS}) WHERE r <= 0.5")
def k11(spark, sf):
    return spark.createDataFrame([(c,) for c in S.missing_filter(lineitem_nulls(spark, sf).select("qty", "ghost", "flag"))], "feature string")


@query("k12_pca")
def k12(spark, sf):
    d = flat(spark, sf)
    return R.pca(d, E64).transform(d, ["vec_id"])


@query("k13_svd")
def k13(spark, sf):
    d = flat(spark, sf)
    return R.truncated_svd(d, E64, 3).transform(d, ["vec_id"])


@query("k14_discriminant")
def k14(spark, sf):
    d = flat(spark, sf)
    return R.discriminant(d, E64, "label").transform(d, ["vec_id", "label"])


@query("k15_pls")
def k15(spark, sf):
    d = li(spark, sf)
    return R.pls(d, ["l_quantity", "l_discount", "l_tax"], "l_extendedprice", 2).transform(d, ["l_orderkey", "l_linenumber"])


@query("k16_nmf")
def k16(spark, sf):
    d = flat(spark, sf).select("vec_id", *[F.abs(c).alias(c) for c in E64])
    return R.nmf(d, E64, "vec_id", 3)[2]


@query("k17_random_projection")
def k17(spark, sf):
    d = flat(spark, sf)
    return R.random_projection(d, E64, 5).transform(d, ["vec_id"])


@query("k18_gates")
def k18(spark, sf):
    return R.gates(li(spark, sf), MEASURES)


@query("k19_borda")
def k19(spark, sf):
    d = flat(spark, sf)
    rows = []
    for fit in (lambda x: R.pca(x, E64), lambda x: R.truncated_svd(x, E64, 3), lambda x: R.random_projection(x, E64, 3)):
        p = fit(d)
        rows.append((p.technique, "reconstruction_error", R.reconstruction_error(d, p)))
        rows.append((p.technique, "cv_score", R.cv_score(d, fit, "label", "vec_id")))
        if p.explained is not None:
            rows.append((p.technique, "explained_variance", p.explained))
    return R.borda(spark.createDataFrame(rows, "technique string, metric string, value double"))


@query("k20_project_new")
def k20(spark, sf):
    d = flat(spark, sf)
    return R.pca(d.filter("vec_id % 10 < 8"), E64).transform(d, ["vec_id", "label"])


@query("o1_training")
def o1(spark, sf):
    known, held = parts(urgent(spark, sf), "o_orderkey", 0.8)
    return M.score(held, M.train(known, UCOLS, "y", "decision_tree"), UCOLS).select("o_orderkey", "label", "prediction", "score")


@query("o1_mlp")
def o1m(spark, sf):
    known, held = parts(urgent(spark, sf), "o_orderkey", 0.8)
    return M.score(held, M.train(known, UCOLS, "y", "mlp"), UCOLS).select("o_orderkey", "label", "prediction", "score")


@query("o2_search")
def o2(spark, sf):
    return M.search(urgent(spark, sf), UCOLS, "y", "decision_tree", {"maxDepth": [2, 4], "minInstancesPerNode": [1, 10]})[1]


#: Parameters of each family that the trials draw.
SPACES = {
    "decision_tree": {"maxDepth": ("int", 2, 8), "minInstancesPerNode": ("int", 1, 50), "impurity": ("choice", ["gini", "entropy"])},
    "logistic": {"regParam": ("log", 1e-4, 1.0), "elasticNetParam": ("uniform", 0.0, 1.0)},
    "random_forest": {"numTrees": ("int", 5, 20), "maxDepth": ("int", 2, 6)},
}


@query("o2_random_search")
def o2r(spark, sf):
    known, valid, held = parts(urgent(spark, sf), "o_orderkey", 0.6, 0.8)
    model, trials = M.random_search(known, valid, UCOLS, "y", SPACES, 8, scratch(spark) + "/trials")
    right = M.score(held, model, UCOLS).agg(F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("held_out_accuracy"))
    return trials.withColumn("held_out_accuracy", right.scalar())


@query("o3_trials")
def o3(spark, sf):
    known, valid, _ = parts(urgent(spark, sf), "o_orderkey", 0.6, 0.8)
    _, trials = M.random_search(known, valid, UCOLS, "y", SPACES, 8)
    means, best = V.trial_summary(trials)
    return means.join(best.groupBy("family").agg(F.count(F.lit(1)).alias("among_best"), F.max("score").alias("best_score")), "family", "left")


@query("o4_hard_vote", "SELECT o_orderkey, CASE WHEN (o_totalprice > 200000)::INT + (o_custkey > 700)::INT + (dayofyear(o_orderdate) > 180)::INT >= 2 THEN 1.0 ELSE 0.0 END::DOUBLE AS vote FROM orders")
def o4(spark, sf):
    d = urgent(spark, sf)
    votes = d.withColumns({"a": (F.col("o_totalprice") > 200000).cast("int"), "b": (F.col("o_custkey") > 700).cast("int"), "c": (F.col("doy") > 180).cast("int")})
    return V.hard_vote(votes, ["a", "b", "c"]).select("o_orderkey", (F.col("vote") + 0.0).alias("vote"))


@query("o4_soft_vote", "SELECT o_orderkey, round((2 * least(o_totalprice / 500000, 1) + o_custkey / 1500) / 3, 9) AS p1 FROM orders")
def o4s(spark, sf):
    a, b = F.least(F.col("o_totalprice") / 500000, F.lit(1.0)), F.col("o_custkey") / 1500
    d = urgent(spark, sf).withColumns({"pa": F.array(1 - a, a), "pb": F.array(1 - b, b)})
    return V.soft_vote(d, ["pa", "pb"], [2.0, 1.0]).select("o_orderkey", F.round(F.get("probability_vote", F.lit(1)), 9).alias("p1"))


@query("o5_stacking")
def o5(spark, sf):
    return M.stack(urgent(spark, sf), UCOLS, "y", "o_orderkey", ("logistic", "decision_tree"))


@query("o5_residual_blend")
def o5r(spark, sf):
    d = table(spark, sf, "part")
    out = M.residual_blend(d, ["p_size", "p_partkey"], "p_retailprice", "p_partkey", (0, 5000))
    return V.regression_metrics(out, "label", "prediction")


@query("o13_coefficients")
def o13(spark, sf):
    d = urgent(spark, sf)
    model = M.train(d, UCOLS, "y", "logistic_l1")
    return M.coefficient_ranking(model.stages[-1], UCOLS, spark)


@query("o15_batch_scoring")
def o15(spark, sf):
    """Encoders, imputation and model stored as one object, read again, and applied to rows that none of them saw."""
    d = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_custkey", "o_orderpriority", F.dayofyear("o_orderdate").alias("doy"), (F.col("o_orderpriority") < "3").cast("int").alias("y"))
    known, held = parts(d, "o_orderkey", 0.8)
    path = scratch(spark) + "/model"
    M.train(known, UCOLS, "y", "logistic", categorical=["o_orderpriority"]).save(path)
    return M.batch_predict(held.drop("y"), path, UCOLS).select("o_orderkey", "prediction", "score")
