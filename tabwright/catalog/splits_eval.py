"""Queries on splits, leakage and evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import rounded
from ..operators import evaluate as V
from ..operators import leakage as L
from ..operators import splits as S
from .registry import query, table

U = "CAST(concat('0x', substr(md5(concat_ws('|', '42', CAST(o_orderkey AS VARCHAR))), 1, 13)) AS BIGINT) / 4503599627370496.0"


def orders(spark, sf):
    return table(spark, sf, "orders")


@query(
    "m1_stratified_split",
    f"""SELECT o_orderkey, o_orderstatus, CASE WHEN rn <= round(n * 0.8) THEN 'train' WHEN rn <= round(n * 0.9) THEN 'val' ELSE 'test' END AS split FROM
    (SELECT o_orderkey, o_orderstatus, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {U}, o_orderkey) AS rn, count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders)""",
)
def m1(spark, sf):
    return S.stratified_split(orders(spark, sf).select("o_orderkey", "o_orderstatus"), "o_orderkey", "o_orderstatus")


@query("m2_smote")
def m2(spark, sf):
    c = table(spark, sf, "customer").withColumn("rich", (F.col("c_acctbal") > 8500).cast("int"))
    return S.smote(c, ["c_acctbal", "c_nationkey"], "rich", "c_custkey")


@query("m3_near_miss")
def m3(spark, sf):
    c = table(spark, sf, "customer").withColumn("rich", (F.col("c_acctbal") > 8500).cast("int"))
    return S.near_miss(c.select("c_custkey", "c_acctbal", "c_nationkey", "rich"), ["c_acctbal", "c_nationkey"], "rich", "c_custkey")


SPLIT = f"CASE WHEN {U} < 0.8 THEN 'train' WHEN {U} < 0.9 THEN 'val' ELSE 'test' END"
OS = f"(SELECT *, {SPLIT} AS split FROM orders)"


def split_orders(spark, sf):
    return S.hash_split(orders(spark, sf), "o_orderkey")


@query("m4_overlap", f"SELECT DISTINCT o_custkey FROM {OS} WHERE split = 'test' AND o_custkey IN (SELECT o_custkey FROM {OS} WHERE split = 'train')")
def m4(spark, sf):
    d = split_orders(spark, sf)
    return S.overlap(d.filter("split = 'train'"), d.filter("split = 'test'"), ["o_custkey"])


@query("m5_equal_to_target", "SELECT * FROM (VALUES ('o_orderkey', false), ('o_orderpriority', false), ('copy', true)) AS t(feature, equals_target)")
def m5(spark, sf):
    o = orders(spark, sf).select("o_orderkey", "o_orderpriority", F.col("o_orderstatus").alias("copy"), "o_orderstatus")
    return S.equal_to_target(o, "o_orderstatus")


CU = U.replace("o_orderkey", "o_custkey")


@query("m6_group_split", f"SELECT o_orderkey, o_custkey, CASE WHEN {CU} < 0.8 THEN 'train' WHEN {CU} < 0.9 THEN 'val' ELSE 'test' END AS split FROM orders")
def m6(spark, sf):
    return S.hash_split(orders(spark, sf).select("o_orderkey", "o_custkey"), "o_custkey")


@query("m6_time_split", "SELECT o_orderkey, CASE WHEN epoch_us(o_orderdate) > (SELECT quantile_cont(epoch_us(o_orderdate)::DOUBLE, 0.8) FROM orders) THEN 'test' ELSE 'train' END AS split FROM orders")
def m6t(spark, sf):
    return S.time_split(orders(spark, sf).select("o_orderkey", "o_orderdate"), "o_orderdate").drop("o_orderdate")


@query("m6_stratified_folds", f"SELECT o_orderkey, CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY {U}, o_orderkey) - 1) % 5 AS INTEGER) AS fold FROM orders")
def m6k(spark, sf):
    return S.kfold(orders(spark, sf).select("o_orderkey", "o_orderstatus"), "o_orderkey", 5, "o_orderstatus").drop("o_orderstatus")


@query("m7_split_shares", f"SELECT split, o_orderstatus, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY split), 9) AS share FROM {OS} GROUP BY 1, 2")
def m7(spark, sf):
    return rounded(S.split_shares(split_orders(spark, sf), "o_orderstatus"), 9)


def _reg(name, fn):
    p = f"(SELECT {fn}(o_totalprice) FROM {OS} WHERE split = 'train')"
    return f"""SELECT '{name}' AS strategy, round(avg(abs(o_totalprice - p)), 3) AS mae, round(avg(pow(o_totalprice - p, 2)) / 1e6, 3) AS mse, round(1 - avg(pow(o_totalprice - p, 2)) / var_pop(o_totalprice), 9) AS r2
      FROM (SELECT o_totalprice, {p} AS p FROM {OS} WHERE split = 'test')"""


@query("m8_regression_baselines", _reg("mean", "avg") + " UNION ALL " + _reg("median", "median"))
def m8(spark, sf):
    d = split_orders(spark, sf)
    out = S.regression_baselines(d.filter("split = 'train'"), d.filter("split = 'test'"), "o_totalprice")
    return out.select("strategy", F.round("mae", 3).alias("mae"), F.round(F.col("mse") / 1e6, 3).alias("mse"), F.round("r2", 9).alias("r2"))


@query(
    "m9_class_baseline_frequent",
    f"""SELECT 'most_frequent' AS strategy, round(avg(CASE WHEN o_orderstatus = m THEN 1.0 ELSE 0.0 END)::DOUBLE, 9) AS accuracy FROM {OS},
    (SELECT o_orderstatus AS m FROM {OS} WHERE split = 'train' GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) WHERE split = 'test'""",
)
def m9(spark, sf):
    d = split_orders(spark, sf)
    out = S.class_baselines(d.filter("split = 'train'"), d.filter("split = 'test'"), "o_orderstatus", "o_orderkey")
    return out.filter("strategy = 'most_frequent'").select("strategy", F.round("accuracy", 9).alias("accuracy"))


@query("m9_class_baselines")
def m9a(spark, sf):
    d = split_orders(spark, sf)
    return S.class_baselines(d.filter("split = 'train'"), d.filter("split = 'test'"), "o_orderstatus", "o_orderkey")


@query("m10_class_weights", "SELECT o_orderkey, o_orderstatus, round((SELECT count(*) FROM orders) / ((SELECT count(DISTINCT o_orderstatus) FROM orders) * count(*) OVER (PARTITION BY o_orderstatus)), 9) AS weight FROM orders")
def m10(spark, sf):
    return rounded(S.class_weights(orders(spark, sf).select("o_orderkey", "o_orderstatus"), "o_orderstatus"), 9)


LEAK = "(SELECT *, o_totalprice * 2 + 1 AS twin, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS is_f, CASE WHEN o_orderstatus = 'F' THEN 'yes' ELSE 'no' END AS word FROM orders)"


def leaky(spark, sf):
    f = F.col("o_orderstatus") == "F"
    return orders(spark, sf).withColumns({"twin": F.col("o_totalprice") * 2 + 1, "is_f": f.cast("int"), "word": F.when(f, "yes").otherwise("no")})


@query("n1_high_correlation", f"SELECT 'twin' AS feature, round(corr(twin, o_totalprice), 6) AS corr FROM {LEAK}")
def n1(spark, sf):
    return rounded(L.high_correlation(leaky(spark, sf), "o_totalprice", ["twin", "o_custkey", "is_f"]))


@query("n2_constant_groups", f"SELECT 'word' AS feature, word AS value, count(*) AS n FROM {LEAK} GROUP BY word UNION ALL SELECT 'is_f', CAST(is_f AS VARCHAR), count(*) FROM {LEAK} GROUP BY is_f HAVING count(DISTINCT o_orderstatus = 'F') = 1")
def n2(spark, sf):
    d = leaky(spark, sf).withColumn("y", F.col("o_orderstatus") == "F")
    return L.constant_groups(d, "y", ["word", "is_f", "o_totalprice", "o_orderpriority"])


def auc_sql(c, y, source):
    return f"""(SELECT (sum(CASE WHEN {y} = 1 THEN r END) - p * (p + 1) / 2) / (p * (n - p)) FROM (SELECT {y}, rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2 AS r,
      sum({y}) OVER () AS p, count(*) OVER () AS n FROM {source}) GROUP BY p, n)"""


@query(
    "n3_feature_auc",
    f"""SELECT 'o_totalprice' AS feature, round({auc_sql('o_totalprice', 'is_f', LEAK)}, 9) AS auc, false AS leaky UNION ALL
    SELECT 'o_orderpriority', round(max((1 + p / pp - q / qq) / 2), 9), false FROM (SELECT sum(is_f) AS p, sum(1 - is_f) AS q, sum(sum(is_f)) OVER () AS pp, sum(sum(1 - is_f)) OVER () AS qq FROM {LEAK} GROUP BY o_orderpriority)
    UNION ALL SELECT 'word', 1.0, true""",
)
def n3(spark, sf):
    return rounded(L.feature_auc(leaky(spark, sf), "is_f", ["o_totalprice"], ["o_orderpriority", "word"]), 9)


@query(
    "n4_separation_auc",
    f"SELECT 'o_totalprice' AS feature, round({auc_sql('o_totalprice', 't', f'(SELECT o_totalprice, CASE WHEN split = $$test$$ THEN 1 ELSE 0 END AS t FROM {OS} WHERE split IN ($$train$$, $$test$$))')}, 9) AS auc, false AS leaky",
)
def n4(spark, sf):
    d = split_orders(spark, sf)
    return rounded(L.separation_auc(d.filter("split = 'train'"), d.filter("split = 'test'"), ["o_totalprice"], []), 9)


@query("n5_unseen_levels", "SELECT 'p_type' AS feature, p_type AS value FROM part WHERE p_type NOT IN (SELECT p_type FROM part WHERE p_type <> 'ECONOMY') GROUP BY p_type")
def n5(spark, sf):
    p = table(spark, sf, "part")
    return L.unseen_levels(p.filter("p_type <> 'ECONOMY'"), p, ["p_type", "p_brand"])


@query("n6_timestamp_auc", f"SELECT round({auc_sql('o_orderdate', 'is_f', LEAK)}, 9) AS auc, false AS leaky")
def n6(spark, sf):
    return rounded(L.timestamp_auc(leaky(spark, sf), "o_orderdate", "is_f"), 9)


@query("n6_future_ratio", "SELECT round(avg(CASE WHEN l_shipdate > o_orderdate THEN 1.0 ELSE 0.0 END)::DOUBLE, 9) AS future_ratio FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def n6f(spark, sf):
    j = table(spark, sf, "lineitem").join(orders(spark, sf), F.col("l_orderkey") == F.col("o_orderkey"))
    return rounded(L.future_ratio(j, "l_shipdate", "o_orderdate"), 9)


# Scores to evaluate: a rule on the price stands for a model.
PRED = """(SELECT o_orderkey, o_orderpriority AS grp, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y, least(o_totalprice / 500000, 1.0) AS p,
  CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END AS yhat, o_orderstatus AS label, CASE WHEN o_totalprice > 300000 THEN 'F' WHEN o_totalprice > 100000 THEN 'O' ELSE 'P' END AS pred, o_totalprice AS price, o_totalprice * 0.9 + 1000 AS est FROM orders)"""


def scored(spark, sf):
    t = F.col("o_totalprice")
    return orders(spark, sf).select(
        "o_orderkey",
        F.col("o_orderpriority").alias("grp"),
        (F.col("o_orderstatus") == "F").cast("int").alias("y"),
        F.least(t / 500000, F.lit(1.0)).alias("p"),
        (t > 250000).cast("int").alias("yhat"),
        F.col("o_orderstatus").alias("label"),
        F.when(t > 300000, "F").when(t > 100000, "O").otherwise("P").alias("pred"),
        t.alias("price"),
        (t * 0.9 + 1000).alias("est"),
    )


@query(
    "o6_classification_metrics",
    f"""WITH l AS (SELECT DISTINCT label AS v FROM {PRED} UNION SELECT DISTINCT pred FROM {PRED}),
    c AS (SELECT v, count(*) FILTER (label = v AND pred = v)::DOUBLE AS tp, count(*) FILTER (label = v)::DOUBLE AS s, count(*) FILTER (pred = v)::DOUBLE AS d FROM l, {PRED} GROUP BY 1),
    m AS (SELECT *, coalesce(tp / nullif(d, 0), 0) AS pr, coalesce(tp / nullif(s, 0), 0) AS re FROM c), f AS (SELECT *, coalesce(2 * pr * re / nullif(pr + re, 0), 0) AS f1 FROM m)
    SELECT round(sum(tp) / sum(s), 9) AS accuracy, round(avg(pr), 9) AS precision_macro, round(avg(re), 9) AS recall_macro, round(avg(f1), 9) AS f1_macro, round(sum(pr * s) / sum(s), 9) AS precision_weighted,
    round(sum(re * s) / sum(s), 9) AS recall_weighted, round(sum(f1 * s) / sum(s), 9) AS f1_weighted, round(max(f1) FILTER (v = 'F'), 9) AS f1_binary FROM f""",
)
def o6(spark, sf):
    return rounded(V.classification_metrics(scored(spark, sf), "label", "pred", "F"), 9)


@query("o6_log_loss", f"SELECT round(avg(-CASE WHEN y = 1 THEN ln(greatest(least(p, 1 - 1e-15), 1e-15)) ELSE ln(1 - greatest(least(p, 1 - 1e-15), 1e-15)) END), 6) AS log_loss FROM {PRED}")
def o6l(spark, sf):
    return rounded(V.log_loss(scored(spark, sf), "y", "p"))


@query("o7_regression_metrics", f"SELECT round(avg(abs(price - est)), 3) AS mae, round(avg(pow(price - est, 2)) / 1e6, 3) AS mse, round(sqrt(avg(pow(price - est, 2))), 3) AS rmse, round(1 - avg(pow(price - est, 2)) / var_pop(price), 9) AS r2, round(avg(abs(price - est) / abs(price)), 9) AS mape FROM {PRED}")
def o7(spark, sf):
    m = V.regression_metrics(scored(spark, sf), "price", "est")
    return m.select(F.round("mae", 3).alias("mae"), F.round(F.col("mse") / 1e6, 3).alias("mse"), F.round("rmse", 3).alias("rmse"), F.round("r2", 9).alias("r2"), F.round("mape", 9).alias("mape"))


def _metric_rows(*names):
    made = ", ".join(f"{{'metric': '{n}', 'model': {n}_model, 'baseline': {n}_base}}" for n in names)
    return f"SELECT r.metric AS metric, round(r.model, 3) AS model, round(r.baseline, 3) AS baseline, round(r.model - r.baseline, 3) AS delta FROM (SELECT unnest([{made}]) AS r FROM w)"


@query(
    "o8_improvement",
    f"""WITH b AS (SELECT avg(price) AS m FROM {PRED}), v AS (SELECT avg(abs(price - est)) AS mae_model, avg(abs(price - m)) AS mae_base, avg(pow(price - est, 2)) AS mse_model, avg(pow(price - m, 2)) AS mse_base,
    var_pop(price) AS v, avg(abs(price - est) / abs(price)) AS mape_model, avg(abs(price - m) / abs(price)) AS mape_base FROM {PRED}, b),
    w AS (SELECT *, sqrt(mse_model) AS rmse_model, sqrt(mse_base) AS rmse_base, 1 - mse_model / v AS r2_model, 1 - mse_base / v AS r2_base FROM v)
    {_metric_rows("mae", "mse", "rmse", "r2", "mape")}""",
)
def o8(spark, sf):
    d = scored(spark, sf)
    d = d.withColumn("base", d.agg(F.avg("price")).scalar())
    return rounded(rounded(V.improvement(d, "price", "est", "base"), 3).select("metric", *[(F.col(c) + 0.0).alias(c) for c in ("model", "baseline", "delta")]), 3)


@query(
    "o9_binary_rates",
    f"""SELECT count(*) FILTER (y = 1 AND yhat = 1) AS tp, count(*) FILTER (y = 0 AND yhat = 1) AS fp, count(*) FILTER (y = 0 AND yhat = 0) AS tn, count(*) FILTER (y = 1 AND yhat = 0) AS fn,
    round(count(*) FILTER (y = 1 AND yhat = 1) / count(*) FILTER (y = 1), 9) AS sensitivity, round(count(*) FILTER (y = 0 AND yhat = 0) / count(*) FILTER (y = 0), 9) AS specificity FROM {PRED}""",
)
def o9(spark, sf):
    return rounded(V.binary_rates(scored(spark, sf), "y", "yhat"), 9)


@query(
    "o10_roc_points",
    f"""SELECT p AS threshold, tp, fp, round(tp / (SELECT sum(y) FROM {PRED}), 9) AS tpr, round(fp / (SELECT sum(1 - y) FROM {PRED}), 9) AS fpr, round(tp / (tp + fp), 9) AS precision FROM
    (SELECT p, sum(sum(y)) OVER (ORDER BY p DESC)::DOUBLE AS tp, sum(sum(1 - y)) OVER (ORDER BY p DESC)::DOUBLE AS fp FROM {PRED} GROUP BY p)""",
)
def o10(spark, sf):
    return rounded(V.roc_points(scored(spark, sf), "y", "p"), 9, skip=["threshold"])


@query("o10_auc", f"SELECT round({auc_sql('p', 'y', PRED)}, 9) AS auc")
def o10a(spark, sf):
    return rounded(V.auc(scored(spark, sf), "y", "p"), 9)


@query(
    "o10_average_precision",
    f"SELECT round(sum(k * tp / (tp + fp)) / sum(k), 9) AS average_precision FROM (SELECT sum(y) AS k, sum(sum(y)) OVER (ORDER BY p DESC)::DOUBLE AS tp, sum(sum(1 - y)) OVER (ORDER BY p DESC)::DOUBLE AS fp FROM {PRED} GROUP BY p)",
)
def o10p(spark, sf):
    return rounded(V.average_precision(scored(spark, sf), "y", "p"), 9)


@query(
    "o11_threshold_sweep",
    " UNION ALL ".join(
        f"""SELECT {t}::DOUBLE AS threshold, count(*) FILTER (y = 1 AND p > {t}) AS tp, count(*) FILTER (y = 0 AND p > {t}) AS fp, count(*) FILTER (y = 0 AND p <= {t}) AS tn, count(*) FILTER (y = 1 AND p <= {t}) AS fn,
    round(count(*) FILTER ((y = 1) = (p > {t})) / count(*), 9) AS accuracy FROM {PRED}"""
        for t in (0.5, 0.6)
    ),
)
def o11(spark, sf):
    return rounded(V.threshold_sweep(scored(spark, sf), "y", "p"), 9)


@query("o12_calibration", f"SELECT CAST(least(floor(p * 10), 9) AS INTEGER) AS bin, count(*) AS n, round(avg(p), 9) AS mean_predicted, round(avg(y), 9) AS observed_rate FROM {PRED} GROUP BY 1")
def o12(spark, sf):
    return rounded(V.calibration(scored(spark, sf), "y", "p"), 9)


@query("o12_brier", f"SELECT round(avg(pow(p - y, 2)), 9) AS brier FROM {PRED}")
def o12b(spark, sf):
    return rounded(V.brier(scored(spark, sf), "y", "p"), 9)


@query(
    "o12_group_rates",
    f"SELECT grp, count(*) AS n, round(avg(yhat), 9) AS selection_rate, round(avg(yhat) FILTER (y = 1), 9) AS tpr, round(avg(yhat) FILTER (y = 0), 9) AS fpr FROM {PRED} GROUP BY 1",
)
def o12g(spark, sf):
    return rounded(V.group_rates(scored(spark, sf), "grp", "y", "yhat"), 9)


@query(
    "o14_promotion_gate",
    f"""WITH a AS (SELECT avg((y = yhat)::INT) AS acc FROM {PRED}), r AS (SELECT list_filter([CASE WHEN acc < 0.9 THEN 'train accuracy below limit' END, CASE WHEN acc < 0.9 THEN 'test accuracy below limit' END,
    'check failed: fresh', CASE WHEN 1 - acc > 0.1 THEN 'train accuracy dropped' END, CASE WHEN 1 - acc > 0.05 THEN 'test accuracy dropped' END], lambda x: x IS NOT NULL) AS reasons FROM a)
    SELECT len(reasons) = 0 AS promote, reasons FROM r""",
)
def o14(spark, sf):
    d = scored(spark, sf)
    acc = d.agg(F.avg((F.col("y") == F.col("yhat")).cast("double"))).first()[0]
    return V.promotion_gate({"train": acc, "test": acc}, {"no_duplicates": True, "fresh": False}, spark, {"train": 1.0, "test": 1.0})


@query("o16_align_schema", f"SELECT p AS p, price AS price, 7.5::DOUBLE AS absent FROM {PRED}")
def o16(spark, sf):
    return V.align_schema(scored(spark, sf), ["p", "price", "absent"], {"absent": 7.5})


@query("o17_frame_difference", "SELECT 'right_only' AS side, count(*) AS n FROM orders WHERE o_orderkey % 50 = 0")
def o17(spark, sf):
    o = orders(spark, sf)
    return V.frame_difference(o, o.unionByName(o.filter(F.col("o_orderkey") % 50 == 0)))


@query("o18_residuals", f"SELECT o_orderkey, round(price - est, 4) AS residual FROM {PRED}")
def o18(spark, sf):
    return V.residuals(scored(spark, sf), "price", "est").select("o_orderkey", F.round("residual", 4).alias("residual"))
