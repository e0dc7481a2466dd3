"""Small frames with answers worked out by hand, properties of seeded operators, and corner cases."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.functions import special
from tabwright.operators import construct, distributions, drift, encode, evaluate, hypothesis, impute, matrix, models, outliers, profile, quality, reduce, scale, split_columns, splits
from tabwright.plans import ingestion, monitoring, profiling, training_prep
from tabwright.sources import readers, schema, sinks
from tabwright.streaming import detectors


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame(
        [(1, "a@x.com", "$10.00", "12345", "Yes"), (2, None, "$20.50", "54321", "No"), (2, "b@y.com", "$30.00", "11111", "Yes")],
        "id long, email string, amount string, zip string, flag string",
    )


def test_masking_duplicates_and_types(small):
    masked = [r["email"] for r in quality.mask_pii(small).collect()]
    assert masked == ["[email]", None, "[email]"]
    assert quality.duplicate_rows(small).first()[0] == 0
    assert quality.duplicate_rows(small, ["id"]).first()[0] == 1
    kinds = {r["feature"]: r["semantic_type"] for r in quality.semantic_profile(small).collect()}
    assert kinds["flag"] == "Boolean" and kinds["id"] == "Integer" and kinds["amount"] == "ID-like Field"
    assert [r["flag"] for r in quality.convert_semantic(small, quality.semantic_profile(small)).collect()] == [True, False, True]


def test_semantic_kinds(spark):
    rows = [(f"{i % 9 + 1}:30", f"2024-01-0{i % 9 + 1}", f"{i % 9 + 1} days", f"${i % 9 + 1},000.50", f"u{i % 9}@m.org", f"https://x.y/{i % 9}", '{"a": %d}' % (i % 9), f"1234{i % 9}-678{i % 9}", "x" * 60 + str(i % 9)) for i in range(60)]
    df = spark.createDataFrame(rows, "t string, d string, u string, c string, e string, w string, j string, z string, p string")
    kinds = {r["feature"]: r["semantic_type"] for r in quality.semantic_profile(df).collect()}
    assert kinds == {
        "t": "Time Only", "d": "Datetime", "u": "Duration / Timedelta", "c": "Currency", "e": "Email", "w": "URL", "j": "JSON / Dict-like", "z": "ZIP Code", "p": "Text Paragraph",
    }
    out = quality.convert_semantic(df, quality.semantic_profile(df)).first()
    assert out["c"] == 1000.5 and out["d"].year == 2024 and out["u"].days == 1


def test_nine_digits_stay(spark):
    df = spark.createDataFrame([("123456789 1234567890 me@a.bc",)], "t string")
    assert quality.mask_pii(df).first()[0] == "123456789 [phone] [email]"


def test_empty_guard(spark):
    with pytest.raises(ValueError):
        quality.require_rows(spark.createDataFrame([], "a int"))
    with pytest.raises(ValueError):
        readers.read_file(spark, "/tmp/x.bin")


@pytest.fixture(scope="module")
def gaps(spark):
    return spark.createDataFrame(
        [(1, 1.0, "x", None, "1"), (2, 2.0, None, None, "2"), (3, None, "y", None, None), (4, 4.0, "x", None, "4"), (5, 5.0, None, None, "5")],
        "k long, A double, B string, C double, D string",
    )


def test_imputation_by_hand(gaps):
    assert impute.high_null_columns(gaps, 0.8) == ["C"]
    assert dict(quality.cast_mixed_numeric(gaps).dtypes)["D"] == "double"
    assert impute.mean_fill(gaps, ["A"]).filter("k = 3").first()["A"] == 3.0
    assert [r["B"] for r in impute.mode_fill(gaps, ["B"]).orderBy("k").collect()] == ["x", "x", "y", "x", "x"]
    drawn = [r["A"] for r in impute.random_fill(gaps, "A", "k").orderBy("k").collect()]
    assert drawn[2] in (1.0, 2.0, 4.0, 5.0) and drawn[:2] == [1.0, 2.0]
    assert [r["C"] for r in impute.random_fill(gaps, "C", "k").collect()] == [0.0] * 5
    plan = impute.fit_plan(gaps, "k", max_null_share=0.8, rare_share=0.1)
    out = impute.apply_plan(gaps, plan, "k", gaps)
    assert "C" not in out.columns and out.filter("A IS NULL OR B IS NULL OR D IS NULL").count() == 0


def test_guide_frame(spark):
    df = spark.createDataFrame(
        [(25.0, 50000.0, "NY", 4.0), (None, 60000.0, "LA", None), (35.0, None, None, 3.0), (40.0, 80000.0, "NY", 5.0), (None, 90000.0, "SF", None), (45.0, None, "LA", 2.0)],
        "age double, income double, city string, rating double",
    )
    med = impute.column_medians(df, ["age", "income"])
    assert med == {"age": 37.5, "income": 70000.0}
    assert impute.column_means(df, ["rating"])["rating"] == 3.5
    assert quality.drop_incomplete(df).count() == 2


def test_encoders_by_hand(spark):
    cat2 = ["low", "low", "low", "low", "medium", "medium", "medium", "medium", "high", "high"]
    cat1 = ["a", "b", "c", "d", "e", "f", "a", "b", "c", "d"]
    df = spark.createDataFrame(list(zip(cat1, cat2, range(10))), "cat1 string, cat2 string, num long")
    r = {x["feature"]: x for x in encode.route_encoders(df, onehot=0.2, ordinal=0.5, frequency=0.8).collect()}
    assert (r["cat1"]["distinct_share"], r["cat2"]["distinct_share"]) == (0.6, 0.3)
    assert (r["cat1"]["tree"], r["cat2"]["tree"], r["cat1"]["linear"], r["cat2"]["linear"]) == ("frequency", "ordinal", "frequency", "frequency")
    f = {x["cat2"]: x["cat2_freq"] for x in encode.frequency_encode(df, "cat2").collect()}
    assert f == {"low": 0.4, "medium": 0.4, "high": 0.2}
    o = {x["cat2"]: x["cat2_ord"] for x in encode.ordinal_encode(df, "cat2").collect()}
    assert o == {"high": 0, "low": 1, "medium": 2}
    new = spark.createDataFrame([("zzz",)], "cat2 string")
    assert encode.frequency_encode(new, "cat2", encode.frequency_table(df, "cat2")).first()["cat2_freq"] == 0.0
    assert encode.ordinal_encode(new, "cat2", encode.ordinal_table(df, "cat2")).first()["cat2_ord"] == -1
    assert sum(encode.one_hot(new, ["cat2"], {"cat2": ["low", "high"]}).first()) == 0.0
    first = encode.ordered_target(df.withColumn("y", F.col("num") % 2), "cat2", "y", "num").orderBy("num").first()
    assert first["cat2_ord_te"] == 0.5


def test_fences_by_hand(spark):
    df = spark.createDataFrame([(float(v), 1.0) for v in [1, 2, 3, 4, 5, 6, 7, 8, 9, 1000]] , "a double, c double")
    row = {r["feature"]: r for r in outliers.fit_fences(df, ["a", "c"]).collect()}
    assert (row["a"]["q1"], row["a"]["q3"]) == (3.25, 7.75)
    counts = {(r["feature"], r["rule"]): r["n"] for r in outliers.rule_counts(df, outliers.fit_fences(df, ["a", "c"])).collect()}
    assert counts[("a", "iqr")] == 1 and counts[("c", "zscore")] == 0 and counts[("c", "modz")] == 0
    assert scale.global_scaler(df, ["a"]).first()["scaler"] == "robust"
    v = outliers.votes(df, outliers.fit_fences(df, ["a", "c"]))
    assert v.filter(F.col("total_votes") != F.col("iqr") + F.col("zscore") + F.col("modz") + F.col("tukey") + F.col("percentile")).count() == 0


def test_multivariate_detectors_find_a_planted_point(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (400, 3))
    x[7] = [9, -9, 9]
    df = spark.createDataFrame(pd.DataFrame({"id": range(400), "a": x[:, 0], "b": x[:, 1], "c": x[:, 2]})).cache()
    assert outliers.mahalanobis(df, ["a", "b", "c"]).filter("id = 7").first()["is_outlier"]
    assert outliers.robust_mahalanobis(df, ["a", "b", "c"]).filter("id = 7").first()["is_outlier"]
    assert outliers.local_outliers(df, ["a", "b", "c"], "id").filter("id = 7").first()["is_outlier"]
    assert outliers.isolation_outliers(df, ["a", "b", "c"], "id").filter("id = 7").first()["is_outlier"]
    method, flagged = outliers.multivariate_outliers(df, ["a", "b", "c"], "id", local=True)
    # The planted point alone lifts every column's kurtosis above the Gaussian limit.
    assert method == "lof" and flagged.filter("id = 7").first()["is_outlier"]
    assert outliers.component_outliers(df, ["a", "b", "c"], 3).filter("id = 7").first()["is_outlier"]


def test_mice_keeps_observed_cells_and_uses_the_others(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(0, 1, 300)
    pdf = pd.DataFrame({"id": range(300), "a": a, "b": 3 * a + rng.normal(0, 0.1, 300)})
    pdf.loc[::5, "b"] = np.nan
    out = impute.mice_fill(spark.createDataFrame(pdf), ["a", "b"], "id", rounds=2).toPandas().sort_values("id")
    seen = pdf["b"].notna()
    assert np.allclose(out["b"][seen.to_numpy()], pdf["b"][seen])
    assert np.abs(out["b"].to_numpy() - 3 * a)[~seen.to_numpy()].max() < 0.6


def test_knn_fill_by_hand(spark):
    df = spark.createDataFrame([(1, 1.0, 10.0), (2, 1.1, 20.0), (3, 9.0, 90.0), (4, 1.05, None)], "id long, x double, y double")
    assert impute.knn_fill(df, ["x", "y"], "id", 2).filter("id = 4").first()["y"] == 15.0


def test_power_and_quantile_transforms(spark):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame(pd.DataFrame({"x": np.exp(rng.normal(0, 1, 2000))}))
    assert abs(scale.best_lambda(df, ["x"], "boxcox")["x"]) < 0.1
    y = scale.power_transform(df, ["x"], "yeo").toPandas()["x"]
    assert abs(y.mean()) < 1e-9 and abs(y.std(ddof=0) - 1) < 1e-9 and abs(y.skew()) < 0.3
    z = scale.quantile_transform(df, ["x"]).toPandas()["x"]
    assert abs(z.skew()) < 0.1 and abs(z.median()) < 0.05
    plan = scale.fit_plan(df, ["x"])
    a, b = scale.apply_plan(df, plan).toPandas()["x"], scale.apply_plan(df, plan).toPandas()["x"]
    assert np.allclose(a, b)


def test_splits_are_exact_and_disjoint(spark):
    df = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 10 == 0, "rare").otherwise("common").alias("y"))
    out = splits.stratified_split(df, "id", "y")
    got = {(r["y"], r["split"]): r["count"] for r in out.groupBy("y", "split").count().collect()}
    assert got == {("rare", "train"): 80, ("rare", "val"): 10, ("rare", "test"): 10, ("common", "train"): 720, ("common", "val"): 90, ("common", "test"): 90}
    assert splits.overlap(out.filter("split = 'train'"), out.filter("split = 'test'"), ["id"]).count() == 0
    folds = splits.kfold(df, "id", 5, "y").groupBy("fold", "y").count().collect()
    assert {r["count"] for r in folds} == {20, 180}


def test_drift_of_a_sample_with_itself_is_zero(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    cols = ["l_quantity", "l_extendedprice"]
    assert all(abs(r["psi"]) < 1e-12 for r in drift.psi(li, li, cols).collect())
    ks = drift.ks_two_sample(drift.sided(li, li, cols), "value", "side", ["feature"]).collect()
    assert all(r["statistic"] == 0 and not r["drift"] for r in ks)
    assert all(abs(r["wasserstein"]) < 1e-9 for r in drift.wasserstein(drift.sided(li, li, cols), "value", "side", ["feature"]).collect())
    assert abs(drift.mmd(li, li, cols, 16).first()[0]) < 1e-12


def test_monitoring_plans(spark, sf, tmp_path):
    li = spark.read.parquet(f"{sf}/lineitem.parquet").select("l_quantity", "l_extendedprice", "l_returnflag")
    moved = li.withColumn("l_extendedprice", F.col("l_extendedprice") * 3)
    monitoring.save_reference(li, ["l_quantity", "l_extendedprice"], str(tmp_path))
    got = {r["feature"]: r["drift"] for r in monitoring.check_against(spark, moved, str(tmp_path)).collect()}
    assert got == {"l_quantity": False, "l_extendedprice": True}
    report, decision = monitoring.monitor(li, moved, str(tmp_path / "hist"), "r1")
    assert {r["feature"] for r in report.filter("drift").collect()} == {"l_extendedprice"}
    assert decision.first()["retrain"]
    _, calm = monitoring.monitor(li, li)
    assert not calm.first()["retrain"]


def test_training_preparation(spark, sf, tmp_path):
    o = spark.read.parquet(f"{sf}/orders.parquet").select("o_orderkey", "o_totalprice", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_custkey").cast("double")).alias("cust"), "o_orderpriority", "o_orderstatus")
    parts, fitted = training_prep.prepare(o, "o_orderkey", "o_orderstatus")
    assert sum(p.count() for p in parts.values()) == o.count()
    assert parts["test"].filter("cust IS NULL").count() == 0 and "o_orderpriority_1-URGENT" in parts["val"].columns
    fitted.save(str(tmp_path))
    again = training_prep.Preparation.load(spark, str(tmp_path), "o_orderkey", fitted.donors)
    raw = splits.stratified_split(o, "o_orderkey", "o_orderstatus").filter("split = 'test'").drop("split")
    assert evaluate.frame_difference(parts["test"], again.apply(raw)).count() == 0


def test_profile_and_ingest_plans(spark, sf, small):
    reports = profiling.profile_table(spark.read.parquet(f"{sf}/customer.parquet"), "c_mktsegment")
    assert all(r.count() > 0 for n, r in reports.items() if n not in ("cramers_v", "theils_u"))
    clean, made = ingestion.ingest(small, suite=[quality.Expectation("not_null", "email")])
    assert clean.count() == 3 and not made["expectations"].first()["success"]


def test_sources_and_sinks(spark, small, tmp_path):
    sinks.write_snapshot(small, f"{tmp_path}/s.parquet")
    assert readers.read_file(spark, f"{tmp_path}/s.parquet").count() == 3
    small.write.option("header", True).option("sep", "\t").csv(f"{tmp_path}/s.tsv")
    assert readers.read_file(spark, f"{tmp_path}/s.tsv").columns == small.columns
    (tmp_path / "m.tsv").write_text("!remark\n!more\nID\tS1\tS2\np1\t1.5\t2.5\n")
    assert readers.read_commented_tsv(spark, f"{tmp_path}/m.tsv").first()["S2"] == 2.5
    (tmp_path / "p.json").write_text('{"a": {"b": 1, "c": {"d": "x"}}, "e": [1, 2]}\n')
    assert readers.read_json_payload(spark, f"{tmp_path}/p.json").columns == ["a.b", "a.c.d", "e"]
    want = T.StructType([T.StructField("id", T.LongType(), False), T.StructField("email", T.StringType(), False)])
    ok, bad = schema.enforce_schema(small, want)
    assert ok.count() == 2 and bad.first()["reject_reason"] == "email:null"
    page = sinks.render_html(profile.health_report(small, "flag"))
    assert "<table>" in page and "missingness" in page


def test_special_functions():
    assert special.chi2_sf(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-12)
    assert special.t_sf2(2.2281388519649385, 10) == pytest.approx(0.05, abs=1e-10)
    assert special.f_sf(3.492828476735633, 2, 20) == pytest.approx(0.05, abs=1e-9)
    assert special.norm_ppf(0.975) == pytest.approx(1.959963984540054)
    assert special.chi2_ppf(0.975, 3) == pytest.approx(9.348403604496145)
    assert special.digamma(1.0) == pytest.approx(-0.5772156649015329)
    assert special.trigamma(1.0) == pytest.approx(np.pi**2 / 6)


def test_distribution_fits(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"g": rng.gamma(3.0, 2.0, 3000), "n": rng.normal(5, 2, 3000), "w": 2.0 * rng.weibull(1.7, 3000), "b": rng.beta(2, 5, 3000), "t": rng.standard_t(3, 3000)})
    df = spark.createDataFrame(pdf).cache()
    fits = {(r["feature"], r["family"]): r["parameters"] for r in distributions.fit_families(df, list(pdf.columns)).collect()}
    assert fits[("g", "gamma")] == pytest.approx([3.0, 2.0], rel=0.12)
    assert fits[("n", "norm")] == pytest.approx([5.0, 2.0], rel=0.05)
    assert fits[("w", "weibull_min")] == pytest.approx([1.7, 2.0], rel=0.06)
    assert fits[("b", "beta")] == pytest.approx([2.0, 5.0], rel=0.12)
    assert fits[("t", "t")][0] == 3.0
    best = {r["feature"]: r for r in distributions.best_fit(df, ["n", "w"]).collect()}
    assert best["w"]["ks"] < 0.03 and best["n"]["ks_p"] > 0.05


def test_bootstrap_brackets_the_estimates(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(10, 3, 900)
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    a, b = hypothesis.bootstrap_ci(df).first(), hypothesis.bootstrap_ci(df).first()
    assert a == b
    assert a["mean_lower"] < x.mean() < a["mean_upper"] and a["mean_upper"] - a["mean_lower"] == pytest.approx(2 * 1.96 * x.std() / 30, rel=0.15)
    assert a["median_lower"] < np.median(x) < a["median_upper"]


def test_projections(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(0, 1, (400, 2))
    x = base @ rng.normal(0, 1, (2, 5)) + rng.normal(0, 0.01, (400, 5))
    y = (base[:, 0] > 0).astype(int)
    cols = [f"x{i}" for i in range(5)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=cols).assign(id=range(400), y=y, t=base[:, 0] * 2 + 1)).cache()
    p = reduce.pca(df, cols)
    assert p.weights.shape[1] <= 2 and p.explained >= 0.9
    assert reduce.reconstruction_error(df, reduce.pca(df, cols, 0.9999)) < 0.01
    z = reduce.discriminant(df, cols, "y").transform(df, ["y"]).toPandas()
    assert abs(z.groupby("y")["LDA_C1"].mean().diff().iloc[-1]) > 1.2 * z["LDA_C1"].std()
    s = reduce.pls(df, cols, "t", 2).transform(df, ["t"]).toPandas()
    assert abs(s["PLS_C1"].corr(s["t"])) > 0.5
    sv = reduce.truncated_svd(df, cols, 2)
    want = np.linalg.svd(x)[2][:2]
    assert np.allclose(np.abs(sv.weights.T @ want.T), np.eye(2), atol=1e-6)
    many, cov, n = reduce.moments(df, cols)
    assert n == 400 and np.allclose(cov, np.cov(x.T, ddof=0))


def test_combat_removes_the_offset(spark):
    rng = np.random.default_rng(10)
    rows = [(f, s, s % 3, float(rng.normal(f, 1) + (s % 3) * 2)) for f in range(30) for s in range(60)]
    df = spark.createDataFrame(rows, "feature int, sample int, batch int, value double")
    out = matrix.combat(df).groupBy("batch").agg(F.avg("value").alias("m")).toPandas()["m"]
    assert out.max() - out.min() < 0.1
    raw = df.groupBy("batch").agg(F.avg("value").alias("m")).toPandas()["m"]
    assert raw.max() - raw.min() > 3.5


def test_text_splits(spark):
    df = spark.createDataFrame([("<b>Ab</b>12-x",), ("q",)], "t string")
    row = split_columns.split_mixed(df, "t").collect()
    assert row[0]["t_alpha_0"] == "Ab" and row[0]["t_digits_0"] == "12" and row[1]["t_digits_0"] == ""
    x = spark.createDataFrame([("<a>1</a><a>2</a>",)], "d string")
    assert split_columns.flatten_xml(x, "d").first()["d_a"] == "2"
    c = spark.createDataFrame([("see #fff now",), ("none",)], "s string")
    out = split_columns.extract_colour(c, "s").collect()
    assert (out[0]["s_colour"], out[0]["s_r"], out[1]["s_colour"]) == ("#fff", 255, None)
    assert construct.minhash(df, "t").filter("size(t_minhash) = 128").count() == 2


def test_models_and_importance(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(0, 1, (300, 2))
    df = spark.createDataFrame(pd.DataFrame({"id": range(300), "a": x[:, 0], "b": x[:, 1], "y": (x[:, 0] > 0).astype(int)})).cache()
    imp = {r["feature"]: r["importance"] for r in models.permutation_importance(df, ["a", "b"], "y", "id", repeats=1, family="decision_tree").collect()}
    assert imp["a"] > 0.3 and abs(imp["b"]) < 0.05
    fitted = models.train(df, ["a", "b"], "y", "logistic")
    assert evaluate.classification_metrics(models.score(df, fitted, ["a", "b"]), "label", "prediction").count() == 1


def test_sequential_detectors_agree_with_the_batch_form(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet")
    got = drift.page_hinkley(ev.select("event_id", "ts", "value"), "value", "ts", "event_id").toPandas().sort_values(["ts", "event_id"])
    step, m = detectors.page_hinkley_step(0.005, 50.0), {"n": 0, "mean": 0.0, "sum": 0.0, "low": 0.0}
    want = []
    for v in got["value"]:
        m, stat, _ = step(m, v)
        want.append(stat)
    assert np.allclose(got["ph"], want)
    step, m, hits = detectors.adaptive_window_step(0.002), {"b": []}, []
    for v in [0.0] * 300 + [1.0] * 300:
        m, _, hit = step(m, v)
        hits.append(hit)
    assert not any(hits[:300]) and any(hits[300:350])


@pytest.mark.parametrize("case", ["no_numbers", "all_missing", "one_row"])
def test_corner_cases(spark, case):
    frames = {
        "no_numbers": spark.createDataFrame([("a", "x"), ("b", "y")], "s string, u string"),
        "all_missing": spark.createDataFrame([(None, None, 1), (None, None, 2)], "s string, x double, k long"),
        "one_row": spark.createDataFrame([("a", 1.0, 1)], "s string, x double, k long"),
    }
    df = frames[case]
    for report in profile.health_report(df).values():
        report.collect()
    quality.semantic_profile(df).collect()
    profile.basic_profile(df).collect()
    if case != "no_numbers":
        outliers.fit_fences(df, ["x"]).collect()
        impute.mean_fill(df, ["x"]).collect()
        impute.random_fill(df, "x", "k").collect()
        scale.scale(df, ["x"], "standard").collect()
        hypothesis.normality(df, ["x"]).collect()
