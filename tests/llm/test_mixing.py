import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwright.llm import mixing

LABELS = "doc_id long, quality int, toxic int"


def corpus(n=300, seed=1):
    rng = random.Random(seed)
    kinds = {"clean": [f"calm{i}" for i in range(30)], "toxic": [f"rude{i}" for i in range(30)], "junk": [f"spam{i}" for i in range(30)]}
    rows, labels = [], []
    for i in range(n):
        d = rng.choices(list(kinds), [0.7, 0.1, 0.2])[0]
        rows.append((i, " ".join(rng.choice(kinds[d]) + rng.choice("abcdef") for _ in range(rng.randint(20, 80)))))
        if i % 2:
            labels.append((i, int(d != "junk"), int(d == "toxic")))
    return rows, labels


def totals(df, domains):
    got = df.agg(*[F.sum(F.col("rate") * F.col("n_tokens") * F.col(f"p_{d}")).alias(d) for d in domains], F.sum("n_tokens").alias("n")).first()
    return [got[d] for d in domains], got["n"]


def test_totals_meet_targets(spark, docs_of):
    rows, labels = corpus()
    labelled = mixing.label_domains(spark.createDataFrame(labels, LABELS))
    targets = {"clean": 0.5, "junk": 0.1, "toxic": 0.4}
    df = mixing.rates(docs_of(rows, ", domain string, rate double"), labelled, targets)
    have, n = totals(df, targets)
    assert n == sum(len(t.split()) for _, t in rows)
    assert all(abs(h - n * w) < 1e-3 * n for h, w in zip(have, targets.values(), strict=True))
    assert df.filter("rate < 0").count() == 0 and df.filter("abs(p_clean + p_junk + p_toxic - 1) > 1e-9").count() == 0


def test_rates_against_local_least_squares(spark):
    """The steps, followed in plain Python over all rows, give the totals and rates that Spark gives, with some rates at 0."""
    rng = random.Random(4)
    rows = []
    for i in range(400):
        p = [rng.random() ** 6 for _ in range(3)]
        rows.append((i, rng.randint(1, 500), [x / sum(p) for x in p]))
    df = spark.createDataFrame(rows, "id long, n_tokens long, p array<double>")
    size = sum(r[1] for r in rows)
    targets = [0.05 * size, 0.05 * size, 0.9 * size]
    steps = mixing.fit_rates(df, targets)
    got = {r.id: r.r for r in df.select("id", mixing.rate_of(F.col("p"), steps).alias("r")).collect()}
    rate = dict.fromkeys(got, 1.0)
    for s in steps:
        rate = {i: max(0.0, rate[i] - sum(a * b for a, b in zip(p, s, strict=True))) for i, _, p in rows}
    assert all(math.isclose(rate[i], got[i], abs_tol=1e-9) for i in rate) and min(rate.values()) == 0
    have = [sum(rate[i] * n * p[k] for i, n, p in rows) for k in range(3)]
    assert all(abs(h - t) < 1e-4 * size for h, t in zip(have, targets, strict=True))


def test_classifier_on_held_out_labels(spark, docs_of):
    rows, labels = corpus(600)
    labelled = mixing.label_domains(spark.createDataFrame(labels, LABELS))
    got = mixing.rates(docs_of(rows), labelled.filter("doc_id < 300"), {"clean": 1.0, "junk": 1.0, "toxic": 1.0})
    best = got.select("doc_id", F.expr("CASE greatest(p_clean, p_junk, p_toxic) WHEN p_clean THEN 'clean' WHEN p_junk THEN 'junk' ELSE 'toxic' END").alias("best"))
    rest = best.join(labelled.filter("doc_id >= 300"), "doc_id")
    assert rest.filter("best = domain").count() > 0.95 * rest.count()


def test_mixed_thins_out_what_is_in_surplus(spark, docs_of):
    rows, labels = corpus(400)
    table = spark.createDataFrame(labels, LABELS)
    kept = {r.doc_id for r in mixing.mixed(docs_of(rows), mixing.label_domains(table), {"clean": 0.98, "junk": 0.01, "toxic": 0.01}).collect()}
    clean = {i for i, t in rows if t.startswith("calm")}
    assert len(clean - kept) <= 0.02 * len(clean) and len(kept - clean) < 0.2 * (len(rows) - len(clean))


def blended(n, seed):
    """Texts of 5 to 4,000 words of one shared vocabulary; toxic ones have some rude words among them, junk has marks."""
    rng = random.Random(seed)
    common, rude = [f"w{i}x{i % 97}" for i in range(3000)], [f"rude{c}" for c in "abcdefgh"]
    rows, labels = [], []
    for i in range(n):
        d = rng.choices(["clean", "toxic", "junk"], [0.76, 0.11, 0.13])[0]
        words = [rng.choice(common) for _ in range(int(5 * 800 ** rng.random()))]
        if d == "toxic":
            words = [rng.choice(rude) if rng.random() < 0.03 else w for w in words] + [rng.choice(rude)]
        rows.append((i, " ".join(w + ("***" if d == "junk" else "") for w in words)))
        if rng.random() < 0.5:
            labels.append((i, int(d != "junk"), int(d == "toxic")))
    return rows, labels, {i: (d_, len(t.split())) for (i, t), d_ in zip(rows, ["junk" if "***" in t else "toxic" if "rude" in t else "clean" for _, t in rows], strict=True)}


def test_clean_documents_stay_at_any_length_and_size(spark, docs_of):
    for n in (500, 4000):
        rows, labels, kinds = blended(n, n)
        kept = {r.doc_id for r in mixing.mixed(docs_of(rows), mixing.label_domains(spark.createDataFrame(labels, LABELS)), {"clean": 0.94, "junk": 0.02, "toxic": 0.04}).collect()}
        for low, high in ((0, 100), (100, 1000), (1000, 5000)):
            clean = {i for i, (d, size) in kinds.items() if d == "clean" and low <= size < high}
            assert len(clean & kept) >= 0.95 * len(clean)
        assert sum(kinds[i][0] == "junk" for i in kept) <= 0.5 * sum(d == "junk" for d, _ in kinds.values())


def test_rates_against_an_independent_solver(spark):
    """With rates between 0 and 1 the totals come as near to unreachable targets as a long plain projected gradient in numpy brings them."""
    rng = np.random.default_rng(6)
    n, p = rng.integers(1, 500, 300).astype(float), rng.dirichlet([0.3, 0.3, 0.3], 300)
    targets = np.array([0.5, 0.01, 0.01]) * n.sum()
    df = spark.createDataFrame([(i, int(a), b.tolist()) for i, (a, b) in enumerate(zip(n, p, strict=True))], "id long, n_tokens long, p array<double>")
    with pytest.warns(UserWarning, match="miss their targets"):
        steps = mixing.fit_rates(df, targets.tolist(), most=1.0, rounds=200)
    got = np.array([r.r for r in df.select("id", mixing.rate_of(F.col("p"), steps, 1.0).alias("r")).orderBy("id").collect()])
    assert got.min() >= 0 and got.max() <= 1
    gram = (n[:, None, None] * p[:, :, None] * p[:, None, :]).sum(axis=0)
    rate = np.ones(300)
    for _ in range(20_000):
        rate = np.clip(rate - p @ ((rate * n) @ p - targets) / np.trace(gram), 0, 1)
    best = np.square((rate * n) @ p - targets).sum()
    assert np.square((got * n) @ p - targets).sum() <= 1.05 * best + 1e-9


def test_posteriors_against_plain_python(spark, docs_of):
    """Levels of evidence and shares of a fitted model, followed in plain Python."""
    rows, labels, _ = blended(600, 2)
    docs = docs_of(rows)
    model = mixing.fit_model(docs, mixing.label_domains(spark.createDataFrame(labels, LABELS)), ["clean", "junk", "toxic"])
    got = docs.select("doc_id", mixing.signs(F.col("text"), mixing.words(F.col("text"))).alias("s"), mixing.membership(F.col("text"), model).alias("m")).collect()
    assert any(w for table in model.weights for w in table)
    for r in got:
        known = [h for h in r.s if model.signs[h % mixing.BUCKETS] == h]
        evidence = [sum(round(t[h % mixing.BUCKETS], 4) for h in known) for t in model.weights]
        order = sorted(evidence, reverse=True)
        ahead = order[0] - max(order[1], 0.0)
        level = 0 if ahead <= 0 else 1 + evidence.index(order[0]) * 4 + sum(ahead > x for x in mixing.LEVELS)
        assert [round(x, 12) for x in r.m.p] == [round(x, 12) for x in model.shares[level]]


def test_corner_cases(spark, docs_of):
    rows, labels = corpus(100)
    rows += [(900, None), (901, ""), (902, "..."), (None, "calm1a calm2b"), (3, rows[3][1]), (903, "calm3c " * 20_000)]
    table = spark.createDataFrame([*labels, (None, 1, 0), (5, None, None), (7, 0, 1)], LABELS).withColumn("text", F.lit("clash"))
    df = docs_of(rows, ", p string, domain string")
    got = mixing.rates(df, mixing.label_domains(table), {"clean": 0.8, "junk": 0.1, "toxic": 0.1}).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.n_tokens for r in got if (r.doc_id or 0) >= 900} == {900: 0, 901: 0, 902: 0, 903: 20_000}
    assert all(math.isfinite(r.rate) and r.rate >= 0 for r in got)
    nothing = mixing.label_domains(table).limit(0)
    assert len(mixing.rates(df, nothing, {"clean": 0.5, "toxic": 0.5}).collect()) == len(rows)
    assert mixing.rates(df.limit(0), nothing, {"clean": 0.5, "toxic": 0.5}).collect() == []
    assert mixing.mixed(df, nothing, {"clean": 0.5, "toxic": 0.5}).count() == len(rows)
    clash = docs_of(rows, ", membership string, __id string, __text string")
    assert mixing.mixed(clash, mixing.label_domains(table), {"clean": 0.8, "junk": 0.1, "toxic": 0.1}).columns == clash.columns
    assert mixing.mixed(df.limit(0), nothing, {"clean": 0.5, "toxic": 0.5}).collect() == []


def test_no_python_in_the_plan(spark, docs_of):
    rows, labels = corpus(40)
    df = mixing.mixed(docs_of(rows), mixing.label_domains(spark.createDataFrame(labels, LABELS)), {"clean": 0.9, "toxic": 0.1})
    plan = df._jdf.queryExecution().toString()
    assert "ArrowEval" not in plan and "MapInPandas" not in plan and "PythonUDF" not in plan
