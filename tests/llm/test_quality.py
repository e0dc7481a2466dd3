import random

import numpy as np
from pyspark.sql import functions as F

from tabwright.llm import quality


def test_em_finds_accuracies():
    rng = random.Random(2)
    rates = [(0.7, 0.02), (0.5, 0.05), (0.6, 0.01)] * 3  # chance of a "bad" vote for bad and good documents
    counts, truth = {}, []
    for _ in range(20_000):
        good = rng.random() < 0.85
        key = "".join("-" if rng.random() < 0.2 else "0" if rng.random() < r[good] else "1" for r in rates)
        counts[key] = counts.get(key, 0) + 1
        truth.append((good, key))
    prior, table = quality.fit_labellers(counts)
    assert abs(prior - 0.85) < 0.02
    assert all(abs(table[0, m, 0] - bad) < 0.06 and abs(table[1, m, 0] - good) < 0.02 for m, (bad, good) in enumerate(rates))
    assert np.mean([(quality.posterior(k, prior, table) > 0.5) == g for g, k in truth]) > 0.95
    assert quality.fit_labellers({})[0] == 0.8


def test_features_of_long_text_match_short_pieces():
    text = b"abcd " * 40_000
    slots, vals = quality.hashed_grams(text, 0, 512)
    assert abs((vals**2).sum() - 1) < 1e-9 and len(slots) <= 5
    assert quality.hashed_grams(b"abc", 0, 512)[0].size == 0


def test_labels_of_documents(spark, sf):
    sf = sf.replace("0.001", "0.01")
    got = quality.classify(spark.read.parquet(f"{sf}/documents.parquet"))
    seen = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").groupBy("quality").agg(F.avg(F.col("keep").cast("int")).alias("kept")).collect()
    kept = {r.quality: r.kept for r in seen}
    assert kept[1] > 0.98 and kept[0] < 0.1


def test_corner_cases(spark, docs_of):
    prose = "It was a fine day and nobody thought of rain. " * 4
    rows = [(i, f"{prose} Number {i} here.") for i in range(30)] + [(i, f"{'SPAM!! ' * 40}{i}") for i in range(30, 36)]
    rows += [(90, None), (91, ""), (92, " \n "), (None, prose), (93, prose), (93, prose), (94, "word " * 50_000)]
    df = docs_of(rows, ", votes string, score double")
    got = {r.doc_id: r for r in quality.classify(df).collect()}
    assert len(quality.classify(df).collect()) == len(rows)
    for i in (90, 91, 92):
        assert (got[i].score, got[i].posterior, got[i].keep) == (0.0, 0.0, False)
    assert all(got[i].keep for i in range(30)) and not any(got[i].keep for i in range(30, 36)) and not got[94].keep
    wide = quality.classify(df, keep_columns=True)
    assert set(df.columns) < set(wide.columns)
    assert quality.classify(df.limit(0)).collect() == []
