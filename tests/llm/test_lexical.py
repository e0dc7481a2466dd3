import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from tabwright.llm import lexical, queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def words(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k=10):
    held = [(i, Counter(words(t))) for i, t in docs if words(t)]
    n, length = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(words(t))
    out = []
    for item, ts in asked.items():
        scored = []
        for i, c in held:
            m = 10 + (90 * sum(c.values()) * n) // length
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in ts if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(str(item), r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def found(df, items, **kw):
    return sorted(((str(r.item_id), r["rank"], r.doc_id, r.score) for r in lexical.ranked(df, items, **kw).collect()), key=str)


def test_whole_tables(spark, sf):
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet").collect() for t in ("documents", "benchmark"))
    want = brute([(r.doc_id, r.text) for r in docs], [(r.item_id, r.text) for r in items])
    got = queries.op11_lexical(spark, sf)
    assert sorted(((str(r.item_id), r["rank"], r.doc_id, r.score) for r in got.collect()), key=str) == want
    assert dict(got.dtypes)["rank"] == "int" and dict(got.dtypes)["score"] == "bigint"


def test_corner_cases(spark):
    rng = random.Random(11)
    bag = [f"w{i}" for i in range(90)] + ["É", "ÀB", "a_b", "x\ty", "C3PO"]
    docs = [(i, " ".join(rng.choices(bag, k=rng.randint(1, 60)))) for i in range(300)]
    docs += [(400 + i, "same words in all copies W1") for i in range(40)] + [(7, "w1 w2"), (7, "w1 w2"), (None, "w1 w2 w3"), (None, "w1 w2 w3")]
    docs += [(500, None), (501, ""), (502, " .,;\x00"), (503, "w5 " * 20000), (504, " w1　w2")]
    items = [(0, "w1 w2 w3 W1"), (1, None), (2, "..."), (3, " ".join(bag)), (4, "same copies"), (5, "absent words"), (None, "w7 w8"), (6, "w1"), (6, "w9 É")]
    items += [(8, " ".join(f"w{i} v{i}" for i in range(80)))]  # more than 64 terms
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5).withColumn("id", F.lit("x")).withColumn("n", F.lit(1)).withColumn("rank", F.lit(1))
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("term", F.lit(1)).withColumn("item", F.lit(1))
    want = brute(docs, items)
    assert found(df, asked) == want
    assert found(df, asked, block=17, pairs=40) == want
    assert found(df, asked, k=3) == brute(docs, items, 3)
    assert found(df.limit(0), asked) == [] and found(df, asked.limit(0)) == []


def test_long_masks_in_parts(spark, monkeypatch):
    docs = [(i, " ".join(f"t{(i * j) % 211}" for j in range(1, 80))) for i in range(120)]
    items = [(1, " ".join(f"t{j}" for j in range(200)))]
    frame = lexical.postings(spark.createDataFrame(docs, "doc_id long, text string"), {f"t{j}".encode(): j for j in range(200)}, "doc_id", "text").toPandas()
    block = lexical.Block(frame, lexical.np.arange(200, dtype=lexical.np.int64) + 1, 120, 120 * 79)
    whole = block.search(lexical.np.arange(200), 5, [])
    monkeypatch.setattr(lexical, "BITS", 64 * 4 * 7)
    assert block.search(lexical.np.arange(200), 5, []) == whole and len(whole) == 5
    assert items and all(score < 0 for score, _, _ in whole)
