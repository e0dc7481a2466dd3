import re

from tabwright.llm import decontaminate


def shingles(text):
    w = [x for x in re.split(r"[\W_]+", (text or "").lower()) if x]
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute(docs, items):
    out = {}
    for d, text in docs:
        for i, item in items:
            a, b = shingles(item), shingles(text)
            if a and len(a & b) >= 0.8 * len(a) - 1e-9:
                out[d, i] = max(out.get((d, i), (0, 0, 0)), (len(a & b) / len(a), len(a & b), len(a)))
    return out


def pairs(df):
    return {(r.doc_id, r.item_id): (r.containment, r.n_found, r.n_shingles) for r in df.collect()}


def test_documents_against_brute_force(spark, sf):
    docs, items = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert want and pairs(decontaminate.contained(docs, items)) == want


def test_corner_cases(spark, docs_of):
    item = "the quick brown fox jumps over the lazy dog and runs away from it"
    items = [(1, item), (1, item), (2, None), (3, ""), (4, "too few words"), (5, "five words are just enough"), (None, "an item that has no number but has words")]
    long = "filler " * 20_000
    docs = [(1, f"{long} The QUICK, brown fox; jumps over the lazy dog and runs away from it! {long}"), (2, item.replace("away", "off")), (3, item[:30]), (4, None), (5, ""), (6, item), (6, item), (6, "other"), (None, item), (7, "so five words are just enough here"), (8, "too few words"), (9, "say an item that has no number but has words indeed")]
    table = spark.createDataFrame(items, "item_id long, text string")
    df = docs_of(docs, ", item_id string, h double")
    assert pairs(decontaminate.contained(df, table)) == brute(docs, items)
    assert decontaminate.contained(df.limit(0), table).collect() == []
    assert decontaminate.contained(df, table.limit(0)).collect() == []
    bad = {d for d, _ in brute(docs, items)} - {6}
    kept = [(r.doc_id, r.text) for r in decontaminate.clean(df, table).collect()]
    assert sorted(kept, key=str) == sorted([x for x in docs if x[0] not in bad and x[1] != item], key=str)
    assert decontaminate.clean(df, table.limit(0)).count() == len(docs)


def test_no_python_in_the_plan(spark, docs_of):
    items = spark.createDataFrame([(1, "five words are just enough")], "item_id long, text string")
    plan = decontaminate.contained(docs_of([(1, "x")]), items)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
