"""The stages of the corpus pipeline on planted documents, and the registered queries against their SQL."""

import random

import duckdb
import pytest

import corpus_pipeline
from check_oracle import TABLES, canon
from tabwright.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    df = queries.QUERIES[name](spark, sf)
    rel = con.execute(queries.ORACLE[name])
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon([d[0] for d in rel.description], rel.fetchall())


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 9))) for _ in range(800)]

    def prose(n):
        out = []
        while len(out) < n:
            s = [rng.choice(vocabulary) for _ in range(rng.randint(5, 12))]
            out += [s[0].capitalize(), *s[1:-1], s[-1] + "."]
        return out

    rows = [(i, " ".join(prose(rng.randint(60, 200)))) for i in range(200)]
    clean = set(range(200))
    rows += [(1000 + i, rows[i][1]) for i in range(20)]  # copies
    for i in range(20, 30):  # near copies: one word of a long text
        text = prose(900)
        rows.append((300 + i, " ".join(text)))
        clean.add(300 + i)
        text[450] = "changed"
        rows.append((1300 + i, " ".join(text)))
    items = [(i, " ".join(prose(30))) for i in range(5)]
    rows += [(2000 + i, " ".join([*prose(80), items[i % 5][1], *prose(80)])) for i in range(10)]  # leaks
    rows += [(3000 + i, " ".join(f"{w.upper()}!!" for w in prose(80))) for i in range(25)]  # junk
    rows += [(3100 + i, " ".join([rng.choice(vocabulary)] * 60)) for i in range(15)]
    rows += [(4000, None), (4001, "")]
    folder = tmp_path_factory.mktemp("planted")
    docs = [(i, t, "en", "src0", len(t or "")) for i, t in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(i, int(i < 3000), 0) for i, _ in rows[::2]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder), rows, clean


def test_planted_cases(spark, planted):
    folder, rows, clean = planted
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = [set(i for i, _ in rows)]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.saved(stage(spark, docs, folder), "stage")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        ids.append({r.doc_id for r in docs.collect()})
    quality, unique, free, mixed = ids[1:]
    assert quality >= clean and not {i for i in quality if 3000 <= i < 4002}
    assert unique == {i for i in quality if not 1000 <= i < 2000}
    assert free == {i for i in unique if not 2000 <= i < 3000}
    assert mixed >= clean
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert last.count() == len(mixed) and last.filter("shard is null").count() == 0


def test_run(spark, planted):
    folder, _, clean = planted
    got = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in got.collect()} >= clean and got.columns[-2:] == ["slot", "shard"]


def test_empty_documents(spark, planted, tmp_path):
    folder, _, _ = planted
    for t in ("benchmark", "labels"):
        spark.read.parquet(f"{folder}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
