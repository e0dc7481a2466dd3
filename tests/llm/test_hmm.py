import itertools
import math
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tabwright.llm import hmm


def small_model(states=3, seed=4):
    rng = np.random.default_rng(seed)
    start, move, emit = rng.random(states) + 0.1, rng.random((states, states)) + 0.1, rng.random((hmm.CLASSES, states)) + 0.1
    return start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0)


def test_forward_against_all_paths():
    start, move, emit = small_model()
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, hmm.CLASSES, n) for n in (1, 5, 3, 3, 10, 1, 8, 9)]
    got = hmm.Layout(texts).likelihoods(start, move, emit)
    for codes, log in zip(texts, got, strict=True):
        total = 0.0
        for path in itertools.product(range(3), repeat=len(codes)):
            p = start[path[0]] * emit[codes[0], path[0]]
            for a, b, c in zip(path, path[1:], codes[1:], strict=False):
                p *= move[a, b] * emit[c, b]
            total += p
        assert math.isclose(log, math.log(total), rel_tol=1e-9)


def test_expected_counts_against_all_paths():
    start, move, emit = small_model(2, 9)
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 50, n) for n in (4, 1, 6, 2, 11, 9, 8)]
    like, first, moves, by_class = hmm.Layout(texts).expected(start, move, emit)
    want_first, want_moves, want_class, want_like = np.zeros(2), np.zeros((2, 2)), np.zeros((hmm.CLASSES, 2)), 0.0
    for codes in texts:
        paths = {}
        for path in itertools.product(range(2), repeat=len(codes)):
            p = start[path[0]] * emit[codes[0], path[0]]
            for a, b, c in zip(path, path[1:], codes[1:], strict=False):
                p *= move[a, b] * emit[c, b]
            paths[path] = p
        total = sum(paths.values())
        want_like += math.log(total)
        for path, p in paths.items():
            want_first[path[0]] += p / total
            for a, b in zip(path, path[1:], strict=False):
                want_moves[a, b] += p / total
            for c, s in zip(codes, path, strict=True):
                want_class[c, s] += p / total
    assert math.isclose(like, want_like, rel_tol=1e-9)
    np.testing.assert_allclose(first, want_first, atol=1e-9)
    np.testing.assert_allclose(moves, want_moves, atol=1e-9)
    np.testing.assert_allclose(by_class, want_class, atol=1e-9)


def test_buffers_keep_every_row_once(monkeypatch):
    monkeypatch.setattr(hmm, "BUFFER", 1000)
    rng = np.random.default_rng(3)
    rows = pd.DataFrame({"__n": rng.choice([3, 200, 600, 900, 5000], 300), "at": np.arange(300)})
    parts = list(hmm._buffers(iter([rows[:7], rows[7:150], rows[150:]])))
    assert sorted(pd.concat(parts)["at"]) == list(range(300))
    assert all(p["__n"].sum() <= 1000 or len(p) == 1 for p in parts)


def base_scores(rows):
    out, held = {}, {}
    words = {i: (t or "").encode().lower().split() for i, t in rows}
    for i, _ in rows:
        held[i] = i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = Counter(w for i, ws in words.items() if not held[i] for w in [*ws, None])
    n, v = sum(counts.values()), len(counts)
    for i, ws in words.items():
        tokens = [*ws, None]
        out[i] = (held[i], len(tokens), sum(counts[w] > 0 for w in tokens), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens))
    return out


def test_documents(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet").withColumn("held_out", F.lit(1)).withColumn("word", F.lit("x"))
    want = base_scores([(r.doc_id, r.text) for r in df.collect()])
    got = hmm.score(df, states=3, rounds=3).collect()
    assert len(got) == len(want)
    for r in got:
        w = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == w[:4]
        assert math.isclose(r.base_score, w[4], rel_tol=1e-9)
    assert sum(r.score for r in got if r.held_out) > sum(r.base_score for r in got if r.held_out)


def test_likelihood_rises_round_by_round(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(int(r.doc_id), False, bytearray(np.array([zlib.crc32(w.encode()) % hmm.CLASSES for w in r.text.split()] + [hmm.END], np.uint16).tobytes()), len(r.text.split()) + 1) for r in df.collect()]
    totals = np.bincount(np.concatenate([np.frombuffer(r[2], np.uint16) for r in rows]), minlength=hmm.CLASSES).astype(float)
    logs = hmm.train(spark.createDataFrame(rows, "__id long, __held boolean, __codes binary, __n long"), totals, 3, 6)[3]
    assert all(b > a for a, b in zip(logs[1:], logs[2:], strict=False))  # half a count is added, so the first round may differ


def test_rare_and_frequent_words_share_one_distribution(spark, docs_of, monkeypatch):
    """With few slots for frequent words, one-word texts of the whole vocabulary and an unknown one sum to a probability of at most 1."""
    monkeypatch.setattr(hmm, "LOOKUP", 64)
    vocabulary = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(vocabulary[j] for j in range(60) if j % (1 + i % 7) == 0)) for i in range(40)]
    rows += [(1000 + i, w) for i, w in enumerate(vocabulary)] + [(2000, "never-seen-word")]
    got = {r.doc_id: r for r in hmm.score(docs_of(rows), states=2, rounds=2).collect()}
    want = base_scores(rows)
    for i, r in got.items():
        assert math.isclose(r.base_score, want[i][4], rel_tol=1e-9) and r.n_known == want[i][2]
    assert sum(10 ** got[1000 + i].score for i in range(60)) <= 1


def test_corner_cases(spark, docs_of):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One TWO one"), (5, "É é É"), (6, "a" * 50_000), (7, "b " * 30_000), (None, "no number")]
    got = {r.doc_id: r for r in hmm.score(docs_of(rows, ", score double")).collect()}
    want = base_scores(rows)
    for i, r in got.items():
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == want[i][:4]
        assert math.isclose(r.base_score, want[i][4], rel_tol=1e-9) and math.isfinite(r.score)
    twice = hmm.score(docs_of([(4, "x y"), (4, "x y")])).collect()
    assert len(twice) == 2 and twice[0] == twice[1]
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    alone = hmm.score(docs_of([(held, "only held out")])).collect()
    assert (alone[0].train_tokens, alone[0].n_known, alone[0].base_score) == (0, 0, 0.0)
    assert hmm.score(docs_of([])).collect() == []
