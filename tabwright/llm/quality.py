"""Quality classifier: heuristic labellers, their accuracies by expectation-maximisation, and a hashed linear scorer."""

from __future__ import annotations

import operator
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fit_logistic, free_name, saved, small_batches

#: Slots of the scorer, the last BINS of them for signals.
DIM, BINS = 1 << 13, 1 << 10
SYMBOLS = b"#$%&*!|~^=+<>{}[]\\@_"
UPPERS = bytes(range(65, 91))
LOWERS = bytes(range(97, 123))
SPACES = b" \t\n\r\x0b\x0c"
#: Letters by case, digits and marks; other bytes stay.
SHAPE = bytes(65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else 97 if 97 <= c <= 122 or c >= 128 else c for c in range(256))
#: Every symbol as "#" and every space as a blank.
MARKS = bytes(35 if c in SYMBOLS + b"!-?" else 32 if c in SPACES else c for c in range(256))

#: Labellers: signal, smallest number of words, and the bounds of "bad" and "good"; between them the labeller abstains.
LABELLERS = [
    ("repeat", 5, ">=", 0.25, "<=", 0.05),
    ("variety", 30, "<=", 0.45, ">=", 0.7),
    ("upper", 5, ">=", 0.5, "<=", 0.2),
    ("symbols", 5, ">=", 0.06, "<=", 0.01),
    ("tails", 5, ">=", 0.1, "<=", 0.02),
    ("bars", 5, ">=", 0.15, "<=", 0.01),
    ("ends", 5, "<=", 0.05, ">=", 0.5),
    ("length", 1, ">=", 15.0, "<=", 9.0),
    ("lines", 20, ">=", 0.5, "<=", 0.2),
]
HOLDS = {">=": operator.ge, "<=": operator.le}


def signals(text: bytes, words: list[bytes]) -> dict[str, float]:
    """Numbers about the whole text that labellers look at."""
    n = max(len(words), 1)
    size = max(len(text.translate(None, SPACES)), 1)
    lower, upper = len(text) - len(text.translate(None, LOWERS)), len(text) - len(text.translate(None, UPPERS))
    lines = [x for x in text.split(b"\n") if x.strip()]
    return {
        "repeat": sum(map(operator.eq, words, words[1:])) / n,
        "variety": len(set(zip(words, words[1:], strict=False))) / (n - 1) if n > 1 else 1.0,
        "upper": upper / max(upper + lower, 1),
        "symbols": (len(text) - len(text.translate(None, SYMBOLS))) / size,
        "tails": (text + b" ").translate(MARKS).count(b"## ") / n,
        "bars": words.count(b"|") / n,
        "ends": sum(x.rstrip().endswith((b".", b"?", b"!", b'"', b":")) for x in lines) / max(len(lines), 1),
        "length": size / n,
        "lines": 1 - len(set(lines)) / max(len(lines), 1),
    }


def votes(found: dict[str, float], n: int) -> str:
    """A character for each labeller: 1 good, 0 bad, - abstains."""
    return "".join("-" if n < least else "0" if HOLDS[b](found[name], bad) else "1" if HOLDS[g](found[name], good) else "-" for name, least, b, bad, g, good in LABELLERS)


def fit_labellers(patterns: dict[str, int], rounds: int = 30) -> tuple[float, np.ndarray]:
    """Share of good documents and ``[class, labeller, vote]`` probabilities from the counts of vote patterns.

    ``patterns`` has at most 3 to the power of the labellers' number entries, however many documents there are. The vote
    abstain says nothing about the class. The start takes a labeller to fault 2 of 100 good documents and, as there are many kinds of bad ones, to
    find 40 of 100 bad ones; one document's worth of that start stays in as a prior.
    """
    m = len(LABELLERS)
    keys = sorted(patterns)
    seen = np.array([[[v == "0", v == "1"] for v in k] for k in keys], float).reshape(len(keys), m, 2)
    counts = np.array([patterns[k] for k in keys], float)
    prior, table = 0.8, np.tile(np.array([[[0.4, 0.6]], [[0.02, 0.98]]]), (1, m, 1))
    start = table.copy()
    for _ in range(rounds if keys else 0):
        good = counts * _posterior(seen, prior, table)
        split = np.stack([counts - good, good])
        prior = (good.sum() + 0.8) / (counts.sum() + 1)
        table = np.einsum("ck,kmv->cmv", split, seen) + start
        table /= table.sum(axis=2, keepdims=True)
    return float(prior), table


def _posterior(seen: np.ndarray, prior: float, table: np.ndarray) -> np.ndarray:
    bad, good = np.einsum("kmv,cmv->ck", seen, np.log(table))
    return 1 / (1 + np.exp(np.clip(bad - good + np.log1p(-prior) - np.log(prior), -500, 500)))


def posterior(pattern: str, prior: float, table: np.ndarray) -> float:
    """Probability that a document with these votes is good."""
    return float(_posterior(np.array([[[v == "0", v == "1"] for v in pattern]], float), prior, table)[0])


def hashed_grams(text: bytes, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Slots from ``low`` up to ``high`` and the roots of their shares, for the hashed 4-grams of bytes of the whole text."""
    raw = np.frombuffer(text, np.uint8)
    if len(raw) < 4:
        return np.zeros(0, np.int64), np.zeros(0)
    counts = np.zeros(high - low, np.int64)
    for at in range(0, len(raw) - 3, 1 << 16):  # a long text needs no more memory than a short one
        piece = raw[at : at + (1 << 16) + 3].astype(np.uint32)
        mixed = ((piece[:-3] * np.uint32(0x9E3779B1) + piece[1:-2]) * np.uint32(0x85EBCA77) + piece[2:-1]) * np.uint32(0xC2B2AE3D) + piece[3:]
        counts += np.bincount(((mixed * np.uint32(0x27D4EB2F)) >> np.uint32(16)) % np.uint32(high - low), minlength=high - low)
    slots = np.flatnonzero(counts)
    return slots + low, np.sqrt(counts[slots] / (len(raw) - 3))


def features(text: bytes, found: dict[str, float], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of length 1 at most: 4-grams of the text and of its letter shapes, and the signals in bins (none for a labeller that ``n`` words are too few for)."""
    half = (DIM - BINS) // 2
    binned = [f"{name}:{min(int(found[name] * (2 if name == 'length' else 20)), 30) if n >= least else 'none'}" for name, least, *_ in LABELLERS]
    bins = np.unique([DIM - BINS + zlib.crc32(x.encode()) % BINS for x in binned]).astype(np.int64)
    trust = np.sqrt(len(text) / (len(text) + 400)) / np.sqrt(11)  # the grams of a short text say little
    grams = [hashed_grams(text, 0, half), hashed_grams(text.translate(SHAPE), half, 2 * half)]
    val = [trust * g[1] for g in grams] + [np.full(len(bins), 3 / np.sqrt(11 * len(LABELLERS)))]
    return np.concatenate([grams[0][0], grams[1][0], bins]), np.concatenate(val)


def _texts(b: pd.DataFrame) -> Iterator[tuple[bytes, list[bytes]]]:
    for t in b["__text"]:
        raw = b"" if t is None else bytes(t)
        yield raw, raw.split()


def classify(docs: DataFrame, train_rows: int = 20000, rounds: int = 30, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text", keep_columns: bool = False) -> DataFrame:
    """Rows (id, votes, posterior, score, keep), or all columns of ``docs`` with ``score`` and ``keep`` (by free names, last), one for each document.

    All documents are labelled and their vote patterns counted; expectation-maximisation on those counts gives the labellers' accuracies and each
    pattern's posterior. About ``train_rows`` documents, sampled evenly (all, if there are no more), train
    the linear scorer on posteriors as soft labels; every document is scored over its whole text. ``keep``: score of ``least`` or more.
    A null, empty or blank text has score and posterior 0 and is not kept; repeated rows are judged each, alike.
    """
    small_batches(docs.sparkSession)
    text = F.col(text_col).cast("binary")
    source = docs.select(text.alias("__text"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = Counter()
        for b in batches:
            seen.update(votes(signals(raw, words), len(words)) for raw, words in _texts(b) if words)
        if seen:
            yield pd.DataFrame({"votes": list(seen.keys()), "n": list(seen.values())})

    found = source.mapInPandas(count, "votes string, n long").groupBy("votes").agg(F.sum("n").alias("n")).collect()
    prior, table = fit_labellers({r.votes: r.n for r in found})

    def train(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for raw, words in _texts(b):
                if words:
                    s = signals(raw, words)
                    rows.append((*features(raw, s, len(words)), posterior(votes(s, len(words)), prior, table)))
            if rows:
                yield pd.DataFrame(rows, columns=["idx", "val", "y"])

    share = train_rows / max(sum(r.n for r in found), 1)
    few = (source if share >= 1 else source.sample(share, seed=7)).repartition(8)
    weights = fit_logistic(saved(few.mapInPandas(train, "idx array<int>, val array<double>, y double"), "quality"), DIM, rounds)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            said, chance, z = [], [], []
            for raw, words in _texts(b):
                s = signals(raw, words)
                said.append(votes(s, len(words)) if words else "-" * len(LABELLERS))
                chance.append(posterior(said[-1], prior, table) if words else 0.0)
                if words:
                    idx, val = features(raw, s, len(words))
                    z.append(float(val @ weights[idx] + weights[-1]))
                else:
                    z.append(-np.inf)
            p = 1 / (1 + np.exp(-np.clip(np.array(z, float), -500, 500)))
            p[np.isneginf(np.array(z, float))] = 0.0
            yield b.drop(columns="__text").assign(__votes=said, __posterior=chance, __score=p, __keep=p >= least)

    kept = docs.columns if keep_columns else [id_col]
    kinds = dict(docs.dtypes)
    # By number on the way, so that no name of the table can clash.
    wide = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], text.alias("__text"))
    schema = ", ".join(f"c{i} {kinds[c]}" for i, c in enumerate(kept)) + ", __votes string, __posterior double, __score double, __keep boolean"
    out = wide.mapInPandas(score, schema)
    if keep_columns:
        return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], F.col("__score").alias(free_name(docs, "score")), F.col("__keep").alias(free_name(docs, "keep")))
    return out.select(F.col("c0").alias(id_col), F.col("__votes").alias("votes"), F.col("__posterior").alias("posterior"), F.col("__score").alias("score"), F.col("__keep").alias("keep"))


def kept(docs: DataFrame, **settings) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps, with all their columns."""
    judged = classify(docs, keep_columns=True, **settings)
    return judged.filter(F.col(f"`{judged.columns[-1]}`")).select(*[f"`{c}`" for c in docs.columns])
