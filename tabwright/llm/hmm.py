"""Hidden Markov language model: Baum-Welch over partitions, exact likelihood by the scaled forward recursion."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, small_batches

#: Classes: at most FREQUENT words of their own, RARE hashed ones for all other words, and one for the end.
FREQUENT, RARE = 4096, 4095
CLASSES = FREQUENT + RARE + 1
END = CLASSES - 1
#: At most so many of the most frequent words go to every task; the rest are counted by a join.
LOOKUP = 1 << 17
BUFFER = 5 << 19
LENGTHS = (512, 4096)
SCALED = 8
FLUSH = 300_000


def rare_class(word: bytes) -> int:
    return FREQUENT + zlib.crc32(word) % RARE


def held_out(key: Column) -> Column:
    """True where crc32 of the id as text is 2 modulo 7; false for a null id."""
    return F.coalesce(F.crc32(key.cast("string")) % 7 == 2, F.lit(False))


def word_counts(docs: DataFrame) -> DataFrame:
    """Rows (word binary, c) over the ``__text`` of the training rows; tasks count before they shuffle."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for b in batches:
            for t in b["__text"]:
                seen.update(bytes(t).lower().split())
                if len(seen) > FLUSH:
                    yield pd.DataFrame({"word": list(seen.keys()), "n": list(seen.values())})
                    seen = Counter()
        if seen:
            yield pd.DataFrame({"word": list(seen.keys()), "n": list(seen.values())})

    return docs.filter("not __held").select("__text").mapInPandas(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("c"))


def frequent_from(counts: DataFrame) -> int:
    """The least count from which on there are at most ``LOOKUP`` words, by bins of equal ratio (a few thousand, whatever the corpus)."""
    bins = counts.groupBy(F.floor(F.log2("c") * 64).alias("b")).agg(F.count("*").alias("n"), F.min("c").alias("c")).orderBy(F.desc("b")).collect()
    least, words = (bins[0].c + 1 if bins else 1), 0
    for r in bins:
        words += r.n
        if words > LOOKUP:
            break
        least = r.c
    return least


class Layout:
    """Texts as class codes, laid out by step so that one operation moves all texts of a batch on by a token.

    State weights are scaled back to sum 1 every ``SCALED`` steps, long before they could underflow.
    """

    def __init__(self, codes: list[np.ndarray]):
        lengths = np.array([len(c) for c in codes])
        self.order = np.argsort(-lengths, kind="stable")
        lengths = lengths[self.order]
        self.active = np.searchsorted(-lengths, -np.arange(1, lengths[0] + 1), side="right")
        self.starts = np.concatenate([[0], np.cumsum(self.active)])
        self.codes = np.empty(self.starts[-1], np.uint16)
        firsts = self.starts[:-1]
        for row, i in enumerate(self.order):
            self.codes[firsts[: lengths[row]] + row] = codes[i]
        self.last = firsts[lengths - 1] + np.arange(len(lengths))

    def forward(self, start: np.ndarray, move: np.ndarray, seen: np.ndarray) -> tuple[np.ndarray, dict[int, np.ndarray]]:
        """Natural log-likelihood of each row; ``seen``, the emissions of all tokens, becomes the scaled state weights. Also the scales of scaled steps."""
        like, scales, ones = np.zeros(self.active[0]), {}, np.ones(len(start))
        state = seen[: self.active[0]]
        state *= start
        for t in range(1, len(self.active)):
            now = seen[self.starts[t] : self.starts[t + 1]]
            now *= state[: len(now)] @ move
            if t % SCALED == 0:
                scales[t] = total = now @ ones
                now /= total[:, None]
                like[: len(now)] += np.log(total)
            state = now
        like += np.log(seen[self.last] @ ones)
        return like, scales

    def likelihoods(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> np.ndarray:
        """Natural log-likelihood of each text, in the order given."""
        out = np.empty(len(self.order))
        out[self.order] = self.forward(start, move, emit[self.codes])[0]
        return out

    def expected(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        """Log-likelihood and expected counts of first states, moves, and states by class."""
        seen = emit[self.codes]
        shares = seen.copy()
        like, scales = self.forward(start, move, shares)
        k, back = len(start), np.ascontiguousarray(move.T)
        moves = np.zeros((k, k))
        ends = np.repeat(1 / shares[self.last].sum(axis=1)[:, None], k, axis=1)
        later = ends[: self.active[-1]]
        for t in range(len(self.active) - 1, 0, -1):
            lo, hi, before = self.starts[t], self.starts[t + 1], self.starts[t - 1]
            front = seen[lo:hi]
            front *= later
            if t in scales:
                front /= scales[t][:, None]
            moves += shares[before : before + hi - lo].T @ front
            shares[lo:hi] *= later
            later = front @ back
            if lo - before > hi - lo:
                later = np.concatenate([later, ends[hi - lo : lo - before]])
        shares[: self.active[0]] *= later
        by_class = np.stack([np.bincount(self.codes, shares[:, j], minlength=CLASSES) for j in range(k)], axis=1)
        return float(like.sum()), shares[: self.active[0]].sum(axis=0), moves * move, by_class


def _buffers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Frames of about ``BUFFER`` tokens, or of one longer text, whose texts are of like length."""
    pools: dict[int, tuple[list, int]] = {}
    for b in batches:
        kinds = np.searchsorted(LENGTHS, b["__n"].to_numpy())
        for kind in np.unique(kinds):
            part = b[kinds == kind]
            while len(part):
                held, size = pools.get(kind, ([], 0))
                fits = max(int(np.searchsorted(np.cumsum(part["__n"].to_numpy()), BUFFER - size, side="right")), 0 if held else 1)
                if fits:
                    pools[kind] = ([*held, part[:fits]], size + int(part["__n"][:fits].sum()))
                    part = part[fits:]
                else:
                    yield pd.concat(held, ignore_index=True)
                    pools[kind] = ([], 0)
    for held, _ in pools.values():
        if held:
            yield pd.concat(held, ignore_index=True)


def _codes(frame: pd.DataFrame) -> list[np.ndarray]:
    return [np.frombuffer(c, np.uint16) for c in frame["__codes"]]


def start_model(states: int, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """States that tend to stay, each with the class shares bent by a fixed random factor, so that they can part."""
    rng = np.random.default_rng(7)
    emit = (totals[:, None] + 0.5) * np.exp(rng.normal(0, 0.5, (CLASSES, states)))
    move = np.full((states, states), 0.1 / max(states - 1, 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    return np.full(states, 1 / states), move, emit / emit.sum(axis=0)


def train(encoded: DataFrame, totals: np.ndarray, states: int, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[float]]:
    """Baum-Welch over all training rows of ``encoded``, whose tokens by class are ``totals``.

    Each round every task sums the expected counts of its texts; Spark adds them by class (``CLASSES`` rows of ``states``
    numbers, whatever the corpus), and the driver normalises them with half a count added. Returns first states, moves, emissions
    and the log-likelihood at each round's start. Without training rows the start model stays.
    """
    source = encoded.filter("not __held").select("__n", "__codes")
    schema = "k long, v array<double>"

    start, move, emit = start_model(states, totals)
    likelihoods: list[float] = []
    for _ in range(rounds if totals.any() else 0):
        model = (start, move, emit)

        def expect(batches: Iterator[pd.DataFrame], model=model) -> Iterator[pd.DataFrame]:
            like, first, moves, by_class = 0.0, np.zeros(states), np.zeros((states, states)), np.zeros((CLASSES, states))
            for frame in _buffers(batches):
                one = Layout(_codes(frame)).expected(*model)
                like, first, moves, by_class = like + one[0], first + one[1], moves + one[2], by_class + one[3]
            seen = np.flatnonzero(by_class.any(axis=1))
            rows = [(int(k), by_class[k]) for k in seen] + [(-1 - i, moves[i]) for i in range(states)]
            rows += [(-1 - states, first), (-2 - states, np.full(states, like))]
            yield pd.DataFrame(rows, columns=["k", "v"])

        summed = source.mapInPandas(expect, schema).groupBy("k").agg(*[F.sum(F.get("v", i)).alias(f"v{i}") for i in range(states)])
        got = {r[0]: np.array(r[1:], float) for r in summed.collect()}
        likelihoods.append(float(got[-2 - states][0]))
        start = got[-1 - states] + 0.5
        move = np.stack([got[-1 - i] for i in range(states)]) + 0.5
        emit = np.stack([got.get(k, np.zeros(states)) for k in range(CLASSES)]) + 0.5 * states / CLASSES
        start, move, emit = start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0)
    return start, move, emit, likelihoods


def score(docs: DataFrame, states: int = 6, rounds: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, held_out, n_tokens, n_known, train_tokens, base_score, score), one for each document.

    Tokens: words of the whole text, A-Z lower-cased, then an end. All rows that are not held out are counted and train the model. A word is emitted in two parts: a
    state emits the word's class (frequent words have their own, others share hashed ones), and a shared class emits the word with its add-one
    share of the class, one count kept for unknown words; so the scores of all texts sum to one. ``score`` is the log10 likelihood, summed over all state
    paths. Null texts are empty: only the end is scored. Repeated rows are counted and scored each; rows of a null id train. Without training rows counts are zero and the model is
    that of the start.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(F.col(id_col).alias("__id"), held_out(F.col(id_col)).alias("__held"), F.coalesce(F.col(text_col).cast("binary"), F.lit("").cast("binary")).alias("__text"))
    kind = dict(docs.dtypes)[id_col]
    counts = saved(word_counts(rows), "word-counts")
    ends = rows.filter("not __held").count()
    words = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n, v = (words.n or 0) + ends, words.v + (1 if ends else 0)
    least = frequent_from(counts)
    known = {bytes(r.word): r.c for r in counts.filter(F.col("c") >= least).collect()}
    own = {w: i for i, w in enumerate(sorted(w for w, c in known.items() if c * FREQUENT > n))}
    lookup = spark.sparkContext.broadcast((known, own))
    end_log = math.log10(ends + 1)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, own = lookup.value
        classes = dict(own)
        logs = {w: math.log10(c + 1) for w, c in known.items()}
        for b in batches:
            out = []
            for t in b["__text"]:
                words = bytes(t).lower().split()
                seen = Counter(words)
                for w in seen:
                    if w not in classes:
                        classes[w] = rare_class(w)
                codes = np.fromiter(map(classes.__getitem__, words), np.uint16, len(words))
                if len(classes) > FLUSH:
                    classes = dict(own)
                total, far, times = end_log, [], []
                for w, t in seen.items():
                    log = logs.get(w)
                    if log is None:
                        far.append(w)
                        times.append(t)
                    else:
                        total += t * log
                near = len(words) - sum(times)
                out.append((len(words) + 1, codes.tobytes() + np.uint16(END).tobytes(), total, near + (1 if ends else 0), far, times))
            frame = pd.DataFrame(out, columns=["__n", "__codes", "__sum", "__known", "__far", "__times"])
            yield pd.concat([b[["__id", "__held"]], frame], axis=1)

    schema = f"__id {kind}, __held boolean, __n long, __codes binary, __sum double, __known long, __far array<binary>, __times array<int>"
    encoded = saved(rows.mapInPandas(encode, schema).withColumn("__row", F.monotonically_increasing_id()), "encoded")
    far = encoded.select("__row", F.explode(F.arrays_zip("__far", "__times")).alias("x")).select("__row", F.col("x.__far").alias("word"), F.col("x.__times").alias("times"))
    rest = counts.filter(F.col("c") < least)
    sums = far.join(rest, "word").groupBy("__row").agg(F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("far_sum"), F.sum("times").alias("far_known"))

    shared = np.ones(CLASSES)  # what a class shares out: 1 for unknown words and c + 1 of each word
    totals = np.zeros(CLASSES)
    grouped = counts.withColumn("k", F.lit(FREQUENT) + F.crc32("word") % RARE).groupBy("k").agg(F.sum(F.col("c") + 1).alias("s"), F.sum("c").alias("c"))
    for r in grouped.collect():
        shared[r.k] += r.s
        totals[r.k] += r.c
    for w, i in own.items():
        shared[rare_class(w)] -= known[w] + 1
        totals[rare_class(w)] -= known[w]
        totals[i] = known[w]
    totals[END] = ends
    own_sum = {i: math.log10(known[w] + 1) for w, i in own.items()}
    inside = -np.log10(shared)
    inside[:FREQUENT] = 0
    for i, x in own_sum.items():
        inside[i] = -x  # a frequent word is its class; its log count is in the sum already
    inside[END] = -end_log
    start, move, emit, _ = train(encoded, totals, states, rounds)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in _buffers(batches):
            codes = _codes(frame)
            logs = Layout(codes).likelihoods(start, move, emit) / math.log(10)
            within = np.array([inside[c].sum() for c in codes])
            yield frame[["__row", "__id", "__held", "__n", "__sum", "__known"]].assign(model=logs + within)

    judged = encoded.select("__row", "__id", "__held", "__n", "__sum", "__known", "__codes").mapInPandas(judge, f"__row long, __id {kind}, __held boolean, __n long, __sum double, __known long, model double")
    total = F.col("__sum") + F.coalesce("far_sum", F.lit(0.0))
    return judged.join(sums, "__row", "left").select(
        F.col("__id").alias(id_col), F.col("__held").alias("held_out"), F.col("__n").alias("n_tokens"), (F.col("__known") + F.coalesce("far_known", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (total - F.col("__n") * math.log10(n + v + 1)).alias("base_score"), (F.col("model") + total).alias("score"),
    )
