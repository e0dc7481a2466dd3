"""Sequential change detectors with per-key state on a stream.

The state is a handful of numbers per key (for the adaptive window a logarithmic
list of bucket sums). Rows of a micro-batch are taken in time order: the rows of a key come in
frames of bounded size, and where there are several, each is sorted and put by in pieces in the
state store, and the pieces are merged from there, so that a hot key never lies in memory whole.
"""

from __future__ import annotations

import json
import math
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor

PIECE_ROWS = 4096
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Detector(StatefulProcessor):
    """One detector for each key: ``step`` maps (memory, values in order) to (memory, statistics, flags)."""

    def __init__(self, key: str, order: list[str], value: str, step, start, ttl_ms: int | None):
        self.key, self.order, self.value, self.step, self.start, self.ttl = key, order, value, step, start, ttl_ms

    def init(self, handle) -> None:
        self.memory = handle.getValueState("memory", "memory string", self.ttl)
        self.pieces = handle.getMapState("pieces", "run int, piece int", "rows binary")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        memory = json.loads(self.memory.get()[0]) if self.memory.exists() else self.start()
        for part in self._in_order(rows):
            memory, stats, flags = self.step(memory, part[self.value].to_numpy(float))
            columns = {self.key: key[0]} | {c: part[c].to_numpy() for c in self.order} | {self.value: part[self.value].to_numpy(float)}
            yield pd.DataFrame(columns | {"statistic": np.asarray(stats, float), "drift": np.asarray(flags, bool)})
        self.memory.update((json.dumps(memory),))

    def _in_order(self, rows) -> Iterator[pd.DataFrame]:
        columns = [*self.order, self.value]
        sizes: list[int] = []
        held = None
        for frame in rows:
            if held is not None:
                sizes.append(self._put_by(len(sizes), held))
            held = frame[columns].sort_values(self.order, kind="stable", ignore_index=True)
        if held is None:
            return
        if not sizes:
            yield held
            return
        sizes.append(self._put_by(len(sizes), held))
        yield from self._merged(sizes)
        for run, size in enumerate(sizes):
            for piece in range(size):
                self.pieces.removeKey((run, piece))

    def _put_by(self, run: int, frame: pd.DataFrame) -> int:
        size = -(-len(frame) // PIECE_ROWS)
        for piece in range(size):
            part = frame.iloc[piece * PIECE_ROWS : (piece + 1) * PIECE_ROWS]
            self.pieces.updateValue((run, piece), (pickle.dumps({c: part[c].to_numpy() for c in part.columns}, protocol=5),))
        return size

    def _piece(self, run: int, piece: int) -> pd.DataFrame:
        return pd.DataFrame(pickle.loads(bytes(self.pieces.getValue((run, piece))[0])))

    def _merged(self, sizes: list[int]) -> Iterator[pd.DataFrame]:
        """Of the pieces at hand, one a run, the rows up to the least of their last rows can have none before them."""
        at = {run: 0 for run, size in enumerate(sizes) if size}
        open_pieces = {run: self._piece(run, 0) for run in at}
        while open_pieces:
            ends = pd.concat([p[self.order].tail(1) for p in open_pieces.values()])
            bound = ends.sort_values(self.order, kind="stable").iloc[0]
            ready = []
            for run, p in list(open_pieces.items()):
                upto = p[self.order[-1]] <= bound[self.order[-1]]
                for c in self.order[-2::-1]:
                    upto = (p[c] < bound[c]) | ((p[c] == bound[c]) & upto)
                ready.append(p[upto])
                rest = p[~upto]
                if len(rest):
                    open_pieces[run] = rest
                elif at[run] + 1 < sizes[run]:
                    at[run] += 1
                    open_pieces[run] = self._piece(run, at[run])
                else:
                    del open_pieces[run]
            yield pd.concat(ready).sort_values(self.order, kind="stable", ignore_index=True)


def _detector(stream: DataFrame, key: str, ts: str, value: str, step, start, tie: str | None, ttl_ms: int | None) -> DataFrame:
    """Rows ``(key, ts, tie, value, statistic, drift)``; rows without a time or a value take no part.

    Rows of one time are taken by ``tie``. A key unseen for ``ttl_ms`` starts anew. The state lives in RocksDB, which the session is set to.
    """
    spark = stream.sparkSession
    name = "spark.sql.streaming.stateStore.providerClass"
    if spark.conf.get(name, None) != STORE:
        spark.conf.set(name, STORE)
    kinds = {f.name: f.dataType.simpleString() for f in stream.schema}
    order = [ts, tie] if tie else [ts]
    out = ", ".join([f"`{c}` {kinds[c]}" for c in [key, *order]] + [f"`{value}` double", "statistic double", "drift boolean"])
    rows = stream.select(key, *order, stream[value].cast("double").alias(value)).dropna(subset=[*order, value])
    worker = Detector(key, order, value, step, start, ttl_ms)
    return rows.groupBy(key).transformWithStateInPandas(worker, out, "Append", "ProcessingTime" if ttl_ms else "None")


def page_hinkley_step(delta: float, threshold: float):
    def step(m, v):
        n, s = m["n"] + np.arange(1, len(v) + 1), m["s"] + np.cumsum(v)
        total = m["sum"] + np.cumsum(v - s / n - delta)
        low = np.minimum(m["low"], np.minimum.accumulate(total))
        stat = total - low
        return {"n": int(n[-1]), "s": float(s[-1]), "sum": float(total[-1]), "low": float(low[-1])}, stat, stat > threshold

    return step


def page_hinkley(stream: DataFrame, key: str, ts: str, value: str, delta: float = 0.005, threshold: float = 50.0, tie: str | None = None, ttl_ms: int | None = None) -> DataFrame:
    return _detector(stream, key, ts, value, page_hinkley_step(delta, threshold), lambda: {"n": 0, "s": 0.0, "sum": 0.0, "low": 0.0}, tie, ttl_ms)


def ddm_step(warn: float, drift: float, min_rows: int):
    def step(m, v):
        n, e = m["n"] + np.arange(1, len(v) + 1), m["e"] + np.cumsum(v)
        p = e / n
        s = np.sqrt(p * (1 - p) / n)
        now = np.where(n >= min_rows, p + s, np.inf)
        first = math.inf if m["bp"] is None else m["bp"] + m["bs"]
        least = np.minimum(first, np.minimum.accumulate(now))
        fresh = now < np.concatenate([[first], least[:-1]])
        at = np.maximum.accumulate(np.where(fresh, np.arange(len(v)), -1))
        bp = np.where(at >= 0, p[at], np.inf if m["bp"] is None else m["bp"])
        bs = np.where(at >= 0, s[at], 0.0 if m["bs"] is None else m["bs"])
        best = (float(bp[-1]), float(bs[-1])) if math.isfinite(bp[-1]) else (None, None)
        return {"n": int(n[-1]), "e": float(e[-1]), "bp": best[0], "bs": best[1]}, p + s, p + s > bp + drift * bs

    return step


def ddm(stream: DataFrame, key: str, ts: str, error: str, warn: float = 2.0, drift: float = 3.0, min_rows: int = 30, tie: str | None = None, ttl_ms: int | None = None) -> DataFrame:
    return _detector(stream, key, ts, error, ddm_step(warn, drift, min_rows), lambda: {"n": 0, "e": 0.0, "bp": None, "bs": None}, tie, ttl_ms)


def adaptive_window_step(confidence: float, per_level: int = 5):
    """Buckets of 2^i values, at most ``per_level`` of each size; a cut with a significant gap drops the older part.

    What is dropped depends on every value before, so values go one by one.
    """

    def one(m, v):
        buckets = m["b"]  # newest first: [count, sum, sum of squares]
        buckets.insert(0, [1, v, v * v])
        size = 1
        while True:
            same = [i for i, b in enumerate(buckets) if b[0] == size]
            if len(same) <= per_level:
                break
            i, j = same[-2], same[-1]
            buckets[i] = [buckets[i][k] + buckets[j][k] for k in range(3)]
            buckets.pop(j)
            size *= 2
        changed = True
        hit = False
        while changed and len(buckets) > 1:
            changed = False
            n, s, q = (sum(b[k] for b in buckets) for k in range(3))
            var = max(q / n - (s / n) ** 2, 0.0)
            n0 = s0 = 0.0
            for b in buckets[:-1]:
                n0 += b[0]
                s0 += b[1]
                n1, s1 = n - n0, s - s0
                if min(n0, n1) < 5:
                    continue
                inv = 1 / n0 + 1 / n1
                d = math.log(2 * math.log(max(n, 2.0)) / confidence)
                eps = math.sqrt(2 * inv * var * d) + 2 / 3 * inv * d
                if abs(s0 / n0 - s1 / n1) > eps:
                    buckets.pop()
                    changed = hit = True
                    break
        m["b"] = buckets
        total = sum(b[0] for b in buckets)
        return m, float(total), hit

    def step(m, values):
        stats, flags = [], []
        for v in values.tolist():
            m, stat, hit = one(m, v)
            stats.append(stat)
            flags.append(hit)
        return m, stats, flags

    return step


def adaptive_window(stream: DataFrame, key: str, ts: str, value: str, confidence: float = 0.002, tie: str | None = None, ttl_ms: int | None = None) -> DataFrame:
    """ADWIN; ``statistic`` is the current window length."""
    return _detector(stream, key, ts, value, adaptive_window_step(confidence), lambda: {"b": []}, tie, ttl_ms)
