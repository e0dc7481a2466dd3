"""Hard-negative mining through bounds along a spanning tree of the anchors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved

#: A squared length up to which all sums of products of whole numbers are exact in doubles.
EXACT = float(1 << 52)
BATCH = 1024
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def scaled(vector: Column, factor: int) -> Column:
    """floor(factor * x) of each component as double; null for a null vector or one with a null or non-finite component (after scaling)."""
    times = F.transform(vector, lambda x: x.cast("double") * float(factor))
    bad = F.exists(times, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(times, lambda x: F.when(F.abs(x) >= float(1 << 53), x).otherwise(F.floor(x).cast("double")))
    return F.when(vector.isNotNull() & ~bad, whole)


def stacked(vectors, dims: int) -> np.ndarray:
    """The vectors as rows, short ones filled with zeros."""
    out = np.zeros((len(vectors), dims))
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


class Tree:
    """A spanning tree of least total length over the anchors, by Prim's rule; ``order`` has every parent before its children."""

    def __init__(self, points: np.ndarray):
        n = len(points)
        self.points, self.parent, self.edge, self.order = points, np.full(n, -1), np.zeros(n), []
        away, outside = np.full(n, np.inf), np.ones(n, bool)
        at = 0
        for _ in range(n):
            self.order.append(at)
            outside[at] = False
            near = np.sqrt(((points - points[at]) ** 2).sum(axis=1))
            closer = outside & (near < away)
            away[closer], self.parent[closer] = near[closer], at
            if outside.any():
                at = int(np.argmin(np.where(outside, away, np.inf)))
                self.edge[at] = away[at]

    def walk(self, rows: np.ndarray, wanted) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(anchor, row numbers, exact scores) of all rows whose score may lie where the anchor looks for it.

        ``wanted(anchor)`` gives the eligible rows and the least and most score looked for. A row's score at a parent, plus and minus the edge's length times the row's
        norm, bounds its score at the child; where that overlaps the window the score is computed, elsewhere the interval is handed on, wider by the edge.
        """
        norms = np.sqrt((rows**2).sum(axis=1)) * (1 + 1e-9)
        middle, reach = np.empty((len(self.points), len(rows))), np.zeros((len(self.points), len(rows)))
        for j in self.order:
            eligible, least, most = wanted(j)
            p = self.parent[j]
            if p < 0:
                middle[j] = rows @ self.points[j]
                at = np.flatnonzero(eligible & (middle[j] >= least) & (middle[j] <= most))
            else:
                width = reach[p] + self.edge[j] * norms * (1 + 1e-9) + 1e-6
                at = np.flatnonzero(eligible & (middle[p] + width >= least) & (middle[p] - width <= most))
                if 2 * len(at) > len(rows):
                    middle[j] = rows @ self.points[j]
                else:
                    middle[j], reach[j] = middle[p], width
                    middle[j, at], reach[j, at] = rows[at] @ self.points[j], 0.0
            if len(at):
                yield j, at, middle[j, at]


class Best:
    """The ``k`` largest scores seen, ties to the smaller id."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def least(self, otherwise):
        return int(self.scores[-1]) if len(self.scores) == self.k else otherwise

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        keep = scores >= self.least(LEAST)
        if keep.any():
            scores, ids = np.concatenate([self.scores, scores[keep]]), np.concatenate([self.ids, ids[keep]])
            order = np.lexsort((ids, ~scores))[: self.k]
            self.scores, self.ids = scores[order], ids[order]


class Anchors:
    """One block of anchors: the tree of those whose products are exact in doubles, and the rest."""

    def __init__(self, rows: list, dims: int):
        self.numbers, self.ids = [r.row for r in rows], np.array([r.id for r in rows], np.int64)
        self.codes = {label: code for code, label in enumerate({r.label: None for r in rows})}
        self.labels = self.coded(r.label for r in rows)
        self.points = stacked([r.v for r in rows], dims)
        with np.errstate(over="ignore"):
            plain = (self.points**2).sum(axis=1) <= EXACT
        self.near, self.far = np.flatnonzero(plain), np.flatnonzero(~plain)
        self.tree = Tree(self.points[self.near])

    def coded(self, labels) -> np.ndarray:
        """Labels as numbers; -1 for one that no anchor of the block has."""
        return np.array([self.codes.get(x, -1) for x in labels], np.int64)

    def meet(self, rows: np.ndarray, wanted) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(anchor, row numbers, scores as 64-bit integers) that ``wanted`` asks for; long products go by whole numbers of any size and stop at 64 bits."""
        with np.errstate(over="ignore"):
            plain = (rows**2).sum(axis=1) <= EXACT
        at, odd = np.flatnonzero(plain), np.flatnonzero(~plain)

        def plain_rows(j: int):
            eligible, least, most = wanted(self.near[j])
            return eligible[at], least, most

        for j, found, scores in self.tree.walk(rows[at], plain_rows):
            yield self.near[j], at[found], np.rint(scores).astype(np.int64)
        # All of an odd row's or odd anchor's products; such rows are told by their length, never left out.
        long = [(j, odd) for j in self.near if len(odd)] + [(j, np.arange(len(rows))) for j in self.far]
        for j, some in long:
            mine = [int(x) for x in self.points[j]]
            eligible, least, most = wanted(j)
            scores = np.array([min(max(sum(a * int(b) for a, b in zip(mine, rows[i], strict=True)), LEAST), MOST) for i in some], np.int64)
            keep = eligible[some] & (scores >= least) & (scores <= most)
            if keep.any():
                yield j, some[keep], scores[keep]


def _batches(frames: Iterator[pd.DataFrame], dims: int) -> Iterator[tuple[np.ndarray, pd.Series, np.ndarray]]:
    for f in frames:
        for start in range(0, len(f), BATCH):
            part = f.iloc[start : start + BATCH]
            yield part["id"].to_numpy(np.int64), part["label"], stacked(part["v"].tolist(), dims)


def mined(
    table: DataFrame, every: int = 100, positives: int = 5, k: int = 10, factor: int = 256, low: int = 30, high: int = 90,
    block: int = 2048, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score): hard negatives of each anchor and positive.

    Anchors are the rows whose id is divisible by ``every``. Components become floor(``factor`` x), scores are integer inner products, higher ones come first and ties go to the smaller id. An
    anchor's positives are its first ``positives`` rows of the same label and another id; its negatives for a positive are the first ``k`` rows of other labels with
    ``low`` percent to ``high`` percent of the positive's score. Anchors come in blocks of ``block`` (their vectors are all that goes to every task, in one broadcast);
    for each block all rows pass twice: once for the positives, once for the negatives, whose windows are then known. A task keeps its best for each anchor and
    positive alone, and these are ranked over all tasks.

    Rows with a null id, label or vector, or with a null or non-finite component, take no part; short vectors are filled with zeros; repeated rows count each, also as anchors;
    rows that share an anchor's id are not its positives. Scores beyond 64 bits are held at their limits. Extra columns are not looked at; an empty table gives no rows.
    """
    spark = table.sparkSession
    known = table.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), scaled(F.col(vector_col), factor).alias("v")).dropna()
    rows = saved(known.withColumn("row", F.monotonically_increasing_id()), "vectors")
    facts = rows.agg(F.max(F.size("v")).alias("dims"), F.count_if(F.col("id") % every == 0).alias("anchors")).first()
    dims = int(facts.dims or 0)
    asked = rows.filter(F.col("id") % every == 0)
    blocks = max(1, -(-facts.anchors // block))
    result = "anchor long, anchor_id long, slot int, positive_id long, positive_score long, negative_id long, negative_score long"
    parts = []
    for number in range(blocks):
        mine = sorted(asked.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == number).collect(), key=lambda r: r.row)
        shared = spark.sparkContext.broadcast(Anchors(mine, dims))

        def first_rows(frames: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            anchors = shared.value
            best = [Best(positives) for _ in anchors.ids]
            for ids, names, vectors in _batches(frames, dims):
                labels = anchors.coded(names)
                for j, at, scores in anchors.meet(vectors, lambda j: ((labels == anchors.labels[j]) & (ids != anchors.ids[j]), best[j].least(LEAST), MOST)):
                    best[j].add(scores, ids[at])
            out = [(j, i, s) for j, b in enumerate(best) for i, s in zip(b.ids.tolist(), b.scores.tolist(), strict=True)]
            yield pd.DataFrame(out, columns=["j", "id", "score"])

        order = Window.partitionBy("j").orderBy(F.desc("score"), F.asc("id"))
        near = rows.mapInPandas(first_rows, "j long, id long, score long").withColumn("slot", F.row_number().over(order)).filter(F.col("slot") <= positives)
        windows: dict[int, list[tuple[int, int, int, int, int]]] = {}
        for r in near.collect():
            lowest, highest = -(-low * r.score // 100), high * r.score // 100
            if lowest <= highest:
                windows.setdefault(r.j, []).append((r.slot, r.id, r.score, lowest, highest))

        def hard_rows(frames: Iterator[pd.DataFrame], shared=shared, windows=windows) -> Iterator[pd.DataFrame]:
            anchors = shared.value
            best = {(j, w[0]): Best(k) for j, ws in windows.items() for w in ws}

            def wanted(j: int):
                ws = windows.get(int(j), ())
                if not ws:
                    return np.zeros(len(labels), bool), MOST, LEAST
                return labels != anchors.labels[j], min(max(w[3], best[j, w[0]].least(LEAST)) for w in ws), max(w[4] for w in ws)

            for ids, names, vectors in _batches(frames, dims):
                labels = anchors.coded(names)
                for j, at, scores in anchors.meet(vectors, wanted):
                    for slot, _, _, lowest, highest in windows[j]:
                        inside = (scores >= lowest) & (scores <= highest)
                        best[j, slot].add(scores[inside], ids[at[inside]])
            out = [
                (anchors.numbers[j], int(anchors.ids[j]), slot, pid, pscore, i, s)
                for j, ws in windows.items()
                for slot, pid, pscore, _, _ in ws
                for i, s in zip(best[j, slot].ids.tolist(), best[j, slot].scores.tolist(), strict=True)
            ]
            yield pd.DataFrame(out, columns=[c.split(" ")[0] for c in result.split(", ")])

        parts.append(saved(rows.mapInPandas(hard_rows, result), "negatives"))
        shared.unpersist()
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("negative_score"), F.asc("negative_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
