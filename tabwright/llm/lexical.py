"""Ranked lexical search by presence masks."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, saved, small_batches

#: Everything in ASCII but digits and letters parts terms.
GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
PARTING = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
#: Bits of presence that a task holds at a time (documents x words of the mask of one item).
BITS = 1 << 26
LAST = (1 << 63) - 1


def terms(text: Column) -> Column:
    """The terms of a text in order, repeats included; null has none."""
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), GAPS, -1), lambda t: t != "")


def postings(docs: DataFrame, vocabulary: dict[bytes, int], id_col: str, text_col: str) -> DataFrame:
    """Rows (id, n, terms, times): length of each whole text with a term at least, and how often it holds the terms of ``vocabulary``, by their numbers."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = shared.value.get
        for b in batches:
            out = []
            for i, text in zip(b["id"], b["text"], strict=True):
                words = bytes(text).translate(PARTING).split()
                if words:
                    seen, times = np.unique(np.array([x for x in map(number, words) if x is not None], np.int32), return_counts=True)
                    out.append((i, len(words), seen, times.astype(np.int32)))
            frame = pd.DataFrame(out, columns=["id", "n", "terms", "times"])
            yield frame.assign(id=frame["id"].astype("Int64"))

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text")).filter("text is not null")
    return rows.mapInPandas(count, "id long, n long, terms array<int>, times array<int>")


class Block:
    """Postings of one block of documents by term, with each posting's share of the score and each term's largest share."""

    def __init__(self, frame: pd.DataFrame, weights: np.ndarray, documents: int, length: int):
        self.missing = frame["id"].isna().to_numpy()
        self.ids = frame["id"].fillna(LAST).to_numpy(np.int64)
        n = frame["n"].to_numpy(np.int64)
        if 90 * int(n.max()) * documents > LAST:
            raise OverflowError("texts are too long for 64-bit scores")
        m = 10 + (90 * n * documents) // length
        lengths = np.array([len(t) for t in frame["terms"]])
        doc = np.repeat(np.arange(len(frame)), lengths)
        term = np.concatenate(frame["terms"].tolist()) if len(doc) else np.zeros(0, np.int32)
        times = np.concatenate(frame["times"].tolist()).astype(np.int64) if len(doc) else np.zeros(0, np.int64)
        order = np.argsort(term, kind="stable")
        self.doc, term, times = doc[order], term[order], times[order]
        self.share = weights[term] * ((1_000_000_000 * times) // (1000 * times + 8 * m[self.doc]))
        self.starts = np.searchsorted(term, np.arange(len(weights) + 1))
        self.largest = np.zeros(len(weights), np.int64)
        held = np.flatnonzero(np.diff(self.starts))
        if len(held):
            self.largest[held] = np.maximum.reduceat(self.share, self.starts[held])

    def part(self, term: int, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents from ``first`` up to ``last`` that hold a term, and its shares in them."""
        a, b = self.starts[term], self.starts[term + 1]
        if first > 0 or last < len(self.ids):
            a, b = a + np.searchsorted(self.doc[a:b], [first, last])
        return self.doc[a:b] - first, self.share[a:b]

    def search(self, wanted: np.ndarray, k: int, best: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """The best ``k`` (score negated, id, 1 for a null id) among ``best`` and this block's documents for the terms ``wanted``.

        A bitmap a term says which documents hold it; together they are each document's mask, and documents of one mask are a group. A mask's largest score is the sum of its terms' largest
        shares in the block. Groups are scored in descending order of that until the ``k``-th score found is above it.
        """
        wanted = wanted[self.largest[wanted] > 0]
        wanted = wanted[np.argsort(-self.largest[wanted], kind="stable")]
        words = -(-len(wanted) // 64)
        step = max(1, BITS // (64 * max(words, 1)))
        for first in range(0, len(self.ids) if words else 0, step):
            last = min(first + step, len(self.ids))
            lists = [self.part(t, first, last) for t in wanted]
            masks = np.zeros((last - first, words), np.uint64)
            for j, (docs, _) in enumerate(lists):
                masks[docs, j // 64] |= np.uint64(1 << j % 64)
            flat = masks[:, 0] if words == 1 else masks.view([("", np.uint64)] * words)[:, 0]
            distinct, group = np.unique(flat, return_inverse=True)
            distinct = distinct[:, None] if words == 1 else distinct.view(np.uint64).reshape(len(distinct), words)
            bits = np.unpackbits(np.ascontiguousarray(distinct, "<u8").view(np.uint8).reshape(len(distinct), 8 * words), axis=1, bitorder="little")[:, : len(wanted)]
            most = bits.astype(np.int64) @ self.largest[wanted]
            order = np.argsort(-most, kind="stable")
            members = np.argsort(group, kind="stable")
            starts = np.searchsorted(group[members], np.arange(len(distinct) + 1))
            at, size = 0, 1
            while at < len(order) and most[order[at]] > 0 and (len(best) < k or most[order[at]] >= -best[-1][0]):
                batch, at = order[at : at + size], at + size
                rows = np.sort(np.concatenate([members[starts[g] : starts[g + 1]] for g in batch]))
                scores = np.zeros(len(rows), np.int64)
                for docs, shares in lists:
                    place = np.minimum(np.searchsorted(docs, rows), max(len(docs) - 1, 0))
                    if len(docs):
                        scores += np.where(docs[place] == rows, shares[place], 0)
                rows = rows + first
                few = np.flatnonzero(scores >= (-best[-1][0] if len(best) == k else 1))
                few = few[np.lexsort((self.ids[rows[few]], -scores[few]))[:k]]
                best = sorted(best + [(-int(scores[i]), int(self.ids[rows[i]]), int(self.missing[rows[i]])) for i in few])[:k]
                size = min(2 * size, 1024)
        return best


def _blocks(batches: Iterator[pd.DataFrame], rows: int) -> Iterator[pd.DataFrame]:
    held, size = [], 0
    for b in batches:
        while len(b):
            part, b = b[: rows - size], b[rows - size :]
            held, size = [*held, part], size + len(part)
            if size == rows:
                yield pd.concat(held, ignore_index=True)
                held, size = [], 0
    if held:
        yield pd.concat(held, ignore_index=True)


def ranked(
    docs: DataFrame, items: DataFrame, k: int = 10, block: int = 1 << 14, pairs: int = 1 << 20,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """Rows (item, rank, id, score): for each item the ``k`` documents of the highest score above 0, ties to the smaller id.

    One pass finds each text's length and its counts of the items' terms; statistics cover all documents. Then every task takes its documents in blocks of ``block`` and searches each item's best among
    them, the k-th score so far being the bar for the next block; the tasks' best are ranked by item. Items come in blocks of about ``pairs`` pairs of item and term, which are all
    that goes to every task; there is one block unless the items are many.

    Null and empty texts and those without a term count in no statistic and are not found; rows of one item id are one item with the terms of all its texts, null being an id of its own; items without terms give no
    rows. Repeated documents count each and are ranked each; documents of a null id come last among equals. Extra columns are not looked at.
    """
    spark = docs.sparkSession
    kind = dict(items.dtypes)[item_col]
    held = saved(items.select(F.col(item_col).alias("item"), F.explode(terms(F.col(item_text))).alias("term")).distinct(), "item-terms")
    blocks = max(1, -(-held.count() // pairs))
    parts = []
    for number in range(blocks):
        mine = held.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == number).collect()
        vocabulary = {t: i for i, t in enumerate(sorted({r.term for r in mine}))}
        asked: dict = {}
        for r in mine:
            asked.setdefault(r.item, []).append(vocabulary[r.term])
        wanted = [(item, np.array(sorted(ts))) for item, ts in asked.items()]
        rows = saved(postings(docs, {t.encode(): i for t, i in vocabulary.items()}, id_col, text_col), "postings")
        facts = rows.agg(F.count("*").alias("docs"), F.sum("n").alias("length")).first()
        weights = np.zeros(len(vocabulary), np.int64)
        for r in rows.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect():
            weights[r.t] = math.floor(1000 * math.log((2 * facts.docs + 2) / (2 * r.df + 1)))

        def find(batches: Iterator[pd.DataFrame], wanted=wanted, weights=weights, facts=facts) -> Iterator[pd.DataFrame]:
            best: list[list] = [[] for _ in wanted]
            for frame in _blocks(batches, block):
                there = Block(frame, weights, facts.docs, facts.length)
                best = [there.search(ts, k, found) for (_, ts), found in zip(wanted, best, strict=True)]
            out = [(i, None if gone else doc, -score) for i, found in enumerate(best) for score, doc, gone in found]
            frame = pd.DataFrame(out, columns=["number", "id", "score"])
            yield frame.assign(id=frame["id"].astype("Int64"))

        names = spark.createDataFrame([(i, item) for i, (item, _) in enumerate(wanted)], f"number long, item {kind}")
        found = rows.mapInPandas(find, "number long, id long, score long")
        order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("id"))
        top = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        parts.append(top.join(F.broadcast(names), "number").select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
