"""Exact top-k by inner product through M-trees."""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import saved
from .negatives import LEAST, MOST, Best, scaled, stacked

#: Squared lengths up to which products are exact as 64-bit integers, and up to which as doubles.
LONG, EXACT = float(1 << 62), float(1 << 52)
#: Trees whose centres go to every task at a time.
CENTRES = 4096


def raised(vectors: np.ndarray, top: float) -> np.ndarray:
    """One more coordinate that brings every vector to the squared length ``top``, so that a smaller distance is a larger inner product."""
    return np.column_stack([vectors, np.sqrt(np.maximum(top - (vectors**2).sum(axis=1), 0))])


def apart(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - centre) ** 2).sum(axis=1))


def most(distance, length, top: float):
    """The largest inner product that a distance to a raised point allows a query of the squared length ``length``, and a little more for rounding."""
    return (length + top - np.maximum(distance, 0) ** 2) / 2 + 1e-7 * (length + top) + 1e-6


class Node:
    """A page of an M-tree: ``rows`` of a leaf or ``children``; for each entry the distance to the page's centre."""

    def __init__(self, centre: np.ndarray):
        self.centre, self.rows, self.children, self.to_centre, self.radius = centre, None, None, None, 0.0
        self.centres = self.radii = None


def build(points: np.ndarray, rows: np.ndarray, page: int, centre: np.ndarray | None = None) -> Node:
    """The M-tree of ``points[rows]``: pages of at most ``page`` entries, split about centres among their rows."""
    node = Node(points[rows].mean(axis=0) if centre is None else centre)
    away = apart(points[rows], node.centre)
    node.radius = float(away.max())
    if len(rows) <= page:
        order = np.argsort(away, kind="stable")
        node.rows, node.to_centre = rows[order], away[order]
        return node
    # Centres at even steps of the distance order are as spread as the page itself; a row goes to the nearest.
    order = rows[np.argsort(away, kind="stable")]
    many = min(16, -(-len(rows) // page))
    chosen = [int(order[i * len(order) // many + len(order) // (2 * many)]) for i in range(many)]
    owner = np.argmin(np.stack([apart(points[rows], points[c]) for c in chosen]), axis=0)
    if len(chosen) == 1 or np.bincount(owner).max() == len(rows):  # equal points: pages by position
        parts = [rows[i : i + max(page, -(-len(rows) // 16))] for i in range(0, len(rows), max(page, -(-len(rows) // 16)))]
    else:
        parts = [rows[owner == j] for j in range(len(chosen)) if (owner == j).any()]
    node.children = [build(points, p, page) for p in parts]
    node.centres, node.radii = np.stack([c.centre for c in node.children]), np.array([c.radius for c in node.children])
    node.to_centre = apart(node.centres, node.centre)
    return node


def packed(node: Node) -> np.ndarray:
    """The order of the rows by leaf; the leaves are renumbered to it, so that a leaf's rows lie side by side."""
    order, at, stack = [], 0, [node]
    while stack:
        page = stack.pop()
        if page.rows is None:
            stack += page.children
        else:
            order.append(page.rows)
            page.rows = np.arange(at, at + len(page.rows))
            at += len(page.rows)
    return np.concatenate(order)


def search(node: Node, whole: np.ndarray, ids: np.ndarray, query: np.ndarray, own: int, top: float, k: int, floor: int) -> list[tuple[int, int]]:
    """The best ``k`` (score, id) of a packed tree for a query, ties to the smaller id; scores under ``floor`` need not be found.

    Best first by the least distance that a page's radius allows. Before a distance is computed, the stored distance to the page's centre bounds it from
    below by the triangle inequality. A bound is turned into the largest score it allows and drops an entry only when that is under the k-th score.
    """
    best: list[tuple[int, int]] = []
    q = np.append(query.astype(float), 0.0)
    length = float((q**2).sum())
    d = float(np.sqrt(((q - node.centre) ** 2).sum()))
    heap, tick = [(-most(d - node.radius, length, top), 0, d, node)], 0
    while heap:
        bound, _, d, page = heapq.heappop(heap)
        need = best[0][0] if len(best) == k else floor
        if -bound < need:
            break
        worth = most(np.abs(d - page.to_centre) - (0.0 if page.rows is not None else page.radii), length, top) >= need
        if page.rows is not None:
            if not worth.any():
                continue
            if 2 * np.count_nonzero(worth) < len(worth):
                rows = page.rows[worth]
                scores = whole[rows] @ query
            else:
                rows = page.rows
                scores = whole[rows[0] : rows[-1] + 1] @ query
            keep = (scores >= (best[0][0] if len(best) == k else floor)) & (ids[rows] != own)
            rows, scores = rows[keep], scores[keep]
            if len(rows) > 2 * k:  # only the page's own best can matter
                order = np.lexsort((ids[rows], -scores))[:k]
                rows, scores = rows[order], scores[order]
            for s, i in zip(scores.tolist(), ids[rows].tolist(), strict=True):
                if len(best) < k:
                    heapq.heappush(best, (s, -i))
                elif (s, -i) > best[0]:
                    heapq.heapreplace(best, (s, -i))
        else:
            away = apart(page.centres[worth], q)
            bounds = most(away - page.radii[worth], length, top)
            for j, b, dc in zip(np.flatnonzero(worth).tolist(), bounds.tolist(), away.tolist(), strict=True):
                if b >= need:
                    tick += 1
                    heapq.heappush(heap, (-b, tick, dc, page.children[j]))
    return [(s, -i) for s, i in best]


def long_pairs(rows: DataFrame, every: int, k: int, block: int) -> list[DataFrame]:
    """Tables (row, query_id, id, score): each task's best among the pairs with a vector too long for 64-bit products, by whole numbers of any size.

    Queries go to the tasks in blocks of ``block``; scores beyond 64 bits are held at their limits.
    """
    asked = rows.filter(F.col("id") % every == 0)
    blocks, parts = max(1, -(-asked.count() // block)), []
    for number in range(blocks):
        mine = asked.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == number).collect()
        shared = rows.sparkSession.sparkContext.broadcast([(r.row, r.id, r.plain, [int(x) for x in r.v]) for r in mine])

        def meet(batches: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            best = [Best(k) for _ in shared.value]
            for b in batches:
                vectors, ids, plain = [[int(x) for x in v] for v in b["v"]], b["id"].to_numpy(np.int64), b["plain"].to_numpy(bool)
                for (_, own, short, q), found in zip(shared.value, best, strict=True):
                    some = np.flatnonzero((ids != own) & ~(plain & short))
                    scores = [min(max(sum(x * y for x, y in zip(q, vectors[i], strict=False)), LEAST), MOST) for i in some]
                    found.add(np.array(scores, np.int64), ids[some])
            out = [(row, own, i, s) for (row, own, _, _), found in zip(shared.value, best, strict=True) for i, s in zip(found.ids.tolist(), found.scores.tolist(), strict=True)]
            yield pd.DataFrame(out, columns=["row", "query_id", "id", "score"])

        parts.append(saved(rows.select("id", "v", "plain").mapInPandas(meet, "row long, query_id long, id long, score long"), "long-pairs"))
        shared.unpersist()
    return parts


def nearest(
    table: DataFrame, every: int = 20, k: int = 20, factor: int = 64, tree_rows: int = 8192, page: int = 512, block: int = 1024, pivots: int = 256,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """Rows (query_id, rank, id, score): for each row whose id is divisible by ``every`` its ``k`` largest integer inner products with the rows of other ids.

    All vectors are indexed: each goes to the nearest of at most ``pivots`` rows (chosen by a hash), and a pivot's cell becomes one M-tree, or several if it has more than ``tree_rows``
    rows, so copies that fill a cell are many trees too. A tree is stored in the shared folder with its pages' covering radii and their entries' distances to their centres. A query first
    searches the tree of its own row; its k-th score there is the bar for all others, and it goes on only to those trees whose covering radius can reach the bar. In a tree,
    queries come in groups of about ``block`` and are answered by best-first search.

    Ties go to the smaller id. Null vectors and those with null or non-finite components take no part, nor do null ids; repeated rows count each, as candidates and as queries;
    rows that share a query's id are its own; shorter vectors are filled with zeros. Vectors longer than 2^31 after scaling are no part of the trees: their products are taken one by one in whole
    numbers, and those beyond 64 bits are held at their limits. Extra columns are not looked at; an empty table gives no rows.
    """
    spark, kind = table.sparkSession, dict(table.dtypes)[id_col]
    known = table.select(F.col(id_col).cast("long").alias("id"), scaled(F.col(vector_col), factor).alias("v")).dropna()
    known = known.withColumn("plain", F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x) <= LONG)
    facts = known.agg(F.count_if("plain").alias("n"), F.count_if(~F.col("plain")).alias("others"), F.max(F.size("v")).alias("dims")).first()
    dims, cells = int(facts.dims or 0), max(1, min(pivots, -(-facts.n // tree_rows)))
    if cells > 1:
        chosen = known.filter("plain").select("v", F.xxhash64("id", "v").alias("h"), "id").orderBy("h", "id").limit(cells).collect()
        shared = spark.sparkContext.broadcast(stacked([r.v for r in chosen], dims))

        def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                away = np.full(len(b), np.inf)
                cell, points = np.zeros(len(b), np.int64), stacked(b["v"].tolist(), dims)
                for j, pivot in enumerate(shared.value):
                    d = ((points - pivot) ** 2).sum(axis=1)
                    cell[d < away] = j
                    away = np.minimum(d, away)
                yield b.assign(cell=cell)

        dealt = known.mapInPandas(deal, "id long, v array<double>, plain boolean, cell long")
    else:
        dealt = known.withColumn("cell", F.lit(0).cast("long"))
    rows = saved(dealt.withColumn("row", F.monotonically_increasing_id()), "vectors")

    sizes = {r.cell: r.n for r in rows.filter("plain").groupBy("cell").agg(F.count("*").alias("n")).collect()}
    parts = [max(1, -(-sizes.get(c, 0) // tree_rows)) for c in range(cells)]
    first = [sum(parts[:c]) for c in range(cells)]

    def of_cell(numbers: list[int]):
        return F.get(F.array(*[F.lit(x).cast("long") for x in numbers]), F.col("cell").cast("int"))

    placed = rows.filter("plain").select("row", "id", "v", (of_cell(first) + F.pmod(F.xxhash64("row"), of_cell(parts))).alias("tree"))

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        ids, vectors = group["id"].to_numpy(), stacked(group["v"].tolist(), dims)
        top = float((vectors**2).sum(axis=1).max())
        root = build(raised(vectors, top), np.arange(len(ids)), page)
        order = packed(root)
        tree = pickle.dumps((root, vectors[order], ids[order]), protocol=5)
        return pd.DataFrame({"tree": group["tree"].iloc[:1], "pages": [tree], "centre": [root.centre], "radius": [root.radius], "top": [top]})

    index = saved(placed.groupBy("tree").applyInPandas(grow, "tree long, pages binary, centre array<double>, radius double, top double"), "m-trees")
    tops = index.select("tree", "pages", "top")

    def answer(asking: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(asking) and len(held):
            top = float(held["top"].iloc[0])
            tree, vectors, ids = pickle.loads(bytes(held["pages"].iloc[0]))
            queries = stacked(asking["v"].tolist(), dims)
            if max(top, float((queries**2).sum(axis=1).max())) > EXACT:
                vectors, queries = vectors.astype(np.int64), queries.astype(np.int64)
            for row, own, floor, q in zip(asking["row"], asking["id"], asking["floor"], queries, strict=True):
                found += [(row, own, i, int(s)) for s, i in search(tree, vectors, ids, q, own, top, k, floor)]
        return pd.DataFrame(found, columns=["row", "query_id", "id", "score"])

    def met(asking: DataFrame) -> DataFrame:
        """Answers of the trees of ``asking`` (tree, row, id, v, floor), a saved table; a tree that many ask is read once for each ``block`` of them."""
        groups = asking.groupBy("tree").agg(F.ceil(F.count("*") / block).alias("groups"))
        queries = asking.join(groups, "tree").withColumn("group", F.pmod(F.xxhash64("row", F.lit("q")), F.col("groups"))).drop("groups")
        pages = tops.join(groups, "tree").select("tree", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("group"), "pages", "top")
        return queries.groupBy("tree", "group").cogroup(pages.groupBy("tree", "group")).applyInPandas(answer, "row long, query_id long, id long, score long")

    asked = placed.filter(F.col("id") % every == 0)
    near = saved(met(saved(asked.withColumn("floor", F.lit(LEAST)), "queries")), "nearest")
    bars = near.groupBy("row").agg(F.when(F.count("*") >= k, F.min("score")).alias("floor"))
    barred = saved(asked.withColumnRenamed("tree", "home").join(bars, "row", "left").withColumn("floor", F.coalesce("floor", F.lit(LEAST))), "queries")
    found = [near]
    for start in range(0, sum(parts), CENTRES) if sum(parts) > 1 else ():
        some = index.filter(F.col("tree").between(start, start + CENTRES - 1)).select("tree", "centre", "radius", "top").collect()
        centres = spark.sparkContext.broadcast([(r.tree, np.array(r.centre), r.radius, r.top) for r in some])

        def reach(batches: Iterator[pd.DataFrame], centres=centres) -> Iterator[pd.DataFrame]:
            for b in batches:
                queries = np.column_stack([stacked(b["v"].tolist(), dims), np.zeros(len(b))])
                length, home, floor = (queries**2).sum(axis=1), b["home"].to_numpy(), b["floor"].to_numpy(float)
                for tree, centre, radius, top in centres.value:
                    worth = (home != tree) & (most(apart(queries, centre) - radius, length, top) >= floor - 1e-7 * np.abs(floor))
                    if worth.any():
                        yield b.loc[worth, ["row", "id", "v", "floor"]].assign(tree=tree)

        asking = saved(barred.mapInPandas(reach, "row long, id long, v array<double>, floor long, tree long"), "queries")
        found.append(saved(met(asking), "further"))
        centres.unpersist()
    if facts.others:
        found += long_pairs(rows, every, k, block)
    every_one = found[0]
    for f in found[1:]:
        every_one = every_one.unionByName(f)
    order = Window.partitionBy("row").orderBy(F.desc("score"), F.asc("id"))
    ranked = every_one.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").cast(kind).alias(id_col), "score")
