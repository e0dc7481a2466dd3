"""Exact k nearest neighbours without comparing all pairs.

Equal vectors are merged first (a group of copies is one weighted point). Donors
are cut into cells around sampled pivots, as many as half the root of their number. A query first searches its own cell,
which bounds its k-th distance; it then visits only the cells that can hold
something closer: no point of cell j is nearer than d(q, p_j) - radius_j. Cells
are cut into blocks of bounded size and the block results are merged.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import as_numbers
from ..session import cut_lineage

BLOCK_ROWS = 4096


def points(df: DataFrame, cols: Sequence[str], key: str) -> DataFrame:
    """``(pid, vec, copies)``: distinct complete vectors, named by their smallest key."""
    data = as_numbers(df, cols, [F.col(key).alias("__key")]).dropna()
    return data.groupBy(F.array(*[F.col(f"`{c}`") + 0.0 for c in cols]).alias("vec")).agg(F.min("__key").alias("pid"), F.count(F.lit(1)).alias("copies"))


def _dist(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty((len(a), len(b)))
    step = max(1, 4_000_000 // max(1, b.size))
    for s in range(0, len(a), step):
        out[s : s + step] = np.sqrt(((a[s : s + step, None, :] - b[None, :, :]) ** 2).sum(axis=2))
    return out


def _mat(col: pd.Series) -> np.ndarray:
    return np.array(col.tolist(), dtype=float)


def _top(q: pd.DataFrame, d: pd.DataFrame, k: int, skip_self: bool) -> pd.DataFrame:
    """Nearest donors of each query until their copies add up to k."""
    if not len(q) or not len(d):
        return pd.DataFrame({"qid": [], "did": [], "dist": [], "copies": []})
    dist = _dist(_mat(q["vec"]), _mat(d["vec"]))
    did, copies = d["pid"].to_numpy(), d["copies"].to_numpy()
    qs, ids, ds, cs = [], [], [], []
    width = min(k + 1, len(d))
    for r, qid in enumerate(q["pid"].to_numpy()):
        near = np.argpartition(dist[r], width - 1)[:width]
        near = near[np.lexsort((did[near], dist[r][near]))]
        total = 0
        for j in near:
            n = int(copies[j]) - (1 if skip_self and did[j] == qid else 0)
            if n <= 0:
                continue
            qs.append(qid), ids.append(did[j]), ds.append(dist[r][j]), cs.append(n)
            total += n
            if total >= k:
                break
    return pd.DataFrame({"qid": qs, "did": ids, "dist": ds, "copies": cs})


def _merge(found: DataFrame, k: int) -> DataFrame:
    """The best donors of each query over all blocks, weighted so that they add up to exactly k."""
    w = Window.partitionBy("qid").orderBy("dist", "did").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("copies").over(w), F.lit(0))
    out = found.withColumn("__b", before).filter(F.col("__b") < k)
    return out.select("qid", "did", "dist", F.least(F.col("copies"), F.lit(k) - F.col("__b")).alias("weight"))


def knn(queries: DataFrame, donors: DataFrame, k: int, skip_self: bool = False) -> DataFrame:
    """``(qid, did, dist, weight)`` over two point tables; the weights of a query add up to k.

    ``skip_self`` leaves one copy of the query's own point out (same table on
    both sides).
    """
    donors = cut_lineage(donors)
    queries = donors if queries is None else cut_lineage(queries)
    n = donors.count()
    if n == 0:
        return donors.sparkSession.createDataFrame([], "qid long, did long, dist double, weight long")
    p = max(1, math.ceil(math.sqrt(n) / 2))
    sample = donors.orderBy(F.xxhash64("pid")).limit(p).select("vec").toPandas()
    pivots = _mat(sample["vec"])

    def assign(batches):
        for pdf in batches:
            if len(pdf):
                dist = _dist(_mat(pdf["vec"]), pivots)
                cell = dist.argmin(axis=1)
                yield pdf.assign(cell=cell, pd=dist[np.arange(len(pdf)), cell])

    kind = "vec array<double>, pid long, copies long, cell int, pd double"
    shape = [F.col("vec"), F.col("pid").cast("long").alias("pid"), F.col("copies").cast("long").alias("copies")]
    placed = donors.select(*shape).mapInPandas(assign, kind)
    asked = queries.select(*shape).mapInPandas(assign, kind)
    cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("pd").alias("radius"))
    stats = {r["cell"]: (r["n"], r["radius"]) for r in cells.collect()}
    used = np.array(sorted(stats))
    radius = np.array([stats[c][1] for c in used])
    blocks = {int(c): max(1, math.ceil(stats[c][0] / BLOCK_ROWS)) for c in used}

    def donor_blocks(batches):
        for pdf in batches:
            b = [int(h) % blocks[int(c)] for h, c in zip(pd.util.hash_array(pdf["pid"].to_numpy()), pdf["cell"])]
            yield pdf.assign(block=b)

    sided = placed.mapInPandas(donor_blocks, kind + ", block int")

    def visit(limit: bool):
        """Query rows repeated for every block they must look into, cut into bounded parts."""

        def run(batches):
            for pdf in batches:
                rows, cs, bs, ps = [], [], [], []
                if limit:
                    dist = _dist(_mat(pdf["vec"]), pivots[used])
                    bound = pdf["bound"].to_numpy()
                for r, own in enumerate(pdf["cell"].to_numpy()):
                    if limit:
                        where = [int(c) for c in used[(dist[r] - radius <= bound[r] * (1 + 1e-9) + 1e-12)] if c != own]
                    else:
                        where = [int(own)] if int(own) in blocks else []
                    for c in where:
                        for b in range(blocks[c]):
                            rows.append(r), cs.append(c), bs.append(b)
                out = pdf.iloc[rows][["vec", "pid", "copies"]].reset_index(drop=True)
                yield out.assign(cell=cs, block=bs)

        return run

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _top(left, right, k, skip_self)

    found_type = "qid long, did long, dist double, copies long"
    visit_type = "vec array<double>, pid long, copies long, cell int, block int"

    def look(rows: DataFrame) -> DataFrame:
        # A block holds at most BLOCK_ROWS donors; its queries are cut into parts by their id,
        # each part meeting a copy of the block, so that one crowded block is many tasks.
        load = rows.groupBy("cell", "block").agg(F.ceil(F.count(F.lit(1)) / (4 * BLOCK_ROWS)).cast("int").alias("parts"))
        q = rows.join(load, ["cell", "block"]).withColumn("part", F.pmod(F.xxhash64("pid"), F.col("parts")).cast("int")).drop("parts")
        d = sided.select("vec", "pid", "copies", "cell", "block").join(load, ["cell", "block"])
        d = d.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
        keys = ["cell", "block", "part"]
        return q.groupBy(*keys).cogroup(d.groupBy(*keys)).applyInPandas(search, found_type)

    first = _merge(look(asked.mapInPandas(visit(False), visit_type)), k)
    first = cut_lineage(first)
    bound = first.groupBy("qid").agg(F.sum("weight").alias("w"), F.max("dist").alias("d"))
    bounded = asked.join(bound, asked["pid"] == bound["qid"], "left").select(
        asked["vec"], asked["pid"], asked["copies"], asked["cell"], F.when(F.col("w") >= k, F.col("d")).otherwise(F.lit(float("inf"))).alias("bound")
    )
    more = look(bounded.mapInPandas(visit(True), visit_type))
    both = first.select("qid", "did", "dist", F.col("weight").alias("copies")).unionByName(more)
    return _merge(both, k)


def local_outlier_factor(df: DataFrame, cols: Sequence[str], key: str, k: int = 20) -> DataFrame:
    """``(pid, copies, lof)`` of every distinct point from its exact neighbours."""
    pts = points(df, cols, key)
    near = cut_lineage(knn(None, pts, k, skip_self=True))
    kdist = near.groupBy("qid").agg(F.max("dist").alias("kd"))
    reach = near.join(kdist.withColumnRenamed("qid", "did"), "did").select("qid", "did", "weight", F.greatest("dist", "kd").alias("reach"))
    lrd = reach.groupBy("qid").agg((1 / (F.sum(F.col("weight") * F.col("reach")) / F.sum("weight") + 1e-10)).alias("lrd"))
    theirs = lrd.select(F.col("qid").alias("did"), F.col("lrd").alias("lrd_d"))
    lof = near.join(theirs, "did").groupBy("qid").agg((F.sum(F.col("weight") * F.col("lrd_d")) / F.sum("weight")).alias("m"))
    out = lof.join(lrd, "qid").select(F.col("qid").alias("pid"), (F.col("m") / F.col("lrd")).alias("lof"))
    return pts.select("pid", "copies", "vec").join(out, "pid")
