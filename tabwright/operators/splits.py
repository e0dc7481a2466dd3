"""Train, validation and test splits, balancing, checks and trivial baselines."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import ordering
from ..functions.columns import as_numbers, hash_unit, null_safe_join, observed
from ..session import cut_lineage
from . import neighbors
from .evaluate import classification_metrics, regression_metrics

# Split weights and the over-sampling neighbourhood.
WEIGHTS = (("train", 0.8), ("val", 0.1), ("test", 0.1))
SMOTE_NEIGHBOURS = 5


def _label(position: Column, total: Column, weights: Sequence[tuple[str, float]]) -> Column:
    """Split name of a 1-based position: cut at the rounded cumulative weights."""
    at, out = 0.0, None
    for name, w in weights[:-1]:
        at += w
        cond = position <= F.round(total * F.lit(round(at, 12)))
        out = F.when(cond, name) if out is None else out.when(cond, name)
    return out.otherwise(weights[-1][0])


def stratified_split(df: DataFrame, key: str, target: str | None = None, weights: Sequence[tuple[str, float]] = WEIGHTS, seed: int = 42) -> DataFrame:
    """``split`` column with exact sizes per class (or overall), by order of a keyed hash.

    The position inside a class comes from ordered buckets of the hash, so a class
    holding most rows is still spread out. ``key`` must be unique and numeric.
    """
    keys = [target] if target else []
    drawn = df.withColumn("__u", hash_unit(key, seed=seed))
    placed = ordering.row_index(drawn, "__u", key, keys)
    return placed.withColumn("split", _label(F.col("__rn"), F.col("__rn__all"), weights)).drop("__u", "__rn", "__rn__all")


def hash_split(df: DataFrame, key: str, weights: Sequence[tuple[str, float]] = WEIGHTS, seed: int = 42) -> DataFrame:
    """``split`` column by key hash alone: no shuffle, sizes approximate, a key (group) stays together."""
    return df.withColumn("split", _by_share(hash_unit(key, seed=seed), weights))


def _by_share(u: Column, weights: Sequence[tuple[str, float]]) -> Column:
    at, out = 0.0, None
    for name, w in weights[:-1]:
        at += w
        out = F.when(u < round(at, 12), name) if out is None else out.when(u < round(at, 12), name)
    return out.otherwise(weights[-1][0])


def time_split(df: DataFrame, ts: str, test_share: float = 0.2) -> DataFrame:
    """Rows after the exact time quantile are the test set."""
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    cut = ordering.quantiles(df.select(micros.alias("t")), "t", [1 - test_share]).select(F.get("q", F.lit(0))).scalar()
    return df.withColumn("split", F.when(micros > cut, "test").otherwise("train"))


def kfold(df: DataFrame, key: str, folds: int = 5, target: str | None = None, seed: int = 42) -> DataFrame:
    """``fold`` column: by key hash, or dealt out evenly inside every class."""
    if target is None:
        return df.withColumn("fold", F.floor(hash_unit(key, seed=seed) * folds).cast("int"))
    drawn = df.withColumn("__u", hash_unit(key, seed=seed))
    placed = ordering.row_index(drawn, "__u", key, [target])
    return placed.withColumn("fold", F.pmod(F.col("__rn") - 1, F.lit(folds)).cast("int")).drop("__u", "__rn", "__rn__all")


def smote(df: DataFrame, cols: Sequence[str], target: str, key: str, k: int = SMOTE_NEIGHBOURS, seed: int = 42) -> DataFrame:
    """Rows ``(cols, target, synthetic)`` with minority classes raised to the majority size.

    Each class gets exact neighbours among its own rows; a synthetic row lies at a
    seeded point between a row and one of its k neighbours. Float targets are
    returned unchanged.
    """
    names = list(cols)
    base = as_numbers(df, names, [F.col(key), F.col(target)]).dropna()
    out = base.select(*names, target).withColumn("synthetic", F.lit(False))
    if isinstance(df.schema[target].dataType, (T.DoubleType, T.FloatType)):
        return out
    sizes = {r[target]: r["n"] for r in base.groupBy(target).agg(F.count(F.lit(1)).alias("n")).collect()}
    top = max(sizes.values())
    for label, n in sorted(sizes.items(), key=lambda kv: str(kv[0])):
        need = top - n
        if need == 0 or n < 2:
            continue
        rows = base.filter(F.col(target) == F.lit(label))
        pts = neighbors.points(rows, names, key)
        near = cut_lineage(neighbors.knn(None, pts, k, skip_self=True))
        # Neighbour copies become ranges 0..k-1, from which each synthetic row draws one.
        vecs = pts.select("pid", "vec")
        listed = near.join(vecs.select(F.col("pid").alias("did"), F.col("vec").alias("dvec")), "did")
        bag = listed.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("dist", "did", "weight", "dvec"))).alias("bag"), F.sum("weight").alias("wk"))
        here = F.array(*[F.col(f"`{c}`") + 0.0 for c in names])
        seats = rows.select(F.col(key).alias("__key"), here.alias("vec")).join(vecs, "vec").join(bag, F.col("pid") == F.col("qid"))
        # Every row gets need // n copies; the first need % n rows by keyed hash get one more.
        extra = ordering.row_index(seats.withColumn("__u", hash_unit("__key", seed=seed)), "__u", "__key")
        times = F.lit(need // n) + (F.col("__rn") <= need % n).cast("int")
        made = extra.filter(times > 0).withColumn("__copy", F.explode(F.sequence(F.lit(1), times)))
        pick = F.floor(hash_unit("__key", "__copy", seed=seed + 1) * F.col("wk"))
        gap = hash_unit("__key", "__copy", seed=seed + 2)
        walk = F.aggregate(
            "bag",
            F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("array<double>").alias("v")),
            lambda s, b: F.struct(
                (s["seen"] + b["weight"]).alias("seen"), F.when(s["v"].isNull() & (pick < s["seen"] + b["weight"]), b["dvec"]).otherwise(s["v"]).alias("v")
            ),
        )["v"]
        new = made.withColumn("__v", walk).withColumn("__g", gap)
        cells = [(F.get("vec", F.lit(i)) + F.col("__g") * (F.get("__v", F.lit(i)) - F.get("vec", F.lit(i)))).alias(c) for i, c in enumerate(names)]
        out = out.unionByName(new.select(*cells, F.lit(label).cast(df.schema[target].dataType).alias(target), F.lit(True).alias("synthetic")))
    return out


def near_miss(df: DataFrame, cols: Sequence[str], target: str, key: str, k: int = 3) -> DataFrame:
    """All minority rows and, of every other class, as many rows closest on average to their k nearest minority rows."""
    names = list(cols)
    sizes = {r[target]: r["n"] for r in df.groupBy(target).agg(F.count(F.lit(1)).alias("n")).collect()}
    minority = min(sizes, key=lambda v: (sizes[v], str(v)))
    few = df.filter(F.col(target) == F.lit(minority))
    rest = df.filter(F.col(target) != F.lit(minority))
    vec = F.array(*[observed(df, c) + 0.0 for c in names])
    pts = neighbors.points(rest, names, key)
    near = neighbors.knn(pts, neighbors.points(few, names, key), k)
    mean = near.groupBy("qid").agg((F.sum(F.col("dist") * F.col("weight")) / F.sum("weight")).alias("__d"))
    scored = pts.join(mean, pts["pid"] == mean["qid"]).select(F.col("vec").alias("__vec"), "__d")
    placed = rest.withColumn("__vec", vec).join(scored, "__vec").drop("__vec")
    kept = ordering.row_index(placed, "__d", key, [target]).filter(F.col("__rn") <= sizes[minority])
    return few.unionByName(kept.select(*df.columns))


def overlap(train: DataFrame, test: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key rows of the test set that also occur in the training set."""
    return test.select(*keys).join(train.select(*keys).distinct(), list(keys), "left_semi").distinct()


def equal_to_target(df: DataFrame, target: str, cols: Sequence[str] | None = None) -> DataFrame:
    """``(feature, equals_target)`` by one null-safe comparison per column in one pass."""
    names = [c for c in (cols or df.columns) if c != target]
    t = F.col(f"`{target}`").cast("string")
    one = df.agg(*[F.min(F.col(f"`{c}`").cast("string").eqNullSafe(t)).alias(f"e{i}") for i, c in enumerate(names)])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"e{i}").alias("equals_target")) for i, c in enumerate(names)])))


def split_shares(df: DataFrame, target: str, split: str = "split") -> DataFrame:
    """``(split, target, n, share)``: target distribution inside each split."""
    counts = df.groupBy(split, target).agg(F.count(F.lit(1)).alias("n"))
    total = counts.groupBy(split).agg(F.sum("n").alias("all"))
    return counts.join(F.broadcast(total), split).select(split, target, "n", (F.col("n") / F.col("all")).alias("share"))


def regression_baselines(train: DataFrame, test: DataFrame, target: str) -> DataFrame:
    """``(strategy, mae, mse, r2, ...)`` of the training mean and median on the test set."""
    mean = train.agg(F.avg(target)).scalar()
    median = ordering.quantiles(train, target, [0.5]).select(F.get("q", F.lit(0))).scalar()
    parts = [regression_metrics(test.withColumn("__p", p), target, "__p").withColumn("strategy", F.lit(n)) for n, p in (("mean", mean), ("median", median))]
    return reduce(lambda a, b: a.unionByName(b), parts)


def class_baselines(train: DataFrame, test: DataFrame, target: str, key: str, seed: int = 42) -> DataFrame:
    """``(strategy, accuracy, f1, precision, recall, ...)`` of the most frequent class, stratified and uniform draws.

    Classes are few by nature; their shares are collected, draws come from the row key.
    """
    counts = sorted(((str(r[0]), r["n"]) for r in train.filter(F.col(target).isNotNull()).groupBy(target).agg(F.count(F.lit(1)).alias("n")).collect()))
    n = sum(c for _, c in counts)
    top = min(v for v, c in counts if c == max(x for _, x in counts))
    u = hash_unit(key, seed=seed)

    def draw(shares: Sequence[float]) -> Column:
        at, out = 0.0, None
        for (v, _), s in list(zip(counts, shares))[:-1]:
            at += s
            out = F.when(u < at, v) if out is None else out.when(u < at, v)
        return out.otherwise(counts[-1][0]) if out is not None else F.lit(counts[0][0])

    plans = {"most_frequent": F.lit(top), "stratified": draw([c / n for _, c in counts]), "uniform": draw([1 / len(counts)] * len(counts))}
    text = test.withColumn("__y", F.col(target).cast("string"))
    parts = [classification_metrics(text.withColumn("__p", p), "__y", "__p").withColumn("strategy", F.lit(name)) for name, p in plans.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """``weight`` = n / (k n_c) joined to every row."""
    counts = df.groupBy(target).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.struct(F.sum("__n").alias("n"), F.count(F.lit(1)).alias("k"))).scalar()
    table = counts.select(target, (total["n"] / (total["k"] * F.col("__n"))).alias("weight"))
    return null_safe_join(df, table, [target], "left")
