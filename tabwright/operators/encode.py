"""Category encoders, binning, date, geographic and text features.

Level tables are grouped results joined by key: Spark broadcasts the small ones
and splits a skewed key in the large ones. Nothing is windowed by category, as
one category may hold a third of the rows.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import IDF, CountVectorizer, HashingTF, RegexTokenizer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ordering
from ..functions.columns import agg_long, hash_unit, is_missing, observed, text_cols
from .association import quantile_bins

# Distinct-share thresholds of the encoder choice.
ONEHOT_SHARE, ORDINAL_SHARE, FREQUENCY_SHARE = 0.05, 0.20, 0.50
MAX_ONEHOT_LEVELS = 5000


def route_encoders(df: DataFrame, cols: Sequence[str] | None = None, onehot: float = ONEHOT_SHARE, ordinal: float = ORDINAL_SHARE, frequency: float = FREQUENCY_SHARE) -> DataFrame:
    """``(feature, n_levels, distinct_share, linear, tree)``: the encoder per model family; nulls count as a level.

    A small share can still be many levels: beyond ``MAX_ONEHOT_LEVELS`` columns, one-hot gives way to frequency.
    """
    names = list(cols or text_cols(df))
    n = F.col("n")
    one = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_distinct(F.col(f"`{c}`")).alias(f"d{i}") for i, c in enumerate(names)],
        *[F.max(is_missing(df, c).cast("int")).alias(f"z{i}") for i, c in enumerate(names)],
    )
    rows = [F.struct(F.lit(c).alias("feature"), (F.col(f"d{i}") + F.col(f"z{i}")).alias("n_levels"), ((F.col(f"d{i}") + F.col(f"z{i}")) / n).alias("distinct_share")) for i, c in enumerate(names)]
    share, many = F.col("distinct_share"), F.col("n_levels") > MAX_ONEHOT_LEVELS
    tree = F.when((share <= onehot) & many, "frequency").when(share <= onehot, "onehot").when(share <= ordinal, "ordinal").when(share <= frequency, "frequency").otherwise("suggest_target")
    linear = F.when((share <= onehot) & ~many, "onehot").when(share <= frequency, "frequency").otherwise("suggest_target")
    return one.select(F.inline(F.array(*rows))).select("feature", "n_levels", "distinct_share", linear.alias("linear"), tree.alias("tree"))


def levels_of(df: DataFrame, c: str, limit: int = MAX_ONEHOT_LEVELS) -> list:
    """Sorted levels; more than ``limit`` of them cannot be columns and are refused."""
    found = df.select(c).filter(F.col(c).isNotNull()).distinct().limit(limit + 1).collect()
    if len(found) > limit:
        raise ValueError(f"{c} has more than {limit} levels: use hashing, frequency or target encoding")
    return sorted(r[0] for r in found)


def one_hot(df: DataFrame, cols: Sequence[str], levels: Mapping[str, Sequence] | None = None, drop: bool = True) -> DataFrame:
    """``<col>_<level>`` 1.0 / 0.0; an unseen level is all zeros."""
    out = {}
    for c in cols:
        for v in (levels or {}).get(c) or levels_of(df, c):
            out[f"{c}_{v}"] = F.coalesce((F.col(f"`{c}`") == F.lit(v)).cast("double"), F.lit(0.0))
    wide = df.withColumns(out)
    return wide.drop(*cols) if drop else wide


def frequency_table(df: DataFrame, c: str) -> DataFrame:
    counts = df.groupBy(c).agg(F.count(F.lit(1)).alias("__n"))
    return counts.filter(F.col(c).isNotNull()).select(c, (F.col("__n") / counts.agg(F.sum("__n")).scalar()).alias(f"{c}_freq"))


def frequency_encode(df: DataFrame, c: str, table: DataFrame | None = None) -> DataFrame:
    out = df.join(table if table is not None else frequency_table(df, c), c, "left")
    return out.withColumn(f"{c}_freq", F.coalesce(f"{c}_freq", F.lit(0.0)))


def ordinal_table(df: DataFrame, c: str) -> DataFrame:
    """``(level, <col>_ord)``: index in sorted order, computed over range partitions."""
    return ordering.dense_index(df.select(c).filter(F.col(c).isNotNull()).distinct(), c, f"{c}_ord")


def ordinal_encode(df: DataFrame, c: str, table: DataFrame | None = None) -> DataFrame:
    out = df.join(table if table is not None else ordinal_table(df, c), c, "left")
    return out.withColumn(f"{c}_ord", F.coalesce(f"{c}_ord", F.lit(-1)).cast("long"))


def encode_variants(df: DataFrame, cols: Sequence[str] | None = None, **thresholds: float) -> dict[str, DataFrame]:
    """Frames for linear, tree and neighbour models from one set of level tables."""
    names = list(cols or text_cols(df))
    routes = {r["feature"]: r for r in route_encoders(df, names, **thresholds).collect()}
    hot = [c for c in names if routes[c]["tree"] == "onehot"]
    levels = {c: levels_of(df, c) for c in hot}
    freq = {c: frequency_table(df, c) for c in names if "frequency" in (routes[c]["linear"], routes[c]["tree"])}
    out = {}
    for family in ("linear", "tree", "knn"):
        frame = one_hot(df, hot, levels) if hot else df
        for c in names:
            how = routes[c]["linear" if family == "knn" else family]
            if how == "frequency":
                frame = frequency_encode(frame, c, freq[c]).drop(c)
            elif how == "ordinal":
                frame = ordinal_encode(frame, c).drop(c)
            elif how == "suggest_target" and family == "linear":
                frame = frame.drop(c)
        out[family] = frame
    return out


def hash_encode(df: DataFrame, c: str, buckets: int = 64) -> DataFrame:
    return df.withColumn(f"{c}_hash", F.pmod(F.xxhash64(F.col(c)), F.lit(buckets)).cast("int"))


def md5_bucket(c: Column, buckets: int) -> Column:
    """A bucket other systems can reproduce: the first eight MD5 digits modulo ``buckets``."""
    return F.pmod(F.conv(F.substring(F.md5(c.cast("string")), 1, 8), 16, 10).cast("long"), F.lit(buckets)).cast("int")


def target_table(df: DataFrame, c: str, target: str) -> DataFrame:
    """``(level, __s, __n)`` sums and counts of the target per level."""
    return df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.sum(observed(df, target)).alias("__s"), F.count(observed(df, target)).cast("double").alias("__n"))


def _global_mean(df: DataFrame, target: str) -> Column:
    return df.agg(F.avg(observed(df, target))).scalar()


def target_encode(df: DataFrame, c: str, target: str, smoothing: float = 10.0, train: DataFrame | None = None) -> DataFrame:
    """``<col>_te`` = (n mean_c + m mean) / (n + m); unseen levels get the global mean."""
    base = train if train is not None else df
    g = _global_mean(base, target)
    out = df.join(target_table(base, c, target), c, "left")
    return out.withColumn(f"{c}_te", F.coalesce((F.col("__s") + smoothing * g) / (F.col("__n") + smoothing), g)).drop("__s", "__n")


def leave_one_out(df: DataFrame, c: str, target: str) -> DataFrame:
    y = observed(df, target)
    out = df.join(target_table(df, c, target), c, "left")
    return out.withColumn(f"{c}_loo", F.coalesce(F.try_divide(F.col("__s") - y, F.col("__n") - 1), _global_mean(df, target))).drop("__s", "__n")


def kfold_target(df: DataFrame, c: str, target: str, fold: Column, smoothing: float = 0.0) -> DataFrame:
    """Out-of-fold means: level totals minus the fold's own share; ``fold`` is a small integer Column."""
    y = observed(df, target)
    marked = df.withColumn("__f", fold)
    per = marked.groupBy(c, "__f").agg(F.sum(y).alias("__fs"), F.count(y).cast("double").alias("__fn"))
    all_ = per.groupBy(c).agg(F.sum("__fs").alias("__s"), F.sum("__fn").alias("__n"))
    table = per.join(all_, c).select(c, "__f", (F.col("__s") - F.col("__fs")).alias("__os"), (F.col("__n") - F.col("__fn")).alias("__on"))
    g = _global_mean(df, target)
    out = marked.join(table, [c, "__f"], "left")
    enc = F.try_divide(F.col("__os") + smoothing * g, F.col("__on") + smoothing)
    return out.withColumn(f"{c}_kf", F.coalesce(enc, g)).drop("__f", "__os", "__on")


def bayes_encode(df: DataFrame, c: str, target: str, alpha: float = 1.0, beta: float = 1.0, train: DataFrame | None = None) -> DataFrame:
    out = df.join(target_table(train if train is not None else df, c, target), c, "left")
    enc = (alpha + F.col("__s")) / (alpha + beta + F.col("__n"))
    return out.withColumn(f"{c}_bayes", F.coalesce(enc, F.lit(alpha / (alpha + beta)))).drop("__s", "__n")


def james_stein_table(df: DataFrame, c: str, target: str) -> DataFrame:
    """``(level, <col>_js)`` with one shrinkage factor for all levels; the global mean if it is undefined."""
    t = target_table(df, c, target).withColumn("__p", F.col("__s") / F.col("__n"))
    g = _global_mean(df, target)
    spread = t.agg(F.sum(F.col("__n") * F.pow(F.col("__p") - g, 2))).scalar()
    k = t.agg(F.count(F.lit(1))).scalar()
    shrink = 1 - F.try_divide((k - 3) * g * (1 - g), F.when(spread > 1e-12, spread))
    return t.select(c, F.coalesce(g + shrink * (F.col("__p") - g), g).alias(f"{c}_js"))


def james_stein(df: DataFrame, c: str, target: str, train: DataFrame | None = None) -> DataFrame:
    base = train if train is not None else df
    out = df.join(james_stein_table(base, c, target), c, "left")
    return out.withColumn(f"{c}_js", F.coalesce(f"{c}_js", _global_mean(base, target)))


def ordered_target(df: DataFrame, c: str, target: str, order: str, tie: str | None = None, prior_weight: float = 1.0) -> DataFrame:
    """Mean of earlier rows of the level only, with the global mean as ``prior_weight`` rows.

    A running sum inside ordered buckets, so that a hot level is spread out.
    """
    y = F.coalesce(observed(df, target), F.lit(0.0))
    run = ordering.running(df, order, {"__s": y, "__n": F.lit(1)}, [c], tie=tie).drop("__s__all", "__n__all")
    g = _global_mean(df, target)
    own = F.coalesce(observed(df, target), F.lit(0.0))
    enc = (F.col("__s") - own + prior_weight * g) / (F.col("__n") - 1 + prior_weight)
    return run.withColumn(f"{c}_ord_te", enc).drop("__s", "__n")


def woe_table(df: DataFrame, c: str, target: str, smoothing: float = 0.5) -> DataFrame:
    """``(level, <col>_woe)`` = ln(share of ones / share of zeros), counts smoothed."""
    t = target_table(df, c, target)
    good, bad = F.col("__s"), F.col("__n") - F.col("__s")
    tot = t.agg(F.struct(F.sum("__s").alias("g"), F.sum(F.col("__n") - F.col("__s")).alias("b"))).scalar()
    woe = F.ln((good + smoothing) / (tot["g"] + 2 * smoothing) / ((bad + smoothing) / (tot["b"] + 2 * smoothing)))
    return t.select(c, woe.alias(f"{c}_woe"))


def woe_encode(df: DataFrame, c: str, target: str, smoothing: float = 0.5, train: DataFrame | None = None) -> DataFrame:
    out = df.join(woe_table(train if train is not None else df, c, target, smoothing), c, "left")
    return out.withColumn(f"{c}_woe", F.coalesce(f"{c}_woe", F.lit(0.0)))


def equal_width(df: DataFrame, cols: Sequence[str], bins: int = 5) -> DataFrame:
    """``<col>_bin`` 0-based; the span comes from one pass."""
    span = {r["feature"]: r for r in agg_long(df, cols, {"lo": F.min, "hi": F.max}).collect()}
    out = {}
    for c in cols:
        lo, hi = span[c]["lo"], span[c]["hi"]
        width = ((hi - lo) / bins) if lo is not None and hi > lo else 1.0
        out[f"{c}_bin"] = F.least(F.floor((observed(df, c) - lo) / width), F.lit(bins - 1)).cast("int")
    return df.withColumns(out)


def cut(x: Column, edges: Sequence[float], right: bool = False) -> Column:
    """Number of edges at or below x (below x with ``right``); left-closed bins by default."""
    total = F.lit(0)
    for e in edges:
        total = total + ((x > F.lit(e)) if right else (x >= F.lit(e))).cast("int")
    return F.when(x.isNotNull(), total)


def quantile_cut(df: DataFrame, cols: Sequence[str], bins: int = 5) -> DataFrame:
    edges = quantile_bins(df, cols, bins)
    return df.withColumns({f"{c}_qbin": cut(observed(df, c), edges.get(c, []), right=True) for c in cols})


def kmeans_bins(df: DataFrame, c: str, bins: int = 5, seed: int = 42) -> DataFrame:
    """Bins around 1-D cluster centres, numbered by centre; the borders are midpoints."""
    ready = VectorAssembler(inputCols=["__x"], outputCol="__v").transform(df.select(observed(df, c).alias("__x")).dropna())
    centres = sorted(float(m[0]) for m in KMeans(k=bins, seed=seed, featuresCol="__v").fit(ready).clusterCenters())
    return df.withColumn(f"{c}_kbin", cut(observed(df, c), [(a + b) / 2 for a, b in zip(centres, centres[1:])]))


def tree_thresholds(df: DataFrame, c: str, target: str, depth: int = 3) -> list[float]:
    """Split points of a shallow tree on one column; the target is a class index."""
    ready = VectorAssembler(inputCols=["__x"], outputCol="features").transform(
        df.select(observed(df, c).alias("__x"), F.col(target).cast("double").alias("label")).dropna()
    )
    model = DecisionTreeClassifier(maxDepth=depth).fit(ready)
    cuts: set[float] = set()

    def walk(node) -> None:
        if node.numDescendants() > 0:
            cuts.add(float(node.split().threshold()))
            walk(node.leftChild())
            walk(node.rightChild())

    walk(model._java_obj.rootNode())
    return sorted(cuts)


def tree_bins(df: DataFrame, c: str, target: str, depth: int = 3) -> DataFrame:
    return df.withColumn(f"{c}_tbin", cut(observed(df, c), tree_thresholds(df, c, target, depth), right=True))


def custom_bins(df: DataFrame, c: str, edges: Sequence[float]) -> DataFrame:
    """Left-closed bins between user edges; NULL outside."""
    x = observed(df, c)
    return df.withColumn(f"{c}_cbin", F.when((x >= edges[0]) & (x < edges[-1]), cut(x, list(edges)[1:-1])))


def binarize(df: DataFrame, c: str, threshold: float) -> DataFrame:
    return df.withColumn(f"{c}_flag", (observed(df, c) > threshold).cast("int"))


def date_parts(df: DataFrame, ts: str) -> DataFrame:
    t = F.col(ts)
    year = F.year(t)
    return df.withColumns(
        {
            f"{ts}_year": year,
            f"{ts}_month": F.month(t),
            f"{ts}_day": F.dayofmonth(t),
            f"{ts}_dow": F.weekday(t),
            f"{ts}_hour": F.hour(t),
            f"{ts}_quarter": F.quarter(t),
            f"{ts}_semester": F.when(F.month(t) <= 6, 1).when(F.month(t) > 6, 2),
            f"{ts}_decade": (F.floor(year / 10) * 10).cast("int"),
            f"{ts}_century": (F.floor(year / 100) * 100).cast("int"),
        }
    )


def cyclical(df: DataFrame, name: str, value: Column, period: float) -> DataFrame:
    angle = 2 * math.pi * value / period
    return df.withColumns({f"{name}_sin": F.sin(angle), f"{name}_cos": F.cos(angle)})


def calendar_flags(df: DataFrame, ts: str, holidays: DataFrame | None = None) -> DataFrame:
    """``is_day`` (6 to 18 h), ``is_weekend``, and ``is_holiday`` from a ``(day)`` calendar table."""
    out = df.withColumns({"is_day": F.hour(ts).between(6, 17).cast("int"), "is_weekend": (F.weekday(ts) >= 5).cast("int")})
    if holidays is None:
        return out
    cal = holidays.select(F.to_date("day").alias("__day"), F.lit(1).alias("__hol")).distinct()
    return out.withColumn("__d", F.to_date(ts)).join(cal, F.col("__d") == F.col("__day"), "left").withColumn("is_holiday", F.coalesce("__hol", F.lit(0))).drop("__d", "__day", "__hol")


def boolean_flag(df: DataFrame, c: str) -> DataFrame:
    """Y/N, yes/no, true/false and 1/0 as 1 and 0; anything else is NULL."""
    low = F.lower(F.trim(F.col(c).cast("string")))
    return df.withColumn(f"{c}_bool", F.when(low.isin("y", "yes", "true", "1", "t"), 1).when(low.isin("n", "no", "false", "0", "f"), 0))


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = 6371.0) -> Column:
    """Great-circle distance in kilometres."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    a = F.pow(F.sin((p2 - p1) / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * radius * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


def geo_cluster(df: DataFrame, lat: str, lon: str, k: int = 8, seed: int = 42) -> DataFrame:
    ready = VectorAssembler(inputCols=[lat, lon], outputCol="__v", handleInvalid="skip").transform(df)
    return KMeans(k=k, seed=seed, featuresCol="__v", predictionCol="geo_region").fit(ready).transform(ready).drop("__v")


def lookup_score(df: DataFrame, c: str, scores: Mapping[str, float], numerator: str | None = None, eps: float = 0.0) -> DataFrame:
    """``<col>_score`` from a small map, and ``<num>_per_<col>`` when a numerator is given."""
    mapped = F.create_map(*[F.lit(x) for kv in scores.items() for x in kv])[F.col(c)]
    out = df.withColumn(f"{c}_score", mapped)
    return out if numerator is None else out.withColumn(f"{numerator}_per_{c}", F.try_divide(observed(df, numerator), mapped + eps))


def tokens(df: DataFrame, text: str) -> DataFrame:
    return RegexTokenizer(inputCol=text, outputCol="__tokens", pattern=r"\W+").transform(df)


def text_vectors(df: DataFrame, text: str, kind: str = "tfidf", features: int = 1 << 18, min_df: float = 1.0) -> DataFrame:
    """``<text>_vec``: hashed counts, counts over a vocabulary, or TF-IDF of hashed counts."""
    words = tokens(df, text)
    name = f"{text}_vec"
    if kind == "count":
        return CountVectorizer(inputCol="__tokens", outputCol=name, vocabSize=features, minDF=min_df).fit(words).transform(words).drop("__tokens")
    tf = HashingTF(inputCol="__tokens", outputCol="__tf" if kind == "tfidf" else name, numFeatures=features).transform(words)
    if kind == "tfidf":
        tf = IDF(inputCol="__tf", outputCol=name).fit(tf).transform(tf).drop("__tf")
    return tf.drop("__tokens")


def fold_of(key: str, folds: int = 5, seed: int = 42) -> Column:
    return F.floor(hash_unit(key, seed=seed) * folds).cast("int")
