"""Benchmark decontamination: size-partitioned MinHash containment search, verified on exact shingles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, let, saved

#: Rows of the sketch table (two numbers each) up to which it is broadcast; a longer one is joined by a shuffle.
BROADCAST_ROWS = 1_000_000
#: The same for tables of digests.
BROADCAST_MARKS = 200_000


def words(text: Column) -> Column:
    """Runs of letters and digits, lower-cased; null has none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")


def _shingled(tokens: Column, width: int, each) -> Column:
    """Distinct ``each(words i to i + width - 1)``; empty for fewer than ``width`` words."""
    return let(tokens, lambda w: F.when(F.size(w) >= width, F.array_distinct(F.transform(F.sequence(F.lit(0), F.size(w) - width), lambda i: each([F.get(w, i + k) for k in range(width)])))))


def shingle_hashes(tokens: Column, width: int) -> Column:
    return _shingled(tokens, width, lambda ws: F.xxhash64(*ws))


def shingles(tokens: Column, width: int) -> Column:
    return F.coalesce(_shingled(tokens, width, lambda ws: F.concat_ws(" ", *ws)), F.array().cast("array<string>"))


def sketches(items: DataFrame, least: float, width: int) -> DataFrame:
    """Rows (h, no) of the MinHash sketch of each item (no, text).

    Items are partitioned by the power of two of their shingle count n. A text that holds ``least`` of an item's shingles lacks n - ceil(least n) at
    most, so one more than that, taken as the smallest hashes, cannot all be missing; a partition's sketch length is that of its largest n. The search so loses no item.
    """
    sized = items.withColumn("hs", F.array_sort(shingle_hashes(words(F.col("text")), width))).withColumn("n", F.size("hs")).filter("n > 0")
    largest = F.pow(F.lit(2.0), F.floor(F.log2("n")) + 1) - 1
    length = (largest - F.ceil(F.lit(least) * largest - 1e-9) + 1).cast("int")
    return sized.select(F.explode(F.slice("hs", F.lit(1), length)).alias("h"), "no")


def digest(text: Column) -> Column:
    """Stands for the whole text where texts are compared."""
    return F.sha2(text.cast("binary"), 256)


def _if_few(df: DataFrame, rows: int) -> DataFrame:
    """``df``, a saved table, for a broadcast if it has at most ``rows`` rows; a longer one is left to a shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def found(texts: DataFrame, items: DataFrame, least: float, width: int) -> DataFrame:
    """Saved rows (``digest``, ``no``, ``n_shingles``, ``n_found``, ``containment``) of the texts (``text``) that hold items (``no``, ``text``, a saved table).

    Pairs of a text's digest and an item's number are made distinct and saved before anything is verified, so neither texts nor shingles go through the search; then
    every distinct text is fetched once, and each pair verified once on the shingles themselves.
    """
    texts = texts.filter("text is not null")
    sketch = _if_few(saved(sketches(items, least, width), "sketch"), BROADCAST_ROWS)
    probes = texts.select(digest(F.col("text")).alias("digest"), F.explode(shingle_hashes(words(F.col("text")), width)).alias("h"))
    pairs = saved(probes.join(sketch, "h").select("digest", "no").distinct(), "pairs")
    marks = _if_few(saved(pairs.select("digest").distinct(), "marks"), BROADCAST_MARKS)
    held = texts.select(digest(F.col("text")).alias("digest"), "text").join(marks, "digest", "left_semi").groupBy("digest").agg(F.any_value("text").alias("doc"))
    both = pairs.join(held, "digest").join(items.select("no", F.col("text").alias("item")), "no")
    counted = let(F.struct(shingles(words(F.col("item")), width).alias("a"), shingles(words(F.col("doc")), width).alias("b")), lambda s: F.struct(F.size(s["a"]).cast("long").alias("n_shingles"), F.size(F.array_intersect(s["a"], s["b"])).cast("long").alias("n_found")))
    checked = saved(both.select("digest", "no", counted.alias("c")).select("digest", "no", "c.n_shingles", "c.n_found", (F.col("c.n_found") / F.col("c.n_shingles")).alias("containment")), "verified")
    return checked.filter(F.col("containment") >= least - 1e-12)


def contained(docs: DataFrame, items: DataFrame, least: float = 0.8, width: int = 5, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """Rows (id, item, ``n_shingles``, ``n_found``, ``containment``) for documents with at least ``least`` of an item's word shingles.

    Every shingle hash of every whole text is looked up in the sketches; the few (text, item) pairs that share one are verified on the shingles themselves.
    The sketch table (two numbers a row) depends on the benchmark only; it is broadcast up to ``BROADCAST_ROWS`` rows, counted first. Items under ``width`` words
    (null and empty ones too) take no part, since so little proves nothing; null and empty texts hold no item. Repeated documents or items with
    one id give one row a pair, that with the most shingles found; a null id is kept as a value of its own.
    """
    bench = saved(items.select(F.col(item_col).alias("item_id"), F.col(item_text).alias("text")).distinct().withColumn("no", F.monotonically_increasing_id()), "items")
    hits = found(docs.select(F.col(text_col).alias("text")), bench.select("no", "text"), least, width)
    named = saved(hits.join(bench.select("no", "item_id"), "no").drop("no"), "hits")
    rows = docs.select(F.col(id_col).alias("id"), digest(F.col(text_col)).alias("digest")).join(_if_few(named, BROADCAST_MARKS), "digest")
    best = rows.groupBy("id", "item_id").agg(F.max(F.struct("containment", "n_found", "n_shingles")).alias("m"))
    return best.select(F.col("id").alias(id_col), F.col("item_id").alias(item_col), "m.n_shingles", "m.n_found", "m.containment")


def clean(docs: DataFrame, items: DataFrame, least: float = 0.8, width: int = 5, text_col: str = "text", item_text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text holds an item; null and empty texts stay, and repeated rows fall or stay together."""
    bench = saved(items.select(F.col(item_text).alias("text")).distinct().withColumn("no", F.monotonically_increasing_id()), "items")
    hits = found(docs.select(F.col(text_col).alias("text")), bench, least, width)
    marked = saved(hits.select(F.col("digest").alias(free_name(docs, "digest"))).distinct(), "leaking")
    return docs.join(_if_few(marked, BROADCAST_MARKS), digest(docs[text_col]) == F.col(marked.columns[0]), "left_anti")
