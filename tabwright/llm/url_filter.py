"""URL allow and block decisions: longest rule first, else a hashed character n-gram model."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, bounded_sample, fit_logistic, margins, saved

DIM = 1 << 15


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def by_rules(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, null if none does.

    A rule ``name/path`` fits the host ``name`` and its subdomains when the url's path starts with ``/path``. Of rules
    of one length the one that sorts first wins. The list is an argument of the caller and becomes one expression.
    """
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: (len(r[0]), [-ord(c) for c in r[0]])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def grams(host: str, path: str, dim: int = DIM) -> tuple[np.ndarray, np.ndarray]:
    """Hashed counts, of unit length, of the 2- to 4-grams of ``^host$`` and ``^path$``, apart by a prefix."""
    found = []
    for kind, text in ((b"h", host), (b"p", path)):
        raw = b"^" + text.encode("utf-8", "surrogatepass") + b"$"
        found += [zlib.crc32(kind + raw[i : i + n]) % dim for n in (2, 3, 4) for i in range(len(raw) - n + 1)]
    idx, counts = np.unique(np.array(found, np.int32), return_counts=True)
    val = np.log1p(counts)
    return idx, val / np.sqrt((val**2).sum())


def _features(extra: str | None):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            pairs = [grams(h, p) for h, p in zip(b.host, b.path, strict=True)]
            out = pd.DataFrame({"idx": [p[0] for p in pairs], "val": [p[1] for p in pairs]})
            yield out.assign(**({extra: b[extra].to_numpy()} if extra else {}))

    return run


def fit(labelled: DataFrame, rounds: int = 30) -> np.ndarray:
    """Weights from a small table ``host, path, y`` (1: allow). With no rows they are zero."""
    return fit_logistic(saved(labelled.select("host", "path", F.col("y").cast("double").alias("y")).mapInPandas(_features("y"), "idx array<int>, val array<double>, y double"), "urls"), DIM, rounds)


def judge(pages: DataFrame, rules: list[tuple[str, str]], labelled: DataFrame | None = None, train_rows: int = 20000, id_col: str = "page_id", url_col: str = "url", rounds: int = 30) -> DataFrame:
    """Rows (id, host, path, rule, verdict, score), one for each row of ``pages``.

    ``labelled`` (``host``, ``path``, ``allow``) trains the model, distinct rows of it, of which about ``train_rows`` are taken by hash when there are
    more; rules teach it nothing, they override it. The model scores every url (``score`` is the probability of allow) and decides those
    without a rule: allow from 0.5. A null url or one without ``://`` has empty host and path
    and is judged by the model like any other; repeated rows are judged each; without a labelled table the score is 0.5.
    """
    parts = pages.select(F.col(id_col).alias("__id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    ruled = parts.withColumn("__rule", by_rules(F.col("host"), F.col("path"), rules))
    weights = np.zeros(DIM + 1)
    if labelled is not None:
        table = saved(labelled.select(ascii_lower(F.col("host")).alias("host"), "path", F.col("allow").cast("double").alias("y")).dropna().distinct(), "labelled")
        few = bounded_sample(table, F.concat_ws("/", "host", "path", F.col("y").cast("string")), train_rows, table.count())
        weights = fit(few.repartition(8), rounds)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            pairs = [grams(h, p) for h, p in zip(b.host, b.path, strict=True)]
            z = margins(pd.Series([p[0] for p in pairs]), pd.Series([p[1] for p in pairs]), weights)
            yield b.assign(score=1 / (1 + np.exp(-z)))

    flat = ruled.select("__id", "host", "path", F.col("__rule.rule").alias("rule"), F.col("__rule.verdict").alias("verdict"))
    kind = dict(pages.dtypes)[id_col]
    scored = flat.mapInPandas(score, f"__id {kind}, host string, path string, rule string, verdict string, score double")
    model = F.when(F.col("score") >= 0.5, "allow").otherwise("block")
    return scored.select(F.col("__id").alias(id_col), "host", "path", "rule", F.coalesce("verdict", model).alias("verdict"), "score")
