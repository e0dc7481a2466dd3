"""One text column into many: patterns, JSON, XML, URLs, paths and more."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import melt_text, numeric_cols
from .association import is_regression, mutual_information
from .profile import target_correlations

# The patterns of the mixed split and of the extractors.
MIXED = {"alpha": r"([A-Za-z]+)", "digits": r"(\d+)", "punct": r"([^A-Za-z0-9]+)"}
HTML_TAG = r"<[^>]+>"
XML_PAIR = r"(?s)<(\w+)[^>]*>(.*?)</\1>"
MAX_LABELS = 5000
IPV4 = r"\b(\d{1,3}(?:\.\d{1,3}){3})\b"
HEX_COLOUR = r"#([0-9a-fA-F]{6}|[0-9a-fA-F]{3})\b"


def _spread(df: DataFrame, items: Column, prefix: str, width: int | None, missing: str | None = "") -> DataFrame:
    """Array items as ``<prefix>_<i>``; the width is the longest array, found by one aggregate."""
    staged = df.withColumn("__items", items)
    if width is None:
        width = staged.agg(F.max(F.size("__items"))).first()[0] or 0
    pick = lambda i: F.get("__items", F.lit(i))
    cells = {f"{prefix}_{i}": pick(i) if missing is None else F.coalesce(pick(i), F.lit(missing)) for i in range(max(width, 0))}
    return staged.withColumns(cells).drop("__items") if cells else staged.drop("__items")


def _few(found: DataFrame, limit: int = MAX_LABELS) -> list[str]:
    """Sorted distinct values that become columns; more than ``limit`` are refused."""
    rows = found.distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"more than {limit} values would become columns: name the ones you want")
    return sorted(r[0] for r in rows)


def strip_html(c: Column) -> Column:
    return F.regexp_replace(c, HTML_TAG, "")


def split_mixed(df: DataFrame, c: str, html: bool = True, widths: Mapping[str, int] | None = None) -> DataFrame:
    """All letter, digit and punctuation runs as ``<col>_<kind>_<i>``, missing as empty text."""
    text = strip_html(F.col(c)) if html else F.col(c)
    out = df
    for kind, pattern in MIXED.items():
        out = _spread(out, F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), f"{c}_{kind}", (widths or {}).get(kind))
    return out


def mixed_matches(df: DataFrame, c: str, html: bool = True) -> DataFrame:
    """The same runs as arrays ``<col>_<kind>``: no width pass and no column limit."""
    text = strip_html(F.col(c)) if html else F.col(c)
    return df.withColumns({f"{c}_{k}": F.regexp_extract_all(text, F.lit(p), F.lit(1)) for k, p in MIXED.items()})


def json_schema(df: DataFrame, c: str) -> T.StructType:
    """Schema of JSON text merged over all rows, inferred by the JSON reader."""
    session = df.sparkSession
    lines = getattr(df.select(c)._jdf, "as")(session._jvm.org.apache.spark.sql.Encoders.STRING())
    return T.StructType.fromJson(json.loads(session._jsparkSession.read().json(lines).schema().json()))


def flatten_json(df: DataFrame, c: str, schema: T.StructType | str | None = None) -> DataFrame:
    """JSON text as ``<col>_<path>`` columns; give the schema, or it is merged over all rows."""
    if schema is None:
        schema = json_schema(df, c)
    rest = [x for x in df.columns if x != c]
    parsed = df.select(*rest, F.from_json(c, schema).alias("__json"))
    paths = _paths(parsed.schema["__json"].dataType)
    return parsed.select(*rest, *[F.col("__json." + ".".join(f"`{p}`" for p in path)).alias(f"{c}_" + ".".join(path)) for path in paths])


def _paths(kind: T.StructType, head: tuple[str, ...] = ()) -> list[tuple[str, ...]]:
    out = []
    for f in kind:
        out += _paths(f.dataType, (*head, f.name)) if isinstance(f.dataType, T.StructType) else [(*head, f.name)]
    return out


def xml_map(c: Column) -> Column:
    """Tag to text of every ``<t ..>..</t>`` pair, also over several lines; the last one wins."""
    tags = F.regexp_extract_all(c, F.lit(XML_PAIR), F.lit(1))
    texts = F.regexp_extract_all(c, F.lit(XML_PAIR), F.lit(2))
    return F.aggregate(
        F.arrays_zip(tags, texts),
        F.create_map().cast("map<string,string>"),
        lambda m, p: F.map_concat(F.map_filter(m, lambda k, _: k != p["0"]), F.create_map(p["0"], p["1"])),
    )


def flatten_xml(df: DataFrame, c: str, tags: Sequence[str] | None = None) -> DataFrame:
    """``<col>_<tag>`` columns; the tags are collected when not given."""
    staged = df.withColumn("__xml", xml_map(F.col(c)))
    if tags is None:
        tags = _few(staged.select(F.explode(F.map_keys("__xml")).alias("x")))
    return staged.withColumns({f"{c}_{t}": F.col("__xml")[t] for t in tags}).drop("__xml")


def split_delimiter(df: DataFrame, c: str, delimiter: str, width: int | None = None) -> DataFrame:
    parts = F.split(F.col(c), "\\Q" + delimiter + "\\E")
    return _spread(df, parts, f"{c}_delim", width, missing=None)


def multi_label(df: DataFrame, c: str, delimiter: str, labels: Sequence[str] | None = None) -> DataFrame:
    """``<col>_lbl_<x>`` 0/1 for every label."""
    parts = F.split(F.col(c), "\\Q" + delimiter + "\\E")
    if labels is None:
        labels = _few(df.select(F.explode(parts).alias("x")).filter("x <> ''"))
    staged = df.withColumn("__parts", parts)
    return staged.withColumns({f"{c}_lbl_{x}": F.coalesce(F.array_contains("__parts", x).cast("int"), F.lit(0)) for x in labels}).drop("__parts")


def regex_all(df: DataFrame, c: str, pattern: str, width: int | None = None) -> DataFrame:
    return _spread(df, F.regexp_extract_all(F.col(c), F.lit(pattern), F.lit(1)), f"{c}_rex", width)


def parse_url(df: DataFrame, c: str) -> DataFrame:
    """scheme, netloc, path, params, query, fragment, path depth and query count."""
    u = F.col(c)
    pull = lambda pattern: F.regexp_extract(u, pattern, 1)
    path = pull(r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)")
    q = pull(r"^[^?#]*\?([^#]*)")
    return df.withColumns(
        {
            f"{c}_scheme": F.lower(pull(r"^([a-zA-Z][a-zA-Z0-9+.-]*):")),
            f"{c}_netloc": pull(r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)"),
            f"{c}_path": F.regexp_replace(path, r";[^/]*$", ""),
            f"{c}_params": F.regexp_extract(path, r";([^/]*)$", 1),
            f"{c}_query": q,
            f"{c}_fragment": pull(r"#(.*)$"),
            f"{c}_depth": F.size(F.filter(F.split(path, "/"), lambda p: p != "")),
            f"{c}_n_query": F.size(F.filter(F.split(q, "&"), lambda p: p != "")),
        }
    )


def _first(c: Column, pattern: str, group: int = 1) -> Column:
    hit = F.regexp_extract(c, pattern, group)
    return F.when(hit != "", hit)


def extract_ip(df: DataFrame, c: str) -> DataFrame:
    """First dotted quad and its octets."""
    ip = _first(F.col(c), IPV4)
    parts = {f"{c}_octet_{i}": F.get(F.split(ip, r"\."), F.lit(i)).cast("int") for i in range(4)}
    return df.withColumns({f"{c}_ip": ip, **parts})


def extract_colour(df: DataFrame, c: str) -> DataFrame:
    """First ``#rgb`` or ``#rrggbb`` with its red, green and blue values."""
    hexa = _first(F.col(c), HEX_COLOUR)
    full = F.when(F.length(hexa) == 3, F.regexp_replace(hexa, "(.)", "$1$1")).otherwise(hexa)
    part = lambda i: F.conv(F.substring(full, i, 2), 16, 10).cast("int")
    return df.withColumns({f"{c}_colour": F.concat(F.lit("#"), hexa), f"{c}_r": part(1), f"{c}_g": part(3), f"{c}_b": part(5)})


def split_path(df: DataFrame, c: str) -> DataFrame:
    """Folder, file name and extension."""
    p = F.col(c)
    return df.withColumns(
        {
            f"{c}_dir": F.regexp_extract(p, r"^(.*)[/\\][^/\\]*$", 1),
            f"{c}_file": F.regexp_extract(p, r"([^/\\]*)$", 1),
            f"{c}_ext": F.regexp_extract(p, r"[^/\\](\.[^./\\]*)$", 1),
        }
    )


def split_email(df: DataFrame, c: str) -> DataFrame:
    return df.withColumns({f"{c}_user": _first(F.col(c), r"^([^@]+)@"), f"{c}_domain": _first(F.col(c), r"@(.+)$")})


def phone_digits(df: DataFrame, c: str) -> DataFrame:
    return df.withColumn(f"{c}_digits", F.regexp_replace(F.col(c), r"\D", ""))


def evaluate_splits(df: DataFrame, new_cols: Sequence[str], target: str | None = None, min_mi: float | None = None, min_corr: float | None = None) -> DataFrame:
    """``(feature, non_null_ratio, n_unique, score, applied, reason)`` per new column."""
    levels = melt_text(df, new_cols).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    per = levels.groupBy("feature").agg(
        (F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)) / F.sum("n")).alias("non_null_ratio"), F.count("value").alias("n_unique")
    )
    if target is None:
        return per.withColumns({"score": F.lit(None).cast("double"), "applied": F.lit(True), "reason": F.lit("no metric")})
    if is_regression(df, target):
        name, limit = "abs_corr", min_corr
        s = target_correlations(df, target, [c for c in new_cols if c in numeric_cols(df)]).select("feature", F.abs("corr").alias("score"))
    else:
        name, limit = "mutual_info", min_mi
        s = mutual_information(df, target, new_cols, regression=False).select("feature", F.col("mi").alias("score"))
    out = per.join(s, "feature", "left")
    if limit is None:
        return out.withColumns({"applied": F.lit(True), "reason": F.lit("no metric")})
    ok = F.coalesce(F.col("score") >= limit, F.col("score").isNull())
    why = F.when(F.col("score").isNull(), "no metric").otherwise(F.format_string(f"{name} %.4f %s threshold {limit}", F.col("score"), F.when(ok, ">=").otherwise("<")))
    return out.withColumns({"applied": ok, "reason": why})
