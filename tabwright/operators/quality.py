"""Ingestion checks, cleaning and row predicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import is_missing, melt_text, text_cols

# Masking and semantic patterns, spellings of truth, and cutoffs.
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b"
PHONE = r"\b\d{10,}\b"
TIME_ONLY = r"^\d{1,2}:\d{2}(:\d{2})?(\s?[APMapm]{2})?$"
ZIP = r"^\d{5}(-\d{4})?$"
CURRENCY = r"^\s*[$₹€£]?[0-9,]+(\.\d{2})?\s*$"
EMAIL_CELL = r"^[^@]+@[^@]+\.[^@]+$"
URL = r"^(http://|https://|www\.)"
DATE_HEAD = r"^\d{4}-\d{1,2}-\d{1,2}"
DURATION = r"(?i)^\s*(\d+(\.\d+)?\s*(days?|d|hours?|hrs?|h|minutes?|mins?|m|seconds?|secs?|s)[\s,]*)+(\d{1,2}:\d{2}:\d{2})?$"
DIGIT_LIKE = r"^-?[0-9]*\.?[0-9]*$"
TRUE_WORDS = ("true", "1", "yes")
FALSE_WORDS = ("false", "0", "no")
RATE = 0.9

# Bits of the per-value pattern mask, in test order.
MASKS = ("boolean", "numeric", "whole", "datetime", "time", "duration", "zip", "currency", "email", "url", "json", "geo", "long")


def mask_pii(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """E-mail addresses, then runs of ten or more digits, in every text column."""
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)] if cols is None else cols
    return df.withColumns(
        {c: F.regexp_replace(F.regexp_replace(F.col(f"`{c}`"), EMAIL, "[email]"), PHONE, "[phone]") for c in names}
    )


def _row_digest(df: DataFrame) -> Column:
    """SHA-256 of all cells, each with its length before it, so that no two different rows read alike."""
    texts = [F.col(f"`{c}`").cast("string") for c in df.columns]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("n")) for t in texts]), 256)


def audit_checksum(df: DataFrame) -> DataFrame:
    """Rows and an order-free content digest: sums modulo 2^60 of two slices of each row's SHA-256, so that doubled rows count."""
    halves = [F.conv(F.substring("d", start, 15), 16, 10).cast("decimal(20,0)") for start in (1, 16)]
    sums = [F.coalesce(F.sum(h), F.lit(0)) % F.lit(1 << 60) for h in halves]
    total = df.select(_row_digest(df).alias("d")).agg(F.count(F.lit(1)).alias("n_rows"), *[s.cast("long").alias(f"s{i}") for i, s in enumerate(sums)])
    return total.select("n_rows", F.concat(*[F.lower(F.lpad(F.hex(c), 15, "0")) for c in ("s0", "s1")]).alias("digest"))


def duplicate_rows(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of each identical group; only digests are shuffled."""
    part = df.select(*keys) if keys else df
    groups = part.select(_row_digest(part).alias("d")).groupBy("d").agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def require_rows(df: DataFrame | None) -> DataFrame:
    if df is None or df.isEmpty():
        raise ValueError("input is empty")
    return df


def drop_duplicate_rows(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    return df.dropDuplicates(list(keys)) if keys else df.distinct()


def _mask(v: Column, num: Column) -> Column:
    low = F.lower(v)
    tests = {
        "boolean": low.isin(*TRUE_WORDS, *FALSE_WORDS),
        "numeric": num.isNotNull(),
        "whole": num == F.floor(num),
        "datetime": v.rlike(DATE_HEAD) & v.try_cast("timestamp").isNotNull(),
        "time": F.trim(v).rlike(TIME_ONLY),
        "duration": v.rlike(DURATION),
        "zip": v.rlike(ZIP),
        "currency": v.rlike(CURRENCY),
        "email": v.rlike(EMAIL_CELL),
        "url": v.rlike(URL),
        "json": F.trim(v).startswith("{"),
        "geo": (num >= -180) & (num <= 180),
        "long": F.length(v) > 50,
    }
    bits = F.lit(0)
    for i, name in enumerate(MASKS):
        bits = bits + F.when(F.coalesce(tests[name], F.lit(False)), F.lit(1 << i)).otherwise(F.lit(0))
    return bits


def semantic_profile(df: DataFrame) -> DataFrame:
    """Meaning of every column: ``(feature, n_rows, n_null, n_distinct, semantic_type)``.

    Patterns are tested once per cell into a bit mask, equal values are combined
    before the shuffle (long texts by digest), and the first rule that holds wins.
    """
    numeric = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    textual = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    cells = melt_text(df, df.columns)
    v = F.col("value")
    cells = cells.withColumn("num", F.nanvl(v.try_cast("double"), F.lit(None).cast("double")))
    keyed = cells.select(
        "feature",
        F.when(F.length(v) > 64, F.sha2(v, 256)).otherwise(v).alias("k"),
        v.isNull().alias("gone"),
        _mask(v, F.col("num")).alias("mask"),
    )
    levels = keyed.groupBy("feature", "k", "gone").agg(F.count(F.lit(1)).alias("n"), F.max("mask").alias("mask"))
    hits = [F.sum(F.when(F.col("mask").bitwiseAND(1 << i) > 0, F.col("n")).otherwise(0)).alias(m) for i, m in enumerate(MASKS)]
    per = levels.groupBy("feature").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("gone"), F.col("n")).otherwise(0)).alias("n_null"),
        F.count(F.lit(1)).alias("n_levels"),
        F.count_if(~F.col("gone")).alias("n_distinct"),
        F.max("n").alias("top"),
        *hits,
    )
    known = F.col("n_rows") - F.col("n_null")
    rate = lambda name, base: F.coalesce(F.try_divide(F.col(name), base), F.lit(0.0)) > RATE
    is_num = F.col("feature").isin(*numeric) if numeric else F.lit(False)
    is_text = F.col("feature").isin(*textual) if textual else F.lit(False)
    level_share = F.col("n_levels") / F.col("n_rows")
    unique = F.col("top") == 1
    kind = (
        F.when(F.col("n_levels") == 1, "Constant / Redundant")
        .when(unique & (F.col("n_distinct") == F.col("n_rows")), "ID-like Field")
        .when(F.col("boolean") == known, "Boolean")
        .when(is_num | rate("numeric", known), F.when(rate("whole", F.col("numeric")), "Integer").otherwise("Float"))
        .when(rate("datetime", F.col("n_rows")), "Datetime")
        .when(rate("time", known), "Time Only")
        .when(rate("duration", F.col("n_rows")), "Duration / Timedelta")
        .when(rate("zip", known), "ZIP Code")
        .when(rate("currency", known), "Currency")
        .when(rate("email", known), "Email")
        .when(rate("url", known), "URL")
        .when(rate("json", known), "JSON / Dict-like")
        .when((F.col("numeric") == known) & rate("geo", F.col("n_rows")), "Geolocation")
        .when(level_share < 0.05, "Categorical")
        .when(is_text & (level_share > 0.5) & ~unique, "High Cardinality Categorical")
        .when(rate("long", known), "Text Paragraph")
        .otherwise("String / Text")
    )
    return per.select("feature", "n_rows", "n_null", "n_distinct", kind.alias("semantic_type"))


def truth_value(c: Column) -> Column:
    """true / yes / 1 and false / no / 0 in any case; anything else is NULL."""
    low = F.lower(c.cast("string"))
    return F.when(low.isin(*TRUE_WORDS), True).when(low.isin(*FALSE_WORDS), False)


def _duration(c: Column) -> Column:
    part = lambda unit: F.coalesce(
        F.nullif(F.regexp_extract(c, rf"(?i)(\d+(?:\.\d+)?)\s*{unit}", 1), F.lit("")).try_cast("double"), F.lit(0.0)
    )
    clock = [F.nullif(F.regexp_extract(c, r"(\d{1,2}):(\d{2}):(\d{2})", i), F.lit("")).try_cast("double") for i in (1, 2, 3)]
    clock = [F.coalesce(x, F.lit(0.0)) for x in clock]
    days, hours = part("d(?:ays?)?"), part("h(?:ours?|rs?)?") + clock[0]
    mins, secs = part("m(?:in(?:ute)?s?)?") + clock[1], part("s(?:ec(?:ond)?s?)?") + clock[2]
    total = days * 86400 + hours * 3600 + mins * 60 + secs
    return F.when(c.rlike(DURATION), F.make_dt_interval(secs=total.cast("decimal(18,6)")))


def convert_semantic(df: DataFrame, profile: DataFrame) -> DataFrame:
    """Columns converted by their meaning; the profile has one row per column."""
    kinds = {r["feature"]: r["semantic_type"] for r in profile.select("feature", "semantic_type").collect()}
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        text = c.cast("string")
        kind = kinds.get(f.name)
        if kind == "Boolean":
            c = truth_value(c)
        elif kind == "Integer":
            c = text.try_cast("double").try_cast("long") if isinstance(f.dataType, T.StringType) else c.try_cast("long")
        elif kind == "Float":
            c = text.try_cast("double") if isinstance(f.dataType, T.StringType) else c.try_cast("double")
        elif kind == "Datetime":
            c = c.try_cast("timestamp")
        elif kind == "Duration / Timedelta":
            c = _duration(text)
        elif kind == "Currency":
            c = F.regexp_replace(text, r"[^\d.]", "").try_cast("double")
        out.append(c.alias(f.name))
    return df.select(*out)


@dataclass(frozen=True)
class Expectation:
    """One rule: not_null, unique, between, in_set or regex."""

    kind: str
    column: str
    args: Mapping[str, Any] = field(default_factory=dict)

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.column}"

    def broken(self, df: DataFrame) -> Column:
        c, a = F.col(f"`{self.column}`"), self.args
        if self.kind == "not_null":
            return is_missing(df, self.column)
        if self.kind == "between":
            return ~c.between(a["low"], a["high"])
        if self.kind == "in_set":
            return ~c.isin(*a["values"])
        if self.kind == "regex":
            return ~c.rlike(a["pattern"])
        raise ValueError(f"unknown expectation: {self.kind}")


def validate(df: DataFrame, suite: Sequence[Expectation]) -> DataFrame:
    """``(expectation, success, detail)``: row rules share one aggregate, unique rules one grouping."""
    row_rules = [e for e in suite if e.kind != "unique"]
    unique = [e for e in suite if e.kind == "unique"]
    parts = []
    if row_rules:
        bad = df.agg(*[F.count_if(e.broken(df)).alias(f"r{i}") for i, e in enumerate(row_rules)])
        pairs = [F.struct(F.lit(e.name).alias("expectation"), F.col(f"r{i}").alias("bad")) for i, e in enumerate(row_rules)]
        parts.append(bad.select(F.inline(F.array(*pairs))))
    if unique:
        cells = melt_text(df, [e.column for e in unique]).filter(F.col("value").isNotNull())
        twice = cells.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
        counts = twice.groupBy("feature").agg(F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("bad"))
        parts.append(counts.select(F.concat(F.lit("unique:"), "feature").alias("expectation"), "bad"))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    detail = F.concat(F.col("bad").cast("string"), F.lit(" unexpected rows")).substr(1, 50)
    return out.select("expectation", (F.col("bad") == 0).alias("success"), detail.alias("detail"))


def near_constant(df: DataFrame, share: float = 0.99, cols: Sequence[str] | None = None) -> DataFrame:
    """``(feature, n_distinct, top_share, prune)``; nulls are not a value."""
    cells = melt_text(df, list(cols or df.columns))
    levels = cells.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    per = levels.groupBy("feature").agg(
        F.count("value").alias("n_distinct"),
        (F.coalesce(F.max(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)) / F.sum("n")).alias("top_share"),
    )
    return per.withColumn("prune", (F.col("n_distinct") < 2) | (F.col("top_share") >= share))


def drop_near_constant(df: DataFrame, share: float = 0.99) -> DataFrame:
    gone = [r["feature"] for r in near_constant(df, share).filter("prune").collect()]
    return df.drop(*gone)


def mixed_types(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Share of integer, float, boolean, date and text spellings among the known values."""
    cells = melt_text(df, list(cols or text_cols(df))).filter(F.col("value").isNotNull())
    v = F.col("value")
    kind = (
        F.when(v.try_cast("bigint").isNotNull(), "integer")
        .when(v.try_cast("double").isNotNull(), "float")
        .when(F.lower(v).isin("true", "false"), "boolean")
        .when(v.rlike(DATE_HEAD) & v.try_cast("timestamp").isNotNull(), "date")
        .otherwise("text")
    )
    counts = cells.select("feature", kind.alias("kind")).groupBy("feature", "kind").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("feature").agg(F.sum("n").alias("all"), F.count(F.lit(1)).alias("kinds"))
    return counts.join(F.broadcast(totals), "feature").select(
        "feature", "kind", "n", (F.col("n") / F.col("all")).alias("share"), (F.col("kinds") > 1).alias("mixed")
    )


def impossible_values(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break each named predicate, in one pass: ``(rule, n_broken)``."""
    counts = df.agg(*[F.count_if(p).alias(f"r{i}") for i, p in enumerate(rules.values())])
    return counts.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("rule"), F.col(f"r{i}").alias("n_broken")) for i, n in enumerate(rules)]))
    )


def high_cardinality(df: DataFrame, share: float = 0.10, exact: bool = False, cols: Sequence[str] | None = None) -> DataFrame:
    """Text columns whose distinct share is above ``share``."""
    names = list(cols or text_cols(df))
    count = F.count_distinct if exact else F.approx_count_distinct
    one = df.agg(F.count(F.lit(1)).alias("n"), *[count(F.col(f"`{c}`")).alias(f"d{i}") for i, c in enumerate(names)])
    rows = [
        F.struct(F.lit(c).alias("feature"), F.col(f"d{i}").alias("n_distinct"), (F.col(f"d{i}") / F.col("n")).alias("distinct_share"))
        for i, c in enumerate(names)
    ]
    return one.select(F.inline(F.array(*rows))).withColumn("high_cardinality", F.col("distinct_share") > share)


def missing_markers(df: DataFrame, max_len: int = 2, min_share: float = 0.01, cols: Sequence[str] | None = None) -> DataFrame:
    """Short, frequent strings that may stand for a missing value: ``(feature, value, share)``."""
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)] if cols is None else list(cols)
    cells = melt_text(df, names).filter(F.col("value").isNotNull())
    short = F.when(F.length("value") <= max_len, F.col("value"))
    levels = cells.select("feature", short.alias("value")).groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    totals = levels.groupBy("feature").agg(F.sum("n").alias("all"))
    return (
        levels.filter(F.col("value").isNotNull())
        .join(F.broadcast(totals), "feature")
        .select("feature", "value", (F.col("n") / F.col("all")).alias("share"))
        .filter(F.col("share") > min_share)
    )


def null_markers(df: DataFrame, markers: DataFrame) -> DataFrame:
    """Marker strings become NULL; at most ``1 / min_share`` markers exist per column."""
    by_col: dict[str, list[str]] = {}
    for r in markers.collect():
        by_col.setdefault(r["feature"], []).append(r["value"])
    return df.withColumns({c: F.when(~F.col(f"`{c}`").isin(*vs), F.col(f"`{c}`")) for c, vs in by_col.items()})


def mixed_numeric(df: DataFrame, min_share: float = 0.9, cols: Sequence[str] | None = None) -> DataFrame:
    """``(feature, digit_share, cast)`` for text columns that are mostly numbers."""
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)] if cols is None else list(cols)
    digit = lambda c: F.col(f"`{c}`").rlike(DIGIT_LIKE).cast("double")
    one = df.agg(*[F.avg(digit(c)).alias(f"s{i}") for i, c in enumerate(names)])
    rows = [F.struct(F.lit(c).alias("feature"), F.col(f"s{i}").alias("digit_share")) for i, c in enumerate(names)]
    return one.select(F.inline(F.array(*rows))).withColumn("cast", F.coalesce(F.col("digit_share") >= min_share, F.lit(False)))


def cast_mixed_numeric(df: DataFrame, min_share: float = 0.9) -> DataFrame:
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    if not names:
        return df
    chosen = [r["feature"] for r in mixed_numeric(df, min_share).filter("cast").collect()]
    return df.withColumns({c: F.col(f"`{c}`").try_cast("double") for c in chosen})


def zero_as_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.when(F.col(f"`{c}`") != 0, F.col(f"`{c}`")) for c in cols})


def clean_names(df: DataFrame, style: str = "upper") -> DataFrame:
    """Column names stripped and upper-cased, or in snake case."""
    if style == "upper":
        names = [c.strip().upper() for c in df.columns]
    else:
        words = ["".join(ch if ch.isalnum() else " " for ch in c).split() for c in df.columns]
        names = ["_".join(w).lower() for w in words]
    return df.toDF(*names)


def drop_incomplete(df: DataFrame, min_share: float | None = None) -> DataFrame:
    """Complete rows, or rows with at least ``min_share`` of their columns known."""
    if min_share is None:
        return df.dropna()
    return df.dropna(thresh=int(min_share * len(df.columns)))


def conflicting_labels(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Identical feature rows that carry more than one label."""
    pairs = df.select(*features, label).groupBy(*features, label).agg(F.count(F.lit(1)).alias("n"))
    return (
        pairs.groupBy(*features)
        .agg(F.sum("n").alias("n_rows"), F.count(label).alias("n_labels"))
        .filter(F.col("n_labels") > 1)
    )


def integrity_checks(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """``(check, n)``: duplicate samples, rows with a missing value, conflicting label groups."""
    dup = duplicate_rows(df, [*features, label]).select(F.lit("duplicate_samples").alias("check"), F.col("duplicate_rows").alias("n"))
    gone = F.lit(False)
    for c in [*features, label]:
        gone = gone | is_missing(df, c)
    miss = df.agg(F.count_if(gone).alias("n")).select(F.lit("rows_with_missing").alias("check"), "n")
    clash = conflicting_labels(df, features, label).agg(F.count(F.lit(1)).alias("n")).select(F.lit("conflicting_labels").alias("check"), "n")
    return dup.unionByName(miss).unionByName(clash)
