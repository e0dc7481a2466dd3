"""Queries on the health report and the univariate profile."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import rounded
from ..operators import profile as P
from .derived import LINEITEM_NULLS, lineitem_nulls
from .registry import query, table

MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def stack(template: str, names, source: str) -> str:
    """The same SELECT for many columns; ``{c}`` is the column."""
    return " UNION ALL ".join(f"SELECT '{c}' AS feature, {template.format(c=c)} FROM {source}" for c in names)


def flagship(spark, sf):
    """Null rate, skew and outlier count of every numeric lineitem column."""
    li = table(spark, sf, "lineitem")
    skew = P.agg_long(li, P.numeric_cols(li), {"skew": P.corrected_skew})
    miss = P.missingness(li, P.numeric_cols(li))
    return (
        P.iqr_outlier_counts(li)
        .join(F.broadcast(skew), "feature")
        .join(F.broadcast(miss), "feature")
        .select("feature", "null_rate", F.round("skew", 6).alias("skew"), "n_outliers")
        .orderBy(F.desc("n_outliers"), "feature")
    )


NUMS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", *MEASURES]


def _outliers(names, source, k=1.5):
    t = "count(*) FILTER ({{c}} < q1 - {k} * (q3 - q1) OR {{c}} > q3 + {k} * (q3 - q1)) AS n_outliers".format(k=k)
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {t.format(c=c)} FROM {source} AS s, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {source}) AS q"
        for c in names
    )


query(
    "c0_health_profile",
    f"""SELECT o.feature, 0.0::DOUBLE AS null_rate, s.skew, o.n_outliers FROM ({_outliers(NUMS, 'lineitem')}) AS o
    JOIN ({stack('round(skewness({c}), 6) AS skew', NUMS, 'lineitem')}) AS s USING (feature)""",
)(flagship)


@query("c1_regime", "SELECT count(*) AS n_rows, 11 AS n_cols, printf('%d/%d=%.2f', 11, count(*), 11 / count(*)) AS ratio, 'n>>p' AS regime FROM lineitem")
def c1(spark, sf):
    return P.regime(table(spark, sf, "lineitem"))


@query(
    "c2_missingness",
    f"""WITH r AS ({stack('avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE AS null_rate', ['l_orderkey', 'l_linenumber', 'rowkey', 'price', 'qty', 'disc', 'ghost', 'flag', 'status'], LINEITEM_NULLS)})
    SELECT feature, round(null_rate, 9) AS null_rate, round((SELECT avg(null_rate) FROM r), 9) AS overall_rate FROM r ORDER BY null_rate DESC, feature LIMIT 10""",
)
def c2(spark, sf):
    return rounded(P.missingness_report(lineitem_nulls(spark, sf)), 9)


@query("c3_type_counts", "SELECT * FROM (VALUES ('bigint', 3), ('int', 1), ('double', 4), ('string', 2), ('timestamp_ntz', 1)) AS t(dtype, n_cols)")
def c3(spark, sf):
    return P.type_counts(table(spark, sf, "lineitem"))


@query("c4_skew", f"SELECT feature, round(skew, 6) AS skew FROM ({stack('skewness({c}) AS skew', NUMS, 'lineitem')}) ORDER BY skew DESC LIMIT 10")
def c4(spark, sf):
    return rounded(P.skew_report(table(spark, sf, "lineitem")))


@query("c5_cardinality", stack("count(DISTINCT {c}) AS n_distinct", ["p_name", "p_brand", "p_type"], "part"))
def c5(spark, sf):
    return P.cardinality(table(spark, sf, "part"))


@query("c6_iqr_outliers", _outliers(["event_id", "user_id", "value"], "events"))
def c6(spark, sf):
    return P.iqr_outlier_counts(table(spark, sf, "events"))


HALF = "(SELECT l_quantity, l_extendedprice, l_discount, l_extendedprice * (1 - l_discount) AS net, l_extendedprice * 2 + l_tax AS dbl FROM lineitem)"


def _half(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_quantity", "l_extendedprice", "l_discount",
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
        (F.col("l_extendedprice") * 2 + F.col("l_tax")).alias("dbl"),
    )


def pair_sql(cols, source):
    return " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS corr FROM {source}" for i, a in enumerate(cols) for b in cols[i + 1 :]
    )


@query("c7_collinear", f"SELECT a, b, round(abs(corr), 6) AS corr FROM ({pair_sql(['l_quantity', 'l_extendedprice', 'l_discount', 'net', 'dbl'], HALF)}) WHERE abs(corr) > 0.9")
def c7(spark, sf):
    return rounded(P.collinear_pairs(_half(spark, sf)))


@query(
    "c8_vif",
    """WITH m AS (SELECT sum(l_quantity * l_quantity) AS aa, sum(l_quantity * l_extendedprice) AS ab, sum(l_extendedprice * l_extendedprice) AS bb FROM lineitem)
    SELECT 'l_quantity' AS feature, round(1 / (1 - ab * ab / (aa * bb)), 6) AS vif FROM m UNION ALL SELECT 'l_extendedprice', round(1 / (1 - ab * ab / (aa * bb)), 6) FROM m""",
)
def c8(spark, sf):
    return rounded(P.vif(table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice")))


@query("c8_vif_intercept", "SELECT f AS feature, round(1 / (1 - pow(corr(net, l_extendedprice), 2)), 5) AS vif FROM (SELECT *, l_extendedprice * (1 - l_discount) AS net FROM lineitem), (VALUES ('net'), ('l_extendedprice')) AS t(f) GROUP BY f")
def c8i(spark, sf):
    return rounded(P.vif(_half(spark, sf).select("net", "l_extendedprice"), intercept=True), 5)


@query("c9_imbalance", "SELECT o_orderstatus AS value, count(*) AS n, round(count(*) / (SELECT count(*) FROM orders), 9) AS share FROM orders GROUP BY 1")
def c9(spark, sf):
    return rounded(P.shares(table(spark, sf, "orders"), "o_orderstatus"), 9)


@query("c10_date_check", "SELECT 'o_orderdate' AS feature, 1.0::DOUBLE AS parsed_rate, CAST(min(o_orderdate) AS VARCHAR) AS first, CAST(max(o_orderdate) AS VARCHAR) AS last FROM orders")
def c10(spark, sf):
    out = P.date_check(table(spark, sf, "orders"), ["o_orderdate"])
    return out.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("first", "last")})


@query("c11_batch_shares", "SELECT l_linenumber AS value, count(*) AS n, round(count(*) / (SELECT count(*) FROM lineitem), 9) AS share FROM lineitem GROUP BY 1")
def c11(spark, sf):
    return rounded(P.shares(table(spark, sf, "lineitem"), "l_linenumber"), 9)


DESCRIBE = """count({c}) AS "count", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, min({c})::DOUBLE AS min, max({c})::DOUBLE AS max,
  count(*) - count({c}) AS missing, round(quantile_cont({c}, 0.25), 6)::DOUBLE AS p25, round(quantile_cont({c}, 0.5), 6)::DOUBLE AS p50, round(quantile_cont({c}, 0.75), 6)::DOUBLE AS p75"""


@query("c12_describe", stack(DESCRIBE, ["price", "qty", "disc", "ghost"], LINEITEM_NULLS))
def c12(spark, sf):
    return rounded(P.describe_numeric(lineitem_nulls(spark, sf), ["price", "qty", "disc", "ghost"]))


@query(
    "c12_describe_text",
    f"""WITH c AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, {c} AS v, count(*) AS n FROM {LINEITEM_NULLS} GROUP BY 2" for c in ['flag', 'status'])})
    SELECT feature, CAST(sum(n) FILTER (v IS NOT NULL) AS BIGINT) AS "count", count(v) AS "unique", CAST(coalesce(sum(n) FILTER (v IS NULL), 0) AS BIGINT) AS missing,
      min(v) FILTER (n = m AND v IS NOT NULL) AS top, any_value(m) AS freq FROM (SELECT *, max(CASE WHEN v IS NOT NULL THEN n END) OVER (PARTITION BY feature) AS m FROM c) GROUP BY feature""",
)
def c12t(spark, sf):
    return P.describe_text(lineitem_nulls(spark, sf))


@query("c13_basic_profile", stack("CASE WHEN '{c}' = 'o_totalprice' THEN 'double' WHEN '{c}' LIKE '%key' THEN 'bigint' ELSE 'string' END AS dtype, count(*) AS n_rows, 5 AS n_cols, count(*) - count({c}) AS n_missing, count(DISTINCT {c}) AS n_unique", ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"], "orders"))
def c13(spark, sf):
    return P.basic_profile(table(spark, sf, "orders").drop("o_orderdate"))


@query("c13_value_counts", " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS value, count(*) AS n FROM part GROUP BY 2" for c in ["p_brand", "p_type"]))
def c13v(spark, sf):
    return P.value_counts(table(spark, sf, "part"), ["p_brand", "p_type"])


POP_SKEW = "skewness({c}) * (count({c}) - 2) / sqrt(count({c}) * (count({c}) - 1.0))"


@query("c14_shape_moments", stack(f"round({POP_SKEW}, 6) AS skewness, round(kurtosis_pop({{c}}), 6) AS kurtosis", ["value", "user_id"], "events"))
def c14(spark, sf):
    return rounded(P.shape_moments(table(spark, sf, "events"), ["value", "user_id"]))


@query("c16_missing_by_class", " UNION ALL ".join(f"SELECT status, '{c}' AS feature, round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END)::DOUBLE, 9) AS null_rate FROM {LINEITEM_NULLS} GROUP BY 1" for c in ["price", "qty", "disc", "ghost"]))
def c16(spark, sf):
    return rounded(P.missing_by_class(lineitem_nulls(spark, sf), "status", ["price", "qty", "disc", "ghost"]), 9)


def hist_sql(cols, source, bins):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, CAST(least(floor(({c} - lo) / ((hi - lo) / {bins})) + 1, {bins}) AS INTEGER) AS bin, count(*) AS n, min(lo) AS lo, max(hi) AS hi
        FROM {source} AS s, (SELECT min({c})::DOUBLE AS lo, max({c})::DOUBLE AS hi FROM {source}) AS b WHERE {c} IS NOT NULL GROUP BY 2"""
        for c in cols
    )


@query("c17_histogram", hist_sql(["l_extendedprice", "l_quantity"], "lineitem", 20))
def c17(spark, sf):
    return P.histogram(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"], 20)


@query("c18_target_distribution", f"SELECT CAST(bin AS VARCHAR) AS bar, n FROM ({hist_sql(['o_totalprice'], 'orders', 10)})")
def c18(spark, sf):
    return P.target_distribution(table(spark, sf, "orders"), "o_totalprice")


@query("c18_target_classes", "SELECT o_orderpriority AS bar, count(*) AS n FROM orders GROUP BY 1")
def c18c(spark, sf):
    return P.target_distribution(table(spark, sf, "orders"), "o_orderpriority")


@query("c19_target_correlations", stack("round(corr({c}, l_extendedprice), 6) AS corr", ["l_quantity", "l_discount", "l_tax", "l_linenumber"], "lineitem"))
def c19(spark, sf):
    li = table(spark, sf, "lineitem")
    return rounded(P.target_correlations(li, "l_extendedprice", ["l_quantity", "l_discount", "l_tax", "l_linenumber"]))
