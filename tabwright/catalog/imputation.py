"""Queries on missing-value analysis and imputation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import rounded
from ..operators import impute as I
from ..operators.drift import ks_two_sample
from .derived import LINEITEM_NULLS, lineitem_nulls, orders_nulls
from .derived import ORDERS_NULLS as LN
from .registry import query, table

NUM = ["price", "qty", "disc"]
DRAW = "CAST(concat('0x', substr(md5(concat_ws('|', '42', CAST(rowkey AS VARCHAR))), 1, 13)) AS BIGINT) / 4503599627370496.0"


def random_sql(c):
    """rowkey and the filled column, drawing as the operator does."""
    return f"""(WITH donors AS (SELECT row_number() OVER (ORDER BY rowkey) AS rn, {c} AS donor FROM {LN} WHERE {c} IS NOT NULL),
      n AS (SELECT count(*) AS n FROM donors),
      want AS (SELECT rowkey, {c}, CASE WHEN {c} IS NULL THEN CAST(floor({DRAW} * n) AS BIGINT) + 1 END AS w FROM {LN}, n)
      SELECT rowkey, coalesce({c}, donor) AS {c} FROM want LEFT JOIN donors ON w = rn)"""


def base(spark, sf):
    return orders_nulls(spark, sf)


@query("e1_mechanism")
def e1(spark, sf):
    return I.mechanism(lineitem_nulls(spark, sf).select("price", "qty", "disc", "ghost", "flag"))


@query("e2_little_test")
def e2(spark, sf):
    return I.little_test(lineitem_nulls(spark, sf), ["price", "qty", "disc"])


@query("e3_drop_high_null", f"SELECT rowkey, price, qty FROM {LINEITEM_NULLS}")
def e3(spark, sf):
    return I.drop_high_null(lineitem_nulls(spark, sf).select("rowkey", "price", "qty", "ghost"))


@query("e4_mean_fill", f"SELECT rowkey, round(coalesce(qty, (SELECT avg(qty) FROM {LN})), 6) AS qty, round(coalesce(disc, (SELECT avg(disc) FROM {LN})), 6) AS disc FROM {LN}")
def e4(spark, sf):
    return rounded(I.mean_fill(base(spark, sf).select("rowkey", "qty", "disc"), ["qty", "disc"]))


@query("e5_median_fill", f"SELECT rowkey, coalesce(qty, (SELECT median(qty) FROM {LN})) AS qty, round(coalesce(disc, (SELECT median(disc) FROM {LN})), 6) AS disc FROM {LN}")
def e5(spark, sf):
    return rounded(I.median_fill(base(spark, sf).select("rowkey", "qty", "disc"), ["qty", "disc"]))


@query("e6_random_fill", f"SELECT * FROM {random_sql('qty')}")
def e6(spark, sf):
    return I.random_fill(base(spark, sf).select("rowkey", "qty"), "qty", "rowkey")


def _knn_sql(gone: str, seen: str) -> str:
    """Five nearest donors by one column: equal donors merge, ties go to the smaller key."""
    return f"""SELECT s_suppkey, sum(v * least(copies, 5 - before)) / sum(least(copies, 5 - before)) AS new FROM (
      SELECT *, coalesce(sum(copies) OVER (PARTITION BY s_suppkey ORDER BY dist, pid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (
        SELECT q.s_suppkey, d.*, sqrt(pow(q.{seen} - d.x, 2)) AS dist FROM (SELECT * FROM s WHERE {gone} IS NULL AND {seen} IS NOT NULL) AS q,
          (SELECT {seen} AS x, min(s_suppkey) AS pid, count(*) AS copies, avg({gone}) AS v FROM s WHERE {gone} IS NOT NULL AND {seen} IS NOT NULL GROUP BY 1) AS d))
      WHERE before < 5 GROUP BY 1"""


@query(
    "e7_knn_fill",
    f"""WITH s AS (SELECT s_suppkey, CASE WHEN s_suppkey % 5 <> 0 THEN CAST(s_nationkey AS DOUBLE) END AS s_nationkey, CASE WHEN s_suppkey % 7 <> 0 THEN s_acctbal END AS s_acctbal FROM supplier),
    a AS ({_knn_sql("s_acctbal", "s_nationkey")}), n AS ({_knn_sql("s_nationkey", "s_acctbal")})
    SELECT s.s_suppkey, round(coalesce(s.s_nationkey, n.new, (SELECT avg(s_nationkey) FROM s)), 6) AS s_nationkey, round(coalesce(s.s_acctbal, a.new, (SELECT avg(s_acctbal) FROM s)), 6) AS s_acctbal
    FROM s LEFT JOIN a USING (s_suppkey) LEFT JOIN n USING (s_suppkey)""",
)
def e7(spark, sf):
    s = table(spark, sf, "supplier").select(
        "s_suppkey",
        F.when(F.col("s_suppkey") % 5 != 0, F.col("s_nationkey").cast("double")).alias("s_nationkey"),
        F.when(F.col("s_suppkey") % 7 != 0, F.col("s_acctbal")).alias("s_acctbal"),
    )
    return rounded(I.knn_fill(s, ["s_nationkey", "s_acctbal"], "s_suppkey"))


@query("e8_mice_fill")
def e8(spark, sf):
    return I.mice_fill(base(spark, sf).select("rowkey", *NUM), NUM, "rowkey")


def _score_sql(method, filled, c="qty"):
    return f"""SELECT '{method}' AS method, round(var_pop(f.{c}) / any_value(b.v0), 6) AS variance_ratio,
      round(abs(var_pop(f.{c}) FILTER (ok) / any_value(b.c0) - 1) + abs(covar_pop(f.{c}, s.price) FILTER (ok) / any_value(b.c1) - 1) + abs(covar_pop(f.{c}, s.disc) FILTER (ok) / any_value(b.c2) - 1), 4) AS covariance_change
      FROM {filled} AS f JOIN (SELECT rowkey, price, disc, disc IS NOT NULL AS ok FROM {LN}) AS s USING (rowkey),
      (SELECT var_pop({c}) AS v0, var_pop({c}) FILTER (disc IS NOT NULL) AS c0, covar_pop({c}, price) FILTER (disc IS NOT NULL) AS c1, covar_pop({c}, disc) FILTER (disc IS NOT NULL) AS c2 FROM {LN}) AS b"""


def _fill_sql(fn, c="qty"):
    return f"(SELECT rowkey, coalesce({c}, (SELECT {fn}({c}) FROM {LN})) AS {c} FROM {LN})"


def _candidates(spark, sf):
    d = base(spark, sf).select("rowkey", *NUM)
    return d, {"mean": I.mean_fill(d, ["qty"]), "median": I.median_fill(d, ["qty"]), "random": I.random_fill(d, "qty", "rowkey")}


@query("e9_candidate_scores", " UNION ALL ".join([_score_sql("mean", _fill_sql("avg")), _score_sql("median", _fill_sql("median")), _score_sql("random", random_sql("qty"))]))
def e9(spark, sf):
    d, made = _candidates(spark, sf)
    s = I.candidate_scores(d, "qty", made, NUM)
    return s.select("method", F.round("variance_ratio", 6).alias("variance_ratio"), F.round("covariance_change", 4).alias("covariance_change"))


@query("e10_choose_candidate")
def e10(spark, sf):
    d, made = _candidates(spark, sf)
    return I.choose_candidate(I.candidate_scores(d, "qty", made, NUM))


@query("e11_collapse_rare", "SELECT p_partkey, CASE WHEN count(*) OVER (PARTITION BY p_brand) / (SELECT count(*) FROM part) >= 0.04 THEN p_brand ELSE '__RARE__' END AS p_brand FROM part")
def e11(spark, sf):
    return I.collapse_rare(table(spark, sf, "part").select("p_partkey", "p_brand"), ["p_brand"], 0.04)


@query("e12_mode_fill", f"SELECT rowkey, coalesce(flag, (SELECT flag FROM {LN} WHERE flag IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, flag LIMIT 1)) AS flag FROM {LN}")
def e12(spark, sf):
    return I.mode_fill(base(spark, sf).select("rowkey", "flag"), ["flag"])


@query("e13_constant_fill", f"SELECT rowkey, coalesce(flag, '__MISSING__') AS flag, coalesce(qty, -1.0) AS qty FROM {LN}")
def e13(spark, sf):
    d = I.constant_fill(base(spark, sf).select("rowkey", "flag", "qty"), ["flag"])
    return I.constant_fill(d, ["qty"], -1.0)


@query("e14_random_fill_text", f"SELECT * FROM {random_sql('flag')}")
def e14(spark, sf):
    return I.random_fill(base(spark, sf).select("rowkey", "flag"), "flag", "rowkey", empty="__MISSING__")


@query(
    "e15_categorical_scores",
    f"""WITH o AS (SELECT flag, count(*) AS c, count(*) / (SELECT count(flag) FROM {LN}) AS p FROM {LN} WHERE flag IS NOT NULL GROUP BY 1), n AS (SELECT count(*) AS n, count(*) - count(flag) AS gone FROM {LN}),
    m AS (SELECT flag FROM o ORDER BY c DESC, flag LIMIT 1), r AS (SELECT flag, count(*) AS c2 FROM {random_sql('flag')} GROUP BY 1)
    SELECT 'mode' AS strategy, round(1 - sum(abs(p - (c + CASE WHEN o.flag = m.flag THEN gone ELSE 0 END) / n)), 9) AS score FROM o, n, m
    UNION ALL SELECT 'constant', round(1 - sum(abs(p - c / n)), 9) FROM o, n UNION ALL SELECT 'random', round(1 - sum(abs(p - c2 / n)), 9) FROM o JOIN r USING (flag), n""",
)
def e15(spark, sf):
    return rounded(I.categorical_scores(base(spark, sf).select("rowkey", "flag"), "flag", "rowkey").drop("rank"), 9)


@query("e16_fit_apply_plan")
def e16(spark, sf):
    d = base(spark, sf).select("rowkey", "price", "qty", "disc", "flag")
    return I.apply_plan(d, I.fit_plan(d, "rowkey"), "rowkey", donors=d)


@query("e16_model_plan")
def e16m(spark, sf):
    s = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").cast("double").alias("nation"), F.when(F.col("s_suppkey") % 7 != 0, F.col("s_acctbal")).alias("balance"))
    old, new = s.filter("s_suppkey % 4 <> 0"), s.filter("s_suppkey % 4 = 0")
    plan = I.fit_plan(old, "s_suppkey", numeric_methods=("mean", "median", "random", "knn", "mice"))
    return I.apply_plan(new, plan, "s_suppkey", donors=old)


@query("e17_missing_flags", f"SELECT rowkey, qty, flag, CAST(qty IS NULL AS INTEGER) AS qty_missing_flag, CAST(flag IS NULL AS INTEGER) AS flag_missing_flag FROM {LN}")
def e17(spark, sf):
    return I.missing_flags(base(spark, sf).select("rowkey", "qty", "flag"), ["qty", "flag"])


@query("e18_simple_fill", f"SELECT rowkey, coalesce(qty, (SELECT median(qty) FROM {LN})) AS qty, coalesce(flag, 'missing') AS flag FROM {LN}")
def e18(spark, sf):
    return I.simple_fill(base(spark, sf).select("rowkey", "qty", "flag"))
