"""Queries on association, tests and time series."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ordering
from ..functions.columns import rounded
from ..operators import association as A
from ..operators import hypothesis as H
from ..operators import profile as P
from ..operators import timeseries as TS
from .derived import LINEITEM_NULLS, lineitem_nulls
from .profiling import MEASURES, hist_sql, pair_sql, stack
from .registry import query, table


@query("d1_pearson_pairs", f"SELECT a, b, round(corr, 6) AS corr FROM ({pair_sql(['price', 'qty', 'disc', 'ghost'], LINEITEM_NULLS)})")
def d1(spark, sf):
    return rounded(P.pearson_pairs(lineitem_nulls(spark, sf), ["price", "qty", "disc", "ghost"]))


@query(
    "d2_correlation_ratio",
    """SELECT 'o_totalprice' AS feature, round(greatest(0, 1 - (SELECT sum(n * v) / sum(n) FROM (SELECT count(*) AS n, var_samp(o_totalprice) AS v FROM orders GROUP BY o_orderstatus)) / var_samp(o_totalprice)), 9) AS eta_squared FROM orders""",
)
def d2(spark, sf):
    return rounded(A.correlation_ratio(table(spark, sf, "orders"), "o_orderstatus", ["o_totalprice"]), 9)


def chi_sql(a, b, source):
    return f"""(WITH t AS (SELECT {a} AS x, {b} AS y, count(*)::DOUBLE AS n FROM {source} WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2),
      r AS (SELECT x, sum(n) AS r FROM t GROUP BY 1), c AS (SELECT y, sum(n) AS c FROM t GROUP BY 1),
      g AS (SELECT r.x, c.y, r.r, c.c, coalesce(t.n, 0) AS o, (SELECT sum(n) FROM t) AS n FROM r CROSS JOIN c LEFT JOIN t ON t.x = r.x AND t.y = c.y),
      s AS (SELECT any_value(n) AS n, count(DISTINCT x) AS rows, count(DISTINCT y) AS cols, sum(pow(o - r * c / n, 2) / (r * c / n)) AS plain,
        sum(pow(greatest(abs(o - r * c / n) - 0.5, 0), 2) / (r * c / n)) AS yates FROM g)
      SELECT n, rows, cols, CASE WHEN rows = 2 AND cols = 2 THEN yates ELSE plain END AS chi2 FROM s)"""


PAIRS = [("l_returnflag", "l_linestatus"), ("l_returnflag", "l_linenumber"), ("l_linestatus", "l_linenumber")]


@query("d3_cramers_v", " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(sqrt(chi2 / n / (least(rows, cols) - 1)), 9) AS cramers_v FROM {chi_sql(a, b, 'lineitem')}" for a, b in PAIRS))
def d3(spark, sf):
    return rounded(A.cramers_v(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"]), 9)


def _h(cols):
    return f"(SELECT ln(sum(n)) - sum(n * ln(n)) / sum(n) FROM (SELECT count(*)::DOUBLE AS n FROM lineitem GROUP BY {cols}))"


@query("d4_theils_u", " UNION ALL ".join(f"SELECT '{x}' AS a, '{y}' AS b, round(({_h(x)} + {_h(y)} - {_h(x + ', ' + y)}) / {_h(x)}, 9) AS u" for a, b in PAIRS for x, y in ((a, b), (b, a))))
def d4(spark, sf):
    return rounded(A.theils_u(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"]), 9)


def spear_sql(a, b, source):
    return f"""SELECT '{a}' AS a, '{b}' AS b, round(corr(ra, rb), 6) AS rho FROM (SELECT rank() OVER (ORDER BY {a}) + (count(*) OVER (PARTITION BY {a}) - 1) / 2 AS ra,
      rank() OVER (ORDER BY {b}) + (count(*) OVER (PARTITION BY {b}) - 1) / 2 AS rb FROM {source} WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"""


@query("d5_spearman", spear_sql("price", "qty", LINEITEM_NULLS) + " UNION ALL " + spear_sql("price", "disc", LINEITEM_NULLS))
def d5(spark, sf):
    return rounded(A.spearman(lineitem_nulls(spark, sf), [("price", "qty"), ("price", "disc")]))


@query(
    "d6_kendall",
    """WITH t AS (SELECT p_size AS x, p_retailprice AS y FROM part),
    s AS (SELECT sum(sign(a.x - b.x) * sign(a.y - b.y)) AS s, sum(abs(sign(a.x - b.x))) AS px, sum(abs(sign(a.y - b.y))) AS py FROM t AS a, t AS b)
    SELECT 'p_size' AS a, 'p_retailprice' AS b, round(s / sqrt(px * py), 9) AS tau FROM s""",
)
def d6(spark, sf):
    return rounded(A.kendall(table(spark, sf, "part"), "p_size", "p_retailprice"), 9)


@query(
    "d6_kendall_three_levels",
    """WITH t AS (SELECT CAST(o_custkey AS DOUBLE) AS x, o_totalprice AS y FROM orders),
    s AS (SELECT sum(sign(a.x - b.x) * sign(a.y - b.y)) AS s, sum(abs(sign(a.x - b.x))) AS px, sum(abs(sign(a.y - b.y))) AS py FROM t AS a, t AS b)
    SELECT 'o_custkey' AS a, 'o_totalprice' AS b, round(s / sqrt(px * py), 9) AS tau FROM s""",
)
def d6_levels(spark, sf):
    return rounded(A.kendall(table(spark, sf, "orders"), "o_custkey", "o_totalprice", bits=5), 9)


@query(
    "d20_ecdf_two_levels",
    """WITH c AS (SELECT o_totalprice AS value, count(*) AS n FROM orders GROUP BY 1)
    SELECT value, n, CAST(sum(n) OVER (ORDER BY value) AS BIGINT) AS upto, CAST(sum(n) OVER () AS BIGINT) AS whole FROM c""",
)
def d20_levels(spark, sf):
    out = ordering.cumulative_counts(table(spark, sf, "orders"), "o_totalprice", levels=2)
    return out.select(F.col("o_totalprice").alias("value"), *[F.col(c).cast("long").alias(a) for c, a in (("__n", "n"), ("__cum", "upto"), ("__cum__all", "whole"))])


@query(
    "d7_target_corr_test",
    f"""SELECT feature, 'point_biserial' AS method, round(r, 6) AS corr, round(r * sqrt((n - 2) / (1 - r * r)), 5) AS t FROM ({stack("corr({c}, CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS r, count(*) AS n", MEASURES, 'lineitem')})""",
)
def d7(spark, sf):
    out = A.target_correlation_tests(table(spark, sf, "lineitem"), "l_linestatus", MEASURES)
    return out.select("feature", "method", F.round("corr", 6).alias("corr"), F.round("t", 5).alias("t"))


@query("d7_target_corr_p")
def d7p(spark, sf):
    return A.target_correlation_tests(table(spark, sf, "lineitem"), "l_extendedprice", ["l_quantity", "l_discount", "l_tax"])


def mi_sql(c, y, source, bins=10):
    cuts = ", ".join(str(i / bins) for i in range(1, bins))
    return f"""SELECT '{c}' AS feature, (SELECT ln(sum(n)) - sum(n * ln(n)) / sum(n) FROM (SELECT sum(n) AS n FROM z GROUP BY b)) + (SELECT ln(sum(n)) - sum(n * ln(n)) / sum(n) FROM (SELECT sum(n) AS n FROM z GROUP BY y))
       - (SELECT ln(sum(n)) - sum(n * ln(n)) / sum(n) FROM z) AS mi FROM (SELECT 1) AS u
    """, f"""(SELECT b, y, count(*)::DOUBLE AS n FROM (SELECT {y} AS y, len(list_filter(e, lambda x: x < {c})) AS b FROM {source}, (SELECT list_distinct(quantile_cont({c}::DOUBLE, [{cuts}])) AS e FROM {source}) AS q) GROUP BY 1, 2)"""


def mi_all(cols, y, source):
    parts = []
    for c in cols:
        body, z = mi_sql(c, y, source)
        parts.append(f"(WITH z AS {z} {body})")
    return " UNION ALL ".join(f"SELECT feature, round(mi, 9) AS mi FROM {p} AS p{i}" for i, p in enumerate(parts))


@query("d8_mutual_information", mi_all(MEASURES, "l_returnflag", "lineitem"))
def d8(spark, sf):
    return rounded(A.mutual_information(table(spark, sf, "lineitem"), "l_returnflag", MEASURES), 9)


def anova_sql(c, y, source):
    return f"""SELECT '{c}' AS feature, round((sum(n * pow(m - g, 2)) / (count(*) - 1)) / (sum((n - 1) * v) / (sum(n) - count(*))), 5) AS f
      FROM (SELECT count({c}) AS n, avg({c}) AS m, var_samp({c}) AS v FROM {source} GROUP BY {y}), (SELECT avg({c}) AS g FROM {source})"""


@query("d9_anova_f", " UNION ALL ".join(anova_sql(c, "l_returnflag", "lineitem") for c in MEASURES))
def d9(spark, sf):
    return rounded(A.anova_f(table(spark, sf, "lineitem"), "l_returnflag", MEASURES).select("feature", "f"), 5)


@query("d9_anova_p")
def d9p(spark, sf):
    return A.anova_f(table(spark, sf, "lineitem"), "l_returnflag", MEASURES)


@query(
    "d10_dependency_switch",
    f"""SELECT 'qty' AS feature, round(r, 6) AS pearson, rho, CASE WHEN abs(rho - r) > 0.2 THEN 'mutual_info' ELSE 'f_test' END AS method, round(r * r * (n - 2) / (1 - r * r), 2) AS score
    FROM (SELECT corr(qty, price) AS r, count(qty) AS n FROM {LINEITEM_NULLS}), ({spear_sql('qty', 'price', LINEITEM_NULLS)})""",
)
def d10(spark, sf):
    out = A.dependency_scores(lineitem_nulls(spark, sf), "price", ["qty"])
    return out.select("feature", F.round("pearson", 6).alias("pearson"), F.round("rho", 6).alias("rho"), "method", F.round("score", 2).alias("score"))


@query(
    "d11_conditional_table",
    """SELECT o_orderpriority, round(count(*) FILTER (o_orderstatus = 'F') / count(*), 9) AS "F", round(count(*) FILTER (o_orderstatus = 'O') / count(*), 9) AS "O",
    round(count(*) FILTER (o_orderstatus = 'P') / count(*), 9) AS "P", count(*) AS "__count" FROM orders GROUP BY 1""",
)
def d11(spark, sf):
    return rounded(A.conditional_table(table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus"), 9)


def ent_bins(c, source):
    return f"""SELECT '{c}' AS feature, (SELECT ln(sum(d)) - sum(d * ln(d)) / sum(d) FROM (SELECT coalesce(n / (sum(n) OVER ()) / ((hi - lo) / 20), 0) + 1e-9 AS d
      FROM range(1, 21) AS g(k) LEFT JOIN ({hist_sql([c], source, 20)}) AS h ON h.bin = g.k)) AS entropy"""


@query(
    "d12_entropy_nats",
    f"""SELECT feature, round(entropy, 6) AS entropy FROM ({ent_bins('l_extendedprice', 'lineitem')} UNION ALL {ent_bins('l_quantity', 'lineitem')} UNION ALL
    SELECT feature, -sum(p * ln(p + 1e-9)) FROM (SELECT 'l_linenumber' AS feature, count(*) / (SELECT count(*) FROM lineitem) AS p FROM lineitem GROUP BY l_linenumber
      UNION ALL SELECT 'l_returnflag', count(*) / (SELECT count(*) FROM lineitem) FROM lineitem GROUP BY l_returnflag) GROUP BY 1)""",
)
def d12(spark, sf):
    return rounded(A.entropy_nats(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity", "l_linenumber", "l_returnflag"]))


@query("d12_entropy_bits", f"SELECT feature, round((ln(sum(n)) - sum(n * ln(n)) / sum(n)) / ln(2), 6) AS entropy FROM ({hist_sql(['l_extendedprice', 'l_quantity'], 'lineitem', 20)}) GROUP BY 1")
def d12b(spark, sf):
    return rounded(A.entropy_bits(table(spark, sf, "lineitem"), ["l_extendedprice", "l_quantity"]))


@query(
    "d13_group_intervals",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, {c} AS "group", round(avg(o_totalprice), 4) AS mean, round(quantile_cont(o_totalprice, 0.025), 4) AS ci_lower,
    round(quantile_cont(o_totalprice, 0.975), 4) AS ci_upper, round(stddev_pop(o_totalprice), 4) AS std_dev, count(*) AS n FROM orders GROUP BY 2"""
        for c in ["o_orderstatus", "o_orderpriority"]
    ),
)
def d13(spark, sf):
    return rounded(H.group_intervals(table(spark, sf, "orders"), ["o_orderstatus", "o_orderpriority"], "o_totalprice"), 4)


def _side(c, v):
    return f"(SELECT count({c}) AS n{v}, avg({c}) AS m{v}, var_samp({c}) AS v{v} FROM lineitem WHERE l_linestatus = '{'F' if v == 1 else 'O'}') AS s{v}"


@query("d14_welch_t", " UNION ALL ".join(f"SELECT '{c}' AS feature, round((m1 - m2) / sqrt(v1 / n1 + v2 / n2), 6) AS t, round(pow(v1 / n1 + v2 / n2, 2) / (pow(v1 / n1, 2) / (n1 - 1) + pow(v2 / n2, 2) / (n2 - 1)), 3) AS dof FROM {_side(c, 1)}, {_side(c, 2)}" for c in MEASURES))
def d14(spark, sf):
    out = H.t_tests(table(spark, sf, "lineitem"), "l_linestatus", MEASURES)
    return out.select("feature", F.round("t", 6).alias("t"), F.round("dof", 3).alias("dof"))


@query("d14_pooled_t", " UNION ALL ".join(f"SELECT '{c}' AS feature, round((m1 - m2) / sqrt(((n1 - 1) * v1 + (n2 - 1) * v2) / (n1 + n2 - 2) * (1 / n1 + 1 / n2)), 6) AS t, (n1 + n2 - 2)::DOUBLE AS dof FROM {_side(c, 1)}, {_side(c, 2)}" for c in MEASURES))
def d14p(spark, sf):
    return rounded(H.t_tests(table(spark, sf, "lineitem"), "l_linestatus", MEASURES, equal_var=True).select("feature", "t", "dof"))


@query("d15_normal_interval", stack("round(avg({c}) - 1.959963984540 * stddev_samp({c}), 6) AS lower, round(avg({c}) + 1.959963984540 * stddev_samp({c}), 6) AS upper", MEASURES, "lineitem"))
def d15(spark, sf):
    return rounded(H.normal_intervals(table(spark, sf, "lineitem"), MEASURES))


@query("d16_bootstrap_ci")
def d16(spark, sf):
    return H.bootstrap_ci(table(spark, sf, "customer"), ["c_acctbal"], n_iter=1000)


WHOLE = 1 << 64


@query(
    "d16_bootstrap_mean",
    f"""WITH v AS (SELECT c_acctbal AS x, count(*) AS n, CAST('0x' || substr(md5('42|0|' || CAST(c_acctbal AS VARCHAR)), 1, 15) AS UBIGINT) AS key FROM customer WHERE c_acctbal IS NOT NULL GROUP BY 1),
    a AS (SELECT x, n, b, ((key::UHUGEINT + (b + 1)::UHUGEINT * {0x9E3779B97F4A7C15}) % {WHOLE})::UBIGINT AS z FROM v CROSS JOIN range(200) AS r(b)),
    c AS (SELECT x, n, b, ((xor(z, z // {1 << 30})::UHUGEINT * {0xBF58476D1CE4E5B9}) % {WHOLE})::UBIGINT AS z FROM a),
    d AS (SELECT x, n, b, ((xor(z, z // {1 << 27})::UHUGEINT * {0x94D049BB133111EB}) % {WHOLE})::UBIGINT AS z FROM c),
    e AS (SELECT x, n, b, (xor(z, z // {1 << 31}) // 2048)::DOUBLE / {float(1 << 53)} AS u FROM d),
    t AS (SELECT n, k, sum(exp(-n + k * ln(n) - lgamma(k + 1))) OVER (PARTITION BY n ORDER BY k) AS upto FROM (SELECT DISTINCT n FROM v) CROSS JOIN range(60) AS r(k)),
    p AS (SELECT n, list(upto ORDER BY k) AS steps FROM t GROUP BY n),
    w AS (SELECT b, x, len(list_filter(steps, lambda s: s < u)) AS w FROM e JOIN p USING (n)),
    m AS (SELECT b, sum(w * x) / sum(w) AS m FROM w GROUP BY b)
    SELECT 'c_acctbal' AS feature, round(quantile_cont(m, 0.025), 6) AS mean_lower, round(quantile_cont(m, 0.975), 6) AS mean_upper FROM m""",
)
def d16_mean(spark, sf):
    found = H.bootstrap_ci(table(spark, sf, "customer"), ["c_acctbal"], n_iter=200)
    return found.select("feature", F.round("mean_lower", 6).alias("mean_lower"), F.round("mean_upper", 6).alias("mean_upper"))


G1 = "(skewness({c}) * (count({c}) - 2) / sqrt(count({c}) * (count({c}) - 1.0)))"


@query("d17_jarque_bera", stack(f"count({{c}}) AS n, round(count({{c}}) / 6 * (pow({G1}, 2) + pow(kurtosis_pop({{c}}), 2) / 4), 3) AS jb", MEASURES, "lineitem"))
def d17(spark, sf):
    return rounded(H.normality(table(spark, sf, "lineitem"), MEASURES).select("feature", "n", "jb"), 3)


@query("d17_normality_p")
def d17p(spark, sf):
    return H.normality(table(spark, sf, "supplier"), ["s_acctbal"])


@query("d24_mardia")
def d24(spark, sf):
    return H.mardia(table(spark, sf, "lineitem"), MEASURES)


@query(
    "d25_breusch_pagan",
    """WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem),
    e AS (SELECT l_quantity AS x, pow(l_extendedprice - a - b * l_quantity, 2) AS e2 FROM lineitem, f)
    SELECT round(count(*) * pow(corr(x, e2), 2), 4) AS lm FROM e""",
)
def d25(spark, sf):
    return rounded(H.breusch_pagan(table(spark, sf, "lineitem"), "l_extendedprice", ["l_quantity"]).select("lm"), 4)


DAILY = """(SELECT d.day, coalesce(s.v, 0.0) AS value FROM (SELECT unnest(generate_series(min(ts)::DATE, max(ts)::DATE, INTERVAL 1 DAY))::DATE AS day FROM events) AS d
  LEFT JOIN (SELECT ts::DATE AS day, sum(value) AS v FROM events GROUP BY 1) AS s USING (day))"""


@query("d28_daily", f"SELECT CAST(day AS VARCHAR) AS day, round(value, 6) AS value FROM {DAILY}")
def d28(spark, sf):
    return rounded(TS.daily(table(spark, sf, "events"), "ts", "value").withColumn("day", F.col("day").cast("string")))


ODAILY = DAILY.replace("FROM events", "FROM orders").replace("ts", "o_orderdate").replace("sum(value)", "sum(o_totalprice)")


@query(
    "d29_decompose",
    f"""WITH s AS (SELECT day, value, row_number() OVER (ORDER BY day) - 1 AS pos FROM {ODAILY}),
    t AS (SELECT *, CASE WHEN lag(value, 6) OVER w IS NOT NULL AND lead(value, 6) OVER w IS NOT NULL THEN
      (sum(value) OVER (ORDER BY day ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING) + (lag(value, 6) OVER w + lead(value, 6) OVER w) / 2) / 12 END AS trend FROM s WINDOW w AS (ORDER BY day)),
    p AS (SELECT pos % 12 AS ph, avg(value - trend) AS raw FROM t GROUP BY 1)
    SELECT CAST(day AS VARCHAR) AS day, round(value, 3) AS value, round(trend + 0.00001, 3) AS trend, round(raw - (SELECT avg(raw) FROM p), 3) AS seasonal, round(value - trend - (raw - (SELECT avg(raw) FROM p)), 3) AS residual FROM t JOIN p ON p.ph = t.pos % 12""",
)
def d29(spark, sf):
    s = TS.daily(table(spark, sf, "orders"), "o_orderdate", "o_totalprice")
    # Twelfths of cents can sit on a rounding tie; the small shift on both sides moves them off it.
    out = TS.decompose(s).withColumns({"day": F.col("day").cast("string"), "trend": F.col("trend") + 0.00001})
    return rounded(out, 3)


@query(
    "d30_acf",
    f"""WITH s AS (SELECT day, value - avg(value) OVER () AS d, row_number() OVER (ORDER BY day) AS k FROM {ODAILY})
    SELECT CAST(g AS INTEGER) AS lag, round((SELECT sum(a.d * b.d) FROM s AS a JOIN s AS b ON b.k = a.k - g) / (SELECT sum(d * d) FROM s), 6) AS acf FROM range(0, 21) AS r(g)""",
)
def d30(spark, sf):
    s = TS.daily(table(spark, sf, "orders"), "o_orderdate", "o_totalprice")
    return rounded(TS.autocorrelation(s).select("lag", "acf"))


@query("d30_pacf")
def d30p(spark, sf):
    return TS.autocorrelation(TS.daily(table(spark, sf, "orders"), "o_orderdate", "o_totalprice"))
