"""Queries on outliers."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from ..functions.columns import rounded
from ..operators import outliers as O
from .profiling import MEASURES
from .registry import query, table

# value with a few far points, as in the fixtures.
EV = "(SELECT event_id, user_id, CASE WHEN event_id % 997 = 0 THEN value * 100 ELSE value END AS value FROM events)"
COLS = ["value", "user_id"]


def events(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", "user_id", F.when(F.col("event_id") % 997 == 0, F.col("value") * 100).otherwise(F.col("value")).alias("value"))


def stats(c):
    return f"""(SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3, quantile_cont({c}, 0.01) AS p1, quantile_cont({c}, 0.99) AS p99,
      avg({c}) AS mu, stddev_pop({c}) AS sd, median({c}) AS med, (SELECT median(abs({c} - m)) FROM {EV}, (SELECT median({c}) AS m FROM {EV})) AS mad FROM {EV})"""


def conds(c):
    return {
        "iqr": f"({c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1))",
        "zscore": f"(abs({c} - mu) / sd > 3)",
        "modz": f"(abs(0.6745 * ({c} - med) / mad) > 3.5)",
        "tukey": f"({c} < q1 - 2 * (q3 - q1) OR {c} > q3 + 2 * (q3 - q1))",
        "percentile": f"({c} < p1 OR {c} > p99)",
    }


def _rule(name, rule):
    sql = f"SELECT event_id, value, user_id, CAST({conds('value')[rule]} AS INTEGER) AS value_outlier FROM {EV}, {stats('value')}"

    @query(name, sql)
    def run(spark, sf):
        e = events(spark, sf)
        return O.flag_columns(e, O.fit_fences(e, ["value"]), rule)

    return run


for _name, _r in (("f1_iqr", "iqr"), ("f2_zscore", "zscore"), ("f3_modified_z", "modz"), ("f4_wide_fence", "tukey"), ("f5_percentile", "percentile")):
    _rule(_name, _r)


@query(
    "f6_mahalanobis",
    """WITH s AS (SELECT avg(l_quantity) AS mx, avg(l_extendedprice) AS my, var_pop(l_quantity) AS vx, var_pop(l_extendedprice) AS vy, covar_pop(l_quantity, l_extendedprice) AS c FROM lineitem),
    d AS (SELECT l_orderkey, l_linenumber, (vy * pow(l_quantity - mx, 2) - 2 * c * (l_quantity - mx) * (l_extendedprice - my) + vx * pow(l_extendedprice - my, 2)) / (vx * vy - c * c) AS md2 FROM lineitem, s)
    SELECT l_orderkey, l_linenumber, round(md2, 6) AS md2, md2 > 7.377758908227871 AS is_outlier FROM d""",
)
def f6(spark, sf):
    out = O.mahalanobis(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"])
    return out.select("l_orderkey", "l_linenumber", F.round("md2", 6).alias("md2"), "is_outlier")


@query("f7_robust_mahalanobis")
def f7(spark, sf):
    return O.robust_mahalanobis(events(spark, sf), COLS).select("event_id", "md2", "is_outlier")


@query("f8_local_outliers")
def f8(spark, sf):
    return O.local_outliers(table(spark, sf, "part"), ["p_size", "p_retailprice"], "p_partkey")


@query("f9_isolation_forest")
def f9(spark, sf):
    return O.isolation_outliers(events(spark, sf), COLS, "event_id")


@query("f10_detector_cascade")
def f10(spark, sf):
    method, out = O.multivariate_outliers(table(spark, sf, "lineitem").withColumn("rowkey", F.col("l_orderkey") * 10 + F.col("l_linenumber")), MEASURES, "rowkey")
    return out.withColumn("method", F.lit(method))


def _votes_sql():
    both = f"{EV} AS e, (SELECT q1 AS q1a, q3 AS q3a, p1 AS p1a, p99 AS p99a, mu AS mua, sd AS sda, med AS meda, mad AS mada FROM {stats('user_id')}) AS u, {stats('value')} AS v"
    a, b = conds("value"), {}
    for r, s in conds("user_id").items():
        for w in ("q1", "q3", "p99", "p1", "mu", "sd", "med", "mad"):
            s = re.sub(rf"\b{w}\b", w + "a", s)
        b[r] = s
    cols = ", ".join(f'CAST({a[r]} OR {b[r]} AS INTEGER) AS "{r}"' for r in a)
    return f"SELECT *, iqr + zscore + modz + tukey + percentile AS total_votes, iqr + zscore + modz + tukey + percentile >= 3 AS is_outlier FROM (SELECT event_id, {cols} FROM {both})"


@query("f11_votes", _votes_sql())
def f11(spark, sf):
    e = events(spark, sf)
    return O.votes(e, O.fit_fences(e, COLS)).drop(*COLS)


@query(
    "f11_rule_counts",
    " UNION ALL ".join(f"SELECT '{c}' AS feature, '{r}' AS rule, count(*) FILTER ({s}) AS n FROM {EV}, {stats(c)}" for c in COLS for r, s in conds(c).items()),
)
def f11c(spark, sf):
    e = events(spark, sf)
    return O.rule_counts(e, O.fit_fences(e, COLS))


@query("f11_full_votes")
def f11f(spark, sf):
    return O.full_votes(events(spark, sf), COLS, "event_id")


@query("f12_winsorize", f"SELECT event_id, round(least(greatest(value, p1), p99), 6) AS value FROM {EV}, {stats('value')}")
def f12(spark, sf):
    e = events(spark, sf).select("event_id", "value")
    return rounded(O.treat(e, O.fit_fences(e, ["value"]), cap=True))


@query("f12_clip_counts", f"SELECT 'value' AS feature, count(*) FILTER (value < p1 OR value > p99) AS n_clipped FROM {EV}, {stats('value')}")
def f12c(spark, sf):
    e = events(spark, sf)
    return O.clip_counts(e, O.fit_fences(e, ["value"]))


@query("f12_drop_voted", f"SELECT event_id FROM ({_votes_sql()}) WHERE NOT is_outlier")
def f12d(spark, sf):
    e = events(spark, sf)
    return O.treat(e, O.fit_fences(e, COLS), cap=False).select("event_id")


def _new_sql():
    """Rows of two fifths judged by fences of the other three, which are capped first."""
    parts, votes = [], []
    for c in COLS:
        whole, capped = f"(SELECT * FROM {EV} WHERE event_id % 5 < 3)", f"t_{c}"
        parts.append(f"{capped} AS (SELECT least(greatest({c}, lo), hi) AS {c} FROM {whole}, (SELECT quantile_cont({c}, 0.01) AS lo, quantile_cont({c}, 0.99) AS hi FROM {whole}))")
        parts.append(f"s_{c} AS {stats(c).replace(EV, capped)}")
        total = " + ".join(f"CAST({s} AS INTEGER)" for s in conds(c).values())
        votes.append(f"v_{c} AS (SELECT event_id, {total} AS n FROM {EV}, s_{c} WHERE event_id % 5 >= 3)")
    added = " + ".join(f"v_{c}.n" for c in COLS)
    joined = f"v_{COLS[0]} " + " ".join(f"JOIN v_{c} USING (event_id)" for c in COLS[1:])
    return f"WITH {', '.join(parts + votes)} SELECT event_id, {added} AS total_votes, {added} >= 3 AS is_outlier FROM {joined}"


@query("f13_flag_new", _new_sql())
def f13(spark, sf):
    e = events(spark, sf)
    known, new = e.filter("event_id % 5 < 3"), e.filter("event_id % 5 >= 3")
    train = O.treat(known, O.fit_fences(known, COLS), cap=True)
    return O.flag_new(new, train, COLS).select("event_id", "total_votes", "is_outlier")


@query(
    "f14_residual_outliers",
    """WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem),
    r AS (SELECT l_orderkey, l_linenumber, l_extendedprice - a - b * l_quantity AS e FROM lineitem, f)
    SELECT l_orderkey, l_linenumber, round(e, 4) AS residual, abs(e) > 3 * (SELECT stddev_pop(e) FROM r) AS is_outlier FROM r""",
)
def f14(spark, sf):
    out = O.residual_outliers(table(spark, sf, "lineitem"), "l_extendedprice", "l_quantity")
    return out.select("l_orderkey", "l_linenumber", F.round("residual", 4).alias("residual"), "is_outlier")


@query("f15_component_outliers")
def f15(spark, sf):
    return O.component_outliers(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *MEASURES), MEASURES).select("l_orderkey", "l_linenumber", "md2", "is_outlier")


@query(
    "f16_median_replace",
    f"SELECT event_id, CASE WHEN {conds('value')['iqr']} THEN med ELSE value END AS value, CAST({conds('value')['iqr']} AS INTEGER) AS value_outlier FROM {EV}, {stats('value')}",
)
def f16(spark, sf):
    e = events(spark, sf).select("event_id", "value")
    return O.replace_with_median(e, O.fit_fences(e, ["value"]))
