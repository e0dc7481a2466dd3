"""Queries on drift and monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import rounded
from ..operators import association as A
from ..operators import distributions as X
from ..operators import drift as D
from ..operators import hypothesis as H
from ..operators import models as M
from ..operators import profile as P
from .profiling import hist_sql
from .registry import query, table
from .sources_quality import scratch

CUT = "1996-01-01"
REF = f"(SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '{CUT}')"
NEW = f"(SELECT * REPLACE (l_extendedprice * 1.2 AS l_extendedprice) FROM lineitem WHERE l_shipdate >= TIMESTAMP '{CUT}')"
COLS = ["l_extendedprice", "l_quantity", "l_discount"]


def sides(spark, sf):
    li = table(spark, sf, "lineitem")
    old = F.col("l_shipdate") < F.lit(CUT).cast("timestamp_ntz")
    return li.filter(old), li.filter(~old).withColumn("l_extendedprice", F.col("l_extendedprice") * 1.2)


def steps(c):
    return f"""(SELECT v, sum(a) OVER w / sum(a) OVER () AS f, sum(b) OVER w / sum(b) OVER () AS g FROM (SELECT v, count(*) FILTER (s = 0) AS a, count(*) FILTER (s = 1) AS b
      FROM (SELECT {c} AS v, 0 AS s FROM {REF} UNION ALL SELECT {c}, 1 FROM {NEW}) GROUP BY v) WINDOW w AS (ORDER BY v))"""


@query("p1_ks", " UNION ALL ".join(f"SELECT '{c}' AS feature, round(max(abs(f - g)), 9) AS statistic FROM {steps(c)}" for c in COLS))
def p1(spark, sf):
    out = D.ks_two_sample(D.sided(*sides(spark, sf), COLS), "value", "side", ["feature"])
    return rounded(out.select("feature", "statistic"), 9)


@query("p1_ks_p")
def p1p(spark, sf):
    return D.ks_two_sample(D.sided(*sides(spark, sf), COLS), "value", "side", ["feature"])


def psi_sql(c):
    cuts = ", ".join(str(i / 10) for i in range(11))
    b = "CASE WHEN v < e[1] OR v > e[11] THEN NULL WHEN v = e[11] THEN 9 ELSE len(list_filter(e, lambda x: x <= v)) - 1 END"
    side = lambda t: f"(SELECT {b} AS bin, count(*)::DOUBLE AS n, sum(count(*)) OVER () AS t FROM (SELECT {c} AS v FROM {t}), e GROUP BY 1)"
    return f"""(WITH e AS (SELECT quantile_cont({c}, [{cuts}]) AS e FROM {REF})
      SELECT sum((p - q) * ln(p / q)) AS psi FROM (SELECT coalesce(r.n / r.t, 1e-8) AS p, coalesce(w.n / w.t, 1e-8) AS q FROM range(10) AS g(k) LEFT JOIN {side(REF)} AS r ON r.bin = k LEFT JOIN {side(NEW)} AS w ON w.bin = k))"""


@query("p2_psi", " UNION ALL ".join(f"SELECT '{c}' AS feature, round(psi, 6) AS psi FROM {psi_sql(c)}" for c in ["l_extendedprice", "l_quantity"]))
def p2(spark, sf):
    return rounded(D.psi(*sides(spark, sf), ["l_extendedprice", "l_quantity"]))


def _density(c, t):
    return f"(SELECT coalesce(n / (sum(n) OVER ()) / ((max(hi) OVER () - min(lo) OVER ()) / 20), 0) AS d, k FROM range(1, 21) AS g(k) LEFT JOIN ({hist_sql([c], t, 20)}) AS h ON h.bin = k)"


def _div(c):
    pq = f"(SELECT p.d + 1e-9 AS p, q.d + 1e-9 AS q FROM {_density(c, REF)} AS p JOIN {_density(c, NEW)} AS q USING (k))"
    return f"""SELECT '{c}' AS feature, round(0.5 * (sum(a / sa * ln(a / sa / (m / sm))) + sum(b / sb * ln(b / sb / (m / sm)))), 6) AS jsd, round(sum((p - q) * ln(p / q)), 6) AS psi, round(sum(p / sp * ln(p / sp / (q / sq))), 6) AS kl
      FROM (SELECT *, sum(a) OVER () AS sa, sum(b) OVER () AS sb, sum(m) OVER () AS sm, sum(p) OVER () AS sp, sum(q) OVER () AS sq FROM (SELECT p, q, p + 1e-9 AS a, q + 1e-9 AS b, (p + q + 2e-9) / 2 AS m FROM {pq}))"""


@query("p3_p4_divergences", " UNION ALL ".join(_div(c) for c in ["l_extendedprice", "l_quantity"]))
def p34(spark, sf):
    return rounded(D.divergences(*sides(spark, sf), ["l_extendedprice", "l_quantity"]))


_AGED = "(SELECT *, row_number() OVER (ORDER BY ts NULLS FIRST, event_id) AS place, count(*) OVER () AS total FROM events)"
_TENTH = {REF: f"(SELECT * FROM {_AGED} WHERE place <= floor(total * 0.1))", NEW: f"(SELECT * FROM {_AGED} WHERE place > floor(total * 0.1))"}


def _div_of(c, sides_sql):
    sql = _div(c)
    for old, new in sides_sql.items():
        sql = sql.replace(old, new)
    return sql


@query("p4_first_tenth", _div_of("value", _TENTH))
def p4(spark, sf):
    head, rest = D.head_and_rest(table(spark, sf, "events"), "ts", "event_id")
    return rounded(D.divergences(head, rest, ["value"]))


CHI = f"""(WITH t AS (SELECT s, v, count(*)::DOUBLE AS n FROM (SELECT 'r' AS s, l_returnflag AS v FROM {REF} UNION ALL SELECT 'n', l_returnflag FROM {NEW}) GROUP BY 1, 2),
  g AS (SELECT *, sum(n) OVER (PARTITION BY s) AS r, sum(n) OVER (PARTITION BY v) AS c, sum(n) OVER () AS t FROM t) SELECT sum(pow(n - r * c / t, 2) / (r * c / t)) AS chi2 FROM g)"""


@query("p5_chi_square", f"SELECT 'l_returnflag' AS feature, round(chi2, 6) AS statistic FROM {CHI}")
def p5(spark, sf):
    return rounded(D.chi_square_drift(*sides(spark, sf), ["l_returnflag"]).select("feature", "statistic"))


@query("p6_wasserstein", " UNION ALL ".join(f"SELECT '{c}' AS feature, round(sum(abs(f - g) * (nx - v)), 6) AS wasserstein FROM (SELECT *, lead(v) OVER (ORDER BY v) AS nx FROM {steps(c)})" for c in COLS))
def p6(spark, sf):
    return rounded(D.wasserstein(D.sided(*sides(spark, sf), COLS), "value", "side", ["feature"]))


@query("p7_classifier_drift")
def p7(spark, sf):
    a, b = sides(spark, sf)
    key = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    return D.classifier_drift(a.withColumn("k", key), b.withColumn("k", key), COLS, "k")


@query("p8_prediction_drift")
def p8(spark, sf):
    score = lambda d: d.withColumn("score", F.least(F.col("l_extendedprice") / 120000, F.lit(1.0)))
    a, b = sides(spark, sf)
    return D.prediction_drift(score(a), score(b), "score")


@query("p9_target_drift", f"SELECT 'l_returnflag' AS feature, round(chi2, 6) AS statistic, chi2 > 5.991464547107979 AS drift FROM {CHI}")
def p9(spark, sf):
    return rounded(D.target_drift(*sides(spark, sf), "l_returnflag").select("feature", "statistic", "drift"))


@query("p10_schema_skew", "SELECT * FROM (VALUES ('l_tax', 'missing'), ('extra', 'added')) AS t(feature, change)")
def p10(spark, sf):
    a, b = sides(spark, sf)
    return D.schema_skew(a, b.drop("l_tax").withColumn("extra", F.lit(1)))


@query(
    "p11_performance_drift",
    f"SELECT round(a, 9) AS reference_score, round(b, 9) AS new_score, b < a AS drift FROM (SELECT avg((l_linestatus = CASE WHEN l_quantity > 25 THEN 'O' ELSE 'F' END)::INT) AS a FROM {REF}), (SELECT avg((l_linestatus = CASE WHEN l_quantity > 25 THEN 'O' ELSE 'F' END)::INT) AS b FROM {NEW})",
)
def p11(spark, sf):
    pred = lambda d: d.withColumn("pred", F.when(F.col("l_quantity") > 25, "O").otherwise("F"))
    a, b = sides(spark, sf)
    return rounded(D.performance_drift(pred(a), pred(b), "l_linestatus", "pred"), 9)


def _report(spark, sf):
    return D.drift_report(*sides(spark, sf), COLS, ["l_returnflag", "l_linestatus"])


@query("p12_drift_report")
def p12(spark, sf):
    return _report(spark, sf)


@query("p12_alerts")
def p12a(spark, sf):
    a, b = sides(spark, sf)
    return D.alerts(_report(spark, sf), D.schema_skew(a, b.drop("l_tax")))


@query("p13_drift_share")
def p13(spark, sf):
    return D.drift_share(_report(spark, sf))


@query("p14_probabilistic_alerts")
def p14(spark, sf):
    li = table(spark, sf, "lineitem")
    return D.probabilistic_alerts(
        entropy=A.entropy_nats(li, ["l_quantity", "l_linestatus"]),
        mi=A.mutual_information(li, "l_returnflag", ["l_quantity", "l_discount"]),
        intervals=H.normal_intervals(li, ["l_quantity", "l_discount", "l_tax"]),
        fits=X.best_fit(li, ["l_quantity", "l_extendedprice"]),
        importance=M.tree_importance(li, ["l_quantity", "l_discount", "l_tax"], "l_returnflag"),
    )


@query("p15_retrain_decision", "SELECT 1::BIGINT AS n_alerts, 0.1::DOUBLE AS target_score, true AS retrain FROM lineitem HAVING count(*) > 0")
def p15(spark, sf):
    shifted = D.drift_report(*sides(spark, sf), ["l_extendedprice"], [])
    return D.retrain_decision(D.alerts(shifted), 0.1)


@query("p16_drift_history")
def p16(spark, sf):
    out = scratch(spark)
    report = D.psi(*sides(spark, sf), COLS).withColumn("drift", F.col("psi") >= D.PSI_LIMIT)
    D.append_history(report, out, "run-1")
    D.append_history(report, out, "run-2")
    return D.history_trend(spark.read.parquet(out))


@query(
    "p17_rolling_performance",
    """SELECT CAST(day AS VARCHAR) AS day, round(acc, 9) AS accuracy, round(m, 6) AS score_mean, round(s, 6) AS score_std, round(avg(acc) OVER (ORDER BY day RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW), 9) AS rolling_accuracy, round(q, 6) AS median
    FROM (SELECT ts::DATE AS day, avg(((event_type = 'click') = (value > 20))::INT) AS acc, avg(value) AS m, stddev_samp(value) AS s, median(value) AS q FROM events GROUP BY 1)""",
)
def p17(spark, sf):
    ev = table(spark, sf, "events").withColumns({"y": (F.col("event_type") == "click").cast("int"), "yhat": (F.col("value") > 20).cast("int")})
    out = D.rolling_performance(ev, "ts", "y", "yhat", "value")
    out = out.withColumn("median", F.get("score_quartiles", F.lit(1))).drop("score_quartiles").withColumn("day", F.col("day").cast("string"))
    return out.select("day", F.round("accuracy", 9).alias("accuracy"), F.round("score_mean", 6).alias("score_mean"), F.round("score_std", 6).alias("score_std"), F.round("rolling_accuracy", 9).alias("rolling_accuracy"), F.round("median", 6).alias("median"))


@query(
    "p18_page_hinkley",
    """WITH a AS (SELECT event_id, ts, value - avg(value) OVER w - 0.005 AS d FROM events WINDOW w AS (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
    b AS (SELECT *, sum(d) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS m FROM a)
    SELECT event_id, round(m - least(0, min(m) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)), 4) AS ph FROM b""",
)
def p18(spark, sf):
    out = D.page_hinkley(table(spark, sf, "events").select("event_id", "ts", "value"), "value", "ts", "event_id")
    return out.select("event_id", F.round("ph", 4).alias("ph"))


@query("p18_ddm")
def p18d(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "ts", (F.col("value") > 30).cast("int").alias("error"))
    return D.ddm(ev, "error", "ts", "event_id").groupBy("level").agg(F.count(F.lit(1)).alias("n"))


@query("p19_mmd")
def p19(spark, sf):
    return D.mmd(*sides(spark, sf), COLS)


@query("c15_column_tags")
def c15(spark, sf):
    ev = table(spark, sf, "events")
    head, rest = D.head_and_rest(ev, "ts", "event_id")
    div = D.divergences(head, rest, ["value", "user_id"])
    return P.column_tags(P.shape_moments(ev, ["value", "user_id"]), A.entropy_nats(ev, ["value", "user_id", "event_type"]), div)


