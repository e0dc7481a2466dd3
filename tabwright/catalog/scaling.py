"""Queries on scaling, transformation, encoding and binning."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import rounded
from ..operators import encode as E
from ..operators import scale as S
from .profiling import MEASURES
from .registry import query, table

KEY = "l_orderkey, l_linenumber"


def li(spark, sf):
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *MEASURES)


def _each(expr):
    return ", ".join(f"round({expr.format(c=c)}, 6) AS {c}" for c in MEASURES)


@query("g1_standard", f"SELECT {KEY}, {_each('({c} - (SELECT avg({c}) FROM lineitem)) / (SELECT stddev_pop({c}) FROM lineitem)')} FROM lineitem")
def g1(spark, sf):
    return rounded(S.scale(li(spark, sf), MEASURES, "standard"))


@query("g2_minmax", f"SELECT {KEY}, {_each('({c} - (SELECT min({c}) FROM lineitem)) / (SELECT max({c}) - min({c}) FROM lineitem)')} FROM lineitem")
def g2(spark, sf):
    return rounded(S.scale(li(spark, sf), MEASURES, "minmax"))


@query("g3_robust", f"SELECT {KEY}, {_each('({c} - (SELECT median({c}) FROM lineitem)) / (SELECT quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) FROM lineitem)')} FROM lineitem")
def g3(spark, sf):
    return rounded(S.scale(li(spark, sf), MEASURES, "robust"))


@query("g4_maxabs", f"SELECT {KEY}, {_each('{c} / (SELECT max(abs({c})) FROM lineitem)')} FROM lineitem")
def g4(spark, sf):
    return rounded(S.scale(li(spark, sf), MEASURES, "maxabs"))


@query("g4_row_normalize", f"SELECT {KEY}, {_each('{c} / sqrt(l_quantity * l_quantity + l_extendedprice * l_extendedprice + l_discount * l_discount + l_tax * l_tax)')} FROM lineitem")
def g4n(spark, sf):
    return rounded(S.row_normalize(li(spark, sf), MEASURES))


@query(
    "g5_functions",
    f"""SELECT {KEY}, l_extendedprice, round(ln(1 + l_extendedprice), 6) AS l_extendedprice_log1p, round(sqrt(l_extendedprice), 6) AS l_extendedprice_sqrt,
    round(cbrt(l_extendedprice), 6) AS l_extendedprice_cbrt, round(1 / (l_extendedprice + 1e-9), 9) AS l_extendedprice_reciprocal FROM lineitem""",
)
def g5(spark, sf):
    d = li(spark, sf).drop("l_quantity", "l_discount", "l_tax")
    for f in ("log1p", "sqrt", "cbrt", "reciprocal"):
        d = S.apply_function(d, ["l_extendedprice"], f)
    return d.withColumns({c: F.round(c, 9 if c.endswith("reciprocal") else 6) for c in d.columns if "price_" in c})


@query("g6_validity", " UNION ALL ".join(f"SELECT '{c}' AS feature, min({c}) > 0 AS boxcox_ok, min({c}) >= 0 AS root_ok, count(*) FILTER (abs({c}) <= 1e-8) = 0 AS reciprocal_ok FROM lineitem" for c in MEASURES))
def g6(spark, sf):
    return S.validity(li(spark, sf), MEASURES)


def _ll(lam):
    y = "ln(value)" if lam == 0 else f"(pow(value, {lam}) - 1) / {lam}"
    return f"SELECT {lam}::DOUBLE AS lam, ({lam} - 1) * sum(ln(value)) - count(*) / 2 * ln(var_pop({y})) AS ll FROM events WHERE value > 0"


@query("g7_boxcox_grid", f"SELECT 'value' AS feature, lam AS lambda FROM ({' UNION ALL '.join(_ll(v) for v in S.BOXCOX_GRID)}) ORDER BY ll DESC LIMIT 1")
def g7g(spark, sf):
    ev = table(spark, sf, "events").filter(F.col("value") > 0)
    best = S.best_lambda(ev, ["value"], "boxcox", S.BOXCOX_GRID)
    return spark.createDataFrame(list(best.items()), "feature string, lambda double")


@query("g7_boxcox")
def g7(spark, sf):
    return S.power_transform(li(spark, sf), ["l_extendedprice", "l_quantity"], "boxcox")


@query("g8_yeo_johnson")
def g8(spark, sf):
    return S.power_transform(li(spark, sf), MEASURES, "yeo")


@query("g9_quantile_normal")
def g9(spark, sf):
    return S.quantile_transform(li(spark, sf), ["l_extendedprice", "l_quantity"])


def _pop(c, t):
    return f"SELECT abs(skewness({c}) * (count({c}) - 2) / sqrt(count({c}) * (count({c}) - 1.0))) AS s, abs(kurtosis_pop({c})) AS k FROM {t}"


@query(
    "g10_global_scaler",
    f"""SELECT CASE WHEN max(s) > 1 OR max(k) > 5 THEN 'robust' WHEN max(s) < 0.5 THEN 'standard' ELSE 'minmax' END AS scaler, round(max(s), 6) AS max_skew, round(max(k), 6) AS max_kurt
    FROM ({_pop('value', 'events')} UNION ALL {_pop('user_id', 'events')})""",
)
def g10(spark, sf):
    return rounded(S.global_scaler(table(spark, sf, "events"), ["value", "user_id"]))


@query("g11_best_pre")
def g11(spark, sf):
    return S.best_pre(table(spark, sf, "events"), ["value", "user_id"])


@query("g12_extra_choice")
def g12(spark, sf):
    return S.extra_choice(table(spark, sf, "events"), ["value", "user_id"])


@query("g13_mode_switch", "SELECT CASE WHEN count(*) * 4 < 1000000 THEN 'enhanced' ELSE 'simple' END AS mode FROM lineitem")
def g13(spark, sf):
    return spark.createDataFrame([(S.mode_switch(li(spark, sf), MEASURES),)], "mode string")


@query("g14_global_plan")
def g14(spark, sf):
    return S.global_plan(li(spark, sf), MEASURES)


@query("g15_fit_apply_plan")
def g15(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "value", "user_id")
    return S.apply_plan(ev, S.fit_plan(ev, ["value", "user_id"]))


@query(
    "g16_polynomial",
    f"""SELECT {KEY}, l_quantity, l_discount, round(pow(l_quantity, 2), 6) AS "l_quantity^2", round(pow(l_discount, 2), 6) AS "l_discount^2",
    round(l_quantity * l_discount, 6) AS "l_quantity*l_discount", round(l_quantity + l_discount, 6) AS "l_quantity+l_discount" FROM lineitem""",
)
def g16(spark, sf):
    return rounded(S.polynomial(li(spark, sf).drop("l_extendedprice", "l_tax"), ["l_quantity", "l_discount"]))


def parts(spark, sf):
    return table(spark, sf, "part")


@query(
    "h1_route_encoders",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, d AS n_levels, round(r, 9) AS distinct_share, CASE WHEN r <= 0.05 THEN 'onehot' WHEN r <= 0.5 THEN 'frequency' ELSE 'suggest_target' END AS linear,
    CASE WHEN r <= 0.05 THEN 'onehot' WHEN r <= 0.2 THEN 'ordinal' WHEN r <= 0.5 THEN 'frequency' ELSE 'suggest_target' END AS tree FROM (SELECT count(DISTINCT {c}) AS d, count(DISTINCT {c}) / count(*) AS r FROM part)"""
        for c in ["p_name", "p_brand", "p_type"]
    ),
)
def h1(spark, sf):
    return rounded(E.route_encoders(parts(spark, sf)), 9)


@query("h2_one_hot", "SELECT c_custkey, " + ", ".join(f"CAST(c_mktsegment = '{s}' AS INTEGER)::DOUBLE AS \"c_mktsegment_{s}\"" for s in ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]) + " FROM customer")
def h2(spark, sf):
    return E.one_hot(table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), ["c_mktsegment"])


@query("h3_frequency", "SELECT p_type, p_partkey, round(count(*) OVER (PARTITION BY p_type) / (SELECT count(*) FROM part), 9) AS p_type_freq FROM part")
def h3(spark, sf):
    return rounded(E.frequency_encode(parts(spark, sf).select("p_partkey", "p_type"), "p_type"), 9)


@query("h4_ordinal", "SELECT p_name, p_partkey, CAST(dense_rank() OVER (ORDER BY p_name) - 1 AS BIGINT) AS p_name_ord FROM part")
def h4(spark, sf):
    return E.ordinal_encode(parts(spark, sf).select("p_partkey", "p_name"), "p_name")


@query("h5_variants")
def h5(spark, sf):
    frames = E.encode_variants(parts(spark, sf).drop("p_name"))
    wide = [frame.select("p_partkey", F.lit(name).alias("family"), F.to_json(F.struct(*[c for c in frame.columns if c != "p_partkey"])).alias("row")) for name, frame in frames.items()]
    return wide[0].unionByName(wide[1]).unionByName(wide[2])


@query("h6_hashing", "SELECT p_partkey, CAST(CAST(concat('0x', substr(md5(p_type), 1, 8)) AS BIGINT) % 16 AS INTEGER) AS bucket FROM part")
def h6(spark, sf):
    return parts(spark, sf).select("p_partkey", E.md5_bucket(F.col("p_type"), 16).alias("bucket"))


@query("h6_hash_native")
def h6n(spark, sf):
    return E.hash_encode(parts(spark, sf).select("p_partkey", "p_type"), "p_type", 16)


ORD = "(SELECT o_orderkey, o_orderpriority, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END::DOUBLE AS y FROM orders)"


def ords(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", (F.col("o_orderstatus") == "F").cast("double").alias("y"))


P = "o_orderkey, o_orderpriority, y"
W = "OVER (PARTITION BY o_orderpriority)"
G = f"(SELECT avg(y) FROM {ORD})"


@query("h7_target_mean", f"SELECT {P}, round((sum(y) {W} + 10 * {G}) / (count(*) {W} + 10), 9) AS o_orderpriority_te FROM {ORD}")
def h7(spark, sf):
    return rounded(E.target_encode(ords(spark, sf), "o_orderpriority", "y"), 9)


@query("h8_leave_one_out", f"SELECT {P}, round((sum(y) {W} - y) / (count(*) {W} - 1), 9) AS o_orderpriority_loo FROM {ORD}")
def h8(spark, sf):
    return rounded(E.leave_one_out(ords(spark, sf), "o_orderpriority", "y"), 9)


FOLD = "CAST(floor(CAST(concat('0x', substr(md5(concat_ws('|', '42', CAST(o_orderkey AS VARCHAR))), 1, 13)) AS BIGINT) / 4503599627370496.0 * 5) AS INTEGER)"


@query(
    "h9_kfold_target",
    f"""SELECT {P}, round((sum(y) {W} - sum(y) OVER (PARTITION BY o_orderpriority, f)) / (count(*) {W} - count(*) OVER (PARTITION BY o_orderpriority, f)), 9) AS o_orderpriority_kf FROM (SELECT *, {FOLD} AS f FROM {ORD})""",
)
def h9(spark, sf):
    return rounded(E.kfold_target(ords(spark, sf), "o_orderpriority", "y", E.fold_of("o_orderkey")), 9)


@query("h10_bayes", f"SELECT {P}, round((1 + sum(y) {W}) / (2 + count(*) {W}), 9) AS o_orderpriority_bayes FROM {ORD}")
def h10(spark, sf):
    return rounded(E.bayes_encode(ords(spark, sf), "o_orderpriority", "y"), 9)


@query(
    "h11_james_stein",
    f"""WITH t AS (SELECT o_orderpriority, count(*) AS n, avg(y) AS p FROM {ORD} GROUP BY 1), s AS (SELECT sum(n * pow(p - {G}, 2)) AS d, count(*) AS k FROM t)
    SELECT o.*, round({G} + (1 - (k - 3) * {G} * (1 - {G}) / d) * (p - {G}), 9) AS o_orderpriority_js FROM {ORD} AS o JOIN t USING (o_orderpriority), s""",
)
def h11(spark, sf):
    return rounded(E.james_stein(ords(spark, sf), "o_orderpriority", "y"), 9)


@query(
    "h12_ordered_target",
    f"""SELECT {P}, round((coalesce(sum(y) OVER w, 0) + {G}) / (count(*) OVER w + 1), 9) AS o_orderpriority_ord_te FROM {ORD}
    WINDOW w AS (PARTITION BY o_orderpriority ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""",
)
def h12(spark, sf):
    return rounded(E.ordered_target(ords(spark, sf), "o_orderpriority", "y", "o_orderkey"), 9)


@query(
    "h13_woe",
    f"SELECT {P}, round(ln((sum(y) {W} + 0.5) / ((SELECT sum(y) FROM {ORD}) + 1) / ((count(*) {W} - sum(y) {W} + 0.5) / ((SELECT count(*) - sum(y) FROM {ORD}) + 1))), 9) AS o_orderpriority_woe FROM {ORD}",
)
def h13(spark, sf):
    return rounded(E.woe_encode(ords(spark, sf), "o_orderpriority", "y"), 9)


def price(spark, sf):
    return parts(spark, sf).select("p_partkey", "p_size", "p_retailprice")


@query("h14_equal_width", "SELECT p_partkey, p_size, p_retailprice, CAST(least(floor((p_retailprice - lo) / ((hi - lo) / 5)), 4) AS INTEGER) AS p_retailprice_bin FROM part, (SELECT min(p_retailprice) AS lo, max(p_retailprice) AS hi FROM part)")
def h14(spark, sf):
    return E.equal_width(price(spark, sf), ["p_retailprice"])


@query(
    "h15_quantile_bins",
    "SELECT p_partkey, p_size, p_retailprice, CAST(len(list_filter(e, lambda x: x < p_size)) AS INTEGER) AS p_size_qbin FROM part, (SELECT list_distinct(quantile_cont(p_size::DOUBLE, [0.2, 0.4, 0.6, 0.8])) AS e FROM part)",
)
def h15(spark, sf):
    return E.quantile_cut(price(spark, sf), ["p_size"])


@query("h16_kmeans_bins")
def h16(spark, sf):
    return E.kmeans_bins(price(spark, sf), "p_retailprice")


@query("h17_tree_bins")
def h17(spark, sf):
    d = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", (F.col("l_quantity") > 25).cast("int").alias("big"))
    return E.tree_bins(d, "l_extendedprice", "big")


@query("h18_custom_bins", "SELECT p_partkey, p_size, p_retailprice, CAST(CASE WHEN p_size < 10 THEN 0 WHEN p_size < 30 THEN 1 WHEN p_size < 51 THEN 2 END AS INTEGER) AS p_size_cbin, CAST(p_retailprice > 950 AS INTEGER) AS p_retailprice_flag FROM part WHERE p_size >= 1")
def h18(spark, sf):
    return E.binarize(E.custom_bins(price(spark, sf), "p_size", [1, 10, 30, 51]), "p_retailprice", 950)


@query(
    "h19_date_parts",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS ts_year, CAST(month(ts) AS INTEGER) AS ts_month, CAST(day(ts) AS INTEGER) AS ts_day, CAST(isodow(ts) - 1 AS INTEGER) AS ts_dow, CAST(hour(ts) AS INTEGER) AS ts_hour,
    CAST(quarter(ts) AS INTEGER) AS ts_quarter, CASE WHEN month(ts) <= 6 THEN 1 ELSE 2 END AS ts_semester, CAST(year(ts) // 10 * 10 AS INTEGER) AS ts_decade, CAST(year(ts) // 100 * 100 AS INTEGER) AS ts_century FROM events""",
)
def h19(spark, sf):
    return E.date_parts(table(spark, sf, "events").select("event_id", "ts"), "ts").drop("ts")


@query("h20_cyclical", "SELECT event_id, round(sin(2 * pi() * hour(ts) / 24), 9) AS hour_sin, round(cos(2 * pi() * hour(ts) / 24), 9) AS hour_cos FROM events")
def h20(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "ts")
    return rounded(E.cyclical(ev, "hour", F.hour("ts"), 24).drop("ts"), 9)


@query(
    "h21_calendar_flags",
    "SELECT event_id, CAST(hour(ts) BETWEEN 6 AND 17 AS INTEGER) AS is_day, CAST(isodow(ts) >= 6 AS INTEGER) AS is_weekend, CAST(ts::DATE IN (SELECT o_orderdate::DATE FROM orders WHERE o_orderpriority = '1-URGENT') AS INTEGER) AS is_holiday FROM events",
)
def h21(spark, sf):
    cal = table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_orderdate").alias("day"))
    return E.calendar_flags(table(spark, sf, "events").select("event_id", "ts"), "ts", cal).drop("ts")


@query("h22_boolean", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 1 WHEN event_id % 3 = 1 THEN 0 END AS word_bool FROM events")
def h22(spark, sf):
    k = F.col("event_id") % 3
    ev = table(spark, sf, "events").select("event_id", F.when(k == 0, "Yes").when(k == 1, "n").otherwise("maybe").alias("word"))
    return E.boolean_flag(ev, "word").drop("word")


HAV = "2 * 6371 * asin(sqrt(pow(sin(radians(s_nationkey - s_acctbal / 200) / 2), 2) + cos(radians(s_acctbal / 200)) * cos(radians(s_nationkey)) * pow(sin(radians(s_suppkey % 180) / 2), 2)))"


@query("h23_haversine", f"SELECT s_suppkey, round({HAV}, 4) AS km FROM supplier")
def h23(spark, sf):
    s = table(spark, sf, "supplier")
    km = E.haversine(F.col("s_acctbal") / 200, F.lit(0.0), F.col("s_nationkey").cast("double"), (F.col("s_suppkey") % 180).cast("double"))
    return s.select("s_suppkey", F.round(km, 4).alias("km"))


@query("h23_geo_cluster")
def h23c(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", (F.col("c_acctbal") / 200).alias("lat"), (F.col("c_nationkey") * 7.0).alias("lon"))
    return E.geo_cluster(c, "lat", "lon", 5)


@query(
    "h24_lookup_score",
    "SELECT o_orderkey, o_orderpriority, o_totalprice, CASE o_orderpriority WHEN '1-URGENT' THEN 0.5 WHEN '2-HIGH' THEN 1.0 ELSE NULL END::DOUBLE AS o_orderpriority_score, round(o_totalprice / CASE o_orderpriority WHEN '1-URGENT' THEN 0.5 WHEN '2-HIGH' THEN 1.0 END::DOUBLE, 6) AS o_totalprice_per_o_orderpriority FROM orders",
)
def h24(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return rounded(E.lookup_score(o, "o_orderpriority", {"1-URGENT": 0.5, "2-HIGH": 1.0}, "o_totalprice"))


@query("h25_text_vectors")
def h25(spark, sf):
    """All three kinds, by kind: hashed counts, counts over a vocabulary, and TF-IDF."""
    d = table(spark, sf, "documents").select("doc_id", "text")
    made = [E.text_vectors(d, "text", kind).select("doc_id", F.lit(kind).alias("kind"), "text_vec") for kind in ("hash", "count", "tfidf")]
    return made[0].unionByName(made[1]).unionByName(made[2])
