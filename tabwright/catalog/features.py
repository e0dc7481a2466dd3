"""Queries on feature construction and column splitting."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import rounded
from ..operators import construct as C
from ..operators import split_columns as J
from .derived import EVENTS_UNTIMED, events_untimed
from .registry import query, table


def orders(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus")


@query(
    "i1_group_aggregates",
    """SELECT o_orderkey, o_custkey, round(sum(o_totalprice) OVER w, 2) AS o_custkey_o_totalprice_sum, round(max(o_totalprice) OVER w, 2) AS o_custkey_o_totalprice_max,
    count(o_totalprice) OVER w AS o_custkey_o_totalprice_count FROM orders WINDOW w AS (PARTITION BY o_custkey)""",
)
def i1(spark, sf):
    d = C.group_aggregates(orders(spark, sf), {"o_custkey": {"o_totalprice": ["sum", "max", "count"]}})
    return rounded(d.drop("o_totalprice", "o_orderpriority", "o_orderstatus"), 2)


@query("i2_ratio", "SELECT l_orderkey, l_linenumber, round(l_extendedprice / nullif(l_discount, 0), 4) AS l_extendedprice_div_l_discount FROM lineitem")
def i2(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")
    return rounded(C.ratio(li, [("l_extendedprice", "l_discount")]).drop("l_extendedprice", "l_discount"), 4)


@query("i3_difference", "SELECT l_orderkey, l_linenumber, round(l_discount - l_tax, 6) AS l_discount_minus_l_tax FROM lineitem")
def i3(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    return rounded(C.difference(li, [("l_discount", "l_tax")]).drop("l_discount", "l_tax"))


@query(
    "i4_cross_hash",
    "SELECT o_orderkey, concat_ws('_', o_orderstatus, o_orderpriority) AS o_orderstatus_x_o_orderpriority, sha256(concat_ws('_', o_orderstatus, o_orderpriority)) AS o_orderstatus_x_o_orderpriority_hash FROM orders",
)
def i4(spark, sf):
    o = C.cross(orders(spark, sf), [("o_orderstatus", "o_orderpriority")])
    return o.drop("o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus")


_PERMUTATIONS = ", ".join(f"{{'a': {a}::BIGINT, 'b': {b}::BIGINT}}" for a, b in C.minhash_permutations())


@query(
    "i5_minhash",
    f"""SELECT doc_id, CASE WHEN len(codes) > 0 THEN list_transform([{_PERMUTATIONS}], lambda p: list_min(list_transform(codes, lambda c: (p.a * c + p.b) % {C.MINHASH_PRIME}))) END AS text_minhash
    FROM (SELECT doc_id, list_transform(list_distinct(list_filter(string_split_regex(lower(text), '\\s+'), lambda w: w <> '')), lambda w: CAST('0x' || substr(md5(w), 1, 8) AS BIGINT)) AS codes FROM documents)""",
)
def i5(spark, sf):
    return C.minhash(table(spark, sf, "documents").select("doc_id", "text"), "text").drop("text")


@query("i6_frequency_count", "SELECT o_orderkey, o_custkey, count(*) OVER (PARTITION BY o_custkey) AS o_custkey_count FROM orders")
def i6(spark, sf):
    return C.frequency_count(orders(spark, sf).select("o_orderkey", "o_custkey"), ["o_custkey"])


@query(
    "i7_text_stats",
    r"""SELECT doc_id, CAST(length(text) AS INTEGER) AS text_chars, CAST(len(list_filter(w, lambda x: x <> '')) AS INTEGER) AS text_words, CAST(len(list_distinct(list_filter(w, lambda x: x <> ''))) AS INTEGER) AS text_unique_words,
    CAST(length(text) - length(translate(text, '.,;:!?', '')) AS INTEGER) AS text_punct FROM (SELECT *, regexp_split_to_array(text, '\s+') AS w FROM documents)""",
)
def i7(spark, sf):
    return C.text_stats(table(spark, sf, "documents").select("doc_id", "text"), "text").drop("text")


@query("i8_date_difference", "SELECT o_orderkey, CAST(floor((epoch_us(o_orderdate) - epoch_us(TIMESTAMP '1995-06-15 13:00:00')) / 86400000000.0) AS BIGINT) AS days FROM orders")
def i8(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate", F.lit("1995-06-15 13:00:00").cast("timestamp").alias("ref"))
    return C.date_difference(o, "o_orderdate", "ref", "days").drop("o_orderdate", "ref")


@query(
    "i9_rolling",
    f"""SELECT event_id, round(avg(value) OVER w, 6) AS value_roll7_mean, round(stddev_samp(value) OVER w, 6) AS value_roll7_std FROM {EVENTS_UNTIMED}
    WINDOW w AS (ORDER BY ts NULLS FIRST, event_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""",
)
def i9(spark, sf):
    ev = events_untimed(spark, sf).select("event_id", "ts", "value")
    return rounded(C.rolling(ev, ["value"], 7, "ts", tie="event_id").drop("ts", "value"))


@query(
    "i9_rolling_by_user",
    f"""SELECT event_id, round(avg(value) OVER w, 6) AS value_roll5_mean, round(stddev_samp(value) OVER w, 6) AS value_roll5_std FROM {EVENTS_UNTIMED}
    WINDOW w AS (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)""",
)
def i9u(spark, sf):
    ev = events_untimed(spark, sf).select("event_id", "user_id", "ts", "value")
    return rounded(C.rolling(ev, ["value"], 5, "ts", ["user_id"], tie="event_id").drop("ts", "value", "user_id"))


@query("i10_custom", "SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 6) AS charge FROM lineitem WHERE l_quantity > 10")
def i10(spark, sf):
    steps = [
        lambda d: d.filter(F.col("l_quantity") > 10),
        lambda d: C.custom_columns(d, {"charge": lambda f: F.round(f["l_extendedprice"] * (1 - f["l_discount"]) * (1 + f["l_tax"]), 6)}),
    ]
    return C.custom_steps(table(spark, sf, "lineitem"), steps).select("l_orderkey", "l_linenumber", "charge")


@query(
    "i11_score_features",
    """SELECT feature, round(s, 6) AS score, s >= 0.5 AS applied FROM (SELECT 'net' AS feature, abs(corr(l_extendedprice * (1 - l_discount), l_extendedprice)) AS s FROM lineitem
    UNION ALL SELECT 'gap', abs(corr(l_discount - l_tax, l_extendedprice)) FROM lineitem)""",
)
def i11(spark, sf):
    li = table(spark, sf, "lineitem")
    d = li.withColumns({"net": F.col("l_extendedprice") * (1 - F.col("l_discount")), "gap": F.col("l_discount") - F.col("l_tax")})
    return rounded(C.score_features(d, "l_extendedprice", ["net", "gap"], 0.5).drop("reason"))


@query(
    "i12_lag_backfill",
    f"""WITH l AS (SELECT event_id, ts, lag(value, 1) OVER w AS a, lag(value, 3) OVER w AS b FROM {EVENTS_UNTIMED} WINDOW w AS (ORDER BY ts NULLS FIRST, event_id))
    SELECT event_id, coalesce(a, first_value(a IGNORE NULLS) OVER f) AS value_lag1, coalesce(b, first_value(b IGNORE NULLS) OVER f) AS value_lag3 FROM l WINDOW f AS (ORDER BY ts NULLS FIRST, event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
)
def i12(spark, sf):
    ev = events_untimed(spark, sf).select("event_id", "ts", "value")
    return C.lags(ev, "value", [1, 3], "ts", tie="event_id", backfill=True).select("event_id", "value_lag1", "value_lag3")


@query(
    "i13_propagate",
    f"SELECT event_id, CAST(max(f) OVER (ORDER BY ts NULLS FIRST, event_id ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS INTEGER) AS promo_active FROM (SELECT *, CASE WHEN event_id % 40 = 0 THEN 1 ELSE 0 END AS f FROM {EVENTS_UNTIMED})",
)
def i13(spark, sf):
    ev = events_untimed(spark, sf).select("event_id", "ts", (F.col("event_id") % 40 == 0).cast("int").alias("promo"))
    return C.propagate(ev, "promo", 7, "ts", tie="event_id").select("event_id", "promo_active")


@query("i14_days_since", "SELECT o_orderkey, CAST(DATE '2000-01-01' - o_orderdate::DATE AS INTEGER) AS days_since_o_orderdate FROM orders")
def i14(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return C.days_since(o, "o_orderdate", F.lit("2000-01-01").cast("date")).drop("o_orderdate")


CODE = "(SELECT p_partkey, concat(p_brand, '-', p_type, '/', p_size, '?a=', p_partkey) AS code FROM part)"


def codes(spark, sf):
    p = table(spark, sf, "part")
    return p.select("p_partkey", F.concat("p_brand", F.lit("-"), "p_type", F.lit("/"), F.col("p_size").cast("string"), F.lit("?a="), F.col("p_partkey").cast("string")).alias("code"))


def _cols(fn, kind, n):
    return ", ".join(f"coalesce({fn}[{i + 1}], '') AS code_{kind}_{i}" for i in range(n))


@query(
    "j1_mixed_split",
    f"""SELECT p_partkey, code, {_cols("a", "alpha", 3)}, {_cols("d", "digits", 3)}, {_cols("p", "punct", 5)} FROM (SELECT *, regexp_extract_all(code, '([A-Za-z]+)', 1) AS a,
    regexp_extract_all(code, '(\\d+)', 1) AS d, regexp_extract_all(code, '([^A-Za-z0-9]+)', 1) AS p FROM {CODE})""",
)
def j1(spark, sf):
    return J.split_mixed(codes(spark, sf), "code")


@query("j1_mixed_arrays")
def j1a(spark, sf):
    return J.mixed_matches(table(spark, sf, "pages").select("page_id", "html"), "html").drop("html")


@query("j2_strip_html", "SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS html FROM pages")
def j2(spark, sf):
    return table(spark, sf, "pages").select("page_id", J.strip_html(F.col("html")).alias("html"))


@query("j3_flatten_json", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k FROM events")
def j3(spark, sf):
    return J.flatten_json(table(spark, sf, "events").select("event_id", "props"), "props")


@query("j4_flatten_xml", "SELECT p_partkey, p_brand AS doc_brand, CAST(p_size AS VARCHAR) AS doc_size FROM part")
def j4(spark, sf):
    p = table(spark, sf, "part")
    doc = F.concat(F.lit("<brand id='1'>x</brand>\n<size unit='cm'>"), F.col("p_size").cast("string"), F.lit("</size><brand\nlang='en'>"), "p_brand", F.lit("</brand>"))
    return J.flatten_xml(p.select("p_partkey", doc.alias("doc")), "doc").drop("doc")


@query("j4_page_tags")
def j4p(spark, sf):
    return table(spark, sf, "pages").select("page_id", J.xml_map(F.col("html")).alias("tags"))


@query("j5_delimiter_split", "SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS o_orderpriority_delim_0, CASE WHEN contains(o_orderpriority, '-') THEN split_part(o_orderpriority, '-', 2) END AS o_orderpriority_delim_1 FROM orders")
def j5(spark, sf):
    return J.split_delimiter(orders(spark, sf).select("o_orderkey", "o_orderpriority"), "o_orderpriority", "-", 2).drop("o_orderpriority")


@query("j6_multi_label", "SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INTEGER) AS tags_lbl_F, CAST(o_orderstatus = 'O' AS INTEGER) AS tags_lbl_O, CAST(o_orderstatus = 'P' AS INTEGER) AS tags_lbl_P, CAST(o_totalprice > 100000 AS INTEGER) AS tags_lbl_big FROM orders")
def j6(spark, sf):
    o = orders(spark, sf)
    tags = F.when(F.col("o_totalprice") > 100000, F.concat("o_orderstatus", F.lit("|big"))).otherwise(F.col("o_orderstatus"))
    return J.multi_label(o.select("o_orderkey", tags.alias("tags")), "tags", "|").drop("tags")


@query("j7_regex_all", f"SELECT p_partkey, coalesce(m[1], '') AS code_rex_0, coalesce(m[2], '') AS code_rex_1, coalesce(m[3], '') AS code_rex_2 FROM (SELECT *, regexp_extract_all(code, '[^0-9]([0-9]+)', 1) AS m FROM {CODE})")
def j7(spark, sf):
    return J.regex_all(codes(spark, sf), "code", "[^0-9]([0-9]+)").drop("code")


@query(
    "j8_url_parse",
    r"""SELECT page_id, url, lower(regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*):', 1)) AS url_scheme, regexp_extract(url, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)', 1) AS url_netloc,
    regexp_replace(p, ';[^/]*$', '') AS url_path, regexp_extract(p, ';([^/]*)$', 1) AS url_params, q AS url_query, regexp_extract(url, '#(.*)$', 1) AS url_fragment,
    CAST(len(list_filter(string_split(p, '/'), lambda x: x <> '')) AS INTEGER) AS url_depth, CAST(len(list_filter(string_split(q, '&'), lambda x: x <> '')) AS INTEGER) AS url_n_query
    FROM (SELECT page_id, url, regexp_extract(url, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1) AS p, regexp_extract(url, '^[^?#]*\?([^#]*)', 1) AS q FROM pages)""",
)
def j8(spark, sf):
    return J.parse_url(table(spark, sf, "pages").select("page_id", "url"), "url")


@query("j9_ip_extract", r"SELECT doc_id, nullif(regexp_extract(text, '\b(\d{1,3}(?:\.\d{1,3}){3})\b', 1), '') AS text_ip FROM documents")
def j9(spark, sf):
    return J.extract_ip(table(spark, sf, "documents").select("doc_id", "text"), "text").select("doc_id", "text_ip")


@query("j10_hex_colour", "SELECT c_custkey, concat('#', lower(right(concat('00000', to_hex(c_custkey * 997 % 16777216)), 6))) AS note_colour, CAST((c_custkey * 997 % 16777216) // 65536 AS INTEGER) AS note_r FROM customer")
def j10(spark, sf):
    code = F.lower(F.lpad(F.hex(F.col("c_custkey") * 997 % 16777216), 6, "0"))
    c = table(spark, sf, "customer").select("c_custkey", F.concat(F.lit("colour #"), code, F.lit(" ok")).alias("note"))
    return J.extract_colour(c, "note").select("c_custkey", "note_colour", "note_r")


@query("j11_file_path", "SELECT p_partkey, concat('/data/', p_brand) AS path_dir, concat(p_name, '.v1.csv') AS path_file, '.csv' AS path_ext FROM part")
def j11(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", F.concat(F.lit("/data/"), "p_brand", F.lit("/"), "p_name", F.lit(".v1.csv")).alias("path"))
    return J.split_path(p, "path").drop("path")


@query("j12_email", "SELECT c_custkey, lower(c_name) AS mail_user, concat(lower(c_mktsegment), '.example.com') AS mail_domain FROM customer")
def j12(spark, sf):
    mail = F.concat(F.lower("c_name"), F.lit("@"), F.lower("c_mktsegment"), F.lit(".example.com"))
    return J.split_email(table(spark, sf, "customer").select("c_custkey", mail.alias("mail")), "mail").drop("mail")


@query("j13_phone_digits", "SELECT c_custkey, regexp_replace(c_name, '[^0-9]', '', 'g') AS c_name_digits FROM customer")
def j13(spark, sf):
    return J.phone_digits(table(spark, sf, "customer").select("c_custkey", "c_name"), "c_name").drop("c_name")


@query("j14_evaluate_splits")
def j14(spark, sf):
    o = J.split_delimiter(orders(spark, sf), "o_orderpriority", "-", 2)
    return J.evaluate_splits(o, ["o_orderpriority_delim_0", "o_orderpriority_delim_1"], "o_orderstatus", min_mi=0.01)
