"""Queries on sources, sinks, checks and cleaning."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import rounded
from ..operators import quality as Q
from ..session import local_folder
from ..sources import readers, schema, sinks
from .derived import EVENTS_MIXED, LINEITEM_NULLS, ORDERS_TWICE, events_mixed, lineitem_nulls, orders_twice
from .registry import query, table


def scratch(spark) -> str:
    """A fresh folder in the shared checkpoint folder, or a local one where none is named."""
    base = spark.conf.get("spark.checkpoint.dir", None) or local_folder(spark, "tabwright-out-")
    return f"{base}/out-{uuid.uuid4().hex}"


@query("a1_read_file", "SELECT l_returnflag, count(*) AS n, round(sum(l_extendedprice), 2) AS price FROM lineitem GROUP BY 1")
def a1(spark, sf):
    li = readers.read_file(spark, f"{sf}/lineitem.parquet")
    return li.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_extendedprice"), 2).alias("price"))


@query(
    "a1_read_csv",
    "SELECT s_nationkey, count(*) AS n, round(sum(s_acctbal), 2) AS bal FROM supplier GROUP BY 1",
)
def a1_csv(spark, sf):
    out = scratch(spark) + "/supplier.csv"
    table(spark, sf, "supplier").write.option("header", True).csv(out)
    s = readers.read_file(spark, out, schema=table(spark, sf, "supplier").schema)
    return s.groupBy("s_nationkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("s_acctbal"), 2).alias("bal"))


@query("a3_json_flatten", "SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS \"props.k\" FROM events")
def a3(spark, sf):
    out = scratch(spark)
    table(spark, sf, "events").select("event_id", "user_id", F.from_json("props", "k bigint").alias("props")).write.json(out)
    return readers.read_json_payload(spark, out)


@query("a5_commented_tsv", "SELECT p_brand, count(*) AS n, round(sum(p_retailprice), 2) AS price FROM part GROUP BY 1")
def a5(spark, sf):
    out = scratch(spark) + "/matrix.tsv"
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_retailprice")
    lines = part.select(F.concat_ws("\t", *part.columns).alias("value"))
    heads = [F.lit("!a remark").alias("value"), F.lit("#another").alias("value"), F.lit("\t".join(part.columns)).alias("value")]
    for head in heads:
        lines = lines.unionByName(part.limit(1).select(head))
    lines.write.text(out)
    named = T.StructType([T.StructField("p_partkey", T.LongType()), T.StructField("p_brand", T.StringType()), T.StructField("p_retailprice", T.DoubleType())])
    back = readers.read_commented_tsv(spark, out, schema=named)
    return back.groupBy("p_brand").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("p_retailprice"), 2).alias("price"))


@query("a6_snapshot", "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1")
def a6(spark, sf):
    out = scratch(spark)
    sinks.write_snapshot(table(spark, sf, "orders"), out, partition_by=["o_orderstatus"])
    return spark.read.parquet(out).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("a7_report_sink", "SELECT c_mktsegment AS value, count(*) AS n FROM customer GROUP BY 1")
def a7(spark, sf):
    out = scratch(spark)
    report = table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    sinks.write_report(report, out, "json")
    return spark.read.schema(report.schema).json(out)


@query(
    "a8_schema_enforce",
    f"""SELECT coalesce(reason, 'accepted') AS outcome, count(*) AS n FROM (
      SELECT CASE WHEN TRY_CAST(mixed AS BIGINT) IS NULL THEN 'mixed:type' END AS reason FROM {EVENTS_MIXED}) GROUP BY 1""",
)
def a8(spark, sf):
    want = T.StructType([T.StructField("event_id", T.LongType(), False), T.StructField("mixed", T.LongType()), T.StructField("value", T.DoubleType())])
    out = schema.check_schema(events_mixed(spark, sf), want)
    return out.groupBy(F.coalesce("reject_reason", F.lit("accepted")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def _digest_sql(source: str) -> str:
    texts = [f"CAST({c} AS VARCHAR)" for c in ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")]
    cells = " || ".join(f"coalesce(CAST(length({t}) AS VARCHAR) || ':' || {t}, 'n')" for t in texts)
    sums = [f"lpad(to_hex(CAST(sum(CAST(CAST('0x' || substr(d, {start}, 15) AS BIGINT) AS HUGEINT)) % {1 << 60} AS BIGINT)), 15, '0')" for start in (1, 16)]
    return f"SELECT count(*) AS n_rows, lower({' || '.join(sums)}) AS digest FROM (SELECT sha256({cells}) AS d FROM {source})"


DIGEST = _digest_sql("customer")


@query("a9_manifest", f"SELECT n_rows, 5 AS n_cols, 42 AS seed, lower(digest) AS digest FROM ({DIGEST})")
def a9(spark, sf):
    return schema.run_manifest(table(spark, sf, "customer"), seed=42, flags={"source": "customer"}).drop("created_at", "flags")


@query(
    "b1_mask_pii",
    r"""SELECT doc_id, regexp_replace(regexp_replace(text, '\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b', '[email]', 'g'),
      '\b\d{10,}\b', '[phone]', 'g') AS text FROM documents""",
)
def b1(spark, sf):
    return Q.mask_pii(table(spark, sf, "documents").select("doc_id", "text"))


@query("b2_checksum", f"SELECT n_rows, lower(digest) AS digest FROM ({DIGEST})")
def b2(spark, sf):
    return Q.audit_checksum(table(spark, sf, "customer"))


@query("b2_checksum_doubled", _digest_sql("(SELECT * FROM customer UNION ALL SELECT * FROM customer)"))
def b2d(spark, sf):
    c = table(spark, sf, "customer")
    return Q.audit_checksum(c.unionByName(c))


@query(
    "b3_delimiter_cells",
    """SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT p_brand, p_partkey % 2 FROM part)) AS duplicate_rows FROM part""",
)
def b3d(spark, sf):
    even = F.col("p_partkey") % 2 == 0
    a = F.when(even, F.concat("p_brand", F.lit("|b"))).otherwise(F.col("p_brand"))
    return Q.duplicate_rows(table(spark, sf, "part").select(a.alias("a"), F.when(even, "c").otherwise("b|c").alias("b")))


@query("b3_duplicate_rows", f"SELECT (count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {ORDERS_TWICE}))) AS duplicate_rows FROM {ORDERS_TWICE}")
def b3(spark, sf):
    return Q.duplicate_rows(orders_twice(spark, sf))


@query("b4_require_rows", "SELECT count(*) AS n FROM orders")
def b4(spark, sf):
    return Q.require_rows(table(spark, sf, "orders")).agg(F.count(F.lit(1)).alias("n"))


def _profile_sql() -> str:
    cols = ["event_id", "ts", "value", "mixed", "marked", "truth", "fixed"]
    parts = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS v FROM {EVENTS_MIXED}" for c in cols)
    return f"""WITH long AS ({parts}), p AS (SELECT feature, count(*) AS n, count(v) AS k, count(DISTINCT v) AS d,
      sum(CASE WHEN lower(v) IN ('true','false','0','1','yes','no') THEN 1 ELSE 0 END) AS b,
      sum(CASE WHEN TRY_CAST(v AS DOUBLE) IS NOT NULL THEN 1 ELSE 0 END) AS num,
      sum(CASE WHEN TRY_CAST(v AS DOUBLE) = floor(TRY_CAST(v AS DOUBLE)) THEN 1 ELSE 0 END) AS whole,
      sum(CASE WHEN regexp_matches(v, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}') AND TRY_CAST(v AS TIMESTAMP) IS NOT NULL THEN 1 ELSE 0 END) AS dt
      FROM long GROUP BY feature)
    SELECT feature, n AS n_rows, n - k AS n_null, d AS n_distinct,
      CASE WHEN d = 1 THEN 'Constant / Redundant' WHEN d = n THEN 'ID-like Field' WHEN b = k THEN 'Boolean'
        WHEN num > 0.9 * k THEN CASE WHEN whole > 0.9 * num THEN 'Integer' ELSE 'Float' END
        WHEN dt > 0.9 * n THEN 'Datetime' WHEN d < 0.05 * n THEN 'Categorical' ELSE 'other' END AS semantic_type FROM p"""


@query("b5_semantic_profile", _profile_sql())
def b5(spark, sf):
    return Q.semantic_profile(events_mixed(spark, sf))


@query("b5_semantic_profile_text")
def b5_text(spark, sf):
    return Q.semantic_profile(table(spark, sf, "pages"))


@query("b6_convert", f"SELECT event_id, value, TRY_CAST(mixed AS BIGINT) AS mixed, marked, truth = 'Yes' AS truth FROM {EVENTS_MIXED}")
def b6(spark, sf):
    ev = events_mixed(spark, sf)
    return Q.convert_semantic(ev, Q.semantic_profile(ev)).drop("ts", "fixed")


@query(
    "b7_expectations",
    """WITH r AS (
      SELECT 'not_null:o_custkey' AS expectation, count(*) - count(o_custkey) AS bad FROM orders UNION ALL
      SELECT 'between:o_totalprice', count(*) FILTER (NOT o_totalprice BETWEEN 1000 AND 200000) FROM orders UNION ALL
      SELECT 'in_set:o_orderstatus', count(*) FILTER (o_orderstatus NOT IN ('F', 'O')) FROM orders UNION ALL
      SELECT 'regex:o_orderpriority', count(*) FILTER (NOT regexp_matches(o_orderpriority, '^[1-5]-')) FROM orders UNION ALL
      SELECT 'unique:o_orderkey', count(*) FILTER (c > 1) FROM (SELECT count(*) AS c FROM orders GROUP BY o_orderkey))
    SELECT expectation, bad = 0 AS success, concat(CAST(bad AS VARCHAR), ' unexpected rows') AS detail FROM r""",
)
def b7(spark, sf):
    E = Q.Expectation
    suite = [
        E("not_null", "o_custkey"),
        E("between", "o_totalprice", {"low": 1000, "high": 200000}),
        E("in_set", "o_orderstatus", {"values": ["F", "O"]}),
        E("regex", "o_orderpriority", {"pattern": "^[1-5]-"}),
        E("unique", "o_orderkey"),
    ]
    return Q.validate(table(spark, sf, "orders"), suite)


@query("b8_drop_duplicates", f"SELECT DISTINCT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM {ORDERS_TWICE}")
def b8(spark, sf):
    return Q.drop_duplicate_rows(orders_twice(spark, sf).drop("o_orderdate"))


@query(
    "b9_near_constant",
    f"""WITH long AS (SELECT 'fixed' AS feature, fixed AS v FROM {EVENTS_MIXED} UNION ALL SELECT 'truth', truth FROM {EVENTS_MIXED}
      UNION ALL SELECT 'marked', marked FROM {EVENTS_MIXED}),
    c AS (SELECT feature, v, count(*) AS n FROM long GROUP BY 1, 2)
    SELECT feature, count(v) AS n_distinct, round(max(n) / sum(n), 6) AS top_share, count(v) < 2 OR max(n) / sum(n) >= 0.99 AS prune FROM c GROUP BY 1""",
)
def b9(spark, sf):
    return rounded(Q.near_constant(events_mixed(spark, sf), cols=["fixed", "truth", "marked"]))


@query(
    "b10_mixed_types",
    f"""WITH long AS (SELECT 'mixed' AS feature, mixed AS v FROM {EVENTS_MIXED} UNION ALL SELECT 'marked', marked FROM {EVENTS_MIXED}),
    k AS (SELECT feature, CASE WHEN TRY_CAST(v AS BIGINT) IS NOT NULL THEN 'integer' WHEN TRY_CAST(v AS DOUBLE) IS NOT NULL THEN 'float' ELSE 'text' END AS kind, count(*) AS n FROM long GROUP BY 1, 2)
    SELECT feature, kind, n, round(n / sum(n) OVER (PARTITION BY feature), 6) AS share, count(*) OVER (PARTITION BY feature) > 1 AS mixed FROM k""",
)
def b10(spark, sf):
    return rounded(Q.mixed_types(events_mixed(spark, sf), ["mixed", "marked"]))


@query(
    "b11_impossible_values",
    """SELECT 'negative_balance' AS rule, count(*) FILTER (c_acctbal < 0) AS n_broken FROM customer
    UNION ALL SELECT 'odd_segment', count(*) FILTER (c_mktsegment IN ('MACHINERY', 'none')) FROM customer""",
)
def b11(spark, sf):
    return Q.impossible_values(
        table(spark, sf, "customer"),
        {"negative_balance": F.col("c_acctbal") < 0, "odd_segment": F.col("c_mktsegment").isin("MACHINERY", "none")},
    )


@query(
    "b12_high_cardinality",
    """SELECT 'p_name' AS feature, count(DISTINCT p_name) AS n_distinct, round(count(DISTINCT p_name) / count(*), 6) AS distinct_share, count(DISTINCT p_name) / count(*) > 0.1 AS high_cardinality FROM part
    UNION ALL SELECT 'p_brand', count(DISTINCT p_brand), round(count(DISTINCT p_brand) / count(*), 6), count(DISTINCT p_brand) / count(*) > 0.1 FROM part
    UNION ALL SELECT 'p_type', count(DISTINCT p_type), round(count(DISTINCT p_type) / count(*), 6), count(DISTINCT p_type) / count(*) > 0.1 FROM part""",
)
def b12(spark, sf):
    return rounded(Q.high_cardinality(table(spark, sf, "part"), exact=True))


@query(
    "b13_missing_markers",
    f"""WITH long AS (SELECT 'mixed' AS feature, mixed AS v FROM {EVENTS_MIXED} UNION ALL SELECT 'marked', marked FROM {EVENTS_MIXED}),
    c AS (SELECT feature, v, count(*) AS n, sum(count(*)) OVER (PARTITION BY feature) AS t FROM long GROUP BY 1, 2)
    SELECT feature, v AS value, round(n / t, 6) AS share FROM c WHERE length(v) <= 2 AND n / t > 0.01""",
)
def b13(spark, sf):
    return rounded(Q.missing_markers(events_mixed(spark, sf), cols=["mixed", "marked"]))


@query("b13_null_markers", f"SELECT event_id, nullif(mixed, 'na') AS mixed, nullif(marked, '?') AS marked FROM {EVENTS_MIXED}")
def b13_apply(spark, sf):
    ev = events_mixed(spark, sf)
    marks = Q.missing_markers(ev, cols=["mixed", "marked"])
    return Q.null_markers(ev, marks.filter(~F.col("value").rlike("^[0-9]"))).select("event_id", "mixed", "marked")


@query("b14_mixed_numeric", f"SELECT event_id, TRY_CAST(mixed AS DOUBLE) AS mixed, marked FROM {EVENTS_MIXED}")
def b14(spark, sf):
    return Q.cast_mixed_numeric(events_mixed(spark, sf)).select("event_id", "mixed", "marked")


@query("b15_zero_as_missing", "SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS l_discount, nullif(l_tax, 0) AS l_tax FROM lineitem")
def b15(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    return Q.zero_as_missing(li, ["l_discount", "l_tax"])


@query("b16_clean_names", 'SELECT n_nationkey AS "N_NATIONKEY", n_name AS "N_NAME", n_regionkey AS "N_REGIONKEY" FROM nation')
def b16(spark, sf):
    return Q.clean_names(table(spark, sf, "nation"))


@query(
    "b17_drop_incomplete",
    f"""SELECT 'complete' AS rule, count(*) AS n FROM {LINEITEM_NULLS} WHERE qty IS NOT NULL AND disc IS NOT NULL AND ghost IS NOT NULL AND flag IS NOT NULL
    UNION ALL SELECT 'half_of_four', count(*) FROM {LINEITEM_NULLS} WHERE (qty IS NOT NULL)::INT + (disc IS NOT NULL)::INT + (ghost IS NOT NULL)::INT + (flag IS NOT NULL)::INT >= 2""",
)
def b17(spark, sf):
    d = lineitem_nulls(spark, sf)
    full = Q.drop_incomplete(d).agg(F.count(F.lit(1)).alias("n")).select(F.lit("complete").alias("rule"), "n")
    half = Q.drop_incomplete(d.select("qty", "disc", "ghost", "flag"), 0.5).agg(F.count(F.lit(1)).alias("n"))
    return full.unionByName(half.select(F.lit("half_of_four").alias("rule"), "n"))


@query(
    "b18_integrity",
    f"""SELECT 'duplicate_samples' AS "check", CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT qty, disc, status, flag FROM {LINEITEM_NULLS})) AS BIGINT) AS n FROM {LINEITEM_NULLS}
    UNION ALL SELECT 'rows_with_missing', count(*) FROM {LINEITEM_NULLS} WHERE qty IS NULL OR disc IS NULL OR flag IS NULL
    UNION ALL SELECT 'conflicting_labels', count(*) FROM (SELECT qty, disc, status FROM {LINEITEM_NULLS} GROUP BY ALL HAVING count(DISTINCT flag) > 1)""",
)
def b18(spark, sf):
    return Q.integrity_checks(lineitem_nulls(spark, sf), ["qty", "disc", "status"], "flag")
