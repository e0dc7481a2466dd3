"""Queries on batch correction and matrix reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import rounded
from ..operators import matrix as M
from .registry import query, table

# Embedding components as measurements of three batches with an added offset.
LONG = "(SELECT vec_id, CAST(vec_id % 3 AS INTEGER) AS batch, label, CAST(unnest(range(len(embedding))) AS INTEGER) AS feature, unnest(embedding)::DOUBLE + (vec_id % 3) * 0.5 AS value FROM embeddings)"


def long(spark, sf):
    e = table(spark, sf, "embeddings")
    b = (F.col("vec_id") % 3).cast("int")
    return e.select("vec_id", b.alias("batch"), "label", F.posexplode("embedding").alias("feature", "v")).select(
        "vec_id", "batch", "label", "feature", (F.col("v").cast("double") + F.col("batch") * 0.5).alias("value")
    )


@query("q1_combat")
def q1(spark, sf):
    return M.combat(long(spark, sf))


@query("q1_combat_covariate")
def q1c(spark, sf):
    return M.combat(long(spark, sf), covariate="label")


@query("q2_batch_means", f"SELECT vec_id, batch, label, feature, round(value - avg(value) OVER (PARTITION BY feature, batch) + avg(value) OVER (PARTITION BY feature), 6) AS value FROM {LONG}")
def q2(spark, sf):
    return rounded(M.remove_batch_means(long(spark, sf)))


@query("q3_collapse_probes", "SELECT p_type AS gene, round(avg(l_quantity), 6) AS l_quantity, round(avg(l_discount), 6) AS l_discount FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size < 30 GROUP BY 1")
def q3(spark, sf):
    values = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("probe"), "l_quantity", "l_discount")
    known = table(spark, sf, "part").filter("p_size < 30").select(F.col("p_partkey").alias("probe"), F.col("p_type").alias("gene"))
    return rounded(M.collapse_probes(values, known, "probe", "gene"))


@query("q4_parse_annotation", "SELECT p_partkey, [p_type] AS genes FROM part")
def q4(spark, sf):
    note = F.concat(F.lit("NM_1 // "), "p_type", F.lit(" // a // b // c // NM_2 // "), "p_type", F.lit(" // d // e // f // NM_3 // X1"))
    return table(spark, sf, "part").select("p_partkey", M.parse_annotation(note).alias("genes"))


@query("q5_transpose", "SELECT sample, " + ", ".join(f"max(value) FILTER (r_name = '{r}') AS \"{r}\"" for r in ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]) + " FROM (SELECT r_name, 'n' AS sample, count(*) AS value FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1 UNION ALL SELECT r_name, 'top', max(n_nationkey) FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1) GROUP BY 1")
def q5(spark, sf):
    n = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    wide = n.groupBy("r_name").agg(F.count(F.lit(1)).alias("n"), F.max("n_nationkey").cast("long").alias("top"))
    return M.transpose_long(wide, "r_name", ["n", "top"])


@query("q6_label_from_title", "SELECT o_orderkey, CASE WHEN contains(lower(o_orderpriority), 'urgent') THEN 'case' WHEN contains(lower(o_orderpriority), 'low') THEN 'control' END AS label FROM orders WHERE contains(lower(o_orderpriority), 'urgent') OR contains(lower(o_orderpriority), 'low')")
def q6(spark, sf):
    return M.label_from_title(table(spark, sf, "orders"), "o_orderpriority", {"urgent": "case", "low": "control"}).select("o_orderkey", "label")


@query("q7_union_common", "SELECT nationkey, acctbal FROM (SELECT c_nationkey AS nationkey, c_acctbal AS acctbal FROM customer UNION ALL SELECT s_nationkey, s_acctbal FROM supplier)")
def q7(spark, sf):
    strip = lambda t: table(spark, sf, t).toDF(*[c[2:] for c in table(spark, sf, t).columns])
    return M.union_common([strip("customer").drop("name"), strip("supplier").drop("name")])


@query("q8_melt", "SELECT l_orderkey, l_linenumber, variable, value FROM (SELECT l_orderkey, l_linenumber, l_quantity, l_tax FROM lineitem) UNPIVOT (value FOR variable IN (l_quantity, l_tax))")
def q8(spark, sf):
    return M.melt(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_quantity", "l_tax"])


@query("q9_log2_normalize", "SELECT l_orderkey, l_linenumber, round(log2(l_extendedprice + 1), 6) AS l_extendedprice, round(log2(l_quantity + 1), 6) AS l_quantity FROM lineitem")
def q9(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    return rounded(M.log2_normalize(li, ["l_extendedprice", "l_quantity"]))
