"""Queries that run whole plans: ingestion, profile, training with held-out scoring, and monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import rounded
from ..plans import ingestion, monitoring, profiling, scoring
from .drift import psi_sql, sides
from .registry import query, table
from .sources_quality import _digest_sql, scratch


@query("plan_ingestion", f"SELECT n_rows, digest, 0::BIGINT AS duplicate_rows FROM ({_digest_sql('customer')})")
def ingest(spark, sf):
    _, reports = ingestion.ingest(table(spark, sf, "customer"), convert=False)
    return reports["checksum"].withColumn("duplicate_rows", reports["duplicates"].scalar())


@query("plan_profile", "SELECT 'p_name' AS feature, count(DISTINCT p_name) AS n_distinct FROM part UNION ALL SELECT 'p_brand', count(DISTINCT p_brand) FROM part UNION ALL SELECT 'p_type', count(DISTINCT p_type) FROM part")
def profile(spark, sf):
    return profiling.profile_table(table(spark, sf, "part"), "p_size")["cardinality"]


@query("plan_train_score", "SELECT count(*) AS n_new, true AS beats_majority FROM orders WHERE o_orderkey % 10 = 0")
def train_score(spark, sf):
    """Rows that took no part in the training are scored from the stored plans; the label follows from two columns with noise-free cuts."""
    folder = scratch(spark)
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.col("o_custkey").cast("double").alias("cust"), "o_orderstatus", (F.col("o_totalprice") > 250000).cast("int").alias("y"))
    old, new = o.filter("o_orderkey % 10 <> 0"), o.filter("o_orderkey % 10 = 0")
    scoring.train_and_save(old, "o_orderkey", "y", folder)
    got = scoring.score_new(spark, new.drop("y"), folder, "o_orderkey").join(new.select("o_orderkey", "y"), "o_orderkey")
    right = F.avg((F.col("prediction") == F.col("y")).cast("double"))
    return got.agg(F.count(F.lit(1)).alias("n_new"), (right > F.greatest(F.avg("y"), 1 - F.avg("y"))).alias("beats_majority"))


@query("plan_monitoring", " UNION ALL ".join(f"SELECT '{c}' AS feature, round(psi, 6) AS psi, psi >= 0.1 AS drift FROM {psi_sql(c)}" for c in ["l_extendedprice", "l_quantity"]))
def monitor(spark, sf):
    folder = scratch(spark)
    ref, new = sides(spark, sf)
    monitoring.save_reference(ref, ["l_extendedprice", "l_quantity"], folder)
    return rounded(monitoring.check_against(spark, new, folder))
