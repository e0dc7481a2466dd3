"""Monitoring of new batches against a stored reference."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import drift
from ..streaming import drift as stream_drift


def save_reference(ref: DataFrame, cols: Sequence[str], folder: str, bins: int = drift.PSI_BINS) -> None:
    """Bin edges and counts of the reference, a few rows per column."""
    edges, counts = stream_drift.reference_profile(ref, cols, bins)
    edges.write.mode("overwrite").parquet(f"{folder}/edges")
    counts.write.mode("overwrite").parquet(f"{folder}/counts")


def check_against(spark: SparkSession, new: DataFrame, folder: str, bins: int = drift.PSI_BINS) -> DataFrame:
    """``(feature, psi, drift)`` of a batch from the stored profile alone: the reference is not read again."""
    edges = stream_drift.edges_of(spark.read.parquet(f"{folder}/edges"))
    counts = drift.bin_counts(new, edges)
    return drift.psi_from_counts(spark.read.parquet(f"{folder}/counts"), counts, bins).withColumn("drift", F.col("psi") >= drift.PSI_LIMIT)


def monitor(ref: DataFrame, new: DataFrame, history: str | None = None, run_id: str = "run", target: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Full drift report and the retrain decision; the report joins the history."""
    features = [c for c in ref.columns if c != target]
    report = drift.drift_report(ref.select(*features), new.select(*[c for c in features if c in new.columns]))
    raised = drift.alerts(report, drift.schema_skew(ref, new))
    if target is not None:
        moved = drift.target_drift(ref, new, target).filter("drift").select(F.lit("target_drift").alias("alert"))
        raised = raised.unionByName(moved)
    if history is not None:
        drift.append_history(report, history, run_id)
    return report, drift.retrain_decision(raised)
