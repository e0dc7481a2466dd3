"""Drift of a stream against a frozen reference profile.

The reference is kept as bin edges and bin counts (a few numbers per feature);
the stream is reduced to counts per window and bin, so the raw reference is never
read again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..operators import drift

EDGES = "feature string, edges array<double>"


def reference_profile(ref: DataFrame, cols: Sequence[str], bins: int = drift.PSI_BINS) -> tuple[DataFrame, DataFrame]:
    """``(feature, edges)`` and ``(feature, bin, n)`` of the reference, both small enough to store."""
    edges = drift.psi_bins(ref, cols, bins)
    return ref.sparkSession.createDataFrame([(c, e) for c, e in edges.items()], EDGES), drift.bin_counts(ref, edges)


def edges_of(profile: DataFrame) -> Mapping[str, Sequence[float]]:
    return {r["feature"]: list(r["edges"]) for r in profile.collect()}


def window_counts(stream: DataFrame, edges: Mapping[str, Sequence[float]], ts: str, window: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    """``(window_start, feature, bin, n)``; works on a stream and on a batch alike."""
    marked = stream.withWatermark(ts, delay).withColumn("w", F.window(ts, window))
    counts = drift.bin_counts(marked, edges, ["w"])
    return counts.select(F.col("w.start").alias("window_start"), "feature", F.coalesce("bin", F.lit(-1)).alias("bin"), "n")


def run_counts(stream: DataFrame, edges: Mapping[str, Sequence[float]], ts: str, table: str, checkpoint: str, window: str = "1 hour", delay: str = "2 hours") -> None:
    """Append the updated counts of every micro-batch to ``table``; late rows raise earlier counts."""

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(table)

    query = window_counts(stream, edges, ts, window, delay).writeStream.outputMode("update").foreachBatch(keep)
    query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def latest_counts(table: DataFrame) -> DataFrame:
    """Counts only grow, so the largest one per cell is the current one, whatever was written twice."""
    return table.groupBy("window_start", "feature", "bin").agg(F.max("n").alias("n"))


def window_drift(counts: DataFrame, ref_counts: DataFrame, bins: int = drift.PSI_BINS, psi_limit: float = drift.PSI_LIMIT) -> DataFrame:
    """``(window_start, feature, n, psi, ks, drift)``; KS is taken at the bin borders."""
    keys = ["window_start", "feature"]
    total = counts.groupBy(*keys).agg(F.sum("n").alias("n"))
    share = counts.filter(F.col("bin") >= 0).join(total.withColumnRenamed("n", "all"), keys).select(*keys, "bin", (F.col("n") / F.col("all")).alias("q"))
    ref_total = ref_counts.groupBy("feature").agg(F.sum("n").alias("all"))
    ref = ref_counts.filter(F.col("bin").isNotNull()).join(ref_total, "feature").select("feature", "bin", (F.col("n") / F.col("all")).alias("p"))
    grid = total.select(*keys, F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    both = grid.join(share, [*keys, "bin"], "left").join(F.broadcast(ref), ["feature", "bin"], "left")
    p, q = F.coalesce("p", F.lit(drift.EMPTY_BIN)), F.coalesce("q", F.lit(drift.EMPTY_BIN))
    # At most ``bins`` rows per window and feature.
    upto = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    gap = F.abs(F.sum(F.coalesce("p", F.lit(0.0))).over(upto) - F.sum(F.coalesce("q", F.lit(0.0))).over(upto))
    out = both.withColumn("gap", gap).groupBy(*keys).agg(F.sum((p - q) * F.ln(p / q)).alias("psi"), F.max("gap").alias("ks"))
    return out.join(total, keys).select(*keys, "n", "psi", "ks", (F.col("psi") >= psi_limit).alias("drift"))
