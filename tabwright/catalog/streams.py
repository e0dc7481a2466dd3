"""Streaming queries, run to the end of what has arrived and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import detectors, drift, ingest
from .registry import query, table
from .sources_quality import scratch

EVENT = "event_id bigint, ts timestamp, user_id bigint, event_type string, value double"


def landed(spark, sf, repeats: bool = True) -> str:
    """events as JSON lines files, every fiftieth message twice unless ``repeats`` is off."""
    folder = scratch(spark)
    ev = table(spark, sf, "events").select("event_id", "ts", "user_id", F.concat("event_type", F.lit(" by a@b.io")).alias("event_type"), "value")
    twice = ev.unionByName(ev.filter(F.col("event_id") % 50 == 0))
    (twice if repeats else ev).select(F.to_json(F.struct("*")).alias("value")).repartition(4).write.text(folder)
    return folder


@query("a4_json_stream", "SELECT event_id, user_id, value FROM events UNION ALL SELECT event_id, user_id, value FROM events WHERE event_id % 50 = 0")
def a4(spark, sf):
    out = scratch(spark)
    ingest.run_available(ingest.decode(ingest.json_lines_source(spark, landed(spark, sf)), EVENT), out + "/data", out + "/ckpt")
    return spark.read.parquet(out + "/data").select("event_id", "user_id", "value")


@query("p20_stream_ingest", "SELECT event_id, concat(event_type, ' by [email]') AS event_type, value FROM events")
def p20(spark, sf):
    out = scratch(spark)
    rows = ingest.decode(ingest.json_lines_source(spark, landed(spark, sf)), EVENT)
    ingest.run_available(ingest.clean(rows, "ts", "event_id", delay="365 days"), out + "/data", out + "/ckpt")
    return spark.read.parquet(out + "/data").select("event_id", "event_type", "value")


CUTS = ", ".join(str(i / 10) for i in range(11))


@query(
    "p21_stream_drift",
    f"""WITH e AS (SELECT quantile_cont(value, [{CUTS}]) AS e FROM events), b AS (SELECT ts::DATE AS d, CASE WHEN value = e[11] THEN 9 ELSE len(list_filter(e, lambda x: x <= value)) - 1 END AS bin FROM events, e),
    p AS (SELECT bin, count(*) / (SELECT count(*) FROM events) AS p FROM b GROUP BY 1), t AS (SELECT d, count(*) AS n FROM b GROUP BY 1), q AS (SELECT d, bin, count(*) AS k FROM b GROUP BY 1, 2),
    g AS (SELECT t.d, t.n, r.bin, coalesce(p, 1e-8) AS p, coalesce(k / n, 1e-8) AS q FROM t CROSS JOIN range(10) AS r(bin) LEFT JOIN p USING (bin) LEFT JOIN q ON q.d = t.d AND q.bin = r.bin)
    SELECT CAST(d AS VARCHAR) AS day, CAST(any_value(n) AS BIGINT) AS n, round(sum((p - q) * ln(p / q)), 9) AS psi FROM g GROUP BY d""",
)
def p21(spark, sf):
    out = scratch(spark)
    profile, counts = drift.reference_profile(table(spark, sf, "events"), ["value"])
    rows = ingest.decode(ingest.json_lines_source(spark, landed(spark, sf, repeats=False)), EVENT)
    drift.run_counts(rows, drift.edges_of(profile), "ts", out + "/data", out + "/ckpt", "1 day", "365 days")
    result = drift.window_drift(drift.latest_counts(spark.read.parquet(out + "/data")), counts)
    return result.select(F.to_date("window_start").cast("string").alias("day"), "n", F.round("psi", 9).alias("psi"))


OVER = "OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)"


def detected(spark, sf, detector):
    """A detector by user on the landed events, every row with its statistic."""
    out = scratch(spark)
    rows = ingest.decode(ingest.json_lines_source(spark, landed(spark, sf, repeats=False)), EVENT)
    ingest.run_available(detector(rows.withColumn("error", (F.col("value") > 20).cast("int"))), out + "/data", out + "/ckpt")
    return spark.read.parquet(out + "/data")


@query(
    "p18_stream_detector",
    f"""WITH a AS (SELECT *, sum(value) {OVER} / count(*) {OVER} AS mean FROM events WHERE value IS NOT NULL AND ts IS NOT NULL), b AS (SELECT *, sum(value - mean - 0.005) {OVER} AS m FROM a),
    c AS (SELECT *, m - least(0, min(m) {OVER}) AS stat FROM b)
    SELECT event_id, user_id, value, round(stat, 6) AS statistic, stat > 50 AS drift FROM c""",
)
def p18s(spark, sf):
    out = detected(spark, sf, lambda rows: detectors.page_hinkley(rows, "user_id", "ts", "value", tie="event_id"))
    return out.select("event_id", "user_id", "value", F.round("statistic", 6).alias("statistic"), "drift")


@query(
    "p18_stream_ddm",
    f"""WITH e AS (SELECT *, CASE WHEN value > 20 THEN 1 ELSE 0 END AS error FROM events WHERE value IS NOT NULL AND ts IS NOT NULL),
    a AS (SELECT *, count(*) {OVER} AS n, sum(error) {OVER} / count(*) {OVER} AS p FROM e), b AS (SELECT *, p + sqrt(p * (1 - p) / n) AS ps, sqrt(p * (1 - p) / n) AS s FROM a),
    c AS (SELECT *, min(CASE WHEN n >= 5 THEN {{'ps': ps, 'n': n, 'p': p, 's': s}} END) {OVER} AS best FROM b)
    SELECT event_id, user_id, round(ps, 9) AS statistic, coalesce(ps > best.p + 3 * best.s, false) AS drift FROM c""",
)
def p18d(spark, sf):
    out = detected(spark, sf, lambda rows: detectors.ddm(rows, "user_id", "ts", "error", min_rows=5, tie="event_id"))
    return out.select("event_id", "user_id", F.round("statistic", 9).alias("statistic"), "drift")


@query("p18_stream_adaptive_window")
def p18a(spark, sf):
    out = detected(spark, sf, lambda rows: detectors.adaptive_window(rows, "user_id", "ts", "value", tie="event_id"))
    return out.select("event_id", "user_id", "value", F.col("statistic").cast("long").alias("window"), "drift")
