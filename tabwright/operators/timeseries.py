"""Daily series, decomposition and autocorrelation.

A daily series is bounded by the calendar (a century is 36,525 rows), so once
rows are summed per day plain windows over it are safe.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def daily(df: DataFrame, ts: str, value: str, fill: str = "zero") -> DataFrame:
    """``(day, value)`` for every calendar day; empty days are 0, or carried forward with ``fill="forward"``."""
    sums = df.groupBy(F.to_date(ts).alias("day")).agg(F.sum(value).alias("value")).filter(F.col("day").isNotNull())
    days = sums.agg(F.min("day").alias("a"), F.max("day").alias("z")).select(F.explode(F.sequence("a", "z")).alias("day"))
    out = days.join(sums, "day", "left")
    if fill == "forward":
        w = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
        return out.withColumn("value", F.last("value", ignorenulls=True).over(w))
    return out.withColumn("value", F.coalesce("value", F.lit(0.0)))


def decompose(series: DataFrame, day: str = "day", value: str = "value", period: int = 12) -> DataFrame:
    """Additive parts of a daily series: centred moving average, seasonal means about zero, residual."""
    half = period // 2
    w = Window.orderBy(day)
    span = w.rowsBetween(-half, half)
    edges = (F.lag(value, half).over(w) + F.lead(value, half).over(w)) / 2
    if period % 2 == 0:
        trend = (F.sum(value).over(w.rowsBetween(-half + 1, half - 1)) + edges) / period
    else:
        trend = F.avg(value).over(span)
    whole = F.lag(value, half).over(w).isNotNull() & F.lead(value, half).over(w).isNotNull()
    base = series.withColumn("pos", F.row_number().over(w) - 1).withColumn("trend", F.when(whole, trend))
    phase = F.col("pos") % period
    means = base.groupBy(phase.alias("phase")).agg(F.avg(F.col(value) - F.col("trend")).alias("raw"))
    seasonal = means.withColumn("seasonal", F.col("raw") - means.agg(F.avg("raw")).scalar()).select("phase", "seasonal")
    out = base.withColumn("phase", phase).join(F.broadcast(seasonal), "phase")
    return out.select(day, value, "trend", "seasonal", (F.col(value) - F.col("trend") - F.col("seasonal")).alias("residual"))


def autocorrelation(series: DataFrame, day: str = "day", value: str = "value", lags: int = 20) -> DataFrame:
    """``(lag, acf, pacf)``: all lag products in one aggregate, partials by Durbin-Levinson on the few results."""
    mean = series.agg(F.avg(value)).scalar()
    w = Window.orderBy(day)
    d = series.select(day, (F.col(value) - mean).alias("d"))
    cols = d.select("d", *[F.lag("d", k).over(w).alias(f"l{k}") for k in range(1, lags + 1)])
    row = cols.agg(F.sum(F.col("d") * F.col("d")), *[F.sum(F.col("d") * F.col(f"l{k}")) for k in range(1, lags + 1)]).first()
    acf = np.array([1.0] + [(row[k] or 0.0) / row[0] for k in range(1, lags + 1)])
    pacf = [1.0]
    phi = np.zeros(0)
    for k in range(1, lags + 1):
        num = acf[k] - float(phi @ acf[k - 1 : 0 : -1]) if k > 1 else acf[1]
        den = 1 - float(phi @ acf[1:k]) if k > 1 else 1.0
        last = num / den
        phi = np.append(phi - last * phi[::-1], last)
        pacf.append(last)
    return series.sparkSession.createDataFrame([(k, float(acf[k]), float(pacf[k])) for k in range(lags + 1)], "lag int, acf double, pacf double")
