"""Streaming ingestion: JSON messages to masked, de-duplicated rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import mask_pii


def kafka_source(spark: SparkSession, servers: str, topic: str, starting: str = "latest", max_per_trigger: int | None = None, **options) -> DataFrame:
    """Messages of a topic as ``value``; needs the Kafka package on the cluster."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    reader = reader.option("startingOffsets", starting).options(**options)
    if max_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def json_lines_source(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Landed files of JSON lines as the same ``value`` column."""
    reader = spark.readStream.format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def decode(messages: DataFrame, schema: T.StructType | str) -> DataFrame:
    """One row per message that is valid JSON of the schema."""
    return messages.select(F.from_json("value", schema).alias("m")).filter(F.col("m").isNotNull()).select("m.*")


def clean(rows: DataFrame, ts: str, key: str, delay: str = "2 hours", mask: bool = True) -> DataFrame:
    """Masked text, late rows bounded by a watermark, repeated keys dropped inside it."""
    out = mask_pii(rows) if mask else rows
    return out.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def run_available(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Consume what has arrived, then stop: the bounded pull of a batch caller."""
    query = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
