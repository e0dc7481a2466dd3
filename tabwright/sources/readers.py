"""File, SQL and landed-JSON readers."""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Suffix of a path and the format it selects.
FORMATS = {".csv": "csv", ".tsv": "tsv", ".parquet": "parquet", ".pq": "parquet"}


def read_file(spark: SparkSession, path: str, schema: T.StructType | None = None, **options) -> DataFrame:
    """CSV, TSV or Parquet by suffix; any URI scheme the session knows (``s3://`` too).

    Give ``schema`` for large text files: inference is a second full read.
    """
    kind = FORMATS.get(PurePosixPath(path).suffix.lower())
    if kind is None:
        raise ValueError(f"unsupported file suffix: {path}")
    reader = spark.read.options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    if kind == "parquet":
        return reader.parquet(path)
    reader = reader.option("header", True).option("sep", "\t" if kind == "tsv" else options.get("sep", ","))
    if schema is None:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_sql(
    spark: SparkSession,
    url: str,
    query: str,
    partition_column: str | None = None,
    lower: int | str | None = None,
    upper: int | str | None = None,
    partitions: int | None = None,
    **properties,
) -> DataFrame:
    """A JDBC query; with bounds on ``partition_column`` it is read by many tasks."""
    reader = spark.read.format("jdbc").options(url=url, **properties)
    if partition_column is None:
        return reader.option("query", query).load()
    return reader.options(
        dbtable=f"({query}) AS q",
        partitionColumn=partition_column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
    ).load()


def read_json_payload(spark: SparkSession, path: str, schema: T.StructType | None = None, sep: str = ".") -> DataFrame:
    """A landed JSON payload (JSON lines) with nested objects as dotted columns."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return flatten(reader.json(path), sep)


def flatten(df: DataFrame, sep: str = ".", prefix: str = "") -> DataFrame:
    """Every nested struct field as its own column named by its path; arrays stay."""

    def walk(fields: T.StructType, path: list[str]) -> list[Column]:
        out = []
        for f in fields:
            here = [*path, f.name]
            if isinstance(f.dataType, T.StructType):
                out += walk(f.dataType, here)
            else:
                ref = ".".join(f"`{p}`" for p in here)
                out.append(F.col(ref).alias(prefix + sep.join(here)))
        return out

    return df.select(*walk(df.schema, []))


def read_commented_tsv(spark: SparkSession, path: str, comments: Sequence[str] = ("!", "#"), schema: T.StructType | None = None) -> DataFrame:
    """A tab-separated matrix with a header; lines that start with one of ``comments`` are remarks."""
    lines = spark.read.text(path)
    for mark in comments:
        lines = lines.filter(~F.col("value").startswith(mark))
    if schema is not None:  # the header is the line that holds the column names
        named = "\t".join(schema.names)
        return lines.filter(F.col("value") != named).select(F.from_csv("value", schema.simpleString()[7:-1].replace(":", " "), {"sep": "\t"}).alias("r")).select("r.*")
    texts = getattr(lines._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
    return DataFrame(spark._jsparkSession.read().option("sep", "\t").option("header", True).option("inferSchema", True).csv(texts), spark)
