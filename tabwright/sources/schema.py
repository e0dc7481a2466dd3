"""Schema enforcement, schema alignment and run manifests."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import audit_checksum


def check_schema(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Rows with cast columns and a ``reject_reason`` (NULL when accepted).

    A value that does not cast, or a NULL in a required column, rejects its row
    and names the columns; a column that is absent rejects every row.
    """
    have = {f.name for f in df.schema}
    cells, reasons = [], []
    for f in expected:
        if f.name not in have:
            cells.append(F.lit(None).cast(f.dataType).alias(f.name))
            reasons.append(F.lit(f"{f.name}:absent"))
            continue
        raw = F.col(f"`{f.name}`")
        cast = raw.try_cast(f.dataType)
        cells.append(cast.alias(f.name))
        reasons.append(F.when(raw.isNotNull() & cast.isNull(), F.lit(f"{f.name}:type")))
        if not f.nullable:
            reasons.append(F.when(raw.isNull(), F.lit(f"{f.name}:null")))
    why = F.array_join(F.array_compact(F.array(*reasons)), ",")
    return df.select(*cells, F.when(why != "", why).alias("reject_reason"))


def enforce_schema(df: DataFrame, expected: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Accepted rows (of the expected schema) and rejected rows (with a reason)."""
    checked = check_schema(df, expected)
    ok = checked.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return ok, checked.filter(F.col("reject_reason").isNotNull())


def run_manifest(df: DataFrame, seed: int, flags: Mapping[str, str] | None = None) -> DataFrame:
    """One row on a run: time, rows, columns, seed, flags and the content digest."""
    pairs = [F.lit(x) for kv in (flags or {}).items() for x in kv]
    stamp = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    return audit_checksum(df).select(
        F.current_timestamp().alias("created_at"),
        F.col("n_rows"),
        F.lit(len(df.columns)).alias("n_cols"),
        F.lit(seed).alias("seed"),
        stamp.alias("flags"),
        F.col("digest"),
    )
