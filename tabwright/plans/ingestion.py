"""The chain every reader result passes through."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..operators import quality


def ingest(df: DataFrame, mask: bool = True, convert: bool = True, suite: Sequence[quality.Expectation] = ()) -> tuple[DataFrame, dict[str, DataFrame]]:
    """Guard, mask, profile, convert and validate: the clean frame and its report tables.

    Reports stay lazy; only the profile (one row per column) is read to convert.
    """
    out = quality.require_rows(df)
    if mask:
        out = quality.mask_pii(out)
    reports = {"checksum": quality.audit_checksum(out), "duplicates": quality.duplicate_rows(out)}
    if convert:
        profile = quality.semantic_profile(out)
        reports["profile"] = profile
        out = quality.convert_semantic(out, profile)
    if suite:
        reports["expectations"] = quality.validate(out, suite)
    return out, reports
