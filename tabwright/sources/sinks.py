"""Parquet snapshots and report files."""

from __future__ import annotations

import html
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame


def write_snapshot(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_splits(splits: Mapping[str, DataFrame], folder: str) -> None:
    """One Parquet folder per split, e.g. train, val and test."""
    for name, part in splits.items():
        write_snapshot(part, f"{folder}/{name}.parquet")


def write_report(report: DataFrame, path: str, kind: str = "json", mode: str = "overwrite") -> None:
    """A small report table as one JSON or CSV file."""
    writer = report.coalesce(1).write.mode(mode)
    if kind == "json":
        writer.json(path)
    elif kind == "csv":
        writer.option("header", True).csv(path)
    else:
        raise ValueError(f"unknown report format: {kind}")


def render_html(sections: Mapping[str, DataFrame], title: str = "Data health report") -> str:
    """Report tables, which are aggregates, as one page with all their lines."""
    parts = [f"<html><head><title>{html.escape(title)}</title></head><body><h1>{html.escape(title)}</h1>"]
    for name, report in sections.items():
        head = "".join(f"<th>{html.escape(c)}</th>" for c in report.columns)
        lines = (
            "<tr>" + "".join(f"<td>{html.escape(str(v))}</td>" for v in row) + "</tr>" for row in report.toLocalIterator()
        )
        parts.append(f"<h2>{html.escape(name)}</h2><table><tr>{head}</tr>{''.join(lines)}</table>")
    return "".join([*parts, "</body></html>"])
