"""Report tables on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_reports(tables: dict[str, DataFrame], root: str, fmt: str = "parquet",
                  mode: str = "errorifexists") -> None:
    """One folder per report. CSV gets a header; nothing is rendered."""
    for name, table in tables.items():
        writer = table.write.mode(mode).format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.save(f"{root.rstrip('/')}/{name}")
