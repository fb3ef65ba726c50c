"""Writing tables and report exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite"
) -> None:
    """Write Parquet, optionally partitioned, for example by Year and Month.

    Rows are rebalanced on the partition columns first: few files per partition, while a partition
    that holds most of the rows is still written by several tasks.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def export_reports(reports: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> list[str]:
    """Write one directory per report and return the paths. ``fmt`` is parquet or csv."""
    if fmt not in ("parquet", "csv"):
        raise ValueError("fmt must be 'parquet' or 'csv'")
    paths = []
    for name, report in reports.items():
        path = f"{folder}/{name}"
        writer = report.write.mode("overwrite")
        if fmt == "csv":
            writer.option("header", True).csv(path)
        else:
            writer.parquet(path)
        paths.append(path)
    return paths
