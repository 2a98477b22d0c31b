"""Writers for result tables and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(
    df: DataFrame, path: str, order_by: list[str] | None = None, keep: list[str] | None = None
) -> None:
    """CSV with a header.  ``order_by`` range-partitions, so part files are in order."""
    if keep:
        df = df.select(*keep)
    if order_by:
        df = df.orderBy(*order_by)
    df.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines; for report tables, whose size is fixed by the report."""
    df.write.mode("overwrite").json(path)
