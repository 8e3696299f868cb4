"""Sinks: chart CSV files and Parquet tables. Writing only happens here."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_chart_csv(df: DataFrame, path: str, order_by=None, columns=None, split_by=(), row_names: bool = False) -> None:
    """One CSV with a header, NULL written as NA, overwriting an earlier output of the same name.

    Chart tables have tens of rows (bands x sexes x years), so they are written as one file.
    Rows are in the order of ``order_by``, ``columns`` are the written ones (which may leave out
    sort keys), and ``split_by`` makes one folder for each of its values. ``row_names`` puts the row's
    number first, under an empty name."""
    out = df.repartition(1)
    if order_by or split_by:
        out = out.sortWithinPartitions(*split_by, *(order_by or ()))
    if columns:
        out = out.select(*split_by, *columns)
    if row_names:
        out = out.select((F.monotonically_increasing_id() + 1).alias(""), *out.columns)  # one partition, so without gaps
    write = out.write.mode("overwrite").option("header", True).option("nullValue", "NA")
    (write.partitionBy(*split_by) if split_by else write).csv(path)


def write_table(df: DataFrame, path: str, partition_by=None) -> None:
    """Parquet table (the serialised base files of the method)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
