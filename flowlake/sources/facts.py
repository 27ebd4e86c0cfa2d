"""Fact-table layout: provenance events, bulletins and queue snapshots on disk.

Facts are written partitioned by the event date, so a time-bounded query
reads only the matching directories (``PartitionFilters`` in the scan) and the
search columns stay plain Parquet columns that take pushed filters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DATE_COL = "event_date"


def write_facts(df: DataFrame, path: str, ts_col: str, mode: str = "append",
                max_records_per_file: int | None = None) -> None:
    """Write ``df`` under ``path`` partitioned by the date of ``ts_col``.

    Rows are dealt out by ranges of (date, timestamp) before the write: each
    task writes few directories, and a day with many rows is split over tasks.
    """
    out = df.withColumn(DATE_COL, F.to_date(F.col(ts_col)))
    w = out.repartitionByRange(DATE_COL, ts_col).write.mode(mode).partitionBy(DATE_COL)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", str(max_records_per_file))
    w.parquet(path)


def read_facts(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """Read facts, optionally only the dates in ``[start, end]`` (pruned by partition)."""
    df = spark.read.parquet(path)
    if start is not None:
        df = df.where(F.col(DATE_COL) >= F.to_date(F.lit(str(start))))
    if end is not None:
        df = df.where(F.col(DATE_COL) <= F.to_date(F.lit(str(end))))
    return df
