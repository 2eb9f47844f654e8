"""Listing tables laid out by date (FLT-1, SRT-1), so that a cut-off by date reads only the folders it needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.operators.incremental import filter_date_range

SPREAD = 8  # tasks that may share the rows of one date


def write_by_date(df: DataFrame, path: str, column: str = "date_added", mode: str = "append", spread: int = SPREAD) -> None:
    """Rows in a folder per date, undated ones in a folder of their own.

    A date's rows are dealt out by all their values to ``spread`` tasks, so a date with a third of the rows is no
    hot task, and a date has at most that many files per write.
    """
    plain = [c for c, kind in df.dtypes if not kind.startswith(("map", "variant"))]
    dealt = df.repartition(F.col(column), F.pmod(F.xxhash64(*plain), F.lit(spread)))
    dealt.write.mode(mode).partitionBy(column).parquet(path)


def read_dates(spark: SparkSession, path: str, start=None, end=None, column: str = "date_added", keep_null: bool = True) -> DataFrame:
    """FLT-1 over such a table: both ends inclusive; only the folders of these dates are listed and read."""
    return filter_date_range(spark.read.parquet(path), start, end, column, keep_null)
