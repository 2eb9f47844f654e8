"""Listing tables and logs: scans (SRC-5 to SRC-7) and sinks (SNK-1 to SNK-5)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.functions.text import blank_to_null, strip
from adloom.sources.versions import VersionedTable, current_path


# --- scans ---------------------------------------------------------------------------------------
def read_pages(spark: SparkSession, path: str, whole_text: bool = False) -> DataFrame:
    """SRC-5: landed pages as ``(url, html)``, from a table or from one file per page."""
    if whole_text:
        files = spark.read.text(path, wholetext=True)
        return files.select(F.input_file_name().alias("url"), F.col("value").alias("html"))
    return spark.read.parquet(path)


def read_listing_table(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, number_rows: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """SRC-6: header-driven CSV; short rows are padded with NULL and empty rows are skipped.

    Passing ``columns`` saves the pass that reads the header. With ``number_rows`` a ``row_num`` in
    file order is added; numbers rise within the table but are not gap-free. ``multi_line`` allows line
    breaks inside quoted cells, at the price of one task per file.
    """
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE")
    reader = reader.option("multiLine", multi_line).option("escape", '"')
    if columns:
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        reader = reader.schema(schema)
    rows = reader.csv(current_path(spark, path))
    present = F.coalesce(*[blank_to_null(F.col(f"`{c}`")) for c in rows.columns])
    rows = rows.filter(present.isNotNull())
    return rows.withColumn("row_num", F.monotonically_increasing_id()) if number_rows else rows


def read_known_ids(spark: SparkSession, path: str, key: str = "id") -> DataFrame:
    """SRC-7: distinct ids of a JSON-lines log; malformed lines and blank ids are dropped."""
    schema = T.StructType([T.StructField(key, T.StringType())])
    lines = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    text = strip(F.col(key))
    return lines.select(F.when(text != "", text).alias(key)).dropna().distinct()


# --- sinks ---------------------------------------------------------------------------------------
def append_jsonl(df: DataFrame, path: str) -> None:
    """SNK-1: append as JSON lines; arrays stay arrays."""
    df.write.mode("append").json(path)


def to_cell(column: Column, data_type: T.DataType) -> Column:
    """SNK-2: NULL to blank, lists joined with commas, everything else as text."""
    if isinstance(data_type, T.ArrayType):
        text = F.array_join(column.cast("array<string>"), ", ")
    elif isinstance(data_type, (T.MapType, T.StructType)):
        text = F.to_json(column)
    elif isinstance(data_type, (T.DoubleType, T.FloatType)):
        whole = column.try_cast("decimal(38,0)").cast("string")
        text = F.when(column == F.floor(column), whole).otherwise(column.cast("string"))
    else:
        text = column.cast("string")
    return F.coalesce(text, F.lit(""))


def to_cells(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """SNK-2: project to ``columns`` in order, all as text; missing columns become blank."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        *[
            (to_cell(F.col(f"`{c}`"), types[c]) if c in types else F.lit("")).alias(c)
            for c in columns
        ]
    )


def append_table(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """SNK-2: ordered append to a header-carrying CSV table, or to its current version."""
    cells = to_cells(df, columns)
    cells.write.mode("append").option("header", True).option("emptyValue", "").csv(current_path(df.sparkSession, path))


def overwrite_table(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """SNK-3: replace all data rows, keep the header.

    The rows, which may come from the table itself, become a new version; the old ones stay until it is complete.
    """
    VersionedTable(df.sparkSession, path, "csv", header="true", emptyValue="").replace(to_cells(df, columns))


def sort_newest_first(df: DataFrame, column: str = "date_added") -> DataFrame:
    """SRT-1: newest first, blanks last; a range-partitioned sort, so files come out in order."""
    return df.orderBy(F.col(column).desc_nulls_last())


@dataclass(frozen=True)
class Alignment:
    """Result of :func:`align_schema`."""

    columns: list[str]
    added: list[str]
    unknown: list[str]
    reset: bool


def plan_alignment(existing: Sequence[str], target: Sequence[str], policy: str) -> Alignment:
    """SNK-4 / SET-5: header a table should have.

    ``exact``   anything but an identical header is reset to the target.
    ``insert``  missing columns are inserted at their target position; a different first column
                means a different table and is reset.
    ``append``  missing columns go to the end; a superset is left alone, and a header with unknown
                columns is kept as it is and reported.
    """
    existing, target = list(existing), list(target)
    missing = [c for c in target if c not in existing]
    unknown = [c for c in existing if c not in target]
    if policy == "exact":
        same = existing == target
        return Alignment(target, [] if same else missing, unknown, reset=not same)
    if policy == "insert":
        if not existing or existing[0] != target[0]:
            return Alignment(target, missing, unknown, reset=True)
        header = list(existing)
        added = []
        for position, name in enumerate(target):
            if position >= len(header) or header[position] != name:
                header.insert(position, name)
                added.append(name)
        return Alignment(header, added, unknown, reset=False)
    if policy == "append":
        if not existing:
            return Alignment(target, target, [], reset=False)
        if unknown and missing:
            return Alignment(existing, [], unknown, reset=False)
        return Alignment(existing + missing, missing, unknown, reset=False)
    raise ValueError(f"unknown policy {policy!r}")


def align_schema(df: DataFrame, target: Sequence[str], policy: str = "append") -> DataFrame:
    """SNK-4: existing rows under the header chosen by :func:`plan_alignment`."""
    plan = plan_alignment(df.columns, target, policy)
    if plan.reset:
        empty = T.StructType([T.StructField(c, T.StringType()) for c in plan.columns])
        return df.sparkSession.createDataFrame([], empty)
    out, used = [], set()
    for name in plan.columns:
        # An inserted column may repeat a name that also exists further right; only one holds data.
        known = name in df.columns and name not in used
        if name in used:
            continue
        used.add(name)
        out.append(F.col(f"`{name}`") if known else F.lit(None).cast("string").alias(name))
    return df.select(*out)


def infer_headers(df: DataFrame) -> list[str]:
    """SNK-5: headers of a table without a fixed layout are the columns of the data."""
    return list(df.columns)


def union_sources(*feeds: DataFrame) -> DataFrame:
    """SET-1: feeds with different columns under one header."""
    result = feeds[0]
    for feed in feeds[1:]:
        result = result.unionByName(feed, allowMissingColumns=True)
    return result
