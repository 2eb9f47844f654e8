"""Bad records kept aside instead of lost (SRC-1, SRC-7): the text as it landed, its file, its place and a reason."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adloom.functions import fixed_values as V
from adloom.functions.text import strip
from adloom.session import durable
from adloom.sources.envelope import explode_items

_PLACE = (1 << 33) - 1


@dataclass(frozen=True)
class Checked:
    """``good`` rows, and ``bad`` ones as ``file, block, place, reason, value``.

    ``block`` is the byte at which the part of the file begins that a task has read, ``place`` the number of the
    record in that task. Every landed record is in one of the two.
    """

    good: DataFrame
    bad: DataFrame


def _placed(lines: DataFrame) -> DataFrame:
    meta = F.col("_metadata")
    return lines.select(
        "value", meta["file_path"].alias("file"), meta["file_block_start"].alias("block"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACE)).alias("place"),
    )


def _split(rows: DataFrame, good: Sequence[Column | str]) -> Checked:
    written = durable(rows)  # read and judged once; both sides come from what was written
    return Checked(written.filter("reason IS NULL").select(*good), written.filter("reason IS NOT NULL").select("file", "block", "place", "reason", "value"))


def read_jsonl_checked(spark: SparkSession, path: str, schema: T.StructType, required: Sequence[str] = ()) -> Checked:
    """SRC-7: JSON lines with ``schema``. Bad are lines that are no JSON object of that shape, and those in which a
    ``required`` field is missing or blank. Blank lines are no records."""
    corrupt = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])
    lines = _placed(spark.read.text(path).filter(strip(F.col("value")) != ""))
    parsed = F.from_json("value", corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    rows = lines.withColumn("item", parsed)
    reason = F.when(F.col("item").isNull() | F.col("item._corrupt").isNotNull(), F.lit("no such object"))
    for name in required:
        reason = reason.when(F.coalesce(strip(F.col(f"item.{name}").cast("string")), F.lit("")) == "", F.lit(f"no {name}"))
    return _split(rows.withColumn("reason", reason), [F.col(f"item.{f.name}").alias(f.name) for f in schema.fields])


def read_envelopes_checked(spark: SparkSession, path: str, keys: Sequence[str] = V.ENVELOPE_KEYS, end: str | None = None) -> Checked:
    """SRC-1: the bodies of response files that hold a list under one of ``keys``, or are one. Bad are files that
    are no JSON, and those without such a list. Blank files are records too.

    With ``end`` a file holds many responses, each closed by that text; ``place`` tells them apart.
    """
    files = _placed(spark.read.text(path, wholetext=True) if end is None else spark.read.text(path, lineSep=end))
    body = F.try_parse_json("value")
    lists = [F.try_variant_get(body, "$", "array<variant>"), *[F.try_variant_get(body, f"$.{k}", "array<variant>") for k in keys]]
    reason = F.when(body.isNull(), F.lit("no JSON")).when(F.coalesce(*lists).isNull(), F.lit("no list of items"))
    return _split(files.withColumn("reason", reason), ["file", F.col("value").alias("body")])


def items_of(checked: Checked, keys: Sequence[str] = V.ENVELOPE_KEYS) -> DataFrame:
    """The items of the good files of :func:`read_envelopes_checked`."""
    return explode_items(checked.good, "body", keys)


def quarantine(checked: Checked, path: str) -> None:
    """Append the bad records to the side table at ``path``."""
    checked.bad.withColumn("seen_at", F.current_timestamp()).write.mode("append").parquet(path)
