"""Row gates with recorded reasons, repair selection and cover choice (FLT-3 to FLT-5, WIN-5)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.functions import fixed_values as V
from adloom.functions.media import split_list
from adloom.functions.text import ascii_digits, blank_to_null, strip


def mandatory_failures(
    fields: Sequence[str] = V.MANDATORY_FIELDS, skip: Sequence[str] = V.MANDATORY_SKIP
) -> Column:
    """FLT-3: names of missing fields, in the order given (so the first one is deterministic)."""

    def missing(name: str) -> Column:
        return F.lower(strip(F.coalesce(F.col(name).cast("string"), F.lit("")))).isin(list(skip))

    return F.array_compact(F.array(*[F.when(missing(f), F.lit(f)) for f in fields]))


def mandatory_gate(
    df: DataFrame,
    fields: Sequence[str] = V.MANDATORY_FIELDS,
    skip: Sequence[str] = V.MANDATORY_SKIP,
) -> DataFrame:
    """FLT-3: adds ``reasons`` (all missing fields) and ``accepted``."""
    return _gated(df, mandatory_failures(fields, skip))


def _number(name: str) -> Column:
    return ascii_digits(F.regexp_replace(F.col(name).cast("string"), r"(?U)[^\d.]", "")).try_cast(
        "double"
    )


def quality_failures(
    fields: Sequence[str] = V.QUALITY_FIELDS, images: str | None = "image_urls"
) -> Column:
    """FLT-4: reasons against a listing: bad or blank fields, price, engine size, no image."""

    def bad(name: str) -> Column:
        text = strip(F.coalesce(F.col(name).cast("string"), F.lit("")))
        return text.isin("", *V.QUALITY_BAD)

    rules = [(bad(f), f) for f in fields]
    rules.append((F.coalesce(_number("price") <= 1, F.lit(True)), "price_value"))
    rules.append(
        (F.coalesce(_number("engine_size") < V.MIN_ENGINE_CC, F.lit(True)), "engine_value")
    )
    if images:
        rules.append((F.coalesce(F.size(images) < 1, F.lit(True)), "images"))
    return F.array_compact(F.array(*[F.when(failed, F.lit(name)) for failed, name in rules]))


def quality_gate(
    df: DataFrame, fields: Sequence[str] = V.QUALITY_FIELDS, images: str | None = "image_urls"
) -> DataFrame:
    """FLT-4: adds ``reasons`` and ``accepted``."""
    return _gated(df, quality_failures(fields, images))


def _gated(df: DataFrame, reasons: Column) -> DataFrame:
    return df.withColumn("reasons", reasons).withColumn("accepted", F.size("reasons") == 0)


def split_gate(gated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(accepted rows, rejected rows with reasons)``."""
    return gated.filter("accepted").drop("reasons", "accepted"), gated.filter("NOT accepted").drop(
        "accepted"
    )


def needs_image_repair(
    df: DataFrame, links: str = "images_drive_links", originals: str | None = None, key: str = "id"
) -> DataFrame:
    """FLT-5: keyed rows whose image cell is blank; with ``originals`` only those that still have
    original links, which come back as the list ``image_urls``."""
    blank = blank_to_null(strip(F.col(links))).isNull()
    keyed = blank_to_null(strip(F.col(key))).isNotNull()
    rows = df.filter(blank & keyed)
    if originals is None:
        return rows
    return rows.withColumn("image_urls", split_list(F.col(originals))).filter(
        F.size("image_urls") > 0
    )


def looks_like_exterior() -> Column:
    """WIN-5: not portrait, not dark; unreadable metadata passes."""
    portrait = F.col("height") > F.col("width") * V.MAX_HEIGHT_TO_WIDTH
    dark = F.col("brightness") < V.MIN_BRIGHTNESS
    return ~F.coalesce(portrait | dark, F.lit(False))


def cover_images(images: DataFrame, key: str = "id") -> DataFrame:
    """WIN-5: first image that looks like an exterior, else the first image."""
    passing = F.when(looks_like_exterior(), F.col("idx"))
    return images.groupBy(key).agg(
        F.coalesce(F.min_by("url", passing), F.min_by("url", "idx")).alias("cover_url")
    )
