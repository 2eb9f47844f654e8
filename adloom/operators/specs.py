"""Label/value pairs to fields (JN-5, JN-12) and specs written inside descriptions (EXT-5).

Pairs live inside the listing row as ``array<struct<pos,label,value>>`` whenever they were read with
it, and are resolved there without any shuffle. Pairs that arrive as a table of their own go through
:func:`pivot_specs`, whose aggregation combines on the map side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.functions import fixed_values as V
from adloom.functions.markup import once
from adloom.functions.numbers import clean_mileage
from adloom.functions.text import (
    ascii_digits, blank_to_null, clean, clean_dashes, contains_any, map_value, squeeze, strip,
)


def label_table(df: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """Label dictionary as a (small, literal) table without the ignored labels."""
    rows = [(k, v) for k, v in labels.items() if not v.startswith("_")]
    return df.sparkSession.createDataFrame(rows, "label string, field string")


def pivot_specs(
    pairs: DataFrame, labels: Mapping[str, str], keys: Sequence[str] = ("id",), keep: str = "first"
) -> DataFrame:
    """JN-5 over a pair table ``(keys..., pos, label, value)``: one column per field.

    ``keep='first'`` lets the lowest position win, ``'last'`` the highest. Blank values never win.
    """
    fields = sorted({f for f in labels.values() if not f.startswith("_")})
    named = pairs.join(F.broadcast(label_table(pairs, labels)), "label")
    named = named.filter(F.col("value") != "")
    choose = F.min_by if keep == "first" else F.max_by
    picked = [
        choose(F.when(F.col("field") == f, F.col("value")),
               F.when(F.col("field") == f, F.col("pos"))).alias(f)
        for f in fields
    ]
    return named.groupBy(*keys).agg(*picked)


def mapped_pairs(pairs: Column, labels: Mapping[str, str]) -> Column:
    """Pairs of a row with their field in place of the label; unmapped and blank ones are gone."""
    used = {k: v for k, v in labels.items() if not v.startswith("_")}
    named = F.transform(
        pairs,
        lambda p: F.struct(map_value(p["label"], used).alias("field"), p["value"].alias("value")),
    )
    return F.filter(named, lambda p: p["field"].isNotNull() & (p["value"] != ""))


def field_value(pairs: Column, name: str, keep: str = "first") -> Column:
    """JN-5 inside a row: first or last value of a field among mapped pairs.

    Looked up by position, which is compiled, instead of filtering the pairs once per field.
    """
    fields, values = pairs["field"], pairs["value"]
    if keep == "last":
        fields, values = F.reverse(fields), F.reverse(values)
    position = F.nullif(F.array_position(fields, F.lit(name)), F.lit(0).cast("bigint"))
    return F.try_element_at(values, position.cast("int"))


def with_specs(
    df: DataFrame, pairs: str, labels: Mapping[str, str], keep: str = "first", prefix: str = ""
) -> DataFrame:
    """One column per field of ``labels`` from the pairs of each row. No shuffle."""
    fields = sorted({f for f in labels.values() if not f.startswith("_")})
    named = df.withColumn("_pairs", mapped_pairs(F.col(pairs), labels))
    return named.withColumns(
        {f"{prefix}{f}": field_value(F.col("_pairs"), f, keep) for f in fields}
    ).drop("_pairs")


def zip_pairs(labels: Column, values: Column) -> Column:
    """JN-12: position-wise pairs, cut to the shorter list. Both lists are made once, not again for every pair."""

    def pairs(labels: Column, values: Column) -> Column:
        both = F.least(F.size(labels), F.size(values))
        return F.transform(
            F.slice(labels, 1, both),
            lambda label, i: F.struct(
                i.cast("int").alias("pos"), label.alias("label"),
                F.try_element_at(values, i + 1).alias("value"),
            ),
        )

    return once(labels, lambda names: once(values, lambda texts: pairs(names, texts)))


def halves(items: Column) -> Column:
    """JN-12: first half of a list as labels of the second half."""
    middle = F.floor(F.size(items) / 2).cast("int")
    return zip_pairs(F.slice(items, 1, middle), F.slice(items, middle + 1, F.size(items)))


# --- EXT-5 -----------------------------------------------------------------------------------------
# Fixed patterns of bullet lines and free-text fallbacks in descriptions.
BULLET = r"(?U)[▪▸•]\s*(.{2,30}?)\s*[:：]\s*(.{1,120}?)(?=\n|[▪▸•]|$)"
PLACES = [
    r"(?U)(?:📌\s*)?العنوان\s*[:：]\s*([^\n/▪،,\d]{2,40})",
    r"(?U)تواجد\s+([^\n/▪،,\d]{2,30})",
]
PLACE_WORDS = ["العنوان", "تواجد"]
DRIVEN = r"(?iU)(?:ماشية|عداد)[^\d]*(\d[\d,،٬.]*)\s*(?:(الف|ألف)\s*)?(?:كيلو|كم|km|K)?"
DRIVEN_WORDS = ["ماشية", "عداد"]
BUILT = r"(?U)(?:سنة|موديل)\s*(?:الصنع|الإنتاج)?\s*[:،]?\s*(20\d{2}|19\d{2})"
BUILT_WORDS = ["سنة", "موديل"]


def _where(text: Column, words: Sequence[str], found: Column) -> Column:
    """``found``, which a pattern gives only in texts with one of ``words``; elsewhere the pattern is not tried."""
    return F.when(contains_any(text, words), found)


def description_pairs(description: Column) -> Column:
    """Bullet lines ``▪label : value`` as pairs in text order; tatweel is ignored."""
    text = F.translate(description, "ـ", "")
    labels = F.transform(F.regexp_extract_all(text, F.lit(BULLET), 1), squeeze)
    values = F.transform(F.regexp_extract_all(text, F.lit(BULLET), 2), clean_dashes)
    return zip_pairs(labels, values)


def mine_description(df: DataFrame, description: str, prefix: str = "desc_") -> DataFrame:
    """EXT-5: spec columns mined from a free-text description (prefix ``desc_``).

    Bullets win; ``desc_city``, mileage and year fall back to patterns in the running text.
    """
    source = F.col(description)
    text = F.translate(source, "ـ", "")
    out = with_specs(
        df.withColumn("_bullets", description_pairs(source)), "_bullets", V.DESCRIPTION_LABELS,
        prefix=prefix,
    ).drop("_bullets")
    number = F.translate(F.regexp_extract(text, DRIVEN, 1), ",،٬.", "")
    driven = _where(text, DRIVEN_WORDS, F.when(
        F.regexp_extract(text, DRIVEN, 2) != "",
        (ascii_digits(number).try_cast("bigint") * 1000).cast("string"),
    ).otherwise(blank_to_null(number)))
    place = F.coalesce(*[
        _where(text, [word], once(F.regexp_extract(text, p, 1), lambda t: clean(t, V.DASHES))) for word, p in zip(PLACE_WORDS, PLACES)
    ])
    built = _where(text, BUILT_WORDS, blank_to_null(F.regexp_extract(text, BUILT, 1)))
    mileage = clean_mileage(F.col(f"{prefix}mileage"), thousands=False)
    return out.withColumns(
        {
            f"{prefix}mileage": F.coalesce(mileage, driven),
            f"{prefix}year": F.coalesce(F.col(f"{prefix}year"), built),
            f"{prefix}city": strip(place),
        }
    )
