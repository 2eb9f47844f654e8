"""Controlled vocabularies as small tables (SRC-8, SRC-9 and the alias dimension).

Files hold what a deployment maintains: the value lists, the brand and model lists and the long list
of model aliases. Only the short per-field aliases are fixed values of this package.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.functions import fixed_values as V
from adloom.functions.text import alias_key, strip

# Field -> vocabulary list that its values are matched against.
FIELD_LISTS = {
    "doors": "doors",
    "fuel_type": "fuel_type",
    "drive_system": "drive_type",
    "transmission": "transmission",
    "origin": "imported",
    "body_type": "vehicle_type",
    "city": "location",
    "exterior_color": "color",
    "interior_color": "interior_color",
    "condition": "condition",
}
ANY_MAKE = "*"


def load_vocab(spark: SparkSession, path: str) -> DataFrame:
    """SRC-8: ``{field: [{name}]}`` as ``(field, ord, name)``."""
    text = spark.read.text(path, wholetext=True)
    lists = F.from_json("value", "map<string,array<struct<name:string>>>")
    return (
        text.select(F.explode(lists).alias("field", "entries"))
        .select("field", F.posexplode("entries").alias("ord", "entry"))
        .select("field", "ord", F.col("entry.name").alias("name"))
    )


def load_brand_models(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """SRC-9: ``{brand: [model]}`` as ``(brand, brand_ord, model, model_ord)``.

    The first path that can be read is used. Names are trimmed, junk brands skipped, repeated models
    dropped in order, and of two spellings that trim to one brand the first wins. A brand without
    models keeps one row whose model is NULL.
    """
    text = _first_readable(spark, [paths] if isinstance(paths, str) else list(paths))
    brands = text.select(
        F.posexplode(F.map_entries(F.from_json("value", "map<string,array<string>>"))).alias(
            "brand_ord", "entry"
        )
    ).select(
        strip(F.col("entry.key")).alias("brand"),
        "brand_ord",
        F.array_distinct(
            F.filter(F.transform("entry.value", strip), lambda m: m != "")
        ).alias("models"),
    )
    brands = brands.filter((F.col("brand") != "") & ~F.col("brand").isin(V.JUNK_BRANDS))
    firsts = brands.groupBy("brand").agg(
        F.min("brand_ord").alias("brand_ord"), F.min_by("models", "brand_ord").alias("models")
    )
    return firsts.select(
        "brand", "brand_ord", F.posexplode_outer("models").alias("model_ord", "model")
    )


def _first_readable(spark: SparkSession, paths: list[str]) -> DataFrame:
    last: Exception | None = None
    for path in paths:
        try:
            return spark.read.text(path, wholetext=True)
        except Exception as missing:  # the path does not exist
            last = missing
    raise FileNotFoundError(f"no vocabulary among {paths}") from last


def load_aliases(spark: SparkSession, path: str) -> DataFrame:
    """Model aliases ``{key: canonical}`` from a JSON file as ``(key, canonical)``."""
    text = spark.read.text(path, wholetext=True)
    return text.select(
        F.explode(F.from_json("value", "map<string,string>")).alias("key", "canonical")
    )


def builtin_aliases(spark: SparkSession) -> DataFrame:
    """Alias dimension ``(field, scope, key, canonical)``; ``scope`` is a make, or ``*``.

    Keys are folded. Where two spellings fold to one key the first entry of the map wins.
    """
    rows, order = [], 0
    for field, entries in V.FIELD_ALIASES.items():
        for key, canonical in entries.items():
            rows.append((order := order + 1, field, ANY_MAKE, key, canonical))
    for make, entries in V.MAKE_MODEL_ALIASES.items():
        for key, canonical in entries.items():
            rows.append((order := order + 1, "model", make, key, canonical))
    table = spark.createDataFrame(rows, "ord int, field string, scope string, key string, canonical string")
    return (
        table.withColumn("key", alias_key(F.col("key")))
        .groupBy("field", "scope", "key")
        .agg(F.min_by("canonical", "ord").alias("canonical"))
    )


@dataclass(frozen=True)
class Vocabulary:
    """The three tables the resolver needs."""

    candidates: DataFrame  # list string, ord long, name string
    aliases: DataFrame  # field, scope, key (folded, lower-cased), canonical
    model_aliases: DataFrame  # key (lower-cased), canonical


def build_vocabulary(
    spark: SparkSession,
    vocab: DataFrame,
    brand_models: DataFrame,
    model_aliases: DataFrame | None = None,
) -> Vocabulary:
    """Put value lists, brands and models under one ``(list, ord, name)`` roof.

    Lists are ``field:<field>``, ``make``, ``model:<brand>`` and ``model:*`` (all models in brand
    order), so every kind of match is an equi-join on ``list``.
    """
    lists = spark.createDataFrame(list(FIELD_LISTS.items()), "field string, source string")
    fields = vocab.withColumnRenamed("field", "source").join(lists, "source").select(
        F.concat(F.lit("field:"), "field").alias("list"), F.col("ord").cast("long"), "name"
    )
    makes = brand_models.groupBy("brand").agg(F.min("brand_ord").cast("long").alias("ord")).select(
        F.lit("make").alias("list"), "ord", F.col("brand").alias("name")
    )
    models = brand_models.filter(F.col("model").isNotNull())
    place = F.col("brand_ord").cast("long") * 1_000_000 + F.col("model_ord")
    per_brand = models.select(
        F.concat(F.lit("model:"), "brand").alias("list"), place.alias("ord"),
        F.col("model").alias("name"),
    )
    every = models.select(
        F.lit(f"model:{ANY_MAKE}").alias("list"), place.alias("ord"), F.col("model").alias("name")
    )
    if model_aliases is None:
        model_aliases = spark.createDataFrame([], "key string, canonical string")
    return Vocabulary(
        fields.unionByName(makes).unionByName(per_brand).unionByName(every),
        builtin_aliases(spark),
        model_aliases,
    )


def read_vocabulary(
    spark: SparkSession,
    vocab_path: str,
    brand_model_paths: str | Sequence[str],
    alias_path: str | None = None,
) -> Vocabulary:
    aliases = load_aliases(spark, alias_path) if alias_path else None
    return build_vocabulary(
        spark, load_vocab(spark, vocab_path), load_brand_models(spark, brand_model_paths), aliases
    )
