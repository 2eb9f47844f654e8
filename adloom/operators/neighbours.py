"""Names within one edit of each other, by their deletion neighbourhoods (JN-8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def deletion_keys(name: Column) -> Column:
    """The name itself and what is left of it without any one of its characters."""
    places = F.sequence(F.lit(1), F.greatest(F.length(name), F.lit(1)))
    cut = F.transform(places, lambda i: F.concat(F.substring(name, F.lit(1), i - 1), F.substring(name, i + 1, F.length(name))))
    return F.array_distinct(F.concat(F.array(name), cut))


def close_pairs(probes: DataFrame, candidates: DataFrame, on: list[str] | None = None) -> DataFrame:
    """Each ``probe`` with every ``candidate`` at a Levenshtein distance of 0 or 1, which is given as ``distance``.

    Two names that differ by an inserted or removed character share the shorter one, and two that differ in one
    character share what is left without it, so an equi-join on those keys loses no pair, however short the names.
    ``on`` names columns that must agree as well. Extra columns of both sides stay; nulls match nothing.
    """
    same = [*(on or []), "_key"]
    left = probes.withColumn("_key", F.explode(deletion_keys(F.col("probe"))))
    right = candidates.withColumn("_key", F.explode(deletion_keys(F.col("candidate"))))
    met = left.join(right, same).drop("_key")
    distance = F.levenshtein("probe", "candidate", 1)
    return met.withColumn("distance", distance).filter("distance >= 0").distinct()
