"""From raw documents to packed training sequences, in stages that each read what the last one wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.llm import exact_dedup, language, mixing, near_dedup, packing
from adloom.session import durable

# Target weights of sources; those not named have a share of 1.
SHARES = {"src0": 4, "src1": 2, "src2": 2}
# Per cent of shared word shingles from which documents are near copies, and bands that find such pairs.
SIMILAR, BANDS = 80, 42


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that could be told; null texts and those without any letter go."""
    rows = docs.select(F.struct("*").alias("document"))
    judged = language.predict_languages(rows, language.learn_prototypes(docs), "document", within="document")
    return judged.where(F.col("lang_pred") != language.UNKNOWN).select("document.*")


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest id."""
    return exact_dedup.drop_copies(docs, exact_dedup.DigestIndex(spark))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id."""
    return near_dedup.drop_near_copies(docs, SIMILAR, bands=BANDS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, stored in the order in which the sources' target weights interleave them."""
    return mixing.mix(docs, SHARES)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, in the order in which the documents are stored."""
    pieces = packing.pack(docs)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("language", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack),
]

# Token ids and learned prototypes have no SQL form; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
