"""Exact dedup against a persistent digest index.

The index is a table with one row per distinct text, bucketed and sorted by digest. A batch is first
reduced to one row per digest (partial aggregation, so a group of copies of any size costs one row per
task), then a sort-merge anti-join with the index leaves the digests that are new, and those are appended.
Both sides of that join hold each digest once, so no key of it is hot; the index side is read by bucket
without a shuffle. Documents get their verdict by an ordinary equi-join on the digest, whose hot keys
adaptive execution splits.

Defined results: null text counts as empty; texts are equal when identical. In a batch the row with the
largest ``doc_id`` of a group stays (a null id is smaller than any), one row only if that id repeats.
A text that the index held before stays with the document recorded there. Empty batches append nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.llm.common import text_of
from adloom.session import durable, fresh_path

BUCKETS = 64


class DigestIndex:
    """Digests seen so far, at a path of shared storage.

    ``path`` reopens an index, in this or a later application; without it a new one is made in the shared
    folder. ``buckets`` must stay the same for one path; take some 200 MB of digests per bucket.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = BUCKETS):
        self.spark, self.buckets = spark, buckets
        self.path = path or fresh_path(spark, "digests")
        self.table = f"digests_{uuid.uuid4().hex}"
        spark.sql(
            f"CREATE TABLE {self.table} (digest BINARY, keep_id BIGINT, group_size BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{self.path}'"
        )

    def read(self) -> DataFrame:
        return self.spark.table(self.table)

    def unseen(self, groups: DataFrame) -> DataFrame:
        """Rows of ``groups`` (unique digests) that the index lacks."""
        known = self.read().select("digest")
        return groups.join(known.hint("merge"), "digest", "left_anti")

    def append(self, groups: DataFrame) -> None:
        rows = groups.select("digest", "keep_id", "group_size")
        rows.repartition(self.buckets, "digest").sortWithinPartitions("digest").write.insertInto(self.table)


def digests(documents: DataFrame, *keep: str) -> DataFrame:
    """``doc_id``, the columns ``keep`` and ``digest``, the SHA-256 of the whole text in UTF-8."""
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    return text_of(documents, "doc_id", *keep).withColumn("digest", digest).drop("text")


def deduplicate(documents: DataFrame, index: DigestIndex) -> DataFrame:
    """Judge a batch against itself and ``index``, and add what is new.

    One row per document: ``doc_id, digest, keep_id, group_size, kept``. ``group_size`` counts the rows of
    this batch; ``keep_id`` of a text known before is the document the index recorded, and no row is kept.
    """
    rows = durable(digests(documents).withColumn("row", F.monotonically_increasing_id()))
    groups = durable(
        rows.groupBy("digest").agg(
            F.max("doc_id").alias("keep_id"),
            F.coalesce(F.max_by("row", "doc_id"), F.max("row")).alias("keep_row"),
            F.count("*").alias("group_size"),
        )
    )
    fresh = durable(index.unseen(groups))
    known = (
        groups.join(fresh.select("digest"), "digest", "left_anti")
        .join(index.read().select("digest", F.col("keep_id").alias("known_id")).hint("merge"), "digest")
        .select("digest", F.col("known_id").alias("keep_id"), F.lit(-1).cast("bigint").alias("keep_row"), "group_size")
    )
    verdicts = durable(fresh.select("digest", "keep_id", "keep_row", "group_size").unionByName(known))
    index.append(fresh)
    return rows.join(verdicts, "digest").select(
        "doc_id", "digest", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept")
    )


def drop_copies(documents: DataFrame, index: DigestIndex) -> DataFrame:
    """The rows of ``documents`` that stay, all columns as they were.

    Rows are told apart by id and digest. Copies under other ids leave by an anti-join; rows that repeat
    both are reduced to one.
    """
    verdict = durable(deduplicate(documents, index))
    dropped = verdict.where(~F.col("kept")).select("doc_id", "digest")
    stays = verdict.where("kept").select("doc_id", "digest")
    gone = durable(dropped.distinct())
    repeated = durable(stays.join(gone, _same(stays, gone), "left_semi"))
    digest = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256))
    rows = documents.select("doc_id", digest.alias("digest"), F.struct("*").alias("document"))
    # merge joins at every size: what is dropped grows with the documents
    gone_, repeated_ = gone.hint("merge"), repeated.hint("merge")
    once = rows.join(gone_, _same(rows, gone_), "left_anti")
    one = rows.join(repeated_, _same(rows, repeated_), "left_semi").dropDuplicates(["doc_id", "digest"])
    return once.unionByName(one).select("document.*")


def _same(left: DataFrame, right: DataFrame):
    return left["digest"].eqNullSafe(right["digest"]) & left["doc_id"].eqNullSafe(right["doc_id"])
