"""A persistent index of known keys (JN-1 to JN-3, SET-4), so that a run does not read the target itself.

The index is a table of keys and their hashes, bucketed and sorted by hash, and grows by what each run adds. A run
reduces its own keys to distinct ones first, so a key with a third of the rows costs a row per task, and only
those are shuffled, into the buckets of the index. The index is read bucket by bucket, without an exchange and,
once compacted, without a sort. What was met is written; rows then are told apart by an ordinary join with it,
which has an exchange below it on either side, so that adaptive execution splits a hot key.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.session import durable, fresh_path
from adloom.sources.versions import VersionedTable

BUCKETS = 64
_COLUMNS = ["key_hash", "key"]
_ORDERED_SCAN = "spark.sql.legacy.bucketedTableScan.outputOrdering"


class KeyIndex:
    """Keys seen so far, as texts, at a path of shared storage.

    ``path`` reopens an index, in this or a later application; without it a new one is made in the shared
    folder. ``buckets`` must stay the same for one path; some 100 million keys a bucket are fine.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = BUCKETS):
        self.spark, self.buckets = spark, buckets
        self.path = path or fresh_path(spark, "keys")
        self._store = VersionedTable(spark, self.path)
        if not self._store.version():
            self._store.replace_by(lambda folder: self._store._fs.mkdirs(self._store._hadoop.Path(folder)))

    @contextmanager
    def _table(self, folder: str | None = None) -> Iterator[str]:
        """Name under which the session knows the bucketed table in ``folder`` for a while."""
        name = f"keys_{uuid.uuid4().hex}"
        self.spark.sql(
            f"CREATE TABLE {name} (key_hash BIGINT, key STRING) USING parquet CLUSTERED BY (key_hash, key) "
            f"SORTED BY (key_hash, key) INTO {self.buckets} BUCKETS LOCATION '{folder or self._store.current()}'"
        )
        before = self.spark.conf.get(_ORDERED_SCAN)
        self.spark.conf.set(_ORDERED_SCAN, "true")
        try:
            yield name
        finally:
            self.spark.conf.set(_ORDERED_SCAN, before)
            self.spark.sql(f"DROP TABLE {name}")

    def _compared(self, keys: DataFrame, known: str, how: str) -> DataFrame:
        # written first: the optimiser would take the join below the distinct, and a hot key into one task
        own = durable(keys.select(F.col("key").cast("string").alias("key")).filter("key IS NOT NULL").distinct())
        own = own.select(F.xxhash64("key").alias("key_hash"), "key")
        return own.join(self.spark.table(known).hint("merge"), _COLUMNS, how)

    def met(self, keys: DataFrame) -> DataFrame:
        """Written table of the distinct ``key`` values of ``keys`` that the index holds; nulls are none."""
        with self._table() as known:
            return durable(self._compared(keys, known, "left_semi").select("key"))

    def append(self, keys: DataFrame) -> DataFrame:
        """Add the ``key`` values that the index lacks, and give them; a repeated call adds nothing."""
        with self._table() as known:
            new = durable(self._compared(keys, known, "left_anti"))
            new.repartition(self.buckets, *_COLUMNS).sortWithinPartitions(*_COLUMNS).write.insertInto(known)
        return new.select("key")

    def read(self) -> DataFrame:
        """All keys."""
        return self._files().select("key")

    def _files(self) -> DataFrame:
        return self.spark.read.schema("key_hash bigint, key string").parquet(self._store.current())

    def compact(self) -> None:
        """Merge what the runs have added into one sorted file per bucket, as a new version of the index."""

        def write(folder: str) -> None:
            self._store._fs.mkdirs(self._store._hadoop.Path(folder))
            # read as plain files: of a bucketed table Spark would drop the repartition, and then the buckets too
            rows = self._files().repartition(self.buckets, *_COLUMNS).sortWithinPartitions(*_COLUMNS)
            with self._table(folder) as new:
                rows.write.insertInto(new)

        self._store.replace_by(write, after=self._store.version())
