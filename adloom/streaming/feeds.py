"""Landed feeds as streams (STM-1 to STM-7).

Every sink is idempotent by key, so a batch that is repeated after a failure changes nothing: progress
is the checkpoint of the query, kept next to the target in shared storage.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from adloom.functions import fixed_values as V
from adloom.operators.incremental import filter_date_range, first_by_key, keep_unseen
from adloom.operators.resolve import new_unknown_values, resolve
from adloom.operators.stats import StatisticsStore, make_of, partial_statistics
from adloom.sources.envelope import explode_items
from adloom.sources.vocabulary import Vocabulary


# --- reading -----------------------------------------------------------------------------------------
def read_listing_stream(
    spark: SparkSession, path: str, schema: str, max_files: int = 1000
) -> DataFrame:
    """STM-1: new JSON-lines files as they land."""
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(path)
    )


def read_table_stream(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """STM-1: a Parquet table as a stream, whether it is a folder of many files or one file.

    The schema is the table's own. A file source follows folders only, so of a single file it follows the
    folder, narrowed to that name.
    """
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", max_files)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(place).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", place.getName()).parquet(place.getParent().toString())


def read_payload_stream(
    spark: SparkSession, path: str, keys: Sequence[str] = V.ENVELOPE_KEYS, max_files: int = 1000
) -> DataFrame:
    """STM-1: items of landed response files (SRC-1) as they land."""
    files = spark.readStream.option("maxFilesPerTrigger", max_files).text(path, wholetext=True)
    return explode_items(files.select(F.col("value").alias("body")), "body", keys)


def drop_seen_within(stream: DataFrame, key: str, event_time: str, delay: str) -> DataFrame:
    """STM-3/STM-4: first row per key, with state bounded by a watermark on the event time.

    Rows no later than the watermark, the greatest event time of the batches before less ``delay``, are dropped. A
    key is forgotten once the watermark has passed its first row by ``delay``, so the state holds the keys of a
    stretch of time, however long the stream runs.
    """
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark([key])


def run_to_table(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """STM-1/STM-2: append what has landed to a table by Spark's own file sink, which commits a batch once.

    For streams whose state is event-time bound, such as :func:`drop_seen_within`: state and target go by one
    checkpoint, and no batch reads the target.
    """
    query = (
        stream.writeStream.outputMode("append").format("parquet").option("path", target)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def state_rows(query: StreamingQuery) -> list[int]:
    """Rows in the state of each batch of a run, over all its stateful operators."""
    return [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in query.recentProgress]


def running_stats(stream: DataFrame) -> DataFrame:
    """STM-7: listings, average and extreme prices per make, kept up to date."""
    return stream.groupBy(make_of(stream).alias("make")).agg(
        F.count("*").alias("listings"), F.avg("price").alias("avg_price"),
        F.min("price").alias("min_price"), F.max("price").alias("max_price"),
    )


# --- writing -----------------------------------------------------------------------------------------
def _read_or_none(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in str(missing) or "UNABLE_TO_INFER_SCHEMA" in str(missing):
            return None
        raise


BUCKET = "key_bucket"


def read_target(spark: SparkSession, target: str, schema: T.StructType | None = None) -> DataFrame:
    """The rows that :func:`append_unseen` has written; with ``schema`` none where it has written nothing."""
    rows = _read_or_none(spark, target) if schema is not None else spark.read.parquet(target)
    return spark.createDataFrame([], schema) if rows is None else rows.drop(BUCKET)


def append_unseen(
    target: str,
    key: str = "id",
    order: Sequence[str] = (),
    transform: Callable[[DataFrame], DataFrame] | None = None,
    start=None,
    end=None,
    buckets: int = 64,
) -> Callable[[DataFrame, int], None]:
    """STM-2/STM-3: ``foreachBatch`` sink that appends rows whose key the target does not hold.

    The target itself is the unbounded state. It is partitioned by a hash of the key, and a batch reads
    only the ``buckets`` its keys fall into. A batch is reduced to one row per key. With ``start``/``end``
    old and late listings are dropped by date (STM-4).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = transform(batch) if transform else batch
        if start is not None or end is not None:
            rows = filter_date_range(rows, start, end)
        rows = rows.filter(F.col(key).isNotNull()).withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))
        known = _read_or_none(spark, target)
        if known is not None:
            met = [r[BUCKET] for r in rows.select(BUCKET).distinct().collect()]  # at most ``buckets``
            rows = keep_unseen(rows, known.filter(F.col(BUCKET).isin(met)), key)
        rows = first_by_key(rows, [key], list(order))
        rows.write.mode("append").partitionBy(BUCKET).parquet(target)

    return write


def add_statistics(store: StatisticsStore, transform: Callable[[DataFrame], DataFrame] = partial_statistics) -> Callable[[DataFrame, int], None]:
    """STM-7: ``foreachBatch`` sink that adds a batch's parts of the statistics; no batch is read twice, and a
    repeated one takes the place of its earlier self."""

    def write(batch: DataFrame, batch_id: int) -> None:
        store.add(batch_id, transform(batch))

    return write


def append_unknown_values(ledger: str, vocabulary: Vocabulary) -> Callable[[DataFrame, int], None]:
    """STM-6: ``foreachBatch`` sink that adds unmatched values the ledger does not hold yet."""

    def write(batch: DataFrame, batch_id: int) -> None:
        found = resolve(batch, vocabulary).unknown()
        known = _read_or_none(batch.sparkSession, ledger)
        if known is not None:
            found = new_unknown_values(found, known)
        found.write.mode("append").parquet(ledger)

    return write


def run_available(
    stream: DataFrame,
    sink: Callable[[DataFrame, int], None],
    checkpoint: str,
    timeout_seconds: float | None = None,
) -> StreamingQuery:
    """STM-1/STM-2/STM-5: process what has landed, then stop; stop early at the time limit.

    A later call with the same checkpoint resumes behind the last finished batch.
    """
    query = (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    if timeout_seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_seconds):
        query.stop()
    return query


def replace_with_latest(target: str) -> Callable[[DataFrame, int], None]:
    """Sink for complete-mode results such as :func:`running_stats`: a folder per batch, which counts once it
    is complete, so that readers never meet a target that is half replaced."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return write


def read_latest(spark: SparkSession, target: str, schema: T.StructType | None = None) -> DataFrame:
    """The result of the last batch that :func:`replace_with_latest` has finished; with ``schema`` no rows
    where none has finished."""
    every = _read_or_none(spark, target) if schema is not None else spark.read.parquet(target)
    if every is None:
        return spark.createDataFrame([], schema)
    last = every.agg(F.max("batch")).first()[0]
    return every.filter(F.col("batch") == last).drop("batch")


def run_complete(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """STM-7: keep ``target`` equal to the aggregate over everything that has landed."""
    query = (
        stream.writeStream.outputMode("complete")
        .foreachBatch(replace_with_latest(target))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
