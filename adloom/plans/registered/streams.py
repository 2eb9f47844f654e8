"""STM-*: the tables as streams. Each query runs its stream to the end and returns what it wrote."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from adloom.operators.stats import StatisticsStore, market_sections
from adloom.plans.registered.base import listing_view, query, table
from adloom.plans.registered.statistics import AS_OF, CARS_SQL
from adloom.session import durable, fresh_path, shared_folder
from adloom.streaming import feeds


def _stream(spark, sf, name):
    return feeds.read_table_stream(spark, f"{sf}/{name}.parquet")


def _work(spark, name):
    """A fresh folder below the cluster's shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query(
    "stream_dedup_equals_batch",
    """
    SELECT user_id, event_type, min(event_id) AS event_id, arg_min(value, event_id) AS value FROM events GROUP BY ALL
    """,
)
def _(spark, sf):
    work = _work(spark, "dedup")
    keyed = _stream(spark, sf, "events").select(
        F.concat_ws("/", "user_id", "event_type").alias("id"), "event_id", "user_id", "event_type", "value"
    )
    sink = feeds.append_unseen(f"{work}/target", order=["event_id"])
    for _ in range(2):  # the second run finds nothing new and must change nothing
        feeds.run_available(keyed, sink, f"{work}/progress")
    return feeds.read_target(spark, f"{work}/target", keyed.schema).drop("id")


@query(
    "stream_date_cutoff",
    "SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS date_added FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '1997-01-01'",
)
def _(spark, sf):
    work = _work(spark, "cutoff")
    rows = _stream(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("date").alias("date_added")
    )
    feeds.run_available(rows, feeds.append_unseen(f"{work}/target", start="1997-01-01"), f"{work}/progress")
    return feeds.read_target(spark, f"{work}/target", rows.schema)


@query(
    "stream_running_stats",
    """
    SELECT event_type AS make, count(*) AS listings, round(avg(value), 6) AS avg_price, min(value) AS min_price, max(value) AS max_price
    FROM events GROUP BY event_type
    """,
)
def _(spark, sf):
    work = _work(spark, "stats")
    rows = _stream(spark, sf, "events").select(F.col("event_type").alias("make"), F.col("value").alias("price"))
    stats = feeds.running_stats(rows)
    feeds.run_complete(stats, f"{work}/target", f"{work}/progress")
    return feeds.read_latest(spark, f"{work}/target", stats.schema).withColumn("avg_price", F.round("avg_price", 6))


_FILES = 6


def _landed(spark, sf, folder):
    """Events as six stretches of time that land one after the other, with repeated and late rows.

    A fifth of the rows come again in the next file, an hour younger; one in seven lands two files late, and
    one in seven three files late. Gives the stretch in seconds.
    """
    events = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    first, last = events.agg(F.min(F.unix_seconds("ts")), F.max(F.unix_seconds("ts"))).first()
    stretch = (last - first) // _FILES + 1
    own = ((F.unix_seconds("ts") - first) / stretch).cast("int")
    seven = F.col("event_id") % 7
    rows = events.withColumn("file", own + F.when(seven == 3, 2).when(seven == 4, 3).otherwise(0))
    again = events.filter((F.col("event_id") % 5 == 0) & ~seven.isin(3, 4)).select("event_id", F.expr("ts + INTERVAL 1 HOUR").alias("ts"), (own + 1).alias("file"))
    every = durable(rows.unionByName(again))
    for file in range(_FILES + 3):
        every.filter(F.col("file") == file).drop("file").coalesce(1).write.mode("append").parquet(folder)
    return stretch


@query(
    "stream_dedup_event_time",
    f"""
    WITH bounds AS (SELECT CAST(epoch(date_trunc('second', min(ts))) AS BIGINT) AS first, (CAST(epoch(date_trunc('second', max(ts))) AS BIGINT) - CAST(epoch(date_trunc('second', min(ts))) AS BIGINT)) // {_FILES} + 1 AS stretch FROM events),
    own AS (SELECT event_id, epoch_us(ts) AS us, (CAST(epoch(date_trunc('second', ts)) AS BIGINT) - first) // stretch AS file, stretch FROM events, bounds),
    landed AS (
      SELECT event_id, us, file + CASE event_id % 7 WHEN 3 THEN 2 WHEN 4 THEN 3 ELSE 0 END AS file, stretch FROM own
      UNION ALL SELECT event_id, us + 3600000000, file + 1, stretch FROM own WHERE event_id % 5 = 0 AND event_id % 7 NOT IN (3, 4)
    ), marks AS (
      SELECT file, lag(seen, 2) OVER (ORDER BY file) // 1000 - 1000 * stretch AS mark
      FROM (SELECT file, max(max(us)) OVER (ORDER BY file) AS seen, any_value(stretch) AS stretch FROM landed GROUP BY file)
    )
    SELECT event_id, min(us) AS us FROM landed JOIN marks USING (file) WHERE mark IS NULL OR us > 1000 * mark GROUP BY event_id
    """,
)
def _(spark, sf):
    """STM-3/STM-4: state bound by a watermark of one stretch, over files that land one by one. Spark judges lateness
    by the watermark that the batch before has run with."""
    landed, work = fresh_path(spark, "landed"), _work(spark, "timed")
    delay = f"{_landed(spark, sf, landed)} seconds"
    stream = feeds.drop_seen_within(feeds.read_table_stream(spark, landed, max_files=1), "event_id", "ts", delay)
    feeds.run_to_table(stream, f"{work}/target", f"{work}/progress")
    return spark.read.parquet(f"{work}/target").select("event_id", F.unix_micros("ts").alias("us"))


def _files_for(rows: int) -> int:
    """Files of a landed feed, an even number: four, or more so that none has above some 250,000 rows."""
    return max(4, 2 * -(-rows // 500_000))


@query("stream_statistics_merged", CARS_SQL)
def _(spark, sf):
    """STM-7: a feed of listings in several files; each batch adds its parts, and the whole is never scanned."""
    landed, work = fresh_path(spark, "landed"), _work(spark, "merged")
    files = _files_for(table(spark, sf, "lineitem").count())
    listing_view(spark, sf).repartition(files).write.parquet(landed)
    store = StatisticsStore(spark, f"{work}/parts")
    feeds.run_available(feeds.read_table_stream(spark, landed, max_files=files // 2), feeds.add_statistics(store), f"{work}/progress")
    return market_sections(durable(store.read()), as_of=F.lit(AS_OF)).withColumn("value", F.round("value", 4))
