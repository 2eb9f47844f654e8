"""Streams over tables as a cluster has them: folders of many files, and feeds in which nothing has landed."""

import duckdb
import pytest
from test_queries import DATA, ordered

import __spark_entry__ as entry
from adloom.session import fresh_path
from adloom.streaming import feeds

STREAMS = ["stream_dedup_equals_batch", "stream_date_cutoff", "stream_running_stats"]


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
@pytest.mark.parametrize("name", STREAMS)
@pytest.mark.parametrize("rows", ["all", "none"])
def test_streams_over_tables_of_several_files(spark, name, rows):
    folder = fresh_path(spark, "tables")
    for table in ("events", "orders"):
        whole = spark.read.parquet(f"{DATA}/{table}.parquet")
        (whole if rows == "all" else whole.limit(0)).repartition(5).write.parquet(f"{folder}/{table}.parquet")
    frame = entry.queries()[name](spark, folder)
    got = [tuple(r) for r in frame.collect()]
    database = duckdb.connect()
    for table in ("events", "orders"):
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet/*.parquet')")
    answer = database.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in answer.description]
    assert ordered(frame.columns, got) == ordered(columns, answer.fetchall()) and bool(got) == (rows == "all")


def test_an_empty_feed_reads_as_an_empty_table(spark):
    schema = spark.createDataFrame([], "id string, price double").schema
    assert feeds.read_target(spark, fresh_path(spark), schema).count() == 0
    assert feeds.read_latest(spark, fresh_path(spark), schema).columns == ["id", "price"]


def test_state_falls_as_the_watermark_passes(spark):
    landed, work = fresh_path(spark, "landed"), fresh_path(spark, "stream")
    for day in range(8):
        rows = spark.range(100).selectExpr(f"id + {100 * (day // 2)} AS id", f"timestamp '2026-01-01' + make_interval(0, 0, 0, {day}) AS ts")
        rows.coalesce(1).write.mode("append").parquet(landed)
    stream = feeds.drop_seen_within(feeds.read_table_stream(spark, landed, max_files=1), "id", "ts", "1 day")
    query = feeds.run_to_table(stream, f"{work}/target", f"{work}/progress")
    state = feeds.state_rows(query)
    assert spark.read.parquet(f"{work}/target").count() == 400  # each id lands on two days
    assert max(state) <= 200 and any(b < a for a, b in zip(state, state[1:]))
    again = feeds.run_to_table(stream, f"{work}/target", f"{work}/progress")
    assert spark.read.parquet(f"{work}/target").count() == 400 and again.exception() is None


def test_a_repeated_batch_counts_once(spark):
    from adloom.operators.stats import StatisticsStore, partial_statistics

    store = StatisticsStore(spark, fresh_path(spark, "parts"))
    schema = "make string, model string, year string, price double, body_type string, fuel_type string, transmission string"
    one = spark.createDataFrame([("a", "x", "2001", 5.0, "suv", None, "N/A")], schema)
    sink = feeds.add_statistics(store, partial_statistics)
    for batch in (0, 1, 1):
        sink(one, batch)
    total = store.read().filter("dimension = 'total'").first()
    assert (total.n, total.price_sum, total.price_n, total.filled_fuel_type) == (2, 10.0, 2, 0)


def test_a_time_limit_ends_a_run(spark):
    """STM-5: what the limit leaves over is read by the next run."""
    import time

    landed, work = fresh_path(spark, "landed"), fresh_path(spark, "stream")
    for part in range(6):
        spark.range(part * 10, part * 10 + 10).selectExpr("cast(id AS string) AS id").coalesce(1).write.mode("append").json(landed)
    stream = feeds.read_listing_stream(spark, landed, "id string", max_files=1)
    sink = feeds.append_unseen(f"{work}/target", buckets=2)

    def slow(batch, batch_id):
        sink(batch, batch_id)
        time.sleep(2)

    feeds.run_available(stream, slow, f"{work}/progress", timeout_seconds=5)
    assert feeds.read_target(spark, f"{work}/target", stream.schema).count() < 60
    feeds.run_available(stream, sink, f"{work}/progress")
    assert feeds.read_target(spark, f"{work}/target").count() == 60
