"""A whole incremental batch over the listing view."""

from __future__ import annotations

from pyspark.sql import functions as F

from adloom.operators.gates import mandatory_gate
from adloom.plans.ingest import incremental_run, ingest_batch
from adloom.plans.registered.base import listing_view, on_listings, query, table
from adloom.session import fresh_path


def _batch(spark, sf):
    flag = F.col("transmission")
    cards = listing_view(spark, sf).select(
        "id", "date_added", "price", "bedrooms", F.when(flag == "N", F.col("seller_name")).otherwise("-").alias("seller_name"),
    )
    known = table(spark, sf, "orders").filter("o_orderstatus = 'F'").select(
        F.explode(F.transform(F.sequence(F.lit(0), F.lit(2)), lambda n: F.concat(F.lit("src"), n.cast("string")))).alias("s"), "o_orderkey"
    )
    lines = table(spark, sf, "lineitem").select(
        F.concat(F.lit("src"), (F.col("l_suppkey") % 3).cast("string")).alias("s"), F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_linenumber"
    )
    known = known.join(lines, ["s", "o_orderkey"]).select(F.concat_ws("_", "s", "o_orderkey", "l_partkey", "l_linenumber").alias("id"))
    details = listing_view(spark, sf).filter("year < 2000").groupBy("id").agg(F.min("city").alias("city"), F.min("model").alias("model"))
    return ingest_batch(
        cards, known, details, start="1996-01-01", order=["date_added", "price"],
        gate=lambda rows: mandatory_gate(rows, ["city", "model", "seller_name"]),
    )


_SQL = """
, known AS (SELECT DISTINCT concat_ws('_', concat('src', CAST(l_suppkey % 3 AS VARCHAR)), CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS id
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderstatus = 'F'),
firsts AS (SELECT id, min((date_added, price, bedrooms, CASE WHEN transmission = 'N' THEN seller_name ELSE '-' END)) AS r
           FROM listing WHERE date_added >= DATE '1996-01-01' AND id NOT IN (SELECT id FROM known) GROUP BY id),
detail AS (SELECT id, min(city) AS city, min(model) AS model FROM listing WHERE year < 2000 GROUP BY id),
fresh AS (SELECT id, r[1] AS date_added, r[2] AS price, r[3] AS bedrooms, r[4] AS seller_name, city, model FROM firsts LEFT JOIN detail USING (id))
"""


@query(
    "ingest_accepted",
    on_listings(f"{_SQL} SELECT id, date_added, price, bedrooms, seller_name, city, model FROM fresh WHERE seller_name <> '-' AND city IS NOT NULL"),
)
def _(spark, sf):
    return _batch(spark, sf).accepted


@query(
    "ingest_rejected",
    on_listings(f"""{_SQL} SELECT id, concat_ws(',', CASE WHEN city IS NULL THEN 'city' END, CASE WHEN model IS NULL THEN 'model' END,
                                     CASE WHEN seller_name = '-' THEN 'seller_name' END) AS reasons
                  FROM fresh WHERE seller_name = '-' OR city IS NULL"""),
)
def _(spark, sf):
    return _batch(spark, sf).rejected.select("id", F.array_join("reasons", ",").alias("reasons"))


_RUN_SQL = """
WITH cards AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, o_custkey % 3 AS feed, o_orderkey // 20 AS page, o_orderpriority AS seller_name,
                      CASE WHEN o_totalprice < 50000 THEN NULL ELSE o_orderstatus END AS model FROM orders),
known AS (SELECT CAST(l_orderkey AS VARCHAR) AS id FROM lineitem WHERE l_quantity > 12),
flagged AS (SELECT *, id NOT IN (SELECT id FROM known) AS is_new FROM cards),
pages AS (SELECT feed, page, max(CAST(is_new AS INT)) AS fresh FROM flagged GROUP BY ALL),
runs AS (SELECT *, count(*) FILTER (WHERE fresh = 0) OVER (PARTITION BY feed ORDER BY page ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS stale FROM pages),
stop AS (SELECT feed, min(page) AS last FROM runs WHERE fresh = 0 AND stale = 2 GROUP BY feed),
seen AS (SELECT flagged.* FROM flagged LEFT JOIN stop USING (feed) WHERE last IS NULL OR page <= last)
"""


def _run(spark, sf):
    orders = table(spark, sf, "orders")
    cards = orders.select(
        F.col("o_orderkey").cast("string").alias("id"), (F.col("o_custkey") % 3).alias("feed"), F.expr("o_orderkey div 20").alias("page"),
        F.col("o_orderpriority").alias("seller_name"), F.when(F.col("o_totalprice") >= 50000, F.col("o_orderstatus")).alias("model"),
    )
    known = table(spark, sf, "lineitem").filter("l_quantity > 12").select(F.col("l_orderkey").cast("string").alias("id"))
    return incremental_run(cards, known, patience=2, feed=["feed"], gate=lambda rows: mandatory_gate(rows, ["model", "seller_name"]))


@query(
    "incremental_run_rows",
    f"{_RUN_SQL} SELECT id, feed, page, model FROM seen WHERE is_new AND model IS NOT NULL",
)
def _(spark, sf):
    run, target, ledger = _run(spark, sf), fresh_path(spark, "target"), fresh_path(spark, "ledger")
    run.save(target, ledger, None, "site")
    return spark.read.schema("id string, feed bigint, page bigint, model string").json(target)


@query(
    "incremental_run_counters",
    f"""{_RUN_SQL} SELECT count(*) AS seen, count(*) FILTER (WHERE is_new) AS new, count(*) FILTER (WHERE NOT is_new) AS duplicate,
        count(*) FILTER (WHERE is_new AND model IS NOT NULL) AS saved, count(*) FILTER (WHERE is_new AND model IS NULL) AS rejected FROM seen""",
)
def _(spark, sf):
    return _run(spark, sf).counters
