"""JN-1 to JN-3, WIN-1/2/3/6, FLT-1/2/6/8: what is new in a feed."""

from __future__ import annotations

from pyspark.sql import functions as F

from adloom.operators import incremental as I
from adloom.plans.registered.base import listing_view, on_listings, query, table
from adloom.session import durable
from adloom.sources.key_index import KeyIndex


_NEW_SQL = (
    "SELECT o_orderkey, o_custkey, o_totalprice FROM orders "
    "WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 25)"
)


@query("incremental_new", _NEW_SQL)
def _(spark, sf):
    known = table(spark, sf, "lineitem").filter("l_returnflag = 'R' AND l_quantity > 25")
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return I.keep_unseen(orders, known.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey")


@query("incremental_new_indexed", _NEW_SQL)
def _(spark, sf):
    """Known ids come from two runs; the run in question asks the index they have left."""
    known = table(spark, sf, "lineitem").filter("l_returnflag = 'R' AND l_quantity > 25").select(F.col("l_orderkey").alias("key"), "l_linenumber")
    index = KeyIndex(spark, buckets=16)
    index.append(known.filter("l_linenumber < 3"))
    index.append(known.filter("l_linenumber >= 3"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return I.keep_unseen_indexed(orders, index, "o_orderkey")


@query(
    "indexed_runs",
    """
    SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1994-01-01' THEN 1 WHEN o_orderdate < TIMESTAMP '1997-01-01' THEN 2 ELSE 3 END AS run FROM orders
    """,
)
def _(spark, sf):
    """Three runs over a growing feed, each of which appends what it has found to be new."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    index, runs = KeyIndex(spark, buckets=16), []
    for run, end in enumerate(("1994-01-01", "1997-01-01", "2100-01-01"), 1):
        new = durable(I.keep_unseen_indexed(orders.filter(F.col("o_orderdate") < end), index, "o_orderkey"))
        index.append(new.select(F.col("o_orderkey").alias("key")))
        runs.append(new.select("o_orderkey", F.lit(run).alias("run")))
    return runs[0].union(runs[1]).union(runs[2])


_EITHER_SQL = """
    WITH known AS (SELECT concat('s_', CAST(c_custkey AS VARCHAR)) AS id FROM customer WHERE c_mktsegment = 'BUILDING')
    SELECT concat('s_', CAST(o_orderkey AS VARCHAR)) AS source_id, concat('s_', CAST(o_custkey AS VARCHAR)) AS source_slug
    FROM orders
    WHERE concat('s_', CAST(o_orderkey AS VARCHAR)) NOT IN (SELECT id FROM known)
      AND concat('s_', CAST(o_custkey AS VARCHAR)) NOT IN (SELECT id FROM known)
"""


def _either_key(spark, sf):
    known = table(spark, sf, "customer").filter("c_mktsegment = 'BUILDING'")
    known = known.select(F.concat(F.lit("s_"), F.col("c_custkey").cast("string")).alias("id"))
    orders = table(spark, sf, "orders").select(
        F.concat(F.lit("s_"), F.col("o_orderkey").cast("string")).alias("source_id"),
        F.concat(F.lit("s_"), F.col("o_custkey").cast("string")).alias("source_slug"),
    )
    return orders, known


@query("either_key_new", _EITHER_SQL)
def _(spark, sf):
    orders, known = _either_key(spark, sf)
    return I.keep_unseen_either(orders, known, ["source_id", "source_slug"])


@query("either_key_new_indexed", _EITHER_SQL)
def _(spark, sf):
    orders, known = _either_key(spark, sf)
    index = KeyIndex(spark, buckets=16)
    index.append(known.withColumnRenamed("id", "key"))
    return I.keep_unseen_either_indexed(orders, index, ["source_id", "source_slug"])


_DUPLICATES_SQL = """
    WITH existing AS (SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS title, CAST(p_size AS VARCHAR) AS price
                      FROM part WHERE p_type = 'ECONOMY'),
         fresh AS (SELECT CAST(l_partkey AS VARCHAR) AS id, p_name AS title, CAST(CAST(l_quantity AS INT) AS VARCHAR) AS price
                   FROM lineitem JOIN part ON l_partkey = p_partkey)
    SELECT id, upper(concat(' ', title, ' ')) AS title, price,
           (id IN (SELECT id FROM existing)) OR EXISTS (
             SELECT 1 FROM existing e WHERE e.title = fresh.title AND e.price = fresh.price) AS is_duplicate
    FROM fresh
"""


def _fresh_and_existing(spark, sf):
    part = table(spark, sf, "part")
    existing = part.filter("p_type = 'ECONOMY'").select(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("title"),
        F.col("p_size").cast("string").alias("price"),
    )
    fresh = table(spark, sf, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_partkey").cast("string").alias("id"),
        F.upper(F.concat(F.lit(" "), "p_name", F.lit(" "))).alias("title"),
        F.col("l_quantity").cast("int").cast("string").alias("price"),
    )
    return fresh, existing


@query("duplicate_split", _DUPLICATES_SQL)
def _(spark, sf):
    fresh, existing = _fresh_and_existing(spark, sf)
    return I.mark_duplicates(fresh, existing)


@query("duplicate_split_indexed", _DUPLICATES_SQL)
def _(spark, sf):
    """The existing listings reach the index in two runs, the second of which repeats the first."""
    fresh, existing = _fresh_and_existing(spark, sf)
    index = KeyIndex(spark, buckets=16)
    I.index_listings(index, existing.filter("id < '5'"))
    I.index_listings(index, existing)
    index.compact()
    return I.mark_duplicates_indexed(fresh, index)


@query(
    "duplicate_documents",
    """
    SELECT doc_id, lang, source, text IN (SELECT text FROM documents WHERE lang = 'en') AS is_duplicate FROM
      (SELECT doc_id, lang, source, lower(trim(text)) AS folded, text FROM documents)
    """,
)
def _(spark, sf):
    documents = table(spark, sf, "documents")
    existing = documents.filter("lang = 'en'").select("text")
    marked = I.mark_duplicates(
        documents.select("doc_id", "lang", "source", "text"), existing, key=None, fields=["text"]
    )
    return marked.drop("text")


@query(
    "first_seen_events",
    """
    SELECT event_id, user_id, event_type, value FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events)
    WHERE rn = 1
    """,
)
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return I.first_by_key(events, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query(
    "first_seen_documents",
    "SELECT min(doc_id) AS doc_id, length(text) AS n FROM documents GROUP BY text",
)
def _(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text")
    firsts = I.first_by_key(documents, ["text"], ["doc_id"])
    return firsts.select("doc_id", F.length("text").cast("bigint").alias("n"))


@query(
    "last_wins_lookup",
    """
    SELECT user_id, event_type FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1
    """,
)
def _(spark, sf):
    return I.last_by_key(table(spark, sf, "events"), ["user_id"], "event_type", "event_id")


_PAGED = """
paged AS (SELECT *, event_id // 5 AS page, event_type = 'purchase' AS is_new FROM events),
pages AS (SELECT page, max(CAST(is_new AS INT)) AS fresh FROM paged GROUP BY page),
runs AS (SELECT page, fresh, count(*) FILTER (WHERE fresh = 0) OVER
           (ORDER BY page ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS stale FROM pages),
stop AS (SELECT min(page) AS page FROM runs WHERE fresh = 0 AND stale = 3)
"""


@query(
    "caught_up_cutoff",
    f"WITH {_PAGED} SELECT event_id, page, is_new FROM paged "
    "WHERE (SELECT page FROM stop) IS NULL OR page <= (SELECT page FROM stop)",
)
def _(spark, sf):
    events = table(spark, sf, "events")
    paged = events.select(
        "event_id", F.expr("event_id div 5").alias("page"),
        (F.col("event_type") == "purchase").alias("is_new"),
    )
    return I.caught_up_cutoff(paged, 3)


@query(
    "caught_up_by_feed",
    """
    WITH paged AS (SELECT l_linenumber AS feed, l_orderkey // 4 AS page, l_orderkey, l_partkey,
                          l_quantity > 40 AS is_new FROM lineitem),
    pages AS (SELECT feed, page, max(CAST(is_new AS INT)) AS fresh FROM paged GROUP BY ALL),
    runs AS (SELECT feed, page, fresh, count(*) FILTER (WHERE fresh = 0) OVER
               (PARTITION BY feed ORDER BY page ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS stale FROM pages),
    stop AS (SELECT feed, min(page) AS last FROM runs WHERE fresh = 0 AND stale = 2 GROUP BY feed)
    SELECT feed, page, l_orderkey, l_partkey FROM paged LEFT JOIN stop USING (feed) WHERE last IS NULL OR page <= last
    """,
)
def _(spark, sf):
    paged = table(spark, sf, "lineitem").select(
        F.col("l_linenumber").alias("feed"), F.expr("l_orderkey div 4").alias("page"),
        "l_orderkey", "l_partkey", (F.col("l_quantity") > 40).alias("is_new"),
    )
    return I.caught_up_cutoff(paged, 2, feed=["feed"]).drop("is_new")


@query(
    "caught_up_rejected",
    """
    WITH paged AS (SELECT event_id, event_id // 5 AS page, event_type = 'purchase' AS is_new, value > 15 AS kept FROM events),
    pages AS (SELECT page, max(CAST(is_new AS INT)) AS fresh, max(CAST(is_new AND kept AS INT)) AS good FROM paged GROUP BY page),
    runs AS (SELECT page, fresh,
               lag(fresh) OVER w AS f1, lag(fresh, 2) OVER w AS f2, lag(good, 2) OVER w AS g2
             FROM pages WINDOW w AS (ORDER BY page)),
    stop AS (SELECT min(page) AS page FROM runs WHERE fresh = 0 AND f1 = 0 AND (f2 = 0 OR (f2 = 1 AND g2 = 0)))
    SELECT event_id, page, is_new, kept FROM paged WHERE (SELECT page FROM stop) IS NULL OR page <= (SELECT page FROM stop)
    """,
)
def _(spark, sf):
    paged = table(spark, sf, "events").select(
        "event_id", F.expr("event_id div 5").alias("page"),
        (F.col("event_type") == "purchase").alias("is_new"), (F.col("value") > 15).alias("kept"),
    )
    return I.caught_up_cutoff(paged, 3, kept="kept")


@query(
    "boundary_stop",
    """
    SELECT event_type, event_id FROM (
      SELECT event_type, event_id, bool_or(ts < TIMESTAMP '2024-01-20') OVER
        (PARTITION BY event_type ORDER BY event_id DESC) AS past FROM events) WHERE NOT past
    """,
)
def _(spark, sf):
    events = table(spark, sf, "events").select(
        "event_type", "event_id", (-F.col("event_id")).alias("seq"),
        F.col("ts").cast("date").alias("date_added"),
    )
    return I.boundary_stop(events, "2024-01-20", "seq", ["event_type"]).select("event_type", "event_id")


@query(
    "pages_before_cutoff",
    """
    SELECT o_orderkey // 3 AS page, bool_and(CAST(o_orderdate AS DATE) < DATE '1999-01-01') AS all_before
    FROM orders GROUP BY 1
    """,
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.expr("o_orderkey div 3").alias("page"), F.col("o_orderdate").cast("date").alias("date_added")
    )
    return I.pages_before_cutoff(orders, "1999-01-01")


@query(
    "cutoff_pages",
    """
    WITH paged AS (SELECT o_orderkey, o_orderpriority AS feed, o_orderkey // 10 AS page,
                          CAST(o_orderdate AS DATE) AS date_added FROM orders),
    stop AS (SELECT feed, min(page) AS last FROM (
               SELECT feed, page FROM paged GROUP BY feed, page HAVING bool_and(date_added < DATE '1997-01-01')) GROUP BY feed)
    SELECT o_orderkey, feed, page, date_added FROM paged LEFT JOIN stop USING (feed) WHERE last IS NULL OR page < last
    """,
)
def _(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderpriority").alias("feed"),
        F.expr("o_orderkey div 10").alias("page"), F.col("o_orderdate").cast("date").alias("date_added"),
    )
    return I.cutoff_pages(orders, "1997-01-01", ["feed"])


@query(
    "date_range",
    on_listings("SELECT id, date_added FROM listing WHERE date_added BETWEEN DATE '1996-03-01' AND DATE '1997-06-30'"),
)
def _(spark, sf):
    rows = I.filter_date_range(listing_view(spark, sf), "1996-03-01", "1997-06-30")
    return rows.select("id", "date_added")


@query(
    "date_range_undated",
    """
    SELECT o_orderkey, date_added FROM (
      SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS date_added FROM orders)
    WHERE date_added IS NULL OR date_added >= DATE '1998-01-01'
    """,
)
def _(spark, sf):
    dated = F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date"))
    orders = table(spark, sf, "orders").select("o_orderkey", dated.alias("date_added"))
    return I.filter_date_range(orders, start="1998-01-01")


@query(
    "min_year",
    on_listings("""SELECT id, CASE WHEN transmission = 'R' THEN 'n/a' ELSE CAST(year AS VARCHAR) END AS year
                   FROM listing WHERE transmission = 'R' OR year >= 1998"""),
)
def _(spark, sf):
    year = F.when(F.col("transmission") == "R", F.lit("n/a")).otherwise(F.col("year").cast("string"))
    rows = listing_view(spark, sf).select("id", year.alias("year"))
    return I.filter_min_year(rows, 1998)


@query(
    "usable_cards",
    "SELECT page_id, url FROM pages WHERE url <> '' AND CAST(page_id AS VARCHAR) <> ''",
)
def _(spark, sf):
    pages = table(spark, sf, "pages").select("page_id", "url", F.col("page_id").cast("string").alias("id"))
    return I.filter_usable_cards(pages, ["id", "url"]).drop("id")


@query("page_budget", "SELECT event_id, event_id // 20 AS page FROM events WHERE event_id // 20 BETWEEN 3 AND 14")
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", F.expr("event_id div 20").alias("page"))
    return I.limit_pages(events, 12, start=3)
