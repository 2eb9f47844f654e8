"""AGG-*: statistics over the listing view. Averages are rounded so that the order in which a sum is
formed cannot show."""

from __future__ import annotations

from pyspark.sql import functions as F

from adloom.operators import stats as S
from adloom.plans.registered.base import listing_view, on_listings, query, table
from adloom.session import durable, fresh_path


@query("listing_view", on_listings("SELECT * FROM listing"))
def _(spark, sf):
    return listing_view(spark, sf)


@query("total_items", on_listings("SELECT count(*) AS total_items, DATE '2002-01-01' AS scraped_at FROM listing"))
def _(spark, sf):
    return S.total_items(listing_view(spark, sf), F.lit("2002-01-01").cast("date"))


_FIELDS = ["id", "source", "make", "model", "year", "body_type", "fuel_type", "transmission", "city",
           "price", "size", "bedrooms", "date_added", "seller_name"]
_TEXT = {"id", "source", "make", "model", "body_type", "fuel_type", "transmission", "city", "seller_name"}


def _filled(name: str) -> str:
    if name in _TEXT:
        return f"{name} <> '' AND {name} <> 'N/A'"
    return f"{name} IS NOT NULL" if name == "date_added" else f"{name} <> 0"


@query(
    "field_population",
    on_listings(
        " UNION ALL ".join(
            f"SELECT '{f}' AS field, count(*) FILTER (WHERE {_filled(f)}) AS populated FROM listing"
            for f in _FIELDS
        )
    ),
)
def _(spark, sf):
    return S.field_population(listing_view(spark, sf))


@query(
    "top_makes",
    on_listings("SELECT make AS name, count(*) AS count FROM listing WHERE make <> '' "
                "GROUP BY make ORDER BY count DESC, name LIMIT 5"),
)
def _(spark, sf):
    return S.top_makes(listing_view(spark, sf))


@query(
    "year_stats",
    on_listings("SELECT round(avg(year), 6) AS avg_year, min(year) AS min_year, max(year) AS max_year FROM listing"),
)
def _(spark, sf):
    found = S.year_stats(listing_view(spark, sf))
    return found.withColumn("avg_year", F.round("avg_year", 6))


@query(
    "price_stats",
    on_listings("SELECT round(avg(price), 4) AS avg_price, min(price) AS min_price, max(price) AS max_price "
                "FROM listing WHERE price <> 0"),
)
def _(spark, sf):
    found = S.price_stats(listing_view(spark, sf))
    return found.withColumn("avg_price", F.round("avg_price", 4))


@query(
    "price_stats_text",
    on_listings("""
      SELECT round(avg(v), 4) AS avg_price, min(v) AS min_price, max(v) AS max_price
      FROM (SELECT CAST(floor(price) AS DOUBLE) AS v FROM listing) WHERE v <> 0"""),
)
def _(spark, sf):
    # Prices as advert text: the first number counts, decimals and words do not.
    whole = F.format_number(F.floor("price"), 0)
    text = F.concat(F.lit("السعر "), whole, F.lit(" دولار"))
    found = S.price_stats(listing_view(spark, sf).withColumn("price", text))
    return found.withColumn("avg_price", F.round("avg_price", 4))


def _distribution(name: str, column: str, missing: str | None = None, source: str | None = None) -> None:
    source = source or column
    if missing:
        value = f"coalesce(CAST({source} AS VARCHAR), '{missing}')"
        sql = f"SELECT {value} AS {column}, count(*) AS count FROM listing GROUP BY 1"
    else:
        sql = (f"SELECT CAST({source} AS VARCHAR) AS {column}, count(*) AS count FROM listing "
               f"WHERE {source} IS NOT NULL AND CAST({source} AS VARCHAR) <> 'N/A' GROUP BY 1")

    @query(name, on_listings(sql))
    def _(spark, sf):
        rows = listing_view(spark, sf)
        if source != column:
            rows = rows.withColumnRenamed(source, column)
        return S.distribution(rows, column, missing)


_distribution("body_type_distribution", "body_type")
_distribution("fuel_distribution", "fuel_type", S.UNKNOWN)
_distribution("transmission_distribution", "transmission", S.UNKNOWN)
_distribution("property_type_distribution", "property_type", S.UNKNOWN, "body_type")
_distribution("bedroom_distribution", "bedrooms")


@query(
    "top_locations",
    on_listings("SELECT city AS name, count(*) AS count FROM listing GROUP BY city ORDER BY count DESC, name LIMIT 5"),
)
def _(spark, sf):
    return S.top_locations(listing_view(spark, sf), column="city")


@query(
    "price_per_unit",
    on_listings("SELECT round(avg(price / size), 4) AS avg_price_per_sqm FROM listing WHERE size > 0 AND price <> 0"),
)
def _(spark, sf):
    return S.price_per_unit(listing_view(spark, sf)).select(
        F.round("avg_price_per_sqm", 4).alias("avg_price_per_sqm")
    )


@query(
    "make_model_combos",
    on_listings("SELECT concat(make, ' ', model) AS model, count(*) AS count FROM listing "
                "GROUP BY 1 ORDER BY count DESC, 1 LIMIT 10"),
)
def _(spark, sf):
    return S.make_model_combos(listing_view(spark, sf))


@query(
    "avg_price_by_location",
    on_listings("SELECT city AS location, round(avg(price), 4) AS avg_price FROM listing WHERE price <> 0 "
                "GROUP BY city ORDER BY avg(price) DESC, 1 LIMIT 10"),
)
def _(spark, sf):
    found = S.avg_price_by_location(listing_view(spark, sf), location="city")
    return found.withColumn("avg_price", F.round("avg_price", 4))


@query(
    "scraper_stats",
    on_listings("""
      SELECT count(*) AS total_items, count(price) AS price_count, round(avg(price), 2) AS price_average,
             min(price) AS price_min, max(price) AS price_max, count(year) AS year_count,
             CAST(floor(avg(year)) AS INT) AS year_average, min(year) AS year_min, max(year) AS year_max,
             count(*) FILTER (WHERE price <> 0 AND make <> '' AND year <> 0 AND city <> '') AS complete
      FROM listing"""),
)
def _(spark, sf):
    found = S.scraper_stats(listing_view(spark, sf))
    blocks = [
        F.col(f"{b}_stats.{m}").alias(f"{b}_{m}")
        for b in ("price", "year") for m in ("count", "average", "min", "max")
    ]
    return found.select("total_items", *blocks, F.col("items_with_complete_data").alias("complete"))


@query(
    "brand_counts",
    on_listings("SELECT make AS brand, count(*) AS count FROM listing WHERE make <> '' GROUP BY make"),
)
def _(spark, sf):
    return S.brand_counts(listing_view(spark, sf))


@query(
    "complete_records",
    on_listings("SELECT count(*) FILTER (WHERE price <> 0 AND make <> '' AND year <> 0 AND city <> '') "
                "AS items_with_complete_data FROM listing"),
)
def _(spark, sf):
    return S.complete_records(listing_view(spark, sf))


def _top(section: str, expression: str, k: int | None = None) -> str:
    tail = f" ORDER BY count DESC, name LIMIT {k}" if k else ""
    return (f"(SELECT '{section}' AS section, {expression} AS name, count(*) AS count, "
            f"CAST(NULL AS DOUBLE) AS value FROM listing GROUP BY 2{tail})")


def _value(section: str, name: str, expression: str) -> str:
    return (f"(SELECT '{section}' AS section, '{name}' AS name, CAST(NULL AS BIGINT) AS count, "
            f"CAST({expression} AS DOUBLE) AS value FROM listing)")


def _filled_sections(renamed: dict[str, str]) -> list[str]:
    return [
        f"(SELECT 'items_by_field' AS section, '{renamed.get(f, f)}' AS name, count(*) FILTER (WHERE {_filled(f)}) AS count, "
        "CAST(NULL AS DOUBLE) AS value FROM listing)" for f in _FIELDS
    ] + ["(SELECT 'scraped_at' AS section, '2002-01-01' AS name, CAST(NULL AS BIGINT) AS count, CAST(NULL AS DOUBLE) AS value)"]


AS_OF = "2002-01-01"


CARS_SQL = on_listings(
        " UNION ALL ".join(
            [_top("top_makes", "make", 5), _top("most_common_models", "concat(make, ' ', model)", 10),
             _top("body_type_distribution", "body_type"), _top("fuel_type_distribution", "fuel_type"),
             _top("transmission_distribution", "transmission"), _value("total", "items", "count(*)")]
            + [_value(f"{c}_stats", f, f"round({f}({c}), 4)") for c in ("year", "price")
               for f in ("avg", "min", "max")]
            + _filled_sections({})
        )
    )


@query("market_analysis_cars", CARS_SQL)
def _(spark, sf):
    return S.market_analysis(listing_view(spark, sf), as_of=F.lit(AS_OF)).withColumn("value", F.round("value", 4))


@query("market_analysis_batches", CARS_SQL)
def _(spark, sf):
    """Four batches of listings, each seen once; the second arrives twice.

    The listings are joined and counted once, by batch; a join per batch would send its small side to the driver each time.
    """
    store, rows = S.StatisticsStore(spark, fresh_path(spark, "statistics")), listing_view(spark, sf)
    batch = F.when(F.col("year") < 1994, 0).when(F.col("year") == 1994, 1).when(F.col("year") <= 1996, 2).when(F.col("year") > 1996, 3)
    parts = durable(S.partial_statistics(rows.withColumn("batch", batch).filter("batch IS NOT NULL"), by=["batch"]))
    for number in (0, 1, 1, 2, 3):
        store.add(number, parts.filter(F.col("batch") == number).drop("batch"))
    return S.market_sections(durable(store.read()), as_of=F.lit(AS_OF)).withColumn("value", F.round("value", 4))


@query(
    "market_analysis_realestate",
    on_listings(
        " UNION ALL ".join(
            [_top("top_locations", "city", 5), _top("bedroom_distribution", "CAST(bedrooms AS VARCHAR)"),
             _top("property_type_distribution", "body_type"), _value("total", "items", "count(*)"),
             _value("avg_price_per_sqm", "avg", "round(avg(price / size), 4)"),
             "(SELECT 'most_expensive_locations' AS section, city AS name, CAST(NULL AS BIGINT) AS count, "
             "round(avg(price), 4) AS value FROM listing GROUP BY city ORDER BY avg(price) DESC, city LIMIT 10)"]
            + _filled_sections({"city": "location", "body_type": "property_type"})
        )
    ),
)
def _(spark, sf):
    rows = listing_view(spark, sf).withColumnsRenamed({"city": "location", "body_type": "property_type"})
    return S.market_analysis(rows, "realestate", F.lit(AS_OF)).withColumn("value", F.round("value", 4))


@query(
    "run_counters",
    """
    SELECT count(*) AS seen, count(*) FILTER (WHERE o_orderstatus = 'O') AS new,
           count(*) FILTER (WHERE o_orderstatus = 'F') AS duplicate,
           count(*) FILTER (WHERE o_totalprice > 100000) AS saved,
           count(*) FILTER (WHERE NOT o_totalprice > 100000) AS skipped,
           CAST(0 AS BIGINT) AS fixed,
           CAST(epoch(max(o_orderdate)) - epoch(min(o_orderdate)) AS DOUBLE) AS duration_seconds
    FROM orders
    """,
)
def _(spark, sf):
    orders = table(spark, sf, "orders")
    rows = orders.select(
        (F.col("o_orderstatus") == "O").alias("is_new"),
        (F.col("o_orderstatus") == "F").alias("is_duplicate"),
        (F.col("o_totalprice") > 100000).alias("accepted"), "o_orderdate",
    )
    return S.run_counters(rows, F.min("o_orderdate"), F.max("o_orderdate"))


_FILTERS = "SELECT n_name AS name, count(*) FILTER (WHERE c_acctbal > 9000) AS count FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"


def _filters(spark, sf):
    joined = table(spark, sf, "customer").join(
        table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return joined.groupBy(F.col("n_name").alias("name")).agg(
        F.count_if(F.col("c_acctbal") > 9000).alias("count")
    )


@query("expected_by_location", f"SELECT * FROM ({_FILTERS}) WHERE count > 0")
def _(spark, sf):
    return S.expected_by_location(_filters(spark, sf))


@query("expected_total", f"SELECT CAST(sum(count) AS BIGINT) AS expected_total FROM ({_FILTERS}) WHERE count > 0")
def _(spark, sf):
    return S.expected_total(_filters(spark, sf))
