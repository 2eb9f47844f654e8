"""JN-4, JN-10, JN-11, MRG-*, AGG-21, SET-1: record fusion and lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from adloom.operators import enrich as E
from adloom.plans.registered.base import query, table
from adloom.sources.tables import union_sources


def _cards(spark, sf):
    """Orders as cards; some card fields are blank or missing."""
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("id"), "o_orderkey",
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).otherwise("").alias("title_raw"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("price_raw"),
        F.lit("from card").alias("description_raw"),
    )


def _details(spark, sf):
    """Customers with a balance as details of their orders."""
    return table(spark, sf, "customer").filter("c_acctbal > 0").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("title_raw"),
        F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("price_raw"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).otherwise("").alias("description_raw"),
    )


_CARD_SQL = """
card AS (SELECT o_custkey AS id, o_orderkey, CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority ELSE '' END AS title_raw,
           CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS price_raw,
           'from card' AS description_raw FROM orders),
detail AS (SELECT c_custkey AS id, c_name AS d_title, CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) AS d_price,
             CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment ELSE '' END AS d_desc
           FROM customer WHERE c_acctbal > 0)
"""


def _merge_sql(title: str, price: str, description: str) -> str:
    return (f"WITH {_CARD_SQL} SELECT id, o_orderkey, {title} AS title_raw, {price} AS price_raw, "
            f"{description} AS description_raw FROM card LEFT JOIN detail USING (id)")


@query(
    "merge_unified",
    _merge_sql("coalesce(nullif(title_raw, ''), d_title)", "coalesce(price_raw, d_price)",
               "coalesce(nullif(d_desc, ''), description_raw)"),
)
def _(spark, sf):
    return E.merge_unified(E.join_details(_cards(spark, sf), _details(spark, sf)))


@query(
    "merge_clean_card",
    _merge_sql("coalesce(d_title, nullif(title_raw, ''))", "coalesce(price_raw, d_price)",
               "coalesce(nullif(d_desc, ''), description_raw)"),
)
def _(spark, sf):
    return E.merge_clean_card(E.join_details(_cards(spark, sf), _details(spark, sf)))


@query(
    "merge_override_present",
    _merge_sql("CASE WHEN d_title IS NOT NULL THEN d_title ELSE title_raw END",
               "CASE WHEN d_title IS NOT NULL THEN d_price ELSE price_raw END",
               "CASE WHEN d_title IS NOT NULL THEN d_desc ELSE description_raw END"),
)
def _(spark, sf):
    names = ["title_raw", "price_raw", "description_raw"]
    joined = E.join_details(_cards(spark, sf), _details(spark, sf))
    return E.override_present(joined, names).select("id", "o_orderkey", *names)


@query(
    "merge_fill_missing",
    _merge_sql("coalesce(nullif(title_raw, ''), d_title)", "coalesce(d_price, price_raw)",
               "coalesce(nullif(d_desc, ''), description_raw)"),
)
def _(spark, sf):
    joined = E.join_details(_cards(spark, sf), _details(spark, sf))
    filled = E.fill_missing(joined, ["title_raw"])
    out = E.override_nonempty(filled, ["price_raw", "description_raw"])
    return out.select("id", "o_orderkey", "title_raw", "price_raw", "description_raw")


_CARS = """
cars AS (SELECT concat(' ', upper(s_name), ' ') AS seller_name, concat('+', CAST(l_orderkey AS VARCHAR), '/', CAST(l_partkey AS VARCHAR)) AS phone,
           CASE WHEN l_returnflag = 'A' THEN 'dealer' ELSE 'private' END AS seller_type,
           l_orderkey * 10 + l_linenumber AS row_num
         FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
"""


def _cars(spark, sf):
    joined = table(spark, sf, "lineitem").join(
        table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")
    )
    return joined.select(
        F.concat(F.lit(" "), F.upper("s_name"), F.lit(" ")).alias("seller_name"),
        F.concat(F.lit("+"), F.col("l_orderkey").cast("string"), F.lit("/"), F.col("l_partkey").cast("string")).alias("phone"),
        F.when(F.col("l_returnflag") == "A", "dealer").otherwise("private").alias("seller_type"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("row_num"),
    )


def _dealers(spark, sf):
    return table(spark, sf, "supplier").select(
        F.col("s_name").alias("dealer_name"), F.col("s_nationkey").alias("city")
    )


_PHONES = f"""
WITH {_CARS}, last AS (
  SELECT lower(trim(seller_name)) AS k, phone, row_number() OVER (
    PARTITION BY lower(trim(seller_name)) ORDER BY row_num DESC, phone DESC) AS rn
  FROM cars WHERE seller_type = 'dealer'),
dealers AS (SELECT s_name AS dealer_name, s_nationkey AS city, phone
            FROM supplier LEFT JOIN (SELECT * FROM last WHERE rn = 1) ON lower(trim(s_name)) = k)
"""


@query("dealer_phone_enrich", f"{_PHONES} SELECT * FROM dealers")
def _(spark, sf):
    return E.enrich_dealers(_dealers(spark, sf), _cars(spark, sf))


@query(
    "dealer_match_rate",
    f"{_PHONES} SELECT count(phone) AS matched, count(*) AS dealers, count(phone) / count(*) AS match_rate FROM dealers",
)
def _(spark, sf):
    return E.phone_match_rate(E.enrich_dealers(_dealers(spark, sf), _cars(spark, sf)))


@query(
    "dealer_aggregate",
    """
    WITH links AS (
      SELECT s_name AS username, l_orderkey * 100000000 + l_partkey * 10 + l_linenumber AS pos,
        CASE WHEN l_linenumber = 1 THEN concat(CAST(CAST(l_quantity AS INT) AS VARCHAR), ' سيارة')
             WHEN l_linenumber = 2 THEN '' ELSE concat('معرض ', CAST(l_partkey AS VARCHAR)) END AS text
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
    names AS (SELECT username, arg_min(text, pos) AS name FROM links WHERE text LIKE 'معرض%' GROUP BY username),
    counts AS (SELECT username, regexp_extract(arg_max(text, pos), '([0-9]+)', 1) AS car_count
               FROM links WHERE text LIKE '%سيارة' GROUP BY username)
    SELECT coalesce(name, username) AS dealer_name, username, car_count
    FROM (SELECT DISTINCT username FROM links) LEFT JOIN names USING (username) LEFT JOIN counts USING (username)
    """,
)
def _(spark, sf):
    joined = table(spark, sf, "lineitem").join(
        table(spark, sf, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")
    )
    text = (
        F.when(F.col("l_linenumber") == 1, F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(" سيارة")))
        .when(F.col("l_linenumber") == 2, "")
        .otherwise(F.concat(F.lit("معرض "), F.col("l_partkey").cast("string")))
    )
    position = F.col("l_orderkey") * 100000000 + F.col("l_partkey") * 10 + F.col("l_linenumber")
    links = joined.select(F.col("s_name").alias("username"), text.alias("text"), position.alias("pos"))
    return E.aggregate_dealers(links)


@query(
    "contact_fill",
    """
    SELECT c.c_custkey AS id, coalesce(nullif(contact, ''), found) AS contact
    FROM (SELECT c_custkey, CASE WHEN c_acctbal > 5000 THEN c_name WHEN c_acctbal > 0 THEN '' END AS contact FROM customer) c
    LEFT JOIN (SELECT o_custkey, max(CASE WHEN o_orderstatus = 'F' THEN concat('ph', CAST(o_orderkey AS VARCHAR))
                                          WHEN o_orderstatus = 'O' THEN concat('wa', CAST(o_orderkey AS VARCHAR)) END) AS found
               FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey
    """,
)
def _(spark, sf):
    balance = F.col("c_acctbal")
    items = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.when(balance > 5000, F.col("c_name")).when(balance > 0, "").alias("contact"),
    )
    key, status = F.col("o_orderkey").cast("string"), F.col("o_orderstatus")
    contacts = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("id"),
        F.when(status == "F", F.concat(F.lit("ph"), key)).otherwise("").alias("phone"),
        F.when(status == "O", F.concat(F.lit("wa"), key)).alias("whatsapp"),
    )
    return E.fill_contacts(items, contacts)


@query(
    "union_sources",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS INT) AS size FROM customer
    UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, NULL, NULL FROM supplier
    UNION ALL SELECT CAST(p_partkey AS VARCHAR), p_name, NULL, p_size FROM part
    """,
)
def _(spark, sf):
    one = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    two = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("name"))
    three = table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("id"), F.col("p_name").alias("name"), F.col("p_size").alias("size")
    )
    return union_sources(one, two, three)
