"""FLT-3 to FLT-5 and WIN-5: gates with reasons, repair selection, cover choice."""

from __future__ import annotations

from pyspark.sql import functions as F

from adloom.functions import fixed_values as V
from adloom.operators import gates as G
from adloom.plans.registered.base import listing_view, on_listings, query, table


def _spoiled(spark, sf):
    """Listings with blanks and placeholders in some cells."""
    rows = listing_view(spark, sf)
    flag = F.col("transmission")
    return rows.select(
        "id", "model", "year", "city", "seller_name", "price",
        F.when(F.col("bedrooms") == 1, F.lit(" غير محدد ")).otherwise(F.col("make")).alias("make"),
        F.when(flag == "R", "N/A").when(flag == "A", F.col("fuel_type")).alias("fuel_type"),
        F.when(F.col("bedrooms") == 2, "0").when(F.col("bedrooms") == 3, "None").otherwise("+963").alias("phone"),
    )


@query(
    "mandatory_gate",
    on_listings("""
    SELECT id, concat_ws(',', CASE WHEN bedrooms = 1 THEN 'make' END, CASE WHEN transmission <> 'A' THEN 'fuel_type' END,
                         CASE WHEN bedrooms IN (2, 3) THEN 'phone' END) AS reasons,
           NOT (bedrooms = 1 OR transmission <> 'A' OR bedrooms IN (2, 3)) AS accepted FROM listing"""),
)
def _(spark, sf):
    gated = G.mandatory_gate(_spoiled(spark, sf))
    return gated.select("id", F.array_join("reasons", ",").alias("reasons"), "accepted")


@query(
    "mandatory_first_missing",
    on_listings("""
    SELECT reason, count(*) AS n FROM (
      SELECT CASE WHEN bedrooms = 1 THEN 'make' WHEN transmission <> 'A' THEN 'fuel_type'
                  WHEN bedrooms IN (2, 3) THEN 'phone' END AS reason FROM listing)
    WHERE reason IS NOT NULL GROUP BY reason"""),
)
def _(spark, sf):
    _, rejected = G.split_gate(G.mandatory_gate(_spoiled(spark, sf)))
    first = F.element_at("reasons", 1).alias("reason")
    return rejected.groupBy(first).agg(F.count("*").alias("n"))


@query(
    "quality_gate",
    on_listings("""
    SELECT id, concat_ws(',', CASE WHEN bedrooms = 4 THEN 'make' END, CASE WHEN contains(city, 'AN') THEN 'exterior_color' END,
             CASE WHEN size = 50 THEN 'engine_size' END, CASE WHEN transmission = 'N' AND bedrooms = 3 THEN 'transmission' END,
             CASE WHEN transmission = 'R' THEN 'condition' END,
             CASE WHEN bedrooms = 5 THEN 'mileage' END, CASE WHEN year = 1995 THEN 'seller_name' END, CASE WHEN fuel_type = 'F' AND bedrooms = 6 THEN 'price_value' END,
             CASE WHEN size * 10 < 100 OR size = 50 THEN 'engine_value' END, CASE WHEN bedrooms = 7 THEN 'images' END) AS reasons,
           NOT (bedrooms IN (4, 5, 7) OR contains(city, 'AN') OR size = 50 OR year = 1995 OR (transmission = 'N' AND bedrooms = 3) OR transmission = 'R' OR (fuel_type = 'F' AND bedrooms = 6) OR size * 10 < 100) AS accepted
    FROM listing"""),
)
def _(spark, sf):
    rows = listing_view(spark, sf)
    beds = F.col("bedrooms")
    spoiled = rows.select(
        "id", "model", "year", "body_type", "city",
        F.when(beds == 4, "غير معروف").otherwise(F.col("make")).alias("make"),
        F.when(F.col("transmission") == "R", "n/a").otherwise("مستعمل").alias("condition"),
        F.when(beds == 5, " ").otherwise("N/A km").alias("mileage"),
        F.when((F.col("fuel_type") == "F") & (beds == 6), "1.00 $").otherwise(
            F.concat(F.lit("$"), F.format_number("price", 2))
        ).alias("price"),
        F.when(F.col("size") == 50, "-").otherwise(F.concat((F.col("size") * 10).cast("string"), F.lit(" CC"))).alias("engine_size"),
        F.when(F.col("city").contains("AN"), "None").otherwise("أبيض").alias("exterior_color"), F.lit("بيج").alias("interior_color"),
        "fuel_type", F.when((F.col("transmission") == "N") & (beds == 3), F.lit(None)).otherwise(F.col("transmission")).alias("transmission"),
        F.col("id").alias("phone"), F.when(F.col("year") == 1995, "none").otherwise(F.col("seller_name")).alias("seller_name"),
        F.when(beds == 7, F.array().cast("array<string>")).otherwise(F.array("id")).alias("image_urls"),
    )
    gated = G.quality_gate(spoiled)
    return gated.select("id", F.array_join("reasons", ",").alias("reasons"), "accepted")


def _images(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("id"),
        (F.col("l_linenumber").cast("bigint") * 100000000 + F.col("l_partkey")).alias("idx"),
        F.concat_ws("/", F.lit("http://img"), F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"),
                    F.col("l_partkey").cast("string")).alias("url"),
        F.lit(1000).alias("width"),
        (F.col("l_quantity").cast("int") * 30).alias("height"),
        F.when(F.col("l_returnflag") != "A", F.col("l_discount") * 1000).alias("brightness"),
    )


@query(
    "cover_image",
    f"""
    WITH image AS (
      SELECT l_orderkey AS id, CAST(l_linenumber AS BIGINT) * 100000000 + l_partkey AS idx,
             concat_ws('/', 'http://img', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR)) AS url,
             NOT coalesce(CAST(l_quantity AS INT) * 30 > 1000 * {V.MAX_HEIGHT_TO_WIDTH}
                          OR CASE WHEN l_returnflag <> 'A' THEN l_discount * 1000 END < {V.MIN_BRIGHTNESS}, FALSE) AS good
      FROM lineitem)
    SELECT id, coalesce(arg_min(url, idx) FILTER (WHERE good), arg_min(url, idx)) AS cover_url FROM image GROUP BY id
    """,
)
def _(spark, sf):
    return G.cover_images(_images(spark, sf))


@query(
    "needs_image_repair",
    """
    SELECT l_orderkey, l_partkey, concat_ws('|', 'a' || CAST(l_suppkey AS VARCHAR), 'b') AS urls FROM lineitem
    WHERE l_returnflag IN ('R', 'A') AND l_linestatus = 'O'
    """,
)
def _(spark, sf):
    flag = F.col("l_returnflag")
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", F.col("l_orderkey").cast("string").alias("id"),
        F.when(flag == "R", " ").when(flag == "N", "done").alias("images_drive_links"),
        F.when(F.col("l_linestatus") == "O", F.concat(F.lit("a"), F.col("l_suppkey").cast("string"), F.lit(" , b,,")))
        .otherwise(" , ").alias("originals"),
    )
    found = G.needs_image_repair(rows, originals="originals")
    return found.select("l_orderkey", "l_partkey", F.array_join("image_urls", "|").alias("urls"))
