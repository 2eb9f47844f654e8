"""SRC-1 to SRC-4, PRJ-3 to PRJ-7: nested payloads built from the tables, and flattened again."""

from __future__ import annotations

from pyspark.sql import functions as F

from adloom.functions import fixed_values as V
from adloom.plans import flatten as L
from adloom.plans.registered.base import query, table
from adloom.sources import envelope as E


def _payloads(spark, sf):
    """Every event as a response: its kind decides the envelope, its props are the only item."""
    events = table(spark, sf, "events")
    kind, item = F.col("event_type"), F.col("props")
    body = (
        F.when(kind == "click", F.concat(F.lit("["), item, F.lit("]")))
        .when(kind == "view", F.concat(F.lit('{"data": {"x": 1}, "results": ['), item, F.lit(","), item, F.lit('], "total": '), F.col("user_id").cast("string"), F.lit("}")))
        .when(kind == "error", F.lit("<html>error</html>"))
        .when(kind == "signup", F.concat(F.lit('{"data": [], "classifieds": ['), item, F.lit('], "pagination": {"last_page": 7}}')))
        .otherwise(F.concat(F.lit('{"ads": ['), item, F.lit('], "meta": {"count": '), F.col("user_id").cast("string"), F.lit("}}")))
    )
    return events.select("event_id", "event_type", body.alias("body"))


@query(
    "envelope_items",
    """
    SELECT event_id, CAST(pos AS INT) AS pos, CAST(json_extract(props, '$.k') AS INT) AS k
    FROM (SELECT event_id, props, unnest(CASE WHEN event_type IN ('click', 'purchase') THEN [0] WHEN event_type = 'view' THEN [0, 1] ELSE [] END) AS pos FROM events)
    """,
)
def _(spark, sf):
    items = E.explode_items(_payloads(spark, sf))
    return items.select("event_id", "pos", F.try_variant_get("item", "$.k", "int").alias("k"))


@query(
    "envelope_non_empty",
    """
    SELECT event_id, CAST(pos AS INT) AS pos, CAST(json_extract(props, '$.k') AS INT) AS k
    FROM (SELECT event_id, props, unnest(CASE WHEN event_type IN ('click', 'signup') THEN [0] WHEN event_type = 'view' THEN [0, 1] ELSE [] END) AS pos FROM events)
    """,
)
def _(spark, sf):
    items = E.explode_items(_payloads(spark, sf), keys=V.ENVELOPE_KEYS_NON_EMPTY, require_non_empty=True)
    return items.select("event_id", "pos", F.try_variant_get("item", "$.k", "int").alias("k"))


@query(
    "envelope_totals",
    """
    SELECT event_id, CASE WHEN event_type IN ('view', 'purchase') THEN CAST(user_id AS INT) END AS total,
           CASE WHEN event_type = 'signup' THEN 7 END AS last_page,
           event_type IN ('click', 'view', 'purchase') AND json_extract(props, '$.price') IS NOT NULL AS is_listing
    FROM events
    """,
)
def _(spark, sf):
    body = F.try_parse_json("body")
    return _payloads(spark, sf).select(
        "event_id", E.envelope_total(body).alias("total"), E.last_page(body).alias("last_page"),
        E.is_listing_payload(F.lit("https://api.example/search/ads?page=1"), body).alias("is_listing"),
    )


# Keys are shifted by one, because a numeric zero counts as missing in a payload.
_ORDERS = """(SELECT * REPLACE (o_orderkey + 1 AS o_orderkey, o_custkey + 1 AS o_custkey)
              FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)"""


def _orders(spark, sf):
    return table(spark, sf, "orders").join(
        table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")
    ).join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).withColumns(
        {"o_orderkey": F.col("o_orderkey") + 1, "o_custkey": F.col("o_custkey") + 1}
    )


@query(
    "flatten_classified",
    f"""
    SELECT concat('src_', CAST(o_orderkey AS VARCHAR)) AS id, concat('https://site.example/cars/', CAST(o_orderkey AS VARCHAR)) AS car_url,
      CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE 'list' END AS ad_title,
      n_name AS make, c_mktsegment AS model, 'أبيض' AS exterior_color,
      CASE o_orderstatus WHEN 'F' THEN 'بنزين' WHEN 'O' THEN 'ديزل' ELSE 'steam' END AS fuel_type,
      CASE WHEN c_acctbal > 0 THEN '+100,000' END AS mileage, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS price,
      CASE WHEN o_orderstatus = 'O' THEN 'دمشق' ELSE 'atlantis' END AS city, c_name AS seller_name, CAST(o_custkey AS VARCHAR) AS phone,
      CASE WHEN c_nationkey <> 0 THEN CAST(c_nationkey AS VARCHAR) END AS views, CASE WHEN c_acctbal > 0 THEN 'True' ELSE 'False' END AS featured,
      CASE WHEN o_orderstatus = 'O' THEN 'a.jpg b.jpg' ELSE 'a.jpg c.jpg' END AS images, 2 AS image_count
    FROM {_ORDERS}
    """,
)
def _(spark, sf):
    status, rows = F.col("o_orderstatus"), _orders(spark, sf)
    parent = F.struct(F.struct(F.col("n_name").alias("name_ar")).alias("parent"), F.lit("").alias("name_ar"), F.col("c_mktsegment").alias("name"))
    detail = F.to_json(
        F.struct(
            F.col("o_orderkey").alias("id"),
            F.when(status == "P", "").when(status == "F", F.col("o_orderpriority")).alias("title_ar"),
            parent.alias("brand"), F.lit("White").alias("external_color"),
            F.when(status == "F", "oil").when(status == "O", " DIESEL").otherwise("steam").alias("fuel_type"),
            F.when(F.col("c_acctbal") > 0, "+100,000").otherwise("").alias("kilometers_parsed"),
            F.floor("o_totalprice").alias("price"), F.when(status == "O", "damascus").otherwise("atlantis").alias("city"),
            F.struct(F.col("c_name").alias("name"), F.col("o_custkey").alias("phone")).alias("user"),
            F.col("c_nationkey").alias("views_count"), (F.col("c_acctbal") > 0).alias("is_featured"),
            F.when(status != "O", F.array(F.struct(F.lit("a.jpg").alias("url")), F.struct(F.lit("c.jpg").alias("url")),
                                          F.struct(F.lit("dir/").alias("url")))).alias("images"),
        )
    )
    listing = F.to_json(F.struct(F.lit("list").alias("title_ar"), F.lit("a.jpg b.jpg").alias("images")))
    items = rows.select(F.try_parse_json(detail).alias("item"), F.try_parse_json(listing).alias("listing"))
    flat = L.flatten_classified(items, "src", "https://site.example/cars/{id}", listing="listing")
    return flat.select(
        "id", "car_url", "ad_title", "make", "model", "exterior_color", "fuel_type", "mileage", "price", "city", "seller_name",
        "phone", "views", "featured", F.array_join("image_urls", " ").alias("images"), "image_count",
    )


@query(
    "flatten_classified_wide",
    f"""
    SELECT concat('src_', CAST(o_orderkey AS VARCHAR)) AS id, n_name AS brand, c_mktsegment AS model, DATE '2001-01-31' - CAST(c_nationkey AS INT) AS date_added,
      CASE o_orderstatus WHEN 'F' THEN 'دفع رباعي' ELSE 'tracks' END AS drive_system, concat('+', CAST(o_custkey AS VARCHAR)) AS contact,
      CASE WHEN o_orderstatus = 'F' THEN concat(o_orderpriority, ' | المصدر: محلي | المواصفات: الفئة الأولى') ELSE o_orderpriority END AS description,
      'http://img.example/new/high/1.jpg' AS images_original_links, CAST(c_nationkey AS VARCHAR) AS mileage
    FROM {_ORDERS}
    """,
)
def _(spark, sf):
    status = F.col("o_orderstatus")
    item = F.to_json(
        F.struct(
            F.col("o_orderkey").alias("id"), F.concat(F.col("c_nationkey").cast("string"), F.lit(" days ago")).alias("created_at_en"),
            F.struct(F.struct(F.col("n_name").alias("name_en")).alias("parent"), F.col("c_mktsegment").alias("name_ar")).alias("brand"),
            F.when(status == "F", "four").otherwise("tracks").alias("drive_line"), F.col("o_orderpriority").alias("description"),
            F.when(status == "F", "local").alias("source"), F.when(status == "F", "first_class").alias("specifications"),
            F.struct(F.col("o_custkey").cast("string").alias("phone")).alias("user"), F.col("c_nationkey").alias("kilometers"),
            F.array(F.lit("http://img.example/new/low/1.jpg"), F.lit("ftp://no")).alias("images"),
        )
    )
    items = _orders(spark, sf).select(F.try_parse_json(item).alias("item"))
    flat = L.flatten_classified_wide(items, "src", "https://site.example", F.lit("2001-01-31").cast("date"))
    return flat.select("id", "brand", "model", "date_added", "drive_system", "contact", "description", "images_original_links", "mileage")


def _adverts(spark, sf):
    status = F.col("o_orderstatus")
    text = lambda c: c.cast("string")
    nested = lambda slug, value: F.struct(
        F.struct(F.lit(slug).alias("slug"), F.lit("").alias("field_name_ar")).alias("template_field"), F.struct(value.alias("ar")).alias("value")
    )
    flat = lambda label, value: F.struct(F.lit(label).alias("name_ar"), value.alias("value"))
    item = F.to_json(
        F.struct(
            F.when(status != "P", F.col("o_orderkey")).alias("_id"), F.concat(F.lit("ad-"), text(F.col("o_orderkey"))).alias("slug"),
            F.concat(F.lit("للبيع سيارة كيا "), F.lower("c_mktsegment"), F.lit(" 2015 في دمشق")).alias("title"),
            F.struct(F.when(status == "F", "أخرى").otherwise(F.col("n_name")).alias("name_ar")).alias("category"),
            F.struct(F.lit("أخرى").alias("name")).alias("governorate"), F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("price"),
            F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("created_at"),
            F.array(flat("السنة", F.lit("قبل 2000")), flat("الوقود", F.lit("Diesel")), flat("الحالة", F.lit("غير محدد"))).alias("featured_fields"),
            F.array(flat("ناقل الحركة", F.lit("cvt"))).alias("attributes"), F.lit("used").alias("condition"),
            F.lit("0").alias("phone"), text(F.col("o_custkey")).alias("whatsapp"), F.struct(F.col("c_name").alias("full_name")).alias("customer"),
            F.array(F.struct(F.lit("rel.jpg").alias("src")), F.struct(F.lit("http://i.example/1.jpg").alias("src"))).alias("gallery"),
        )
    )
    detail = F.to_json(F.array(nested("traveled_distance", F.concat(text(F.col("c_nationkey")), F.lit(" كم"))),
                               nested("engine_capacity", F.lit("2000 سي سي")), nested("year_of_manufacture", F.lit("-"))))
    return _orders(spark, sf).select(F.try_parse_json(item).alias("item"), F.try_parse_json(detail).alias("detail"))


_ADVERT_SQL = """concat('src_', CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey AS VARCHAR) ELSE 'ad-' || CAST(o_orderkey AS VARCHAR) END) AS id,
      concat('https://site.example/cars/ad-', CAST(o_orderkey AS VARCHAR)) AS car_url, CAST(o_custkey AS VARCHAR) AS phone, c_name AS seller_name,
      CAST(o_orderdate AS DATE) AS date_added, 'ديزل' AS fuel_type, 'CVT' AS transmission, 'مستعمل' AS condition, 'http://i.example/1.jpg' AS cover_image_url"""
_ADVERT_COLUMNS = ["id", "car_url", "phone", "seller_name", "date_added", "fuel_type", "transmission", "condition", "cover_image_url"]


@query(
    "flatten_advert",
    f"""
    SELECT {_ADVERT_SQL}, 'للبيع' AS listing_type, CASE WHEN o_orderstatus = 'F' THEN 'كيا' ELSE n_name END AS make,
           lower(c_mktsegment) AS model, '2000' AS year, CAST(c_nationkey AS VARCHAR) AS mileage, '2000' AS engine_size, 'غير ذلك' AS city
    FROM {_ORDERS}
    """,
)
def _(spark, sf):
    flat = L.flatten_advert(_adverts(spark, sf), "src", "https://site.example/cars/", detail="detail")
    return flat.select(*_ADVERT_COLUMNS, "listing_type", "make", "model", "year", "mileage", "engine_size", "city")


@query(
    "flatten_advert_production",
    f"""
    SELECT {_ADVERT_SQL}, CASE WHEN o_orderstatus = 'F' THEN 'أخرى' ELSE n_name END AS make, 'قبل 2000' AS year, 'أخرى' AS city,
           concat(CAST(c_nationkey AS VARCHAR), ' كم') AS mileage, '2000 سي سي' AS engine_size,
           concat('للبيع سيارة كيا ', lower(c_mktsegment), ' 2015 في دمشق') AS model
    FROM {_ORDERS}
    """,
)
def _(spark, sf):
    flat = L.flatten_advert(_adverts(spark, sf), "src", "https://site.example/cars/", detail="detail", form="production")
    return flat.select(*_ADVERT_COLUMNS, "make", "model", "year", "mileage", "engine_size", "city")


@query(
    "flatten_advert_wide",
    f"""
    SELECT concat('src_', CAST(o_orderkey AS VARCHAR)) AS id, format('{{:,}}', CAST(floor(o_totalprice) AS BIGINT)) AS price, n_name AS make,
           lower(c_mktsegment) AS model, CAST(c_nationkey AS VARCHAR) AS mileage, 'أحمر' AS exterior_color, 'حلب' AS city,
           concat(CAST(o_custkey AS VARCHAR), ' / WA:99', CAST(o_custkey AS VARCHAR)) AS phone, 'http://i.example/1.jpg, http://i.example/2.jpg' AS images_original_links
    FROM {_ORDERS}
    """,
)
def _(spark, sf):
    text = F.concat(F.lit("<p>▪اللون : أحمر</p><p>▪الموديل : "), F.lower("c_mktsegment"), F.lit("</p><p>▪المسافة المقطوعة : 5 كم</p>العنوان : حلب"))
    field = F.struct(F.struct(F.lit("mileage").alias("slug")).alias("template_field"),
                     F.struct(F.concat(F.col("c_nationkey").cast("string"), F.lit(" km")).alias("ar")).alias("value"))
    item = F.to_json(
        F.struct(
            F.col("o_orderkey").alias("id"), F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("price"),
            F.struct(F.col("n_name").alias("name_ar")).alias("category"), F.array(field).alias("featured_fields"), text.alias("description"),
            F.col("o_custkey").alias("phone"), F.concat(F.lit("99"), F.col("o_custkey").cast("string")).alias("whatsapp"),
            F.array(F.struct(F.lit("http://i.example/1.jpg").alias("src")), F.struct(F.lit("http://i.example/2.jpg").alias("src"))).alias("gallery"),
        )
    )
    items = _orders(spark, sf).select(F.try_parse_json(item).alias("item"))
    flat = L.flatten_advert_wide(items, "src", "https://site.example/ads/")
    return flat.select("id", "price", "make", "model", "mileage", "exterior_color", "city", "phone", "images_original_links")
