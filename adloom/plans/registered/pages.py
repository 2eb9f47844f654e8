"""EXT-1 to EXT-8, PRJ-1: pages of the table itself, and listing pages built from other tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from adloom.functions.text import blank_to_null, squeeze, unescape_html
from adloom.operators import pages as P
from adloom.plans import listings as L
from adloom.plans.registered.base import query, spread, table


@query(
    "page_titles",
    r"""
    SELECT page_id, regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1) AS title,
           len(regexp_extract_all(html, '(?is)<p(?:\s[^>]*)?>(.*?)</p>', 1)) AS paragraphs FROM pages
    """,
)
def _(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title>", 1).alias("title"),
        F.size(P.tag_texts(F.col("html"), "p")).cast("bigint").alias("paragraphs"),
    )


@query(
    "page_links",
    """
    SELECT page_id, CAST(pos AS INT) AS pos, links[pos + 1] AS target FROM (
      SELECT page_id, links, unnest(range(len(links))) AS pos FROM (
        SELECT page_id, regexp_extract_all(html, '(?i)<a\\s[^>]*?href="([^"]*)"', 1) AS links FROM pages))
    """,
)
def _(spark, sf):
    pages = table(spark, sf, "pages")
    return pages.select("page_id", F.posexplode(P.link_targets(F.col("html"))).alias("pos", "target"))


_UNESCAPED = """replace(replace(replace(replace(replace({0}, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&nbsp;', ' '), '&amp;', '&')"""


@query(
    "page_headlines",
    f"""
    SELECT page_id, nullif(trim(regexp_replace({_UNESCAPED.format("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")}, '\\s+', ' ', 'g')), '') AS title_raw
    FROM pages
    """,
)
def _(spark, sf):
    facts = P.extract_pages(table(spark, sf, "pages"), key=["page_id"])
    details = P.generic_details(facts, ["page_id"])
    return details.select("page_id", blank_to_null(squeeze(unescape_html(F.col("title_raw")))).alias("title_raw"))


def _row(label, value):
    return F.concat(F.lit(f"<tr><td> {label}</td>\n<td><b>"), value.cast("string"), F.lit("</b></td></tr>"))


def _part_pages(spark, sf):
    """A detail page per part, with every label/value layout in it."""
    name, size = F.col("p_name"), F.col("p_size")
    html = F.concat(
        F.lit("<html><body><h1> "), name, F.lit("</h1><span>"), F.format_number(F.floor("p_retailprice"), 0),
        F.lit(" $</span><h2>معلومات السيارة</h2><div><div>الماركة</div><div>"), F.col("p_brand"),
        F.lit("</div><div>الموديل</div><div>old</div></div><dl><dt>الموديل</dt><dd>"), name,
        F.lit("</dd></dl><table>"), _row("السنة", 1960 + size), _row("نوع الوقود", F.col("p_type")),
        F.lit("</table><div class='spec-row'><div>نوع الوقود</div><div>late</div></div>"
              "<div class='car-detail'><div>اللون</div><div>"), F.col("p_type"), F.lit("</div></div>"
              "<div class='accordion-inner-details'><ul><li>الأبواب</li><li>اللون</li></ul><ul><li>"), size.cast("string"),
        F.lit("</li><li>late</li></ul></div><h3>الوصف</h3><p>ماشية <b>"), (size * 1000).cast("string"),
        F.lit("</b> كم</p><h4>معلومات البائع</h4><p>"), F.col("p_brand"),
        F.lit("</p><a href='tel:+963 1'>c</a><a href='https://wa.me/"), F.col("p_partkey").cast("string"),
        F.lit("?x=1'>w</a><img src='https://photos.example/cars/front-side.jpg'><img src='https://photos.example/site-logo-large.png'>"
              "</body></html>"),
    )
    return spread(table(spark, sf, "part")).select(F.col("p_partkey").cast("string").alias("url"), html.alias("html"))


@query(
    "page_details",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS url, p_name AS title_raw, concat(format('{:,}', CAST(floor(p_retailprice) AS BIGINT)), ' $') AS price_raw,
           concat('ماشية ', CAST(p_size * 1000 AS VARCHAR), ' كم') AS description_raw, p_brand AS seller_name, '+963 1' AS phone,
           CAST(p_partkey AS VARCHAR) AS whatsapp, 'https://photos.example/cars/front-side.jpg' AS images,
           concat('الماركة=', p_brand, ';الموديل=', p_name, ';السنة=', CAST(1960 + p_size AS VARCHAR), ';نوع الوقود=', p_type,
                  ';اللون=', p_type, ';الأبواب=', CAST(p_size AS VARCHAR)) AS specs
    FROM part
    """,
)
def _(spark, sf):
    details = P.generic_details(P.extract_pages(_part_pages(spark, sf)))
    shown = F.transform("specs", lambda p: F.concat(p["label"], F.lit("="), p["value"]))
    return details.withColumns({"specs": F.array_join(shown, ";"), "images": F.array_join("images", " ")})


@query(
    "nested_details",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS url, CASE WHEN p_size < 40 THEN concat(p_name, ' of ', p_brand, ' and ', p_type) END AS description_raw,
           concat(p_brand, ' ', p_type) AS seller_name, 'roof' || CASE WHEN p_size < 25 THEN ' glass' ELSE '' END || ', abs' AS features
    FROM part
    """,
)
def _(spark, sf):
    """Pages whose boxes hold boxes of their own name; in some the outer one is never closed."""
    size = F.col("p_size")
    html = F.concat(
        F.lit("<div class='description-car-details'><div>"), F.col("p_name"), F.lit("</div> of <div class='x'>"), F.col("p_brand"), F.lit("<div> and "), F.col("p_type"),
        F.lit("</div></div>"), F.when(size < 40, "</div>").otherwise(""), F.lit("<div class='div-box-border-username'><p>"), F.col("p_brand"), F.lit(" <p>"), F.col("p_type"),
        F.lit("</p></p></div><div class='box-accordion-2'><div><h3>الراحة</h3></div><ul><li>roof"), F.when(size < 25, "<ul><li>glass</li></ul>").otherwise(""),
        F.lit("</li><li>abs</li></ul></div>"), F.when(size >= 40, "<p>more</p>").otherwise(""),
    )
    pages = spread(table(spark, sf, "part")).select(F.col("p_partkey").cast("string").alias("url"), html.alias("html"))
    facts = P.extract_pages(pages, "accordion")
    names = F.filter(F.transform("features", lambda f: f["name"]), lambda n: n != "glass")
    return facts.select("url", P.field("description_raw").alias("description_raw"), P.field("seller_name").alias("seller_name"), F.array_join(names, ", ").alias("features"))


@query(
    "page_tables",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS url, concat('السنة=', CAST(1960 + p_size AS VARCHAR), ';نوع الوقود=', p_type) AS specs FROM part
    """,
)
def _(spark, sf):
    pairs = P.table_pairs(F.col("html"))
    shown = F.transform(pairs, lambda p: F.concat(p["label"], F.lit("="), p["value"]))
    return _part_pages(spark, sf).select("url", F.array_join(shown, ";").alias("specs"))


@query(
    "parse_listings",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS id, p_brand AS brand, p_name AS model, 1960 + p_size AS year, CAST(floor(p_retailprice) AS DOUBLE) AS price,
           p_type AS fuel_type, CASE WHEN p_size * 1000 BETWEEN 100 AND 1000000 THEN concat(CAST(p_size * 1000 AS VARCHAR), ' كم') END AS mileage,
           CAST(p_size AS VARCHAR) AS doors, 'بيع' AS listing_type, p_brand AS seller_name, p_type AS color,
           concat('+963 1 | WA:', CAST(p_partkey AS VARCHAR)) AS contact, '["https://photos.example/cars/front-side.jpg"]' AS images,
           concat_ws(' ', p_brand, p_name, CAST(1960 + p_size AS VARCHAR), CASE WHEN contains(p_name, 'new') THEN 'جديدة' END, 'للبيع', 'في دمشق') AS ad_title
    FROM part
    """,
)
def _(spark, sf):
    details = P.generic_details(P.extract_pages(_part_pages(spark, sf)))
    raw = details.withColumnRenamed("url", "id").withColumns(
        {"source": F.lit("src"), "scraped_at": F.lit("2001-01-01"), "listing_type": F.lit("sell"), "category": F.lit(None).cast("string"),
         "location_raw": F.lit(" دمشق ")}
    )
    listings = L.parse_listings(raw)
    return listings.select("id", "brand", "model", "year", "price", "fuel_type", "mileage", "doors", "listing_type", "seller_name", "color",
                           "contact", "images", "ad_title")


def _card_pages(spark, sf, card):
    """Parts as cards of listing pages of twenty."""
    cards = table(spark, sf, "part").select(
        F.floor(F.col("p_partkey") / 20).alias("url"), F.struct("p_partkey", card.alias("card")).alias("entry")
    )
    page = cards.groupBy("url").agg(F.sort_array(F.collect_list("entry")).alias("entries"))
    html = F.concat(F.lit("<div>"), F.array_join(F.transform("entries", lambda e: e["card"]), "\n"), F.lit("</div>"))
    return page.select("url", html.alias("html"))


@query(
    "grid_cards",
    """
    SELECT concat('src_', CAST(p_partkey AS VARCHAR)) AS id, concat('https://s.example/listing/car-', CAST(p_partkey AS VARCHAR), '/') AS car_url,
           concat('car-', CAST(p_partkey AS VARCHAR)) AS slug, p_brand AS make, p_name AS model, 1960 + p_size AS year, CAST(p_size AS VARCHAR) AS mileage,
           'دمشق' AS city, CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) AS price, CASE WHEN p_size < 25 THEN 'للإيجار' ELSE 'للبيع' END AS listing_type
    FROM part
    """,
)
def _(spark, sf):
    key, size = F.col("p_partkey").cast("string"), F.col("p_size")
    card = F.concat(
        F.lit('<a data-ad-id="'), key, F.lit('" href="https://s.example/listing/car-'), key, F.lit('/"><div class="basis-[28%] x"><img src="http://i.example/'), key,
        F.lit('.jpg"></div><h2>'), F.when(size < 25, "سيارة للإيجار").otherwise("سيارة"), F.lit('</h2><span class="bg-custom_light_gray p">'), F.col("p_brand"),
        F.lit(' ‏&gt; '), F.col("p_name"), F.lit('</span><span class="bg-very_light_blue">'), size.cast("string"), F.lit(' كم</span><span class="bg-very_light_yellow">موديل '),
        (1960 + size).cast("string"), F.lit('</span><span class="font-medium text-xs">دمشق</span><span class="text-site_blue">$'), F.format_number(F.floor("p_retailprice"), 0),
        F.lit("</span></a>"),
    )
    cards = P.extract_cards(_card_pages(spark, sf, card), "grid")
    found = L.grid_cards(cards, F.lit("src"))
    return found.select("id", "car_url", "slug", "make", "model", "year", "mileage", "city", "price", "listing_type")


@query(
    "accordion_cards",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS id, 'كيا' AS make, p_name AS model, p_type AS body_type, CAST(1960 + p_size AS VARCHAR) AS year,
           CAST(p_size AS VARCHAR) AS mileage, 'حلب' AS city, 'بنزين' AS fuel_type, 'كوري' AS origin, CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) AS price
    FROM part
    """,
)
def _(spark, sf):
    key, size = F.col("p_partkey").cast("string"), F.col("p_size")
    card = F.concat(
        F.lit("<div class='car-card'><button class='sharing' data-link='http://s.example/"), key, F.lit("'></button><button class='bookmark' data-car-id='"), key,
        F.lit("'></button><h1 class='car-title'>كيا Kia</h1><h2 class='car-sub-title'>"), F.col("p_name"), F.lit(" • "), F.col("p_type"), F.lit(" • "),
        (1960 + size).cast("string"), F.lit("</h2><div class='features-a'><div><p>"), size.cast("string"), F.lit(" كم</p></div><div><span>حلب</span></div></div>"
        "<div class='features-b'><span>بنزين</span><span>كوري</span></div><button id='request-price'>السعر "), F.format_number(F.floor("p_retailprice"), 0),
        F.lit(" دولار</button></div>"),
    )
    found = L.accordion_cards(P.extract_cards(_card_pages(spark, sf, card), "accordion"), F.lit("src"))
    return found.select("id", "make", "model", "body_type", "year", "mileage", "city", "fuel_type", "origin", "price")


@query(
    "dealer_rows",
    """
    SELECT s_name AS dealer_name, concat('/dealer/', CAST(s_suppkey AS VARCHAR)) AS profile_url, CAST(s_suppkey AS VARCHAR) AS dealer_id,
           CASE WHEN s_nationkey < 10 THEN NULL ELSE n_name END AS location, concat(CAST(s_nationkey AS VARCHAR), ' cars') AS cars_count
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
    """,
)
def _(spark, sf):
    key = F.col("s_suppkey").cast("string")
    rows = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    html = F.concat(
        F.lit("<table><tr class='stm-single-dealer'><td><div class='title'><a href='/dealer/"), key, F.lit("'>"), F.col("s_name"),
        F.lit("</a></div><div class='dealer-labels heading-font'>"), F.col("s_nationkey").cast("string"),
        F.lit(" <b>cars</b></div><div class='dealer-location-label'>"), F.when(F.col("s_nationkey") < 10, "غير معروف").otherwise(F.col("n_name")),
        F.lit("</div><span class='stm-show-number' data-id='"), key, F.lit("'></span></td></tr></table>"),
    )
    cards = P.extract_cards(rows.select(key.alias("url"), html.alias("html")), "dealers")
    return P.dealer_rows(cards).select("dealer_name", "profile_url", "dealer_id", "location", "cars_count")


@query(
    "portal_details",
    """
    SELECT concat('src_', CAST(p_partkey AS VARCHAR)) AS id, p_name || ' مستعملة' AS ad_title, 'مستعمل' AS condition, CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) AS price,
           'كيا' AS make, p_name AS model, CAST(p_size * 1000 AS VARCHAR) AS mileage, DATE '2001-02-03' AS date_added, 'dealer' AS seller_type,
           CASE WHEN contains('963', CAST(p_partkey AS VARCHAR)) THEN '+963' ELSE concat('+963 / WA:', CAST(p_partkey AS VARCHAR)) END AS phone, CAST(p_size AS VARCHAR) AS views, 'http://i.example/a.jpg' AS image_urls
    FROM part
    """,
)
def _(spark, sf):
    key, size = F.col("p_partkey").cast("string"), F.col("p_size")
    item = lambda label, value: F.concat(
        F.lit(f"<li class='single-listing-data-item'><span class='single-listing-data-item-label'>{label}</span><span class='single-listing-data-item-value'>"), value,
        F.lit("</span></li>"),
    )
    html = F.concat(
        F.lit("<head><meta property='article:published_time' content='2001-02-03T00:00'></head><h1 class='single-listing-title'>"), F.col("p_name"),
        F.lit(" مستعملة</h1><b class='single-listing-price-value'>$"), F.format_number(F.floor("p_retailprice"), 0), F.lit("</b><i class='post-views'>"), size.cast("string"),
        F.lit(" views</i><ul>"), item("الماركة", F.lit("Kia - كيا")), item("الموديل", F.col("p_name")), item("الكيلومتراج", F.concat(size.cast("string"), F.lit(" ألف كم"))),
        item("الموديل", F.lit("late")), F.lit("</ul><a class='single-listing-dealer-name' href='/dealer/x'>X</a><span class='single-listing-phone-number'>+963</span>"
        "<a class='single-listing-whatsapp-button' href='https://wa.me/"), key, F.lit("'>w</a><img class='single-listing-gallery-image' src='http://i.example/a-10x20.jpg?v=1'><img src='http://i.example/b.jpg'>"),
    )
    pages = spread(table(spark, sf, "part")).select(key.alias("url"), html.alias("html"))
    facts = P.extract_pages(pages, "portal")
    found = L.portal_listings(facts, F.lit("src"), F.col("url"), F.col("url"))
    return found.select("id", "ad_title", "condition", "price", "make", "model", "mileage", "date_added", "seller_type", "phone", "views",
                        F.array_join("image_urls", " ").alias("image_urls"))


@query(
    "grid_details",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS car_url, p_brand AS make, 1960 + p_size AS year, CAST(p_size AS VARCHAR) AS engine_size, 'غير ذلك' AS condition,
           'card' AS city, p_name AS seller_name, '963000000' AS phone, CASE WHEN p_size < 25 THEN 'bluetooth, roof' END AS interior_features
    FROM part
    """,
)
def _(spark, sf):
    size = F.col("p_size")
    check = lambda name, on: F.lit(
        f"<span class='flex items-center'><span class='rounded-full {'bg-emerald-100' if on else ''}'></span>{name}</span>"
    )
    sections = F.concat(F.lit("<tr><td colspan='2'><div class='py-1'>الميزات الداخلية:</div><div>"), check("bluetooth", True), check("seats", False),
                        check("roof", True), check("bluetooth", True), F.lit("</div></td></tr>"))
    html = F.concat(
        F.lit("<table class='w-full'>"), _row("الماركة", F.col("p_brand")), _row("سنة التصنيع", 1960 + size), _row("حجم المحرك", F.concat(size.cast("string"), F.lit(" CC"))),
        _row("الحالة", F.lit("أخرى")), F.when(size < 25, sections).otherwise(""), F.lit("</table><span class='text-primary font-semibold'>"), F.col("p_name"),
        F.lit("</span><a href='https://s.example/users/963000000'>u</a><div class='text-xs font-semibold text-gray-500'>ريف ‏&gt; قدسيا</div>"),
    )
    part = spread(table(spark, sf, "part")).withColumn("car_url", F.col("p_partkey").cast("string"))
    none = F.lit(None).cast("string")
    cards = part.select("car_url", F.lit("card").alias("city"), none.alias("make"), none.alias("year"), none.alias("mileage"))
    facts = P.extract_pages(part.select(F.col("car_url"), html.alias("html")), "grid", key=["car_url"])
    merged = L.merge_grid(cards, L.grid_details(facts, ["car_url"]))
    return merged.select("car_url", "make", "year", "engine_size", "condition", "city", "seller_name", "phone", "interior_features")


@query(
    "accordion_details",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS url, 'كيا' AS make, p_name AS model, p_type AS body_type, CAST(p_size AS VARCHAR) AS doors, 'أحمر' AS exterior_color,
           CAST(1960 + p_size AS VARCHAR) AS year, DATE '2001-02-03' AS date_added, CAST(p_size AS VARCHAR) AS views, 'a|b' AS features, 'abs' AS safety_features
    FROM part
    """,
)
def _(spark, sf):
    size = F.col("p_size").cast("string")
    html = F.concat(
        F.lit("<script type='application/ld+json'>{\"brand\": \"كيا Kia\", \"model\": \"ld\", \"color\": \"أحمر\", \"vehicleModelDate\": \""), (1960 + F.col("p_size")).cast("string"),
        F.lit("\"}</script><div class='box-accordion-1-right'><ul><li>جسم المركبة</li><li>عدد الأبواب</li></ul><ul><li class='li-1-details-color'>"), F.col("p_type"),
        F.lit("</li><li class='li-1-details-color'>"), size, F.lit("</li></ul></div><div class='box-accordion-1-left'><ul><li>موديل المركبة</li></ul><ul><li>"), F.col("p_name"),
        F.lit("</li></ul></div><div class='box-banner-car-view-date'><span>03-02-2001</span><span>المشاهدين: "), size, F.lit("</span></div>"
              "<div class='box-accordion-2'><h3>الراحة</h3><ul><li>a</li><li>b</li><li>a</li></ul></div><div class='box-accordion-3'><h3>أمان</h3><ul><li>abs</li></ul></div>"),
    )
    pages = spread(table(spark, sf, "part")).select(F.col("p_partkey").cast("string").alias("url"), html.alias("html"))
    found = L.accordion_details(P.extract_pages(pages, "accordion"), ["url"])
    return found.select("url", "make", "model", "body_type", "doors", "exterior_color", "year", "date_added", "views", "features", "safety_features")
