"""STR-*, NUM-*, DAT-*, ARR-*, URL-*, JSN-*: column expressions over whole tables and texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from adloom.functions import dates as D
from adloom.functions import fixed_values as V
from adloom.functions import media as M
from adloom.functions import numbers as N
from adloom.functions import text as T
from adloom.plans.registered.base import query, table

# RE2 white space is ASCII; this class lists what Unicode adds.
WS = r"[\s\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


@query(
    "clean_text",
    rf"""
    SELECT doc_id, CASE WHEN t NOT IN ('', '-', '—', '–', 'null', 'None') THEN t END AS cleaned
    FROM (SELECT doc_id, trim(regexp_replace(text, '{WS}+', ' ', 'g')) AS t FROM documents)
    """,
)
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.clean(F.col("text")).alias("cleaned"))


@query(
    "fold_text",
    rf"""
    SELECT doc_id, lower(translate(regexp_replace(text, '^{WS}+|{WS}+$', '', 'g'), 'إأآٱةىـ', 'ااااهي')) AS key FROM documents
    """,
)
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.alias_key(F.col("text")).alias("key"))


@query(
    "first_number",
    r"""
    SELECT doc_id, nullif(regexp_extract(replace(text, ',', ''), '([0-9]+)', 1), '') AS digits,
           TRY_CAST(replace(regexp_extract(text, '([0-9,]*[0-9][0-9,]*|,+)', 1), ',', '') AS DOUBLE) AS amount
    FROM documents
    """,
)
def _(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", N.clean_number(F.col("text")).alias("digits"), N.first_number(F.col("text")).alias("amount")
    )


@query(
    "year_in_text",
    r"""
    SELECT doc_id, TRY_CAST(regexp_extract(text, '(?:^|[^\pL\pN_])((?:19[5-9][0-9]|20[012][0-9]))(?:[^\pL\pN_]|$)', 1) AS INT) AS year
    FROM documents
    """,
)
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", N.parse_year(F.col("text")).alias("year"))


def _keyword_case(words: dict[str, str]) -> str:
    return " ".join(f"WHEN contains(t, '{k}') THEN '{v}'" for k, v in words.items())


_WORDS = {"with": "W", "pour": "P", "nicht": "N", "para": "S", "the": "T"}


@query(
    "keyword_detect",
    f"SELECT doc_id, CASE {_keyword_case(_WORDS)} END AS keyword FROM (SELECT doc_id, lower(text) AS t FROM documents)",
)
def _(spark, sf):
    lowered = F.lower("text")
    return table(spark, sf, "documents").select("doc_id", T.detect_keyword(lowered, _WORDS).alias("keyword"))


@query(
    "contact_build",
    """
    SELECT c_custkey,
      CASE WHEN phone IS NULL AND wa IS NULL THEN NULL WHEN phone IS NULL THEN 'WA:' || wa
           WHEN wa IS NULL OR wa = phone THEN phone ELSE phone || ' | WA:' || wa END AS contact,
      coalesce(nullif(phone, '0'), nullif(wa, '0')) AS chosen
    FROM (SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN CAST(c_custkey AS VARCHAR) END AS phone,
                 CASE WHEN c_nationkey < 10 THEN CAST(c_custkey AS VARCHAR) WHEN c_nationkey < 20 THEN CAST(c_nationkey AS VARCHAR) END AS wa
          FROM customer)
    """,
)
def _(spark, sf):
    key, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey")
    phone = F.when(F.col("c_acctbal") > 0, key).otherwise("")
    other = F.when(nation < 10, key).when(nation < 20, nation.cast("string"))
    return table(spark, sf, "customer").select(
        "c_custkey", T.build_contact(phone, other).alias("contact"), T.choose_phone(phone, other).alias("chosen")
    )


@query(
    "contact_by_digits",
    """
    SELECT c_custkey, CASE WHEN c_acctbal <= 0 THEN 'WA:+' || k WHEN c_nationkey < 10 THEN '00 ' || k
                           ELSE '00 ' || k || ' / WA:+' || k END AS contact
    FROM (SELECT *, CAST(c_custkey AS VARCHAR) AS k FROM customer)
    """,
)
def _(spark, sf):
    key = F.col("c_custkey").cast("string")
    phone = F.when(F.col("c_acctbal") <= 0, "null").otherwise(F.concat(F.lit("00 "), key))
    same = F.concat(F.lit("0 0 "), key)
    other = F.when((F.col("c_nationkey") < 10) & (F.col("c_acctbal") > 0), same).otherwise(F.concat(F.lit("+"), key))
    return table(spark, sf, "customer").select("c_custkey", T.contact_by_digits(phone, other).alias("contact"))


@query(
    "ad_title",
    """
    SELECT p_partkey, concat_ws(' ', CASE WHEN p_size < 10 THEN NULL ELSE p_brand END,
                                CASE WHEN p_size < 10 THEN concat(lower(p_brand), ' ', p_name) ELSE p_name END,
                                CAST(1990 + p_size AS VARCHAR), CASE WHEN p_type = 'SMALL' THEN 'جديدة' END,
                                CASE WHEN p_type = 'PROMO' THEN 'للإيجار' ELSE 'للبيع' END,
                                CASE WHEN p_size < 40 THEN concat('في ', p_type) END) AS title
    FROM part
    """,
)
def _(spark, sf):
    kind = F.col("p_type")
    model = F.when(F.col("p_size") < 10, F.concat(F.lower("p_brand"), F.lit(" "), "p_name")).otherwise(F.col("p_name"))
    title = T.build_ad_title(
        F.col("p_brand"), model, 1990 + F.col("p_size"),
        F.when(kind == "PROMO", "إيجار").otherwise("بيع"),
        F.when(F.col("p_size") < 40, kind), F.when(kind == "SMALL", "جديدة").otherwise("مستعملة"),
    )
    return table(spark, sf, "part").select("p_partkey", title.alias("title"))


@query(
    "listing_type",
    """
    SELECT p_partkey, CASE WHEN p_type IN ('PROMO', 'SMALL') THEN 'للإيجار' ELSE 'للبيع' END AS by_title,
           CASE WHEN p_type = 'PROMO' THEN 'إيجار' ELSE 'بيع' END AS by_code,
           CASE WHEN p_size > 25 THEN 'مستعمل' WHEN p_size > 10 THEN 'جديد' END AS condition
    FROM part
    """,
)
def _(spark, sf):
    kind, size = F.col("p_type"), F.col("p_size")
    word = F.when(kind == "PROMO", " للتأجير").when(kind == "SMALL", " للإيجار").otherwise(" للبيع")
    state = F.when(size > 25, " جديدة مستعملة").when(size > 10, " جديد").otherwise("")
    title = F.concat(F.col("p_name"), word, state)
    code = F.when(kind == "PROMO", "RENT").when(kind == "SMALL", "swap").otherwise("sell")
    return table(spark, sf, "part").select(
        "p_partkey", T.listing_type_of_title(title).alias("by_title"), T.listing_type_of_code(code).alias("by_code"),
        T.condition_of_title(title).alias("condition"),
    )


@query(
    "title_brand_model",
    """
    SELECT p_partkey, CASE WHEN p_size < 10 THEN 'Kia' WHEN p_size < 20 THEN 'Toyota' WHEN p_size < 30 THEN 'Land Rover'
                           ELSE nullif(regexp_extract(p_name, '^([a-z]+)', 1), 'new') END AS brand,
           CASE WHEN p_size < 30 THEN regexp_extract(p_name, '^([a-z]+)', 1)
                WHEN regexp_extract(p_name, '^([a-z]+)', 1) <> 'new' THEN regexp_extract(p_name, '^[a-z]+ ([a-z]+)', 1) END AS model
    FROM part
    """,
)
def _(spark, sf):
    size, name = F.col("p_size"), F.col("p_name")
    title = (
        F.when(size < 10, F.concat(F.lit("KIA "), name, F.lit(" 2015 mazdaspeed")))
        .when(size < 20, F.concat(F.lit("تويوتا "), name, F.lit(" دمشق")))
        .when(size < 30, F.concat(F.lit("land rover "), name, F.lit(" range")))
        .otherwise(name)
    )
    rows = table(spark, sf, "part").select("p_partkey", title.alias("t")).withColumn("brand", T.extract_brand(F.col("t")))
    return rows.select("p_partkey", "brand", T.extract_model(F.col("t"), F.col("brand")).alias("model"))


@query(
    "parse_title",
    """
    SELECT p_partkey, CASE WHEN p_size < 20 THEN 'بي ام دبليو' ELSE regexp_extract(p_name, '^([a-z]+)', 1) END AS make,
           CASE WHEN p_size < 20 THEN p_name ELSE regexp_extract(p_name, '^[a-z]+ (.*)$', 1) END AS model FROM part
    """,
)
def _(spark, sf):
    size, name = F.col("p_size"), F.col("p_name")
    title = F.when(
        size < 20, F.concat(F.lit("للبيع سيارة بي ام دبليو "), name, F.lit(" 2015 مستعملة في دمشق"))
    ).otherwise(F.concat(F.lit("سيارة "), name, F.lit(" زيرو جديدة")))
    parsed = T.parse_title(title)
    return table(spark, sf, "part").select("p_partkey", parsed["make"].alias("make"), parsed["model"].alias("model"))


@query(
    "bilingual_text",
    """
    SELECT p_partkey, 'كيا' AS arabic, CASE WHEN p_size < 25 THEN 'روج' ELSE p_name END AS native,
           upper(p_brand) AS make, p_name AS model, p_name AS place
    FROM part
    """,
)
def _(spark, sf):
    name = F.col("p_name")
    compound = F.when(F.col("p_size") < 25, F.concat(name, F.lit(" - روج"))).otherwise(F.concat(name, F.lit(" كل الفئات")))
    pair = T.split_make_model(F.concat(F.upper("p_brand"), F.lit(" ‏> "), name))
    return table(spark, sf, "part").select(
        "p_partkey", T.arabic_only(F.concat(F.lit("كيا "), "p_brand")).alias("arabic"),
        T.strip_foreign(compound).alias("native"), pair["make"].alias("make"), pair["model"].alias("model"),
        T.last_breadcrumb(F.concat(F.lit("ريف دمشق ‏> "), name)).alias("place"),
    )


@query(
    "prices_and_mileage",
    r"""
    SELECT l_orderkey, l_partkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS price,
           CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) AS digits,
           format('{:,}', CAST(floor(l_extendedprice) AS BIGINT)) AS commas,
           CASE WHEN l_linenumber < 4 THEN CAST(CAST(l_quantity AS INT) * 1000 AS VARCHAR) ELSE CAST(CAST(l_quantity AS INT) * 100 AS VARCHAR) END AS mileage,
           CASE WHEN CAST(l_quantity AS INT) * 20 BETWEEN 100 AND 1000000 THEN concat(CAST(CAST(l_quantity AS INT) * 20 AS VARCHAR), ' km') END AS driven
    FROM lineitem
    """,
)
def _(spark, sf):
    quantity = F.col("l_quantity").cast("int")
    price = F.concat(F.lit("$"), F.format_number(F.col("l_extendedprice").cast("decimal(18,2)"), 2))
    whole = F.concat(F.lit("السعر "), F.format_number(F.floor("l_extendedprice"), 0), F.lit(" دولار"))
    mileage = F.when(F.col("l_linenumber") < 4, F.concat(quantity.cast("string"), F.lit(" ألف كم"))).otherwise(
        F.concat(F.format_number(quantity * 100, 0), F.lit(" KM "))
    )
    driven = F.concat(F.lit("only "), (quantity * 20).cast("string"), F.lit("km since 2015"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", N.parse_price(price).alias("price"),
        N.price_digits(whole).alias("digits"), N.price_with_commas(whole).alias("commas"),
        N.clean_mileage(mileage).alias("mileage"), N.extract_mileage(driven).alias("driven"),
    )


@query(
    "date_formats",
    """
    SELECT o_orderkey, d AS iso, d AS named, d AS compact, d AS day_first, d AS argument,
           DATE '2001-01-01' - CAST(o_custkey % 30 AS INT) * 7 AS relative
    FROM (SELECT *, CAST(o_orderdate AS DATE) AS d FROM orders)
    """,
)
def _(spark, sf):
    day = F.col("o_orderdate").cast("date")
    months = [k for k, _ in list(V.MONTH_NAMES.items())[:12]]
    name = F.element_at(F.array(*[F.lit(m) for m in months]), F.month(day))
    named = F.concat(name, F.lit(" "), F.dayofmonth(day).cast("string"), F.lit("، "), F.year(day).cast("string"))
    ago = F.concat(F.lit("منذ "), (F.col("o_custkey") % 30).cast("string"), F.lit(" أسابيع"))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        D.iso_date(F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T08:12:39.000000Z"))).alias("iso"),
        D.month_name_date(named).alias("named"),
        D.compact_date(F.date_format(day, "yyyyMMddHHmm")).alias("compact"),
        D.day_first_date(F.concat(F.lit("added "), F.date_format(day, "dd-MM-yyyy"))).alias("day_first"),
        D.date_argument(F.date_format(day, "dd-MM-yyyy")).alias("argument"),
        D.relative_date(F.lit(""), ago, F.lit("2001-01-01").cast("date")).alias("relative"),
    )


@query(
    "page_text",
    rf"""
    SELECT page_id, nullif(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
        replace(replace(replace(replace(replace(
          regexp_replace(regexp_replace(html, '(?i)(<br\s*/?>|</(?:p|div|li)\s*>)', '\1' || chr(10), 'g'),
                         '(?s)<!--.*?-->|<[^>]*>', '', 'g'),
          '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'),
      '\r\n?', chr(10), 'g'), '[^\S\n]+(\n)', '\1', 'g'), '[^\S\n]+$', ''), '\n\n\n+', chr(10) || chr(10), 'g'),
      ' ' || chr(10)), '') AS text
    FROM pages
    """,
)
def _(spark, sf):
    return table(spark, sf, "pages").select("page_id", T.html_to_text(F.col("html")).alias("text"))


@query(
    "image_urls",
    """
    SELECT l_orderkey, l_partkey, l_linenumber,
           'http://site.example/wp/' || CAST(l_partkey AS VARCHAR) || '.jpg' AS original,
           'http://cdn.example/new/high/' || CAST(l_partkey AS VARCHAR) AS better,
           'https://img.example/a b/' || CAST(l_partkey AS VARCHAR) AS unwrapped,
           'https://site.example/car/' || CAST(l_partkey AS VARCHAR) AS absolute,
           CAST(l_partkey AS VARCHAR) AS slug
    FROM lineitem
    """,
)
def _(spark, sf):
    key = F.col("l_partkey").cast("string")
    size = F.concat(F.lit("-"), (F.col("l_quantity").cast("int") + 100).cast("string"), F.lit("x768.jpg?v=3"))
    proxy = F.concat(F.lit("/_next/image?url=https%3A%2F%2Fimg.example%2Fa%20b%2F"), key, F.lit("&w=640"))
    absolute = M.absolute_url(F.concat(F.lit("/car/"), key), "https://site.example/")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber",
        M.original_image_url(F.concat(F.lit("http://site.example/wp/"), key, size)).alias("original"),
        M.better_quality(F.concat(F.lit("http://cdn.example/new/low/"), key)).alias("better"),
        M.unwrap_image_url(proxy).alias("unwrapped"), absolute.alias("absolute"),
        M.last_segment(F.concat(absolute, F.lit("/")), "/car/").alias("slug"),
    )


_NOISE = " OR ".join(f"contains(lower(u), '{w}')" for w in V.IMAGE_NOISE)


@query(
    "image_filter",
    f"""
    WITH links AS (SELECT page_id, list_transform(regexp_extract_all(html, '(?i)<a\\s[^>]*?href="([^"]*)"', 1),
                          lambda x: 'https://photos.example/cars' || x || '.jpg') AS urls FROM pages),
    kept AS (SELECT page_id, list_filter(urls, lambda u: length(u) > 30 AND NOT ({_NOISE})) AS urls FROM links)
    SELECT page_id, coalesce(array_to_string(list_sort(list_distinct(urls)), ' '), '') AS photos, urls[1] AS cover FROM kept
    """,
)
def _(spark, sf):
    links = F.regexp_extract_all("html", F.lit(r'(?i)<a\s[^>]*?href="([^"]*)"'), 1)
    urls = F.transform(links, lambda x: F.concat(F.lit(" https://photos.example/cars"), x, F.lit(".jpg ")))
    kept = M.keep_photos(urls)
    return table(spark, sf, "pages").select(
        "page_id", F.array_join(F.sort_array(kept), " ").alias("photos"), M.cover_url(F.array().cast("array<string>"), kept).alias("cover")
    )


@query(
    "json_contacts",
    """
    SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 'p' || CAST(c_custkey AS VARCHAR) ELSE 'top' END AS phone,
           CASE WHEN c_nationkey < 12 THEN CAST(c_nationkey AS VARCHAR) END AS whatsapp
    FROM customer
    """,
)
def _(spark, sf):
    inner = F.struct(
        F.when(F.col("c_acctbal") > 0, F.concat(F.lit("p"), F.col("c_custkey").cast("string"))).alias("mobile"),
        F.when(F.col("c_nationkey") < 12, F.col("c_nationkey")).alias("wa_number"),
    )
    body = F.to_json(F.struct(F.lit("top").alias("tel"), inner.alias("result")))
    found = M.contact_from_json(body)
    return table(spark, sf, "customer").select("c_custkey", found["phone"].alias("phone"), found["whatsapp"].alias("whatsapp"))


def _spelled(text: str) -> str:
    """Letter by letter in SQL: digraphs are marked first, every letter is then replaced once."""
    sql = text
    for i, latin in enumerate(V.DIGRAPHS):
        sql = f"replace({sql}, '{latin}', chr({0xE000 + i}))"
    for letter, arabic in V.LETTERS.items():
        sql = f"replace({sql}, '{letter}', '{arabic}')"
    for i, arabic in enumerate(V.DIGRAPHS.values()):
        sql = f"replace({sql}, chr({0xE000 + i}), '{arabic}')"
    return sql


@query("transliterate", f"SELECT p_name, {_spelled('p_name')} AS arabic FROM (SELECT DISTINCT p_name FROM part)")
def _(spark, sf):
    names = table(spark, sf, "part").select("p_name").distinct()
    return names.select("p_name", T.transliterate(F.col("p_name")).alias("arabic"))
