"""Raw cards and page facts to typed listings (PRJ-1, PRJ-2, EXT-6, EXT-7)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.functions import fixed_values as V
from adloom.functions import numbers as N
from adloom.functions import text as T
from adloom.functions.dates import day_first_date, iso_date
from adloom.functions.markup import once
from adloom.functions.media import images_to_json, original_image_url, whatsapp_number
from adloom.operators.pages import (
    NO_NOTES, card_date, feature_list, field, page_date, page_vehicle, phone_of_link, settle_pairs,
    split_features,
)
from adloom.operators.specs import with_specs
from adloom.sources.schemas import COLUMNS
from adloom.sources.tables import to_cells


def parse_listings(
    raw: DataFrame, labels: Mapping[str, str] = V.GENERIC_LABELS, as_of: Column | None = None
) -> DataFrame:
    """PRJ-1: the unified 27 columns. A structured value wins over what the free text suggests.

    ``raw`` has the columns of ``schemas.RAW_CARD``; of several labels for a field the last wins.
    ``as_of`` fills a missing ``scraped_at``.
    """
    spec = lambda name: T.blank_to_null(F.col(f"s_{name}"))
    title, text = F.coalesce(T.strip(F.col("title_raw")), F.lit("")), T.strip(F.col("description_raw"))
    text = F.coalesce(text, F.lit(""))
    fields = {f for f in labels.values() if not f.startswith("_")}
    wanted = dict(labels)
    for name in ("brand", "model", "year", "mileage", "fuel_type", "transmission", "condition",
                 "location", "body_type", "engine", "cylinders", "color", "interior_color",
                 "doors", "vin", "specs_category", "drive_system"):
        if name not in fields:
            wanted[f"\x00{name}"] = name  # a label no page has, so that every column exists
    specs = with_specs(raw, "specs", wanted, keep="last", prefix="s_")
    specs = specs.withColumns({f"s_{f}": T.strip(F.col(f"s_{f}")) for f in {*wanted.values()}
                               if not f.startswith("_")})
    lowered = F.lower(F.concat_ws(" ", title, text))
    brand = T.brand_in_english(F.coalesce(spec("brand"), T.extract_brand(title)))
    stage = specs.withColumn("brand", brand)
    stamp = F.current_timestamp().cast("string") if as_of is None else as_of
    stage = stage.withColumns(
        {
            "model": F.coalesce(spec("model"), T.extract_model(title, F.col("brand"))),
            "year": F.coalesce(N.parse_year(spec("year")), N.parse_year(title)),
            "location": F.coalesce(spec("location"), T.clean(F.col("location_raw"), [])),
            "condition": F.coalesce(
                spec("condition"), T.detect_keyword(lowered, V.CONDITION_KEYWORDS)
            ),
            "listing_type": T.listing_type_of_code(F.col("listing_type")),
        }
    )
    return stage.select(
        F.coalesce(F.col("scraped_at"), stamp).alias("scraped_at"),
        F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce("id", F.lit("")).alias("id"),
        F.coalesce(spec("specs_category"), F.col("category")).alias("category"),
        images_to_json(F.filter("images", lambda x: x != "")).alias("images"),
        "listing_type", "condition",
        spec("body_type").alias("body_type"),
        "brand", "model",
        N.parse_price(F.col("price_raw")).alias("price"),
        "location", "year",
        F.coalesce(
            spec("transmission"), T.detect_keyword(lowered, V.TRANSMISSION_KEYWORDS)
        ).alias("transmission"),
        F.coalesce(spec("fuel_type"), T.detect_keyword(lowered, V.FUEL_KEYWORDS)).alias("fuel_type"),
        F.coalesce(spec("mileage"), N.extract_mileage(text), N.extract_mileage(title)).alias("mileage"),
        spec("engine").alias("engine"),
        spec("cylinders").alias("cylinders"),
        spec("color").alias("color"),
        spec("interior_color").alias("interior_color"),
        spec("doors").alias("doors"),
        T.validate_vin(spec("vin")).alias("vin"),
        T.clean(text, []).alias("description"),
        "seller_name",
        T.build_contact(F.col("phone"), F.col("whatsapp")).alias("contact"),
        spec("drive_system").alias("drive_system"),
        T.build_ad_title(
            F.col("brand"), F.col("model"), F.col("year"), F.col("listing_type"),
            F.col("location"), F.col("condition"),
        ).alias("ad_title"),
    )


def project_source(df: DataFrame, profile: str, as_text: bool = False) -> DataFrame:
    """PRJ-2: the fixed columns of a profile in order; missing ones are NULL (blank as text)."""
    columns = COLUMNS[profile]
    if as_text:
        return to_cells(df, columns)
    return df.select(
        *[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns]
    )


def _foreign(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns(
        {n: once(T.strip_foreign(F.col(n)), T.blank_to_null) for n in names if n in df.columns}
    )


PORTAL_COMPOUNDS = [
    "make", "model", "body_type", "fuel_type", "transmission", "condition", "city",
    "exterior_color", "interior_color",
]


def portal_listings(
    facts: DataFrame, source: Column, listing_id: Column, url: Column, images_under: str = "http",
    card_day: Column | None = None, card_day_first: bool = False,
) -> DataFrame:
    """EXT-6: portal detail pages (facts of source ``portal``) to listings.

    Condition comes from the title before the specs. ``card_day`` is the date of the listing page;
    with ``card_day_first`` (MRG-5) it overrides the page's own date instead of filling it.
    """
    title = T.clean_dashes(field("title_raw"))
    kept = [c for c in facts.columns if c not in ("profiles",)]
    base = facts.select(*kept).withColumns(
        {
            "ad_title": title, "source": source, "listing_id": listing_id, "car_url": url,
            "id": T.listing_key(source, listing_id),
        }
    )
    cleaned = F.transform(
        "pairs",
        lambda p: F.struct(p["pos"].alias("pos"), T.clean_dashes(p["label"]).alias("label"),
                           T.clean_dashes(p["value"]).alias("value")),
    )
    base = with_specs(base.withColumn("_specs", cleaned), "_specs", V.PORTAL_LABELS)
    number = whatsapp_number(field("whatsapp_link"))
    phone = F.coalesce(T.clean_dashes(field("phone")), phone_of_link())
    photos = F.array_distinct(
        F.filter(F.transform("images", original_image_url), lambda u: u.startswith(images_under))
    )
    dates = [page_date()]
    if card_day is not None:
        dates = [card_day, *dates] if card_day_first else [*dates, card_day]
    base = base.withColumns(
        {
            "listing_type": T.listing_type_of_title(F.coalesce(title, F.lit(""))),
            "condition": F.coalesce(T.condition_of_title(title), F.col("condition")),
            "price": N.price_digits(field("price_raw"), keep_junk=False),
            "views": T.blank_to_null(F.regexp_extract(field("views_raw"), r"(\d+)", 1)),
            "mileage": N.clean_mileage(F.col("mileage")),
            "description": T.clean_dashes(field("description_raw")),
            "seller_name": T.clean_dashes(field("seller_name")),
            "seller_notes": T.clean(field("seller_notes"), NO_NOTES),
            "seller_type": F.when(
                field("dealer_link").contains("/dealer/"), F.lit("dealer")
            ).otherwise(F.lit("private")),
            "phone": T.contact_by_substring(phone, number),
            "date_added": F.coalesce(*dates),
            "image_urls": photos, "image_count": F.size(photos),
        }
    )
    return _foreign(base, PORTAL_COMPOUNDS).drop("fields", "pairs", "images", "features", "dates",
                                                 "scripts", "_specs")


def portal_cards(cards: DataFrame, base_url: str) -> DataFrame:
    """Listing-page cards of the portal: id, absolute link, date."""
    link = field("car_url")
    absolute = F.when(link.startswith("http"), link).otherwise(
        F.concat(F.lit(base_url.rstrip("/") + "/"), F.regexp_replace(link, "^/+", ""))
    )
    return cards.select(
        field("data-listing-id").alias("listing_id"), absolute.alias("car_url"),
        card_date().alias("date_added"),
    ).filter("listing_id IS NOT NULL AND car_url IS NOT NULL")


def grid_cards(cards: DataFrame, source: Column) -> DataFrame:
    """Listing-page cards of the grid site."""
    parts = T.split_make_model(T.clean(field("make_model")))
    title = T.clean(field("ad_title"))
    link = field("href")
    slug = F.when(
        link.contains("/listing/"), F.substring_index(F.regexp_replace(link, "/+$", ""), "/listing/", -1)
    ).otherwise(field("data-ad-id"))
    cover = field("cover_image_url")
    return cards.select(
        F.concat(source, F.lit("_"), field("data-ad-id")).alias("id"), source.alias("source"),
        link.alias("car_url"), field("data-ad-id").alias("listing_id"), slug.alias("slug"),
        title.alias("ad_title"),
        T.listing_type_of_title(F.coalesce(title, F.lit("")), V.RENT_WORDS_SHORT).alias("listing_type"),
        T.blank_to_null(parts["make"]).alias("make"), T.blank_to_null(parts["model"]).alias("model"),
        N.clean_year(F.regexp_replace(T.clean(field("year")), r"(?U)^موديل\s*", "")).alias("year"),
        T.strip_km(T.clean(field("mileage"))).alias("mileage"),
        T.clean(field("transmission")).alias("transmission"),
        T.clean(field("city")).alias("city"),
        N.price_digits(T.clean(field("price"))).alias("price"),
        T.clean(field("description")).alias("description"),
        F.when(~cover.startswith("%"), cover).alias("cover_image_url"),
    ).filter("listing_id IS NOT NULL AND car_url IS NOT NULL")


def grid_details(facts: DataFrame, key: Sequence[str]) -> DataFrame:
    """EXT-7: detail pages of the grid site; numeric cells keep their digits only."""
    specs = with_specs(
        facts.withColumn("_specs", settle_pairs(F.filter("pairs", lambda p: p["strategy"] == "table"))),
        "_specs", V.GRID_LABELS, keep="last",
    )
    person = F.filter("profiles", lambda h: h.rlike(r"/users/\d{9,}"))
    phone = F.regexp_extract(F.try_element_at(person, F.lit(1)), r"/users/(\d{9,})", 1)
    path = field("city_path")
    sections = {name: feature_list(section) for section, name in V.FEATURE_SECTIONS.items()}
    return specs.select(
        *key,
        *[T.clean(F.col(f)).alias(f) for f in sorted(set(V.GRID_LABELS.values()))
          if f not in ("price", "listing_id")],
        N.price_digits(T.clean(F.col("price"))).alias("price"),
        T.blank_to_null(F.regexp_extract("listing_id", r"(\d{5,})", 1)).alias("listing_id"),
        T.clean(field("seller_name")).alias("seller_name"),
        T.blank_to_null(phone).alias("phone"),
        F.when(path.rlike("[>＞]"), T.last_breadcrumb(path)).alias("city_detail"),
        *[T.blank_to_null(F.array_join(v, ", ")).alias(n) for n, v in sections.items()],
    )


def merge_grid(cards: DataFrame, details: DataFrame, key: str = "car_url") -> DataFrame:
    """MRG-3: non-empty detail values win; the finer city is used only where the card has none."""
    joined = cards.join(
        details.select(key, *[F.col(c).alias(f"d_{c}") for c in details.columns if c != key]),
        key, "left",
    )
    out = {}
    for name in [c for c in details.columns if c not in (key, "city_detail")]:
        detail = F.col(f"d_{name}")
        if name in cards.columns:
            card = F.col(name)
            out[name] = F.coalesce(T.blank_to_null(detail.cast("string")), card.cast("string"))
        else:
            out[name] = detail
    merged = joined.withColumns(out)
    city = F.coalesce(T.blank_to_null(F.col("city")), F.col("d_city_detail"))
    merged = merged.withColumns(
        {
            "city": city,
            "year": N.clean_year(F.col("year")),
            "mileage": T.strip_km(F.col("mileage")),
            "engine_size": T.strip_cc(F.col("engine_size")),
            "engine_power": T.strip_hp(F.col("engine_power")),
            "date_added": iso_date(F.col("date_added")),
        }
    ).drop(*[f"d_{c}" for c in details.columns if c != key])
    return merged.withColumns(
        {f: T.rewrite_other(F.col(f)) for f in V.OTHER_FIELDS if f in merged.columns}
    )


def accordion_cards(cards: DataFrame, source: Column) -> DataFrame:
    """Listing-page cards of the accordion site."""
    parts = T.split_subtitle(F.coalesce(field("subtitle"), F.lit("")))
    return cards.select(
        T.strip(field("id")).alias("id"), source.alias("source"), field("car_url").alias("car_url"),
        T.arabic_only(field("make")).alias("make"), parts["model"].alias("model"),
        parts["body_type"].alias("body_type"), parts["year"].alias("year"),
        T.strip_km(field("mileage")).alias("mileage"), field("city").alias("city"),
        field("fuel_type").alias("fuel_type"), field("origin").alias("origin"),
        field("transmission").alias("transmission"), field("condition").alias("condition"),
        N.clean_number(field("price")).alias("price"), F.col("images").alias("card_images"),
    ).filter("id <> '' AND car_url <> ''")


def accordion_details(facts: DataFrame, key: Sequence[str]) -> DataFrame:
    """EXT-7: detail pages of the accordion site; the spec columns win over JSON-LD."""
    specs = with_specs(
        facts.withColumn("_specs", F.filter("pairs", lambda p: p["strategy"] == "list")),
        "_specs", V.ACCORDION_LABELS,
    ).withColumn("_ld", page_vehicle())
    general, safety = split_features()
    ld = lambda name: F.col(f"_ld.{name}")
    both = {"body_type", "exterior_color", "fuel_type", "model", "transmission"}
    plain = [f for f in dict.fromkeys(V.ACCORDION_LABELS.values()) if f != "make"]
    dated = field("dated")
    code = F.regexp_replace(field("listing_code"), r"ID\s*:", "")
    return specs.select(
        *key,
        T.arabic_only(F.coalesce(F.col("make"), ld("make"))).alias("make"),
        *[(F.coalesce(F.col(f), ld(f)) if f in both else F.col(f)).alias(f) for f in plain],
        ld("year").alias("year"), ld("price").alias("price"),
        day_first_date(dated).alias("date_added"),
        T.blank_to_null(F.regexp_extract(dated, r"(?U)المشاهدين[:\s]*(\d+)", 1)).alias("views"),
        field("description_raw").alias("description_original"),
        field("city").alias("city"), T.strip_km(field("mileage")).alias("mileage"),
        F.coalesce(phone_of_link(), field("script_phone")).alias("phone"), T.strip(code).alias("listing_id"),
        field("seller_name").alias("seller_name"), field("seller_type").alias("seller_type"),
        T.blank_to_null(F.regexp_extract(field("seller_listings"), r"(\d+)", 1)).alias("seller_listings"),
        F.array_join(general, "|").alias("features"), F.array_join(safety, "|").alias("safety_features"),
        F.array_join("images", ", ").alias("images_original_links"),
    )


def raw_cards(cards: DataFrame, source: Column, listing_type: str = "sell") -> DataFrame:
    """Raw cards (``schemas.RAW_CARD``) of the tile and column layouts; Arabic rule names are labels.

    A year or mileage that a tile keeps in its bullet list becomes a spec as well.
    """
    labels = ["الماركة", "الموديل", "الفئة", "السنة", "الكيلومترات", "ناقل الحركة", "نوع الوقود"]
    years = F.filter("items", lambda x: x.rlike(r"\b\d{4}\b"))
    driven = F.filter(
        "items",
        lambda x: ~x.rlike(r"\b\d{4}\b") & (x.contains(V.KM_UNIT) | F.lower(x).contains("km")),
    )
    listed = {"السنة": F.try_element_at(years, F.lit(-1)),
              "الكيلومترات": F.try_element_at(driven, F.lit(-1))}
    specs = F.array(
        *[
            F.struct(
                F.lit(i).alias("pos"), F.lit(name).alias("label"),
                F.coalesce(field(name), listed.get(name, F.lit(None).cast("string"))).alias("value"),
            )
            for i, name in enumerate(labels)
        ]
    )
    link = field("whatsapp_link")
    ad_id = T.blank_to_null(F.regexp_extract(link, r"/ads/([^&?]+)", 1))
    place = F.split(field("place"), r"\|")
    return cards.select(
        source.alias("source"), F.concat(source, F.lit("_"), ad_id).alias("id"),
        F.lit(None).cast("string").alias("scraped_at"), F.lit(listing_type).alias("listing_type"),
        field("title_raw").alias("title_raw"), field("price_raw").alias("price_raw"),
        F.coalesce(field("location_raw"), T.strip(F.try_element_at(place, F.lit(1)))).alias("location_raw"),
        F.lit(None).cast("string").alias("description_raw"), F.lit(None).cast("string").alias("category"),
        F.coalesce(field("parent_url"), field("href")).alias("ad_url"), ad_id.alias("ad_id"),
        F.filter(specs, lambda p: p["value"].isNotNull()).alias("specs"), "images",
        F.lit(None).cast("string").alias("phone"), whatsapp_number(link).alias("whatsapp"),
        F.lit(None).cast("string").alias("seller_name"),
        T.strip(F.try_element_at(place, F.lit(2))).alias("posted_date"),
    )

