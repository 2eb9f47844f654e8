"""Nested API items to flat listings (PRJ-5, PRJ-6). Items are variants; see ``sources.envelope``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.functions import fixed_values as V
from adloom.functions import media as M
from adloom.functions import numbers as N
from adloom.functions import text as T
from adloom.functions.dates import iso_date, relative_date
from adloom.functions.markup import once
from adloom.operators.specs import field_value, mine_description
from adloom.sources.envelope import ITEMS, first_truthy, member, members, object_type, with_texts
from adloom.sources.schemas import COLUMNS

def _image_list(value: Column) -> Column:
    """ARR-2: list of strings or objects, or one text with blanks between URLs."""
    entries = F.transform(F.try_variant_get(value, "$", ITEMS), M.image_entry_url)
    text = F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))
    empty = F.array().cast("array<string>")
    return F.coalesce(M.usable_image_urls(entries), M.images_from_text(text), empty)


def _translated(c: Column, entries: Mapping[str, str]) -> Column:
    """JN-6, plain-key variant, for text that is clean already."""
    return F.coalesce(T.map_value(F.lower(c), entries), c)


# --- classified items ----------------------------------------------------------------------------
CLASSIFIED_PATHS = {
    "listing_id": ["id"],
    "ad_title": ["title_ar", "title_en", "name"],
    "condition": ["condition"],
    "body_type": ["body_type"],
    "status": ["status"],
    "make": ["brand.parent.name_ar", "brand.parent.name"],
    "model": ["brand.name_ar", "brand.name"],
    "year": ["year"],
    "exterior_color": ["external_color", "exterior_color", "color"],
    "interior_color": ["internal_color", "interior_color"],
    "fuel_type": ["fuel_type"],
    "engine_size": ["engine_capacity", "engine_size", "engine"],
    "cylinders": ["number_of_cylinders", "cylinders"],
    "transmission": ["transmission"],
    "drive_system": ["drive_line", "drive_system", "drivetrain"],
    "origin": ["source", "origin"],
    "specifications": ["specifications", "specs"],
    "city": ["city", "location"],
    "mileage": ["kilometers_parsed", "mileage", "odometer"],
    "price": ["price"],
    "views": ["views_count", "views"],
    "featured": ["is_featured", "featured"],
    "phone": ["user.phone"],
    "seller_name": ["user.name", "user.full_name"],
    "description": ["description", "notes"],
}
CLASSIFIED_CODES = {
    "condition": V.CONDITIONS_EN, "body_type": V.BODIES_EN, "exterior_color": V.COLORS_EN,
    "interior_color": V.COLORS_EN, "fuel_type": V.CLASSIFIED_FUELS,
    "transmission": V.CLASSIFIED_TRANSMISSIONS, "drive_system": V.CLASSIFIED_DRIVES,
    "origin": V.CLASSIFIED_ORIGINS, "specifications": V.CLASSIFIED_SPECIFICATIONS,
    "city": V.CLASSIFIED_CITIES,
}


def flatten_classified(df: DataFrame, source: str, url_template: str, item: str = "item", listing: str | None = None) -> DataFrame:
    """PRJ-5, raw form: columns of profile ``classified_raw``.

    ``item`` is the detail variant; every key it lacks is taken from the ``listing`` variant, while a
    key it has wins even when blank (MRG-2). English codes are translated. ``url_template`` holds
    ``{id}``.
    """
    items = [F.col(item)] + ([F.col(listing)] if listing else [])
    staged = df.withColumn("_images", _image_list(member("images", *items)))
    texts = with_texts(
        staged, CLASSIFIED_PATHS, *items, plain=["listing_id", "price", "views", "featured"]
    )
    texts = texts.withColumns({f: _translated(F.col(f), m) for f, m in CLASSIFIED_CODES.items()})
    key = T.strip(F.coalesce("listing_id", F.lit("")))
    computed = {
        "id": F.concat(F.lit(f"{source}_"), key),
        "source": F.lit(source),
        "car_url": F.when(key != "", F.replace(F.lit(url_template), F.lit("{id}"), key)),
        "listing_id": key,
        "listing_type": F.lit(V.FOR_SALE),
        "price": N.price_digits(F.col("price")),
        "date_added": F.lit(None).cast("date"),
        "scraped_at": F.lit(None).cast("string"),
        "featured": F.when(F.col("featured").isNotNull(), F.lit("True")).otherwise(F.lit("False")),
        "image_urls": F.col("_images"),
        "image_count": F.size("_images"),
    }
    return texts.select(
        *[computed.get(c, F.col(c)).alias(c) for c in COLUMNS["classified_raw"]]
    )


WIDE_PATHS = {
    "created_en": ["created_at_en"],
    "created_ar": ["created_at_ar"],
    "ad_title": ["title_ar", "title_en"],
    "brand": ["brand.parent.name_ar", "brand.parent.name_en", "brand.name_ar", "brand.name_en"],
    "model": ["brand.name_ar", "brand.name_en"],
    "price": ["price"],
    "location": ["city"],
    "year": ["year"],
    "drive_system": ["drive_line"],
    "transmission": ["transmission"],
    "fuel_type": ["fuel_type"],
    "engine": ["engine_capacity"],
    "cylinders": ["number_of_cylinders"],
    "color": ["external_color"],
    "interior_color": ["internal_color"],
    "description": ["description"],
    "origin": ["source"],
    "specifications": ["specifications"],
    "seller_name": ["user.name"],
    "contact": ["user.phone"],
}


def flatten_classified_wide(df: DataFrame, source: str, base_url: str, as_of: Column, item: str = "item") -> DataFrame:
    """PRJ-5, wide form: columns of profile ``classified_wide``; relative dates count from ``as_of``."""
    it = F.col(item)
    listed = F.try_variant_get(it, "$.images", ITEMS)
    links = F.filter(
        F.transform(listed, lambda v: F.try_variant_get(v, "$", "string")),
        lambda u: u.startswith("http"),
    )
    staged = df.withColumns(
        {
            "_links": F.transform(links, lambda u: M.better_quality(u)),
            "_key": F.coalesce(F.try_variant_get(it, "$.id", "string"), F.lit("")),
            "mileage": F.try_variant_get(it, "$.kilometers", "string"),
        }
    )
    coded = ["drive_system", "transmission", "fuel_type", "origin", "specifications"]
    texts = with_texts(staged, WIDE_PATHS, it, plain=["created_en", "created_ar", "price", *coded])
    texts = texts.withColumns({c: T.strip(F.col(c)) for c in coded})
    code = lambda name, entries: F.coalesce(T.map_value(F.col(name), entries), F.col(name))
    extra = lambda name, entries, label: F.concat(F.lit(label), T.map_value(F.col(name), entries))
    computed = {
        "date_added": relative_date(F.col("created_en"), F.col("created_ar"), as_of),
        "source": F.lit(source),
        "id": F.concat(F.lit(f"{source}_"), F.col("_key")),
        "category": F.lit("cars"),
        "listing_type": F.lit(V.FOR_SALE),
        "price": T.blank_to_null(F.regexp_replace("price", r"(?U)[^\d.]", "")),
        "location": F.coalesce(T.map_value(F.lower("location"), V.WIDE_CITIES), F.col("location")),
        "drive_system": code("drive_system", V.WIDE_DRIVES),
        "transmission": code("transmission", V.WIDE_TRANSMISSIONS),
        "fuel_type": code("fuel_type", V.WIDE_FUELS),
        "description": T.blank_to_null(
            F.concat_ws(
                " | ", "description", extra("origin", V.WIDE_ORIGINS, V.ORIGIN_LABEL),
                extra("specifications", V.WIDE_SPECIFICATIONS, V.SPECIFICATION_LABEL),
            )
        ),
        "contact": T.with_plus(F.col("contact")),
        "images_original_links": F.array_join("_links", ", "),
        "car_url": F.concat(F.lit(f"{base_url.rstrip('/')}/cars/"), F.col("_key")),
    }
    none = F.lit(None).cast("string")
    return texts.select(
        *[
            computed.get(c, F.col(c) if c in texts.columns else none).alias(c)
            for c in COLUMNS["classified_wide"]
        ]
    )


# --- adverts -----------------------------------------------------------------------------------------
FEATURED_KEYS = ["featured_fields", "featuredAttributes", "featured_attributes"]
DIRECT_FIELDS = [
    ("year", "year"), ("color", "exterior_color"), ("exterior_color", "exterior_color"),
    ("interior_color", "interior_color"), ("fuel_type", "fuel_type"),
    ("transmission", "transmission"), ("condition", "condition"), ("engine_size", "engine_size"),
    ("body_type", "body_type"), ("drive_system", "drive_system"), ("doors", "doors"),
    ("cylinders", "cylinders"), ("chassis_number", "chassis_number"), ("mileage", "mileage"),
]
CODED_FIELDS = {
    "condition": V.CONDITIONS_EN, "transmission": V.ADVERT_TRANSMISSIONS,
    "fuel_type": V.ADVERT_FUELS, "body_type": V.BODIES_EN, "drive_system": V.ADVERT_DRIVES,
}


ATTRIBUTE_PATHS = {
    "slug": ["slug", "key"],
    "label": ["name_ar", "label_ar", "name"],
    "text": ["value_ar", "value", "val", "display_value"],
}


FORM_LABELS = ["field_name_ar", "name_ar"]
# An attribute as it is read: the members that count, as variants.
ATTRIBUTE = object_type({
    "template_field": object_type(dict.fromkeys(["slug", *FORM_LABELS], "variant")),
    **{key: "variant" for keys in ATTRIBUTE_PATHS.values() for key in keys},
})


def attribute_pairs(attributes: Column) -> Column:
    """Attribute variants, nested or flat, as ``(field, value)``; unspecified values are dropped."""
    return _pairs(F.transform(attributes, lambda a: F.try_variant_get(a, "$", ATTRIBUTE)))


def _pairs(attributes: Column) -> Column:
    """Pairs of attributes that were read as ``ATTRIBUTE``.

    The slug is looked up before the Arabic label. Transforms follow one another, so that each
    step works on values the step before has bound.
    """

    def texts(a: Column) -> Column:
        form, nested = a["template_field"], a["template_field"].isNotNull()
        spoken = once(members(a["value"], {"ar": "variant", "en": "variant"}), lambda v: F.when(
            v.isNotNull(), first_truthy([v["ar"], v["en"]])).otherwise(F.try_variant_get(a["value"], "$", "string")))
        own = {k: first_truthy([a[key] for key in keys]) for k, keys in ATTRIBUTE_PATHS.items()}
        return F.struct(
            F.when(nested, first_truthy([form["slug"]])).otherwise(own["slug"]).alias("slug"),
            F.when(nested, first_truthy([form[k] for k in FORM_LABELS])).otherwise(own["label"]).alias("label"),
            F.when(nested, spoken).otherwise(own["text"]).alias("text"),
        )

    def pair(p: Column) -> Column:
        target = F.coalesce(
            T.map_value(T.strip(p["slug"]), V.ADVERT_SLUGS),
            T.map_value(T.squeeze(p["label"]), V.ADVERT_LABELS),
        )
        # a value whose field is not known is dropped, so it is not made tidy either
        return once(target, lambda f: F.struct(f.alias("field"), F.when(f.isNotNull(), T.squeeze(p["text"])).alias("value")))

    missing = ["", *V.PLACEHOLDERS, *V.UNSPECIFIED]
    found = F.transform(F.transform(attributes, texts), pair)
    return F.filter(found, lambda p: p["field"].isNotNull() & ~T.is_any(p["value"], missing))


def _lists(df: DataFrame, name: str, item: Column, entries: Mapping[str, str]) -> tuple[DataFrame, dict[str, Column]]:
    """The named lists of an item, read together as column ``name``; empty ones are null. ``entries`` has the type of their entries."""
    read = df.withColumn(name, members(item, {key: f"array<{kind}>" for key, kind in entries.items()}))
    lists = {key: F.col(name)[key] for key in entries}
    return read, {key: F.when(F.size(x) > 0, x) for key, x in lists.items()}


def _names(key: str) -> list[str]:
    return [f"{key}.name_ar", f"{key}.name"]


ADVERT_PATHS = {
    "listing_id": ["id", "_id"],
    "slug": ["slug"],
    "ad_title": ["title", "name"],
    "make": [*_names("category"), "make", "brand"],
    "city": [*_names("governorate"), "city"],
    "price": ["price"],
    "date_added": ["createdAt", "created_at", "published_date", "date_added"],
    "phone": ["phone"],
    "whatsapp": ["whatsapp"],
    "description": ["description_ar", "description"],
    "given_model": ["model_ar", "model"],
    "category_model": [*_names("sub_category"), *_names("subCategory")],
    "cover": ["cover_image", "thumbnail"],
}
PERSON_PATHS = {
    "seller_name": ["customer.name", "customer.full_name"],
    "seller_listings": ["customer.totalAds", "customer.ads_count"],
    "creator_name": ["created_by.name", "created_by.full_name"],
    "creator_listings": ["created_by.totalAds", "created_by.ads_count"],
    "customer": ["customer"],
}


def flatten_advert(
    df: DataFrame,
    source: str,
    url_prefix: str,
    item: str = "item",
    detail: str | None = None,
    form: str = "raw",
) -> DataFrame:
    """PRJ-6: advert items to flat listings, ``form`` raw or production.

    ``detail`` names a variant column with the attribute list of the detail endpoint; its attributes
    come first, then featured ones, then plain ones, and the first value of a field stays. Raw form
    also derives make and model from the title, extracts the year, strips units and rewrites
    "other"; production form takes the model from the sub-category or from what the title has left.
    """
    if form not in ("raw", "production"):
        raise ValueError(f"unknown form {form!r}")
    raw_form, it = form == "raw", F.col(item)
    blank = [V.PLACEHOLDERS] if raw_form else [V.PLACEHOLDERS_FOLDED, True]
    tidy = lambda c: once(T.squeeze(c), lambda text: T.unless_placeholder(text, *blank))
    staged, lists = _lists(_with_attributes(df, it, detail), "_photos", it, dict.fromkeys(["gallery", "images", "photos"], "variant"))
    photos = F.transform(F.coalesce(*lists.values()), M.image_entry_url)
    staged = staged.withColumn("_cover", M.cover_url(photos)).drop("_photos")
    direct = {f"direct_{key}": [key] for key, _ in DIRECT_FIELDS}
    kept = ["listing_id", "slug", "price", "date_added", "phone", "whatsapp", "cover", "customer",
            "seller_listings", "creator_listings"]
    texts = with_texts(
        staged, {**ADVERT_PATHS, **PERSON_PATHS, **direct}, it, tidy=tidy, plain=kept
    )
    texts = texts.withColumns({k: T.strip(F.coalesce(k, F.lit(""))) for k in ("listing_id", "slug")})
    key = F.when(F.col("listing_id") != "", F.col("listing_id")).otherwise(F.col("slug"))
    creator = lambda name, other: F.when(F.col("customer").isNull(), F.col(other)).otherwise(F.col(name))
    rented = T.listing_type_of_title(F.coalesce("ad_title", F.lit("")), V.RENT_WORDS_SHORT)
    base = texts.withColumns(
        {
            "id": F.concat(F.lit(f"{source}_"), key),
            "source": F.lit(source),
            "listing_id": T.blank_to_null(F.col("listing_id")),
            "car_url": F.when(F.col("slug") != "", F.concat(F.lit(url_prefix), F.col("slug"))),
            "slug": T.blank_to_null(F.col("slug")),
            "listing_type": rented if raw_form else F.lit(V.FOR_SALE),
            "price": N.price_digits(F.col("price")),
            "date_added": iso_date(F.col("date_added")),
            "phone": T.choose_phone(F.col("phone"), F.col("whatsapp")),
            "seller_name": creator("seller_name", "creator_name"),
            "seller_listings": creator("seller_listings", "creator_listings"),
            "cover_image_url": F.coalesce("_cover", "cover"),
        }
    )
    first = {f: field_value(F.col("_attrs"), f) for f in dict.fromkeys(V.ADVERT_SLUGS.values())}
    for name, target in DIRECT_FIELDS:
        first[target] = F.coalesce(first[target], F.col(f"direct_{name}"))
    flat = base.withColumns(first)
    codes = dict(CODED_FIELDS)
    if not raw_form:
        codes["fuel_type"] = {**V.ADVERT_FUELS, "petrol": V.ADVERT_FUELS["gasoline"]}
    flat = flat.withColumns({f: _translated(F.col(f), entries) for f, entries in codes.items()})
    if raw_form:
        flat = _advert_raw_tail(flat)
    else:
        left = T.model_from_title(F.col("ad_title"), F.col("make"), F.col("year"))
        left = F.when(F.col("make").isNotNull(), left)
        flat = flat.withColumn("model", F.coalesce("category_model", "given_model", left))
    helpers = {"_attrs", "_cover", "cover", "customer", "whatsapp", "given_model", "category_model",
               "creator_name", "creator_listings", item, detail, *direct}
    return flat.select(*[c for c in flat.columns if c not in helpers])


def _with_attributes(df: DataFrame, item: Column, detail: str | None) -> DataFrame:
    """Add ``_attrs``: attribute pairs of the detail, the featured and the plain list, in that order."""
    read, lists = _lists(df, "_lists", item, dict.fromkeys([*FEATURED_KEYS, "attributes"], ATTRIBUTE))
    sources = [F.try_variant_get(F.col(detail), "$", f"array<{ATTRIBUTE}>")] if detail else []
    sources += [F.coalesce(*[lists[k] for k in FEATURED_KEYS]), lists["attributes"]]
    empty = F.array().cast(f"array<{ATTRIBUTE}>")
    raw = read.withColumn("_attrs", F.concat(*[F.coalesce(s, empty) for s in sources]))
    return raw.withColumn("_attrs", _pairs(F.col("_attrs"))).drop("_lists")


def _advert_raw_tail(flat: DataFrame) -> DataFrame:
    """Title fallback, unit stripping and the rewriting of "other"."""
    from_title = T.parse_title(F.coalesce(F.col("ad_title"), F.lit("")))
    bad = F.col("make").isNull() | F.col("make").isin(V.BAD_MAKES)
    flat = flat.withColumn("_title", from_title).withColumns(
        {
            "model": T.trim_model_place(F.coalesce("given_model", "_title.model")),
            "make": F.when(bad, F.coalesce("_title.make", "make")).otherwise(F.col("make")),
            "year": N.clean_year(F.col("year")).cast("string"),
            "mileage": T.strip_km(F.col("mileage")),
            "engine_size": T.strip_cc(F.col("engine_size"), latin=False),
        }
    ).drop("_title")
    return flat.withColumns(
        {f: T.rewrite_other(F.col(f)) for f in V.OTHER_FIELDS if f in flat.columns}
    )


GENERIC_CATEGORIES = ["سيارات", "Cars", "Motors", "محركات"]
ADVERT_WIDE_PATHS = {
    "slug": ["slug"],
    "ad_link": ["ad_link"],
    "date_added": ["published_date"],
    "ad_title": ["title", "title_ar"],
    "price": ["price", "dollar_price"],
    "make": _names("category"),
    "place": _names("governorate"),
    "description_original": ["description", "description_ar"],
    "customer": ["customer"],
    "seller_name": ["customer.name"],
    "creator_name": ["created_by.name"],
    "phone": ["phone"],
    "whatsapp": ["whatsapp"],
    "cover": ["cover_image"],
}


def flatten_advert_wide(df: DataFrame, source: str, url_prefix: str, item: str = "item", detail: str | None = None) -> DataFrame:
    """PRJ-6, wide form: attributes first, then what the description says (EXT-5)."""
    it = F.col(item)
    staged, lists = _lists(_with_attributes(df, it, detail), "_photos", it, {"gallery": object_type({"src": "string"})})
    gallery = F.filter(lists["gallery"]["src"], lambda u: u != "")
    staged = staged.withColumns(
        {"_gallery": gallery, "id": F.concat(F.lit(f"{source}_"), F.try_variant_get(it, "$.id", "string"))}
    ).drop("_photos")
    kept = ["slug", "ad_link", "date_added", "price", "description_original", "customer", "phone",
            "whatsapp", "cover"]
    texts = with_texts(staged, ADVERT_WIDE_PATHS, it, tidy=T.clean_dashes, plain=kept)
    seller = F.when(F.col("customer").isNull(), F.col("creator_name")).otherwise(F.col("seller_name"))
    images = F.when(F.size("_gallery") > 0, F.col("_gallery")).otherwise(
        F.array_compact(F.array("cover"))
    )
    base = texts.withColumns(
        {
            "source": F.lit(source),
            "car_url": F.coalesce("ad_link", F.concat(F.lit(url_prefix), "slug")),
            "listing_type": T.listing_type_of_title(F.coalesce("ad_title", F.lit(""))),
            "date_added": iso_date(F.col("date_added")),
            "price": N.price_with_commas(F.col("price")),
            "make": F.when(~F.col("make").isin(GENERIC_CATEGORIES), F.col("make")),
            "description_original": T.html_to_text(F.col("description_original")),
            "seller_name": seller,
            "phone": T.contact_by_digits(F.col("phone"), F.col("whatsapp")),
            "images_original_links": F.array_join(images, ", "),
        }
    )
    mined = mine_description(base, "description_original")
    mined_as = {"exterior_color": "desc_color", "engine_size": "desc_engine"}
    out = {}
    for name in dict.fromkeys([*V.ADVERT_SLUGS.values(), "model"]):
        value = field_value(F.col("_attrs"), name)
        if name == "mileage":
            value = N.clean_mileage(value, thousands=False)
        spare = mined_as.get(name, f"desc_{name}")
        out[name] = F.coalesce(value, F.col(spare)) if spare in mined.columns else value
    out["city"] = F.coalesce("place", "desc_city")
    flat = mined.withColumns(out)
    helpers = {"_attrs", "_gallery", "slug", "ad_link", "place", "customer", "creator_name", "whatsapp",
               "cover", item, detail}
    return flat.select(
        *[c for c in flat.columns if c not in helpers and not c.startswith("desc_")]
    )
