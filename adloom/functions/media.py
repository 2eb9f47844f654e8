"""Image lists, URLs and contact JSON (ARR-*, URL-*, JSN-*)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adloom.functions import fixed_values as V
from adloom.functions.markup import once
from adloom.functions.text import arabic_only, blank_to_null, contains_any, first_nonempty, strip


def images_from_json(c: Column) -> Column:
    """ARR-1: JSON text to its non-empty entries; anything that is not a list gives no images."""
    parsed = F.from_json(c, "array<string>")
    return F.coalesce(F.filter(parsed, lambda x: x != ""), F.array().cast("array<string>"))


def images_to_json(c: Column) -> Column:
    return F.to_json(F.coalesce(c, F.array().cast("array<string>")))


def images_from_text(c: Column) -> Column:
    """ARR-2: URLs separated by white space."""
    return F.filter(F.split(strip(c), r"(?U)\s+"), lambda x: x != "")


def image_entry_url(entry: Column) -> Column:
    """ARR-2: an entry is a JSON string, or an object holding ``url``, ``src`` or ``path``.

    ``entry`` is a variant value.
    """
    found = F.try_variant_get(entry, "$", "struct<url:string,src:string,path:string>")  # null for what is no object
    return strip(once(found, lambda o: F.when(
        o.isNotNull(), F.coalesce(*[blank_to_null(o[key]) for key in ("url", "src", "path")])
    ).otherwise(F.try_variant_get(entry, "$", "string"))))


def usable_image_urls(urls: Column) -> Column:
    """ARR-2: drop blanks and directory links."""
    return F.filter(urls, lambda u: (u != "") & ~u.endswith("/"))


def first_http(urls: Column) -> Column:
    return F.try_element_at(F.filter(urls, lambda u: u.startswith("http")), F.lit(1))


def cover_url(*lists: Column, fallbacks: tuple[Column, ...] = ()) -> Column:
    """ARR-3: first ``http`` image of the first non-empty list, else a named cover field."""
    chosen = F.coalesce(*[F.when(F.size(x) > 0, x) for x in lists])
    named = [first_nonempty(*fallbacks)] if fallbacks else []
    return F.coalesce(first_http(chosen), *named)


def keep_photos(urls: Column) -> Column:
    """ARR-4: absolute, long enough, not an icon or banner; duplicates removed in order."""
    trimmed = F.transform(urls, strip)
    good = F.filter(
        trimmed,
        lambda u: u.startswith("http")
        & (F.length(u) > V.MIN_IMAGE_URL)
        & ~contains_any(F.lower(u), V.IMAGE_NOISE),
    )
    return F.array_distinct(good)


def join_list(c: Column, separator: str = ", ") -> Column:
    """ARR-5."""
    return F.array_join(c, separator)


def split_list(c: Column, separator: str = ",") -> Column:
    """ARR-5: split on a literal separator, trim, drop blanks."""
    quoted = "".join(f"\\{ch}" if ch in r"|.*+?^$()[]{}\\" else ch for ch in separator)
    return F.filter(F.transform(F.split(c, quoted), strip), lambda x: x != "")


def original_image_url(c: Column) -> Column:
    """URL-1: drop the query and a ``-WxH`` resize suffix."""
    return F.regexp_replace(
        F.regexp_replace(c, r"\?.*$", ""), r"-\d+x\d+(?=\.[a-zA-Z]+$)", ""
    )


def better_quality(c: Column, low: str = "/new/low/", high: str = "/new/high/") -> Column:
    """URL-2: swap one literal path piece for another."""
    return F.replace(c, F.lit(low), F.lit(high))


def larger_thumbnail(c: Column) -> Column:
    return better_quality(c, "-thumb-sm_", "-thumb-md_")


def unwrap_image_url(c: Column) -> Column:
    """URL-3: decode the target of an image-proxy link."""
    target = blank_to_null(F.regexp_extract(c, r"url=([^&]+)", 1))
    return F.coalesce(F.when(c.contains("/_next/image"), F.try_url_decode(target)), c)


def absolute_url(c: Column, base: str) -> Column:
    """URL-4: prefix relative links with the site root."""
    joined = F.concat(F.lit(base.rstrip("/") + "/"), F.regexp_replace(c, "^/+", ""))
    return F.when(c.startswith("http"), c).otherwise(joined)


def last_segment(c: Column, marker: str = "/") -> Column:
    """URL-4: slug or user name behind the last ``marker``."""
    return F.substring_index(F.regexp_replace(c, "/+$", ""), marker, -1)


def whatsapp_number(c: Column) -> Column:
    """URL-4: number of a ``wa.me`` link."""
    return blank_to_null(F.regexp_extract(c, r"wa\.me/\+?(\d+)", 1))


def contact_from_json(c: Column) -> Column:
    """JSN-1: ``struct(phone, whatsapp)``; a later wrapper overrides an earlier one and the top."""
    layers = [f"$.{w}" for w in reversed(V.CONTACT_WRAPPERS)] + ["$"]
    body = F.try_parse_json(c)

    def pick(keys: list[str]) -> Column:
        per_key = [
            F.coalesce(*[F.try_variant_get(body, f"{p}.{k}", "string") for p in layers])
            for k in keys
        ]
        return F.coalesce(*[blank_to_null(strip(v)) for v in per_key])

    return F.struct(pick(V.PHONE_KEYS).alias("phone"), pick(V.WHATSAPP_KEYS).alias("whatsapp"))


def vehicle_from_json_ld(c: Column) -> Column:
    """JSN-2: vehicle fields of an embedded JSON-LD document."""
    get = lambda path: blank_to_null(F.get_json_object(c, path))
    return F.struct(
        arabic_only(get("$.brand")).alias("make"),
        get("$.model").alias("model"),
        get("$.vehicleModelDate").alias("year"),
        get("$.bodyType").alias("body_type"),
        get("$.color").alias("exterior_color"),
        get("$.vehicleTransmission").alias("transmission"),
        get("$.fuelType").alias("fuel_type"),
        F.translate(get("$.offers.price"), ",", "").alias("price"),
    )
