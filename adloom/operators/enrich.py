"""Record fusion and lookups (JN-4, JN-10, JN-11, MRG-*, AGG-21)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.functions.text import blank_to_null, strip

DEALER = "dealer"



def join_details(cards: DataFrame, details: DataFrame, key: str = "id", prefix: str = "detail_") -> DataFrame:
    """JN-4: every card with its detail, columns of which get a prefix; ``has_detail`` tells a hit."""
    renamed = details.select(
        key, F.lit(True).alias("_found"),
        *[F.col(c).alias(prefix + c) for c in details.columns if c != key],
    )
    joined = cards.join(renamed, key, "left")
    return joined.withColumn("has_detail", F.coalesce("_found", F.lit(False))).drop("_found")


def _nonempty(df: DataFrame, name: str):
    kind = dict(df.dtypes)[name]
    if kind.startswith("array"):
        return F.when(F.size(F.col(name)) > 0, F.col(name))
    if kind == "string":
        return blank_to_null(F.col(name))
    return F.col(name)


def merge_unified(joined: DataFrame, prefix: str = "detail_") -> DataFrame:
    """MRG-1 after JN-4: detail wins for description, images, contact and seller; card wins for title
    and price; detail specs override card specs label by label."""
    detail_first = ["description_raw", "images", "phone", "whatsapp", "seller_name"]
    card_first = ["title_raw", "price_raw"]
    return _fuse(joined, prefix, detail_first, card_first)


def merge_clean_card(joined: DataFrame, prefix: str = "detail_") -> DataFrame:
    """MRG-4: card price preferred, detail title preferred."""
    detail_first = ["title_raw", "description_raw", "images", "phone", "whatsapp", "seller_name"]
    return _fuse(joined, prefix, detail_first, ["price_raw"])


def _fuse(joined: DataFrame, prefix: str, detail_first: Sequence[str], card_first: Sequence[str]) -> DataFrame:
    columns = joined.columns
    changes = {}
    for name in [*detail_first, *card_first]:
        if prefix + name not in columns:
            continue
        detail = _nonempty(joined, prefix + name)
        if name not in columns:
            changes[name] = detail
            continue
        card = _nonempty(joined, name)
        order = (detail, card) if name in detail_first else (card, detail)
        changes[name] = F.coalesce(*order)
    out = joined.withColumns(changes)
    if "specs" in columns and prefix + "specs" in columns:
        out = out.withColumn("specs", merge_pairs(F.col("specs"), F.col(prefix + "specs")))
    return out.drop(*[c for c in columns if c.startswith(prefix)], "has_detail")


def merge_pairs(card, detail):
    """MRG-1 for label/value pairs: card labels that the detail repeats give way to the detail."""
    empty = F.array().cast("array<struct<pos:int,label:string,value:string>>")
    card, detail = F.coalesce(card, empty), F.coalesce(detail, empty)
    labels = F.transform(detail, lambda p: p["label"])
    return F.concat(F.filter(card, lambda p: ~F.array_contains(labels, p["label"])), detail)


def override_present(joined: DataFrame, columns: Sequence[str], prefix: str = "detail_") -> DataFrame:
    """MRG-2: where a detail was found, its value replaces the card's even when blank."""
    return joined.withColumns(
        {c: F.when(F.col("has_detail"), F.col(prefix + c)).otherwise(F.col(c)) for c in columns}
    )


def override_nonempty(joined: DataFrame, columns: Sequence[str], prefix: str = "detail_") -> DataFrame:
    """MRG-3 / MRG-5: a non-empty detail value wins."""
    return joined.withColumns(
        {c: F.coalesce(_nonempty(joined, prefix + c), F.col(c)) for c in columns}
    )


def fill_missing(joined: DataFrame, columns: Sequence[str], prefix: str = "detail_") -> DataFrame:
    """MRG-3 (city) / MRG-5 (raw): the detail value fills what the card lacks."""
    return joined.withColumns(
        {c: F.coalesce(_nonempty(joined, c), F.col(prefix + c)) for c in columns}
    )


def fill_contacts(items: DataFrame, contacts: DataFrame, key: str = "id") -> DataFrame:
    """JN-11: only where the contact is missing, phone or else WhatsApp."""
    found = F.coalesce(blank_to_null(F.col("phone")), blank_to_null(F.col("whatsapp")))
    lookup = contacts.groupBy(key).agg(F.max(found).alias("_contact"))
    joined = items.join(lookup, key, "left")
    contact = F.coalesce(blank_to_null(F.col("contact")), F.col("_contact"))
    return joined.withColumn("contact", contact).select(*items.columns)


# --- dealers -----------------------------------------------------------------------------------------
def dealer_phones(cars: DataFrame, order: str = "row_num") -> DataFrame:
    """WIN-3: phone of the last dealer listing per lower-cased seller name."""
    usable = cars.filter(
        (F.col("seller_type") == DEALER) & (F.col("seller_name") != "") & (F.col("phone") != "")
    )
    named = usable.withColumn("dealer_key", F.lower(strip(F.col("seller_name"))))
    return named.groupBy("dealer_key").agg(
        F.max_by("phone", F.struct(order, "phone")).alias("dealer_phone")
    )


def enrich_dealers(dealers: DataFrame, cars: DataFrame, order: str = "row_num") -> DataFrame:
    """JN-10: dealers with the phone of their last listing, NULL when there is none."""
    keyed = dealers.withColumn("dealer_key", F.lower(strip(F.col("dealer_name"))))
    joined = keyed.join(dealer_phones(cars, order), "dealer_key", "left")
    kept = [c for c in dealers.columns if c != "phone"]
    return joined.select(*kept, F.col("dealer_phone").alias("phone"))


def aggregate_dealers(links: DataFrame, order: str = "pos") -> DataFrame:
    """AGG-21: dealers from listing-page links ``(username, text, pos)``.

    The first text without a car count is the name, the last number in a counting text is the count,
    and a dealer without a name is called by user name.
    """
    counting = F.col("text").contains("سيارة")
    number = blank_to_null(F.regexp_extract("text", r"(\d+)", 1))
    name = F.when(~counting & (F.col("text") != ""), F.col("text"))
    return (
        links.filter(F.col("username") != "")
        .groupBy("username")
        .agg(
            F.min_by(name, F.when(name.isNotNull(), F.col(order))).alias("name"),
            F.max_by(
                F.when(counting, number), F.when(counting & number.isNotNull(), F.col(order))
            ).alias("car_count"),
        )
        .select(F.coalesce("name", "username").alias("dealer_name"), "username", "car_count")
    )


def phone_match_rate(dealers: DataFrame) -> DataFrame:
    """AGG-21: matched dealers, all dealers and their ratio."""
    return dealers.agg(
        F.count(blank_to_null(F.col("phone"))).alias("matched"), F.count("*").alias("dealers")
    ).withColumn("match_rate", F.try_divide("matched", "dealers"))
