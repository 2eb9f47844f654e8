"""String expressions (STR-*). Every function takes and returns a ``Column``; blanks become NULL.

Java regular expressions are ASCII by default, so patterns that must see Arabic letters, digits or
non-breaking spaces carry the ``(?U)`` flag.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from adloom.functions import fixed_values as V
from adloom.functions.markup import once

HAS_ARABIC = "[؀-ۿ]"
YEAR_PATTERN = r"(?U)\b(19[5-9]\d|20[012]\d)\b"


# --- small building blocks -----------------------------------------------------------------------
def blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


# All Unicode white space, plus the four separators that count as blank in the source data's rules.
WHITE_SPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip(c: Column) -> Column:
    """Remove Unicode white space at both ends (``trim`` only knows U+0020); no regular expression,
    so it costs next to nothing on values that have none."""
    return F.btrim(c, F.lit(WHITE_SPACE))


def squeeze(c: Column) -> Column:
    """Collapse runs of Unicode white space to one blank and trim."""
    return F.trim(F.regexp_replace(c.cast("string"), r"(?U)\s+", " "))


def literal_map(entries: Mapping[str, str]) -> Column:
    """Map literal, written as one SQL expression (a call per entry would slow down planning)."""
    quoted = ["'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'" for p in entries.items() for x in p]
    return F.expr(f"map({', '.join(quoted)})")


def map_value(c: Column, entries: Mapping[str, str]) -> Column:
    return F.try_element_at(literal_map(entries), c)


def contains_any(c: Column, words: Sequence[str]) -> Column:
    hit = F.lit(False)
    for word in words:
        hit = hit | c.contains(word)
    return hit


def is_any(c: Column, values: Sequence[str]) -> Column:
    """``c`` is one of ``values``, like ``isin``, for use inside lambdas: not compiled, ``isin`` throws for every hit."""
    hit = F.lit(False)
    for value in dict.fromkeys(values):
        hit = hit | (c == value)
    return hit


def ascii_digits(c: Column) -> Column:
    """Arabic-Indic digits to ASCII, so casts accept them."""
    return F.translate(c, V.DIGITS_FROM, V.DIGITS_TO)


def first_nonempty(*cols: Column) -> Column:
    """PRJ-4: first alternative that is present and not blank."""
    return F.coalesce(*[blank_to_null(c.cast("string")) for c in cols])


# --- STR-1 ... STR-14 ------------------------------------------------------------------------------
def clean(
    c: Column, placeholders: Sequence[str] = V.PLACEHOLDERS, ignore_case: bool = False
) -> Column:
    """STR-1: squeeze white space; placeholder spellings become NULL."""
    return unless_placeholder(squeeze(c), placeholders, ignore_case)


def unless_placeholder(
    text: Column, placeholders: Sequence[str] = V.PLACEHOLDERS, ignore_case: bool = False
) -> Column:
    """The second half of STR-1, for text that is squeezed already."""
    key = F.lower(text) if ignore_case else text
    return F.when(~is_any(key, ["", *placeholders]), text)


def clean_dashes(c: Column) -> Column:
    """STR-1, variant in which only dashes are placeholders (``N/A`` and ``null`` are kept)."""
    return clean(c, V.DASHES)


def fold_ar(c: Column) -> Column:
    """STR-2: unify alef, teh marbuta and yeh forms and drop tatweel. Case is kept."""
    return F.translate(strip(c), V.FOLD_FROM, V.FOLD_TO)


def alias_key(c: Column) -> Column:
    """Key under which hard-coded aliases are compared: folded, then lower-cased."""
    return F.lower(fold_ar(c))


def is_arabic(c: Column) -> Column:
    """STR-4."""
    return c.rlike(HAS_ARABIC)


def transliterate(c: Column) -> Column:
    """STR-5: Latin to Arabic, left to right, digraphs before letters; unknown letters vanish."""
    table = {**V.DIGRAPHS, **V.LETTERS}
    pattern = "(?s)(" + "|".join(V.DIGRAPHS) + "|.)"
    tokens = F.regexp_extract_all(F.lower(strip(c)), F.lit(pattern), 1)
    spelled = F.transform(
        tokens,
        lambda t: F.coalesce(map_value(t, table), F.when(t.rlike(r"^\p{L}$"), "").otherwise(t)),
    )
    return strip(F.array_join(spelled, ""))


def strip_brand_prefix(c: Column) -> Column:
    """STR-6: drop a leading brand name; a string that is only the brand stays."""
    prefixes = "|".join(V.BRAND_PREFIXES)
    text = strip(c)
    rest = F.regexp_replace(text, rf"(?iu)^(?:{prefixes})[ -]+", "")
    rest = F.regexp_replace(rest, "[ -]+$", "")
    led = text.rlike(rf"(?iu)^(?:{prefixes})[ -]")
    return F.when(F.lower(text).isin(V.BRAND_PREFIXES) | ~led, text).otherwise(rest)


def strip_variant_number(c: Column) -> Column:
    """STR-7: ``IS 300`` to ``IS``."""
    code = F.upper(F.regexp_extract(strip(c), r"^([A-Za-z]{1,3})\s+\d{2,3}$", 1))
    return F.coalesce(blank_to_null(code), c)


def is_short_or_numeric(c: Column) -> Column:
    """STR-8: model codes that must stay as capital letters."""
    return (F.length(strip(c)) <= 3) | c.rlike(r"(?U)\d")


def arabic_only(c: Column) -> Column:
    """STR-9: leading Arabic run of a bilingual label, else the whole text."""
    text = strip(c)
    lead = strip(F.regexp_extract(text, r"(?U)^([؀-ۿ\s،؛]+)", 1))
    return F.coalesce(blank_to_null(lead), text)


def strip_foreign(c: Column) -> Column:
    """STR-10: Arabic half of ``Latin - Arabic`` compounds; an "all models" suffix is dropped."""
    text = strip(F.regexp_replace(c, rf"(?U)\s*{V.ALL_MODELS}\s*$", ""))

    def halved(t: Column) -> Column:
        parts = F.filter(F.transform(F.split(t, r"(?U)\s*[-–]\s*"), strip), lambda p: p != "")
        arabic = lambda x: F.try_element_at(F.filter(x, is_arabic), F.lit(1))
        named = once(parts, lambda x: F.when(F.size(x) >= 2, arabic(x)))
        return F.coalesce(F.when(t.contains("-") | t.contains("–"), named), t)

    return once(text, halved)


def strip_bidi(c: Column) -> Column:
    """STR-11: drop bidirectional control characters."""
    return strip(F.regexp_replace(c, r"[‎‏‪-‮⁦-⁩]", ""))


def strip_unit(c: Column, unit: str) -> Column:
    """STR-12: drop a trailing unit given as a pattern (see the named variants below)."""
    return strip(F.regexp_replace(strip(c), rf"(?U)\s*(?:{unit})\s*$", ""))


def strip_km(c: Column) -> Column:
    return strip_unit(c, V.KM_UNIT)


def strip_cc(c: Column, latin: bool = True) -> Column:
    return strip_unit(c, r"CC|cc|سي\s+سي" if latin else r"سي\s+سي")


def strip_hp(c: Column) -> Column:
    return strip_unit(c, "حصان")


def split_make_model(c: Column) -> Column:
    """STR-13: ``make > model`` as a struct; without a separator everything is the make."""
    parts = F.split(c, r"(?U)[^\S\r\n]*>\s*", 2)
    return F.struct(
        strip_bidi(F.try_element_at(parts, F.lit(1))).alias("make"),
        strip_bidi(F.try_element_at(parts, F.lit(2))).alias("model"),
    )


def last_breadcrumb(c: Column) -> Column:
    """STR-13: finest-grained part of a location breadcrumb."""
    return strip(F.element_at(F.split(c, r"(?U)\s*[‏>＞›»]\s*"), -1))


def split_subtitle(c: Column) -> Column:
    """STR-14: ``model • body • year`` as a struct."""
    parts = F.filter(F.transform(F.split(c, "•"), strip), lambda p: p != "")
    return F.struct(
        F.try_element_at(parts, F.lit(1)).alias("model"),
        F.try_element_at(parts, F.lit(2)).alias("body_type"),
        F.try_element_at(parts, F.lit(3)).alias("year"),
    )


# --- STR-15 ... STR-22: titles -----------------------------------------------------------------------
def detect_keyword(c: Column, keywords: Mapping[str, str]) -> Column:
    """STR-15: value of the first keyword (in map order) that the text contains."""
    return F.coalesce(*[F.when(c.contains(k.lower()), F.lit(v)) for k, v in keywords.items()])


def listing_type_of_title(c: Column, rent_words: Sequence[str] = V.RENT_WORDS) -> Column:
    """STR-16: rent when a rent word appears, else sale."""
    return F.when(contains_any(c, rent_words), F.lit(V.FOR_RENT)).otherwise(F.lit(V.FOR_SALE))


def listing_type_of_code(c: Column) -> Column:
    """STR-16: site codes to sale or rent, sale by default."""
    return F.coalesce(map_value(F.lower(c), V.LISTING_TYPES), F.lit(V.SALE))


def condition_of_title(c: Column) -> Column:
    """STR-17: used is tested before new."""
    return F.when(contains_any(c, V.USED_WORDS), F.lit(V.USED)).when(
        contains_any(c, V.NEW_WORDS), F.lit(V.NEW)
    )


def extract_brand(title: Column) -> Column:
    """STR-18: known brand (list order decides), Arabic brand name, first Latin word."""
    lowered = [b.lower() for b in V.KNOWN_BRANDS]
    found = F.regexp_extract_all(
        title, F.lit(r"(?iU)\b(" + "|".join(V.KNOWN_BRANDS) + r")\b"), 1
    )
    rank = F.array_min(
        F.transform(found, lambda b: F.array_position(F.lit(lowered), F.lower(b)))
    )
    known = F.try_element_at(F.lit(V.KNOWN_BRANDS), rank.cast("int"))
    arabic = F.coalesce(*[F.when(title.contains(k), F.lit(v)) for k, v in V.BRAND_NAMES_AR.items()])
    word = F.regexp_extract(title, r"(?U)\b([A-Za-z][A-Za-z\-]+)\b", 1)
    latin = F.when((word != "") & ~F.lower(word).isin(V.TITLE_STOP_WORDS), word)
    return F.coalesce(known, arabic, latin)


def brand_in_english(c: Column) -> Column:
    return F.coalesce(map_value(c, V.BRAND_NAMES_AR), c)


def without_literal(text: Column, literal: Column) -> Column:
    """``text`` without any occurrence of ``literal``, in whatever case; by position, so no pattern is built
    per row. Null where ``literal`` is."""
    pieces = F.split(F.replace(F.lower(text), F.lower(literal), F.lit("\u0001")), "\u0001")
    start = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))

    def take(done: Column, piece: Column) -> Column:
        return F.struct(
            (done["at"] + F.length(piece) + F.length(literal)).alias("at"),
            F.concat(done["out"], F.substring(text, done["at"], F.length(piece))).alias("out"),
        )

    return F.when(literal == "", text).otherwise(F.aggregate(pieces, start, take)["out"])


def without_word(text: Column, word: Column) -> Column:
    """``text`` without ``word`` where it stands alone, between characters that are no part of a word.

    The text is cut at the word; where a cut touches a word character on the other side of the word's edge,
    the word is put back.
    """
    pieces = F.split(F.replace(text, word, F.lit("\u0001")), "\u0001")
    inside = r"(?U)^\w$"
    opens, closes = F.substring(word, 1, 1).rlike(inside), F.substring(word, -1, 1).rlike(inside)

    def join(done: Column, piece: Column) -> Column:
        before, after = F.substring(done, -1, 1).rlike(inside), F.substring(piece, 1, 1).rlike(inside)
        alone = (before != opens) & (after != closes)
        return F.concat(done, F.when(alone, "").otherwise(word), piece)

    first = F.get(pieces, F.lit(0))
    return F.aggregate(F.slice(pieces, F.lit(2), F.size(pieces)), first, join)


def extract_model(title: Column, brand: Column) -> Column:
    """STR-19: first word left after removing the brand, years and Arabic text."""
    rest = strip(without_literal(title, brand))
    rest = strip(F.regexp_replace(rest, YEAR_PATTERN, ""))
    rest = strip(F.regexp_replace(rest, V.ARABIC_RUN, ""))
    word = F.try_element_at(F.split(rest, r"(?U)\s+"), F.lit(1))
    return F.when(F.length(word) >= 2, word)


def trim_model_tail(c: Column) -> Column:
    """STR-20: drop one trailing year, then trailing condition words."""
    text = strip(F.regexp_replace(c, r"(?U)\s+\d{4}\s*$", ""))
    tail = "|".join(V.TITLE_TRAIL)
    return strip(F.regexp_replace(squeeze(text), rf"(?U)(?:(?:^|\s+)(?:{tail}))+$", ""))


def parse_title(title: Column) -> Column:
    """STR-20: ``struct(make, model)`` from an Arabic advert title."""
    text = strip(title)
    text = strip(F.regexp_replace(text, "^(?:" + "|".join(V.TITLE_PREFIXES) + ")", ""))
    text = trim_model_tail(strip(F.substring_index(text, V.IN_PLACE, 1)))

    def first_words(text: Column) -> Column:
        multi = once(F.regexp_extract(text, "^(" + "|".join(V.MULTI_WORD_MAKES) + ")", 1), blank_to_null)
        return F.coalesce(multi, F.regexp_extract(text, r"(?U)^(\S+)", 1))

    def parts(text: Column, make: Column) -> Column:
        model = once(trim_model_tail(strip(F.substring(text, F.length(make) + 1, F.length(text)))), blank_to_null)
        return F.struct(blank_to_null(make).alias("make"), model.alias("model"))

    return once(text, lambda t: once(first_words(t), lambda make: parts(t, make)))


def trim_model_place(c: Column) -> Column:
    """STR-21: cut a leaked location; a model that starts with one is blank."""
    text = strip(F.substring_index(strip(c), V.IN_PLACE, 1))
    return once(text, lambda t: F.when((t != "") & ~t.rlike(r"(?U)^في\s"), t))


def model_from_title(title: Column, make: Column, year: Column) -> Column:
    """STR-21: title without make and year, when more than one character is left."""

    def without(text: Column, word: Column) -> Column:
        removed = strip(without_word(text, word))
        return F.when(F.coalesce(word, F.lit("")) == "", text).otherwise(removed)

    rest = squeeze(without(without(title, make), year))
    return F.when(F.length(rest) > 1, rest)


def build_ad_title(
    brand: Column, model: Column, year: Column, listing_type: Column, location: Column,
    condition: Column,
) -> Column:
    """STR-22: Arabic title; the brand is not repeated when the model already starts with it."""
    repeated = F.lower(model).startswith(F.lower(brand))
    return F.concat_ws(
        " ",
        F.when(F.coalesce(repeated, F.lit(False)), None).otherwise(blank_to_null(brand)),
        blank_to_null(model),
        year.cast("string"),
        F.when(condition == V.BRAND_NEW, F.lit(V.BRAND_NEW)),
        F.when(listing_type == V.RENT, F.lit(V.FOR_RENT)).otherwise(F.lit(V.FOR_SALE)),
        F.concat(F.lit(V.IN_PLACE.lstrip()), blank_to_null(location)),
    )


# --- STR-23 ... STR-27: contact, VIN, markup ------------------------------------------------------------
def build_contact(phone: Column, whatsapp: Column) -> Column:
    """STR-23: ``phone | WA:number``, the second part only when it differs."""
    phone, whatsapp = blank_to_null(phone), blank_to_null(whatsapp)
    other = F.when(~whatsapp.eqNullSafe(phone), F.concat(F.lit("WA:"), whatsapp))
    return blank_to_null(F.concat_ws(" | ", phone, other))


def _usable_phone(c: Column) -> Column:
    return once(squeeze(c), lambda text: unless_placeholder(text, [*V.PLACEHOLDERS, *V.NO_PHONE]))


def contact_by_digits(phone: Column, whatsapp: Column) -> Column:
    """STR-23: ``phone / WA:number``; equal digits count as the same number."""
    phone, whatsapp = _usable_phone(phone), clean(whatsapp)
    digits = r"(?U)\D"
    differs = F.regexp_replace(phone, digits, "") != F.regexp_replace(whatsapp, digits, "")
    alone = F.concat(F.lit("WA:"), _usable_phone(whatsapp))
    both = F.concat(phone, F.lit(" / WA:"), whatsapp)
    return F.when(phone.isNull(), alone).when(differs, both).otherwise(phone)


def contact_by_substring(phone: Column, whatsapp: Column) -> Column:
    """STR-23: append the number unless the phone text already contains it."""
    phone = F.coalesce(phone, F.lit(""))
    known = F.translate(phone, "+ ", "").contains(F.regexp_replace(whatsapp, r"^\++", ""))
    joined = F.regexp_replace(F.concat(phone, F.lit(" / WA:"), whatsapp), r"^[ /]+|[ /]+$", "")
    return blank_to_null(F.when(known | whatsapp.isNull(), phone).otherwise(joined))


def choose_phone(phone: Column, whatsapp: Column) -> Column:
    """STR-24: phone, else WhatsApp, rejecting null-like spellings."""
    return F.coalesce(_usable_phone(phone), _usable_phone(whatsapp))


def with_plus(c: Column) -> Column:
    """STR-24: prefix ``+`` when it is missing."""
    return F.when(c.startswith("+"), c).otherwise(F.concat(F.lit("+"), blank_to_null(c)))


def validate_vin(c: Column) -> Column:
    """STR-25: NULL for phrases (two or more Arabic runs) and for texts over 30 characters."""
    text = strip(c)
    runs = F.size(F.regexp_extract_all(text, F.lit(f"({V.ARABIC_RUN})"), 1))
    return F.when((text != "") & (runs < 2) & (F.length(text) <= 30), text)


def unescape_html(c: Column) -> Column:
    """The named and numeric entities that occur in listing text; ``&amp;`` last."""
    text = c
    for entity, char in (
        ("&nbsp;", "\xa0"), ("&#160;", "\xa0"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&amp;", "&"),
    ):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


def strip_tags(c: Column, separator: str = "") -> Column:
    return F.regexp_replace(c, r"(?s)<!--.*?-->|<[^>]*>", separator)


def html_to_text(c: Column) -> Column:
    """STR-26: markup to text; block ends become line breaks, at most one blank line in a row."""
    broken = F.regexp_replace(c, r"(?i)<br\s*/?>|</(?:p|div|li)\s*>", "$0\n")
    plain = F.when(c.contains("<"), unescape_html(strip_tags(broken))).otherwise(c)
    lines = F.regexp_replace(F.regexp_replace(plain, r"\r\n?", "\n"), r"(?U)[^\S\n]+(?=\n|\z)", "")
    return blank_to_null(strip(F.regexp_replace(lines, r"\n{3,}", "\n\n")))


def override_make(c: Column) -> Column:
    """STR-27: spelling replaced after matching."""
    return F.coalesce(map_value(c, V.MAKE_OVERRIDES), c)


def translate_value(c: Column, entries: Mapping[str, str]) -> Column:
    """JN-6, plain-key variant: lower-cased trimmed lookup, cleaned input when unknown."""
    return F.coalesce(map_value(F.lower(strip(c)), entries), clean(c))


def rewrite_other(c: Column) -> Column:
    """PRJ-7: all spellings of "other" to one."""
    return F.when(c.isin(V.OTHER_SPELLINGS), F.lit(V.OTHER_CANONICAL)).otherwise(c)


def listing_key(source: Column, listing_id: Column, slug: Column | None = None) -> Column:
    """PRJ-3: ``source_id``, falling back to the slug."""
    key = blank_to_null(strip(listing_id.cast("string")))
    if slug is not None:
        key = F.coalesce(key, blank_to_null(strip(slug)))
    return F.concat(source, F.lit("_"), key)
