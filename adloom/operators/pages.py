"""Fields, label/value pairs and cards from landed pages (EXT-1 to EXT-4, EXT-6 to EXT-8).

Everything is column expressions over markup (``functions/markup.py``): an element begins at an opening tag and
ends at its own closing tag, a container reaches to the next container of its page, a card to the next card. An
element that holds others of its own name and is never closed has no value. What differs between sites is data, the rules in ``functions/page_values.py``; they become one expression per field, so a table of
pages is read once whatever sources it mixes. Nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.functions import fixed_values as V
from adloom.functions import page_values as W
from adloom.functions.dates import compact_date, first_date, iso_date, month_name_date
from adloom.functions.markup import element_contents, first_content, holds, holds_any, matches, once, opening_tag, pieces_from
from adloom.functions.media import keep_photos, unwrap_image_url, vehicle_from_json_ld, whatsapp_number
from adloom.functions.page_values import NO_NOTES, RULES, SAFETY_WORDS, Rule
from adloom.functions.text import blank_to_null, contains_any, squeeze, unescape_html

HEADING = "h[2-4]"


# --- patterns of flat markup --------------------------------------------------------------------------
def _having(name: str, value: str) -> str:
    """Lookahead for an attribute of the tag whose quoted value matches ``value``."""
    return rf"""(?=[^>]*\s{name}\s*=\s*["']{value}["'])"""


def _class(pattern: str) -> str:
    """Lookahead for a tag one of whose classes is ``pattern`` (``*`` stands for anything)."""
    token = re.escape(pattern).replace(r"\*", r"""[^"'\s>]*""")
    return _having("class", rf"""(?:[^"'>]*\s)?{token}(?:\s[^"'>]*)?""")


def _first(html: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract(html, pattern, group)


def _at(values: Column, place: int) -> Column:
    return F.try_element_at(values, F.lit(place + 1 if place >= 0 else place))


def inner_text(markup: Column) -> Column:
    """Text of some markup: tags count as blanks, entities are resolved, white space is squeezed."""
    return squeeze(unescape_html(F.regexp_replace(markup, "<[^>]*>", " ")))


def _present(value: Column) -> Column:
    """Blank to null, for values that are costly to find."""
    return once(value, blank_to_null)


def _texts(html: Column, name: str) -> Column:
    return F.transform(element_contents(html, opening_tag(name), name), inner_text)


def _attribute(tag: Column, name: str) -> Column:
    return F.trim(unescape_html(_first(tag, rf"""(?is)\s{name}\s*=\s*["']([^"']*)["']""", 1)))


# --- rules --------------------------------------------------------------------------------------------
def _opening(rule: Rule) -> str:
    name, _, value = rule.attribute.partition("=")
    conditions = [_class(c) for c in rule.classes.split()]
    if name:
        conditions.append(_having(name, re.escape(value) if value else """[^"']*"""))
    return opening_tag(rule.tag, *conditions)


def _words(rule: Rule) -> list[str]:
    """Words without which the rule finds nothing."""
    name, _, value = rule.attribute.partition("=")
    tag = f"<{rule.tag}" if rule.tag else ""
    return [w for w in (tag, name, value, *re.split(r"[\s*]+", f"{rule.classes} {rule.within}")) if w]


def _picked(html: Column, low: Column, rule: Rule, containers: Sequence[str]) -> Column:
    """What one rule finds, or null."""
    scope = html
    if rule.within:
        behind = _first(html, f"(?is){opening_tag('', _class(rule.within))}(.*)", 2)
        others = "|".join(f"(?:{opening_tag('', _class(c))})" for c in containers if c != rule.within)
        scope = F.get(F.split(behind, f"(?is){others}", 2), F.lit(0)) if others else behind
    opening = _opening(rule)
    if rule.take == "text":
        found = once(scope, lambda x: inner_text(_at(element_contents(x, opening, rule.tag), rule.nth)))
    else:
        found = _attribute(_at(matches(scope, f"(?is){opening}", 0), rule.nth), rule.take)
    return F.when(holds(low, *_words(rule)), _present(found))


def _fields(html: Column, low: Column, rules: Sequence[Rule]) -> dict[str, Column]:
    """Each field as the first non-empty value of its rules; ``low`` is the page in lower case."""
    containers = list(dict.fromkeys(r.within for r in rules if r.within))
    found: dict[str, list[Column]] = {}
    for rule in rules:
        found.setdefault(rule.field, []).append(_picked(html, low, rule, containers))
    return {name: F.coalesce(*values) for name, values in found.items()}


def _map_of(fields: dict[str, Column]) -> Column:
    """Map of the fields that were found."""
    entries = F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in fields.items()])
    return F.map_from_entries(F.filter(entries, lambda e: e["value"].isNotNull()))


def _rules(source: str, level: str) -> list[Rule]:
    shared = [r for r in RULES if (r.source, r.level) == ("generic", level)] if level == "page" else []
    return [r for r in RULES if (r.source, r.level) == (source, level)] + [r for r in shared if r.source != source]


# --- label/value layouts ------------------------------------------------------------------------------
def _pair_list(strategy: str, labels: Column, values: Column) -> Column:
    """Pairs of two lists, as far as the shorter one reaches."""
    both = F.filter(
        F.arrays_zip(labels.alias("a"), values.alias("b")), lambda p: p["a"].isNotNull() & p["b"].isNotNull()
    )
    return F.transform(both, lambda p: F.struct(F.lit(strategy).alias("strategy"), p["a"].alias("label"), p["b"].alias("value")))


def _every_other(values: Column, start: int) -> Column:
    return F.filter(values, lambda _, i: i % 2 == start)


def _behind_heading(html: Column, words: Sequence[str], levels: str = HEADING) -> Column:
    """What follows the first heading that holds one of the words; empty without one."""
    inside = r"(?:(?!</\1).){0,300}?"  # headings are short; tags inside of them count as text
    return _first(html, rf"(?is)<({levels})\b[^>]*>{inside}(?:{'|'.join(words)}){inside}</\1>(.*)", 2)


def _if_held(held: Column, found: Column, kind: str) -> Column:
    """Nothing where a page lacks the words that ``found`` needs."""
    return F.when(~held, F.array().cast(kind)).otherwise(found)


_PAIRS = "array<struct<strategy:string,label:string,value:string>>"


def layout_pairs(html: Column, source: str, low: Column | None = None) -> Column:
    """EXT-1: ``(strategy, pos, label, value)`` of every layout in use, layout by layout. A layout is looked for
    only in pages that have its words (``low`` is the page in lower case)."""
    low = F.lower(html) if low is None else low
    run = F.get(F.split(_behind_heading(html, [W.INFO_HEADING], "h[23]"), r"(?i)<(?!/?(?:div|p)\b)", 2), F.lit(0))
    leaves = F.transform(matches(run, r"(?is)<(div|p)\b[^>]*>([^<]+)</\1>", 2), inner_text)
    grid = once(leaves, lambda x: _pair_list("grid", _every_other(x, 0), _every_other(x, 1)))
    cells = F.transform(
        matches(html, r"(?is)<tr\b[^>]*>(.*?)</tr>", 1), lambda row: F.transform(matches(row, r"(?is)<t[dh]\b[^>]*>(.*?)</t[dh]>", 1), inner_text)
    )
    cells = F.filter(cells, lambda row: F.size(row) >= 2)
    cell = lambda rows, n: F.transform(rows, lambda c: F.get(c, F.lit(n)))
    tables = once(cells, lambda x: _pair_list("table", cell(x, 0), cell(x, 1)))
    items = element_contents(html, opening_tag("li", _class(W.DATA_ITEM)), "li")
    side = lambda found, name: F.transform(
        found, lambda item: inner_text(first_content(item, opening_tag("", _class(f"{W.DATA_ITEM}-{name}"))))
    )
    title = opening_tag("", _class(W.CHAPTER))
    chapters = F.transform(matches(html, rf"(?is){title}(.*?)(?=<[^>]*{W.CHAPTER}|\z)", 2), lambda part: F.transform(element_contents(part, opening_tag("ul"), "ul"), lambda ul: _texts(ul, "li")))
    even = F.filter(F.flatten(chapters), lambda x: (F.size(x) > 0) & (F.size(x) % 2 == 0))
    halves = F.flatten(
        F.transform(even, lambda x: _pair_list("halves", F.slice(x, F.lit(1), (F.size(x) / 2).cast("int")), F.slice(x, (F.size(x) / 2).cast("int") + 1, (F.size(x) / 2).cast("int"))))
    )
    spec = opening_tag("div", _having("class", rf"""[^"'>]*(?:{W.SPEC_CLASSES})[^"'>]*"""))
    row = rf"(?is){spec}\s*<div\b[^>]*>([^<]*)</div>\s*<div\b[^>]*>([^<]*)</div>\s*</div>"
    short = lambda pairs: F.filter(pairs, lambda p: F.length(p["label"]) < W.MAX_LABEL)
    rows = lambda found: _pair_list("div", *(F.transform(found, lambda x: inner_text(_first(x, row, n))) for n in (2, 3)))
    parts = [
        _if_held(holds(low, W.INFO_HEADING), grid, _PAIRS),
        _if_held(holds(low, "<dt", "<dd"), _pair_list("dl", _texts(html, "dt"), _texts(html, "dd")), _PAIRS),
        _if_held(holds(low, "</tr"), tables, _PAIRS),
        _if_held(holds(low, W.DATA_ITEM), once(items, lambda x: _pair_list("item", side(x, "label"), side(x, "value"))), _PAIRS),
        _if_held(holds(low, W.CHAPTER), halves, _PAIRS),
        _if_held(holds(low, "<div", "class") & holds_any(low, W.SPEC_CLASSES.split("|")), short(once(matches(html, row, 0), rows)), _PAIRS),
    ]
    if source in W.LIST_CLASSES:
        box = opening_tag("div", _having("class", rf"""[^"'>]*(?:{W.LIST_CLASSES[source]})[^"'>]*"""))
        lists = F.transform(element_contents(html, box, "div"), lambda x: F.transform(element_contents(x, opening_tag("ul"), "ul"), lambda ul: _texts(ul, "li")))
        lists = F.flatten(F.filter(lists, lambda x: F.size(x) % 2 == 0))
        two = once(lists, lambda x: F.arrays_zip(_every_other(x, 0).alias("a"), _every_other(x, 1).alias("b")))
        listed = short(F.flatten(F.transform(two, lambda x: _pair_list("list", x["a"], x["b"]))))
        parts.append(_if_held(holds(low, W.LIST_WORD, "<ul"), listed, _PAIRS))
    # a value that only repeats its label says nothing, but in a definition list it was meant
    told = F.filter(
        F.concat(*parts),
        lambda p: (p["label"] != "") & (p["value"] != "") & ((p["label"] != p["value"]) | (p["strategy"] == "dl")),
    )
    return F.transform(
        told, lambda p, i: F.struct(p["strategy"].alias("strategy"), i.cast("int").alias("pos"), p["label"].alias("label"), p["value"].alias("value"))
    )


# --- what a page tells by wording ---------------------------------------------------------------------
def _following(html: Column, words: Sequence[str], tags: str) -> Column:
    """Text of the first element of ``tags`` behind a heading with one of the words."""
    return _present(once(_behind_heading(html, words), lambda x: inner_text(first_content(x, opening_tag(tags)))))


def _named_seller(html: Column) -> Column:
    """First text in a seller box that is neither a caption, a number nor a word of three letters."""
    box = first_content(html, opening_tag("div", _having("class", rf"""[^"'>]*(?:{W.SELLER_CLASSES})[^"'>]*""")))
    lines = F.transform(F.split(box, "<[^>]*>"), lambda x: squeeze(unescape_html(x)))
    caption = rf"^(?:{'|'.join(W.SELLER_NOT_BEGINNINGS)}|\d)|^[\u0600-\u06FF]{{1,3}}$"
    names = F.filter(lines, lambda x: (F.length(x) > 2) & ~x.isin(W.SELLER_NOT_NAMES) & ~x.rlike(caption))
    return F.substring(_at(names, 0), 1, W.MAX_SELLER)


def _worded_fields(html: Column, low: Column, links: Column) -> dict[str, Column]:
    """EXT-2: fields that pages without rules of their own give away by wording or link targets."""
    leaves = matches(html, rf"(?is)<(span|div|p|h2|strong)\b[^>]*>([^<]{{1,{W.MAX_PRICE}}})</\1>", 2)
    # reading entities and blanks makes no price mark, so only leaves with one are read
    marked = F.transform(F.filter(leaves, lambda x: x.rlike(W.PRICE_MARKS)), inner_text)
    priced = F.filter(marked, lambda x: x.rlike(W.PRICE_MARKS) & x.rlike(r"\d"))
    calls = F.filter(links, lambda x: x.startswith("tel:"))
    chats = F.filter(links, lambda x: x.contains("wa.me") & ~x.startswith("tel:"))
    worded = lambda words, found: F.when(holds_any(low, words), found)
    seller = F.substring(worded(W.SELLER_HEADINGS, _following(html, W.SELLER_HEADINGS, "div|p|span|h4|h5")), 1, W.MAX_SELLER)
    return {
        "price_raw": _at(priced, 0),
        "description_raw": worded(W.DESCRIPTION_HEADINGS, _following(html, W.DESCRIPTION_HEADINGS, "div|p|section")),
        "seller_name": F.coalesce(seller, worded(W.SELLER_CLASSES.split("|"), _present(_named_seller(html)))),
        "phone_link": _at(calls, 0),
        "whatsapp_link": _at(chats, 0),
    }


def _noted_fields(html: Column, low: Column, raw: Column) -> dict[str, Column]:
    note = rf"(?is)<(h[2-5])\b[^>]*>[^<]*(?:{W.NOTES_HEADING})[^<]*</\1>(?:\s|<br[^>]*>){{0,9}}<([a-z][a-z0-9]*)\b[^>]*>(.*?)</\2>"
    return {
        "script_phone": F.when(raw.contains("let phone"), _present(_first(raw, r"let phone\s*=\s*'([^']+)'", 1))),
        "seller_notes": F.when(holds_any(low, ["ملاحظات", "seller"]), _present(inner_text(_first(html, note, 3)))),
    }


_FEATURES = "array<struct<section:string,name:string>>"


def _section_features(html: Column, low: Column) -> Column:
    """EXT-4: ``(section, name)`` of checked features in table sections and of lists in feature boxes, or
    else of lists behind a caption that speaks of safety or features."""
    named = lambda section, names: F.transform(
        F.filter(names, lambda n: n != ""), lambda n: F.struct(section.alias("section"), n.alias("name"))
    )
    cells = element_contents(html, opening_tag("td", _having("colspan", "2")), "td")
    checked = opening_tag("span", _class("flex"), _class("items-center")) + r"\s*" + r"<span\b" + _class("rounded-full") + _class("bg-emerald-100") + r"[^>]*>\s*</span>([^<]+)"
    title = lambda cell: F.regexp_replace(inner_text(first_content(cell, opening_tag("div", _class("py-1")), "div")), r"[:\s]+$", "")
    ticks = F.flatten(F.transform(cells, lambda c: named(title(c), F.transform(matches(c, f"(?is){checked}", 2), inner_text))))
    boxes = element_contents(html, opening_tag("div", _having("class", rf"""[^"'>]*{W.FEATURE_CLASSES}[^"'>]*""")), "div")
    caption = lambda box: inner_text(first_content(box, opening_tag(HEADING)))
    listed = F.flatten(F.transform(boxes, lambda b: named(caption(b), _texts(b, "li"))))
    ticks = _if_held(holds(low, "<td", "colspan", "bg-emerald-100"), ticks, _FEATURES)
    listed = _if_held(holds(low, "<div", W.FEATURE_WORD), listed, _FEATURES)
    words = "|".join([*W.SAFETY_WORDS, *W.FEATURE_WORDS])
    behind = rf"(?is)<(h[2-4]|p|span)\b[^>]*>([^<]*(?:{words})[^<]*)</\1>(?:\s|</?div\b[^>]*>){{0,9}}<ul\b[^>]*>(.*?)</ul>"
    loose = F.arrays_zip(matches(html, behind, 2).alias("a"), matches(html, behind, 3).alias("b"))
    loose = F.flatten(F.transform(loose, lambda x: named(inner_text(x["a"]), _texts(x["b"], "li"))))
    loose = _if_held(holds(low, "<ul") & holds_any(low, [*W.SAFETY_WORDS, *W.FEATURE_WORDS]), loose, _FEATURES)
    return once(F.concat(ticks, listed), lambda found: F.when(F.size(found) > 0, found).otherwise(loose))


def _image_links(tags: Column) -> Column:
    first = lambda tag: F.coalesce(*[_present(_attribute(tag, n)) for n in ("data-lg-src", "src", "data-src", "data-lazy")])
    return F.filter(F.transform(tags, first), lambda x: x.isNotNull())


def page_images(html: Column, source: str) -> Column:
    """Image links in page order: all of them, or those of the gallery where a source has one."""
    tags = matches(html, r"(?is)<img\b[^>]*>", 0)
    if source == "portal":
        own = F.filter(tags, lambda t: t.rlike(f"(?is)<img{_class(W.GALLERY_IMAGE)}"))
        other = F.filter(tags, lambda t: _attribute(t, "src").contains(W.CAR_IMAGE))
        return _image_links(once(own, lambda x: F.when(F.size(x) > 0, x).otherwise(other)))
    if source == "accordion":
        album = _image_links(matches(first_content(html, opening_tag("", _class(W.ALBUM))), r"(?is)<img\b[^>]*>", 0))
        preview = matches(html, f"(?is)<meta{_having('property', 'og:image')}[^>]*>", 0)
        shown = F.filter(F.transform(preview, lambda t: _attribute(t, "content")), lambda x: x != "")
        return once(album, lambda x: F.when(F.size(x) > 0, x).otherwise(shown))
    return _image_links(tags)


def extract_pages(
    pages: DataFrame, source: str = "generic", key: Sequence[str] = ("url",), html: str = "html"
) -> DataFrame:
    """EXT-1/2/4/6/7: one row per page with everything its rules and its wording tell.

    ``key, fields, pairs, images, features, dates, scripts, profiles``.
    """
    raw = F.coalesce(F.col(html), F.lit(""))
    rows = pages.select(*key, raw.alias("_raw")).withColumn("_low", F.lower("_raw"))
    html_, raw_, low = F.col("_html"), F.col("_raw"), F.col("_low")
    quiet = F.regexp_replace(raw_, r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1>", "")
    rows = rows.withColumn("_html", F.when(holds_any(low, ["<!--", "<script", "<style"]), quiet).otherwise(raw_))
    found_links = F.transform(matches(html_, r"(?is)<a\b[^>]*>", 0), lambda t: _attribute(t, "href"))
    rows = rows.withColumns({"_low": F.lower("_html"), "_links": found_links})
    links = F.col("_links")
    own = _fields(html_, low, _rules(source, "page"))
    more = _worded_fields(html_, low, links) if source == "generic" else _noted_fields(html_, low, raw_)
    fields = {name: F.coalesce(*[f[name] for f in (own, more) if name in f]) for name in {**own, **more}}
    published = matches(html_, f"(?is)<meta{_having('property', 'article:published_time')}[^>]*>", 0)
    times = matches(html_, r"(?is)<time\b[^>]*\sdatetime=[^>]*>", 0)
    dates = F.concat(F.transform(published, lambda t: _attribute(t, "content")), F.transform(times, lambda t: _attribute(t, "datetime")))
    dates = _if_held(holds_any(low, ["article:published_time", "<time"]), dates, "array<string>")
    scripts = matches(raw_, f"(?is)<script{_having('type', 'application/ld[+]json')}[^>]*>(.*?)</script>", 1)
    scripts = _if_held(raw_.contains("<") & F.lower(raw_).contains("ld+json"), scripts, "array<string>")
    # as rows of a generator the fields are found once, whatever reads them and whatever filter stands above
    found = rows.select(*key, "_raw", "_html", "_low", "_links", F.inline(F.array(F.struct(_map_of(fields).alias("fields")))))
    return found.select(
        *key,
        "fields",
        layout_pairs(html_, source, low).alias("pairs"),
        page_images(html_, source).alias("images"),
        _section_features(html_, low).alias("features"),
        dates.alias("dates"),
        scripts.alias("scripts"),
        F.filter(links, lambda x: x.contains("/users/") | x.contains("/dealer/")).alias("profiles"),
    )


def extract_cards(
    pages: DataFrame, source: str, key: Sequence[str] = ("url",), html: str = "html"
) -> DataFrame:
    """EXT-3/EXT-8: one row per card of each page, in page order: ``key, pos, fields, images, items``.

    A link that opens right before a card surrounds it.
    """
    whole, *parts = _rules(source, "card")
    begin = ("" if whole.tag == "a" else r"(?:<a\b[^>]*>\s*)?") + _opening(whole)
    blocks = pieces_from(F.coalesce(F.col(html), F.lit("")), begin)
    attribute = r"""(?is)\s(data-[\w-]+|href)\s*=\s*["']([^"']*)["']"""

    def carried(opening: Column, known: Sequence[str]) -> Column:
        """Attributes of the card's own tag; of one that it repeats, the first counts."""
        values = F.transform(matches(opening, attribute, 2), lambda x: F.trim(unescape_html(x)))
        both = F.arrays_zip(matches(opening, attribute, 1).alias("key"), values.alias("value"))
        first = lambda e, i: F.array_position(F.transform(both, lambda x: x["key"]), e["key"]) == i + 1
        return F.filter(F.filter(both, first), lambda e: ~e["key"].isin(list(known)))

    def read(x: Column) -> Column:
        fields = {"card_text": inner_text(x["card"]), **_fields(x["inside"], x["low"], parts)}
        if whole.tag != "a":
            fields["parent_url"] = _present(_attribute(_first(x["card"], r"(?is)^<a\b[^>]*>", 0), "href"))
        own = F.concat(F.map_entries(_map_of(fields)), carried(x["opening"], list(fields)))
        return F.struct(
            F.map_from_entries(own).alias("fields"), _image_links(matches(x["inside"], r"(?is)<img\b[^>]*>", 0)).alias("images"),
            _texts(x["inside"], "li").alias("items"),
        )

    def card(text: Column) -> Column:
        opening, inside = _first(text, f"(?is){_opening(whole)}", 0), F.regexp_replace(text, f"(?is)^{begin}", "")
        parted = F.struct(text.alias("card"), opening.alias("opening"), inside.alias("inside"))
        return once(parted, lambda x: once(x.withField("low", F.lower(x["inside"])), read))

    # the cards are read where they are exploded, so that whatever reads them finds what was found once
    cards = pages.select(*key, F.posexplode(F.transform(blocks, card)).alias("pos", "_card"))
    return cards.select(*key, "pos", "_card.fields", "_card.images", "_card.items")


# --- interpretation (column expressions) -------------------------------------------------------------
def settle_pairs(pairs: Column) -> Column:
    """EXT-1: one value per label. Grids, definition lists and tables overwrite each other (last
    wins); divs and paired lists only add labels that are not there yet (first wins)."""
    strong = F.filter(pairs, lambda p: p["strategy"].isin("grid", "dl", "table"))
    weak = F.filter(pairs, lambda p: ~p["strategy"].isin("grid", "dl", "table"))
    labels = F.array_distinct(F.concat(F.transform(strong, lambda p: p["label"]),
                                       F.transform(weak, lambda p: p["label"])))

    def value(name: Column) -> Column:
        of = lambda side: F.filter(side, lambda p: p["label"] == name)
        return F.coalesce(
            F.try_element_at(of(strong), F.lit(-1))["value"],
            F.try_element_at(of(weak), F.lit(1))["value"],
        )

    return F.transform(
        labels,
        lambda name, i: F.struct(
            i.cast("int").alias("pos"), name.alias("label"), value(name).alias("value")
        ),
    )


def field(name: str) -> Column:
    return blank_to_null(F.try_element_at("fields", F.lit(name)))


def generic_details(facts: DataFrame, key: Sequence[str] = ("url",)) -> DataFrame:
    """EXT-2: raw detail rows (title, price, specs, description, seller, images, contact)."""
    images = keep_photos(F.transform("images", unwrap_image_url))
    return facts.select(
        *key,
        field("title_raw").alias("title_raw"),
        field("price_raw").alias("price_raw"),
        field("description_raw").alias("description_raw"),
        field("seller_name").alias("seller_name"),
        F.coalesce(field("phone"), phone_of_link()).alias("phone"),
        F.coalesce(whatsapp_number(field("whatsapp_link")), field("whatsapp_link")).alias("whatsapp"),
        settle_pairs(F.col("pairs")).alias("specs"),
        images.alias("images"),
    )


def phone_of_link() -> Column:
    return blank_to_null(F.trim(F.replace(field("phone_link"), F.lit("tel:"), F.lit(""))))


def json_ld(path: str) -> Column:
    """First embedded JSON-LD document that has ``path``."""
    found = F.transform("scripts", lambda s: F.get_json_object(s, path))
    return F.try_element_at(F.array_compact(found), F.lit(1))


def page_date() -> Column:
    """DAT-6: page meta, then time elements (first that is a date), then JSON-LD."""
    listed = F.array_compact(F.transform("dates", iso_date))
    return first_date(F.try_element_at(listed, F.lit(1)), iso_date(json_ld("$.datePublished")))


def page_vehicle() -> Column:
    """JSN-2 over the first JSON-LD document."""
    return vehicle_from_json_ld(F.try_element_at("scripts", F.lit(1)))


def feature_list(section: str) -> Column:
    """EXT-4: distinct checked features of a named section, in page order."""
    own = F.filter("features", lambda f: f["section"] == section)
    return F.array_distinct(F.transform(own, lambda f: f["name"]))


def split_features() -> tuple[Column, Column]:
    """EXT-4: ``(general, safety)`` features by words in the section heading."""
    def names(safe: bool) -> Column:
        hit = F.filter(
            "features", lambda f: contains_any(f["section"], SAFETY_WORDS) == F.lit(safe)
        )
        return F.array_distinct(F.transform(hit, lambda f: f["name"]))

    return names(False), names(True)


def card_date() -> Column:
    """Card date: compact attribute, time element, then a month name in the card text."""
    return first_date(
        compact_date(field("data-date")), iso_date(field("time_attr")),
        month_name_date(field("time_text")), month_name_date(field("card_text")),
    )


def dealer_rows(cards: DataFrame) -> DataFrame:
    """EXT-8: dealer directory rows; placeholder locations become NULL."""
    place = squeeze(field("location"))
    return cards.select(
        squeeze(field("dealer_name")).alias("dealer_name"),
        field("profile_url").alias("profile_url"),
        squeeze(field("cars_count")).alias("cars_count"),
        squeeze(field("phone_masked")).alias("phone_masked"),
        F.when(~place.isin(V.NO_LOCATION), place).alias("location"),
        field("dealer_id").alias("dealer_id"),
        F.lit(None).cast("string").alias("phone"),
    )


# --- flat markup, without leaving the JVM -------------------------------------------------------------
def tag_texts(html: Column, tag: str) -> Column:
    """Inner text of every ``tag`` element (elements of that tag must not nest)."""
    inner = F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>"), 1)
    return F.transform(inner, lambda x: squeeze(F.regexp_replace(x, "<[^>]*>", "")))


def table_pairs(html: Column) -> Column:
    """EXT-1 for two-cell table rows, natively."""
    row = r"(?is)<tr[^>]*>\s*<t[dh][^>]*>(.*?)</t[dh]>\s*<t[dh][^>]*>(.*?)</t[dh]>"
    text = lambda x: squeeze(F.regexp_replace(x, "<[^>]*>", ""))
    labels, values = (F.regexp_extract_all(html, F.lit(row), g) for g in (1, 2))
    return F.transform(
        F.arrays_zip(labels.alias("a"), values.alias("b")),
        lambda p, i: F.struct(
            i.cast("int").alias("pos"), text(p["a"]).alias("label"), text(p["b"]).alias("value")
        ),
    )


def link_targets(html: Column) -> Column:
    """``href`` of every link, in page order."""
    return F.regexp_extract_all(html, F.lit(r'(?i)<a\s[^>]*?href="([^"]*)"'), 1)
