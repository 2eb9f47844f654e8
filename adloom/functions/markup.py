"""Elements of markup as column expressions, those that hold others of their own name included (EXT-1 to EXT-4).

An element begins at an opening tag and ends at its own closing tag: behind the opening, the tags of its name are
laid out as an array, each with the text before it, and a running depth (one up per opening, one down per
closing) tells at which of them it is back at zero. Where that never happens the element has no content.

Most elements hold none of their own name. So all are first cut at the next closing tag, in one pass over the
page, and only a page in which one of those contents opens its own name again is laid out.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def opening_tag(name: str = "", *conditions: str) -> str:
    """Pattern of an opening tag; its name is the first group."""
    return rf"<({name or '[a-z][a-z0-9]*'})(?=[\s>/]){''.join(conditions)}[^>]*>"


def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, whatever number of times it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def holds(low: Column, *words: str) -> Column:
    """Whether a lower-cased page has all the words. A search for a substring is some twenty times cheaper than a
    pattern over the page, so it goes before patterns that cannot match without the words."""
    found = F.lit(True)
    for word in words:
        found = found & low.contains(word.lower())
    return found


def holds_any(low: Column, words) -> Column:
    found = F.lit(False)
    for word in words:
        found = found | low.contains(word.lower())
    return found


def matches(html: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(html, F.lit(pattern), F.lit(group))


def content_length(behind: Column, name: Column) -> Column:
    """How far the element goes whose opening tag of ``name`` ends where ``behind`` begins; null if it never ends."""
    tag = F.concat(F.lit("(?is)</?"), name, F.lit(r"(?=[\s>/])[^>]*>"))
    tags = F.regexp_extract_all(behind, tag, F.lit(0))
    gaps = F.split(behind, tag)
    start = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("length"))
    step = F.arrays_zip(tags.alias("tag"), F.slice(gaps, F.lit(1), F.size(tags)).alias("gap"))

    def walk(at: Column, x: Column) -> Column:
        closes = x["tag"].startswith("</")
        depth = at["depth"] + F.when(closes, -1).when(x["tag"].endswith("/>"), 0).otherwise(1)
        length = at["length"] + F.length(x["gap"]) + F.when(depth == 0, 0).otherwise(F.length(x["tag"]))
        return F.when(at["depth"] == 0, at).otherwise(F.struct(depth.alias("depth"), length.alias("length")))

    return F.aggregate(step, start, walk, lambda at: F.when(at["depth"] == 0, at["length"]))


def _opens_again(x: Column, name: str = "") -> Column:
    """Whether the content cut at the next closing tag opens its own name. Text without tags is not searched, and
    ``regexp_instr`` keeps its compiled pattern from row to row, which ``rlike`` does for literals only."""
    opening = F.lit(rf"(?i)<{name}[\s>/]") if name else F.concat(F.lit("(?i)<"), x["name"], F.lit(r"[\s>/]"))
    return x["content"].contains("<") & (F.regexp_instr(x["content"], opening) > 0)


def _flat(opening: str) -> str:
    return rf"(?is){opening}(.*?)(?:</\1>|\z)"


def element_contents(html: Column, opening: str, name: str = "") -> Column:
    """Content of each element that begins with ``opening`` (a pattern whose first group is the name), in page
    order, inner ones too; null where the element nests its own name and never closes. One that nests nothing
    and is never closed takes the rest of the page. A ``name`` that is the same for all saves a pass."""
    contents = matches(html, _flat(opening), 2)
    if name:
        found = F.transform(contents, lambda c: F.struct(F.lit(name).alias("name"), c.alias("content")))
    else:
        found = F.arrays_zip(matches(html, _flat(opening), 1).alias("name"), contents.alias("content"))
    rests = F.arrays_zip(
        matches(html, f"(?is){opening}", 1).alias("name"), matches(html, f"(?is){opening}(?=(.*))", 2).alias("rest")
    )
    own = lambda x: F.lit(name) if name else x["name"]
    deep = F.transform(rests, lambda x: F.substring(x["rest"], F.lit(1), content_length(x["rest"], own(x))))
    return once(found, lambda cut: F.when(F.exists(cut, lambda x: _opens_again(x, name)), deep).otherwise(F.transform(cut, lambda x: x["content"])))


def first_content(html: Column, opening: str, name: str = "") -> Column:
    """Content of the first such element; empty without one."""
    own = F.lit(name) if name else F.regexp_extract(html, _flat(opening), 1)
    found = F.struct(own.alias("name"), F.regexp_extract(html, _flat(opening), 2).alias("content"))
    rest = F.regexp_extract(html, rf"(?is){opening}(.*)", 2)

    def settle(x: Column) -> Column:
        deep = once(rest, lambda r: F.substring(r, F.lit(1), content_length(r, x["name"])))
        return F.when(_opens_again(x, name), deep).otherwise(x["content"])

    return once(found, settle)


def pieces_from(html: Column, begin: str) -> Column:
    """A page cut before each match of ``begin``: from one to the next. What lies before the first is left out."""
    starts, gaps = matches(html, f"(?is){begin}", 0), F.split(html, f"(?is){begin}")
    return F.zip_with(starts, F.slice(gaps, F.lit(2), F.size(starts)), lambda a, b: F.concat(a, b))
