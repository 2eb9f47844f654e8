"""Elements that hold others of their own name, against a plain walk over the tags."""

import random
import re

import pytest
from pyspark.sql import functions as F

from adloom.functions import markup as M
from adloom.operators import pages as P


def plain_contents(html, name, wanted):
    """Content of each ``name`` element whose tag ``wanted`` accepts, by counting tags; None where it never closes."""
    tags = list(re.finditer(rf"(?is)<(/?){name}(?=[\s>/])[^>]*>", html))
    out, nested = [], False
    for i, tag in enumerate(tags):
        if tag[1] or not wanted(tag[0]):
            continue
        depth, end = 1, None
        for later in tags[i + 1 :]:
            depth += -1 if later[1] else 0 if later[0].endswith("/>") else 1
            if not depth:
                end = later.start()
                break
        out.append(html[tag.end() : end] if end is not None else None)
    return out


def contents(spark, html, opening):
    return spark.createDataFrame([(html,)], "html string").select(M.element_contents(F.col("html"), opening)).first()[0]


@pytest.mark.parametrize("html", [
    "<div>a</div><div>b</div>", "<div><div>a</div> b</div>", "<div>1<div>2<div>3</div>4</div>5</div>6<DIV x='y'>7</dIv>",
    "<div>a<div/>b</div>c", "<div><div>never</div>", "<ul><li>a<ul><li>b</li></ul></li><li>c</li></ul>", "", "<divider>x</divider><div>y</div>",
])
def test_own_closing_tags(spark, html):
    for name in ("div", "li", "ul"):
        assert contents(spark, html, M.opening_tag(name)) == plain_contents(html, name, lambda tag: True)


def test_random_trees(spark):
    draw = random.Random(4)
    pages = []
    for _ in range(60):
        parts = [draw.choice(["<div>", "<div class='k'>", "</div>", "</div>", "<p>", "</p>", "x ", "é"]) for _ in range(draw.randrange(30))]
        pages.append("<div>" + "".join(parts) + "</div>" * draw.randrange(12))
    frame = spark.createDataFrame(list(enumerate(pages)), "id int, html string")
    rows = frame.select("id", M.element_contents(F.col("html"), M.opening_tag("div", r"(?=[^>]*\bclass='k')")).alias("c")).collect()
    checked = 0
    for r in rows:
        plain = plain_contents(pages[r.id], "div", lambda tag: "class='k'" in tag)
        if any(c is not None and re.search(r"(?i)<div[\s>/]", c) for c in plain):  # else the next closing tag is its own
            assert r.c == plain
            checked += 1
    assert checked > 5


def test_first_content_of_an_unclosed_nest_is_null(spark):
    frame = spark.createDataFrame([("<p>t</p><div><div>a</div> b",), ("<div>rest of it",), ("none",), ("<div>a<div>b</div>c</div>d",)], "html string")
    got = [r[0] for r in frame.select(M.first_content(F.col("html"), M.opening_tag("div"))).collect()]
    assert got == [None, "rest of it", "", "a<div>b</div>c"]


def test_repeated_attributes_and_nested_cards(spark):
    html = "<a data-ad-id='1' data-ad-id='2' href='/x'><span class='bg-custom_light_gray'>A <span>B</span> &gt; C</span></a><a data-ad-id='3'></a>"
    cards = P.extract_cards(spark.createDataFrame([("u", html)], "url string, html string"), "grid").orderBy("pos").collect()
    assert [c.fields["data-ad-id"] for c in cards] == ["1", "3"] and cards[0].fields["make_model"] == "A B > C"


def test_headings_with_inner_tags(spark):
    html = "<h3><i class='icon'></i> الوصف <b>:</b></h3><div><div>first</div> second</div>"
    facts = P.extract_pages(spark.createDataFrame([("u", html)], "url string, html string"))
    assert P.generic_details(facts).first().description_raw == "first second"


def test_long_pages_take_time_in_proportion(spark):
    html = "<div class='stm-listing-description'>" + "<div>x</div>" * 20_000 + "</div>tail"
    facts = P.extract_pages(spark.createDataFrame([("u", html)], "url string, html string"), "portal")
    assert len(facts.select(P.field("description_raw")).first()[0]) == 2 * 20_000 - 1
