"""Feed, gate, merge, spec and statistics operators on small fixtures."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from adloom.operators import enrich as E
from adloom.operators import gates as G
from adloom.operators import incremental as I
from adloom.operators import specs as S
from adloom.operators import stats as A


def rows(frame, *columns):
    return sorted(tuple(r[c] for c in columns) for r in frame.collect())


# --- feeds ---------------------------------------------------------------------------------------
def walk(pages, patience):
    """The run as a loop over pages: (new, kept) flags per row; the last page read, or None."""
    streak = 0
    for page in sorted(pages):
        new = [k for n, k in pages[page] if n]
        if not new:
            streak += 1
        else:
            streak = 0 if any(new) else 1
        if streak >= patience:
            return page
    return None


@pytest.mark.parametrize("patience", [1, 2, 3])
def test_caught_up_equals_the_loop(spark, patience):
    rng = random.Random(patience)
    feeds = {
        f: {p: [(rng.random() < 0.15, rng.random() < 0.5) for _ in range(rng.randint(1, 4))] for p in range(40)}
        for f in "abcdef"
    }
    data = [(f, p, n, k) for f, pages in feeds.items() for p, items in pages.items() for n, k in items]
    frame = spark.createDataFrame(data, "feed string, page int, is_new boolean, kept boolean")
    found = dict(frame_max(I.caught_up_cutoff(frame, patience, feed=["feed"], kept="kept")))
    for feed, pages in feeds.items():
        last = walk(pages, patience)
        assert found[feed] == (39 if last is None else last)
    plain = {f: {p: [(n, True) for n, _ in items] for p, items in pages.items()} for f, pages in feeds.items()}
    found = dict(frame_max(I.caught_up_cutoff(frame, patience, feed=["feed"])))
    for feed, pages in plain.items():
        last = walk(pages, patience)
        assert found[feed] == (39 if last is None else last)


def frame_max(frame):
    return [(r.feed, r.page) for r in frame.groupBy("feed").agg(F.max("page").alias("page")).collect()]


def test_known_rows_are_dropped_and_keyless_rows_stay(spark):
    new = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "id string, n int")
    known = spark.createDataFrame([("a",), ("a",), (None,)], "id string")
    assert sorted(r.n for r in I.keep_unseen(new, known).collect()) == [2, 3]
    both = spark.createDataFrame([("a", "x"), ("y", "a"), ("y", "x")], "source_id string, source_slug string")
    assert rows(I.keep_unseen_either(both, known.dropna(), ["source_id", "source_slug"]), "source_id") == [("y",)]


def test_duplicates(spark):
    schema = "id string, title string, price string"
    existing = spark.createDataFrame([("1", "Kia", "5"), ("", "x", "1"), ("9", None, None)], schema)
    new = spark.createDataFrame(
        [("1", "other", "7"), ("2", " KIA ", "5"), ("", "y", "1"), ("3", "", None), ("4", "new", "1"), ("4", "new", "1")], schema
    )
    unique, duplicates = I.split_duplicates(new, existing)
    assert rows(unique, "id", "title") == [("", "y"), ("4", "new"), ("4", "new")]
    assert rows(duplicates, "id") == [("1",), ("2",), ("3",)]
    strict = I.mark_duplicates(new, existing, blank_matches=False)
    assert not strict.filter("id = '3'").first().is_duplicate
    assert new.columns == unique.columns


def test_first_and_last(spark):
    frame = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("a", 1, "b"), (None, 0, "z")], "k string, n int, v string")
    assert rows(I.first_by_key(frame, ["k"], ["n"]), "k", "n", "v") == [("a", 1, "b")]
    assert rows(I.last_by_key(frame.dropna(), ["k"], "v", "n"), "k", "v") == [("a", "x")]


def test_dates_and_years(spark):
    day = lambda n: dt.date(2026, 1, n)
    frame = spark.createDataFrame([(1, day(1), "2014"), (2, day(5), "x"), (3, None, None), (4, day(9), "2015")], "n int, date_added date, year string")
    pick = lambda f: [r.n for r in f.orderBy("n").collect()]
    assert pick(I.filter_date_range(frame, "2026-01-05", "2026-01-05")) == [2, 3]
    assert pick(I.filter_date_range(frame, "2026-01-02", keep_null=False)) == [2, 4]
    assert pick(I.filter_min_year(frame)) == [2, 3, 4]
    assert pick(I.boundary_stop(frame.withColumn("seq", -F.col("n")), "2026-01-06", "seq")) == [3, 4]
    paged = frame.withColumn("page", F.when(F.col("n") < 3, 1).otherwise(2))
    assert rows(I.pages_before_cutoff(paged, "2026-01-06"), "page", "all_before") == [(1, True), (2, False)]
    undated = frame.filter("n = 3").withColumn("page", F.lit(1))
    assert rows(I.pages_before_cutoff(undated, "2026-01-06"), "all_before") == [(False,)]


# --- gates and covers ----------------------------------------------------------------------------
def test_gates(spark):
    frame = spark.createDataFrame(
        [("1", "kia", "5 $", "1600", ["u"]), ("2", "N/A", "1", "abc", []), ("3", " ", "x", "99", None)],
        "id string, make string, price string, engine_size string, image_urls array<string>",
    )
    reasons = {r.id: r.reasons for r in G.quality_gate(frame, ["make"]).collect()}
    assert reasons == {
        "1": [], "2": ["make", "price_value", "engine_value", "images"],
        "3": ["make", "price_value", "engine_value", "images"],
    }
    accepted, rejected = G.split_gate(G.mandatory_gate(frame, ["make", "price"]))
    assert rows(accepted, "id") == [("1",)] and rows(rejected, "id") == [("2",), ("3",)]
    broken = spark.createDataFrame([("1", "", "a, b"), ("2", "", " ,"), (None, "", "a"), ("4", "x", "a")], "id string, links string, orig string")
    assert rows(G.needs_image_repair(broken, "links"), "id") == [("1",), ("2",)]
    found = G.needs_image_repair(broken, "links", "orig").collect()
    assert [(r.id, r.image_urls) for r in found] == [("1", ["a", "b"])]


def test_cover(spark):
    meta = [("a", 0, "p", 100, 200, 90.0), ("a", 1, "dark", 200, 100, 10.0), ("a", 2, "good", 200, 100, 90.0),
            ("b", 1, "only", 100, 200, 90.0), ("b", 2, "next", 100, 200, 90.0), ("c", 0, "blind", None, None, None)]
    frame = spark.createDataFrame(meta, "id string, idx int, url string, width int, height int, brightness double")
    assert rows(G.cover_images(frame), "id", "cover_url") == [("a", "good"), ("b", "only"), ("c", "blind")]


# --- merging and lookups ---------------------------------------------------------------------------
def test_merges(spark):
    spec = "array<struct<pos:int,label:string,value:string>>"
    cards = spark.createDataFrame(
        [("1", "card", "", "5", [(0, "a", "1"), (1, "b", "2")], ["i"]), ("2", "card", "d", None, None, [])],
        f"id string, title_raw string, description_raw string, price_raw string, specs {spec}, images array<string>",
    )
    details = spark.createDataFrame(
        [("1", "detail", "long", "9", [(0, "b", "3")], [], "me")],
        f"id string, title_raw string, description_raw string, price_raw string, specs {spec}, images array<string>, seller_name string",
    )
    joined = E.join_details(cards, details)
    one, two = E.merge_unified(joined).orderBy("id").collect()
    assert (one.title_raw, one.description_raw, one.price_raw, one.images, one.seller_name) == ("card", "long", "5", ["i"], "me")
    assert [(p.label, p.value) for p in one.specs] == [("a", "1"), ("b", "3")]
    assert (two.title_raw, two.description_raw, two.price_raw) == ("card", "d", None)
    assert E.merge_clean_card(joined).orderBy("id").first().title_raw == "detail"
    blank = E.override_present(joined.withColumn("detail_title_raw", F.lit("")), ["title_raw"])
    assert [r.title_raw for r in blank.orderBy("id").collect()] == ["", "card"]


def test_dealers_and_contacts(spark):
    cars = spark.createDataFrame(
        [(1, "dealer", " Bob ", "1"), (2, "dealer", "bob", "2"), (3, "private", "Bob", "3"), (4, "dealer", "bob", "")],
        "row_num int, seller_type string, seller_name string, phone string",
    )
    dealers = spark.createDataFrame([("BOB", ""), ("Ann", "")], "dealer_name string, phone string")
    found = E.enrich_dealers(dealers, cars)
    assert rows(found.fillna(""), "dealer_name", "phone") == [("Ann", ""), ("BOB", "2")]
    rate = E.phone_match_rate(found).first()
    assert (rate.matched, rate.dealers, rate.match_rate) == (1, 2, 0.5)
    links = spark.createDataFrame([("u", "", 0), ("u", "12 سيارة", 1), ("u", "Name", 2), ("u", "Other", 3), ("v", "", 4)], "username string, text string, pos int")
    found = E.aggregate_dealers(links).orderBy("username").collect()
    assert [(r.dealer_name, r.car_count) for r in found] == [("Name", "12"), ("v", None)]
    items = spark.createDataFrame([("1", ""), ("2", "x"), ("3", None)], "id string, contact string")
    contacts = spark.createDataFrame([("1", None, "w"), ("2", "p", "w")], "id string, phone string, whatsapp string")
    assert rows(E.fill_contacts(items, contacts).fillna(""), "id", "contact") == [("1", "w"), ("2", "x"), ("3", "")]


# --- specs -----------------------------------------------------------------------------------------
def test_specs_first_and_last(spark):
    labels = {"A": "year", "B": "year", "C": "_skip", "D": "make"}
    pairs = [(1, 0, "B", ""), (1, 1, "A", "1"), (1, 2, "B", "2"), (1, 3, "C", "x"), (1, 4, "Z", "y")]
    frame = spark.createDataFrame(pairs, "id int, pos int, label string, value string")
    assert rows(S.pivot_specs(frame, labels, keep="first"), "id", "year", "make") == [(1, "1", None)]
    assert rows(S.pivot_specs(frame, labels, keep="last"), "id", "year", "make") == [(1, "2", None)]
    inside = frame.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("pos", "label", "value"))).alias("specs"))
    for keep, year in (("first", "1"), ("last", "2")):
        row = S.with_specs(inside, "specs", labels, keep).first()
        assert (row.year, row.make) == (year, None)


def test_zip_cuts_to_the_shorter_list(spark):
    frame = spark.createDataFrame([(["a", "b"], ["1"]), ([], ["1"])], "k array<string>, v array<string>")
    found = frame.select(S.zip_pairs(F.col("k"), F.col("v")).alias("p")).collect()
    assert [[(p.label, p.value) for p in r.p] for r in found] == [[("a", "1")], []]


# --- statistics ------------------------------------------------------------------------------------
def cars(spark):
    return spark.createDataFrame(
        [("Kia", None, "Rio", "2015", "1,000 $", "SUV", "بنزين", "دمشق"), ("", "Kia", "Rio", "x", "0", "N/A", None, "دمشق"),
         ("Audi", None, None, "2017", "free", None, "بنزين", None)],
        "brand string, make string, model string, year string, price string, body_type string, fuel_type string, location string",
    )


def test_statistics(spark):
    frame = cars(spark)
    assert rows(A.top_makes(frame), "name", "count") == [("Audi", 1), ("Kia", 2)]
    assert rows(A.make_model_combos(frame), "model", "count") == [("Audi Unknown", 1), ("Kia Rio", 2)]
    year = A.year_stats(frame).first()
    assert (year.avg_year, year.min_year, year.max_year) == (2016.0, 2015, 2017)
    price = A.price_stats(frame).first()
    assert (price.avg_price, price.min_price, price.max_price) == (1000.0, 1000.0, 1000.0)
    assert rows(A.distribution(frame, "body_type"), "body_type", "count") == [("SUV", 1)]
    assert rows(A.distribution(frame, "fuel_type", A.UNKNOWN), "fuel_type", "count") == [("Unknown", 1), ("بنزين", 2)]
    filled = {r.field: r.populated for r in A.field_population(frame).collect()}
    assert filled["brand"] == 2 and filled["body_type"] == 1 and filled["price"] == 3
    stats = A.scraper_stats(frame).first()
    assert stats.total_items == 3 and stats.price_stats["count"] == 1 and stats.year_stats.average == 2016
    assert stats.items_with_complete_data == 1
    empty = A.scraper_stats(frame.limit(0)).first()
    assert empty.total_items == 0 and empty.price_stats["average"] == 0 and empty.year_stats["max"] == 0


def test_market_analysis_matches_single_statistics(spark):
    frame = cars(spark).withColumn("transmission", F.lit("x"))
    found = {(r.section, r.name): (r["count"], r.value) for r in A.market_analysis(frame).collect()}
    assert found[("top_makes", "Kia")] == (2, None)
    assert found[("most_common_models", "Audi Unknown")] == (1, None)
    assert found[("fuel_type_distribution", "Unknown")] == (1, None)
    assert found[("total", "items")] == (None, 3.0)
    assert found[("price_stats", "avg")] == (None, 1000.0)
    assert ("body_type_distribution", "N/A") not in found


def test_rank_within_keeps_the_best_and_whole_groups(spark):
    data = [("a", f"n{i:02d}", i % 7) for i in range(30)] + [("b", f"m{i}", i) for i in range(9)]
    frame = spark.createDataFrame(data, "dimension string, name string, n int")
    kept = A.rank_within(frame, {"a": 3})
    assert rows(kept.filter("dimension = 'a'"), "name") == [("n06",), ("n13",), ("n20",)]
    assert kept.filter("dimension = 'b'").count() == 9


def test_run_counters(spark):
    frame = spark.createDataFrame([(True, False), (False, None), (True, True)], "is_new boolean, accepted boolean")
    found = A.run_counters(frame).first()
    assert (found.seen, found.new, found.saved, found.skipped, found.duplicate, found.fixed) == (3, 2, 1, 1, 0, 0)


# --- skewed joins ----------------------------------------------------------------------------------
@pytest.fixture()
def small_skew(spark):
    changes = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {k: spark.conf.get(k, None) for k in changes}
    for k, v in changes.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def final_plan(frame):
    frame.write.format("noop").mode("overwrite").save()
    rows = frame.collect()
    return rows, frame._jdf.queryExecution().executedPlan().toString()


def hot(spark, n=20_000):
    """Seven rows in ten share a key."""
    key = F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise(F.col("id").cast("string"))
    filler = F.sha2(F.col("id").cast("string"), 256)
    return spark.range(n).repartition(6).select(key.alias("id"), filler.alias("title"), F.lit("1").alias("price"))


@pytest.mark.parametrize(
    "join",
    [
        lambda new, known: I.keep_unseen(new, known),
        lambda new, known: I.keep_unseen_either(new, known, ["id"]),
        lambda new, known: I.mark_duplicates(new, known, fields=()),
        lambda new, known: I.mark_duplicates(new, known, key=None, fields=("id", "price")),
    ],
)
def test_a_hot_key_is_split(spark, small_skew, join):
    new = hot(spark)
    known = spark.range(3000).select(F.col("id").cast("string").alias("id"), F.lit("t").alias("title"), F.lit("1").alias("price"))
    rows, plan = final_plan(join(new, known))
    assert "skew=true" in plan
    assert len(rows) in (20_000, 20_000 - 900)


def test_rows_without_an_id_are_dealt_out(spark, small_skew):
    new = hot(spark).withColumn("id", F.when(F.col("id") != "hot", F.col("id")))
    known = spark.range(3000).select(F.col("id").cast("string").alias("id"))
    marked = I.mark_duplicates(new, known, fields=())
    assert marked.filter("is_duplicate").count() == 900 and marked.filter("id IS NULL AND is_duplicate").count() == 0


def test_normalisation_joins_listing_rows_twice(spark, vocabulary):
    from adloom.operators.resolve import normalize_listings

    rows = spark.createDataFrame([("هيونداي", "tucson", "ابيض", "دمشق", "بنزين")] * 3, "make string, model string, color string, location string, fuel_type string")
    plan = normalize_listings(rows, vocabulary)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 2


def test_similar_pairs_are_few(spark):
    from adloom.operators.resolve import folded_candidates, numbered_characters, similar_pairs

    assert spark.range(1).select(numbered_characters(F.lit("abab")).alias("c")).first()["c"] == ["a1", "b1", "a2", "b2"]
    words = ["amber", "beige", "coral", "dunes", "ebony", "frost", "green", "hazel"]
    names = [f"{a} {b}" for a in words for b in words]
    candidates = spark.createDataFrame([("l", i, n) for i, n in enumerate(names)], "list string, ord int, name string")
    values = spark.createDataFrame([("l", n[:4] + n[5:]) for n in names], "list string, folded string")
    pairs = similar_pairs(values, folded_candidates(candidates), 0.8).count()
    assert len(names) <= pairs < len(names) ** 2 / 5


def test_gaps_in_page_numbers_do_not_break_a_run(spark):
    pages = [(1, True), (2, False), (5, False), (90, False), (91, True), (92, False)]
    frame = spark.createDataFrame(pages, "page int, is_new boolean")
    assert rows(I.caught_up_cutoff(frame, 3), "page") == [(1,), (2,), (5,), (90,)]
