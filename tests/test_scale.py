"""Work that has to grow no faster than its input: tasks, passes and files of single operators."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from adloom.operators import pages as P

DATA = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
def test_pages_of_a_table_of_one_file_are_read_by_many_tasks(spark):
    from adloom.plans.registered.pages import _part_pages

    assert _part_pages(spark, str(DATA)).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_a_layout_is_laid_out_once(spark):
    rows = spark.createDataFrame([("<table><tr><td>a</td><td>b</td></tr></table>",)], "html string")
    found = rows.select(P.layout_pairs(F.col("html"), "generic").alias("pairs"))
    assert [tuple(p) for p in found.first()["pairs"]] == [("table", 0, "a", "b")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("<tr") == 1
    assert plan.count("<(div|p)") == 1


def test_responses_that_share_a_file_are_judged_one_by_one(spark, tmp_path):
    from adloom.sources.quarantine import items_of, read_envelopes_checked

    (tmp_path / "a.txt").write_text('[{"id": 1}]\x1e{oops\x1e{"data":\n [{"id": 2}, {"id": 3}]}\x1e{"data": 5}\x1e', encoding="utf-8")
    checked = read_envelopes_checked(spark, str(tmp_path), end="\x1e")
    assert sorted((r["place"], r["reason"], r["value"]) for r in checked.bad.collect()) == [(1, "no JSON", "{oops"), (3, "no list of items", '{"data": 5}')]
    assert checked.good.count() == 2 and items_of(checked).count() == 3


def test_foreign_halves_are_split_once_and_only_where_there_are_halves(spark):
    from adloom.functions.text import strip_foreign

    rows = spark.createDataFrame([("Kia - كيا",), ("Kia",), (" - ",), ("a-b",), (None,), ("كيا – Kia",)], "x string")
    found = rows.select(strip_foreign(F.col("x")).alias("x"))
    assert [r["x"] for r in found.collect()] == ["كيا", "Kia", "-", "a-b", None, "كيا"]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("split(") <= 1


def test_parts_of_a_batch_are_not_drawn_into_one_task(spark, tmp_path):
    from adloom.operators.stats import StatisticsStore
    from adloom.plans.registered.streams import _files_for

    store = StatisticsStore(spark, str(tmp_path / "parts"))
    parts = spark.range(100).selectExpr("'make' AS dimension", "CAST(id % 50 AS STRING) AS name", "id AS n")
    store.add(0, parts.repartition(3))
    assert len(list((tmp_path / "parts" / "batch=0").glob("*.parquet"))) == 3
    assert store.read().count() == 50
    assert [_files_for(n) for n in (0, 600_000, 10_000_000, 60_000_000)] == [4, 4, 40, 240]


def test_layouts_and_features_are_looked_for_only_where_their_words_are(spark):
    item = "<li class='single-listing-data-item'><b class='single-listing-data-item-label'>a</b><i class='single-listing-data-item-value'>b</i></li>"
    html = f"<DL><DT>c</DT><DD>d</DD></DL>{item.upper()}<div class='Car-Detail'><div>e</div><div>f</div></div>"
    rows = spark.createDataFrame([("1", html), ("2", "<p>none</p>"), ("3", None)], "url string, html string")
    found = P.extract_pages(rows)
    pairs = {r["url"]: [(p["strategy"], p["label"], p["value"]) for p in r["pairs"]] for r in found.select("url", "pairs").collect()}
    assert pairs == {"1": [("dl", "c", "d"), ("item", "A", "B"), ("div", "e", "f")], "2": [], "3": []}
    plan = found.select("pairs", "features")._jdf.queryExecution().optimizedPlan().toString()
    for word in ("<dt", "single-listing-data-item", "single-listing-chapter-title", "box-accordion-"):
        assert re.search(rf"Contains\(_low#\d+, {word}\)", plan)


def test_objects_among_variants_are_told_without_their_schema(spark):
    from adloom.plans.flatten import attribute_pairs
    from adloom.sources.envelope import ITEMS

    text = """[{"template_field": {"slug": "mileage"}, "value": {"ar": " 5  km"}}, {"template_field": null, "slug": "mileage", "value": 7},
               {"template_field": "x", "key": "mileage", "value": ""}, {"slug": "unheard", "value": 1}, 3, null]"""
    rows = spark.createDataFrame([(text,)], "x string").select(F.try_variant_get(F.try_parse_json("x"), "$", ITEMS).alias("x"))
    found = rows.select(attribute_pairs(F.col("x")).alias("pairs"))
    assert [tuple(p) for p in found.first()["pairs"]] == [("mileage", "5 km"), ("mileage", "7")]
    assert "schema_of_variant" not in found._jdf.queryExecution().optimizedPlan().toString().lower()


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
@pytest.mark.parametrize("name", ["flatten_advert", "flatten_advert_production"])
def test_flattening_is_cut_into_methods_that_the_jvm_compiles(spark, name):
    from adloom.plans.registered import load_all

    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = load_all()[name].run(spark, str(DATA))._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    stages = debug.codegenStringSeq(plan)
    sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    assert sizes and max(sizes) < 8000


def test_missing_members_and_found_words_throw_nothing(spark):
    from adloom.plans.flatten import attribute_pairs
    from adloom.sources.envelope import member, with_texts

    rows = spark.createDataFrame([('{"a": null, "b": {"c": "0"}, "d": 0}', '{"a": 1, "e": "x"}')], "x string, y string")
    rows = rows.select(F.try_parse_json("x").alias("x"), F.try_parse_json("y").alias("y"))
    wanted = {"first": ["z", "a", "b.z", "b.c"], "zero": ["d"], "other": ["e"]}
    assert tuple(with_texts(rows, wanted, F.col("x")).select(*wanted).first()) == ("0", None, None)
    assert tuple(with_texts(rows, wanted, F.col("x"), F.col("y")).select(*wanted).first()) == ("0", None, "x")
    assert rows.select(F.to_json(member("a", F.col("x"), F.col("y")))).first()[0] == "null"
    plan = lambda c: rows.select(c.alias("c"))._jdf.queryExecution().optimizedPlan().toString()
    assert "$.a" not in plan(member("a", F.col("x"), F.col("y")))
    pairs = plan(attribute_pairs(F.try_variant_get("x", "$", "array<variant>")))
    assert "$.slug" not in pairs and " IN (" not in pairs


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
def test_batches_of_statistics_come_from_one_pass(spark, monkeypatch):
    from adloom.operators import stats as S
    from adloom.plans.registered import load_all

    added, add = [], S.StatisticsStore.add
    monkeypatch.setattr(S.StatisticsStore, "add", lambda self, batch, parts: (added.append((batch, parts)), add(self, batch, parts)))
    load_all()["market_analysis_batches"].run(spark, str(DATA))
    assert [batch for batch, _ in added] == [0, 1, 1, 2, 3]
    assert not any("lineitem" in f or "part.parquet" in f for _, parts in added for f in parts.inputFiles())


def test_parts_by_batch_equal_those_of_each_batch(spark):
    from adloom.operators import stats as S

    rows = [("a", "m", 1999, "b", "f", None, 5.0, 0), ("a", "n", 2000, None, "f", "t", 0.0, 1), ("c", None, None, "b", None, "t", 7.0, 1)]
    frame = spark.createDataFrame(rows, "make string, model string, year int, body_type string, fuel_type string, transmission string, price double, batch int")
    parts = S.partial_statistics(frame, by=["batch"])
    for batch in (0, 1):
        own = S.partial_statistics(frame.filter(F.col("batch") == batch).drop("batch"))
        assert parts.filter(F.col("batch") == batch).drop("batch").exceptAll(own).count() == 0
        assert own.exceptAll(parts.filter(F.col("batch") == batch).drop("batch")).count() == 0


def test_only_runs_that_begin_like_a_name_are_put_together(spark):
    from adloom.operators.mentions import find_mentions

    texts = spark.createDataFrame([("1", "big red car and a Big RED"), ("2", "red"), ("3", ""), ("4", None), ("5", "big")], "id string, text string")
    names = spark.createDataFrame([("big red car", 0), ("red", 1), ("Big red", 2), ("car and a big house", 3)], "name string, ord int")
    found = find_mentions(texts, names)
    assert sorted((r["id"], r["start"], r["size"], r["name"]) for r in found.collect()) == [("1", 0, 3, "big red car"), ("1", 5, 2, "Big red"), ("2", 0, 1, "red")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and "lambda" not in plan


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
def test_descriptions_of_a_table_of_one_file_are_mined_by_many_tasks(spark):
    from adloom.plans.registered import load_all

    mined = load_all()["description_mining"].run(spark, str(DATA))
    assert mined.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_bullets_are_found_once_and_other_patterns_tried_only_where_their_words_are(spark):
    from adloom.operators.specs import description_pairs, mine_description

    texts = ["▪اللون : - \n▪نوع الـوقود  :  ديزل\n• اللون : أحمر", "ماشية 12 الف كيلو", "سنة 1999\nتواجد حلب الجديدة", "📌العنوان : دمشق / القصور", "", None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    found = frame.select("id", description_pairs(F.col("text")).alias("pairs"))
    assert [tuple(p) for p in found.filter("id = 0").first()["pairs"]] == [(0, "اللون", None), (1, "نوع الوقود", "ديزل"), (2, "اللون", "أحمر")]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("regexp_extract_all") == 2
    mined = {r["id"]: (r["fuel_type"], r["color"], r["mileage"], r["year"], r["city"]) for r in mine_description(frame, "text", prefix="").collect()}
    none = (None,) * 5
    assert mined == {0: ("ديزل", "أحمر", None, None, None), 1: (None, None, "12000", None, None), 2: (None, None, None, "1999", "حلب الجديدة"),
                     3: (None, None, None, None, "دمشق"), 4: none, 5: none}


def test_values_are_read_once_for_containment(spark, tmp_path):
    from adloom.operators.resolve import folded_candidates, match_containment

    values = spark.createDataFrame([("l", "bc"), ("l", ""), ("l", "zz"), ("k", ""), ("l", "abcd")], "list string, folded string")
    values.write.parquet(str(tmp_path / "values"))
    names = folded_candidates(spark.createDataFrame([("l", 2, "abcd"), ("l", 1, "xbc"), ("l", 0, "q")], "list string, ord int, name string"))
    found = match_containment(spark.read.parquet(str(tmp_path / "values")), names)
    assert sorted(tuple(r) for r in found.collect()) == [("l", "", "q"), ("l", "abcd", "abcd"), ("l", "bc", "xbc")]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1


def test_a_mileage_is_cleaned_with_one_pattern(spark):
    from adloom.functions.numbers import clean_mileage, extract_mileage, price_digits

    texts = ["210 ألف", "210 ألف كم", "5 KM ", "5km\n", "5 \u212am", "km", "5 km km", "x km\x1f", "1,200\u2003كم\u2028", "٣ ألف", "ألف", " ", None, "12 كمx"]
    frame = spark.createDataFrame([(t,) for t in texts], "x string")
    done = frame.select(clean_mileage(F.col("x")).alias("m"), clean_mileage(F.col("x"), thousands=False).alias("p"))
    assert [r["m"] for r in done.collect()] == ["210000", "210000", "5", "5", "5", None, "5 km", "x km", "1200", "3000", "ألف", None, None, "12 كمx"]
    assert [r["p"] for r in done.collect()][:3] == ["210 ألف", "210 ألف", "5"]
    for make, most in ((clean_mileage, 1), (extract_mileage, 2), (price_digits, 2)):
        plan = frame.select(make(F.col("x")).alias("m"))._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("regexp_") <= most, plan


def test_listings_are_read_twice_to_normalise_them(spark, vocabulary, tmp_path, monkeypatch):
    from adloom.operators import resolve as R

    path, written, durable = str(tmp_path / "listings"), [], R.durable
    rows = [("Hyundai", "Tucson", "Diesel"), ("كيا", "rio", "مازوت"), (None, "x", None)]
    spark.createDataFrame(rows, "make string, model string, fuel_type string").write.parquet(path)
    monkeypatch.setattr(R, "durable", lambda df, **o: durable((written.append(df), df)[1], **o))
    done = R.normalize_listings(spark.read.parquet(path), vocabulary)
    reads = [df for df in [*written, done] if any("/listings/" in f for f in df.inputFiles())]
    assert len(reads) == 2
    assert sorted(r["model"] for r in done.collect()) == ["X", "توسان", "ريو"]


def test_a_null_among_the_texts_of_a_listing_counts(spark, vocabulary):
    from adloom.operators.resolve import normalize_listings

    rows = [("1", "رمادي", None), ("2", None, "رمادي"), ("3", None, None), ("4", " ", "رمادى")]
    frame = spark.createDataFrame(rows, "id string, exterior_color string, interior_color string")
    done = {r["id"]: (r["exterior_color"], r["interior_color"]) for r in normalize_listings(frame, vocabulary).collect()}
    assert done == {"1": ("رمادي", None), "2": (None, "رمادي"), "3": (None, None), "4": (None, "رمادي")}


def test_a_change_log_is_compiled(spark):
    from adloom.operators.repair import diff_columns

    rows = spark.createDataFrame([("1", "a", "b"), ("2", "a", "a"), ("3", None, "")], "id string, x string, new_x string")
    log = diff_columns(rows, {"x": "new_x"}, "id", allow_blank=True)[1]
    assert [tuple(r) for r in log.collect()] == [("1", "x", "a", "b")]
    assert "lambda" not in log._jdf.queryExecution().optimizedPlan().toString()
