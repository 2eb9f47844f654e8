"""Readers, writers, catalog, registry and streaming feeds."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from adloom.functions import fixed_values as V
from adloom.operators import pages as P
from adloom.operators.incremental import first_by_key
from adloom.plans import flatten as L
from adloom.plans.listings import parse_listings, project_source, raw_cards
from adloom.sources import catalog as C
from adloom.sources import envelope as E
from adloom.sources import schemas, tables
from adloom.sources.registry import SourceProfile, get_source, register_source, registered_sources
from adloom.streaming import feeds


def variants(spark, *documents):
    frame = spark.createDataFrame([(json.dumps(d),) for d in documents], "body string")
    return frame.select(F.try_parse_json("body").alias("item"))


# --- envelopes -------------------------------------------------------------------------------------
def test_envelopes(spark, tmp_path):
    for i, body in enumerate(['[{"k": 1}]', '{"data": {"x": 1}, "results": [{"k": 2}, {"k": 3}]}', '{"data": [], "ads": [{"k": 4}]}', "<html>"]):
        (tmp_path / f"{i}.json").write_text(body)
    items = E.read_envelope_json(spark, str(tmp_path))
    assert sorted(r.k for r in items.select(F.try_variant_get("item", "$.k", "int").alias("k")).collect()) == [1, 2, 3]
    items = E.read_envelope_json(spark, str(tmp_path), ["data", "ads"], require_non_empty=True)
    assert sorted(r.k for r in items.select(F.try_variant_get("item", "$.k", "int").alias("k")).collect()) == [1, 4]


def test_totals_and_classifier(spark):
    found = variants(spark, {"total": "9", "count": 7}, {"meta": {"totalItems": 3}}, {"pagination": {"last_page": 4}}).select(
        E.envelope_total(F.col("item")).alias("t"), E.last_page(F.col("item")).alias("p")
    )
    assert [(r.t, r.p) for r in found.collect()] == [(7, None), (3, None), (None, 4)]
    url = F.lit("https://x/search/ads?p=1")
    frame = variants(spark, {"data": [{"price": None}]}, {"data": [{"name": 1}]}, {"data": []}, [{"published_date": "x"}])
    assert [r.c for r in frame.select(E.is_listing_payload(url, F.col("item")).alias("c")).collect()] == [True, False, False, True]
    assert not frame.select(E.is_listing_payload(F.lit("https://x/cats"), F.col("item")).alias("c")).first().c


def test_a_present_blank_key_of_the_detail_wins(spark):
    frame = variants(spark, {"id": 5, "title_ar": "", "price": 0}).withColumn("listing", F.try_parse_json(F.lit('{"title_ar": "x", "price": 3, "year": 2015}')))
    row = L.flatten_classified(frame, "src", "u/{id}", listing="listing").first()
    assert (row.id, row.car_url, row.ad_title, row.price, row.year, row.featured) == ("src_5", "u/5", None, None, "2015", "False")
    assert row.image_urls == [] and list(row.asDict()) == schemas.COLUMNS["classified_raw"]


def test_advert_attributes_first_value_stays(spark):
    item = {
        "id": 1, "title": "كيا ريو 2016", "category": "text", "make": "Kia",
        "attributes": [{"slug": "color", "value": "x"}, {"key": "color", "value": "y"}, {"name_ar": "الوقود", "value_ar": "gas"}, "junk"],
        "featured_fields": [{"template_field": {"slug": "nope", "field_name_ar": "السنة"}, "value": {"en": "2016"}}],
    }
    row = L.flatten_advert(variants(spark, item), "src", "u/").first()
    assert (row.exterior_color, row.fuel_type, row.year, row.make, row.model) == ("x", "غاز", "2016", "Kia", "ريو")
    with pytest.raises(ValueError):
        L.flatten_advert(variants(spark, item), "src", "u/", form="other")


# --- tables ------------------------------------------------------------------------------------------
def test_cells_and_round_trip(spark, tmp_path):
    frame = spark.createDataFrame([("1", 5.0, ["a", "b"], None, True), ("2", 2.5, [], dt.date(2026, 1, 2), False)],
                                  "id string, price double, urls array<string>, d date, flag boolean")
    cells = tables.to_cells(frame, ["id", "urls", "price", "d", "missing", "flag"])
    assert [tuple(r) for r in cells.orderBy("id").collect()] == [("1", "a, b", "5", "", "", "true"), ("2", "", "2.5", "2026-01-02", "", "false")]
    path = str(tmp_path / "sheet")
    tables.append_table(frame, path, ["id", "urls"])
    tables.append_table(frame.limit(1), path, ["id", "urls"])
    assert tables.read_listing_table(spark, path, ["id", "urls"]).count() == 3
    tables.overwrite_table(frame, path, ["id", "urls"])
    numbered = tables.read_listing_table(spark, path, number_rows=True)
    assert numbered.count() == 2 and "row_num" in numbered.columns


def test_ragged_rows_and_empty_rows(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,a,b\n1,x\n,,\n2,y,z\n", encoding="utf-8")
    found = tables.read_listing_table(spark, str(tmp_path), ["id", "a", "b"]).orderBy("id").collect()
    assert [tuple(r) for r in found] == [("1", "x", None), ("2", "y", "z")]


def test_known_ids(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text('{"id": "a"}\n{broken\n{"id": " "}\n{"id": null}\n{"id": "a"}\n{"id": "b"}\n')
    assert sorted(r.id for r in tables.read_known_ids(spark, str(tmp_path)).collect()) == ["a", "b"]
    out = str(tmp_path / "out")
    frame = spark.createDataFrame([("c", ["ا", "b"])], "id string, urls array<string>")
    tables.append_jsonl(frame, out)
    tables.append_jsonl(frame, out)
    lines = [json.loads(r.value) for r in spark.read.text(out).collect()]
    assert lines == [{"id": "c", "urls": ["ا", "b"]}] * 2


def test_schema_alignment():
    plan = tables.plan_alignment
    assert plan(["id", "b"], ["id", "a", "b"], "exact").reset
    assert not plan(["id"], ["id"], "exact").reset
    inserted = plan(["id", "b"], ["id", "a", "b"], "insert")
    assert inserted.columns == ["id", "a", "b"] and inserted.added == ["a"]
    assert plan(["x"], ["id"], "insert").reset
    assert plan(["b", "id", "z"], ["id", "b"], "append").columns == ["b", "id", "z"]
    assert plan(["id"], ["id", "b"], "append").columns == ["id", "b"]
    odd = plan(["id", "z"], ["id", "b"], "append")
    assert odd.columns == ["id", "z"] and odd.unknown == ["z"] and not odd.added
    assert plan([], ["id"], "append").columns == ["id"]


def test_profiles_have_the_stated_widths():
    widths = {"unified": 27, "classified_raw": 33, "portal_raw": 33, "advert_raw": 25, "grid_raw": 32, "portal_wide": 26,
              "advert_wide": 35, "accordion_wide": 37, "classified_wide": 31, "dealers": 7, "dealer_directory": 8}
    assert {k: len(v) for k, v in schemas.COLUMNS.items()} == widths
    assert all(len(set(v)) == len(v) for v in schemas.COLUMNS.values())


def test_unified_rows(spark):
    card = {"source": "src", "id": "1", "title_raw": "Kia Rio 2016 جديدة", "price_raw": "$5,000", "location_raw": " حلب ", "listing_type": "rent",
            "description_raw": "قطعت 90,000 كم بنزين automatic", "phone": "1", "whatsapp": "2", "images": ["u", ""],
            "specs": [(0, "السنة", "2015"), (1, "سنة الصنع", "2017"), (2, "المصدر", "x"), (3, "رقم الهيكل", "متاح عند التواصل")]}
    names = [p.split(" ")[0] for p in schemas.RAW_CARD.replace("pos:int,label:string,value:string", "").split(", ")]
    frame = spark.createDataFrame([tuple(card.get(n) for n in names)], schemas.RAW_CARD)
    row = parse_listings(frame, as_of=F.lit("now")).first()
    assert list(row.asDict()) == schemas.COLUMNS["unified"]
    assert (row.brand, row.model, row.year, row.mileage, row.fuel_type, row.transmission) == ("Kia", "Rio", 2017, "90,000 كم", "بنزين", "أوتوماتيك")
    assert (row.condition, row.location, row.price, row.listing_type, row.vin, row.contact) == ("جديدة", "حلب", 5000.0, "إيجار", None, "1 | WA:2")
    assert row.ad_title == "Kia Rio 2017 جديدة للإيجار في حلب" and row.images == '["u"]' and row.scraped_at == "now"
    reversed_labels = parse_listings(frame.withColumn("specs", F.expr("array(struct(0 AS pos, 'الموديل' AS label, 'كيا' AS value))")), V.REVERSED_LABELS).first()
    assert (reversed_labels.brand, reversed_labels.model) == ("Kia", "Rio")
    assert project_source(frame, "portal_wide").columns == schemas.COLUMNS["portal_wide"]


# --- pages -------------------------------------------------------------------------------------------
def test_nested_markup(spark):
    html = ("<div class='spec-x'><div>a</div><div>1</div></div><div class='spec-x'><div>a</div><div>2</div></div>"
            "<table><tr><th>b</th><td>3</td></tr><tr><td>b</td><td>4</td></tr><tr><td>c</td><td>c</td></tr></table>"
            "<script>var x='<h1>no</h1>';</script><h1>yes &amp; no<p>unclosed")
    facts = P.extract_pages(spark.createDataFrame([("u", html), ("v", None)], "url string, html string"))
    rows = {r.url: r for r in P.generic_details(facts).collect()}
    assert [(p.label, p.value) for p in rows["u"].specs] == [("b", "4"), ("a", "1")]
    assert rows["u"].title_raw.startswith("yes & no") and rows["v"].specs == []


def test_seller_boxes_notes_chapters_and_flat_features(spark):
    box = "<div class='seller-info-box'><span>المعلن</span><p>حساب تجاري</p><p>معرض النور</p></div>"
    html = ("<h3>ملاحظات</h3><br><div>good <b>car</b></div><a href='tel:1'>x</a><script>let phone = '77';</script>"
            "<h4 class='single-listing-chapter-title'>x</h4><ul><li>A</li><li>B</li><li>1</li><li>2</li></ul><h4 class='single-listing-chapter-title'>y</h4>"
            "<p>ميزات</p><ul><li>roof</li></ul><div><span>أمان</span></div><div><ul><li>abs</li></ul></div>")
    pages = spark.createDataFrame([("u", box + html)], "url string, html string")
    general, safety = P.split_features()
    row = P.extract_pages(pages, "portal").select(
        P.field("seller_name").alias("s"), P.field("seller_notes").alias("n"), P.field("script_phone").alias("p"), P.field("phone_link").alias("t"),
        "pairs", general.alias("g"), safety.alias("f"),
    ).first()
    assert (row.s, row.n, row.p, row.t, row.g, row.f) == (None, "good car", "77", None, ["roof"], ["abs"])
    assert [(p.label, p.value) for p in row.pairs if p.strategy == "halves"] == [("A", "1"), ("B", "2")]
    plain = P.generic_details(P.extract_pages(pages)).first()
    assert (plain.seller_name, plain.phone) == ("معرض النور", "1")


def test_gallery_images(spark):
    html = "<meta property='og:image' content='o'><img src='x/car-image.jpg'><img class='single-listing-gallery-image' data-lg-src='g'><div class='container-images-album'><img src='a'></div>"
    pages = spark.createDataFrame([("u", html), ("v", "<meta property='og:image' content='o'><img src='x/car-image.jpg'>")], "url string, html string")
    found = {s: [r.images for r in P.extract_pages(pages, s).orderBy("url").collect()] for s in ("portal", "accordion", "generic")}
    assert found["portal"] == [["g"], ["x/car-image.jpg"]]
    assert found["accordion"] == [["a"], ["o"]]
    assert found["generic"] == [["x/car-image.jpg", "g", "a"], ["x/car-image.jpg"]]


def test_tile_and_column_cards(spark):
    tile = ("<div class='product'><div class='text-orange'>5$</div><span class='bg-purple'>Kia</span><h5 class='product-title'>T</h5>"
            "<li>2015</li><li>90 كم</li><div class='text-muted'>حلب | اليوم</div><a class='btn-whatsapp' href='https://wa.me/963?t=/ads/77'></a></div>")
    cards = P.extract_cards(spark.createDataFrame([("u", tile)], "url string, html string"), "tiles")
    row = raw_cards(cards, F.lit("src")).first()
    assert (row.id, row.price_raw, row.location_raw, row.posted_date, row.whatsapp) == ("src_77", "5$", "حلب", "اليوم", "963")
    assert {(p.label, p.value) for p in row.specs} == {("الماركة", "Kia"), ("السنة", "2015"), ("الكيلومترات", "90 كم")}
    column = ("<a href='/car/1'><div class='card'><img class='card-img-top' src='/i.jpg'><h5>Kia</h5><h6><span>Rio</span></h6><h6 class='text-primary'>T</h6>"
              "<div class='col-6'><div class='col-12'>حلب</div><div class='col-12'>5 كم</div></div></div></a>")
    row = raw_cards(P.extract_cards(spark.createDataFrame([("u", column)], "url string, html string"), "columns"), F.lit("src")).first()
    assert (row.ad_url, row.title_raw, row.location_raw, row.images) == ("/car/1", "T", "حلب", ["/i.jpg"])
    assert ("الموديل", "Rio") in {(p.label, p.value) for p in row.specs}


# --- catalog and ledgers -----------------------------------------------------------------------------
def test_catalog(spark, tmp_path):
    sites = [{"id": "a", "name": "Alpha", "url": "https://a", "type": "cars", "scraper_class": "Abc", "scraper_file": "a.py", "enabled": True, "priority": 2,
              "scheduling": {"enabled": True, "frequency": "weekly", "day": "Monday", "time": "09:00"}, "last_run": "2026-05-04T18:35:33"},
             {"id": "b", "name": "B", "url": "x", "type": "boats", "priority": 1}]
    (tmp_path / "catalog.json").write_text(json.dumps({"app": 1, "websites": sites}))
    catalog = C.load_catalog(spark, str(tmp_path / "catalog.json"))
    first = catalog.filter("id = 'a'").first()
    assert first.scheduling_day == "Monday" and first.last_run == dt.datetime(2026, 5, 4, 18, 35, 33)
    known = catalog.filter("id = 'a'")
    migrated = C.migrate_catalog(known, catalog)
    assert sorted((r.name, r.enabled, r.total_items) for r in migrated.collect()) == [("Alpha", True, None), ("B", False, 0)]
    errors = {r.id: len(r.errors) for r in C.validate_catalog(catalog).collect()}
    assert errors == {"a": 0, "b": 5}
    assert [r.id for r in C.ordered_catalog(catalog).collect()] == ["b", "a"]
    assert [r.id for r in C.enabled_catalog(catalog).collect()] == ["a"]
    assert C.find_website(catalog, "name", "B").count() == 1
    added = C.add_websites(known, spark.createDataFrame([("c", "Gamma"), ("d", "Alpha")], "id string, name string"))
    assert sorted((r.name, r.image_folder) for r in added.collect() if r.id != "a") == [("Gamma", "images/gamma")]


def test_ledgers(spark, tmp_path):
    jobs, stats, audit = (str(tmp_path / n) for n in ("jobs", "stats", "audit"))
    C.record_run(spark, jobs, "a", status="success", items_count=3, completed_at=dt.datetime(2026, 1, 1))
    C.record_run(spark, jobs, "a", status="error", items_count=1, completed_at=dt.datetime(2026, 1, 2))
    C.save_statistics(spark, stats, "a", 3, 1, {"سعر": 1})
    C.log_audit(spark, audit, 1, "update", "website", "a", {"k": 2})
    with pytest.raises(ValueError):
        C.record_run(spark, jobs, "a", nonsense=1)
    ledger = spark.read.parquet(jobs)
    latest = C.latest_runs(ledger).first()
    assert (latest.last_run_status, latest.last_run_count) == ("error", 1)
    assert json.loads(spark.read.parquet(stats).first().raw_statistics) == {"سعر": 1}
    assert spark.read.parquet(audit).first().details == '{"k": 2}'
    assert ledger.select("id").distinct().count() == 2


def test_registry():
    profile = SourceProfile("test-source", labels={"a": "make"}, columns=("id",))
    register_source(profile)
    assert get_source("test-source") is profile and "test-source" in registered_sources()
    with pytest.raises(ValueError):
        register_source(profile)
    assert get_source("nobody").name == "cars" and get_source("nobody", "realestate").name == "realestate"


# --- streams -------------------------------------------------------------------------------------------
SCHEMA = "id string, n int, make string, fuel_type string, price double, date_added date"


def land(path, name, rows):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(json.dumps(r) for r in rows))


def test_incremental_runs_resume_and_equal_a_batch(spark, tmp_path):
    landing, target, progress = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "progress")
    one = [{"id": f"k{i % 7}", "n": i, "date_added": "2026-01-02"} for i in range(20)]
    two = [{"id": f"k{i % 9}", "n": 100 + i, "date_added": "2026-01-02"} for i in range(18)] + [{"id": "old", "n": 1, "date_added": "2020-01-01"}, {"n": 5}]
    sink = feeds.append_unseen(target, order=["n"], start="2026-01-01")
    run = lambda: feeds.run_available(feeds.read_listing_stream(spark, str(landing), SCHEMA, max_files=1), sink, progress, 120)
    land(landing, "1.json", one)
    run()
    first = sorted((r.id, r.n) for r in spark.read.parquet(target).collect())
    assert first == [(f"k{i}", i) for i in range(7)]
    run()
    assert sorted((r.id, r.n) for r in spark.read.parquet(target).collect()) == first
    land(landing, "2.json", two)
    run()
    streamed = sorted((r.id, r.n) for r in spark.read.parquet(target).collect())
    batch = spark.read.schema(SCHEMA).json(str(landing)).filter("date_added >= '2026-01-01'")
    assert streamed == sorted((r.id, r.n) for r in first_by_key(batch, ["id"], ["n"]).collect())


def test_stateful_dedup_running_stats_and_payloads(spark, tmp_path):
    landing = tmp_path / "in"
    land(landing, "1.json", [{"id": "a", "make": "kia", "price": 2.0}, {"id": "a", "make": "kia", "price": 4.0}])
    stream = feeds.read_listing_stream(spark, str(landing), SCHEMA)
    seen = feeds.drop_seen_within(stream.withColumn("at", F.lit(dt.datetime(2026, 1, 1))), "id", "at", "1 day")
    counted = []
    feeds.run_available(seen, lambda batch, _: counted.append(batch.count()), str(tmp_path / "p1"))
    assert sum(counted) == 1
    feeds.run_complete(feeds.running_stats(stream), str(tmp_path / "stats"), str(tmp_path / "p2"))
    row = spark.read.parquet(str(tmp_path / "stats")).first()
    assert (row.make, row.listings, row.avg_price) == ("kia", 2, 3.0)
    payloads = tmp_path / "payloads"
    payloads.mkdir()
    (payloads / "a.json").write_text('{"data": [{"k": 1}, {"k": 2}]}')
    items = []
    sink = lambda batch, _: items.extend(r.k for r in batch.select(F.try_variant_get("item", "$.k", "int").alias("k")).collect())
    feeds.run_available(feeds.read_payload_stream(spark, str(payloads)), sink, str(tmp_path / "p3"))
    assert sorted(items) == [1, 2]


def test_unknown_values_accumulate(spark, vocabulary, tmp_path):
    landing, ledger = tmp_path / "in", str(tmp_path / "ledger")
    sink = feeds.append_unknown_values(ledger, vocabulary)
    for name, fuels in (("1.json", ["steam", "Diesel"]), ("2.json", ["steam", "wind"])):
        land(landing, name, [{"id": name, "fuel_type": f} for f in fuels])
        feeds.run_available(feeds.read_listing_stream(spark, str(landing), SCHEMA), sink, str(tmp_path / "progress"))
    assert sorted(r.value for r in spark.read.parquet(ledger).collect()) == ["steam", "wind"]


def test_built_in_profiles_know_their_columns():
    from adloom.plans.profiles import BUILT_IN, register_built_in

    register_built_in()
    for profile in BUILT_IN:
        assert get_source(profile.name).columns and callable(profile.flatten)


# --- a whole batch ---------------------------------------------------------------------------------------
def test_ingest_batch(spark, vocabulary):
    from adloom.operators.gates import mandatory_gate
    from adloom.plans.ingest import ingest_batch

    cards = spark.createDataFrame(
        [("1", 1, "Kia - كيا", "ريو", "2016", dt.date(2026, 2, 1)), ("1", 2, "x", "x", "2016", None), ("2", 1, "كيا", "ريو", "2016", dt.date(2026, 2, 1)),
         ("3", 1, "كيا", "", "2016", None), ("4", 1, "كيا", "ريو", "2016", dt.date(2020, 1, 1)), ("5", 1, "كيا", "ريو", "2009", None), (None, 1, "كيا", "ريو", "2016", None)],
        "id string, n int, make string, model string, year string, date_added date",
    )
    known = spark.createDataFrame([("2",)], "id string")
    details = spark.createDataFrame([("1", "سيراتو", "+963"), ("3", "", "+963")], "id string, model string, phone string")
    batch = ingest_batch(
        cards, known, details, vocabulary, start="2026-01-01", least_year=2015, order=["n"], strip_compounds=True,
        gate=lambda rows: mandatory_gate(rows, ["make", "model", "phone"]),
    )
    assert [(r.id, r.make, r.model, r.phone) for r in batch.accepted.collect()] == [("1", "كيا", "ريو", "+963")]
    assert [(r.id, r.reasons) for r in batch.rejected.collect()] == [("3", ["model"])]


# --- packaging ---------------------------------------------------------------------------------------
def test_python_tasks_find_the_package_from_any_folder(tmp_path):
    import subprocess
    import sys
    from pathlib import Path

    home = str(Path(__file__).resolve().parent.parent)
    script = tmp_path / "job.py"
    script.write_text(
        f"import sys\nsys.path.insert(0, {home!r})\n"
        "from adloom.session import build_session\nfrom adloom.functions.similarity import ratio\n"
        "spark = build_session('job', 'local[1]', **{'spark.ui.enabled': 'false'})\n"
        "print('RATIO', spark.createDataFrame([('abcd', 'bcde')], 'a string, b string').select(ratio('a', 'b')).first()[0])\n",
        encoding="utf-8",
    )
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, capture_output=True, text=True, timeout=180, env={**__import__("os").environ, "PYTHONPATH": ""})
    assert "RATIO 0.75" in done.stdout, done.stderr[-2000:]
