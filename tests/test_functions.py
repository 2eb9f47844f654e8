"""Stated examples and traps of the column expressions."""

import datetime as dt
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from adloom.functions import dates as D
from adloom.functions import fixed_values as V
from adloom.functions import media as M
from adloom.functions import numbers as N
from adloom.functions import text as T
from adloom.functions.similarity import ratio

CASES = [
    (T.clean, "  a\xa0\t b ", "a b"),
    (T.clean, "null", None),
    (T.clean, "Null", "Null"),
    (T.clean, "N/A", "N/A"),
    (T.clean_dashes, "null", "null"),
    (T.clean_dashes, "—", None),
    (T.strip, "\xa0\t x 　", "x"),
    (T.fold_ar, " أوتومـاتيكة ", "اوتوماتيكه"),
    (T.alias_key, "إBMW", "اbmw"),
    (T.transliterate, "Check", "تشك"),
    (T.transliterate, "Rav4 é", "راف4"),
    (T.transliterate, "ckh", "كه"),
    (T.strip_brand_prefix, "Toyota Rav4", "Rav4"),
    (T.strip_brand_prefix, "kia", "kia"),
    (T.strip_brand_prefix, "Kiaro", "Kiaro"),
    (T.strip_brand_prefix, "Mercedes-Benz -C200", "C200"),
    (T.strip_variant_number, "IS 300", "IS"),
    (T.strip_variant_number, "IS 3000", "IS 3000"),
    (T.is_short_or_numeric, "GLE", True),
    (T.is_short_or_numeric, "golf", False),
    (T.is_short_or_numeric, "golf٥", True),
    (T.arabic_only, "كيا Kia", "كيا"),
    (T.arabic_only, "Kia", "Kia"),
    (T.strip_foreign, "BMW - بي ام دبليو", "بي ام دبليو"),
    (T.strip_foreign, "روج-Rogue", "روج"),
    (T.strip_foreign, "G class كل الفئات", "G class"),
    (T.strip_foreign, "كل الفئات", ""),
    (T.strip_foreign, "A-B", "A-B"),
    (T.strip_bidi, "‏ريو‬", "ريو"),
    (T.strip_km, "120,000 كم ", "120,000"),
    (T.strip_cc, "2000 CC", "2000"),
    (T.strip_hp, "199 حصان", "199"),
    (T.last_breadcrumb, "ريف دمشق ‏> قدسيا", "قدسيا"),
    (T.listing_type_of_title, "سيارة للتأجير", "للإيجار"),
    (T.listing_type_of_title, "سيارة", "للبيع"),
    (T.listing_type_of_code, "RENT", "إيجار"),
    (T.listing_type_of_code, None, "بيع"),
    (T.condition_of_title, "جديدة مستعملة", "مستعمل"),
    (T.extract_brand, "used range rover, kia", "Kia"),
    (T.extract_brand, "kiaro", "kiaro"),
    (T.extract_brand, "تويوتا", "Toyota"),
    (T.extract_brand, "for x", None),
    (T.validate_vin, "متاح عند التواصل", None),
    (T.validate_vin, "x" * 31, None),
    (T.validate_vin, " ABC123 ", "ABC123"),
    (T.html_to_text, "<p>a&nbsp;b</p><br>c &amp;lt; d  \n\n\n\ne", "a\xa0b\n\nc &lt; d\n\ne"),
    (T.html_to_text, "plain  \ntext", "plain\ntext"),
    (T.override_make, "مرسيدس بنز", "مرسيدس"),
    (T.rewrite_other, "اخري", "غير ذلك"),
    (T.trim_model_place, "ريو في دمشق", "ريو"),
    (T.trim_model_place, "في دمشق", None),
    (T.with_plus, "963", "+963"),
    (T.with_plus, "+963", "+963"),
    (N.clean_number, "11,800", "11800"),
    (N.clean_number, "2000 CC", "2000"),
    (N.clean_number, "$15,000", "15000"),
    (N.clean_number, "199 خيل", "199"),
    (N.clean_number, "199 HP 100", "199"),
    (N.clean_number, "2.0", "2"),
    (N.clean_number, "٢٠١٥", "٢٠١٥"),
    (N.clean_cylinders, "V", "V"),
    (N.parse_price, "$25,000.5", 25000.5),
    (N.parse_price, "1.2.3", None),
    (N.parse_price, "٢٠", 20.0),
    (N.price_digits, "12345678.0", "12345678"),
    (N.price_digits, "1.2.3", "1.2.3"),
    (N.price_digits, "12.50", "12.5"),
    (N.price_digits, "free", None),
    (N.price_with_commas, "10300", "10,300"),
    (N.first_number, "السعر 17,000 دولار", 17000.0),
    (N.first_number, "150 متر", 150.0),
    (N.first_number, ",", None),
    (N.parse_year, "كيا 2015", 2015),
    (N.parse_year, "12015", None),
    (N.parse_year, "1949", None),
    (N.clean_year, "قبل 1900", 1900),
    (N.clean_mileage, "150,000 كم", "150000"),
    (N.clean_mileage, "75٬000 km", "75000"),
    (N.clean_mileage, "210 ألف كم", "210000"),
    (N.clean_mileage, "245 ألف", "245000"),
    (N.extract_mileage, "قطعت 120,000 km", "120,000 km"),
    (N.extract_mileage, "2015 ثم 90000", "2015 كم"),
    (N.extract_mileage, "5 ثم 90000", None),
    (D.iso_date, "2026-05-07T08:12:39.000000Z", dt.date(2026, 5, 7)),
    (D.iso_date, "2026-13-07", None),
    (D.month_name_date, "مايو 15، 2026", dt.date(2026, 5, 15)),
    (D.month_name_date, "April 15, 2026", dt.date(2026, 4, 15)),
    (D.month_name_date, "Maybe 3 2020", dt.date(2020, 5, 3)),
    (D.compact_date, "202605071212", dt.date(2026, 5, 7)),
    (D.day_first_date, "x 05-07-2026", dt.date(2026, 7, 5)),
    (D.date_argument, "2026-07-05", dt.date(2026, 7, 5)),
    (D.date_argument, "yesterday", None),
    (M.images_from_json, '["a", "", null, "b"]', ["a", "b"]),
    (M.images_from_json, "oops", []),
    (M.images_from_text, " a\tb ", ["a", "b"]),
    (M.original_image_url, "http://x/a-768x1024.jpg?v=1", "http://x/a.jpg"),
    (M.larger_thumbnail, "x-thumb-sm_1", "x-thumb-md_1"),
    (M.unwrap_image_url, "/_next/image?url=https%3A%2F%2Fa.b%2Fc&w=1", "https://a.b/c"),
    (M.whatsapp_number, "https://wa.me/963?x", "963"),
    (M.last_segment, "http://x/dealer/bob/", "bob"),
    (lambda c: M.split_list(c, "|"), "a| b||c", ["a", "b", "c"]),
]


@pytest.mark.parametrize("function,value,expected", CASES)
def test_stated_values(evaluate, function, value, expected):
    assert evaluate(function, value) == expected


def test_titles(evaluate):
    build = lambda *parts: evaluate(T.build_ad_title, *parts)
    assert build("Toyota", "Camry", "2019", "بيع", "دمشق", None) == "Toyota Camry 2019 للبيع في دمشق"
    assert build("BMW", "X5", "2020", "إيجار", None, None) == "BMW X5 2020 للإيجار"
    assert build("Mazda", "Mazda 6", None, None, None, "جديدة") == "Mazda 6 جديدة للبيع"
    assert evaluate(T.extract_model, "Kia Rio 2015 دمشق", "kia") == "Rio"
    assert evaluate(T.extract_model, "C+ (x) 1", "C+") == "(x)"
    parsed = evaluate(T.parse_title, "للبيع سيارة بي ام دبليو 320 2010 مستعملة في دمشق")
    assert (parsed.make, parsed.model) == ("بي ام دبليو", "320")
    left = evaluate(lambda t, m, y: T.model_from_title(t, m, y), "كيا ريو 2015", "كيا", "2015")
    assert left == "ريو"


def test_contacts(evaluate):
    assert evaluate(T.build_contact, "1", "2") == "1 | WA:2"
    assert evaluate(T.build_contact, "1", "1") == "1"
    assert evaluate(T.build_contact, None, "2") == "WA:2"
    assert evaluate(T.contact_by_digits, "+1 2", "12") == "+1 2"
    assert evaluate(T.contact_by_digits, "0", "12") == "WA:12"
    assert evaluate(T.contact_by_substring, "+963 1", "9631") == "+963 1"
    assert evaluate(T.contact_by_substring, "", "9631") == "WA:9631"
    assert evaluate(T.choose_phone, "null", "5") == "5"
    found = evaluate(M.contact_from_json, '{"phone": "1", "car": {"phone": "2"}, "ad": {"phone": 3, "wa": " 9 "}}')
    assert (found.phone, found.whatsapp) == ("3", "9")


def test_relative_dates(spark):
    day = dt.date(2026, 5, 10)
    rows = [
        ("4 days ago", "", dt.date(2026, 5, 6)), ("2 months ago", "", dt.date(2026, 3, 11)),
        ("", "منذ 2 أسابيع", dt.date(2026, 4, 26)), ("", "الآن", day), ("3 hours ago", "", day),
        (None, None, day), ("soon", "منذ 3 سنوات", dt.date(2023, 5, 11)), ("soon", "soon", None),
    ]
    frame = spark.createDataFrame([(e, a) for e, a, _ in rows], "e string, a string")
    found = frame.select(D.relative_date(F.col("e"), F.col("a"), F.lit(day)).alias("d")).collect()
    assert [r.d for r in found] == [x for *_, x in rows]


def test_first_nonempty_and_keys(evaluate):
    assert evaluate(T.first_nonempty, None, "", "x") == "x"
    assert evaluate(lambda i, s: T.listing_key(F.lit("src"), i, s), "", "slug") == "src_slug"
    assert evaluate(lambda i, s: T.listing_key(F.lit("src"), i, s), " 7 ", "slug") == "src_7"
    assert evaluate(lambda c: M.absolute_url(c, "https://h/"), "/a") == "https://h/a"


def test_ratio_agrees_with_the_standard_library(spark):
    letters = random.Random(7)
    words = ["".join(letters.choice("abcdeاب ") for _ in range(letters.randint(0, 12))) for _ in range(80)]
    pairs = [(letters.choice(words), letters.choice(words)) for _ in range(400)] + [("tide", "diet"), ("diet", "tide")]
    frame = spark.createDataFrame(pairs, "a string, b string")
    for row in frame.withColumn("r", ratio("a", "b")).collect():
        assert row.r == SequenceMatcher(None, row.a, row.b).ratio()


def test_transliteration_against_a_plain_loop(spark):
    table = {**V.DIGRAPHS, **V.LETTERS}

    def spell(word):
        out, i, word = "", 0, word.strip().lower()
        while i < len(word):
            if word[i : i + 2] in table:
                out, i = out + table[word[i : i + 2]], i + 2
            else:
                out += table.get(word[i], "" if word[i].isalpha() else word[i])
                i += 1
        return out.strip()

    letters = random.Random(3)
    words = ["".join(letters.choice("achkqusgtoephx 1-é") for _ in range(9)) for _ in range(500)]
    frame = spark.createDataFrame([(w,) for w in words], "w string")
    for row in frame.withColumn("r", T.transliterate(F.col("w"))).collect():
        assert row.r == spell(row.w), row.w


def test_folding_is_idempotent(spark):
    letters = random.Random(5)
    words = [("".join(letters.choice("إأآٱةىـابج زx ") for _ in range(10)),) for _ in range(300)]
    frame = spark.createDataFrame(words, "w string").withColumn("f", T.fold_ar(F.col("w")))
    assert frame.filter(T.fold_ar(F.col("f")) != F.trim("f")).count() == 0
