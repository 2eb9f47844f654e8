"""Mentions, names within one edit, bad records and dated tables, against plain versions."""

import itertools
import random
import re

from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from adloom.operators.mentions import find_mentions, first_listed, scoped_mentions
from adloom.operators.neighbours import close_pairs
from adloom.session import fresh_path
from adloom.sources import dated, quarantine


def plain_mentions(texts, names):
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = set()
    for key, text in texts:
        w = words(text)
        hits = []
        for ord_, name in names:
            n = words(name)
            hits += [(i, len(n), ord_, name) for i in range(len(w) - len(n) + 1) if n and w[i : i + len(n)] == n]
        best = {}
        for i, size, ord_, name in sorted(hits, key=lambda h: h[2], reverse=True):
            best[i, size] = (ord_, name)
        for (i, size), (ord_, name) in best.items():
            if not any((j, s) != (i, size) and j <= i and j + s >= i + size for j, s in best):
                out.add((key, i, size, ord_, name))
    return out


def test_mentions_equal_a_plain_scan(spark):
    draw = random.Random(6)
    pool = ["land", "Cruiser", "rover", "range", "é", "X5", "5", "bmw"]
    names = [(i, " ".join(draw.choice(pool) for _ in range(draw.randrange(1, 4)))) for i in range(25)] + [(25, "--"), (26, "LAND  cruiser"), (27, "")]
    texts = [(i, draw.choice([" ", ", ", "-"]).join(draw.choice(pool + ["x", "the"]) for _ in range(draw.randrange(25)))) for i in range(80)]
    texts += [(100, None), (101, ""), (102, "range " * 3000)]
    frame = spark.createDataFrame(texts, "id int, text string").repartition(3)
    found = find_mentions(frame, spark.createDataFrame(names, "ord int, name string"))
    rows = {(r.id, r.start, r.size, r.ord, r.name) for r in found.collect()}
    expected = plain_mentions(texts, names)
    assert rows == expected and len(rows) > 100
    firsts = {r.id: r.name for r in first_listed(found).collect()}
    assert firsts == {k: min((o, i, n) for key, i, _, o, n in expected if key == k)[2] for k in {e[0] for e in expected}}
    assert find_mentions(frame, spark.createDataFrame([], "ord int, name string")).count() == 0


def test_models_count_where_their_brand_is_mentioned(spark):
    texts = spark.createDataFrame([(1, "kia rio 2010"), (2, "rio grande"), (3, "Kia and ford Focus")], "id int, text string")
    brands = find_mentions(texts, spark.createDataFrame([(0, "kia"), (1, "ford")], "ord int, name string"))
    models = find_mentions(texts, spark.createDataFrame([(0, "rio", "kia"), (1, "focus", "ford"), (2, "grande", "fiat")], "ord int, name string, brand string"))
    assert sorted((r.id, r.name) for r in scoped_mentions(models, brands).collect()) == [(1, "rio"), (3, "focus")]


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_no_pair_within_one_edit_is_lost(spark):
    names = ["".join(p) for n in range(4) for p in itertools.product("abé", repeat=n)] + ["سوناتا", "سونتا", "سونااتا", "abcdefghijkl", "abcdefghijk", "xbcdefghijkl"]
    left = spark.createDataFrame([(n,) for n in [*names, None]], "probe string")
    right = spark.createDataFrame([(n, len(n or "")) for n in [*names, None]], "candidate string, ord int")
    rows = {(r.probe, r.candidate, r.distance) for r in close_pairs(left, right).collect()}
    assert rows == {(a, b, edits(a, b)) for a in names for b in names if edits(a, b) <= 1}


def test_every_landed_record_is_good_or_kept_aside(spark):
    path, side = fresh_path(spark, "log"), fresh_path(spark, "side")
    lines = ['{"id": "1"}', '{"id": ', "", "  ", "plain", '{"id": " "}', "[1]", '{"id": "2", "more": 5}', '{"other": 1}', '{"id": {"x": 1}}', "null"]
    spark.createDataFrame([(x,) for x in lines], "value string").repartition(3).write.text(path)
    checked = quarantine.read_jsonl_checked(spark, path, StructType([StructField("id", StringType())]), ["id"])
    good, bad = [r.id for r in checked.good.collect()], checked.bad.collect()
    assert sorted(good) == ["1", "2", '{"x":1}'] and len(good) + len(bad) == len([x for x in lines if x.strip()])
    assert {r.value for r in bad} == {'{"id": ', "plain", '{"id": " "}', "[1]", '{"other": 1}', "null"}
    assert len({(r.file, r.block, r.place) for r in bad}) == len(bad)
    quarantine.quarantine(checked, side)
    quarantine.quarantine(checked, side)
    assert spark.read.parquet(side).count() == 2 * len(bad)


def test_a_range_of_dates_reads_its_folders_only(spark):
    path = fresh_path(spark, "dated")
    rows = spark.range(2000).selectExpr("id", "CASE WHEN id % 50 = 0 THEN NULL WHEN id % 3 = 0 THEN date'2026-01-05' ELSE date_add(date'2026-01-01', cast(id % 40 AS int)) END AS date_added")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are put together
    try:
        dated.write_by_date(rows, path, spread=4)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    found = dated.read_dates(spark, path, "2026-01-10", "2026-01-12")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [(isnull(date_added" in plan and "DataFilters: []" in plan
    kept = rows.filter("date_added IS NULL OR date_added BETWEEN '2026-01-10' AND '2026-01-12'")
    assert sorted(r.id for r in found.collect()) == sorted(r.id for r in kept.collect())
    assert dated.read_dates(spark, path, "2026-01-10", keep_null=False).filter("date_added IS NULL").count() == 0
    hot = spark.read.parquet(path).filter(F.col("date_added") == "2026-01-05").select(F.input_file_name()).distinct().count()
    assert 1 < hot <= 4
