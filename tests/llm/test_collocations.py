"""Phrase mining against a plain count, and the odd rows."""

import collections
import random
import re

import numpy as np
import pytest
from edge import ODD, documents

from adloom.llm import collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return [re.findall(r"[^\x20\x09]+", piece) for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))]


def plain_mine(docs, least, top):
    """``docs``: (lang, text)."""
    counts, n = collections.Counter(), collections.Counter()
    for lang, text in docs:
        for words in plain_words(text):
            n[lang or "und"] += len(words)
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    counts[lang or "und", tuple(words[i : i + size])] += 1
    rows = collections.defaultdict(list)
    frequent = {key: f for key, f in counts.items() if f >= least and len(key[1]) > 1}
    for (lang, phrase), a in frequent.items():
        longer = [f for (other, p), f in frequent.items() if other == lang and len(p) > len(phrase) and any(p[i : i + len(phrase)] == phrase for i in range(len(p)))]
        if any(100 * f >= 80 * a for f in longer):
            continue
        cuts = [(2_000_000 * a // (counts[lang, phrase[:k]] + counts[lang, phrase[k:]]), k) for k in range(1, len(phrase))]
        score, k = min(cuts)
        rows[lang].append((-score, -a, " ".join(phrase).encode(), a, counts[lang, phrase[:k]], counts[lang, phrase[k:]], n[lang], score))
    return {(lang, i, p.decode(), a, l, r, total, score) for lang, own in rows.items() for i, (_, _, p, a, l, r, total, score) in enumerate(sorted(own)[:top], 1)}


def sample(seed, rows=160):
    draw = random.Random(seed)
    words = ["the", "The", "of", "new", "York", "times", "é", "Ä", "a", "b", "machine", "learning", "x y"]
    docs = []
    for _ in range(rows):
        parts = [draw.choice(words) if draw.random() < 0.7 else "New York Times" for _ in range(draw.randrange(60))]
        docs.append((draw.choice(["en", "fr", None]), draw.choice([" ", "  ", "\t"]).join(p + draw.choice(["", "", "", ".", "\n", ","]) for p in parts)))
    return docs


def frame(spark, docs):
    rows = [(i, text, lang, "s", 0, 7, 7, 7, 7.0, 7, "x", "x", "x") for i, (lang, text) in enumerate(docs)]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, doc bigint, at int, slot bigint, score double, phrase bigint, f string, n string, rank string"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.mark.parametrize("broadcast_rows", [1_000_000, 0])
def test_phrases_equal_a_plain_count(spark, broadcast_rows):
    docs = sample(3)
    got = {tuple(r) for r in collocations.mine_collocations(frame(spark, docs), least=8, top=25, broadcast_rows=broadcast_rows).collect()}
    assert got and got == plain_mine(docs, 8, 25)


def test_long_texts_cut_into_windows_keep_pieces_and_places(spark, monkeypatch):
    docs = [("en", ("alpha beta gamma delta. " * 40 + "no stop here " * 90)), (None, None), ("en", "x" * 3000 + " alpha beta")]
    whole = {tuple(r) for r in collocations.mine_collocations(frame(spark, docs), least=5).collect()}
    assert whole == plain_mine(docs, 5, 2000)
    data = np.frombuffer(docs[0][1].encode(), np.uint8)
    for size in (7, 64, 500):
        parts = list(collocations._windows(data, size))
        assert b"".join(p.tobytes() for p, _, _ in parts) == data.tobytes()
        rows = []
        for part, pieces, places in parts:
            _, piece, place, words = collocations.cut_words(part, np.array([0, len(part)]))
            rows += zip((piece + pieces).tolist(), (place + np.where(piece == 0, places, 0)).tolist(), words.to_pylist(), strict=True)
        assert rows == [(i, j, w) for i, own in enumerate(plain_words(docs[0][1])) for j, w in enumerate(own)]


def test_counts_beyond_64_bits_stay_exact(spark):
    big = 9_000_000_000_000_000_000
    ones = spark.createDataFrame([("en\ta", big), ("en\tb", big - 1)], "phrase string, f bigint")
    twos = spark.createDataFrame([("en\ta b", big - 2)], "phrase string, f bigint")
    row = collocations.scored_phrases([ones, twos]).first()
    assert (row["l"], row["r"], row["score"]) == (big, big - 1, 2_000_000 * (big - 2) // (2 * big - 1))


def test_odd_rows_and_empty_tables(spark):
    odd = documents(spark, ODD)
    got = {tuple(r) for r in collocations.mine_collocations(odd, least=2).collect()}
    assert got == plain_mine([("en", t) for _, t in ODD], 2, 2000)
    assert collocations.mine_collocations(odd.where("false")).count() == 0
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("occurrences_")]


def test_merge_join_shuffles_nothing(spark):
    relations = collocations._Relations(spark, 4)
    rows = spark.range(100).selectExpr("id % 7 AS doc", "id AS at", "id * 3 AS id")
    with collocations._settings(spark, collocations._IN_PLACE):
        stored = relations.store(rows.repartition(4, "doc"))
        plan = collocations._longer(stored)._jdf.queryExecution().executedPlan().toString()
    relations.drop()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Sort [") == 1


def test_ids_of_phrases_never_clash(spark, monkeypatch):
    real = collocations._mark
    monkeypatch.setattr(collocations, "_mark", lambda seed, *columns: real(seed, *columns) % 7 if seed < 2 else real(seed, *columns))
    docs = sample(8, 60)
    got = {tuple(r) for r in collocations.mine_collocations(frame(spark, docs), least=6, top=25).collect()}
    assert got and got == plain_mine(docs, 6, 25)


def test_words_are_told_by_stored_ids_unless_a_rare_one_shares_the_id_of_a_frequent_one(spark, monkeypatch):
    C = collocations
    texts = [("en", "a b c a b d"), ("en", "a b c a b e"), ("en", "x a b c")]
    documents = spark.createDataFrame(texts, "lang string, text string")

    def counted():
        return [sorted(tuple(r) for r in f.collect()) for f in C.frequent_phrases(documents, least=2, longest=3)[0]]

    def joined_by():
        keys, longer = [], C._longer
        plan = lambda o: o._jdf.queryExecution().optimizedPlan().toString()
        monkeypatch.setattr(C, "_longer", lambda o: keys.append(re.search(r"LeftSemi, \((\w+?)#", plan(o)).group(1) if not keys else "") or longer(o))
        result = counted()
        monkeypatch.setattr(C, "_longer", longer)
        return result, keys[0]

    by_id, key = joined_by()
    assert key == "id" and by_id[1] == [("en\ta b", 5), ("en\tb c", 3), ("en\tc a", 2)]
    monkeypatch.setattr(C, "_stands_alone", lambda *_: False)
    assert joined_by() == (by_id, "phrase")
    words = spark.createDataFrame([("a", 5), ("b", 1)], "phrase string, f bigint")
    monkeypatch.undo()
    frequent = words.where("f > 1").withColumn("id", C._mark(0, "phrase"))
    assert C._stands_alone(frequent, words)
    assert not C._stands_alone(frequent, words.selectExpr("'a' AS phrase", "f"))
