import collections
import hashlib
import random
import re

import numpy as np
import pytest
from edge import ODD, documents

from adloom.llm import exact_dedup, near_dedup, superminhash
from adloom.llm.components import components


def test_exact_verdicts_on_odd_rows(spark):
    rows = exact_dedup.deduplicate(documents(spark, ODD), exact_dedup.DigestIndex(spark, buckets=4)).collect()
    groups = collections.defaultdict(list)
    for i, text in ODD:
        groups[hashlib.sha256((text or "").encode()).digest()].append(i)
    assert len(rows) == len(ODD)
    for r in rows:
        ids = groups[bytes(r["digest"])]
        assert r["group_size"] == len(ids) and r["keep_id"] == max((i for i in ids if i is not None), default=None)
    kept = collections.Counter(bytes(r["digest"]) for r in rows if r["kept"])
    assert set(kept.values()) == {1} and len(kept) == len(groups)


def test_index_persists_and_only_new_texts_are_appended(spark):
    first = exact_dedup.DigestIndex(spark, buckets=4)
    exact_dedup.deduplicate(documents(spark, [(1, "a"), (2, "b"), (3, "a")]), first).count()
    again = exact_dedup.DigestIndex(spark, path=first.path, buckets=4)
    rows = exact_dedup.deduplicate(documents(spark, [(9, "a"), (10, "c"), (11, "c")]), again).collect()
    assert {(r["doc_id"], r["keep_id"], r["kept"]) for r in rows} == {(9, 3, False), (10, 11, False), (11, 11, True)}
    assert again.read().count() == 3
    plan = again.unseen(spark.createDataFrame([(b"x",)], "digest binary"))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1


def test_drop_copies_keeps_columns_and_one_row(spark):
    docs = documents(spark, ODD)
    kept = exact_dedup.drop_copies(docs, exact_dedup.DigestIndex(spark, buckets=4))
    assert kept.columns == docs.columns
    got = collections.Counter((r["doc_id"], r["text"] or "") for r in kept.collect())
    assert set(got.values()) == {1} and {t for _, t in got} == {t or "" for _, t in ODD}
    assert (8, "same text again and again here") in got and (2, "") in got
    none = docs.where("false")
    assert exact_dedup.drop_copies(none, exact_dedup.DigestIndex(spark, buckets=4)).count() == 0


def brute_sets(docs):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = []
    for i, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(lower))
        out.append((i, {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()))
    return out


def brute_components(docs, threshold=85):
    sets = brute_sets(docs)
    root = {i: i for i, _ in sets if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(sets)):
        for b in range(a):
            (i, s), (j, t) = sets[a], sets[b]
            if s and t and None not in (i, j) and 100 * len(s & t) >= threshold * len(s | t):
                low, high = sorted((find(i), find(j)))
                root[high] = low
    return sorted(
        ((i, len(s), None if i is None else find(i), i is None or find(i) == i) for i, s in sets), key=repr
    )


def near_copies(seed, bases=4, copies=25, words=80):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    docs, number = [], 0
    for _ in range(bases):
        base = [rng.choice(vocabulary) for _ in range(words)]
        for _ in range(copies):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(words)] = rng.choice(vocabulary)
            docs.append((number, " ".join(own).replace("w1", "W1") if rng.random() < 0.3 else " ".join(own)))
            number += rng.randint(1, 3)
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("limits", [{}, {"BLOCK": 4}, {"BLOCK": 4, "CLOUD_ROOM": 10}])
def test_near_groups_equal_brute_force(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(near_dedup, name, value)
    docs = near_copies(1)
    rows = near_dedup.near_duplicates(documents(spark, docs)).collect()
    assert sorted(map(tuple, rows), key=repr) == brute_components(docs)


def test_near_groups_on_odd_rows(spark):
    rows = near_dedup.near_duplicates(documents(spark, ODD)).collect()
    assert sorted(map(tuple, rows), key=repr) == brute_components(ODD)
    docs = documents(spark, ODD)
    assert near_dedup.drop_near_copies(docs).columns == docs.columns
    assert near_dedup.near_duplicates(docs.where("false")).count() == 0


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 99), (5, 5)]
    random.Random(2).shuffle(edges)
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(61)} | {99: 99, 100: 99, 101: 99}


def test_signature_agreement_estimates_similarity():
    rng = np.random.default_rng(4)
    for size in (3, 40, 900):
        common = rng.integers(0, 1 << 63, size, dtype=np.uint64)
        agree = []
        for _ in range(40):
            a = np.unique(np.concatenate([common, rng.integers(0, 1 << 63, size, dtype=np.uint64)]))
            b = np.unique(np.concatenate([common, rng.integers(0, 1 << 63, size, dtype=np.uint64)]))
            s = superminhash.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), 256)
            agree.append((s[0] == s[1]).mean())
        assert abs(np.mean(agree) - 1 / 3) < 0.03


def test_signature_follows_the_definition():
    """Against a plain implementation that never stops early."""
    rng = np.random.default_rng(9)
    size = 16
    hashes = rng.integers(0, 1 << 63, 5, dtype=np.uint64)
    fast = superminhash.signatures(hashes, np.array([0, 5]), size)[0]
    slow = np.full(size, np.iinfo(np.uint64).max, np.uint64)
    for h in hashes:
        order = list(range(size))
        for rank in range(size):
            drawn = int(superminhash.mix64(np.array([h]) + np.uint64((rank + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))[0])
            swap = rank + (((drawn & 0xFFFFFFFF) * (size - rank)) >> 32)
            order[rank], order[swap] = order[swap], order[rank]
            slow[order[rank]] = min(int(slow[order[rank]]), (rank << 48) | (drawn >> 16))
    assert fast.tolist() == slow.tolist()


@pytest.mark.parametrize("before", [[], ["", ""]])
def test_shingles_of_a_slice_with_few_words(before):
    """One text of 0 to 5 words makes up the slice, with or without empty texts; the longer slice has the same hashes."""
    long = b"and now a text of more words than a shingle"
    for count in range(6):
        own = " ".join("abcde"[:count]).encode()
        offsets = np.array([*[0] * (len(before) + 1), len(own)])
        hashes, bounds = superminhash.shingles(np.frombuffer(own, np.uint8), offsets)
        assert bounds.tolist() == [*[0] * (len(before) + 1), min(count, 1)]
        beside, _ = superminhash.shingles(np.frombuffer(own + long, np.uint8), np.array([0, len(own), len(own + long)]))
        assert hashes.tolist() == beside[: len(hashes)].tolist()


@pytest.mark.parametrize("text", ["one two", "one two three"])
def test_a_short_text_as_the_only_row(spark, text):
    docs = documents(spark, [(1, text)])
    assert [tuple(r) for r in near_dedup.near_duplicates(docs).collect()] == [(1, 1, 1, True)]
    assert near_dedup.drop_near_copies(docs).count() == 1
