import random
from zlib import crc32

import numpy as np
import pytest
from edge import ODD, documents
from pyspark.sql import functions as F

from adloom.llm import packing, shards
from adloom.llm.tokens import default_vocabulary, encoder
from adloom.session import fresh_path


def expected(text):
    exact = encoder(default_vocabulary()).exact
    return exact.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]


def test_fast_ids_equal_the_reference_encoder():
    rng = random.Random(5)
    alphabet = "abXYZ  \n\t'stmdlvre019²Ⅷéüß日本مر\x1c\x85\xa0 .,!?<|endoftext|>_😀"
    both = encoder(default_vocabulary())
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        assert both.encode(text).tolist() == both.exact.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", ["word and, more. " * 20_000, " " * 1_200_000, "x" * 200_000])
def test_long_texts(text):
    both = encoder(default_vocabulary())
    assert both.encode(text).tolist() == both.exact.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("length", [1, 7, 2048])
def test_pieces_cover_every_id_once(spark, length):
    texts = ODD if length > 1 else ODD[:8]
    rows = packing.pack(documents(spark, texts), length).collect()
    filled = {}
    for r in rows:
        filled.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    assert sorted(filled) == list(range(len(filled)))
    for number, parts in filled.items():
        end = 0
        for offset, size in sorted(parts):
            assert offset == end
            end += size
        assert end == length or (number == len(filled) - 1 and 0 < end <= length)
    whole = {}
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"]
        if r["start"] == 0:
            whole.setdefault(r["doc_id"], []).append([])
            total = r["doc_tokens"]
        assert len(whole[r["doc_id"]][-1]) == r["start"] and r["doc_tokens"] == total
        whole[r["doc_id"]][-1] += ids
    wanted = {}
    for i, text in texts:
        wanted.setdefault(i, []).append(expected(text))
    assert {i: sorted(x) for i, x in whole.items()} == {i: sorted(x) for i, x in wanted.items()}


def test_pieces_follow_the_stored_order(spark):
    path = fresh_path(spark)
    documents(spark, [f"text number {i}" for i in range(200)]).repartitionByRange(5, F.desc("doc_id")).sortWithinPartitions(
        F.desc("doc_id")
    ).write.parquet(path)
    rows = packing.pack(spark.read.parquet(path), 64).orderBy("sequence_id", "offset").collect()
    ids = [r["doc_id"] for r in rows if r["start"] == 0]
    assert ids == sorted(ids, reverse=True)


def test_empty_table(spark):
    none = documents(spark, ["x"]).where("false")
    assert packing.pack(none).count() == 0
    layout = shards.write_shards(none, fresh_path(spark), key=1)
    assert layout.count == 0 and shards.read_shards(spark, layout).count() == 0


@pytest.mark.parametrize("count", [1, 2, 3, 4, 5, 16, 17, 1000, 4097])
def test_permutation_is_a_bijection_with_inverse(count):
    order = shards.Permutation(count, key=99)
    slots = order.slots(np.arange(count))
    assert sorted(slots.tolist()) == list(range(count))
    assert order.indexes(slots).tolist() == list(range(count))
    if count > 100:
        assert slots.tolist() != shards.Permutation(count, key=98).slots(np.arange(count)).tolist()


def test_shards_round_trip(spark):
    length, per_shard = 16, 5
    docs = documents(spark, [(i, t) for i, t in ODD if len(t or "") < 1000] + [(100 + i, "word " * i) for i in range(60)])
    layout = shards.write_shards(docs, fresh_path(spark), key=3, length=length, per_shard=per_shard)
    offsets, total = packing.placed(packing.tokenize(docs))
    assert layout.total == total
    sequences = {r["sequence_id"]: bytes(r["ids"]) for r in packing.sequences(offsets, length, layout.width).collect()}
    assert sorted(sequences) == list(range(layout.count))
    rows = shards.read_shards(spark, layout).collect()
    assert sorted(r["slot"] for r in rows) == list(range(layout.count))
    slots = shards.Permutation(layout.count, 3).slots(np.arange(layout.count))
    tokens_in_windows = sorted(len(s) // 2 for s in sequences.values())
    assert tokens_in_windows[1:] == [length] * (layout.count - 1)
    for r in rows:
        assert r["slot"] == slots[r["sequence_id"]]
        assert (r["shard"], r["byte_offset"]) == (r["slot"] // per_shard, r["slot"] % per_shard * layout.stride)
        assert r["ids_crc32"] == crc32(r["ids"]) and len(r["ids"]) == 2 * length
    files = spark.read.format("binaryFile").load(layout.folder).where("length > 0")
    assert files.count() == layout.shards
    resumed = shards.read_shards(spark, layout, first_slot=12).collect()
    assert sorted(r["slot"] for r in resumed) == list(range(12, layout.count))
    # every id of every document is in the sequences, in order
    joined = b"".join(sequences[i] for i in range(layout.count))
    assert len(joined) == 2 * total
