"""Training-order materialisation: shuffled sequences in fixed-stride shard files.

A keyed Feistel network permutes the sequence numbers; where the next power of four exceeds their count, a
value that falls outside goes through the network again until it is inside (cycle-walking), so the
permutation is exact for any count and needs no table. Slots are dealt to shards by range and every shard is
one file, written by Spark's own committer: a lost or repeated task leaves no half-written shard. All
records have the same stride (padded ids and one mark byte), so a reader finds slot ``s`` at byte
``(s % per_shard) * stride`` of shard ``s // per_shard`` and can resume anywhere; the inverse permutation
says which sequence it holds.

Defined results: documents are packed first (see ``packing``), so null and empty texts are their end mark and
repeated rows are written again. An empty table writes nothing and gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adloom.llm.common import mix64, slices
from adloom.llm.packing import END_ID, LENGTH, id_type, placed, tokenize, windows_of
from adloom.llm.tokens import default_vocabulary
from adloom.session import ship_package

PER_SHARD = 4096
ROUNDS = 6
MARK = b"\n"


@dataclass(frozen=True)
class Permutation:
    """A keyed bijection of ``0 .. count - 1``."""

    count: int
    key: int

    def _half(self) -> int:
        return max(1, -(-max(self.count - 1, 1).bit_length() // 2))

    def _rounds(self, values: np.ndarray, inverse: bool) -> np.ndarray:
        half = np.uint64(self._half())
        mask = np.uint64((1 << int(half)) - 1)
        left, right = values >> half, values & mask
        for turn in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
            salt = np.uint64((self.key * 0x9E3779B97F4A7C15 + turn * 0xD1342543DE82EF95 + 1) % (1 << 64))
            if inverse:
                left, right = right ^ (mix64(left + salt) & mask), left
            else:
                left, right = right, left ^ (mix64(right + salt) & mask)
        return (left << half) | right

    def _walk(self, values: np.ndarray, inverse: bool) -> np.ndarray:
        out = self._rounds(values.astype(np.uint64), inverse)
        while (outside := out >= self.count).any():
            out[outside] = self._rounds(out[outside], inverse)
        return out.astype(np.int64)

    def slots(self, indexes: np.ndarray) -> np.ndarray:
        return self._walk(indexes, False)

    def indexes(self, slots: np.ndarray) -> np.ndarray:
        return self._walk(slots, True)


@dataclass(frozen=True)
class Layout:
    """All that a reader needs to know of a shard folder."""

    folder: str
    count: int
    total: int
    key: int
    length: int
    per_shard: int
    width: str

    @property
    def stride(self) -> int:
        return self.length * np.dtype(self.width).itemsize + len(MARK)

    @property
    def shards(self) -> int:
        return -(-self.count // self.per_shard)


def write_shards(
    documents: DataFrame,
    folder: str,
    key: int,
    length: int = LENGTH,
    per_shard: int = PER_SHARD,
    vocabulary: str | None = None,
    end_id: int = END_ID,
    pad_id: int = 0,
) -> Layout:
    """Write the documents' packed sequences in training order to ``folder/part-<shard>-*``."""
    path = vocabulary or default_vocabulary()
    offsets, total = placed(tokenize(documents, path, end_id))
    layout = Layout(folder, -(-total // length), total, key, length, per_shard, id_type(path))
    if not layout.count:
        return layout
    order = Permutation(layout.count, key)

    cut = windows_of(length, layout.width)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(3).compress  # records cross the shuffle compressed
        for batch in cut(batches):
            slots = order.slots(batch.column(0).to_numpy())
            packed = pa.array([pack(x.as_buffer()) for x in batch.column(2)], pa.binary())
            columns = [pa.array(slots), pa.array((slots // per_shard).astype(np.int32)), batch.column(1), packed]
            yield pa.RecordBatch.from_arrays(columns, ["slot", "shard", "offset", "packed"])

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        size = layout.stride - len(MARK)
        padding = np.full(length, pad_id, layout.width).tobytes()
        slot, held = None, b""  # boundary records of one window follow each other

        for batch in slices(batches, "packed", rows=1024):
            done = []
            for own, data in zip(batch.column(0).to_pylist(), batch.column(3), strict=True):
                if own != slot:
                    if slot is not None:
                        done.append(held + padding[len(held) : size])
                    slot, held = own, b""
                held += unpack(data.as_buffer())
            yield pa.RecordBatch.from_arrays([pa.array(done, pa.binary())], ["record"])
        if slot is not None:
            yield pa.RecordBatch.from_arrays([pa.array([held + padding[len(held) : size]], pa.binary())], ["record"])

    assigned = offsets.mapInArrow(assign, "slot bigint, shard int, offset bigint, packed binary")
    dealt = assigned.repartitionById(layout.shards, "shard").sortWithinPartitions("slot", "offset")
    shards = dealt.mapInArrow(records, "record binary")
    # partition N of the result is shard N, and the writer names its file after it
    shards.select(F.col("record").cast("string").alias("value")).write.option("lineSep", MARK.decode()).text(folder)
    return layout


def read_shards(spark: SparkSession, layout: Layout, first_slot: int = 0) -> DataFrame:
    """Records from ``first_slot`` on: ``sequence_id, slot, shard, byte_offset, n_tokens, ids, ids_crc32``.

    ``ids`` are the record's bytes with its padding, ``n_tokens`` the ids that are not padding. Shards before
    the one of ``first_slot`` are not read.
    """
    schema = "sequence_id bigint, slot bigint, shard int, byte_offset bigint, n_tokens bigint, ids binary, ids_crc32 bigint"
    if not layout.count:
        return spark.createDataFrame([], schema)
    ship_package(spark)
    order = Permutation(layout.count, layout.key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, step = layout.stride - len(MARK), 1024
        for batch in slices(batches, "content"):
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = memoryview(content.as_buffer())
                if len(data) % layout.stride:
                    raise ValueError(f"shard {shard} is no whole number of records")
                for start in range(0, len(data) // layout.stride, step):
                    stop = min(start + step, len(data) // layout.stride)
                    places = np.arange(start, stop)
                    slots = shard * layout.per_shard + places
                    ids = [bytes(data[p * layout.stride : p * layout.stride + size]) for p in places]
                    keep = np.flatnonzero(slots >= first_slot)
                    index = order.indexes(slots)
                    tokens = np.minimum(layout.length, layout.total - index * layout.length)
                    columns = [pa.array(index), pa.array(slots), pa.array(np.full(len(places), shard, np.int32))]
                    columns += [pa.array(places * layout.stride), pa.array(tokens), pa.array(ids, pa.binary())]
                    names = ["sequence_id", "slot", "shard", "byte_offset", "n_tokens", "ids", "ids_crc32"]
                    columns.append(pa.array([crc32(x) for x in ids], pa.int64()))
                    yield pa.RecordBatch.from_arrays(columns, names).take(pa.array(keep))

    shard = F.regexp_extract("path", r"/part-(\d+)-[^/]*$", 1).cast("int")
    files = spark.read.format("binaryFile").load(layout.folder).select(shard.alias("shard"), "content")
    files = files.where((F.col("shard") >= first_slot // layout.per_shard) & (F.octet_length("content") > 0))
    return files.mapInArrow(run, schema)
