"""Near-duplicate documents by SuperMinHash, banding, verification on full sets and union-find.

1. Every whole text becomes its set of distinct word shingles and a SuperMinHash signature; signatures are
   cut into bands. Texts with equal sets are one class from here on, whatever their number.
2. Classes that share a band are candidates. Each bucket links its members to its smallest one (a star, no
   pairs); the components of those links are clouds: no candidate pair crosses two clouds.
3. Clouds are verified in blocks. A cloud goes to one task, or is cut into blocks of which every two meet in
   one task; a cloud too large for that is verified bucket by bucket, in blocks again. A block pair compares
   the full shingle sets of all its texts whose sizes allow the similarity, so no link inside is missed,
   and emits the few links that join its parts, not all of them.
4. The components of those links are the near-duplicate groups.

A pair at the threshold of 0.85 is missed by all 32 bands of 8 values with a chance of 4 in 100,000; links inside a
cloud are found even then. A lower threshold takes more bands: 42 of 6 miss a pair at 0.8 with a chance of 3 in a
million. Shingles are compared by 64-bit hashes.

Defined results: A-Z are lowered, words end at ASCII white space; null and empty texts and those without a
word have an empty set and are linked with nothing; a text of fewer than five words has one shingle. Rows
are told apart by ``doc_id``: rows that repeat an id belong to one document. A row with a null id takes
part in no group, has a null component and is kept. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adloom.llm.common import slices, text_bytes
from adloom.llm.components import components
from adloom.llm.superminhash import band_keys, shingles, signatures
from adloom.session import durable, ship_package

SIZE, BANDS = 256, 32
THRESHOLD = 85  # per cent
BLOCK = 128  # classes in a block, unless the cloud is very large
MOST_BLOCKS = 64  # of a cloud, before its work or size asks for more
WORK = 2_000_000_000  # set elements that a block pair compares, about
ROOM = 4_000_000  # shingles that a block pair holds
CLOUD_ROOM = 8 * ROOM  # a cloud with more shingles is verified bucket by bucket
BATCH = 512 << 10  # bytes of text that a task turns into shingles at once


def sketch(documents: DataFrame, size: int = SIZE, bands: int = BANDS) -> DataFrame:
    """``doc_id``, ``n`` distinct shingles, ``set_a, set_b`` (128 bits that stand for the set), ``bands`` and ``row``."""
    ship_package(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=BATCH):
            hashes, offsets = shingles(*text_bytes(batch))
            n = np.diff(offsets)
            keys = band_keys(signatures(hashes, offsets, size), bands)
            sums = []
            for salt in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
                spread = np.concatenate([[0], np.cumsum((hashes ^ (hashes >> np.uint64(29))) * np.uint64(salt) ^ (hashes >> np.uint64(17)), dtype=np.uint64)])
                sums.append((spread[offsets[1:]] - spread[offsets[:-1]]).view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * bands), pa.array(keys.ravel().view(np.int64)))
            columns = [batch.column(0), pa.array(n), pa.array(sums[0]), pa.array(sums[1]), lists]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "set_a", "set_b", "bands"])

    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    made = rows.mapInArrow(run, "doc_id bigint, n bigint, set_a bigint, set_b bigint, bands array<bigint>")
    return durable(made.withColumn("row", F.monotonically_increasing_id()), "zstd")


def _blocks(k: Column, total: Column) -> Column:
    """Into how many blocks a group of ``k`` classes with ``total`` shingles is cut."""
    work = F.ceil(F.sqrt(4.0 * k * total / WORK))
    room = F.ceil(2.0 * total / ROOM)
    return F.greatest(work, room, F.least(F.ceil(k / BLOCK), F.lit(MOST_BLOCKS)), F.lit(1)).cast("int")


def _units(members: DataFrame, group: str) -> DataFrame:
    """``unit, id``: every two classes of a group meet in some unit. ``members`` has ``group, id, n``."""
    sizes = durable(members.groupBy(group).agg(_blocks(F.count("*"), F.sum("n")).alias("blocks")))
    mine = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    spread = members.join(sizes, group).withColumn("mine", mine)
    met = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    unit = F.xxhash64(group, F.least("mine", "other"), F.greatest("mine", "other"), F.lit(group))
    return met.select(unit.alias("unit"), "id")


def verified_links(documents: DataFrame, units: DataFrame, threshold: int) -> DataFrame:
    """``a, b`` of links that join the parts of each unit (``unit, id``).

    The whole texts are read again for the ids in ``units`` only: writing the sets of all documents would
    take more than the texts do.
    """

    def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=BATCH):
            hashes, offsets = shingles(*text_bytes(batch))
            data = [hashes[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(data, pa.binary())], ["unit", "id", "shingles"])

    def compare(ids: list[int], data: list[bytes]) -> list[tuple[int, int]]:
        # an id that repeats with other texts has several sets
        every = sorted({(len(d), i, d) for i, d in zip(ids, data, strict=True)})
        order = [i for _, i, _ in every]
        arrays = [np.frombuffer(d, np.uint64) for _, _, d in every]
        sizes = np.array([len(x) for x in arrays])
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        _, local = np.unique(np.concatenate(arrays), return_inverse=True)
        seen = np.zeros(int(local.max()) + 1, np.int32)
        part = np.arange(len(order))
        links = []
        for i in range(len(order) - 1):
            last = int(np.searchsorted(sizes, sizes[i] * 100 // threshold, "right"))
            if last <= i + 1:
                continue
            own = local[offsets[i] : offsets[i + 1]]
            seen[own] = 1
            common = np.add.reduceat(seen[local[offsets[i + 1] : offsets[last]]], offsets[i + 1 : last] - offsets[i + 1])
            seen[own] = 0
            union = sizes[i] + sizes[i + 1 : last] - common
            for j in (np.flatnonzero(100 * common >= threshold * union) + i + 1).tolist():
                if part[i] != part[j]:
                    links.append((order[i], order[j]))
                    part[part == part[j]] = part[i]
        return links

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, ids, data = None, [], []

        def done() -> pa.RecordBatch:
            links = compare(ids, data) if len(ids) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

        for batch in batches:
            for u, i, d in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if u != unit:
                    if ids:
                        yield done()
                    unit, ids, data = u, [], []
                ids.append(i)
                data.append(d.as_py())
        if ids:
            yield done()

    rows = documents.select(F.col("doc_id").cast("bigint").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    # merge joins at every size: both sides grow with the documents
    texts = rows.join(units.hint("merge"), "id").select("unit", "id", "text").dropDuplicates()
    placed = texts.mapInArrow(with_sets, "unit bigint, id bigint, shingles binary")
    return placed.repartition("unit").sortWithinPartitions("unit").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(documents: DataFrame, threshold: int = THRESHOLD, size: int = SIZE, bands: int = BANDS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row; documents are linked at ``threshold`` per cent."""
    rows = sketch(documents, size, bands)
    able = rows.where("n > 0 AND doc_id IS NOT NULL")
    classes = durable(
        able.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("id"), F.min_by("row", "doc_id").alias("row"))
    )
    heads = durable(able.join(classes.select("row").hint("merge"), "row").select(F.col("doc_id").alias("id"), "n", "bands"), "zstd")

    banded = heads.select("id", "n", F.explode("bands").alias("key"))
    hubs = durable(banded.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("last")).where("hub < last").select("key", "hub"))
    stars = banded.join(hubs.hint("merge"), "key")
    clouds = durable(components(stars.where("id != hub").select(F.col("id").alias("a"), F.col("hub").alias("b"))))
    members = durable(heads.join(clouds.hint("merge"), "id").select("id", "n", "component").distinct())
    totals = members.groupBy("component").agg(F.sum("n").alias("total"))
    small = durable(totals.select("component", (F.col("total") <= CLOUD_ROOM).alias("small")))
    sorted_out = durable(members.join(small, "component"))
    whole = _units(sorted_out.where("small").select("component", "id", "n"), "component")
    large = sorted_out.where("NOT small").select("id")
    by_bucket = _units(durable(stars.join(large, "id", "left_semi").select("key", "id", "n").distinct()), "key")
    units = durable(whole.unionByName(by_bucket))
    links = durable(verified_links(documents, units, threshold))
    groups = durable(components(links))

    named = durable(
        classes.join(groups, "id", "left").select("set_a", "set_b", F.coalesce("component", "id").alias("component_id"))
    )
    found = rows.join(named.hint("merge"), ["set_a", "set_b"], "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return found.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def drop_near_copies(documents: DataFrame, threshold: int = THRESHOLD, size: int = SIZE, bands: int = BANDS) -> DataFrame:
    """The rows of ``documents`` that stay: of each group the document with the smallest id."""
    gone = durable(near_duplicates(documents, threshold, size, bands).where("NOT kept").select("doc_id").distinct())
    return documents.join(gone, documents["doc_id"] == gone["doc_id"], "left_anti")
