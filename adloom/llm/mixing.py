"""Mixing sources to target weights by Pfair scheduling.

The documents of a source form a stream, cut into blocks of equal size (characters); a document belongs to
the block in which it begins. A source of weight w (its share of all shares) gets block i, from 0, a release
time floor(i / w) and a deadline ceil((i + 1) / w); every slot goes to the released block with the earliest
deadline. As the weights add up to one, each block gets a slot inside its window, so at every time each
source is less than one block away from its target. The schedule repeats after as many slots as there are
shares, so it is made for one period and each block finds its slot by arithmetic.

Every document is kept: when a source has ended, its later slots stay empty and the others go on in their
proportions. Streams are numbered by two-pass prefix sums: rows are dealt by range of source and a hash of
the id, so a source with a third of all rows is spread over many partitions, and each partition's totals
give the next one's start.

Defined results: a null source counts as the source ``''``; null and empty texts have size 0 and keep their
place in the stream. Rows are ordered by the hash of their id, then id and size; repeated rows follow each
other. Sources without a target get a share of 1. An empty table gives no rows. There may be at most
``MOST_SOURCES`` sources and ``MOST_SHARES`` shares in all, as the schedule of a period is made by the driver.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from adloom.session import durable, ship_package

BLOCK_CHARS = 100_000
MOST_SOURCES = 10_000
MOST_SHARES = 1_000_000


def period(shares: dict[str, int]) -> dict[str, list[int]]:
    """The slots that each source gets in one period, by earliest deadline among the released blocks."""
    total = sum(shares.values())
    if len(shares) > MOST_SOURCES or total > MOST_SHARES or min(shares.values()) < 1:
        raise ValueError("shares must be positive and within the bounds")
    slots: dict[str, list[int]] = {s: [] for s in shares}
    waiting = [(0, -(-total // share), source) for source, share in sorted(shares.items())]  # release, deadline
    heapq.heapify(waiting)
    ready: list[tuple[int, str]] = []
    for slot in range(total):
        while waiting and waiting[0][0] <= slot:
            _, deadline, source = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline, source))
        deadline, source = heapq.heappop(ready)
        slots[source].append(slot)
        block, share = len(slots[source]), shares[source]
        if block < share:
            heapq.heappush(waiting, (block * total // share, -(-(block + 1) * total // share), source))
    return slots


def _streams(documents: DataFrame) -> DataFrame:
    """``source, part, before, size`` and ``document`` (the columns as they came) of all rows, written in stream order.

    ``before`` is what lies before the row in its source and partition.
    """
    ship_package(documents.sparkSession)
    size = F.coalesce(F.length("text"), F.lit(0)).cast("bigint")
    rows = documents.select(
        F.coalesce("source", F.lit("")).alias("source"),
        F.xxhash64("doc_id").alias("drawn"),
        F.col("doc_id").alias("id"),
        size.alias("size"),
        F.struct("*").alias("document"),
    )
    dealt = rows.repartitionByRange("source", "drawn", "id", "size").sortWithinPartitions("source", "drawn", "id", "size")
    names = dealt.columns

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, source, before = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            starts = []
            for own, size in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if own != source:
                    source, before = own, 0
                starts.append(before)
                before += size
            columns = [pa.array([part] * len(starts), pa.int32()), pa.array(starts, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*names, "part", "before"])

    schema = StructType([*dealt.schema.fields, StructField("part", IntegerType()), StructField("before", LongType())])
    return durable(dealt.mapInArrow(number, schema), "zstd")


def schedule(documents: DataFrame, shares: dict[str, int] | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``document`` (a struct of all columns), ``source, block, release, deadline, slot, begin`` of every row.

    ``release`` and ``deadline`` are the window of the block, ``slot`` its place in the mix; ``begin`` is where the
    document begins in its source. Ordering by slot, then begin gives the mixed order.
    """
    streams = _streams(documents)
    # one row for each partition and the sources in it: as many as partitions and sources together
    totals = streams.groupBy("source", "part").agg(F.sum("size").alias("total"), F.count("*").alias("rows"))
    below = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = durable(totals.withColumn("base", F.coalesce(F.sum("total").over(below), F.lit(0).cast("bigint"))))
    sources = [r["source"] for r in bases.select("source").distinct().limit(MOST_SOURCES + 1).collect()]
    placed = streams.join(F.broadcast(bases.select("source", "part", "base")), ["source", "part"])
    begin = F.col("base") + F.col("before")
    placed = placed.select("document", "source", "id", begin.alias("begin"), F.floor(begin / block_chars).alias("block"))
    mine = {s: (shares or {}).get(s, 1) for s in sources} or {"": 1}
    slots, total = period(mine), sum(mine.values())
    rows = [(s, mine[s], slots[s]) for s in sorted(mine)]
    plan = documents.sparkSession.createDataFrame(rows, "source string, share bigint, slots array<bigint>")
    timed = placed.join(F.broadcast(plan), "source")
    turn = F.expr("block div share")
    return timed.select(
        "document",
        "source",
        "block",
        F.expr(f"block * {total} div share").alias("release"),
        F.expr(f"((block + 1) * {total} + share - 1) div share").alias("deadline"),
        (turn * total + F.get("slots", F.expr("block % share").cast("int"))).alias("slot"),
        "begin",
    )


def mix(documents: DataFrame, shares: dict[str, int] | None = None, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """All rows of ``documents`` in mixed order: over the partitions, and within each."""
    timed = schedule(documents, shares, block_chars)
    ordered = timed.repartitionByRange("slot", "begin").sortWithinPartitions("slot", "begin")
    return ordered.select("document.*")
