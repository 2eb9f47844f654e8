"""Packing by concatenate-and-cut: all documents end to end, cut into windows of a fixed length.

Pass one tokenises each input partition once and writes ids with the number of ids before each document in
its partition. The partitions' totals, one row each, are summed up in order, which gives every document a
global offset. Pass two cuts fixed windows at multiples of the length. A window that lies inside one run of
rows is complete in its task; the windows at both ends of a run are boundary records, a few per task, and
only those are shuffled and put together. So nothing is lost to padding but in the very last window.

The order is that of the stored rows: files by name, blocks by start, rows as they lie; for input that is no
file scan, Spark's partition order.

Defined results: null and empty texts become their end mark alone; every row of the input is packed, also
with a null or repeated ``doc_id``; a text of any length is cut into as many windows as it needs. An empty
table gives no pieces and no sequences.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adloom.llm.common import slices
from adloom.llm.tokens import default_vocabulary, encoder
from adloom.session import durable, ship_package

LENGTH = 2048
END_ID = 1

_TOKENS = "doc_id bigint, file string, block bigint, part int, before bigint, n_tokens bigint, ids binary"
_PIECES = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


def tokenize(documents: DataFrame, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Written table of each document's ids (little-endian, as narrow as the vocabulary allows) in stored order.

    ``before`` counts the ids before it in its run: the rows of one file block in one partition.
    """
    path = vocabulary or default_vocabulary()
    ship_package(documents.sparkSession)
    width = id_type(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, place, before = encoder(path).encode, TaskContext.get().partitionId(), None, 0
        for batch in slices(batches):
            counts, starts, ids = [], [], []
            files, blocks = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for text, file, block in zip(batch.column(1).to_pylist(), files, blocks, strict=True):
                if (file, block) != place:
                    place, before = (file, block), 0
                own = np.append(encode(text or ""), np.uint32(end_id)).astype(width)
                starts.append(before)
                counts.append(len(own))
                ids.append(own.tobytes())
                before += len(own)
            columns = [batch.column(0), pa.array(files, pa.string()), pa.array(blocks, pa.int64())]
            columns += [pa.array([part] * len(ids), pa.int32()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64())]
            names = ["doc_id", "file", "block", "part", "before", "n_tokens", "ids"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(ids, pa.binary())], names)

    rows = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        "text",
        F.input_file_name().alias("file"),
        F.input_file_block_start().alias("block"),
    )
    level = {"parquet.compression.codec.zstd.level": "6"}
    return durable(rows.mapInArrow(run, _TOKENS), "zstd", **level)


def id_type(vocabulary: str) -> str:
    return "<u2" if encoder(vocabulary).size <= 1 << 16 else "<u4"


def placed(tokens: DataFrame) -> tuple[DataFrame, int]:
    """``tokens`` with the global offset ``at`` of each document, and the number of all ids.

    The totals have one row for each run, so at most a few per input split, whatever the rows; that bounds
    both their window and their broadcast.
    """
    key = ["file", "block", "part"]
    totals = tokens.groupBy(key).agg(F.sum("n_tokens").alias("total"))
    below = Window.orderBy(*key).rowsBetween(Window.unboundedPreceding, -1)
    bases = durable(totals.withColumn("base", F.coalesce(F.sum("total").over(below), F.lit(0).cast("bigint"))))
    count = bases.agg(F.sum("total")).first()[0] or 0
    joined = tokens.join(F.broadcast(bases.drop("total")), key)
    return joined.select("doc_id", (F.col("base") + F.col("before")).alias("at"), "n_tokens", "ids"), count


def cut(offsets: DataFrame, length: int, width: str) -> DataFrame:
    """Pieces of documents by window; ``ids`` in little-endian unsigned 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "ids"):
            doc, at, n, ids = (batch.column(i) for i in range(4))
            rows, starts, lengths, parts, windows, offs = [], [], [], [], [], []
            for row, (begin, count, data) in enumerate(zip(at.to_pylist(), n.to_pylist(), ids, strict=True)):
                own = np.frombuffer(data.as_buffer(), width).astype("<u4").tobytes()
                start = 0
                while start < count:
                    window, offset = divmod(begin + start, length)
                    size = min(length - offset, count - start)
                    rows.append(row)
                    starts.append(start)
                    lengths.append(size)
                    parts.append(own[4 * start : 4 * (start + size)])
                    windows.append(window)
                    offs.append(offset)
                    start += size
            taken = pa.array(rows, pa.int64())
            long = [pa.array(x, pa.int64()) for x in (starts, lengths, windows, offs)]
            columns = [doc.take(taken), long[0], long[1], pa.array(parts, pa.binary()), n.take(taken), long[2], long[3]]
            names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays(columns, names)

    return offsets.mapInArrow(run, _PIECES)


def pack(documents: DataFrame, length: int = LENGTH, vocabulary: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Pieces: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``; each id lies in exactly one."""
    path = vocabulary or default_vocabulary()
    offsets, _ = placed(tokenize(documents, path, end_id))
    return cut(offsets, length, id_type(path))


def windows_of(length: int, width: str):
    """Function over Arrow batches of :func:`placed` documents to ``sequence_id, offset, ids`` records: whole windows,
    and at both ends of a run of rows the boundary records of windows that other tasks share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin, held, size = 0, [], 0  # a run of ids without a gap, from a global offset on

        def windows(end: bool) -> tuple[list, list, list]:
            """Take what is complete from the run; at its end, also the rest as a boundary record."""
            nonlocal begin, held, size
            data, out = np.concatenate(held) if held else np.zeros(0, width), ([], [], [])
            taken = 0
            while taken < len(data):
                window, offset = divmod(begin + taken, length)
                count = min(length - offset, len(data) - taken)
                if offset + count < length and not end:
                    break
                for column, value in zip(out, (window, offset, data[taken : taken + count].tobytes()), strict=True):
                    column.append(value)
                taken += count
            begin, held = begin + taken, [data[taken:].copy()]
            size = len(held[0])
            return out

        def batch_of(out: tuple[list, list, list]) -> pa.RecordBatch:
            types = (pa.int64(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types, strict=True)], ["sequence_id", "offset", "ids"])

        for batch in slices(batches, "ids"):
            for at, data in zip(batch.column(1).to_pylist(), batch.column(3), strict=True):
                if at != begin + size:
                    yield batch_of(windows(True))
                    begin, held, size = at, [], 0
                own = np.frombuffer(data.as_buffer(), width)
                held.append(own)
                size += len(own)
            yield batch_of(windows(False))
        yield batch_of(windows(True))

    return run


def sequences(offsets: DataFrame, length: int, width: str) -> DataFrame:
    """Packed sequences ``sequence_id, n_tokens, ids`` of :func:`placed` documents (the last may be short)."""
    records = offsets.mapInArrow(windows_of(length, width), "sequence_id bigint, offset bigint, ids binary")
    bytes_each = length * np.dtype(width).itemsize
    whole = records.where(F.octet_length("ids") == bytes_each).select("sequence_id", "ids")
    boundary = records.where(F.octet_length("ids") < bytes_each)
    ordered = F.sort_array(F.collect_list(F.struct("offset", "ids")))["ids"]
    joined = F.aggregate(ordered, F.lit(b""), lambda left, right: F.concat(left, right))
    merged = boundary.groupBy("sequence_id").agg(joined.alias("ids"))
    tokens = (F.octet_length("ids") / np.dtype(width).itemsize).cast("bigint")
    return whole.unionByName(merged).select("sequence_id", tokens.alias("n_tokens"), "ids")
