"""Helpers that several operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH_BYTES = 8 << 20  # text that a Python task works on at once; a longer text makes a batch of its own
FOLDS = 5


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document belongs to the fold that nothing is learned from (null ids: the id ``''``)."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return (F.crc32(key.cast("binary")) % FOLDS) == 0


def text_of(documents: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and ``text`` with null as empty."""
    return documents.select(*keep, F.coalesce(F.col("text"), F.lit("")).alias("text"))


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = BATCH_BYTES, rows: int = 8192
) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds about ``limit`` bytes in each, in 1 to ``rows`` rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(batch.schema.get_field_index(column))
        width = 8 if pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type) else 4
        offsets = np.frombuffer(values.buffers()[1], f"<i{width}", values.offset + len(values) + 1)[values.offset :]
        start = 0
        while start < len(values):
            stop = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
            stop = min(max(stop, start + 1), start + rows, len(values))
            yield batch.slice(start, stop - start)
            start = stop


def text_bytes(batch: pa.RecordBatch, column: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts of a batch end to end, and the offsets of the texts in them."""
    values = batch.column(batch.schema.get_field_index(column))
    width = 8 if pa.types.is_large_string(values.type) else 4
    offsets = np.frombuffer(values.buffers()[1], f"<i{width}", values.offset + len(values) + 1)[values.offset :]
    data = values.buffers()[2]
    every = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return every[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x
