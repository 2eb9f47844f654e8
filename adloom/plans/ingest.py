"""One incremental batch: which incoming listings are new, good enough, and how they are written.

The order of the steps is the cheap ones first: date range and known ids only need the card, and only
what they leave over is joined with details, canonicalised and gated.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from adloom.functions.text import strip_foreign
from adloom.operators.enrich import fill_missing, join_details
from adloom.operators.gates import mandatory_gate, split_gate
from adloom.operators.incremental import (
    caught_up_cutoff, cutoff_pages, filter_date_range, filter_min_year, filter_usable_cards, first_by_key, keep_unseen,
)
from adloom.operators.repair import COMPOUND_FIELDS
from adloom.operators.resolve import new_unknown_values, normalize_listings, resolve
from adloom.session import durable
from adloom.sources.catalog import record_run
from adloom.sources.tables import append_jsonl
from adloom.sources.vocabulary import Vocabulary


@dataclass(frozen=True)
class Batch:
    """Accepted rows, and rejected rows with their ``reasons``; ``counts`` of both, observed as they were written."""

    accepted: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


@dataclass(frozen=True)
class Run:
    """One incremental run: what was read, kept and rejected, its counters, and values nobody knows."""

    batch: Batch
    counters: DataFrame
    unknown: DataFrame | None

    def save(self, target: str, ledger: str, unknown: str | None, website_id: str) -> None:
        """Append accepted rows, one line of the run ledger, and new unknown values."""
        spark = self.counters.sparkSession
        append_jsonl(self.batch.accepted, target)
        counts = self.counters.first()
        record_run(
            spark, ledger, website_id, status="success", items_count=counts["saved"], items_new=counts["new"],
            items_duplicate=counts["duplicate"],
        )
        if unknown and self.unknown is not None:
            self.unknown.write.mode("append").parquet(unknown)


def incremental_run(
    cards: DataFrame,
    known: DataFrame,
    patience: int = 3,
    feed: Sequence[str] = (),
    page: str = "page",
    vocabulary: Vocabulary | None = None,
    known_unknown: DataFrame | None = None,
    key: str = "id",
    start=None,
    **options,
) -> Run:
    """Read each feed's pages until it has caught up or lies before ``start``, and ingest what was read.

    A feed has caught up after ``patience`` pages in a row without a new id. ``options`` go to
    :func:`ingest_batch`; ``known_unknown`` are the values reported before.
    """
    ids = durable(known.select(F.col(key).alias("_known")).filter("_known IS NOT NULL").distinct())
    seen = ids.withColumn("_seen", F.lit(True))
    flagged = cards.join(seen, F.col(key) == F.col("_known"), "left").withColumn("is_new", F.col("_seen").isNull())
    flagged = durable(flagged.drop("_known", "_seen"))
    read = caught_up_cutoff(flagged, patience, feed=feed, page=page)
    if start is not None and "date_added" in cards.columns:
        read = cutoff_pages(read, start, feed, page)
    observed = Observation("read")
    fresh = F.coalesce("is_new", F.lit(False))
    read = durable(read.observe(observed, F.count(F.lit(1)).alias("seen"), F.count_if(fresh).alias("new"), F.count_if(~fresh).alias("duplicate")))
    rows = read.drop("is_new")
    batch = ingest_batch(rows, known, vocabulary=vocabulary, start=start, key=key, **options)
    found = None
    if vocabulary is not None:
        found = resolve(rows, vocabulary).unknown()
        found = new_unknown_values(found, known_unknown) if known_unknown is not None else found
    counted = {**observed.get, **batch.counts}  # taken from the writes themselves: no row is read to be counted
    order = ["seen", "new", "duplicate", "saved", "rejected"]
    counters = cards.sparkSession.createDataFrame([tuple(counted[c] for c in order)], ", ".join(f"{c} bigint" for c in order))
    return Run(batch, counters, found)


def ingest_batch(
    cards: DataFrame,
    known: DataFrame,
    details: DataFrame | None = None,
    vocabulary: Vocabulary | None = None,
    start=None,
    end=None,
    least_year: int | None = None,
    order: Sequence[str] = (),
    gate: Callable[[DataFrame], DataFrame] = mandatory_gate,
    strip_compounds: bool = False,
    key: str = "id",
) -> Batch:
    """Filter, deduplicate, enrich, canonicalise and gate the incoming ``cards``.

    ``order`` tells which of several incoming rows with one key is the first and stays. Details fill
    what a card lacks and add their own columns.
    """
    rows = filter_usable_cards(cards, [key])
    rows = filter_date_range(rows, start, end) if "date_added" in rows.columns else rows
    rows = first_by_key(keep_unseen(rows, known, key), [key], list(order))
    if details is not None:
        joined = join_details(rows, details, key, prefix="detail_")
        shared = [c for c in details.columns if c != key and c in rows.columns]
        own = [c for c in details.columns if c != key and c not in rows.columns]
        rows = fill_missing(joined, shared).select(
            *rows.columns, *[F.col(f"detail_{c}").alias(c) for c in own]
        )
    if strip_compounds:
        rows = rows.withColumns(
            {f: strip_foreign(F.col(f)) for f in COMPOUND_FIELDS if f in rows.columns}
        )
    if vocabulary is not None:
        rows = normalize_listings(rows, vocabulary)
    if least_year is not None:
        rows = filter_min_year(rows, least_year)
    observed = Observation("gated")
    passed = F.coalesce("accepted", F.lit(False))
    gated = durable(gate(rows).observe(observed, F.count_if(passed).alias("saved"), F.count_if(~passed).alias("rejected")))
    return Batch(*split_gate(gated), dict(observed.get))  # both sides read the rows that were gated once
