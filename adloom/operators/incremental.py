"""What is new in a feed (JN-1 to JN-3, WIN-1/2/3/6, FLT-1/2/6/8, SRT-4).

Feeds are not walked in order: stops are reduced to minima, maxima and counts, which combine on the map
side, so a feed holding a third of the rows is no hot task. Joins against what is known have nothing but an
exchange below them on either side, so that adaptive execution recognises and splits a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adloom.functions import fixed_values as V
from adloom.functions.text import strip
from adloom.session import durable
from adloom.sources.key_index import KeyIndex


# --- joins against what is known ---------------------------------------------------------------------
def keep_unseen(listings: DataFrame, known: DataFrame, key: str = "id") -> DataFrame:
    """JN-1: rows whose key the target does not hold. Rows without a key are kept."""
    return listings.join(known.select(key), key, "left_anti")


def keep_unseen_either(listings: DataFrame, known: DataFrame, keys: Sequence[str], key: str = "id") -> DataFrame:
    """JN-2: rows unseen under every one of several key columns."""
    ids = known.select(F.col(key).alias("_known"))
    out = listings
    for name in keys:
        out = out.join(ids, F.col(name) == F.col("_known"), "left_anti")
    return out


_PLAIN = ("string", "bigint", "int", "double", "float", "date", "timestamp", "boolean", "smallint")


def _folded(c: Column) -> Column:
    return F.lower(strip(F.coalesce(c.cast("string"), F.lit(""))))


def mark_duplicates(
    new: DataFrame,
    existing: DataFrame,
    key: str | None = "id",
    fields: Sequence[str] = ("title", "price"),
    blank_matches: bool = True,
) -> DataFrame:
    """JN-3: ``is_duplicate`` - known by id, or equal to an existing row in all ``fields``.

    Texts are compared trimmed and lower-cased; a missing value equals a missing value unless
    ``blank_matches`` is off. New rows are not compared with each other. The OR is two equi-joins, each
    adding a flag, so it never becomes a nested loop. The distinct keys are written first, which leaves a
    plain exchange below the join; rows without an id, which can match nothing, are dealt out by their texts.
    """
    out, flags = new, []
    if key:
        ids = durable(existing.select(F.col(key).cast("string").alias("_id")).filter("_id <> ''").distinct())
        texts = [F.col(c).cast("string") for c in new.columns if c != key and dict(new.dtypes)[c] in _PLAIN]
        apart = F.concat(F.lit("\u0000"), F.xxhash64(*texts).cast("string")) if texts else F.lit(None).cast("string")
        own = F.col(key).cast("string")
        out = out.withColumn("_own", F.when(own.isNull() | (own == ""), apart).otherwise(own))
        out = out.join(ids.withColumn("_by_id", F.lit(True)), F.col("_own") == F.col("_id"), "left")
        flags.append(F.col("_by_id"))
    if fields:
        names = [f"_f{i}" for i in range(len(fields))]
        seen = existing.select(*[_folded(F.col(f)).alias(n) for f, n in zip(fields, names)])
        if not blank_matches:
            seen = seen.filter(F.concat(*[F.col(n) for n in names]) != "")
        seen = durable(seen.distinct()).withColumn("_by_fields", F.lit(True))
        out = out.withColumns({n: _folded(F.col(f)) for f, n in zip(fields, names)})
        out = out.join(seen, names, "left")
        flags.append(F.col("_by_fields"))
    duplicate = F.coalesce(*flags, F.lit(False)) if flags else F.lit(False)
    return out.select(*new.columns, duplicate.alias("is_duplicate"))


def keep_unseen_indexed(listings: DataFrame, index: KeyIndex, key: str = "id") -> DataFrame:
    """JN-1 / SET-4 against a stored index. Rows without a key are kept."""
    return keep_unseen_either_indexed(listings, index, [key])


def keep_unseen_either_indexed(listings: DataFrame, index: KeyIndex, keys: Sequence[str]) -> DataFrame:
    """JN-2 against a stored index: one look-up for all key columns."""
    every = listings.select(F.explode(F.array(*[F.col(k).cast("string") for k in keys])).alias("key"))
    met = index.met(every).withColumnRenamed("key", "_met")
    out = listings
    for name in keys:
        out = out.join(met, F.col(name).cast("string") == F.col("_met"), "left_anti")
    return out


def _match_keys(rows: DataFrame, key: str | None, fields: Sequence[str], blank_matches: bool) -> list[Column]:
    """What a listing is known by: its id, and its folded fields together; null where that tells nothing."""
    own = []
    if key:
        text = F.col(key).cast("string")
        own.append(F.when(text != "", F.concat(F.lit("id\u0001"), text)))
    if fields:
        texts = F.concat_ws("\u0001", *[_folded(F.col(f)) for f in fields])
        present = F.concat(*[_folded(F.col(f)) for f in fields]) != ""
        told = F.concat(F.lit("fields\u0001"), texts)
        own.append(told if blank_matches else F.when(present, told))
    return own


def index_listings(
    index: KeyIndex, rows: DataFrame, key: str | None = "id", fields: Sequence[str] = ("title", "price"), blank_matches: bool = True
) -> None:
    """Add the listings of a run to an index that :func:`mark_duplicates_indexed` asks."""
    keys = _match_keys(rows, key, fields, blank_matches)
    index.append(rows.select(F.explode(F.array(*keys)).alias("key")))


def mark_duplicates_indexed(
    new: DataFrame, index: KeyIndex, key: str | None = "id", fields: Sequence[str] = ("title", "price"), blank_matches: bool = True
) -> DataFrame:
    """JN-3 against a stored index: :func:`mark_duplicates` without reading the target."""
    keys = _match_keys(new, key, fields, blank_matches)
    names = [f"_key{i}" for i in range(len(keys))]
    rows = new.withColumns(dict(zip(names, keys, strict=True)))
    met = index.met(rows.select(F.explode(F.array(*names)).alias("key")))
    # rows that one key tells nothing about can match nothing, and are dealt out by the others
    apart = F.concat(F.lit("\u0000"), F.xxhash64(*names).cast("string"))
    for name in names:
        flagged = met.select(F.col("key").alias(f"{name}_met"))
        rows = rows.withColumn(name, F.coalesce(name, apart)).join(flagged, F.col(name) == F.col(f"{name}_met"), "left")
    hit = F.coalesce(*[F.col(f"{n}_met") for n in names]).isNotNull()
    return rows.select(*new.columns, hit.alias("is_duplicate"))


def split_duplicates(new: DataFrame, existing: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """JN-3 as ``(unique, duplicates)``."""
    marked = mark_duplicates(new, existing, **options)
    drop = lambda flag: marked.filter(F.col("is_duplicate") == flag).drop("is_duplicate")
    return drop(False), drop(True)


def first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """WIN-2: first row per key in the given order. Rows without a key are dropped.

    Ties in ``order`` are settled by the remaining columns, so the outcome never depends on
    partitioning; the columns must therefore be orderable (no maps).
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order, *rest) if order or rest else Window.partitionBy(*keys).orderBy(*keys))
    # the rank filter is also applied in each partition, below the exchange
    return df.filter(present).withColumn("_place", place).filter("_place = 1").select(*df.columns)


def last_by_key(df: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    """WIN-3: value of the last row per key."""
    return df.groupBy(*keys).agg(F.max_by(value, F.struct(order, value)).alias(value))


# --- filters -----------------------------------------------------------------------------------------
def filter_date_range(
    df: DataFrame, start=None, end=None, column: str = "date_added", keep_null: bool = True
) -> DataFrame:
    """FLT-1: inclusive at both ends; undated rows pass unless ``keep_null`` is off."""
    inside = F.lit(True)
    if start is not None:
        inside = inside & (F.col(column) >= F.lit(start).cast("date"))
    if end is not None:
        inside = inside & (F.col(column) <= F.lit(end).cast("date"))
    null = F.col(column).isNull()
    return df.filter(null | inside) if keep_null else df.filter(~null & inside)


def filter_min_year(df: DataFrame, least: int = V.MIN_YEAR, column: str = "year") -> DataFrame:
    """FLT-2: minimum model year; a year that cannot be read passes."""
    year = F.col(column).try_cast("int")
    return df.filter(year.isNull() | (year >= least))


def filter_usable_cards(df: DataFrame, columns: Sequence[str] = ("id", "car_url")) -> DataFrame:
    """FLT-6: key and link present."""
    usable = F.lit(True)
    for c in columns:
        usable = usable & (F.coalesce(F.col(c), F.lit("")) != "")
    return df.filter(usable)


def pages_before_cutoff(df: DataFrame, cutoff, page: Sequence[str] = ("page",), column: str = "date_added") -> DataFrame:
    """FLT-8: per page, whether it has dated rows and all of them lie before ``cutoff``."""
    early = F.col(column) < F.lit(cutoff).cast("date")
    return df.groupBy(*page).agg(F.coalesce(F.bool_and(early), F.lit(False)).alias("all_before"))


def limit_pages(df: DataFrame, pages: int, start: int = 1, column: str = "page") -> DataFrame:
    """SRT-4: page budget, counted from ``start``."""
    return df.filter(F.col(column).between(start, start + pages - 1))


def truncate_text(c: Column, length: int = 100) -> Column:
    """SRT-4."""
    return F.substring(c, 1, length)


# --- stops along a feed ------------------------------------------------------------------------------
def stop_before_first(df: DataFrame, stop: Column, order: str, feed: Sequence[str] = ()) -> DataFrame:
    """Rows of each feed strictly before its first row (by ``order``) for which ``stop`` holds."""
    feeds = list(feed)
    first = F.min(F.when(stop, F.col(order))).alias("_first")
    if not feeds:
        bound = df.agg(first).first()["_first"]  # one number; as a literal it reaches the scan
        return df if bound is None else df.filter(F.col(order) < F.lit(bound))
    firsts = durable(df.groupBy(*feeds).agg(first))
    joined = df.join(firsts, feeds, "left")
    return joined.filter(F.col("_first").isNull() | (F.col(order) < F.col("_first"))).drop("_first")


def boundary_stop(df: DataFrame, start, order: str, feed: Sequence[str] = (), column: str = "date_added") -> DataFrame:
    """WIN-6: a date-sorted feed ends at its first row older than ``start``."""
    return stop_before_first(df, F.col(column) < F.lit(start).cast("date"), order, feed)


def cutoff_pages(df: DataFrame, cutoff, feed: Sequence[str] = (), page: str = "page", column: str = "date_added") -> DataFrame:
    """FLT-8 applied: pages before the first one whose dated rows all lie before ``cutoff``."""
    feeds = list(feed)
    flagged = pages_before_cutoff(df, cutoff, [*feeds, page], column)
    return _drop_from(df, flagged.filter("all_before"), feeds, page, keep_stop=False)


def _drop_from(df: DataFrame, stops: DataFrame, feeds: list[str], page: str, keep_stop: bool) -> DataFrame:
    """Rows up to the first stop page of their feed."""
    first = F.min(page).alias("_stop")
    within = lambda stop: F.col(page) <= stop if keep_stop else F.col(page) < stop
    if not feeds:
        bound = stops.agg(first).first()["_stop"]  # one number; as a literal it reaches the scan
        return df if bound is None else df.filter(within(F.lit(bound)))
    joined = df.join(durable(stops.groupBy(*feeds).agg(first)), feeds, "left")
    return joined.filter(F.col("_stop").isNull() | within(F.col("_stop"))).drop("_stop")


def caught_up_pages(
    df: DataFrame,
    patience: int,
    is_new: str = "is_new",
    feed: Sequence[str] = (),
    page: str = "page",
    kept: str | None = None,
) -> DataFrame:
    """WIN-1: stop page per feed, the first that completes ``patience`` stale pages in a row.

    Pages that left no rows are no pages here, so the pages of a feed are numbered first, in bands of
    ``PAGE_BAND``, whatever gaps they have. Every stale page votes for itself and the ``patience - 1`` pages
    after it, and a stale page with ``patience`` votes ends the run: a run of stale pages is found by
    counting, without walking the feed in order. With ``kept`` (whether a new row was accepted), a
    page of which every new row was rejected restarts the count at one instead of zero.
    """
    feeds = list(feed)
    new = F.coalesce(F.max(F.col(is_new).cast("int")), F.lit(0))
    aggregates = [new.alias("_new")]
    if kept:
        aggregates.append(
            F.coalesce(F.max((F.col(is_new) & F.col(kept)).cast("int")), F.lit(0)).alias("_kept")
        )
    pages = _numbered(durable(df.groupBy(*feeds, page).agg(*aggregates)), feeds, page)
    stale = F.col("_new") == 0
    reach = F.sequence(F.lit(0), F.lit(patience - 1))
    votes = F.when(stale, reach)
    if kept:
        # A fully rejected page counts as the first stale page, so it only supports the page that
        # is patience - 1 further on.
        rejected = (F.col("_new") == 1) & (F.col("_kept") == 0)
        votes = votes.when(rejected, F.array(F.lit(patience - 1)))
        stale = stale | rejected if patience == 1 else stale
    targets = F.transform(votes, lambda step: F.col("_number") + step)
    cast = pages.select(*feeds, F.explode(targets).alias("_number"))
    counted = cast.groupBy(*feeds, "_number").agg(F.count("*").alias("_votes"))
    full = counted.filter(F.col("_votes") == patience).drop("_votes")
    own = pages.filter(stale).select(*feeds, page, "_number")
    return own.join(full, [*feeds, "_number"], "left_semi").drop("_number")


PAGE_BAND = 10_000


def _numbered(pages: DataFrame, feeds: list[str], page: str) -> DataFrame:
    """``pages`` with ``_number``, their place in the feed: within a band, behind the bands before it."""
    banded = pages.withColumn("_band", F.floor(F.col(page) / PAGE_BAND))
    sizes = banded.groupBy(*feeds, "_band").agg(F.count("*").alias("_size"))
    before = Window.partitionBy(*feeds).orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.withColumn("_base", F.coalesce(F.sum("_size").over(before), F.lit(0).cast("bigint"))).drop("_size")
    own = F.row_number().over(Window.partitionBy(*feeds, "_band").orderBy(page))
    placed = banded.withColumn("_own", own).join(bases, [*feeds, "_band"])
    return placed.withColumn("_number", F.col("_base") + F.col("_own")).drop("_band", "_own", "_base")


def caught_up_cutoff(
    df: DataFrame,
    patience: int,
    is_new: str = "is_new",
    feed: Sequence[str] = (),
    page: str = "page",
    kept: str | None = None,
) -> DataFrame:
    """WIN-1: rows of the pages that an incremental run reads before it has caught up."""
    stops = caught_up_pages(df, patience, is_new, feed, page, kept)
    return _drop_from(df, stops, list(feed), page, keep_stop=True)
