"""Statistics and market insight (AGG-1 to AGG-22).

A bundle of distributions shares one scan: the columns are turned into ``(dimension, name)`` pairs,
aggregated with a map-side combine, and only the aggregates are ranked. Ties in a ranking are settled
by name, because rows of a DataFrame have no first-seen order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adloom.functions.numbers import first_number
from adloom.functions.text import blank_to_null
from adloom.session import durable

UNKNOWN = "Unknown"
NOT_AVAILABLE = "N/A"


# --- building blocks -------------------------------------------------------------------------------
def number_in(df: DataFrame, column: str) -> Column:
    """NUM-4 for text, the value itself for numbers."""
    if dict(df.dtypes)[column] == "string":
        return first_number(F.col(column))
    return F.col(column).cast("double")


def make_of(df: DataFrame) -> Column:
    """``brand``, else ``make``."""
    names = [c for c in ("brand", "make") if c in df.columns]
    return F.coalesce(*[blank_to_null(F.col(c)) for c in names])


def combo_of(df: DataFrame) -> Column:
    """``make model``, either part ``Unknown`` when it is missing."""
    return F.concat_ws(
        " ", F.coalesce(make_of(df), F.lit(UNKNOWN)), F.coalesce("model", F.lit(UNKNOWN))
    )


def count_by(df: DataFrame, column: Column, name: str) -> DataFrame:
    return df.groupBy(column.alias(name)).agg(F.count("*").alias("n"))


def top_k(counts: DataFrame, k: int, value: str, name: str) -> DataFrame:
    """SRT-3: largest first, name ascending; runs as TakeOrderedAndProject."""
    return counts.orderBy(F.desc(value), F.asc(name)).limit(k)


def rank_within(counts: DataFrame, k: Mapping[str, int], group: str = "dimension", value: str = "n") -> DataFrame:
    """First ``k[group]`` rows of each group; other groups are kept whole.

    The rank filter is pushed below the exchange, so a task never sorts more than its own part and
    the ranked groups arrive with at most k rows per input partition.
    """
    limited = counts.filter(F.col(group).isin(list(k)))
    order = Window.partitionBy(group).orderBy(F.desc(value), F.asc("name"))
    ranked = limited.withColumn("_rank", F.row_number().over(order)).filter(
        F.col("_rank") <= max(k.values())
    )
    allowed = F.coalesce(*[F.when(F.col(group) == g, F.lit(n)) for g, n in k.items()])
    kept = ranked.filter(F.col("_rank") <= allowed).drop("_rank")
    return kept.unionByName(counts.filter(~F.col(group).isin(list(k))))


# --- single statistics -------------------------------------------------------------------------------
def total_items(df: DataFrame, as_of: Column | None = None) -> DataFrame:
    """AGG-1."""
    stamp = F.current_timestamp() if as_of is None else as_of
    return df.agg(F.count("*").alias("total_items")).withColumn("scraped_at", stamp)


def is_filled(name: str, kind: str) -> Column:
    """Whether a column of that type holds something: not blank, zero, false or ``N/A``."""
    c = F.col(f"`{name}`")
    if kind == "string":
        return (c != "") & (c != NOT_AVAILABLE)
    if kind == "boolean":
        return c
    if kind.startswith(("array", "map")):
        return F.size(c) > 0
    if kind.startswith(("int", "bigint", "smallint", "tinyint", "double", "float", "decimal")):
        return c != 0
    return c.isNotNull()


def field_population(df: DataFrame) -> DataFrame:
    """AGG-2: ``(field, populated)`` - values that are present, not blank, zero, false or ``N/A``."""
    counted = df.agg(*[F.count_if(is_filled(n, k)).alias(n) for n, k in df.dtypes])
    return counted.unpivot([], counted.columns, "field", "populated")


def top_makes(df: DataFrame, k: int = 5) -> DataFrame:
    """AGG-3."""
    counts = count_by(df, make_of(df), "name").filter("name IS NOT NULL")
    return top_k(counts, k, "n", "name").select("name", F.col("n").alias("count"))


def year_stats(df: DataFrame) -> DataFrame:
    """AGG-4: over years written as digits only."""
    text = F.col("year").cast("string")
    year = F.when(text.rlike(r"^\d+$"), text.try_cast("int"))
    return df.agg(
        F.avg(year).alias("avg_year"), F.min(year).alias("min_year"), F.max(year).alias("max_year")
    )


def price_stats(df: DataFrame, column: str = "price") -> DataFrame:
    """AGG-5: zero and unreadable prices are left out."""
    value = number_in(df, column)
    price = F.when(value != 0, value)
    return df.agg(
        F.avg(price).alias("avg_price"), F.min(price).alias("min_price"),
        F.max(price).alias("max_price"),
    )


def distribution(df: DataFrame, column: str, missing: str | None = None) -> DataFrame:
    """AGG-6/9/11/12/14: count per value, as text.

    ``missing`` names the group of NULL values; without it NULL and ``N/A`` are left out.
    """
    name = F.col(column).cast("string")
    if missing is not None:
        return count_by(df, F.coalesce(name, F.lit(missing)), column).withColumnRenamed("n", "count")
    kept = df.filter(name.isNotNull() & (name != NOT_AVAILABLE))
    return count_by(kept, name, column).withColumnRenamed("n", "count")


def top_locations(df: DataFrame, k: int = 5, column: str = "location") -> DataFrame:
    """AGG-7."""
    counts = distribution(df, column).withColumnsRenamed({column: "name", "count": "n"})
    return top_k(counts, k, "n", "name").select("name", F.col("n").alias("count"))


def price_per_unit(df: DataFrame, price: str = "price", size: str = "size") -> DataFrame:
    """AGG-8: mean of price-to-size ratios over rows that have both."""
    p, s = number_in(df, price), number_in(df, size)
    ratio = F.when((p != 0) & (s > 0), F.try_divide(p, s))
    return df.agg(F.avg(ratio).alias("avg_price_per_sqm"))


def make_model_combos(df: DataFrame, k: int = 10) -> DataFrame:
    """AGG-10."""
    return top_k(count_by(df, combo_of(df), "model"), k, "n", "model").select(
        "model", F.col("n").alias("count")
    )


def avg_price_by_location(df: DataFrame, k: int = 10, location: str = "location", price: str = "price") -> DataFrame:
    """AGG-13."""
    value = number_in(df, price)
    priced = df.filter(value != 0)
    averages = priced.groupBy(F.coalesce(F.col(location), F.lit(UNKNOWN)).alias("location")).agg(
        F.avg(value).alias("avg_price")
    )
    return top_k(averages, k, "avg_price", "location")


def scraper_stats(df: DataFrame) -> DataFrame:
    """AGG-15/17: one nested row; zeros where nothing was counted."""
    price = F.when(number_in(df, "price") != 0, number_in(df, "price"))
    year = F.when(F.col("year").try_cast("int") != 0, F.col("year").try_cast("int"))
    brand = make_of(df)
    place = blank_to_null(F.col("location" if "location" in df.columns else "city"))
    complete = price.isNotNull() & brand.isNotNull() & year.isNotNull() & place.isNotNull()
    flat = df.agg(
        F.count("*").alias("total_items"),
        F.count(price).alias("price_count"), F.round(F.avg(price), 2).alias("price_average"),
        F.min(price).alias("price_min"), F.max(price).alias("price_max"),
        F.count(year).alias("year_count"), F.floor(F.avg(year)).cast("int").alias("year_average"),
        F.min(year).alias("year_min"), F.max(year).alias("year_max"),
        F.count_if(complete).alias("items_with_complete_data"),
    )

    def block(name: str) -> Column:
        parts = [F.col(f"{name}_count").alias("count")]
        for p in ("average", "min", "max"):
            parts.append(F.coalesce(F.col(f"{name}_{p}"), F.lit(0)).alias(p))
        return F.struct(*parts).alias(f"{name}_stats")

    return flat.select(
        "total_items", block("price"), block("year"), "items_with_complete_data"
    )


def brand_counts(df: DataFrame) -> DataFrame:
    """AGG-16: all brands, most frequent first."""
    counts = count_by(df, make_of(df), "brand").filter("brand IS NOT NULL")
    return counts.orderBy(F.desc("n"), F.asc("brand")).select("brand", F.col("n").alias("count"))


def complete_records(df: DataFrame) -> DataFrame:
    """AGG-17."""
    return scraper_stats(df).select("items_with_complete_data")


# --- bundles -------------------------------------------------------------------------------------------
TOTAL = "total"


def market_analysis(df: DataFrame, kind: str = "cars", as_of: Column | None = None) -> DataFrame:
    """AGG-18 as ``(section, name, count, value)`` rows, from a single pass over the listings.

    ``items_by_field`` counts the filled values of each column; ``scraped_at`` holds the time of the
    analysis, ``as_of``, as its name.
    Rankings and distributions carry counts, the other sections carry values. What the pass yields is small next
    to the listings and is written out, as several sections are read from it.
    """
    return market_sections(durable(partial_statistics(df, kind)), kind, as_of)


def _plan(df: DataFrame, kind: str) -> tuple[dict[str, Column], dict[str, Column]]:
    """Numbers that figures are made of, and the names of each dimension."""
    price = number_in(df, "price")
    price = F.when(price != 0, price)
    named = lambda c: F.when(F.col(c).cast("string") != NOT_AVAILABLE, F.col(c))
    if kind == "cars":
        text = F.col("year").cast("string")
        numbers = {"price": price, "year": F.when(text.rlike(r"^\d+$"), text.try_cast("int"))}
        dimensions = {
            "top_makes": make_of(df),
            "most_common_models": combo_of(df),
            "body_type_distribution": named("body_type"),
            "fuel_type_distribution": F.coalesce("fuel_type", F.lit(UNKNOWN)),
            "transmission_distribution": F.coalesce("transmission", F.lit(UNKNOWN)),
        }
    else:
        size = number_in(df, "size")
        numbers = {"price": price, "ratio": F.when(size > 0, F.try_divide(price, size))}
        dimensions = {
            "top_locations": named("location"),
            "most_expensive_locations": F.coalesce("location", F.lit(UNKNOWN)),
            "bedroom_distribution": named("bedrooms"),
            "property_type_distribution": F.coalesce("property_type", F.lit(UNKNOWN)),
        }
    return numbers, dimensions


_LIMITS = {"cars": {"top_makes": 5, "most_common_models": 10}, "realestate": {"top_locations": 5}}
_PRICED = {"cars": [TOTAL], "realestate": [TOTAL, "most_expensive_locations"]}


def partial_statistics(df: DataFrame, kind: str = "cars", by: Sequence[str] = ()) -> DataFrame:
    """AGG-18 / STM-7: what the sections of a market analysis are made of, for one batch of listings.

    ``(dimension, name, n, <number>_sum, <number>_n, <number>_min, <number>_max, filled_<column>)``: counts, sums and
    extremes only, so that the parts of batches merge into those of all their listings. One aggregation by
    ``(dimension, name)`` yields them; figures over everything belong to the one-member dimension ``total``, and only
    rows of a dimension that needs a figure carry the number it is made of. The columns ``by`` tell several batches
    apart, whose parts then come from one pass; they are no columns of a listing.
    """
    numbers, dimensions = _plan(df, kind)
    return _grouped(df, {TOTAL: F.lit(TOTAL), **dimensions}, numbers, _PRICED[kind], by)


def merge_statistics(parts: DataFrame) -> DataFrame:
    """Parts of several batches as those of one; columns that only some batches have count as empty in the others."""
    figures = [c for c in parts.columns if c not in ("dimension", "name")]
    how = lambda c: F.min if c.endswith("_min") else F.max if c.endswith("_max") else F.sum
    return parts.groupBy("dimension", "name").agg(*[how(c)(f"`{c}`").alias(c) for c in figures])


class StatisticsStore:
    """AGG-18 / STM-7: the parts of all batches so far, in a folder per batch.

    A batch that is added again takes the place of its earlier self, so repeated driver steps and stream batches
    count once. Reading takes a row per batch, dimension and name, never the listings.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def add(self, batch: int | str, parts: DataFrame) -> None:
        """Store the parts of one batch; their files are few where the parts are small, and no task holds them all."""
        parts.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def read(self) -> DataFrame:
        """The parts of all batches, merged."""
        every = self.spark.read.option("mergeSchema", True).parquet(self.path)
        return merge_statistics(every.drop("batch"))


def market_sections(parts: DataFrame, kind: str = "cars", as_of: Column | None = None) -> DataFrame:
    """The sections of :func:`market_analysis` from merged parts, which are best written before."""
    fields_of = [c.removeprefix("filled_") for c in parts.columns if c.startswith("filled_")]
    means = {c.replace("_sum", "_avg"): F.try_divide(c, c.replace("_sum", "_n")) for c in parts.columns if c.endswith("_sum")}
    groups, limits, priced = parts.withColumns(means), _LIMITS[kind], _PRICED[kind]
    fields = groups.filter(F.col("dimension") == TOTAL).select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("name"), F.col(f"`filled_{n}`").alias("count")) for n in fields_of]))
    )
    listed = groups.filter(~F.col("dimension").isin(priced)).select("dimension", "name", "n")
    none = F.lit(None)
    stamp = F.current_timestamp() if as_of is None else as_of
    sections = rank_within(listed, limits).select(
        F.col("dimension").alias("section"), "name", F.col("n").alias("count"),
        none.cast("double").alias("value"),
    ).unionByName(_totals(groups.filter(F.col("dimension") == TOTAL), kind))
    sections = sections.unionByName(
        fields.select(F.lit("items_by_field").alias("section"), "name", "count", none.cast("double").alias("value"))
    ).unionByName(
        parts.sparkSession.range(1).select(
            F.lit("scraped_at").alias("section"), stamp.cast("string").alias("name"),
            none.cast("bigint").alias("count"), none.cast("double").alias("value"),
        )
    )
    if kind == "cars":
        return sections
    averages = groups.filter((F.col("dimension") == "most_expensive_locations") & F.col("price_avg").isNotNull())
    dear = top_k(averages.select("name", "price_avg"), 10, "price_avg", "name")
    return sections.unionByName(
        dear.select(
            F.lit("most_expensive_locations").alias("section"), "name",
            none.cast("bigint").alias("count"), F.col("price_avg").alias("value"),
        )
    )


def _grouped(
    df: DataFrame, dimensions: Mapping[str, Column], numbers: Mapping[str, Column], priced: Sequence[str], by: Sequence[str] = ()
) -> DataFrame:
    """The flags of filled columns travel with the one-member dimension only."""
    filled = {n: F.coalesce(is_filled(n, k), F.lit(False)) for n, k in df.dtypes if n not in by}

    def entry(dimension: str, name: Column) -> Column:
        carried = [
            (c.cast("double") if dimension in priced else F.lit(None).cast("double")).alias(k)
            for k, c in numbers.items()
        ]
        flags = [(f if dimension == TOTAL else F.lit(None).cast("boolean")).alias(f"filled_{n}") for n, f in filled.items()]
        return F.struct(F.lit(dimension).alias("dimension"), name.cast("string").alias("name"), *carried, *flags)

    exploded = df.select(*by, F.inline(F.array(*[entry(d, c) for d, c in dimensions.items()])))
    figures = [
        f(k).alias(f"{k}_{label}")
        for k in numbers for label, f in (("sum", F.sum), ("n", F.count), ("min", F.min), ("max", F.max))
    ]
    return (
        exploded.filter("name IS NOT NULL").groupBy(*by, "dimension", "name")
        .agg(F.count("*").alias("n"), *figures, *[F.count_if(F.col(f"`filled_{n}`")).alias(f"filled_{n}") for n in filled])
    )


def _totals(total: DataFrame, kind: str) -> DataFrame:
    """Sections of figures over all listings."""
    total = total.groupBy().agg(
        F.coalesce(F.max("n"), F.lit(0)).cast("double").alias("n"),
        *[F.max(c).alias(c) for c in total.columns if c not in ("dimension", "name", "n")],
    )
    if kind == "cars":
        figures = {(f"{k}_stats", f): f"{k}_{f}" for k in ("year", "price") for f in ("avg", "min", "max")}
    else:
        figures = {("avg_price_per_sqm", "avg"): "ratio_avg"}
    entries = [
        F.struct(
            F.lit(section).alias("section"), F.lit(name).alias("name"),
            F.lit(None).cast("bigint").alias("count"), F.col(column).alias("value"),
        )
        for (section, name), column in {(TOTAL, "items"): "n", **figures}.items()
    ]
    return total.select(F.inline(F.array(*entries)))


# --- run counters --------------------------------------------------------------------------------------
def run_counters(rows: DataFrame, started: Column | None = None, ended: Column | None = None) -> DataFrame:
    """AGG-20: counters of a run whose rows carry boolean ``is_new``, ``is_duplicate``, ``accepted``
    and ``fixed`` (missing ones count as zero). ``started`` and ``ended`` are timestamps, literal or
    aggregated, and give the duration in seconds."""

    def flag(name: str) -> Column:
        return F.col(name) if name in rows.columns else F.lit(None).cast("boolean")

    duration = []
    if started is not None and ended is not None:
        seconds = ended.cast("timestamp").cast("double") - started.cast("timestamp").cast("double")
        duration.append(seconds.alias("duration_seconds"))
    return rows.agg(
        F.count("*").alias("seen"),
        F.count_if(flag("is_new")).alias("new"),
        F.count_if(flag("is_duplicate")).alias("duplicate"),
        F.count_if(flag("accepted")).alias("saved"),
        F.count_if(~flag("accepted")).alias("skipped"),
        F.count_if(flag("fixed")).alias("fixed"),
        *duration,
    )


def expected_by_location(filters: DataFrame) -> DataFrame:
    """AGG-22: location filters ``(name, count)`` with cars, most first."""
    return filters.filter("count > 0").orderBy(F.desc("count"), F.asc("name"))


def expected_total(filters: DataFrame) -> DataFrame:
    """AGG-22: announced cars over all locations."""
    return filters.filter("count > 0").agg(F.sum("count").alias("expected_total"))
