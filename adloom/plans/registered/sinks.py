"""SNK-*, SRT-1: cells, alignment and repair, as the rows that a sink would write."""

from __future__ import annotations

from pyspark.sql import functions as F

from adloom.functions.numbers import clean_number
from adloom.operators.repair import diff_columns, repair_data, repair_stored
from adloom.plans.registered.base import listing_view, on_listings, query, table
from adloom.plans.registered.matching import NORMALIZED, NORMALIZED_FIELDS, raw_listings, vocabulary_of
from adloom.session import fresh_path
from adloom.sources.tables import align_schema, sort_newest_first, to_cells
from adloom.sources.versions import VersionedTable


@query(
    "sheet_cells",
    on_listings("""SELECT id, make, '' AS phone, CAST(year AS VARCHAR) AS year, CAST(date_added AS VARCHAR) AS date_added,
                          concat(source, ', ', city) AS image_urls, CASE WHEN bedrooms < 4 THEN model ELSE '' END AS model FROM listing"""),
)
def _(spark, sf):
    rows = listing_view(spark, sf).withColumns(
        {"image_urls": F.array("source", "city"), "model": F.when(F.col("bedrooms") < 4, F.col("model"))}
    )
    return to_cells(rows, ["id", "make", "model", "year", "phone", "date_added", "image_urls"])


@query(
    "schema_align",
    on_listings("SELECT id, source, NULL AS car_url, make, model, price, NULL AS phone FROM listing"),
)
def _(spark, sf):
    rows = listing_view(spark, sf).select("id", "source", "make", "model", "price")
    return align_schema(rows, ["id", "source", "car_url", "make", "model", "price", "phone"], "insert")


@query("newest_first", on_listings("SELECT id, date_added FROM listing"))
def _(spark, sf):
    return sort_newest_first(listing_view(spark, sf).select("id", "date_added"))


@query(
    "repair_changes",
    """
    SELECT * FROM (
      SELECT CAST(p_partkey AS VARCHAR) AS id, 'price' AS field, concat('$', format('{:,}', CAST(floor(p_retailprice) AS BIGINT))) AS old,
             CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) AS new FROM part
      UNION ALL
      SELECT CAST(p_partkey AS VARCHAR), 'seats', CASE WHEN p_size < 25 THEN p_type ELSE concat(CAST(p_size AS VARCHAR), ' seats') END,
             CASE WHEN p_size < 25 THEN '' ELSE CAST(p_size AS VARCHAR) END FROM part)
    """,
)
def _(spark, sf):
    return _repaired(_repairable(spark, sf))[1]


def _repairable(spark, sf):
    size = F.col("p_size")
    return table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("id"), F.concat(F.lit("$"), F.format_number(F.floor("p_retailprice"), 0)).alias("price"),
        F.when(size < 25, F.col("p_type")).otherwise(F.concat(size.cast("string"), F.lit(" seats"))).alias("seats"),
        size.cast("string").alias("year"),
    )


def _repaired(rows):
    fields = ["price", "seats", "year"]
    both = rows.withColumns({f"new_{f}": clean_number(F.col(f)) for f in fields})
    return diff_columns(both, {f: f"new_{f}" for f in fields}, "id", allow_blank=True)


@query(
    "repair_stored",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS id, CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) AS price,
           CASE WHEN p_size >= 25 THEN CAST(p_size AS VARCHAR) END AS seats, CAST(p_size AS VARCHAR) AS year FROM part
    """,
)
def _(spark, sf):
    """A stored table repaired in place, twice: the second repair finds nothing to change."""
    stored = VersionedTable(spark, fresh_path(spark, "repaired"))
    stored.replace(_repairable(spark, sf))
    repair_stored(stored, _repaired)
    again = repair_stored(stored, _repaired)
    return stored.read().join(again.select("id").distinct(), "id", "left_anti").select("id", "price", "seats", "year")


@query(
    "repair_table",
    f"WITH RECURSIVE {NORMALIZED} " + " UNION ALL ".join(
        f"SELECT concat_ws('_', l_orderkey, l_partkey, l_linenumber) AS id, '{f}' AS field, old_{f} AS old, {f} AS new FROM normalized WHERE {f} <> old_{f}"
        for f in NORMALIZED_FIELDS
    ),
)
def _(spark, sf):
    rows = raw_listings(spark, sf).withColumn("id", F.concat_ws("_", "l_orderkey", "l_partkey", "l_linenumber"))
    return repair_data(rows, vocabulary_of(spark, sf), allow_blank=False, strip_compounds=True)[1]
