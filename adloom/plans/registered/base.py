"""Registration, table access and the listing-shaped view of the driver tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    """Register a query under ``name`` with its SQL equivalent (none for what SQL cannot say)."""

    def add(run: Run) -> Run:
        if name in REGISTRY:
            raise ValueError(f"query {name!r} is registered already")
        REGISTRY[name] = Query(run, sql)
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt out to as many tasks as the session shuffles into. For queries that make much work of each small
    row: a table of one small file is one task, however long its rows then take."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def listing_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as listings: part is the car, supplier the seller, nation the city."""
    lines = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part")
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    source = F.concat(F.lit("src"), (F.col("l_suppkey") % 3).cast("string"))
    return (
        lines.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.concat_ws("_", source, "l_orderkey", "l_partkey", "l_linenumber").alias("id"),
            source.alias("source"),
            F.col("p_brand").alias("make"),
            F.col("p_name").alias("model"),
            F.year("l_shipdate").alias("year"),
            F.col("p_type").alias("body_type"),
            F.col("l_linestatus").alias("fuel_type"),
            F.col("l_returnflag").alias("transmission"),
            F.col("n_name").alias("city"),
            F.col("l_extendedprice").alias("price"),
            F.col("p_size").alias("size"),
            F.col("l_linenumber").alias("bedrooms"),
            F.col("l_shipdate").cast("date").alias("date_added"),
            F.col("s_name").alias("seller_name"),
        )
    )


LISTING_SQL = """
listing AS (
  SELECT concat_ws('_', concat('src', CAST(l_suppkey % 3 AS VARCHAR)), CAST(l_orderkey AS VARCHAR),
                   CAST(l_partkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS id,
         concat('src', CAST(l_suppkey % 3 AS VARCHAR)) AS source,
         p_brand AS make, p_name AS model, CAST(year(l_shipdate) AS INT) AS year,
         p_type AS body_type, l_linestatus AS fuel_type, l_returnflag AS transmission,
         n_name AS city, l_extendedprice AS price, p_size AS size, l_linenumber AS bedrooms,
         CAST(l_shipdate AS DATE) AS date_added, s_name AS seller_name
  FROM lineitem JOIN part ON l_partkey = p_partkey
                JOIN supplier ON l_suppkey = s_suppkey
                JOIN nation ON s_nationkey = n_nationkey
)
"""


def on_listings(body: str) -> str:
    """SQL over the listing view."""
    return f"WITH {LISTING_SQL.rstrip()} {body}"
