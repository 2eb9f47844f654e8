"""Connected components of an edge table, by alternating stars (distributed union-find).

Every node hangs its larger neighbours, then its smaller ones, on the smallest node it knows, until nothing
changes; that takes some log(n) rounds for long chains and two or three for the stars that dedup makes.
Minima are partial aggregates and joins are plain equi-joins of written tables, so a node with a third of
all edges is split by adaptive execution. Edges stay in tables; the driver sees one checksum per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adloom.session import durable


def _checked(edges: DataFrame) -> tuple[DataFrame, tuple]:
    table = durable(edges)
    sums = table.agg(F.count("*"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
    return table, tuple(sums)


def _hang(rows: DataFrame, larger: bool) -> DataFrame:
    """Edges from each neighbour of ``node`` (the larger ones, or the smaller ones and itself) to its minimum."""
    least = durable(rows.groupBy("node").agg(F.least(F.min("node"), F.min("other")).alias("root")))
    joined = rows.join(least, "node")
    if larger:
        return joined.where("other > node").select(F.col("other").alias("high"), F.col("root").alias("low"))
    both = F.explode(F.array("node", "other"))
    return joined.select(both.alias("high"), F.col("root").alias("low")).where("high > low")


def components(edges: DataFrame) -> DataFrame:
    """``id, component`` (the smallest id reachable) of every node in ``edges`` (``a, b``), loops aside."""
    ordered = edges.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).where("high > low")
    table, seen = _checked(ordered.distinct())
    while seen[0]:
        both = table.select(F.col("high").alias("node"), F.col("low").alias("other")).unionByName(
            table.select(F.col("low").alias("node"), F.col("high").alias("other"))
        )
        large = durable(_hang(both, larger=True).distinct())
        table, now = _checked(_hang(large.toDF("node", "other"), larger=False).distinct())
        if now == seen:
            break
        seen = now
    roots = table.select(F.col("low").alias("id")).distinct().withColumn("component", F.col("id"))
    return table.select(F.col("high").alias("id"), F.col("low").alias("component")).unionByName(roots)
