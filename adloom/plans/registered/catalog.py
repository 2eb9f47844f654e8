"""CAT-*, SRC-10, SNK-8, AGG-23, JN-13, PRJ-8, FLT-7: suppliers as sites, orders as their runs."""

from __future__ import annotations

from pyspark.sql import functions as F

from adloom.plans.registered.base import query, table
from adloom.session import fresh_path
from adloom.sources import catalog as C


def _sites(spark, sf):
    key = F.col("s_suppkey").cast("string")
    balance = F.col("s_acctbal")
    return table(spark, sf, "supplier").select(
        key.alias("id"), F.col("s_name").alias("name"),
        F.when(balance < 0, F.lit("ftp://x")).otherwise(F.concat(F.lit("https://s.example/"), key)).alias("url"),
        F.when(F.col("s_nationkey") < 12, "cars").when(F.col("s_nationkey") < 20, "realestate").otherwise("boats").alias("type"),
        F.when(balance > 9000, "X").otherwise("Adapter").alias("scraper_class"), F.lit("adapters/site.py").alias("scraper_file"),
        (balance > 1000).alias("enabled"), F.col("s_nationkey").alias("priority"), F.lit(0).alias("total_items"),
        F.lit(None).cast("timestamp").alias("last_run"), F.lit(None).cast("int").alias("last_run_count"),
        F.lit(None).cast("string").alias("last_run_status"), F.lit("old").alias("description"),
    )


def _jobs(spark, sf):
    """Order lines by supplier are runs."""
    return table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("website_id"), F.col("l_shipdate").cast("timestamp").alias("completed_at"),
        F.when(F.col("l_returnflag") == "R", "error").otherwise("success").alias("status"),
        F.col("l_quantity").cast("int").alias("items_count"),
    )


_SITES = """
site AS (SELECT CAST(s_suppkey AS VARCHAR) AS id, s_name AS name, CASE WHEN s_acctbal < 0 THEN 'ftp://x' ELSE concat('https://s.example/', CAST(s_suppkey AS VARCHAR)) END AS url,
           CASE WHEN s_nationkey < 12 THEN 'cars' WHEN s_nationkey < 20 THEN 'realestate' ELSE 'boats' END AS type, s_acctbal > 1000 AS enabled, s_nationkey AS priority, s_acctbal FROM supplier)
"""
_RUNS = """
run AS (SELECT CAST(l_suppkey AS VARCHAR) AS website_id, max({'t': l_shipdate, 's': CASE WHEN l_returnflag = 'R' THEN 'error' ELSE 'success' END, 'n': CAST(l_quantity AS INT)}) AS r
        FROM lineitem GROUP BY 1)
"""


@query("catalog_enabled", f"WITH {_SITES} SELECT id, name, type, priority FROM site WHERE enabled")
def _(spark, sf):
    return C.enabled_catalog(_sites(spark, sf)).select("id", "name", "type", "priority")


@query(
    "catalog_validation",
    f"""WITH {_SITES} SELECT id, concat_ws('; ', CASE WHEN s_acctbal < 0 THEN 'Valid URL is required (must start with http/https)' END,
       CASE WHEN type = 'boats' THEN 'Invalid website type' END, CASE WHEN s_acctbal > 9000 THEN 'Scraper class name is required' END) AS errors FROM site""",
)
def _(spark, sf):
    checked = C.validate_catalog(_sites(spark, sf))
    return checked.select("id", F.array_join("errors", "; ").alias("errors"))


@query("catalog_latest_runs", f"WITH {_RUNS} SELECT website_id, r.t AS last_run, r.s AS last_run_status, r.n AS last_run_count FROM run")
def _(spark, sf):
    return C.latest_runs(_jobs(spark, sf)).withColumn("last_run", F.col("last_run").cast("timestamp_ntz"))


@query(
    "catalog_status",
    f"""WITH {_SITES}, {_RUNS} SELECT id, type, enabled, coalesce(r.n, 0) AS total_items, r.n AS last_run_count,
        strftime(r.t, '%Y-%m-%d') AS last_run_date, strftime(r.t, '%H:%M:%S') AS last_run_time
        FROM site LEFT JOIN run ON id = website_id""",
)
def _(spark, sf):
    return C.status_summary(_sites(spark, sf), _jobs(spark, sf)).drop("last_run")


@query(
    "catalog_changes",
    f"""WITH {_SITES} SELECT id, CASE WHEN priority < 5 THEN upper(name) ELSE name END AS name,
        CASE WHEN priority < 2 THEN NULL WHEN priority < 5 THEN 'new' ELSE 'old' END AS description FROM site WHERE type <> 'boats'""",
)
def _(spark, sf):
    sites = _sites(spark, sf)
    said = F.when(F.col("priority") >= 2, "new")
    changes = sites.filter("priority < 5").select("id", F.upper("name").alias("name"), said.alias("description"), F.lit(2).alias("step"))
    earlier = sites.filter("priority < 5").select("id", F.lit("first").alias("name"), F.lit("first").alias("description"), F.lit(1).alias("step"))
    changed = C.upsert_catalog(sites, changes.unionByName(earlier), order=["step"])
    return C.delete_from_catalog(changed, sites.filter("type = 'boats'")).select("id", "name", "description")


@query(
    "catalog_saved",
    f"""WITH {_SITES} SELECT id, name, type, CASE WHEN priority < 5 THEN 'new' END AS description FROM site WHERE type <> 'boats'""",
)
def _(spark, sf):
    """A stored catalog, changed and saved over the version that it was read from."""
    path = fresh_path(spark, "catalog")
    C.save_catalog(_sites(spark, sf).withColumn("description", F.lit(None).cast("string")), path)
    sites = C.read_catalog(spark, path)
    C.save_catalog(C.upsert_catalog(sites, sites.filter("priority < 5").select("id", F.lit("new").alias("description"))), path)
    C.save_catalog(C.delete_from_catalog(C.read_catalog(spark, path), sites.filter("type = 'boats'")), path)
    return C.read_catalog(spark, path).select("id", "name", "type", "description")


@query(
    "catalog_migration",
    f"""WITH {_SITES}, known AS (SELECT * FROM site WHERE priority < 12)
        SELECT name, FALSE AS migrated, CAST(priority AS INT) AS priority, CAST(NULL AS VARCHAR) AS image_folder FROM known
        UNION ALL SELECT name, TRUE, priority, 'images/' || lower(name) FROM site WHERE name NOT IN (SELECT name FROM known)""",
)
def _(spark, sf):
    sites = _sites(spark, sf).select("id", "name", "type", "priority")
    known = sites.filter("priority < 12").withColumn("migrated", F.lit(False))
    again = sites.withColumn("id", F.concat(F.col("id"), F.lit("~"))).withColumn("priority", F.lit(-1))
    new = sites.unionByName(again).withColumn("migrated", F.lit(True))
    return C.add_websites(known, new).select("name", "migrated", "priority", "image_folder")


@query(
    "catalog_jobs",
    f"""WITH {_SITES} SELECT CAST(l_suppkey AS VARCHAR) AS website_id, name AS website_name, count(*) AS runs, CAST(sum(CAST(l_quantity AS INT)) AS BIGINT) AS items
        FROM site JOIN lineitem ON id = CAST(l_suppkey AS VARCHAR) GROUP BY ALL""",
)
def _(spark, sf):
    joined = C.with_jobs(_sites(spark, sf), _jobs(spark, sf))
    return joined.groupBy("website_id", "website_name").agg(F.count("*").alias("runs"), F.sum("items_count").alias("items"))


@query("catalog_groups", f"WITH {_SITES} SELECT type, count(*) AS sites FROM site WHERE type IN ('cars', 'realestate') GROUP BY type")
def _(spark, sf):
    groups = C.group_catalog(_sites(spark, sf))
    both = groups["cars"].unionByName(groups["realestate"])
    return both.groupBy("type").agg(F.count("*").alias("sites"))
