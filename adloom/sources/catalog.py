"""Site catalog, run ledger, statistics and audit tables (SRC-10, SNK-7, SNK-8, CAT-*, JN-13)."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adloom.functions.text import blank_to_null
from adloom.operators.incremental import first_by_key
from adloom.sources import schemas
from adloom.sources.versions import VersionedTable

SITE_TYPES = ["cars", "realestate", "other"]


# --- reading and migrating -------------------------------------------------------------------------
def load_catalog(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """SRC-10: sites of a JSON catalog with the nested schedule flattened. A catalog is one document, or
    one document a line when ``multi_line`` is off."""
    document = spark.read.schema(f"websites array<struct<{_colons(schemas.WEBSITE)}>>")
    sites = document.option("multiLine", multi_line).json(path).select(F.inline("websites"))
    return sites.select(
        *[c for c in sites.columns if c not in ("scheduling", "last_run")],
        F.col("scheduling.enabled").alias("scheduling_enabled"),
        F.col("scheduling.frequency").alias("scheduling_frequency"),
        F.col("scheduling.day").alias("scheduling_day"),
        F.col("scheduling.time").alias("scheduling_time"),
        F.col("last_run").try_cast("timestamp").alias("last_run"),
    )


def _colons(ddl: str) -> str:
    """Top-level ``name type`` pairs as struct members."""
    return ", ".join(p.strip().replace(" ", ":", 1) for p in ddl.split(", "))


def _new_names(new: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of names that are not known, one per name: the one with the smallest id, then columns in order."""
    order = [c for c in ["id", *[c for c in new.columns if c != "id"]] if c in new.columns]
    return first_by_key(new.join(known.select("name"), "name", "left_anti"), ["name"], order)


def migrate_catalog(existing: DataFrame, new: DataFrame) -> DataFrame:
    """SRC-10: add the sites whose name is not known yet, one per name, with defaults filled in."""
    fresh = _new_names(new, existing).withColumns(
        {
            "description": F.coalesce("description", F.lit("")),
            "enabled": F.coalesce("enabled", F.lit(False)),
            "scheduling_enabled": F.coalesce("scheduling_enabled", F.lit(False)),
            "priority": F.coalesce("priority", F.lit(0)),
            "total_items": F.coalesce("total_items", F.lit(0)),
        }
    )
    return existing.unionByName(fresh, allowMissingColumns=True)


# --- changing ----------------------------------------------------------------------------------------
def add_websites(catalog: DataFrame, new: DataFrame) -> DataFrame:
    """SNK-8: insert sites; a name that is taken, also by an earlier row of ``new``, is rejected; the image
    folder has a default."""
    fresh = _new_names(new, catalog)
    if "image_folder" not in fresh.columns:
        fresh = fresh.withColumn("image_folder", F.lit(None).cast("string"))
    fresh = fresh.withColumn(
        "image_folder",
        F.coalesce(
            blank_to_null(F.col("image_folder")), F.concat(F.lit("images/"), F.lower("name"))
        ),
    )
    return catalog.unionByName(fresh, allowMissingColumns=True)


def upsert_catalog(
    catalog: DataFrame, changes: DataFrame, updated_at: Column | None = None, order: Sequence[str] = ()
) -> DataFrame:
    """SNK-8: set the given attributes by ``id``, also to NULL; unknown attributes and ids are ignored.

    Of several changes for one id the last by ``order`` counts, and by the values where that is a tie.
    """
    known = [c for c in changes.columns if c in catalog.columns and c != "id"]
    latest = [F.desc(c) for c in [*order, *known]]
    place = F.row_number().over(Window.partitionBy("id").orderBy(*latest or ["id"]))
    last = changes.withColumn("_place", place).filter("_place = 1")
    renamed = last.select(
        "id", F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in known]
    )
    joined = catalog.join(renamed, "id", "left")
    out = [
        F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in known else F.col(c)
        for c in catalog.columns
    ]
    if "updated_at" in catalog.columns and "updated_at" not in known:
        stamp = F.current_timestamp() if updated_at is None else updated_at
        position = catalog.columns.index("updated_at")
        out[position] = F.when(F.col("_hit"), stamp).otherwise(F.col("updated_at")).alias("updated_at")
    return joined.select(*out)


def delete_from_catalog(catalog: DataFrame, ids: DataFrame) -> DataFrame:
    """SNK-8: drop sites by id."""
    return catalog.join(ids.select("id"), "id", "left_anti")


def save_catalog(catalog: DataFrame, path: str) -> None:
    """SNK-8: the catalog as a new version of the table, which it may well have been read from."""
    VersionedTable(catalog.sparkSession, path).replace(catalog)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The catalog as it was saved last."""
    return VersionedTable(spark, path).read()


# --- ledgers -----------------------------------------------------------------------------------------
def _append_row(spark: SparkSession, path: str, schema: str, values: Mapping, stamp: str) -> None:
    names = [part.split(" ")[0] for part in schema.split(", ")]
    unknown = set(values) - set(names)
    if unknown:
        raise ValueError(f"unknown columns {sorted(unknown)}")
    row = spark.createDataFrame([tuple(values.get(n) for n in names)], schema)
    row = row.withColumn("id", F.coalesce("id", F.expr("uuid()")))
    row = row.withColumn(stamp, F.coalesce(stamp, F.current_timestamp()))
    row.write.mode("append").parquet(path)


def append_ledger(path: str, rows: DataFrame, schema: str, stamp: str, defaults: Mapping | None = None) -> None:
    """SNK-7: many lines of a ledger in one write. ``rows`` has any of its columns; the others get their default,
    ids and time stamps are filled in. Columns that the ledger lacks are an error."""
    names = [part.split(" ")[0] for part in schema.split(", ")]
    unknown = set(rows.columns) - set(names)
    if unknown:
        raise ValueError(f"unknown columns {sorted(unknown)}")
    filled = {**(defaults or {}), "id": F.expr("uuid()"), stamp: F.current_timestamp()}

    def value(name: str, kind: str) -> Column:
        own = [F.col(name)] if name in rows.columns else []
        other = filled.get(name)
        return F.coalesce(*own, other if isinstance(other, Column) else F.lit(other)).cast(kind).alias(name)

    rows.select(*[value(*part.split(" ", 1)) for part in schema.split(", ")]).write.mode("append").parquet(path)


RUN_DEFAULTS = {"status": "pending", "items_count": 0, "duration_seconds": 0.0, "sheets_written": False}


def record_runs(path: str, runs: DataFrame) -> None:
    """SNK-7: lines of the run ledger from a table of runs."""
    append_ledger(path, runs, schemas.JOBS, "started_at", RUN_DEFAULTS)


def save_statistics_of(path: str, snapshots: DataFrame) -> None:
    """SNK-7: snapshots from a table of ``website_id, total_items, items_added`` and further columns, which together
    are the document that is kept as JSON."""
    own = ["website_id", "total_items", "items_added"]
    rest = [c for c in snapshots.columns if c not in own]
    append_ledger(path, snapshots.select(*own, F.to_json(F.struct(*rest)).alias("raw_statistics")), schemas.STATISTICS, "created_at")


def log_audits(path: str, events: DataFrame) -> None:
    """SNK-7: audit events from a table; ``details`` may be a struct or a map, which is kept as JSON."""
    if "details" in events.columns and dict(events.dtypes)["details"] != "string":
        events = events.withColumn("details", F.to_json("details"))
    append_ledger(path, events, schemas.AUDIT, "created_at")


def record_run(spark: SparkSession, path: str, website_id: str, **values) -> None:
    """SNK-7: one line of the run ledger."""
    _append_row(spark, path, schemas.JOBS, {**RUN_DEFAULTS, "website_id": website_id, **values}, "started_at")


def save_statistics(
    spark: SparkSession, path: str, website_id: str, total_items: int, items_added: int, stats: dict
) -> None:
    """SNK-7: statistics snapshot with the full document as JSON."""
    blob = json.dumps(stats, ensure_ascii=False)
    _append_row(
        spark, path, schemas.STATISTICS,
        {"website_id": website_id, "total_items": total_items, "items_added": items_added,
         "raw_statistics": blob},
        "created_at",
    )


def log_audit(
    spark: SparkSession, path: str, user_id: int, action: str, resource_type: str,
    resource_id: str | None = None, details: dict | None = None, ip_address: str | None = None,
    user_agent: str | None = None,
) -> None:
    """SNK-7: one audit event."""
    _append_row(
        spark, path, schemas.AUDIT,
        {"user_id": user_id, "action": action, "resource_type": resource_type,
         "resource_id": resource_id, "details": json.dumps(details) if details else None,
         "ip_address": ip_address, "user_agent": user_agent},
        "created_at",
    )


# --- queries -----------------------------------------------------------------------------------------
def ordered_catalog(catalog: DataFrame) -> DataFrame:
    """CAT-1 / SRT-2: by priority, then name."""
    return catalog.orderBy("priority", "name")


def enabled_catalog(catalog: DataFrame) -> DataFrame:
    """FLT-7 / CAT-1: enabled sites in order."""
    return ordered_catalog(catalog.filter("enabled"))


def find_website(catalog: DataFrame, column: str, value: str) -> DataFrame:
    """FLT-7: lookup by ``id`` or ``name``."""
    return catalog.filter(F.col(column) == value)


def group_catalog(catalog: DataFrame) -> dict[str, DataFrame]:
    """PRJ-8: car sites and real-estate sites."""
    return {kind: catalog.filter(F.col("type") == kind) for kind in ("cars", "realestate")}


def validate_catalog(catalog: DataFrame) -> DataFrame:
    """CAT-2: ``errors`` per row; empty means valid."""

    def missing(column: str, least: int) -> Column:
        return F.coalesce(F.length(column), F.lit(0)) < least

    # The messages.
    rules = [
        (missing("name", 2), "Website name is required (min 2 characters)"),
        (~F.coalesce(F.col("url").startswith("http"), F.lit(False)),
         "Valid URL is required (must start with http/https)"),
        (~F.coalesce(F.col("type").isin(SITE_TYPES), F.lit(False)), "Invalid website type"),
        (missing("scraper_class", 3), "Scraper class name is required"),
        (~F.coalesce(F.col("scraper_file").endswith(".py"), F.lit(False)),
         "Scraper file must be a Python file (.py)"),
    ]
    failed = F.array_compact(F.array(*[F.when(bad, F.lit(text)) for bad, text in rules]))
    return catalog.withColumn("errors", failed)


def latest_runs(jobs: DataFrame) -> DataFrame:
    """CAT-3: newest run per site; one row per site after a map-side combine."""
    return (
        jobs.groupBy("website_id")
        .agg(F.max(F.struct("completed_at", "status", "items_count")).alias("run"))
        .select(
            "website_id",
            F.col("run.completed_at").alias("last_run"),
            F.col("run.status").alias("last_run_status"),
            F.col("run.items_count").alias("last_run_count"),
        )
    )


def apply_runs(catalog: DataFrame, jobs: DataFrame) -> DataFrame:
    """CAT-4: write the newest run back to the catalog."""
    runs = latest_runs(jobs).withColumnRenamed("website_id", "id")
    return upsert_catalog(catalog, runs.withColumn("total_items", F.col("last_run_count")))


def status_summary(catalog: DataFrame, jobs: DataFrame) -> DataFrame:
    """AGG-23: dashboard line per site, with the last run split into date and time."""
    return apply_runs(catalog, jobs).select(
        "id", "type", "enabled", "total_items", "last_run", "last_run_count",
        F.date_format("last_run", "yyyy-MM-dd").alias("last_run_date"),
        F.date_format("last_run", "HH:mm:ss").alias("last_run_time"),
    )


def with_jobs(catalog: DataFrame, jobs: DataFrame, how: str = "inner") -> DataFrame:
    """JN-13: catalog rows with their runs (or statistics, which share ``website_id``)."""
    renamed = catalog.select(F.col("id").alias("website_id"), F.col("name").alias("website_name"))
    return renamed.join(jobs, "website_id", how)
