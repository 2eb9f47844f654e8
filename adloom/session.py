"""Session defaults, intermediates in shared storage, and the package on executors."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from functools import lru_cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: dict[str, str] = {}
_DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "adloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators rely on; ``conf`` overrides any of them."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    ship_package(session)
    return session


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables: the one the cluster names in ``spark.checkpoint.dir``.

    A temporary folder stands in only where the setting is absent and driver and tasks are one process;
    elsewhere executors would write to disks that nobody else can read, so that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if re.fullmatch(r"local(\[[^\]]*\])?", master):
        return _local_folder()
    raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="spark-")


def fresh_path(spark: SparkSession, kind: str = "table") -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"


def durable(df: DataFrame, compression: str = "snappy", **options: str) -> DataFrame:
    """Write ``df`` to shared storage and read it back.

    That cuts lineage, so a lost executor never recomputes the scan behind it, runs the plan once,
    and leaves a table whose size the optimiser knows when it picks joins. The shuffles of the write
    are not needed once it is done, so their files go at once.
    """
    spark = df.sparkSession
    path = fresh_path(spark)
    before = spark.conf.get(_DROP_SHUFFLES, None)
    spark.conf.set(_DROP_SHUFFLES, "true")
    try:
        df.write.options(compression=compression, **options).parquet(path)
    finally:
        spark.conf.set(_DROP_SHUFFLES, before) if before is not None else spark.conf.unset(_DROP_SHUFFLES)
    return spark.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, so that Python tasks can import it."""
    context = spark.sparkContext
    if _SHIPPED.get("application") == context.applicationId:
        return
    home = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{home.name}.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for file in sorted(home.rglob("*.py")):
            out.write(file, file.relative_to(home.parent))
    context.addPyFile(str(archive))
    _SHIPPED["application"] = context.applicationId
