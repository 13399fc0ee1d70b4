"""Session settings the package relies on, and the shared work folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Runtime settings that suit jobs over large event tables. None of them changes
# a result; UTC does, and is therefore applied by `use_utc` as well.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app_name: str, master: str | None = None, **overrides: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Event dates and hours are UTC dates and hours, whatever the cluster's zone."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the cluster's shared `spark.checkpoint.dir`.

    A machine-local folder is only used by a local-mode session that names none.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        stamp = spark.sql("SELECT uuid()").first()[0]
        return f"{shared.rstrip('/')}/cairnlake-{purpose}-{stamp}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return tempfile.mkdtemp(prefix=f"cairnlake-{purpose}-")
