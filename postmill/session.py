"""A session with the settings the jobs rely on.

On a cluster the operator's own session is fine; only the time zone and
adaptive execution matter, and adaptive execution is Spark's default.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Small message files are packed into one task by their open cost.
    "spark.sql.files.openCostInBytes": str(1 << 18),
}


def build_session(app_name: str = "postmill", master: str | None = None, **conf: str) -> SparkSession:
    """Session with ``SETTINGS``; keyword ``conf`` uses ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name on storage that all executors share: below ``spark.checkpoint.dir``, or,
    in a local session without that setting, below the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/postmill-{uuid.uuid4().hex}"
