"""Session defaults for runs that bring no session of their own."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


#: Spark 4.1 lets a union keep the partitioning of its sides, and a window above it has then been seen to number rows of
#: a key in two places, which gave wrong bands. Without it a union is followed by an exchange, as before 4.1.
UNION = "spark.sql.unionOutputPartitioning"


def guarded(spark: SparkSession) -> SparkSession:
    """``spark`` with that setting off. Queries call it; who uses operators in a session of their own should as well."""
    if spark.conf.get(UNION, "false") != "false":
        spark.conf.set(UNION, "false")
    return spark


def local_session(app: str = "cadastra", cpus: int | None = None) -> SparkSession:
    """A local session with the settings the tests and the bench use."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config(UNION, "false")
        .getOrCreate()
    )
