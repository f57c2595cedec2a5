"""Spark session factory."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

# What the operators rely on. Sizing (executors, memory, shuffle partitions) is left to the cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app: str = "millrace", master: str | None = None, **conf: str) -> SparkSession:
    """Return a session with ANSI casts, UTC and adaptive execution on.

    ``conf`` takes dotted settings through ``**{"spark.x": "y"}`` and wins over the defaults.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the bench."""
    parallel = os.cpu_count() if cores == "*" else int(cores)
    return build_session(
        master=f"local[{cores}]",
        **{
            "spark.sql.shuffle.partitions": str(parallel),
            "spark.driver.memory": memory,
            "spark.ui.enabled": "false",
        },
    )
