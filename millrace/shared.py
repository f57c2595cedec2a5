"""Frames that are used more than once: written to the folder all executors share, or kept for a while."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def new_folder(spark: SparkSession) -> str:
    """A new folder name under the folder that all executors share.

    It is the one the session names in ``spark.checkpoint.dir``, else one inside its warehouse; never
    a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The frame as Parquet in a new shared folder, read back. Lineage ends there: a lost executor costs nothing
    that is written, and no cache is left behind when the frame outlives the caller."""
    folder = new_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


@contextmanager
def kept(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """The frame kept by the executors, spilling to disk, until the block ends: for passes that all run inside it."""
    stored = df.persist(level)
    try:
        yield stored
    finally:
        stored.unpersist()
