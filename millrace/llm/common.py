"""What the operators of this package share: words, shared folders, graph components."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def words(text):
    """The words of a text column as an array; null and blank texts give an empty one."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE + "+"), "")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def shared_folder(spark: SparkSession) -> str:
    """A new folder name in the folder that all executors share.

    It is the one the session names in ``spark.checkpoint.dir``, else one inside its warehouse.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_shared"
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """The frame written as Parquet in the shared folder and read back: lineage ends there.

    Lost executors cost nothing that is written, and two readers do not compute it twice.
    """
    spark = df.sparkSession
    folder = shared_folder(spark)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of the graph of ``(a, b)`` edges: one ``(node, root)`` row per node.

    ``root`` is the smallest node of the component. Alternating stars: each round hangs the larger
    neighbours of a node, then its smaller ones, on its smallest neighbour, until only stars are
    left. Rounds grow with the logarithm of the diameter. A round is two joins on a node with the
    minimum of its neighbours, which combines before the shuffle; no neighbourhood is collected,
    and a hot node's join can be split. Self-loops and repeated edges are fine; an edge with a null
    end is left out. An empty graph gives no rows.
    """
    # Nodes between large and small ends; each round's edges are a written table.
    now = written(
        edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    if now.isEmpty():
        return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    before = None
    while True:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        # Small star: an edge always runs from the larger end, so the neighbours are the smaller ones.
        roots = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(roots, "a")
        hung = small.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        now = written(hung.union(roots.select("a", F.col("m").alias("b"))).distinct())
        state = now.agg(
            F.count("*").alias("n"),
            F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("s"),
        ).first()
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
