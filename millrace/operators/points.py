"""Share of points inside a quarter circle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def circle_hits(points: DataFrame, group: str = "grp", radius_squared: float = 1.0) -> DataFrame:
    """``<group>, hits, points``; a point on the circle is a hit."""
    inside = F.col("x") * F.col("x") + F.col("y") * F.col("y") <= F.lit(radius_squared)
    return points.groupBy(group).agg(F.count_if(inside).alias("hits"), F.count(F.lit(1)).alias("points"))


def circle_ratio(hits: DataFrame) -> DataFrame:
    """``hits, points, ratio`` over all groups; the ratio is four times the share inside."""
    total = hits.agg(F.sum("hits").alias("hits"), F.sum("points").alias("points"))
    return total.withColumn("ratio", F.try_divide(4.0 * F.col("hits"), F.col("points")))
