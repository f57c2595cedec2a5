"""Categorical features into a decision tree, on MLlib."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.shared import kept, written

PLACE_BITS = 33  # of a row's number inside its partition, as monotonically_increasing_id has them


def category_indices(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``feature, value, idx`` for every value of the columns: the most frequent is 0, ties are
    alphabetical, nulls have no number. A fitted indexer numbers them alike.

    The values stay in Spark and may be as many as the rows. They are sorted by range; a row's number is
    its place in its partition, plus the rows of the partitions before, less the feature's first place.
    The sorted values are written, as both the places and the sizes are read from them.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in columns])
    counts = df.select(F.inline(cells)).filter("value IS NOT NULL").groupBy("feature", "value").count()
    ordered = counts.orderBy("feature", F.desc("count"), "value").select("feature", "value", F.monotonically_increasing_id().alias("at"))
    ordered = written(ordered)
    part = F.shiftright("at", PLACE_BITS)
    # One row per partition and one per feature: few enough for a running sum in one task.
    sizes = ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.col("at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    placed = ordered.join(offsets, part == F.col("part")).select("feature", "value", (F.col("offset") + inside).alias("place"))
    firsts = placed.groupBy("feature").agg(F.min("place").alias("first"))
    return placed.join(firsts, "feature").select("feature", "value", (F.col("place") - F.col("first")).cast("double").alias("idx"))


def encoder(columns: Sequence[str]) -> OneHotEncoder:
    """Indices to 0/1 vectors without the last category; outputs end in ``_vec``."""
    return OneHotEncoder(inputCols=[f"{c}_idx" for c in columns], outputCols=[f"{c}_vec" for c in columns])


def one_hot(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_idx`` and ``<column>_vec`` for every column. Null values have null in both."""
    ranks = category_indices(df, columns)
    # The encoder needs no more of the data than each column's highest index.
    highest = [F.coalesce(F.max(F.when(F.col("feature") == c, F.col("idx"))), F.lit(0.0)).alias(f"{c}_idx") for c in columns]
    coded = df
    for c in columns:
        own = ranks.filter(F.col("feature") == c).select(F.col("value").alias(f"_value_{c}"), F.col("idx").alias(f"{c}_idx"))
        coded = coded.join(own, F.col(c) == F.col(f"_value_{c}"), "left").drop(f"_value_{c}")
    return encoder(columns).fit(ranks.agg(*highest)).transform(coded)


def tree_pipeline(columns: Sequence[str], label: str) -> Pipeline:
    """Index, encode and assemble the features, index the label, train a tree with default settings.

    A feature value that training never saw is no category at all; such a label fails. MLlib's indexer
    holds the categories of a model on the driver, as the model does itself.
    """
    indexer = StringIndexer(inputCols=list(columns), outputCols=[f"{c}_idx" for c in columns], handleInvalid="keep")
    assembler = VectorAssembler(inputCols=[f"{c}_vec" for c in columns], outputCol="features")
    label_indexer = StringIndexer(inputCol=label, outputCol=f"{label}_idx")
    tree = DecisionTreeClassifier(labelCol=f"{label}_idx", featuresCol="features")
    return Pipeline(stages=[indexer, encoder(columns), assembler, label_indexer, tree])


def split_rows(df: DataFrame, share: float, seed: int, keys: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Two disjoint parts of about ``share`` and ``1 - share`` of the rows, whole together.

    The side of a row depends on the MD5 of its ``keys`` (all columns by default), not on its place
    in a partition, so it stays the same when a lost task runs again or a plan changes.
    """
    text = F.concat_ws("|", *[F.col(key).cast("string") for key in keys or df.columns], F.lit(str(seed)))
    draw = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 1_000_000
    first = draw < F.lit(round(share * 1_000_000))
    return df.filter(first), df.filter(~first)


def train_tree(training: DataFrame, columns: Sequence[str], label: str) -> PipelineModel:
    """Fit the pipeline. The needed columns are kept (spilling to disk) while the passes over them run."""
    with kept(training.select(*columns, label)) as rows:
        return tree_pipeline(columns, label).fit(rows)


def accuracy(scored: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    """``accuracy, test_error, n``."""
    right = F.avg((F.col(label) == F.col(prediction)).cast("double"))
    rates = scored.agg(right.alias("accuracy"), F.count(F.lit(1)).alias("n"))
    return rates.select("accuracy", (1.0 - F.col("accuracy")).alias("test_error"), "n")
