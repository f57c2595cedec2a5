"""Savings projections over tables of people and savings plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import savings


def find_people(names: DataFrame, people: DataFrame, order: Sequence[str], missing: str = "null") -> DataFrame:
    """``name, gender, birth_year`` for each row of ``names``: the first person of that exact name.

    ``order`` names the columns of ``people`` that give the order of the file. A name nobody has
    gives nulls, or fails the query with ``missing="raise"``.
    """
    # An aggregate, not a window: the copies of a name are combined on the map side.
    first = people.groupBy("name").agg(
        F.min_by(F.struct("gender", "birth_year"), F.struct(*order)).alias("person")
    )
    found = names.select("name").join(first, "name", "left")
    if missing == "raise":
        unknown = F.raise_error(F.concat(F.lit("no such person: "), F.col("name")))
        gender = F.when(F.col("person").isNull(), unknown.cast("string")).otherwise(F.col("person.gender"))
    else:
        gender = F.col("person.gender")
    return found.select("name", gender.alias("gender"), F.col("person.birth_year").alias("birth_year"))


def project(people: DataFrame, plans: DataFrame) -> DataFrame:
    """Join people with their plans and add every projected quantity, unrounded.

    ``lifestyle`` is null where there are no retirement years.
    """
    joined = people.join(plans, "name")
    timed = joined.withColumns(
        {
            "working_years": F.col("retirement_age") - F.col("start_age"),
            "death_age": savings.death_age(F.col("gender"), F.col("birth_year")),
        }
    )
    saved = timed.withColumns(
        {
            "retirement_years": F.col("death_age") - F.col("retirement_age"),
            "balance": savings.balance(
                F.col("contribution"), F.col("working_years"), savings.yearly_rate(F.col("strategy"))
            ),
        }
    )
    lived = saved.withColumn("lifestyle", F.try_divide("balance", F.col("retirement_years").cast("double")))
    return lived.withColumn("band", savings.band(F.col("lifestyle")))


def report(projected: DataFrame) -> DataFrame:
    """The projection with payout and percentage of a median salary to one decimal."""
    return projected.select(
        "name", "gender", "birth_year", "start_age", "retirement_age", "working_years", "strategy", "contribution",
        F.round("balance", 1).alias("payout"),
        "death_age", "retirement_years",
        F.round(F.col("lifestyle") * 100.0, 1).alias("percent"),
        "band",
    )


def summary(projected: DataFrame) -> DataFrame:
    """``strategy, band, n, mean_balance``."""
    return projected.groupBy("strategy", "band").agg(
        F.count(F.lit(1)).alias("n"), F.avg("balance").alias("mean_balance")
    )
