"""Per-person savings arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
YEARLY_RATE = {"growth": 1.045, "balanced": 1.035, "conservative": 1.025, "cash": 1.01}
BASE_YEAR = 2018
LIFE_SPAN = {"male": (79, 20), "other": (83, 30)}  # base age, years of birth per extra year of age
MODEST_FROM = 0.56
COMFORTABLE_FROM = 1.0


def whole_div(left: Column, right: int) -> Column:
    """Integer division that cuts towards zero, also below zero."""
    quotient = left / F.lit(right)
    return F.when(quotient < 0, F.ceil(quotient)).otherwise(F.floor(quotient)).cast("int")


def death_age(gender: Column, birth_year: Column) -> Column:
    years = F.lit(BASE_YEAR) - birth_year
    male, other = LIFE_SPAN["male"], LIFE_SPAN["other"]
    return F.when(gender == "male", male[0] + whole_div(years, male[1])).otherwise(
        other[0] + whole_div(years, other[1])
    )


def yearly_rate(strategy: Column) -> Column:
    """Growth factor of a strategy in any letter case; an unknown one fails the query."""
    rate = None
    for name, value in YEARLY_RATE.items():
        hit = F.lower(strategy) == name
        rate = F.when(hit, F.lit(value)) if rate is None else rate.when(hit, F.lit(value))
    message = F.concat(F.lit("unknown strategy: "), F.coalesce(strategy, F.lit("null")))
    return rate.otherwise(F.raise_error(message).cast("double"))


def balance(contribution: Column, years: Column, rate: Column) -> Column:
    """Savings after ``years`` yearly steps of growth and deposit, from nothing; none for no years."""
    steps = F.when(years > 0, F.sequence(F.lit(1), years)).otherwise(F.array().cast("array<int>"))
    deposit = contribution / F.lit(100.0)
    return F.when(years.isNotNull(), F.aggregate(steps, F.lit(0.0), lambda saved, _: saved * rate + deposit))


def band(level: Column) -> Column:
    """Name of a spending level; null stays null."""
    return (
        F.when(level < MODEST_FROM, "poverty")
        .when(level < COMFORTABLE_FROM, "modest")
        .when(level.isNotNull(), "comfortable")
    )
