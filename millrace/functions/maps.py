"""Maps made of arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def count_map(values: Column) -> Column:
    """How often each value occurs in an array, as a map of values to counts; nulls have no entry.

    Sorted first, so each value is a run, whose length is the gap between the places where runs begin.
    """
    ordered = F.array_sort(F.filter(values, lambda v: v.isNotNull()))

    def runs(box: Column) -> Column:
        array = box["values"]
        starts = F.filter(
            F.sequence(F.lit(1), F.size(array)), lambda i: (i == 1) | (F.get(array, i - 1) != F.get(array, F.greatest(i - 2, F.lit(0))))
        )
        return F.struct(array.alias("values"), starts.alias("starts"))

    def as_map(box: Column) -> Column:
        array, starts = box["values"], box["starts"]
        ends = F.concat(F.slice(starts, 2, F.size(starts)), F.array(F.size(array) + 1))
        counts = F.zip_with(starts, ends, lambda a, b: (b - a).cast("bigint"))
        return F.map_from_arrays(F.transform(starts, lambda i: F.get(array, i - 1)), counts)

    # Inside an array of one, so that each step is computed once.
    box = F.transform(F.transform(F.array(F.struct(ordered.alias("values"))), runs), as_map)[0]
    empty = F.size(ordered) == 0
    return F.when(~empty, box).otherwise(F.map_from_arrays(F.filter(values, lambda v: F.lit(False)), F.array().cast("array<bigint>")))
