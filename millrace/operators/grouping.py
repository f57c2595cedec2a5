"""Groups in long form, so that no group, however hot, is ever held in one task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_totals(entries: DataFrame, keys: Sequence[str], **totals) -> DataFrame:
    """``entries`` with ``totals``, aggregates over all entries under their ``keys``; null is a key.

    The totals combine on the map side. Their join may be broadcast or have a hot key split.
    """
    sums = entries.groupBy(*[F.col(key).alias(f"_of_{key}") for key in keys]).agg(*[c.alias(name) for name, c in totals.items()])
    same = reduce(lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"_of_{key}")) for key in keys])
    return entries.join(sums, same).select(*entries.columns, *totals)


def grouped(df: DataFrame, keys: Sequence[str], items: Sequence[str]) -> DataFrame:
    """``keys..., items..., copies, n_entries, n_rows``: one row per different entry of each group.

    ``copies`` says how often the entry occurs, ``n_entries`` and ``n_rows`` how many different entries
    and how many rows the whole group has. Grouping by key and entry spreads hot keys and combines
    copies before the shuffle.
    """
    entries = df.groupBy(*keys, *items).agg(F.count(F.lit(1)).alias("copies"))
    return with_totals(entries, keys, n_entries=F.count(F.lit(1)), n_rows=F.sum("copies"))


# Groups as maps of about ``size`` entries: a small group is one map, a hot one is as many as it takes.


def _map_of(entry: Column, maps: Column) -> Column:
    """Which of its group's maps holds an entry."""
    return F.pmod(F.xxhash64(entry), maps)


def in_maps(entries: DataFrame, keys: Sequence[str], entry: str, value: str, size: int = 1000) -> DataFrame:
    """``keys..., map_no, n_maps, entries``: the groups of ``entries`` as maps from ``entry`` to ``value``.

    ``entries`` has each entry of a group once. Its map follows from its hash, so a hot group is dealt to
    many tasks and no map grows with it. A null entry can be no key of a map and is left out; an empty table gives no rows.
    """
    named = entries.filter(F.col(entry).isNotNull())
    sized = with_totals(named, keys, n_maps=F.ceil(F.count(F.lit(1)) / F.lit(size)))
    dealt = sized.withColumn("map_no", _map_of(F.col(entry), F.col("n_maps")))
    pairs = F.collect_list(F.struct(F.col(entry), F.col(value)))
    return dealt.groupBy(*keys, "map_no", "n_maps").agg(F.map_from_entries(pairs).alias("entries"))


def map_rows(maps: DataFrame, keys: Sequence[str], entry: str, value: str, entries: str = "entries") -> DataFrame:
    """The entries of maps as rows again: ``keys..., entry, value``."""
    pairs = maps.select(*keys, F.explode(F.map_entries(entries)).alias("_pair"))
    return pairs.select(*keys, F.col("_pair.key").alias(entry), F.col("_pair.value").alias(value))


def looked_up(wanted: DataFrame, maps: DataFrame, keys: Sequence[str], entry: str, value: str) -> DataFrame:
    """``wanted`` with the ``value`` that its group's maps have for its ``entry``, null where they have none.

    Each row goes to the one map that can hold its entry, by equality of keys and number. Null keys meet null keys.
    """
    sizes = maps.select(*[F.col(key).alias(f"_of_{key}") for key in keys], "n_maps").distinct()
    same = reduce(lambda a, b: a & b, [F.col(key).eqNullSafe(F.col(f"_of_{key}")) for key in keys])
    sought = wanted.join(sizes, same, "left").select(*wanted.columns, _map_of(F.col(entry), F.col("n_maps")).alias("_no"))
    held = maps.select(*[F.col(key).alias(f"_of_{key}") for key in keys], F.col("map_no").alias("_map_no"), F.col("entries").alias("_entries"))
    found = sought.join(held, same & (F.col("_no") == F.col("_map_no")), "left")
    return found.select(*wanted.columns, F.try_element_at("_entries", F.col(entry)).alias(value))
