"""Revision histories.

Two shapes: *articles*, ``aid, title, revisions array<struct<rid, contributor, ts>>``, as parsed from
page markup with one row per page record; and *revisions*, ``aid, title, rid, contributor, ts``, one
row each, which is what every aggregate works on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import markup
from millrace.functions.maps import count_map
from millrace.operators.grouping import grouped, in_maps, with_totals

REVISION = ("aid", "title", "rid", "contributor", "ts")


def parse_pages(pages: DataFrame, page: str = "value", strict: bool = True) -> DataFrame:
    """Page markup to articles. Pages without a revision are dropped.

    A missing id is -1 and a missing text is empty. ``strict`` fails on a bad timestamp.
    """
    xml = F.col(page)
    parsed = pages.select(
        markup.element_id(xml).alias("aid"),
        markup.element_text(xml, "title").alias("title"),
        F.transform(markup.elements(xml, "revision"), lambda r: markup.revision(r, strict)).alias("revisions"),
    )
    return parsed.filter(F.size("revisions") >= 1)


def flatten(articles: DataFrame) -> DataFrame:
    """Articles to revisions; ``seq`` is the place within the article."""
    rows = articles.select("aid", "title", F.posexplode("revisions").alias("seq", "r"))
    return rows.select("aid", "title", "seq", "r.rid", "r.contributor", "r.ts")


def parse_revisions(pages: DataFrame, page: str = "value", strict: bool = True) -> DataFrame:
    """Page markup to revisions, as ``flatten(parse_pages(...))`` gives them, without the nested form:
    revisions become rows first, so that their columns are compiled."""
    xml = F.col(page)
    rows = pages.select(
        markup.element_id(xml).alias("aid"),
        markup.element_text(xml, "title").alias("title"),
        F.posexplode(markup.elements(xml, "revision")).alias("seq", "markup"),
    )
    parsed = rows.select("aid", "title", "seq", markup.revision(F.col("markup"), strict).alias("r"))
    return parsed.select("aid", "title", "seq", "r.rid", "r.contributor", "r.ts")


# Columns of an articles table.


def revision_count() -> Column:
    return F.size("revisions")


def contributors() -> Column:
    """Contributors in order, repeats kept."""
    return F.col("revisions.contributor")


def contributor_revisions() -> Column:
    """Array of ``struct<contributor, rid>``."""
    return F.transform("revisions", lambda r: F.struct(r["contributor"], r["rid"]))


def revision_years() -> Column:
    return F.transform("revisions", lambda r: F.year(r["ts"]))


def revisions_per_year_map() -> Column:
    """A map from year to number of revisions, of one article."""
    return count_map(revision_years())


def revision_line(r: Column) -> Column:
    return F.concat(F.lit("\t"), r["rid"].cast("string"), F.lit(","), r["contributor"], F.lit(","), markup.instant_text(r["ts"]))


def render() -> Column:
    """``aid,title`` and then one indented line ``rid,contributor,timestamp`` per revision."""
    line = F.transform("revisions", lambda r: F.concat(revision_line(r), F.lit("\n")))
    return F.concat(F.col("aid").cast("string"), F.lit(","), F.col("title"), F.lit("\n"), F.array_join(line, ""))


# Aggregates of a revisions table.


def totals(revisions: DataFrame) -> DataFrame:
    """``n_articles, n_revisions`` in one job."""
    per_article = revisions.groupBy("aid").agg(F.count(F.lit(1)).alias("n"))
    return per_article.agg(
        F.count(F.lit(1)).alias("n_articles"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_revisions")
    )


def unique_contributors(revisions: DataFrame) -> DataFrame:
    """Number of contributors; the empty name is one of them."""
    return revisions.select("contributor").distinct().agg(F.count(F.lit(1)).alias("n"))


def creation_years(revisions: DataFrame, order: str = "seq", distinct: bool = True) -> DataFrame:
    """Years of the first-listed revision of each article, each year once unless ``distinct`` is off."""
    first = revisions.groupBy("aid").agg(F.year(F.min_by("ts", order)).alias("year")).select("year")
    return first.distinct() if distinct else first


def busy_articles(revisions: DataFrame, min_revisions: int, min_contributors: int, distinct: bool = True) -> DataFrame:
    """Number of articles with that many revisions and that many different contributors.

    With ``distinct`` off a contributor counts once per revision.
    """
    # Two levels, so that an article with a huge history is combined before it meets in one task.
    pairs = revisions.groupBy("aid", "contributor").agg(F.count(F.lit(1)).alias("n"))
    sizes = pairs.groupBy("aid").agg(F.sum("n").alias("revisions"), F.count(F.lit(1)).alias("people"))
    people = F.col("people") if distinct else F.col("revisions")
    hit = (F.col("revisions") >= min_revisions) & (people >= min_contributors)
    return sizes.agg(F.count_if(hit).alias("n"))


def articles_by_revisions(revisions: DataFrame, limit: int | None = None) -> DataFrame:
    """``aid, title, n`` by number of revisions, descending, ties by title and id."""
    counts = revisions.groupBy("aid", "title").agg(F.count(F.lit(1)).alias("n"))
    ordered = counts.orderBy(F.desc("n"), "title", "aid")
    return ordered if limit is None else ordered.limit(limit)


def contributor_counts(revisions: DataFrame) -> DataFrame:
    return revisions.groupBy("contributor").agg(F.count(F.lit(1)).alias("n"))


def contributors_by_revisions(revisions: DataFrame, limit: int | None = None) -> DataFrame:
    """``contributor, n`` by number of revisions, descending, ties by name."""
    ordered = contributor_counts(revisions).orderBy(F.desc("n"), "contributor")
    return ordered if limit is None else ordered.limit(limit)


def in_year(revisions: DataFrame, year: int) -> DataFrame:
    """Revisions of one year. Written as a range, so that it reaches the scan as a pushed filter."""
    start = F.lit(f"{year:04d}-01-01").cast("timestamp_ntz")
    end = F.lit(f"{year + 1:04d}-01-01").cast("timestamp_ntz")
    return revisions.filter((F.col("ts") >= start) & (F.col("ts") < end))


def per_year(revisions: DataFrame, *summaries: Column) -> DataFrame:
    """``year`` and one column per aggregate expression passed in."""
    return revisions.groupBy(F.year("ts").alias("year")).agg(*summaries)


def contributors_per_year(revisions: DataFrame) -> DataFrame:
    """``year, n_contributors``, combined before the few years meet in a few tasks."""
    pairs = revisions.select(F.year("ts").alias("year"), "contributor").distinct()
    return pairs.groupBy("year").agg(F.count(F.lit(1)).alias("n_contributors"))


def revisions_by_year(revisions: DataFrame, fields: Sequence[str] = ("aid", "rid", "contributor", "ts")) -> DataFrame:
    """``year, fields..., copies, n_entries, n_rows``: the revisions of each year, beside the whole year's numbers."""
    return grouped(revisions.withColumn("year", F.year("ts")), ["year"], fields)


def contributor_counts_per_year(revisions: DataFrame) -> DataFrame:
    """``year, contributor, n``: the map of each year in long form."""
    return revisions.groupBy(F.year("ts").alias("year"), "contributor").agg(F.count(F.lit(1)).alias("n"))


def contributor_maps_per_year(revisions: DataFrame) -> DataFrame:
    """``year, contributor, n, n_contributors``: the entries of each year's map, beside its size."""
    return with_totals(contributor_counts_per_year(revisions), ["year"], n_contributors=F.count(F.lit(1)))


def contributor_year_maps(revisions: DataFrame, size: int = 1000) -> DataFrame:
    """``year, map_no, n_maps, entries``: each year's contributors with their revisions, as maps of about ``size`` entries."""
    return in_maps(contributor_counts_per_year(revisions), ["year"], "contributor", "n", size)


def revision_columns(revisions: DataFrame) -> DataFrame:
    """``aid, title, rid, contributor, pair, year, n_revisions``: per revision what the columns of an articles table
    list per article, beside the article's number of revisions. A history of any length is in no task as a whole."""
    pair = F.concat_ws(":", "contributor", F.col("rid").cast("string"))
    rows = revisions.select("aid", "title", "rid", "contributor", pair.alias("pair"), F.year("ts").alias("year"))
    return with_totals(rows, ["aid", "title"], n_revisions=F.count(F.lit(1)))


def by_contributor(revisions: DataFrame, n: int, split: int = 8) -> DataFrame:
    """Hash-partition by contributor into ``n``, each contributor over at most ``split`` partitions.

    ``split=1`` keeps a contributor in one partition, which suits a later grouping by contributor
    but puts a contributor who made a third of all revisions into one task.
    """
    if split == 1:
        return revisions.repartition(n, "contributor")
    salt = F.pmod(F.xxhash64(*revisions.columns), F.lit(split))
    return revisions.withColumn("_salt", salt).repartition(n, "contributor", "_salt").drop("_salt")


# Two histories side by side.


def _both(first: DataFrame, second: DataFrame, fields: Sequence[str]) -> DataFrame:
    picked = [df.select(*fields, F.lit(side).alias("side")) for side, df in ((1, first), (2, second))]
    return picked[0].unionByName(picked[1])


def _cogroup(both: DataFrame, fields: Sequence[str]) -> DataFrame:
    entries = both.groupBy("contributor", "side", *fields).agg(F.count(F.lit(1)).alias("copies"))
    sizes = {f"n_revs{side}": F.sum(F.when(F.col("side") == side, F.col("copies")).otherwise(0)) for side in (1, 2)}
    return with_totals(entries, ["contributor"], **sizes)


def cogroup_by_contributor(first: DataFrame, second: DataFrame, fields: Sequence[str] = ("aid", "rid", "ts")) -> DataFrame:
    """``contributor, side, fields..., copies, n_revs1, n_revs2``: what each contributor of either history did.

    One row per different revision and side (1 or 2). ``n_revs1`` and ``n_revs2`` are all the contributor's
    revisions in either history, 0 where there are none. One grouping of the union, not a join of two.
    """
    return _cogroup(_both(first, second, ["contributor", *fields]), fields)


def _kept_in_both(both: DataFrame, keep: Column) -> DataFrame:
    sides = both.groupBy("contributor", "side").agg(keep.alias("_keep")).filter("_keep")
    return sides.groupBy("contributor").agg(F.count(F.lit(1)).alias("_n")).filter("_n = 2").select("contributor")


def _common(first: DataFrame, second: DataFrame) -> DataFrame:
    return _both(first, second, [c for c in first.columns if c in second.columns])


def shared_contributors(first: DataFrame, second: DataFrame, keep: Column | None = None) -> DataFrame:
    """Contributors for whom ``keep`` holds in both histories.

    ``keep`` is a boolean aggregate over the revisions of one side, such as
    ``F.bool_or(F.year("ts") == 2013)``; by default, having any revision. No list is built and each
    side is combined on the map side, so a contributor of any size is one row per task.
    """
    return _kept_in_both(_common(first, second), F.lit(True) if keep is None else keep)


def cogroup_where(
    first: DataFrame, second: DataFrame, keep: Column, fields: Sequence[str] = ("aid", "rid", "ts")
) -> DataFrame:
    """The cogroup of only those contributors for whom ``keep`` holds in both histories."""
    both = _common(first, second)
    return _cogroup(both.join(_kept_in_both(both, keep), "contributor", "left_semi"), fields)
