"""Film shooting locations: one row per film and location.

Columns: ``title, release_year, location, company, distributor, director, writer, actor1, actor2,
actor3``, all strings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import upper_after_first_space
from millrace.operators.grouping import grouped

ACTORS = ("actor1", "actor2", "actor3")


def clean(films: DataFrame) -> DataFrame:
    """Films with one known director, a location and a numeric year; titles trimmed.

    Adds ``year``, the release year as int, so that no later step compares text with numbers.
    """
    director = F.col("director")
    kept = films.filter(
        director.isNotNull()
        & ~director.contains(" and ")
        & ~director.contains("&")
        & F.col("location").isNotNull()
        & F.col("release_year").try_cast("int").isNotNull()
    )
    return kept.withColumns({"title": F.trim("title"), "year": F.col("release_year").try_cast("int")})


def released_between(films: DataFrame, first: int, last: int) -> DataFrame:
    """Distinct ``title, year`` in a range of years (inclusive), latest first."""
    rows = films.filter(F.col("year").between(first, last)).select("title", "year").distinct()
    return rows.orderBy(F.desc("year"), "title")


def written_by(films: DataFrame, name: str) -> DataFrame:
    return films.filter(F.col("writer").contains(name)).select("title", "writer")


def year_range(films: DataFrame) -> DataFrame:
    return films.agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"))


def record_count(films: DataFrame) -> DataFrame:
    return films.agg(F.count(F.lit(1)).alias("n"))


def count_values(df: DataFrame, column: str) -> DataFrame:
    """Number of different values of a column; null is one of them."""
    return df.select(column).distinct().agg(F.count(F.lit(1)).alias("n"))


def totals(films: DataFrame) -> DataFrame:
    """``n_films, n_companies``, with null counted as a value.

    Both come from the distinct pairs, a fraction of the rows.
    """
    pairs = films.select("title", "company").distinct()

    def values(column: str) -> Column:
        return F.count_distinct(column) + F.coalesce(F.max(F.col(column).isNull().cast("int")), F.lit(0))

    return pairs.agg(values("title").alias("n_films"), values("company").alias("n_companies"))


def _films_per(films: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys..., n_films``, distinct titles, combined before the groups of a hot key meet."""
    pairs = films.select(*keys, "title").distinct()
    return pairs.groupBy(*keys).agg(F.count("title").alias("n_films"))


def mean_films_per_company(films: DataFrame) -> DataFrame:
    """Mean number of films of a company; films without a company are one company."""
    return _films_per(films, ["company"]).agg(F.avg("n_films").alias("mean_films"))


def per_director(films: DataFrame) -> DataFrame:
    """``director, n_films``, most films first."""
    return _films_per(films, ["director"]).orderBy(F.desc("n_films"), "director")


def per_company_year(films: DataFrame) -> DataFrame:
    """``company, year, n_films``, most films first."""
    return _films_per(films, ["company", "year"]).orderBy(F.desc("n_films"), "company", "year")


def locations_per_title(films: DataFrame, at_least: int = 1) -> DataFrame:
    """``title, n_locations``, for titles with that many different locations."""
    pairs = films.select("title", "location").distinct()
    counts = pairs.groupBy("title").agg(F.count("location").alias("n_locations"))
    return counts.filter(F.col("n_locations") >= at_least)


def crew(names: Sequence[str] = (*ACTORS, "director", "distributor", "writer")) -> Column:
    """All people of a film in one string, unknown ones left out."""
    return F.concat_ws(", ", *names)


def with_crew_member(films: DataFrame, name: str) -> DataFrame:
    """Titles of films a person worked on. The filter comes before ``distinct``, so that a match on
    any row of a title counts."""
    return films.filter(crew().contains(name)).select("title").distinct()


def title_locations(films: DataFrame) -> DataFrame:
    """``title, location, copies, n_locations, n_rows``: each location of a title with its number of rows,
    beside the size of the title's set and all its rows. Null locations are no member of the set.

    One row per location, however many a title has.
    """
    pairs = films.groupBy("title", "location").agg(F.count(F.lit(1)).alias("copies"))
    totals = pairs.groupBy("title").agg(F.count("location").alias("n_locations"), F.sum("copies").alias("n_rows"))
    return pairs.where("location IS NOT NULL").join(totals, "title")


def rows_at(films: DataFrame, locations: Sequence[str]) -> DataFrame:
    """``title`` and one column per location with its number of rows, null for none."""
    return films.groupBy("title").pivot("location", list(locations)).count()


def shot_at_all(films: DataFrame, locations: Sequence[str]) -> DataFrame:
    """The rows of ``rows_at`` with at least one row at every location.

    Rows elsewhere cannot change the answer and are dropped before the shuffle.
    """
    counts = rows_at(films.filter(F.col("location").isin(list(locations))), locations)
    for name in locations:
        counts = counts.filter(F.col(f"`{name}`") >= 1)
    return counts


def directors_upper(films: DataFrame) -> DataFrame:
    """Distinct ``director`` and ``director_upper``, with all after the first name upper-cased."""
    return films.select("director").distinct().withColumn("director_upper", upper_after_first_space(F.col("director")))


def _cast(films: DataFrame, *keep: str) -> DataFrame:
    """One row ``keep..., list_no, actor`` per named actor; ``list_no`` says which column it is from."""
    slots = F.array(*[F.struct(F.lit(i).alias("list_no"), F.col(c).alias("actor")) for i, c in enumerate(ACTORS)])
    rows = films.select(*keep, F.explode(slots).alias("slot"))
    return rows.select(*keep, "slot.list_no", "slot.actor").filter("actor IS NOT NULL")


def location_actors(films: DataFrame, distinct: bool = True) -> DataFrame:
    """``location, actor, copies, n_entries, n_rows``: who played at a location, each once.

    ``copies`` counts the actor's rows there; ``n_entries`` and ``n_rows`` are those of the whole location.
    With ``distinct`` off a name comes once for each of the three actor columns (``list_no``) it stands in.
    """
    return grouped(_cast(films, "location"), ["location"], ["actor"] if distinct else ["actor", "list_no"])


def actor_names(films: DataFrame) -> DataFrame:
    """``actor, copies``: each actor with the number of actor columns the name occurs in.

    This is the union of the three columns' distinct names, with its repeats as a number.
    """
    seen = F.bit_or(F.element_at(F.array(F.lit(1), F.lit(2), F.lit(4)), F.col("list_no") + 1))
    return _cast(films).groupBy("actor").agg(F.bit_count(seen).alias("copies"))


def actor_union(films: DataFrame) -> DataFrame:
    """``actor``, once per actor column the name occurs in."""
    return actor_names(films).select("actor", F.explode(F.sequence(F.lit(1), "copies"))).select("actor")


def directors(films: DataFrame) -> DataFrame:
    return films.select("director").filter("director IS NOT NULL").distinct()


def actors_containing_directors(films: DataFrame) -> DataFrame:
    """``actor, director`` for each actor name that contains a director name.

    An actor comes once per actor column it occurs in and per director. A containment condition
    would make a nested loop over all pairs; here each actor name is cut into the pieces that are
    as long as some director name, and a piece must *equal* a director. Rows grow with the number
    of names times their length, and only true matches leave the join.
    """
    known = directors(films)
    # One row with an array: the different lengths of director names, at most the longest name.
    lengths = known.agg(F.collect_set(F.length("director"))).scalar()

    def pieces(length: Column) -> Column:
        starts = F.sequence(F.lit(1), F.length("actor") - length + 1)
        return F.array_distinct(F.transform(starts, lambda start: F.substring(F.col("actor"), start, length)))

    sized = actor_names(films).select("actor", "copies", lengths.alias("lengths"))
    fitting = F.filter("lengths", lambda length: (length >= 1) & (length <= F.length("actor")))
    cut = sized.select("actor", "copies", F.explode(F.flatten(F.transform(fitting, pieces))).alias("director"))
    return (
        cut.join(known, "director")
        .select("actor", "director", F.explode(F.sequence(F.lit(1), "copies")))
        .select("actor", "director")
    )


def acting_directors(films: DataFrame) -> DataFrame:
    """Distinct names that occur both as actor and as director."""
    names = actor_names(films).select(F.col("actor").alias("name"))
    return names.join(directors(films).withColumnRenamed("director", "name"), "name", "left_semi")
