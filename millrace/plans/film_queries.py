"""Queries over film locations: line items as shooting days."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import films
from millrace.plans.registry import query
from millrace.plans.views import oracle, view
from millrace.shared import new_folder
from millrace.sources import files, sinks

CLEAN = """
SELECT * REPLACE (trim(title, ' ') AS title), try_cast(release_year AS int) AS year FROM films
WHERE director IS NOT NULL AND NOT contains(director, ' and ') AND NOT contains(director, '&')
  AND location IS NOT NULL AND try_cast(release_year AS int) IS NOT NULL
"""
ACTORS_SQL = " UNION ALL ".join(f"SELECT DISTINCT actor{i} AS actor FROM clean WHERE actor{i} IS NOT NULL" for i in (1, 2, 3))
PLACES = ("NATION_3", "NATION_7")


def _clean(spark, folder):
    return films.clean(view(spark, folder, "films"))


def _sql(select, **extra):
    return oracle(select, "films", clean=CLEAN, **extra)


@query(
    "films_clean",
    _sql("SELECT title, release_year, location, company, director, count(*) AS n FROM clean GROUP BY ALL"),
)
def films_clean(spark, folder):
    keys = ["title", "release_year", "location", "company", "director"]
    return _clean(spark, folder).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


@query("film_records", oracle("SELECT count(*) AS n FROM films", "films"))
def film_records(spark, folder):
    return films.record_count(view(spark, folder, "films"))


COLUMNS = ", ".join(files.FILM_COLUMNS.values())


@query(
    "film_preview",
    oracle(f"SELECT {COLUMNS} FROM films ORDER BY ({COLUMNS.replace(', ', ' IS NOT NULL, ')} IS NOT NULL), {COLUMNS} LIMIT 10", "films"),
)
def film_preview(spark, folder):
    table = view(spark, folder, "films")
    known = F.struct(*[F.col(c).isNotNull() for c in table.columns])
    return sinks.preview(table.orderBy(known, *table.columns))


@query("films_2000s", _sql("SELECT DISTINCT title, year FROM clean WHERE year BETWEEN 2000 AND 2009"))
def films_2000s(spark, folder):
    return films.released_between(_clean(spark, folder), 2000, 2009)


@query("films_by_writer", _sql("SELECT title, writer FROM clean WHERE contains(writer, 'Writer 4')"))
def films_by_writer(spark, folder):
    return films.written_by(_clean(spark, folder), "Writer 4")


@query("film_year_range", _sql("SELECT min(year) AS first_year, max(year) AS last_year FROM clean"))
def film_year_range(spark, folder):
    return films.year_range(_clean(spark, folder))


@query(
    "film_totals",
    _sql(
        "SELECT (SELECT count(*) FROM (SELECT DISTINCT title FROM clean)) AS n_films, "
        "(SELECT count(*) FROM (SELECT DISTINCT company FROM clean)) AS n_companies"
    ),
)
def film_totals(spark, folder):
    return films.totals(_clean(spark, folder))


@query("film_companies", _sql("SELECT count(*) AS n FROM (SELECT DISTINCT company FROM clean)"))
def film_companies(spark, folder):
    return films.count_values(_clean(spark, folder), "company")


@query(
    "avg_films_per_company",
    _sql("SELECT round(avg(n), 6) AS mean_films FROM (SELECT count(DISTINCT title) AS n FROM clean GROUP BY company)"),
)
def avg_films_per_company(spark, folder):
    mean = films.mean_films_per_company(_clean(spark, folder))
    return mean.select(F.round("mean_films", 6).alias("mean_films"))


@query(
    "films_3_locations",
    _sql("SELECT title, count(DISTINCT location) AS n_locations FROM clean GROUP BY title HAVING count(DISTINCT location) >= 3"),
)
def films_3_locations(spark, folder):
    return films.locations_per_title(_clean(spark, folder), at_least=3)


@query(
    "films_by_crew",
    _sql(
        "SELECT DISTINCT title FROM clean WHERE "
        "contains(concat_ws(', ', actor1, actor2, actor3, director, distributor, writer), 'Director 5')"
    ),
)
def films_by_crew(spark, folder):
    return films.with_crew_member(_clean(spark, folder), "Director 5")


@query(
    "film_crews",
    _sql(
        "SELECT concat_ws(', ', actor1, actor2, actor3, director, distributor, writer) AS crew, count(*) AS n "
        "FROM clean GROUP BY 1"
    ),
)
def film_crews(spark, folder):
    return _clean(spark, folder).groupBy(films.crew().alias("crew")).agg(F.count(F.lit(1)).alias("n"))


@query("films_per_director", _sql("SELECT director, count(DISTINCT title) AS n_films FROM clean GROUP BY director"))
def films_per_director(spark, folder):
    return films.per_director(_clean(spark, folder))


@query(
    "films_per_company_year",
    _sql("SELECT company, year, count(DISTINCT title) AS n_films FROM clean GROUP BY company, year"),
)
def films_per_company_year(spark, folder):
    return films.per_company_year(_clean(spark, folder))


@query(
    "film_location_list",
    _sql(
        "SELECT title, location, count(*) AS copies, any_value(n_locations) AS n_locations, any_value(n_rows) AS n_rows "
        "FROM clean JOIN (SELECT title, count(DISTINCT location) AS n_locations, count(*) AS n_rows FROM clean "
        "GROUP BY title) USING (title) WHERE location IS NOT NULL GROUP BY title, location"
    ),
)
def film_location_list(spark, folder):
    return films.title_locations(_clean(spark, folder))


@query(
    "film_pivot",
    _sql(
        f"SELECT title, count(*) FILTER (WHERE location = '{PLACES[0]}') AS \"{PLACES[0]}\", "
        f"count(*) FILTER (WHERE location = '{PLACES[1]}') AS \"{PLACES[1]}\" FROM clean GROUP BY title "
        f'HAVING "{PLACES[0]}" >= 1 AND "{PLACES[1]}" >= 1'
    ),
)
def film_pivot(spark, folder):
    return films.shot_at_all(_clean(spark, folder), PLACES)


@query(
    "film_pivot_all",
    _sql(
        f"SELECT title, nullif(count(*) FILTER (WHERE location = '{PLACES[0]}'), 0) AS \"{PLACES[0]}\", "
        f"nullif(count(*) FILTER (WHERE location = '{PLACES[1]}'), 0) AS \"{PLACES[1]}\" FROM clean GROUP BY title"
    ),
)
def film_pivot_all(spark, folder):
    return films.rows_at(_clean(spark, folder), PLACES)


@query(
    "director_upper",
    _sql(
        "SELECT DISTINCT director, CASE WHEN instr(director, ' ') > 0 THEN director[:instr(director, ' ')] || "
        "upper(director[instr(director, ' ') + 1:]) ELSE director END AS director_upper FROM clean"
    ),
)
def director_upper(spark, folder):
    return films.directors_upper(_clean(spark, folder))


@query(
    "location_actors",
    _sql(
        "SELECT location, actor, count(*) AS copies, count(*) OVER (PARTITION BY location) AS n_entries, "
        "cast(sum(count(*)) OVER (PARTITION BY location) AS bigint) AS n_rows FROM ("
        "SELECT location, unnest([actor1, actor2, actor3]) AS actor FROM clean) WHERE actor IS NOT NULL GROUP BY location, actor"
    ),
)
def location_actors(spark, folder):
    return films.location_actors(_clean(spark, folder))


@query("actor_union", _sql(ACTORS_SQL))
def actor_union(spark, folder):
    return films.actor_union(_clean(spark, folder))


@query(
    "actor_director_contains",
    _sql(
        "SELECT actor, director FROM actors JOIN (SELECT DISTINCT director FROM clean) ON contains(actor, director)",
        actors=ACTORS_SQL,
    ),
)
def actor_director_contains(spark, folder):
    return films.actors_containing_directors(_clean(spark, folder))


@query(
    "actor_director_equal",
    _sql("SELECT DISTINCT actor AS name FROM actors WHERE actor IN (SELECT director FROM clean)", actors=ACTORS_SQL),
)
def actor_director_equal(spark, folder):
    return films.acting_directors(_clean(spark, folder))


@query("film_csv_scan", _sql("SELECT director, year, count(*) AS n FROM clean GROUP BY director, year"))
def film_csv_scan(spark, folder):
    """Films written as CSV with a header and read back with inferred types."""
    path = new_folder(spark)
    table = view(spark, folder, "films")
    named = table.select(*[F.col(new).alias(old) for old, new in files.FILM_COLUMNS.items()])
    named.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    cleaned = films.clean(files.read_films(spark, path, infer=True))
    return cleaned.groupBy("director", "year").agg(F.count(F.lit(1)).alias("n"))
