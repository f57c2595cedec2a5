import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import films
from millrace.sources import files

SCHEMA = ", ".join(f"{c} string" for c in files.FILM_COLUMNS.values())


def film(title="A", year="2004", location="L", company="C", distributor="D", director="Ann Lee", writer="W", *actors):
    return (title, year, location, company, distributor, director, writer, *(list(actors) + [None] * 3)[:3])


@pytest.fixture(scope="module")
def frame(spark):
    return lambda *rows: spark.createDataFrame(list(rows), SCHEMA)


def test_clean(frame, rows):
    kept = films.clean(
        frame(
            film(" Kept "),
            film("n1", director=None),
            film("n2", director="Ann Lee and Bo Ray"),
            film("n3", director="Ann & Bo"),
            film("n4", location=None),
            film("n5", year="n/a"),
            film("n6", year=None),
            film("Padded year", year=" 2004 "),
            film("Band", director="Sandy Anders"),
        )
    )
    assert rows(kept, "title", "year") == [("Band", 2004), ("Kept", 2004), ("Padded year", 2004)]


def test_years(frame):
    cleaned = films.clean(frame(film("a", "1999"), film("b", "2000"), film("c", "2009"), film("c", "2009"), film("d", "2010"), film("e", "99")))
    assert [tuple(r) for r in films.released_between(cleaned, 2000, 2009).collect()] == [("c", 2009), ("b", 2000)]
    assert tuple(films.year_range(cleaned).first()) == (99, 2010)


def test_null_is_a_company(frame):
    data = frame(film("a", company="X"), film("b", company="X"), film("b", company="X"), film("c", company=None))
    assert tuple(films.totals(data).first()) == (3, 2)
    assert films.count_values(data, "company").first()[0] == 2
    assert films.mean_films_per_company(data).first()[0] == 1.5


def test_counts_per_group(frame):
    data = films.clean(frame(film("a", "2001"), film("a", "2001", "M"), film("b", "2002", director="Bo"), film("c", "2001")))
    assert [tuple(r) for r in films.per_director(data).collect()] == [("Ann Lee", 2), ("Bo", 1)]
    assert [tuple(r) for r in films.per_company_year(data).collect()] == [("C", 2001, 2), ("C", 2002, 1)]
    assert [tuple(r) for r in films.locations_per_title(data, 2).collect()] == [("a", 2)]


def test_crew_match_on_any_row(frame, rows):
    data = frame(film("a"), film("a", "2004", "L", "C", "D", "Ann", "W", "Cy Young"), film("b"))
    assert rows(films.with_crew_member(data, "Cy Young")) == [("a",)]
    crews = data.select(films.crew()).collect()
    assert crews[1][0] == "Cy Young, Ann, D, W"


def test_title_locations(frame, spark):
    data = frame(film("a", location="x"), film("a", location="x"), film("a", location="y"))
    got = {tuple(r) for r in films.title_locations(data).select("title", "location", "copies", "n_locations", "n_rows").collect()}
    assert got == {("a", "x", 2, 2, 3), ("a", "y", 1, 2, 3)}
    many = spark.range(15_000).selectExpr("'a' AS title", "cast(id AS string) AS location")
    rows = films.title_locations(many)
    assert rows.count() == 15_000 and rows.select("n_locations", "n_rows").distinct().collect() == [(15_000, 15_000)]


def test_pivot(frame, rows):
    data = frame(film("a", location="x"), film("a", location="x"), film("a", location="y"), film("b", location="x"), film("c", location="z"))
    assert rows(films.rows_at(data, ["x", "y"])) == [("a", 2, 1), ("b", 1, None), ("c", None, None)]
    assert rows(films.shot_at_all(data, ["x", "y"])) == [("a", 2, 1)]


def test_location_actors(frame):
    data = frame(film("a", "1", "x", "C", "D", "Q", "W", "p", "q"), film("b", "1", "x", "C", "D", "Q", "W", "q", "p", "r"))
    found = films.location_actors(data).collect()
    assert sorted((r.actor, r.copies, r.n_entries, r.n_rows) for r in found) == [("p", 2, 3, 5), ("q", 2, 3, 5), ("r", 1, 3, 5)]
    assert sorted(r.actor for r in films.location_actors(data, distinct=False).collect()) == ["p", "p", "q", "q", "r"]


def brute_contains(records):
    actors = [(slot, name) for slot in (7, 8, 9) for name in {r[slot] for r in records} if name is not None]
    known = {r[5] for r in records if r[5] is not None}
    return sorted((name, director) for _, name in actors for director in known if director in name)


@pytest.mark.parametrize("seed", range(4))
def test_containment_matches_all_pairs(frame, seed):
    draw = random.Random(seed)
    names = ["An", "Ann", "Ann Lee", "Anna", "Lee", "Bo", "nn", "é", "Zoé B", "a", "aaa", "aa", "Director 1", "Director 12"]
    records = [
        film("t", "1", "x", "C", "D", draw.choice([*names, None]), "W", *[draw.choice([*names, None]) for _ in range(3)])
        for _ in range(25)
    ]
    got = films.actors_containing_directors(frame(*records))
    assert sorted(tuple(r) for r in got.collect()) == brute_contains(records)
    equal = {r[0] for r in films.acting_directors(frame(*records)).collect()}
    assert equal == {r[5] for r in records} & {r[slot] for r in records for slot in (7, 8, 9)} - {None}


def test_containment_has_no_nested_loop(frame):
    plan = films.actors_containing_directors(frame(film()))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_no_actors_or_directors(frame):
    assert films.actors_containing_directors(frame(film())).count() == 0
    assert films.actors_containing_directors(frame(film("a", "1", "x", "C", "D", None, "W", "p"))).count() == 0


def test_union_repeats_a_name_per_column(frame, rows):
    data = frame(film("a", "1", "x", "C", "D", "Q", "W", "p", "p", "r"), film("b", "1", "x", "C", "D", "Q", "W", "p", None, "p"))
    assert rows(films.actor_union(data)) == [("p",), ("p",), ("p",), ("r",)]


def test_directors_upper(frame, rows):
    data = frame(film(director="Ann Lee"), film(director="Madonna"), film(director="Ann Lee"))
    assert rows(films.directors_upper(data)) == [("Ann Lee", "Ann LEE"), ("Madonna", "Madonna")]


@pytest.mark.parametrize("infer", [False, True])
def test_csv(spark, rows, tmp_path, infer):
    path = tmp_path / "films.csv"
    path.write_text(
        "Title,Release Year,Locations,Fun Facts,Production Company,Distributor,Director,Writer,Actor 1,Actor 2,Actor 3\n"
        '" A ",2001,"Pier, 39",,C,D,Ann Lee,W,p,,\n'
        "B,n/a,X,,C,D,Bo,W,p,,\n"
    )
    table = files.read_films(spark, str(path), infer=infer)
    assert table.columns == list(files.FILM_COLUMNS.values())
    assert rows(films.clean(table), "title", "location", "year", "actor2") == [("A", "Pier, 39", 2001, None)]


def test_preview(spark, capsys):
    from millrace.sources import sinks

    assert sinks.preview(spark.range(30).select(F.col("id").alias("n")), 10, schema=True).count() == 10
    assert "n: long" in capsys.readouterr().out
