import pytest
from pyspark.sql import functions as F

from millrace.functions import savings
from millrace.operators import cohort, points
from millrace.sources import files

PERSON = "name string, gender string, birth_year int"
PLAN = "name string, start_age int, retirement_age int, contribution int, strategy string"


def projected(spark, gender="male", birth=1956, start=25, retire=65, share=10, strategy="growth"):
    people = spark.createDataFrame([("x", gender, birth)], PERSON)
    plans = spark.createDataFrame([("x", start, retire, share, strategy)], PLAN)
    return cohort.project(people, plans)


@pytest.mark.parametrize("gender,birth,age", [("male", 1956, 82), ("male", 2018, 79), ("male", 2037, 79), ("male", 2038, 78), ("female", 1928, 86), ("", 1989, 83), (None, 1988, 84)])
def test_death_age(spark, gender, birth, age):
    frame = spark.createDataFrame([(gender, birth)], "g string, b int")
    assert frame.select(savings.death_age(F.col("g"), F.col("b"))).first()[0] == age


@pytest.mark.parametrize("strategy,rate", [("growth", 1.045), ("Balanced", 1.035), ("CONSERVATIVE", 1.025), ("cash", 1.01)])
def test_projection(spark, strategy, rate):
    row = projected(spark, strategy=strategy).first()
    balance = 0.0
    for _ in range(40):
        balance = balance * rate + 10 / 100.0
    assert row.balance == balance and row.working_years == 40
    assert row.death_age == 82 and row.retirement_years == 17
    assert row.lifestyle == balance / 17
    report = cohort.report(projected(spark, strategy=strategy)).first()
    assert report.payout == float(f"{balance:.1f}") and report.percent == float(f"{balance / 17 * 100:.1f}")


def test_no_years(spark):
    assert projected(spark, start=65, retire=65).first().balance == 0.0
    assert projected(spark, start=66, retire=65).first().balance == 0.0
    row = projected(spark, retire=82).first()
    assert row.retirement_years == 0 and row.lifestyle is None and row.band is None


def test_unknown_strategy_fails(spark):
    with pytest.raises(Exception, match="unknown strategy: gold"):
        projected(spark, strategy="gold").collect()


def test_bands(spark):
    frame = spark.createDataFrame([(0.5599,), (0.56,), (0.9999,), (1.0,)], "v double")
    assert [r[0] for r in frame.select(savings.band(F.col("v"))).collect()] == ["poverty", "modest", "modest", "comfortable"]


def test_first_match_and_missing_person(spark, rows):
    people = spark.createDataFrame([(2, "a", "male", 1950), (1, "a", "female", 1960), (3, "b", "male", 1970)], f"place int, {PERSON}")
    names = spark.createDataFrame([("a",), ("b",), ("A",), ("a",)], "name string")
    found = cohort.find_people(names, people, ["place"])
    assert rows(found) == [("A", None, None), ("a", "female", 1960), ("a", "female", 1960), ("b", "male", 1970)]
    with pytest.raises(Exception, match="no such person: A"):
        cohort.find_people(names, people, ["place"], missing="raise").collect()


def test_people_file_keeps_its_order(spark, tmp_path):
    path = tmp_path / "names"
    path.write_text("".join(f"P{i % 50},{'male' if i % 2 else 'female'},{1928 + i % 90}\n" for i in range(500)))
    people = files.read_people(spark, str(path))
    assert [r.birth_year for r in people.orderBy("place").collect()] == [1928 + i % 90 for i in range(500)]
    first = cohort.find_people(people.select("name").distinct(), people, ["place"])
    assert {r.name: r.birth_year for r in first.collect()} == {f"P{i}": 1928 + i for i in range(50)}


def test_malformed_person_fails(spark, tmp_path):
    path = tmp_path / "names"
    path.write_text("A,male,1950\nB,male,soon\n")
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST"):
        files.read_people(spark, str(path)).collect()


def test_summary(spark):
    row = cohort.summary(projected(spark)).first()
    assert row.n == 1 and row.band in {"poverty", "modest", "comfortable"}


def test_circle(spark):
    frame = spark.createDataFrame([(1, 0.0, 0.0), (1, 0.6, 0.8), (1, 1.0, 0.1), (2, 0.9, 0.9)], "grp int, x double, y double")
    hits = points.circle_hits(frame)
    assert sorted(tuple(r) for r in hits.collect()) == [(1, 2, 3), (2, 0, 1)]
    assert tuple(points.circle_ratio(hits).first()) == (2, 4, 2.0)
    assert points.circle_ratio(points.circle_hits(frame.limit(0))).first().ratio is None


def test_circle_of_whole_numbers(spark):
    """The integer form: coordinates below 4096 and a squared radius of 2**24 - 1."""
    frame = spark.createDataFrame([(1, 0, 0), (1, 4095, 90), (1, 4095, 91)], "grp int, x int, y int")
    inside = sum(x * x + y * y <= 0xFFFFFF for x, y in ((0, 0), (4095, 90), (4095, 91)))
    assert points.circle_hits(frame, radius_squared=0xFFFFFF).first().hits == inside
