import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions import markup
from millrace.operators import articles
from millrace.plans import article_queries
from millrace.sources import files, sinks

DUMP = """<dump>
<page><title>One</title><id>1</id>
<revision><id>10</id><timestamp>2013-05-01T10:00:00Z</timestamp><contributor><username>ann</username><id>77</id></contributor></revision>
<revision><id>11</id><timestamp>2014-01-01T00:00:00.500Z</timestamp><contributor><ip>1.2.3.4</ip></contributor></revision>
</page>
<page><title>Two
lines</title>
<revision minor="1"><timestamp>2013-12-31T23:59:59Z</timestamp><contributor><username>bob</username><ip>9.9.9.9</ip></contributor></revision>
</page>
<page><title>Empty</title><id>3</id></page>
</dump>
"""


@pytest.fixture(scope="module")
def dump(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("dump") / "pages.xml"
    path.write_text(DUMP)
    return str(path)


def test_page_records(spark, dump):
    records = [r[0] for r in files.read_page_records(spark, dump).collect()]
    assert records == [piece + "</page>" for piece in DUMP.split("</page>")]


def test_parse(spark, dump):
    got = {r.title: r for r in files.read_articles(spark, dump).collect()}
    assert set(got) == {"One", "Two\nlines"}
    one, two = got["One"], got["Two\nlines"]
    assert one.aid == 1
    assert [tuple(r) for r in one.revisions] == [
        (10, "ann", datetime(2013, 5, 1, 10)),
        (11, "1.2.3.4", datetime(2014, 1, 1, 0, 0, 0, 500000)),
    ]
    assert two.aid == -1
    assert [tuple(r) for r in two.revisions] == [(-1, "bob", datetime(2013, 12, 31, 23, 59, 59))]


def test_columns_of_articles(spark, dump):
    parsed = files.read_articles(spark, dump).filter("aid = 1")
    row = parsed.select(
        articles.revision_count(), articles.contributors(), articles.contributor_revisions(), articles.revision_years()
    ).first()
    assert row[0] == 2 and row[1] == ["ann", "1.2.3.4"]
    assert [tuple(p) for p in row[2]] == [("ann", 10), ("1.2.3.4", 11)]
    assert row[3] == [2013, 2014]


def test_years_do_not_depend_on_the_session_zone(spark, dump):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Pacific/Auckland")
        years = articles.flatten(files.read_articles(spark, dump)).select(F.year("ts")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert sorted(r[0] for r in years) == [2013, 2013, 2014]


def test_render(spark, dump, tmp_path):
    out = str(tmp_path / "text")
    sinks.write_articles(files.read_articles(spark, dump).filter("aid = 1"), out)
    text = "".join(p.read_text() for p in sorted((tmp_path / "text").glob("part-*")))
    assert text == "1,One\n\t10,ann,2013-05-01T10:00:00Z\n\t11,1.2.3.4,2014-01-01T00:00:00.500Z\n"


@pytest.mark.parametrize("stamp", ["", "yesterday", "2013-05-01T10:00:00"])
def test_bad_timestamp(spark, stamp):
    page = f"<page><title>t</title><revision><timestamp>{stamp}</timestamp></revision></page>"
    pages = spark.createDataFrame([(page,)], "value string")
    assert articles.parse_pages(pages, strict=False).first().revisions[0].ts is None
    with pytest.raises(Exception, match="ISO-8601"):
        articles.parse_pages(pages).collect()


@pytest.mark.parametrize("name", ["id", "revision", "title"])
def test_elements_match_the_pattern(spark, name):
    samples = [DUMP, "<idx>1</idx><id>2</id>", "<id></id><id>x</id>", "<id a='1'>y</id>", "", "<id>open"]
    frame = spark.createDataFrame([(i, s) for i, s in enumerate(samples)], "i int, s string").orderBy("i")
    got = frame.select(markup.elements(F.col("s"), name), markup.element_text(F.col("s"), name)).collect()
    for sample, (found, text) in zip(samples, got):
        assert found == re.findall(rf"(?s)(<{name}[^>]*?>.+?</{name}>)", sample)
        first = re.search(rf"(?s)<{name}[^>]*?>(.+?)</{name}>", sample)
        assert text == (first.group(1) if first else "")


HISTORY = [
    # aid, title, seq, rid, contributor, ts
    (1, "a", 0, 5, "ann", datetime(2013, 1, 1)),
    (1, "a", 1, 6, "ann", datetime(2014, 1, 1)),
    (1, "a", 2, 7, "bob", datetime(2014, 6, 1)),
    (2, "b", 0, 1, "", datetime(2013, 3, 1)),
    (3, "c", 0, 9, "cid", datetime(2012, 12, 31)),
]
OTHER = [(9, "z", 0, 50, "ann", datetime(2013, 2, 2)), (9, "z", 1, 51, "bob", datetime(2013, 2, 2)), (9, "z", 2, 52, "dan", datetime(2013, 2, 2))]
SCHEMA = "aid bigint, title string, seq int, rid bigint, contributor string, ts timestamp_ntz"


@pytest.fixture(scope="module")
def history(spark):
    return spark.createDataFrame(HISTORY, SCHEMA)


@pytest.fixture(scope="module")
def other(spark):
    return spark.createDataFrame(OTHER, SCHEMA)


def test_totals(history):
    assert tuple(articles.totals(history).first()) == (3, 5)
    assert tuple(articles.totals(history.limit(0)).first()) == (0, 0)


def test_empty_name_is_a_contributor(history):
    assert articles.unique_contributors(history).first()[0] == 4


def test_creation_years(history, rows):
    assert rows(articles.creation_years(history)) == [(2012,), (2013,)]
    assert rows(articles.creation_years(history, distinct=False)) == [(2012,), (2013,), (2013,)]


def test_busy_articles(history):
    assert articles.busy_articles(history, 3, 2).first()[0] == 1
    assert articles.busy_articles(history, 3, 3).first()[0] == 0
    assert articles.busy_articles(history, 3, 3, distinct=False).first()[0] == 1


def test_orders(history):
    assert [r.title for r in articles.articles_by_revisions(history).collect()] == ["a", "b", "c"]
    assert [tuple(r) for r in articles.contributors_by_revisions(history, 2).collect()] == [("ann", 2), ("", 1)]


def test_years(history, rows):
    counts = articles.per_year(history, F.count(F.lit(1)).alias("n"), F.count_distinct("contributor").alias("people"))
    assert rows(counts) == [(2012, 1, 1), (2013, 2, 2), (2014, 2, 2)]
    assert rows(articles.in_year(history, 2013), "rid") == [(1,), (5,)]
    maps = articles.contributor_maps_per_year(history).collect()
    assert sorted(map(tuple, maps)) == [(2012, "cid", 1, 1), (2013, "", 1, 2), (2013, "ann", 1, 2), (2014, "ann", 1, 2), (2014, "bob", 1, 2)]
    by_year = articles.revisions_by_year(history, ["rid"])
    assert rows(by_year) == [(2012, 9, 1, 1, 1), (2013, 1, 1, 2, 2), (2013, 5, 1, 2, 2), (2014, 6, 1, 2, 2), (2014, 7, 1, 2, 2)]


def test_year_is_a_pushed_filter(spark, history, tmp_path):
    history.write.parquet(str(tmp_path / "h"))
    plan = articles.in_year(spark.read.parquet(str(tmp_path / "h")), 2013)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts" in plan and "LessThan(ts" in plan


def test_cogroup(history, other, rows):
    got = articles.cogroup_by_contributor(history, other, ["rid"])
    assert got.columns == ["contributor", "side", "rid", "copies", "n_revs1", "n_revs2"]
    assert rows(got) == [
        ("", 1, 1, 1, 1, 0), ("ann", 1, 5, 1, 2, 1), ("ann", 1, 6, 1, 2, 1), ("ann", 2, 50, 1, 2, 1),
        ("bob", 1, 7, 1, 1, 1), ("bob", 2, 51, 1, 1, 1), ("cid", 1, 9, 1, 1, 0), ("dan", 2, 52, 1, 0, 1),
    ]


def test_hot_contributor_is_whole(spark):
    rows_of = lambda start, n, who: spark.range(start, start + n).select(
        F.lit(1).cast("bigint").alias("aid"), F.col("id").alias("rid"), F.lit(who).alias("contributor"), F.lit(datetime(2013, 1, 1)).cast("timestamp_ntz").alias("ts")
    )
    first, second = rows_of(0, 25_000, "bot").union(rows_of(50_000, 3, "ann")), rows_of(90_000, 15_000, "bot")
    bot = [r for r in articles.cogroup_by_contributor(first, second).collect() if r.contributor == "bot"]
    assert sorted(r.rid for r in bot if r.side == 1) == list(range(25_000))
    assert sorted(r.rid for r in bot if r.side == 2) == list(range(90_000, 105_000))
    assert {(r.n_revs1, r.n_revs2) for r in bot} == {(25_000, 15_000)}


def test_shared_contributors(history, other, rows):
    assert rows(articles.shared_contributors(history, other)) == [("ann",), ("bob",)]
    in_2013 = F.bool_or(F.year("ts") == 2013)
    assert rows(articles.shared_contributors(history, other, in_2013)) == [("ann",)]
    kept = articles.cogroup_where(history, other, in_2013).collect()
    assert sorted((r.contributor, r.side, r.rid, r.n_revs1, r.n_revs2) for r in kept) == [("ann", 1, 5, 2, 1), ("ann", 1, 6, 2, 1), ("ann", 2, 50, 2, 1)]


def test_partitioning_by_contributor(history):
    together = articles.by_contributor(history, 4, split=1)
    homes = together.select("contributor", F.spark_partition_id()).distinct().groupBy("contributor").count().collect()
    assert together.rdd.getNumPartitions() == 4 and all(r["count"] == 1 for r in homes)
    assert sorted(articles.by_contributor(history, 4).collect()) == sorted(history.collect())


def test_revisions_without_the_nested_form(spark):
    revision = "<revision><id>{0}</id><timestamp>2008-01-0{0}T00:00:00Z</timestamp><ip>1.1.1.{0}</ip></revision>"
    texts = [(f"<page><title>t</title><id>7</id>{revision.format(1)}{revision.format(2)}</page>",), ("<page><id>8</id></page>",), (None,)]
    pages = spark.createDataFrame(texts, "value string")
    flat = articles.parse_revisions(pages)
    assert flat.columns == articles.flatten(articles.parse_pages(pages)).columns
    assert sorted(flat.collect()) == sorted(articles.flatten(articles.parse_pages(pages)).collect()) and flat.count() == 2


@pytest.mark.parametrize("name", ["page_round_trip", "article_columns", "article_text", "contributors_both_files"])
def test_an_article_of_many_revisions_takes_several_pages(spark, monkeypatch, name):
    folder = "/root/testdata/sf0.001"
    run = getattr(article_queries, name)
    whole = sorted(map(tuple, run(spark, folder).collect()))
    monkeypatch.setattr(article_queries, "PAGE", 4, raising=False)
    pages = files.read_articles(spark, article_queries._page_files(spark, folder))
    per_article = pages.groupBy("aid").agg(F.count("*").alias("n"), F.sum(F.size("revisions")).alias("revisions"))
    assert per_article.where("revisions > 20 AND n < 2").isEmpty() and not per_article.where("n > 2").isEmpty()
    assert sorted(map(tuple, run(spark, folder).collect())) == whole


def test_revision_columns_of_a_long_history(spark):
    """An article with nearly all revisions: rows and a total, no list."""
    hot = spark.range(50_000).selectExpr("1 AS aid", "'a' AS title", "id AS rid", "concat('u', id % 7) AS contributor", "timestamp_ntz'2001-05-01 00:00:00' AS ts")
    other = spark.createDataFrame([(2, "b", 7, "x", None), (None, None, 8, "y", None)], "aid int, title string, rid bigint, contributor string, ts timestamp_ntz")
    got = articles.revision_columns(hot.union(other))
    assert got.columns == ["aid", "title", "rid", "contributor", "pair", "year", "n_revisions"]
    assert got.filter("aid = 1 AND n_revisions = 50000 AND year = 2001 AND pair = concat(contributor, ':', rid)").count() == 50_000
    assert {tuple(r) for r in got.filter("aid IS NULL OR aid = 2").collect()} == {(2, "b", 7, "x", "x:7", None, 1), (None, None, 8, "y", "y:8", None, 1)}
    assert articles.revision_columns(hot.limit(0)).count() == 0
