"""Queries over revision histories: customers as articles, orders as revisions."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.markup import instant_text
from millrace.operators import articles
from millrace.operators.grouping import looked_up, map_rows, with_totals
from millrace.plans.registry import query
from millrace.plans.views import oracle, view
from millrace.shared import new_folder
from millrace.sources import files, sinks

DAY_SQL = "strftime(ts, '%Y-%m-%d %H:%M:%S')"
ISO_SQL = "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')"
YEAR = 1996
PAGE = 1000  # revisions in a page of markup, about
MAP_SIZE = 100  # entries of a map, about


def _revisions(spark, folder):
    return view(spark, folder, "revisions")


def _histories(spark, folder):
    rows = _revisions(spark, folder)
    return rows.filter("history = 1"), rows.filter("history = 2")


def _sql(select, **extra):
    return oracle(select, "revisions", **extra)


@query("article_revision_totals", _sql("SELECT count(DISTINCT aid) AS n_articles, count(*) AS n_revisions FROM revisions"))
def article_revision_totals(spark, folder):
    return articles.totals(_revisions(spark, folder))


@query("unique_contributors", _sql("SELECT count(DISTINCT contributor) AS n FROM revisions"))
def unique_contributors(spark, folder):
    return articles.unique_contributors(_revisions(spark, folder))


FIRST_YEARS = "SELECT aid, cast(year(arg_min(ts, rid)) AS int) AS year FROM revisions GROUP BY aid"


@query("creation_years", _sql(f"SELECT DISTINCT year FROM ({FIRST_YEARS})"))
def creation_years(spark, folder):
    return articles.creation_years(_revisions(spark, folder), order="rid")


@query("creation_years_all", _sql(f"SELECT year FROM ({FIRST_YEARS})"))
def creation_years_all(spark, folder):
    return articles.creation_years(_revisions(spark, folder), order="rid", distinct=False)


SIZES = "SELECT count(*) AS revisions, count(DISTINCT contributor) AS people FROM revisions GROUP BY aid"


@query(
    "articles_min_rev_contrib",
    _sql(f"SELECT count(*) FILTER (WHERE revisions >= 10 AND people >= 10) AS n FROM ({SIZES})"),
)
def articles_min_rev_contrib(spark, folder):
    return articles.busy_articles(_revisions(spark, folder), 10, 10)


@query(
    "articles_min_rev_contrib_repeats",
    _sql(f"SELECT count(*) FILTER (WHERE revisions >= 10 AND revisions >= 12) AS n FROM ({SIZES})"),
)
def articles_min_rev_contrib_repeats(spark, folder):
    return articles.busy_articles(_revisions(spark, folder), 10, 12, distinct=False)


@query("articles_by_revisions", _sql("SELECT aid, title, count(*) AS n FROM revisions GROUP BY aid, title"))
def articles_by_revisions(spark, folder):
    return articles.articles_by_revisions(_revisions(spark, folder))


@query(
    "articles_top3",
    _sql("SELECT aid, title, count(*) AS n FROM revisions GROUP BY aid, title ORDER BY n DESC, title, aid LIMIT 3"),
)
def articles_top3(spark, folder):
    return articles.articles_by_revisions(_revisions(spark, folder), limit=3)


@query("contributors_by_revisions", _sql("SELECT contributor, count(*) AS n FROM revisions GROUP BY contributor"))
def contributors_by_revisions(spark, folder):
    return articles.contributors_by_revisions(_revisions(spark, folder))


@query(
    "contributors_top3",
    _sql("SELECT contributor, count(*) AS n FROM revisions GROUP BY contributor ORDER BY n DESC, contributor LIMIT 3"),
)
def contributors_top3(spark, folder):
    return articles.contributors_by_revisions(_revisions(spark, folder), limit=3)


@query(
    "revisions_by_year_list",
    _sql(
        f"SELECT cast(year(ts) AS int) AS year, aid, rid, contributor, {DAY_SQL} AS ts, count(*) AS copies, "
        "cast(sum(count(*)) OVER (PARTITION BY year(ts)) AS bigint) AS n_rows FROM revisions GROUP BY year(ts), aid, rid, contributor, ts"
    ),
)
def revisions_by_year_list(spark, folder):
    rows = articles.revisions_by_year(_revisions(spark, folder))
    return rows.select("year", "aid", "rid", "contributor", F.col("ts").cast("string").alias("ts"), "copies", "n_rows")


@query("revisions_per_year", _sql("SELECT cast(year(ts) AS int) AS year, count(*) AS n_revisions FROM revisions GROUP BY 1"))
def revisions_per_year(spark, folder):
    return articles.per_year(_revisions(spark, folder), F.count(F.lit(1)).alias("n_revisions"))


@query(
    "revisions_in_year",
    _sql(f"SELECT cast(year(ts) AS int) AS year, count(*) AS n_revisions FROM revisions WHERE year(ts) = {YEAR} GROUP BY 1"),
)
def revisions_in_year(spark, folder):
    rows = articles.in_year(_revisions(spark, folder), YEAR)
    return articles.per_year(rows, F.count(F.lit(1)).alias("n_revisions"))


@query(
    "contributors_per_year",
    _sql("SELECT cast(year(ts) AS int) AS year, count(DISTINCT contributor) AS n_contributors FROM revisions GROUP BY 1"),
)
def contributors_per_year(spark, folder):
    return articles.contributors_per_year(_revisions(spark, folder))


COUNTS = "SELECT cast(year(ts) AS int) AS year, contributor, count(*) AS n FROM revisions GROUP BY 1, 2"


@query("contributor_counts_per_year", _sql(COUNTS))
def contributor_counts_per_year(spark, folder):
    return articles.contributor_counts_per_year(_revisions(spark, folder))


@query("contributor_maps_per_year", _sql(f"SELECT *, count(*) OVER (PARTITION BY year) AS n_contributors FROM ({COUNTS})"))
def contributor_maps_per_year(spark, folder):
    return articles.contributor_maps_per_year(_revisions(spark, folder))


@query(
    "contributor_in_year",
    _sql(f"SELECT contributor, count(*) AS n FROM revisions WHERE year(ts) = {YEAR} AND contributor = 'user1001' GROUP BY 1"),
)
def contributor_in_year(spark, folder):
    rows = articles.in_year(_revisions(spark, folder), YEAR).filter("contributor = 'user1001'")
    return articles.contributor_counts(rows)


@query("partitioned_by_contributor", _sql("SELECT contributor, rid FROM revisions"))
def partitioned_by_contributor(spark, folder):
    return articles.by_contributor(_revisions(spark, folder), 8, split=4).select("contributor", "rid")


SIDE_SUM = "cast(sum(CASE WHEN history = {0} THEN count(*) ELSE 0 END) OVER (PARTITION BY contributor) AS bigint) AS n_revs{0}"
COGROUP = f"SELECT contributor, cast(history AS int) AS side, rid, count(*) AS copies, {SIDE_SUM.format(1)}, {SIDE_SUM.format(2)} FROM revisions"


@query("cogroup_contributors", _sql(f"{COGROUP} GROUP BY contributor, history, rid"))
def cogroup_contributors(spark, folder):
    return articles.cogroup_by_contributor(*_histories(spark, folder), fields=["rid"])


BOTH = """
SELECT contributor FROM revisions GROUP BY contributor
HAVING count(*) FILTER (WHERE history = 1 AND {0}) > 0 AND count(*) FILTER (WHERE history = 2 AND {0}) > 0
"""
IN_YEAR = f"year(ts) = {YEAR}"


@query("contributors_both", _sql(f"SELECT count(*) AS n FROM ({BOTH.format('true')})"))
def contributors_both(spark, folder):
    return articles.shared_contributors(*_histories(spark, folder)).agg(F.count(F.lit(1)).alias("n"))


@query("contributors_both_in_year", _sql(f"SELECT count(*) AS n FROM ({BOTH.format(IN_YEAR)})"))
def contributors_both_in_year(spark, folder):
    first, second = (articles.in_year(side, YEAR) for side in _histories(spark, folder))
    return articles.shared_contributors(first, second).agg(F.count(F.lit(1)).alias("n"))


@query(
    "cogroup_where_in_year",
    _sql(f"{COGROUP} WHERE contributor IN ({BOTH.format(IN_YEAR)}) GROUP BY contributor, history, rid"),
)
def cogroup_where_in_year(spark, folder):
    first, second = _histories(spark, folder)
    return articles.cogroup_where(first, second, F.bool_or(F.year("ts") == YEAR), fields=["rid"])


def _page_files(spark, folder, history=None):
    """Revisions as files of page markup: user names in the first history, ips in the second. An
    article of a long history takes several pages of one id, each with revisions by a hash of ``rid``."""
    rows = _revisions(spark, folder).select("aid", "title", "rid", "contributor", "ts", "history")
    if history:
        rows = rows.filter(F.col("history") == history)
    revisions = F.sort_array(F.collect_list(F.struct("rid", "contributor", "ts", "history")))
    counts = rows.groupBy("aid", "title").agg(F.ceil(F.count(F.lit(1)) / F.lit(PAGE)).alias("pages"))
    paged = rows.join(counts, ["aid", "title"]).withColumn("page", F.pmod(F.xxhash64("rid"), F.col("pages")))
    pages = paged.groupBy("aid", "title", "page").agg(revisions.alias("items"))

    def tag(name, text):
        return F.concat(F.lit(f"<{name}>"), text.cast("string"), F.lit(f"</{name}>"))

    def revision(r):
        who = F.when(r["history"] == 1, tag("username", r["contributor"])).otherwise(tag("ip", r["contributor"]))
        stamp = tag("timestamp", instant_text(r["ts"]))
        return tag("revision", F.concat(tag("id", r["rid"]), stamp, tag("contributor", who)))

    body = F.array_join(F.transform("items", revision), "\n")
    page = F.concat(
        F.lit("<page>\n"), tag("title", F.col("title")), tag("id", F.col("aid")), body, F.lit("\n</page>")
    )
    path = new_folder(spark)
    pages.select(page.alias("value")).write.text(path)
    return path


@query("page_round_trip", _sql(f"SELECT aid, title, rid, contributor, {DAY_SQL} AS ts FROM revisions"))
def page_round_trip(spark, folder):
    """Pages written as markup, scanned by page and parsed."""
    rows = files.read_revisions(spark, _page_files(spark, folder))
    return rows.select("aid", "title", "rid", "contributor", F.col("ts").cast("string").alias("ts"))


@query(
    "article_columns",
    _sql(
        "SELECT aid, title, rid, contributor, contributor || ':' || rid AS pair, cast(year(ts) AS int) AS year, "
        "count(*) OVER (PARTITION BY aid, title) AS n_revisions FROM revisions"
    ),
)
def article_columns(spark, folder):
    """The derived columns of parsed articles, a row per revision."""
    return articles.revision_columns(files.read_revisions(spark, _page_files(spark, folder)))


@query(
    "article_record_columns",
    _sql(
        "SELECT aid, title, rid, contributor, contributor || ':' || rid AS pair, cast(year(ts) AS int) AS year, "
        "count(*) OVER (PARTITION BY aid, title) AS n_revisions FROM revisions"
    ),
)
def article_record_columns(spark, folder):
    """The same from the list columns of each page record, which its markup bounds, zipped and made rows; an article's
    number of revisions is the sum over its pages."""
    pages = files.read_articles(spark, _page_files(spark, folder))
    listed = F.arrays_zip(
        articles.contributors().alias("contributor"), articles.contributor_revisions().alias("by"), articles.revision_years().alias("year")
    )
    rows = pages.select("aid", "title", articles.revision_count().alias("n"), F.posexplode(listed).alias("place", "r"))
    pair = F.concat_ws(":", "r.by.contributor", F.col("r.by.rid").cast("string"))
    columns = rows.select("aid", "title", "n", "place", F.col("r.by.rid").alias("rid"), "r.contributor", pair.alias("pair"), "r.year")
    first = F.when(F.col("place") == 0, F.col("n")).otherwise(0)
    totals = with_totals(columns.withColumn("first", first), ["aid", "title"], n_revisions=F.sum("first"))
    return totals.select("aid", "title", "rid", "contributor", "pair", "year", "n_revisions")


@query("article_year_maps", _sql("SELECT aid, title, cast(year(ts) AS int) AS year, count(*) AS n FROM revisions GROUP BY ALL"))
def article_year_maps(spark, folder):
    """A map from year to revisions in each page record, read back by entries and summed over an article's pages."""
    pages = files.read_articles(spark, _page_files(spark, folder))
    maps = pages.select("aid", "title", articles.revisions_per_year_map().alias("entries"))
    return map_rows(maps, ["aid", "title"], "year", "n").groupBy("aid", "title", "year").agg(F.sum("n").alias("n"))


@query("contributor_map_entries", _sql(f"SELECT *, true AS bounded FROM ({COUNTS})"))
def contributor_map_entries(spark, folder):
    """Each year's contributors as maps, read back by entries, and whether no map is far above its size."""
    maps = articles.contributor_year_maps(_revisions(spark, folder), size=MAP_SIZE)
    sized = maps.withColumn("bounded", F.size("entries") <= 2 * MAP_SIZE)
    return map_rows(sized, ["year", "bounded"], "contributor", "n").select("year", "contributor", "n", "bounded")


@query(
    "contributor_map_lookup",
    _sql(
        f"SELECT a.contributor, a.n AS n_before, b.n FROM ({COUNTS}) AS a LEFT JOIN ({COUNTS}) AS b "
        f"ON b.year = a.year + 1 AND b.contributor = a.contributor WHERE a.year = {YEAR}"
    ),
)
def contributor_map_lookup(spark, folder):
    """The contributors of a year, looked up in the next year's maps."""
    rows = _revisions(spark, folder)
    maps = articles.contributor_year_maps(rows, size=MAP_SIZE)
    before = articles.contributor_counts(articles.in_year(rows, YEAR)).withColumnRenamed("n", "n_before")
    wanted = before.withColumn("year", F.lit(YEAR + 1))
    return looked_up(wanted, maps, ["year"], "contributor", "n").select("contributor", "n_before", "n")


@query(
    "article_text",
    _sql(
        "SELECT line, count(*) AS n FROM ("
        "SELECT DISTINCT aid || ',' || title AS line FROM revisions UNION ALL "
        f"SELECT chr(9) || rid || ',' || contributor || ',' || {ISO_SQL} FROM revisions) GROUP BY line"
    ),
)
def article_text(spark, folder):
    """Articles written as plain text and read back as lines."""
    path = new_folder(spark)
    sinks.write_revisions(files.read_revisions(spark, _page_files(spark, folder)), path)
    return files.read_lines(spark, path).groupBy("line").agg(F.count(F.lit(1)).alias("n"))


@query("contributors_both_files", _sql(f"SELECT contributor FROM ({BOTH.format('true')})"))
def contributors_both_files(spark, folder):
    """The two histories as two data sets of page files, read and compared."""
    first, second = (files.read_revisions(spark, _page_files(spark, folder, h)) for h in (1, 2))
    return articles.shared_contributors(first, second)
