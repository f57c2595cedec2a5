"""Views over the test tables, written once as SQL that Spark and DuckDB both read.

``{orders}`` and the like stand for tables: Spark binds them to DataFrames, the oracle to names.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession

REVISIONS = """
SELECT o_custkey AS aid, c_name AS title, o_orderkey AS rid,
       'user' || cast((o_orderkey * 7) % 4999 AS string) AS contributor, o_orderdate AS ts,
       CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 2 END AS history
FROM {orders} JOIN {customer} ON c_custkey = o_custkey
"""

FILMS = """
SELECT ' ' || p_name || ' ' AS title,
       CASE WHEN l_orderkey % 41 = 0 THEN 'n/a' ELSE cast(1985 + p_size % 30 AS string) END AS release_year,
       CASE WHEN l_orderkey % 23 = 0 THEN NULL ELSE n_name END AS location,
       CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE p_brand END AS company,
       r_name AS distributor,
       CASE WHEN p_partkey % 17 = 0 THEN NULL
            WHEN p_partkey % 13 = 0 THEN 'Ann Lee and Bo Ray'
            WHEN p_partkey % 11 = 0 THEN 'Ann Lee & Bo Ray'
            WHEN p_partkey % 7 = 0 THEN 'Madonna'
            ELSE 'Director ' || cast(p_partkey % 29 AS string) END AS director,
       'Writer ' || cast(p_partkey % 9 AS string) AS writer,
       'Director ' || cast(s_suppkey % 31 AS string) AS actor1,
       CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_name END AS actor2,
       CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE 'Actor ' || cast(s_suppkey % 12 AS string) END AS actor3
FROM {lineitem} JOIN {part} ON p_partkey = l_partkey JOIN {supplier} ON s_suppkey = l_suppkey
     JOIN {nation} ON n_nationkey = s_nationkey JOIN {region} ON r_regionkey = n_regionkey
"""

PEOPLE = """
SELECT c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender,
       cast(1928 + c_custkey % 91 AS int) AS birth_year
FROM {customer}
"""

PLANS = """
SELECT c_name AS name, cast(25 + c_custkey % 16 AS int) AS start_age,
       cast(60 + c_custkey % 11 AS int) AS retirement_age, cast(5 + c_custkey % 16 AS int) AS contribution,
       CASE c_custkey % 4 WHEN 0 THEN 'growth' WHEN 1 THEN 'Balanced'
            WHEN 2 THEN 'conservative' ELSE 'CASH' END AS strategy
FROM {customer}
"""

# A list of people in which names repeat: one entry per order, in order of the order key.
REGISTER = """
SELECT 'Customer#' || lpad(cast(o_custkey AS string), 9, '0') AS name,
       CASE WHEN o_orderkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender,
       cast(1928 + o_orderkey % 91 AS int) AS birth_year, o_orderkey AS place
FROM {orders}
"""

# Images of 40 x 25, one per thousand events.
PIXELS = """
SELECT event_id DIV 1000 AS image_id, 40 AS width, 25 AS height,
       cast((event_id % 1000) % 40 AS int) AS x, cast((event_id % 1000) DIV 40 AS int) AS y,
       cast((((event_id % 40) * 16) % 256) * 65536 + ((((event_id % 1000) DIV 40) * 20) % 256) * 256
            + (user_id * 40) % 256 AS int) AS rgb
FROM {events}
"""

POINTS = """
SELECT l_suppkey AS grp, cast((l_partkey * 7919) % 1000 AS double) / 1000 AS x,
       cast((l_orderkey * 104729) % 1000 AS double) / 1000 AS y
FROM {lineitem}
"""

CARS = """
SELECT l_orderkey AS row_order, l_partkey AS row_part, l_suppkey AS row_supplier,
       l_returnflag AS buying, l_linestatus AS maintain, cast(l_linenumber AS string) AS doors,
       p_type AS persons, p_brand AS boot, o_orderpriority AS safety, o_orderstatus AS label
FROM {lineitem} JOIN {part} ON p_partkey = l_partkey JOIN {orders} ON o_orderkey = l_orderkey
"""

# Oracle only: the words of the documents with their places, and the words of letters only.
WORDS = r"""
SELECT doc_id, line_no, unnest(range(len(ws))) AS word_no, unnest(ws) AS word FROM (
  SELECT doc_id, line_no, list_filter(regexp_split_to_array(line, '[ \t\n\r\f]+'), lambda s: s <> '') AS ws FROM (
    SELECT doc_id, unnest(range(len(ls))) AS line_no, unnest(ls) AS line FROM (
      SELECT doc_id, list_filter(string_split(text, chr(10)), lambda s: s <> '') AS ls FROM documents)))
"""
LETTER_WORDS = r"""
SELECT doc_id, pos, word FROM (
  SELECT doc_id, unnest(range(len(ws))) AS pos, unnest(ws) AS word FROM (
    SELECT doc_id, regexp_split_to_array(text, '[ \r\n]') AS ws FROM documents))
WHERE regexp_full_match(word, '[a-zA-Z]+')
"""

VIEWS = {
    "revisions": REVISIONS,
    "films": FILMS,
    "people": PEOPLE,
    "plans": PLANS,
    "register": REGISTER,
    "pixels": PIXELS,
    "points": POINTS,
    "cars": CARS,
}


def table_names(sql: str) -> list[str]:
    return [field for _, field, _, _ in string.Formatter().parse(sql) if field]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", "text")


def view(spark: SparkSession, folder: str, name: str) -> DataFrame:
    sql = VIEWS[name]
    tables = {t: table(spark, folder, t) for t in table_names(sql)}
    return spark.sql(sql, **tables)


def duck(sql: str) -> str:
    """A view's SQL in the oracle's dialect."""
    bound = sql.format(**{t: t for t in table_names(sql)})
    return bound.replace(" DIV ", " // ").strip()


def oracle(select: str, *names: str, **extra: str) -> str:
    """An oracle query over some of the views, given as common table expressions."""
    parts = {n: {"words": WORDS, "letter_words": LETTER_WORDS}.get(n) or duck(VIEWS[n]) for n in names} | extra
    ctes = ",\n".join(f"{n} AS ({sql.strip()})" for n, sql in parts.items())
    return f"WITH {ctes}\n{select.strip()}" if ctes else select.strip()
