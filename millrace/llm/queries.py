"""The registered queries of this package, each over its whole tables, and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import (
    ball_codes, covertree, decontamination, hard_negatives, licenses, line_dedup, mixing, packing, quality, secrets, simhash, token_counts,
    toxicity,
)
from millrace.llm.common import written
from millrace.plans.registry import query


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_SPACE = r"[ \t\n\x0b\f\r]"
_NO_SPACE = r"[^ \t\n\x0b\f\r]"

QUALITY_ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         list_filter(regexp_split_to_array(coalesce(text, ''), '{_SPACE}+'), lambda w: w <> '') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '{_NO_SPACE}')) AS ls
  FROM documents),
starts AS (
  SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS w
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM d)),
repeated AS (
  SELECT r, count(DISTINCT j) AS n FROM (
    SELECT r, unnest([i, i + 1, i + 2]) AS j FROM (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS c FROM starts)
    WHERE c > 1) GROUP BY r),
m AS (
  SELECT doc_id, cast(len(ws) AS bigint) AS n_words, cast(length(array_to_string(ws, '')) AS bigint) AS word_chars,
         cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS bigint) AS n_symbols,
         cast(len(ls) - len(list_distinct(ls)) AS bigint) AS n_dup_lines,
         cast(coalesce(n, 0) AS bigint) AS n_repeat_words, len(ls) AS n_lines,
         length(regexp_replace(text, '\P{{L}}', '', 'g')) AS n_letters,
         length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')) AS n_upper
  FROM d LEFT JOIN repeated USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 10 * n_letters < 6 * word_chars
            OR 2 * n_upper > n_letters) AS kept
FROM m
"""


@query("op1_quality", QUALITY_ORACLE)
def _quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.digest(_read(spark, folder, "documents"))


@query("op2_mixing")
def _mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.digest(_read(spark, folder, "documents"))


@query("op3_secrets")
def _secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.digest(_read(spark, folder, "documents"))


@query("op4_line_dedup")
def _line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.digest(_read(spark, folder, "documents"))


@query("op5_toxicity")
def _toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.digest(_read(spark, folder, "documents"), _read(spark, folder, "labels"))


EMBEDDINGS_ORACLE = """
WITH RECURSIVE e AS (SELECT vec_id, cast(embedding AS DOUBLE[]) AS v FROM embeddings),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM e AS a JOIN e AS b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reach AS (
  SELECT vec_id AS a, vec_id AS b FROM e UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
least AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM e JOIN least ON least.a = vec_id LEFT JOIN counts ON counts.a = vec_id
"""


@query("op6_embeddings", EMBEDDINGS_ORACLE)
def _embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return covertree.digest(_read(spark, folder, "embeddings"))


@query("op7_packing")
def _packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.digest(_read(spark, folder, "documents"))


@query("op8_tokens")
def _tokens(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.digest(_read(spark, folder, "documents"))


def _licenses_oracle() -> str:
    plain = f"regexp_replace(lower(coalesce(text, '')), '{licenses.NOISE}', ' ', 'g')"
    plain = rf"regexp_replace({plain}, '[^\p{{L}}\p{{N}}\n]+', '', 'g')"
    for spelling, usual in licenses.SPELLINGS:
        plain = f"replace({plain}, '{spelling}', '{usual}')"
    rows = ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in licenses.LICENSES)
    return rf"""
WITH known AS (
  SELECT c, length(c) AS n, string_agg(DISTINCT license, '|' ORDER BY license) AS license
  FROM (SELECT license, replace({plain}, chr(10), '') AS c FROM (VALUES {rows}) AS t(license, text)) WHERE length(c) >= {licenses.HEAD} GROUP BY c),
d AS (SELECT row_number() OVER () AS r, doc_id, string_split({plain}, chr(10)) AS ls FROM documents),
cells AS (SELECT * FROM (SELECT r, doc_id, unnest(range(len(ls))) AS place, unnest(ls) AS l FROM d) WHERE l <> ''),
sums AS (
  SELECT *, sum(length(l)) OVER w AS upto, row_number() OVER w AS k, count(*) OVER (PARTITION BY r) AS size
  FROM cells WINDOW w AS (PARTITION BY r ORDER BY place)),
whole AS (SELECT r, string_agg(l, '' ORDER BY place) AS t FROM cells GROUP BY r),
runs AS (
  SELECT s.r, s.doc_id, s.place, s.k, s.size, known.license, s.upto - length(s.l) + n AS stop
  FROM sums AS s JOIN whole USING (r)
  JOIN known ON left(c, {licenses.HEAD}) = substr(t, cast(s.upto - length(s.l) + 1 AS bigint), {licenses.HEAD}) AND c = substr(t, cast(s.upto - length(s.l) + 1 AS bigint), n))
SELECT runs.doc_id, CASE WHEN e.k - runs.k + 1 = runs.size THEN 'text' WHEN e.k = runs.k THEN 'line' ELSE 'lines' END AS unit,
       cast(runs.place AS int) AS place, cast(e.k - runs.k + 1 AS int) AS n_lines, license
FROM runs JOIN sums AS e ON e.r = runs.r AND e.upto = runs.stop
"""


@query("op9_licenses", _licenses_oracle())
def _licenses(spark: SparkSession, folder: str) -> DataFrame:
    # Written, as its heads are read first; as many rows as LICENSES has different texts.
    known = written(licenses.digests(licenses.known(spark)))
    return licenses.matches(_read(spark, folder, "documents"), known)


@query("op10_simhash")
def _simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.digest(_read(spark, folder, "documents"))


_ITEM_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION_ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_ITEM_WORDS} AS ws FROM documents),
items AS (SELECT cast(item_id AS varchar) AS item, {_ITEM_WORDS} AS ws FROM benchmark),
strings AS (
  SELECT DISTINCT item, k, array_to_string(list_slice(ws, i, i + k - 1), ' ') AS w
  FROM (SELECT item, ws, least(len(ws), 10) AS k, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM items WHERE len(ws) > 0)),
places AS (
  SELECT r, k, i, array_to_string(list_slice(ws, i, i + k - 1), ' ') AS w
  FROM (SELECT r, k, ws, unnest(range(1, len(ws) - k + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT k FROM strings))),
hits AS (SELECT r, item, k, i FROM places JOIN strings USING (k, w)),
hit AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + k)) AS j FROM (SELECT DISTINCT r, k, i FROM hits)) GROUP BY r),
listed AS (SELECT r, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY r)
SELECT doc_id, cast(len(ws) AS bigint) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(listed.n, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, hit.n IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN listed USING (r)
"""


@query("op11_decontamination", DECONTAMINATION_ORACLE)
def _decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.digest(_read(spark, folder, "documents"), _read(spark, folder, "benchmark"))


_WHOLE = "list_transform(embedding, lambda x: floor(256 * cast(x AS double)))"
_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"

HARD_NEGATIVES_ORACLE = f"""
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, {_WHOLE} AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {_FINITE}),
s AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS id, cast(list_inner_product(a.v, b.v) AS bigint) AS score
  FROM e AS a JOIN e AS b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, cast(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS int) AS rank,
       id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 10
"""


@query("op12_hard_negatives", HARD_NEGATIVES_ORACLE)
def _hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.digest(_read(spark, folder, "embeddings"))


def _codes_oracle() -> str:
    def assigned(i: int) -> str:
        # Least distance and then least entry, as one number.
        return f"""
a{i} AS MATERIALIZED (
  SELECT rn, part, min(d * 64 + entry) AS best FROM (
    SELECT rn, part, entry, cast(list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c) AS bigint) AS d
    FROM p JOIN c{i} USING (part)) GROUP BY rn, part)"""

    def moved(i: int) -> str:
        return f"""
m{i} AS (
  SELECT part, entry, i, floor(sum(y) / count(*)) AS y FROM (
    SELECT part, best % 64 AS entry, unnest(range(len(x))) AS i, unnest(x) AS y FROM p JOIN a{i} USING (rn, part))
  GROUP BY part, entry, i),
c{i + 1} AS MATERIALIZED (
  SELECT part, entry, coalesce(n, c) AS c
  FROM c{i} LEFT JOIN (SELECT part, entry, list(y ORDER BY i) AS n FROM m{i} GROUP BY part, entry) USING (part, entry))"""

    return f"""
WITH k AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rn, vec_id, label, {_WHOLE} AS v FROM embeddings WHERE {_FINITE}),
p AS MATERIALIZED (
  SELECT rn, part, list_slice(v, part * len(v) // 16 + 1, (part + 1) * len(v) // 16) AS x
  FROM (SELECT rn, v, unnest(range(16)) AS part FROM k)),
c0 AS (SELECT part, rn - 1 AS entry, x AS c FROM p WHERE rn <= 64), {assigned(0)}, {moved(0)}, {assigned(1)}, {moved(1)}, {assigned(2)},
coded AS (
  SELECT rn, string_agg(lower(printf('%02x', best % 64)), '' ORDER BY part) AS code, cast(sum(best // 64) AS bigint) AS error
  FROM a2 GROUP BY rn)
SELECT vec_id, code, error, cast(sum(error) OVER (PARTITION BY label) AS bigint) AS label_error,
       (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda y: cast(cast(y AS bigint) AS varchar)), ','), ',' ORDER BY part, entry))
        FROM c2) AS codebooks_sha256
FROM k JOIN coded USING (rn)
"""


@query("op13_vector_codes", _codes_oracle())
def _vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return ball_codes.digest(_read(spark, folder, "embeddings"))
