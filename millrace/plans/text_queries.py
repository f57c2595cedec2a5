"""Queries over the texts of ``documents``."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.text import index_of
from millrace.operators import index, words
from millrace.operators.index import STOP_WORDS
from millrace.plans.registry import query
from millrace.plans.views import documents, oracle
from millrace.shared import new_folder
from millrace.sources import files, sinks

STOP_SQL = ", ".join(f"'{word}'" for word in STOP_WORDS)


def _letter_words(spark, folder, *keep):
    return words.letter_words(documents(spark, folder), keep=keep)


def _hits(spark, folder):
    return index.word_positions(documents(spark, folder), STOP_WORDS)


def _postings(spark, folder):
    return index.document_postings(documents(spark, folder), STOP_WORDS)


@query(
    "word_count_500",
    oracle("SELECT word, count(*) AS n FROM words GROUP BY word HAVING count(*) >= 500", "words"),
)
def word_count_500(spark, folder):
    return words.word_counts(words.words(documents(spark, folder)), at_least=500)


@query("word_counts", oracle("SELECT word, count(*) AS n FROM words GROUP BY word", "words"))
def word_counts(spark, folder):
    return words.word_counts(words.words(documents(spark, folder)))


@query("word_counts_alpha", oracle("SELECT word, count(*) AS n FROM letter_words GROUP BY word", "letter_words"))
def word_counts_alpha(spark, folder):
    return words.word_counts(_letter_words(spark, folder))


@query("word_total", oracle("SELECT count(*) AS n FROM letter_words", "letter_words"))
def word_total(spark, folder):
    return words.word_total(_letter_words(spark, folder))


@query("unique_words_desc", oracle("SELECT DISTINCT word FROM letter_words", "letter_words"))
def unique_words_desc(spark, folder):
    return words.unique_words_descending(_letter_words(spark, folder))


@query(
    "longest_word",
    oracle(
        "SELECT coalesce((SELECT word FROM letter_words ORDER BY length(word) DESC, doc_id DESC, pos DESC LIMIT 1), ' ') AS word",
        "letter_words",
    ),
)
def longest_word(spark, folder):
    return words.longest_word(_letter_words(spark, folder, "doc_id"), order=["doc_id", "pos"])


@query(
    "three_letter_words",
    oracle("SELECT count(*) FILTER (WHERE length(word) = 3) AS n FROM letter_words", "letter_words"),
)
def three_letter_words(spark, folder):
    return words.words_of_length(_letter_words(spark, folder), 3)


@query(
    "avg_word_length",
    oracle("SELECT round(avg(length(word)), 6) AS mean_length FROM letter_words", "letter_words"),
)
def avg_word_length(spark, folder):
    return words.mean_word_length(_letter_words(spark, folder)).select(
        F.round("mean_length", 6).alias("mean_length")
    )


@query(
    "words_by_first_letter",
    oracle("SELECT DISTINCT word[1] AS letter, word FROM letter_words", "letter_words"),
)
def words_by_first_letter(spark, folder):
    return words.words_by_first_letter(_letter_words(spark, folder))


LINES = r"""
SELECT doc_id, unnest(range(len(ls))) AS line_no, unnest(ls) AS line FROM (
  SELECT doc_id, regexp_split_to_array(regexp_replace(text, '(\r\n|\r|\n)\z', ''), '\r\n|\r|\n') AS ls FROM documents)
"""


@query(
    "lines_found_top20",
    oracle(
        "SELECT doc_id, line_no, cast(instr(line, 'the') - 1 AS int) AS score, line FROM lines "
        "ORDER BY 3 DESC, doc_id, line_no LIMIT 20",
        lines=LINES,
    ),
)
def lines_found_top20(spark, folder):
    numbered = words.lines(documents(spark, folder), keep=["doc_id"])
    best = words.best_lines(numbered, "the", order=["doc_id", "line_no"])
    return best.select("doc_id", F.col("line_no").cast("bigint").alias("line_no"), "score", "line")


@query(
    "line_index_counts",
    oracle(
        "SELECT cast(instr(line, 'ing') - 1 AS int) AS score, count(*) AS n FROM lines GROUP BY 1",
        lines=LINES,
    ),
)
def line_index_counts(spark, folder):
    scored = words.lines(documents(spark, folder)).select(index_of(F.col("line"), "ing").alias("score"))
    return scored.groupBy("score").agg(F.count(F.lit(1)).alias("n"))


@query(
    "stopword_antijoin",
    oracle(f"SELECT word, count(*) AS n FROM words WHERE word NOT IN ({STOP_SQL}) GROUP BY word", "words"),
)
def stopword_antijoin(spark, folder):
    counts = words.word_counts(words.words(documents(spark, folder)))
    return words.without_words(counts, index.stop_word_table(spark))


@query(
    "stopword_file_antijoin",
    oracle(f"SELECT word, count(*) AS n FROM words WHERE word NOT IN ({STOP_SQL}) GROUP BY word", "words"),
)
def stopword_file_antijoin(spark, folder):
    """The same with the stop words from a file that has a comment and a repeat."""
    path = new_folder(spark)
    stop = index.stop_word_table(spark)
    comment = spark.range(1).select(F.lit("# stop words").alias("word"))
    comment.unionAll(stop).unionAll(stop).write.text(path)
    counts = words.word_counts(words.words(documents(spark, folder)))
    return words.without_words(counts, files.read_stop_words(spark, path))


HITS = f"SELECT * FROM words WHERE word NOT IN ({STOP_SQL})"


@query(
    "inverted_index_docs",
    oracle("SELECT word, doc_id, count(*) AS n FROM hits GROUP BY word, doc_id", "words", hits=HITS),
)
def inverted_index_docs(spark, folder):
    return index.doc_counts(_hits(spark, folder))


@query(
    "inverted_index_totals",
    oracle(
        "SELECT word, count(*) AS total, count(DISTINCT doc_id) AS n_docs FROM hits GROUP BY word",
        "words",
        hits=HITS,
    ),
)
def inverted_index_totals(spark, folder):
    return index.totals(_hits(spark, folder))


@query(
    "index_positions",
    oracle(
        "SELECT word, doc_id, count(*) AS n, string_agg(line_no || ':' || word_no, ' ' ORDER BY line_no, word_no) AS positions "
        "FROM hits GROUP BY word, doc_id",
        "words",
        hits=HITS,
    ),
)
def index_positions(spark, folder):
    spots = F.transform("positions", lambda p: F.concat_ws(":", p["line_no"].cast("string"), p["word_no"].cast("string")))
    return _postings(spark, folder).withColumn("positions", F.array_join(spots, " "))


@query(
    "posting_lists",
    oracle(
        "SELECT word, doc_id, count(*) AS n, min(line_no) AS first_line, count(*) OVER (PARTITION BY word) AS n_docs "
        "FROM hits GROUP BY word, doc_id",
        "words",
        hits=HITS,
    ),
)
def posting_lists(spark, folder):
    first_line = F.col("positions")[0]["line_no"].cast("bigint")
    entries = _postings(spark, folder).select("word", "doc_id", "n", first_line.alias("first_line"))  # what the join carries
    return index.posting_lists(entries)


@query(
    "corpus_counters",
    oracle(
        "SELECT (SELECT count(*) FROM hits) AS n_words, "
        "(SELECT count(*) FROM hits WHERE starts_with(word, 'A')) AS n_a_words, "
        "(SELECT cast(sum(len(list_filter(string_split(text, chr(10)), lambda s: s <> ''))) AS bigint) FROM documents) AS n_lines",
        "words",
        hits=HITS,
    ),
)
def corpus_counters(spark, folder):
    return index.corpus_counters(documents(spark, folder), STOP_WORDS)


@query(
    "words_by_length_order",
    oracle("SELECT DISTINCT word, cast(strlen(word) AS int) AS n_bytes FROM words", "words"),
)
def words_by_length_order(spark, folder):
    return words.longest_first(words.words(documents(spark, folder)))


PART_SQL = "cast(least((strlen(word) - 1) // 3, 9) AS int)"  # ten parts


@query(
    "length_partition_sizes",
    oracle(f"SELECT {PART_SQL} AS part, count(DISTINCT word) AS n_words FROM words GROUP BY 1", "words"),
)
def length_partition_sizes(spark, folder):
    return index.part_sizes(words.words(documents(spark, folder)), 10)


@query(
    "length_partition_layout",
    oracle(f"SELECT {PART_SQL} AS part, word, count(*) AS n FROM words GROUP BY 1, 2", "words"),
)
def length_partition_layout(spark, folder):
    """Word counts laid out by word length; each part must be on partitions of its own."""
    counts = words.word_counts(words.words(documents(spark, folder)))
    placed = index.repartition_by_length(counts, 10, split=4)
    own = F.floor(F.spark_partition_id() / 4) == F.col("part")
    part = F.when(own, F.col("part")).otherwise(F.raise_error("row outside its part").cast("int"))
    return placed.select(part.alias("part"), "word", "n")


@query("word_count_files", oracle("SELECT word, cast(count(*) AS bigint) AS n FROM words GROUP BY word", "words"))
def word_count_files(spark, folder):
    """Word counts written as two tab-separated part files and read back."""
    path = new_folder(spark)
    sinks.write_key_values(words.word_counts(words.words(documents(spark, folder))), path, "word", "n", 2)
    fields = F.split("line", "\t")
    lines = files.read_lines(spark, path)
    return lines.select(fields[0].alias("word"), fields[1].cast("bigint").alias("n"))


@query(
    "document_files_index",
    oracle("SELECT word, count(*) AS total, count(DISTINCT doc_id) AS n_docs FROM hits GROUP BY word", "words", hits=HITS),
)
def document_files_index(spark, folder):
    """Documents written as records of markup, scanned with the record delimiter and indexed."""
    path = new_folder(spark)
    tag = F.concat(F.lit('<Document id="'), F.col("doc_id").cast("string"), F.lit('">\n'))
    documents(spark, folder).select(F.concat(tag, "text", F.lit("</Document>"))).write.text(path)
    return index.totals(index.word_positions(files.read_documents(spark, path), STOP_WORDS))


@query(
    "posting_files",
    oracle(
        """
SELECT part, text, count(*) AS n FROM (
  SELECT part, word || chr(9) || count(*) AS text FROM placed GROUP BY part, word
  UNION ALL SELECT part, '' FROM placed GROUP BY part, word
  UNION ALL SELECT part, chr(9) || doc_id || ' ' || count(*) FROM placed GROUP BY part, word, doc_id
  UNION ALL SELECT part, chr(9) || chr(9) || line_no || ' ' || word_no FROM placed
) GROUP BY part, text
""",
        "words",
        placed=f"SELECT *, {PART_SQL} AS part FROM words WHERE word NOT IN ({STOP_SQL})",
    ),
)
def posting_files(spark, folder):
    """The index written as text by word length and read back as lines."""
    table, text = new_folder(spark), new_folder(spark)
    _postings(spark, folder).write.parquet(table)
    sinks.write_postings(spark.read.parquet(table), text, 10)
    lines = spark.read.schema("value string, part int").text(text)
    return lines.groupBy("part", F.col("value").alias("text")).agg(F.count(F.lit(1)).alias("n"))
