"""Word streams and word statistics over a table of texts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import WHITESPACE, index_of, is_letters, text_lines


def words(texts: DataFrame, text: str = "text") -> DataFrame:
    """One row ``word`` per whitespace-separated word."""
    return texts.select(F.explode(F.split(text, WHITESPACE)).alias("word")).filter("word <> ''")


def letter_words(texts: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Words between spaces and line ends that are English letters only, as ``keep..., pos, word``.

    ``pos`` grows along the text; it counts dropped pieces too.
    """
    pieces = texts.select(*keep, F.posexplode(F.split(text, "[ \r\n]")).alias("pos", "word"))
    return pieces.filter(is_letters(F.col("word")))


def word_counts(stream: DataFrame, at_least: int | None = None) -> DataFrame:
    """``word, n``; with ``at_least``, only words that often (inclusive)."""
    counts = stream.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts if at_least is None else counts.filter(F.col("n") >= at_least)


def word_total(stream: DataFrame) -> DataFrame:
    return stream.agg(F.count(F.lit(1)).alias("n"))


def unique_words_descending(stream: DataFrame) -> DataFrame:
    return stream.select("word").distinct().orderBy(F.desc("word"))


def longest_word(stream: DataFrame, order: Sequence[str]) -> DataFrame:
    """The longest word; of equally long ones the last in ``order``. One space if there are no words."""
    rank = F.struct(F.length("word"), *order)
    return stream.agg(F.coalesce(F.max_by("word", rank), F.lit(" ")).alias("word"))


def words_of_length(stream: DataFrame, length: int) -> DataFrame:
    return stream.agg(F.count_if(F.length("word") == length).alias("n"))


def mean_word_length(stream: DataFrame) -> DataFrame:
    """Mean length, NaN if there are no words."""
    return stream.agg(F.coalesce(F.avg(F.length("word")), F.lit(float("nan"))).alias("mean_length"))


def words_by_first_letter(stream: DataFrame) -> DataFrame:
    """The set of words of each first letter in long form, ``letter, word``.

    No arrays: the vocabulary of one letter has no size limit.
    """
    return stream.select(F.substring("word", 1, 1).alias("letter"), "word").distinct()


def without_words(stream: DataFrame, stop: DataFrame) -> DataFrame:
    """Drop exact matches with the ``word`` column of ``stop``, case-sensitive.

    Call it on counts rather than on the raw stream where that gives the same answer. There is no
    broadcast hint: Catalyst broadcasts ``stop`` if its measured size allows.
    """
    return stream.join(stop.select("word"), "word", "left_anti")


def longest_first(stream: DataFrame) -> DataFrame:
    """Distinct words by byte length descending, then in byte order."""
    sized = stream.select("word").distinct().withColumn("n_bytes", F.octet_length("word"))
    return sized.orderBy(F.desc("n_bytes"), "word")


def lines(texts: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """One row ``keep..., line_no, line`` per line, blank ones included."""
    return texts.select(*keep, F.posexplode(text_lines(F.col(text))).alias("line_no", "line"))


def best_lines(
    numbered: DataFrame,
    target: str,
    order: Sequence[str],
    score: Callable[[Column, str], Column] = index_of,
    limit: int = 20,
) -> DataFrame:
    """The ``limit`` lines of the highest score, ties in file order.

    Lines without the target score -1 and fill up the report if there are too few hits.
    """
    scored = numbered.withColumn("score", score(F.col("line"), target))
    return scored.orderBy(F.desc("score"), *order).limit(limit)
