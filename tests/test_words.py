import math

import pytest
from pyspark.sql import functions as F

from millrace.functions.text import index_of, is_letters, length_part, text_lines, upper_after_first_space
from millrace.operators import words


def texts(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "doc_id bigint, text string")


def test_words_split_on_five_characters_only(spark, rows):
    frame = texts(spark, " a\tb\nc\rd\fe  f\x0bg ", "", " \n ")
    assert rows(words.words(frame)) == [("a",), ("b",), ("c",), ("d",), ("e",), ("f\x0bg",)]


def test_letter_words(spark, rows):
    frame = texts(spark, "The tHe 89B things, é a\nb\r\nc", "")
    assert rows(words.letter_words(frame), "word") == [("The",), ("a",), ("b",), ("c",), ("tHe",)]


def test_letters_take_the_whole_word(spark):
    frame = spark.createDataFrame([("abc",), ("abc\n",), ("",), ("a1",)], "w string")
    assert [r[0] for r in frame.select(is_letters(F.col("w"))).collect()] == [True, False, False, False]


def test_threshold_is_inclusive(spark, rows):
    frame = texts(spark, "x x x y y z")
    assert rows(words.word_counts(words.words(frame), at_least=2)) == [("x", 3), ("y", 2)]


def test_longest_word_takes_the_last_of_equals(spark):
    stream = words.letter_words(texts(spark, "aaa bbb c", "ddd e"), keep=["doc_id"])
    assert words.longest_word(stream, ["doc_id", "pos"]).first()[0] == "ddd"


def test_no_words(spark):
    stream = words.letter_words(texts(spark, "1 2"), keep=["doc_id"])
    assert words.longest_word(stream, ["doc_id", "pos"]).first()[0] == " "
    assert math.isnan(words.mean_word_length(stream).first()[0])
    assert words.word_total(stream).first()[0] == 0
    assert words.words_of_length(stream, 3).first()[0] == 0


def test_unique_words_are_in_reverse_order(spark):
    stream = words.letter_words(texts(spark, "b a Z b c"))
    assert [r[0] for r in words.unique_words_descending(stream).collect()] == ["c", "b", "a", "Z"]


def test_words_by_first_letter_keep_case(spark, rows):
    stream = words.letter_words(texts(spark, "a A ab a"))
    assert rows(words.words_by_first_letter(stream)) == [("A", "A"), ("a", "a"), ("a", "ab")]


def test_longest_first_counts_bytes(spark):
    frame = texts(spark, "bb é abc aa éé")
    assert [tuple(r) for r in words.longest_first(words.words(frame)).collect()] == [
        ("éé", 4), ("abc", 3), ("aa", 2), ("bb", 2), ("é", 2),
    ]


def test_stop_words_match_exactly(spark, rows):
    stream = words.words(texts(spark, "The the then"))
    stop = spark.createDataFrame([("the",)], "word string")
    assert rows(words.without_words(stream, stop)) == [("The",), ("then",)]


def test_lines(spark):
    frame = texts(spark, "a\r\nb\rc\n\nd\n", "x", "", "\n", None)
    got = frame.select(text_lines(F.col("text"))).collect()
    assert [r[0] for r in got] == [["a", "b", "c", "", "d"], ["x"], [], [""], []]


def test_best_lines_fill_up_with_misses(spark):
    frame = texts(spark, "no\nan x\nx", "x\nxx x")
    numbered = words.lines(frame, keep=["doc_id"])
    best = words.best_lines(numbered, "x", ["doc_id", "line_no"]).select("score", "line").collect()
    assert [tuple(r) for r in best] == [(3, "an x"), (0, "x"), (0, "x"), (0, "xx x"), (-1, "no")]


def test_best_lines_with_a_scorer_of_ones_own(spark):
    numbered = words.lines(texts(spark, "a\nbbb\ncc"), keep=["doc_id"])
    best = words.best_lines(numbered, "", ["line_no"], score=lambda line, _: F.length(line), limit=2)
    assert [r.line for r in best.collect()] == ["bbb", "cc"]


def test_index_of(spark):
    frame = spark.createDataFrame([("science",), ("a science",), ("none",), ("é science",)], "v string")
    assert [r[0] for r in frame.select(index_of(F.col("v"), "science")).collect()] == [0, 2, -1, 2]


@pytest.mark.parametrize("n", [1, 2, 7, 10, 30, 31, 100])
def test_length_part(spark, n):
    frame = spark.range(1, 80).select(F.repeat(F.lit("w"), F.col("id").cast("int")).alias("w"))
    got = [r[0] for r in frame.orderBy(F.length("w")).select(length_part(F.col("w"), n)).collect()]
    step = max(30 // n, 1)
    assert got == [min((length - 1) // step, n - 1) for length in range(1, 80)]


def test_upper_after_first_space(spark):
    frame = spark.createDataFrame([("Ann Lee",), ("Madonna",), ("Jan van Eyck",), (" x",), (None,)], "n string")
    got = [r[0] for r in frame.select(upper_after_first_space(F.col("n"))).collect()]
    assert got == ["Ann LEE", "Madonna", "Jan VAN EYCK", " X", None]
