"""Splitting, matching and rewriting strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The five characters a word is split on. Not ``\s``, which also holds the vertical tab.
WHITESPACE = r"[ \t\n\r\f]+"


def tokens(text: Column) -> Column:
    """Array of the whitespace-separated words of a string."""
    return F.filter(F.split(text, WHITESPACE), lambda word: word != "")


def nonblank_lines(text: Column) -> Column:
    """Array of the non-empty lines; a line of spaces only is not empty."""
    return F.filter(F.split(text, "\n"), lambda line: line != "")


def text_lines(text: Column) -> Column:
    """Array of all lines, ended by ``\\n``, ``\\r`` or both; nothing follows a closing line end."""
    parts = F.split(F.regexp_replace(text, r"(\r\n|\r|\n)\z", ""), r"\r\n|\r|\n")
    return F.when(text != "", parts).otherwise(F.array().cast("array<string>"))


def is_letters(word: Column) -> Column:
    """True if the whole word is made of English letters."""
    return word.rlike(r"\A[a-zA-Z]+\z")


def index_of(text: Column, target: str) -> Column:
    """Zero-based index of the first ``target`` in ``text``, or -1."""
    return F.instr(text, target) - 1


def upper_after_first_space(name: Column) -> Column:
    """Upper-case everything behind the first space; a name of one word is unchanged."""
    space = F.instr(name, " ")
    return F.when(
        space > 0, F.concat(F.substring(name, F.lit(1), space), F.upper(F.substring(name, space + 1, F.length(name))))
    ).otherwise(name)


def length_part(word: Column, n: int) -> Column:
    """Part ``0 .. n-1`` for a word by its length in bytes, the longest words in the last part."""
    longest = 30  # fixed value: lengths up to this many bytes are spread over the parts
    step = max(longest // n, 1)
    part = F.floor((F.octet_length(word) - 1) / F.lit(step))
    return F.greatest(F.least(part, F.lit(n - 1)), F.lit(0)).cast("int")
