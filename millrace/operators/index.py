"""Positional inverted index."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import length_part, nonblank_lines, tokens
from millrace.operators.grouping import with_totals

# The default stop words.
STOP_WORDS = (
    "I a about an are as at be by com for from how in is it of on or that the this to was what when "
    "where who will with www"
).split()

IN_ROW = 1 << 20  # bytes of a text that is indexed within its row; bounds what a row holds, not what is indexed


def stop_word_table(spark: SparkSession) -> DataFrame:
    """The default stop words as a table ``word``, small enough by its plan to be broadcast."""
    return spark.range(1).select(F.explode(F.array(*[F.lit(word) for word in STOP_WORDS])).alias("word"))


def word_positions(
    documents: DataFrame, stop_words: Iterable[str] | DataFrame = (), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row ``doc_id, line_no, word_no, word`` per word, both numbers from zero.

    Empty lines are not numbered. Words are numbered within their line before stop words go. A table of
    stop words (``word``) may be of any size; it is joined, and no list of it is made.
    """
    numbered = documents.select(
        F.col(doc_id).alias("doc_id"), F.posexplode(nonblank_lines(F.col(text))).alias("line_no", "line")
    )
    hits = numbered.select("doc_id", "line_no", F.posexplode(tokens(F.col("line"))).alias("word_no", "word"))
    if isinstance(stop_words, DataFrame):
        return hits.join(stop_words.select("word"), "word", "left_anti").select(*hits.columns)
    stop_words = list(stop_words)
    return hits.filter(~F.col("word").isin(stop_words)) if stop_words else hits


def document_records(records: DataFrame) -> DataFrame:
    """``doc_id, text`` from records whose first non-empty line holds the id between double quotes.

    Records of line ends only (the tail of a file) are dropped; an id that is no number fails.
    """
    parts = records.select(nonblank_lines(F.col("value")).alias("lines")).filter(F.size("lines") > 0)
    return parts.select(
        F.regexp_extract(F.col("lines")[0], '"([^"]*)"', 1).cast("bigint").alias("doc_id"),
        F.array_join(F.slice("lines", F.lit(2), F.size("lines")), "\n").alias("text"),
    )


def doc_counts(hits: DataFrame) -> DataFrame:
    """``word, doc_id, n``."""
    return hits.groupBy("word", "doc_id").agg(F.count(F.lit(1)).alias("n"))


def totals(hits: DataFrame) -> DataFrame:
    """``word, total, n_docs``."""
    return doc_counts(hits).groupBy("word").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("n_docs"))


def postings(hits: DataFrame) -> DataFrame:
    """The index in long form: ``word, doc_id, n, positions array<struct<line_no, word_no>>``.

    A list holds the hits of one word in one document, so it is no larger than the document.
    """
    # One bigint per hit through the shuffle in place of a struct; it sorts in text order.
    place = F.shiftleft(F.col("line_no").cast("bigint"), 32).bitwiseOR(F.col("word_no").cast("bigint"))
    grouped = hits.groupBy("word", "doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(place)).alias("places")
    )
    unpacked = F.transform(
        "places",
        lambda p: F.struct(
            F.shiftright(p, 32).cast("int").alias("line_no"),
            p.bitwiseAND(F.lit(0xFFFFFFFF)).cast("int").alias("word_no"),
        ),
    )
    return grouped.select("word", "doc_id", "n", unpacked.alias("positions"))


def document_postings(
    documents: DataFrame, stop_words: Iterable[str] | DataFrame = (), doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The ``postings`` of the documents' ``word_positions``, without a shuffle or a sort of all hits.

    A text of up to ``IN_ROW`` bytes whose id no other text has is indexed within its row. Longer ones and those that
    share an id (null is one) go through ``word_positions`` and ``postings``. Only texts are shuffled, to count their ids.
    """
    texts = documents.select(doc_id, text)
    texts = texts if texts.columns == ["doc_id", "text"] else texts.toDF("doc_id", "text")
    counted = with_totals(texts, ["doc_id"], n_texts=F.count(F.lit(1)))
    in_row = (F.col("n_texts") == 1) & (F.octet_length("text") <= IN_ROW)  # null for a null text, which has no words
    # Two columns, not two filters: those would be moved before the shuffle, and the texts be shuffled once for each.
    alone, others = F.when(in_row, F.col("text")), F.when(in_row, None).otherwise(F.col("text"))
    rest = postings(word_positions(counted.select("doc_id", others.alias("text")), stop_words))
    return _row_postings(counted.select("doc_id", alone.alias("text")), stop_words).unionByName(rest)


def _row_postings(documents: DataFrame, stop_words: Iterable[str] | DataFrame) -> DataFrame:
    """``postings`` of texts each of which is alone under its id: a row's hits sorted and cut where the word changes."""

    def line_hits(line: Column, line_no: Column) -> Column:
        return F.transform(tokens(line), lambda word, word_no: F.struct(word.alias("word"), line_no.alias("line_no"), word_no.alias("word_no")))

    hits = F.flatten(F.transform(nonblank_lines(F.col("text")), line_hits))
    listed = [] if isinstance(stop_words, DataFrame) else list(stop_words)
    if listed:
        hits = F.filter(hits, lambda hit: ~hit["word"].isin(listed))
    texts = documents.select("doc_id", F.sort_array(hits).alias("hits"))

    hit, n_hits = F.col("hits"), F.size("hits")
    numbers = F.slice(F.sequence(F.lit(0), n_hits), F.lit(1), n_hits)
    starts = F.filter(numbers, lambda i: (i == 0) | (F.get(hit, i)["word"] != F.get(hit, i - 1)["word"]))

    def entry(start: Column, i: Column) -> Column:
        n = F.coalesce(F.get("starts", i + 1), n_hits) - start
        places = F.transform(F.slice(hit, start + 1, n), lambda h: F.struct(h["line_no"].alias("line_no"), h["word_no"].alias("word_no")))
        return F.struct(F.get(hit, start)["word"].alias("word"), n.cast("bigint").alias("n"), places.alias("positions"))

    entries = texts.withColumn("starts", starts).select("doc_id", F.inline(F.transform("starts", entry)))
    found = entries.select("word", "doc_id", "n", "positions")
    return found.join(stop_words.select("word"), "word", "left_anti").select(*found.columns) if isinstance(stop_words, DataFrame) else found


def posting_lists(index: DataFrame) -> DataFrame:
    """``word, doc_id, n, positions, n_docs``: the documents of each word, beside their number.

    Reads ``index`` twice, so pass a written one where that is dear.
    """
    return with_totals(index, ["word"], n_docs=F.count(F.lit(1)))


def corpus_counters(documents: DataFrame, stop_words: Iterable[str] | DataFrame, text: str = "text") -> DataFrame:
    """Kept words, kept words starting with ``A``, and non-empty lines.

    One pass over the texts with a list of stop words; a table of them is joined to the words' counts.
    """
    if isinstance(stop_words, DataFrame):
        counts = documents.select(F.explode(tokens(F.col(text))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
        kept = counts.join(stop_words.select("word"), "word", "left_anti")
        a_words = F.when(F.col("word").startswith("A"), F.col("n")).otherwise(0)
        none = F.lit(0).cast("bigint")
        words = kept.select(F.col("n").alias("n_words"), a_words.alias("n_a_words"), none.alias("n_lines"))
        lines = documents.select(none, none, F.size(nonblank_lines(F.col(text))).cast("bigint"))
        both = words.union(lines)
        return both.agg(*[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in both.columns])
    stop_words = list(stop_words)
    found = tokens(F.col(text))
    kept = F.filter(found, lambda word: ~word.isin(stop_words)) if stop_words else found
    per_text = documents.select(
        kept.alias("kept"),
        F.size(nonblank_lines(F.col(text))).alias("lines"),
    )
    a_words = F.size(F.filter("kept", lambda word: word.startswith("A")))
    sums = per_text.select(F.size("kept").alias("kept"), a_words.alias("a_words"), "lines").agg(
        F.sum("kept").alias("n_words"), F.sum("a_words").alias("n_a_words"), F.sum("lines").alias("n_lines")
    )
    return sums.select(*[F.coalesce(name, F.lit(0)).alias(name) for name in sums.columns])


def part_sizes(stream: DataFrame, n: int) -> DataFrame:
    """Distinct words in each of ``n`` length parts, ``part, n_words``."""
    parts = stream.select("word").distinct().select(length_part(F.col("word"), n).alias("part"))
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("n_words"))


def repartition_by_length(df: DataFrame, n: int, split: int = 8) -> DataFrame:
    """Place rows by the length part of ``word``, each part on ``split`` partitions of its own.

    Adds ``part``. Partition ``part * split + i`` holds slice ``i`` of a part. Word lengths are far
    from even, so ``split=1`` (one partition per part) puts most rows on a few tasks.
    """
    row = F.pmod(F.xxhash64(*df.columns), F.lit(split)).cast("int")
    placed = df.withColumn("part", length_part(F.col("word"), n)).withColumn("_slice", row)
    return placed.repartitionById(n * split, F.col("part") * split + F.col("_slice")).drop("_slice")
