"""Text files out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import length_part
from millrace.operators.articles import render, revision_line


def write_key_values(df: DataFrame, path: str, key: str, value: str, n: int) -> None:
    """``n`` text files of ``key<tab>value`` lines, each sorted by key. Keys should be unique, as
    counts per key are, so that hashing them fills the files evenly."""
    placed = df.repartition(n, key).sortWithinPartitions(key)
    placed.select(F.concat(F.col(key), F.lit("\t"), F.col(value).cast("string")).alias("value")).write.text(path)


def posting_pieces(index: DataFrame) -> DataFrame:
    """The index's entries in pieces: ``word, section, doc_id, n, positions``.

    Section 0 is a word with its total, 1 a document with its count and its places, 2 the end of an
    entry. What a piece does not have is null.
    """
    totals = index.groupBy("word").agg(F.sum("n").alias("n"))
    frame = totals.select("word", F.explode(F.array(F.lit(0), F.lit(2))).alias("section"), "n")
    body = index.select("word", F.lit(1).alias("section"), F.col("doc_id").cast("bigint").alias("doc_id"), "n", "positions")
    return body.unionByName(frame, allowMissingColumns=True)


def _posting_numbers() -> Column:
    """A piece's numbers as short text: a word's total, or a document's count with a line per place."""
    places = F.transform("positions", lambda p: F.concat(p["line_no"].cast("string"), F.lit(" "), p["word_no"].cast("string")))
    return F.when(F.col("section") == 0, F.col("n").cast("string")).when(
        F.col("section") == 1, F.array_join(F.concat(F.array(F.col("n").cast("string")), places), "\n")
    )


def _posting_text() -> Column:
    """A piece as text from its ``numbers``: the word and its total, or a document and its count with a line per place, or
    an empty line. The last line end is the writer's."""
    head = F.concat("word", F.lit("\t"), F.col("numbers"))
    lines = F.replace(F.col("numbers"), F.lit("\n"), F.lit("\n\t\t"))
    document = F.concat(F.lit("\t"), F.col("doc_id").cast("string"), F.lit(" "), lines)
    places = F.regexp_replace(lines, r"\A[^\n]*\n", "")  # all there is of a document without an id
    document = F.coalesce(document, places)
    return F.when(F.col("section") == 0, head).when(F.col("section") == 1, document).otherwise("")


def write_postings(index: DataFrame, path: str, n: int = 10) -> None:
    """The index as text in directories ``part=0 .. part=n-1``, split by the byte length of the word.

    Within a part, longer words come first, then byte order; the files of a part continue each
    other in name order. Rows are split by range down to the document, so neither a crowded length
    nor a word found everywhere ends up in one task. Their numbers are shuffled as text, which takes
    less than structs, and without what the other columns say. Reads ``index`` more than once, so pass a written one.
    """
    order = ["part", F.desc("n_bytes"), "word", "section", "doc_id"]
    keys = {"part": length_part(F.col("word"), n), "n_bytes": F.octet_length("word")}
    placed = posting_pieces(index).select("word", "section", "doc_id", _posting_numbers().alias("numbers")).withColumns(keys)
    ranged = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.select("part", _posting_text().alias("text")).write.partitionBy("part").text(path)


def write_articles(articles: DataFrame, path: str) -> None:
    """Each article's text rendering; its last line end is the writer's."""
    articles.select(F.regexp_replace(render(), r"\n\z", "").alias("value")).write.text(path)


def write_revisions(revisions: DataFrame, path: str) -> None:
    """The text of ``write_articles`` from a row per revision: sorted by article and ``rid``, no article as one record."""
    line = revision_line(F.struct("rid", "contributor", "ts"))
    heads = revisions.select("aid", "title").distinct()
    heads = heads.select("aid", "title", F.lit(0).alias("section"), F.lit(0).cast("bigint").alias("rid"), F.concat_ws(",", "aid", "title").alias("value"))
    body = revisions.select("aid", "title", F.lit(1).alias("section"), F.col("rid").cast("bigint").alias("rid"), line.alias("value"))
    keys = ["aid", "title", "section", "rid"]
    heads.union(body).repartitionByRange(*keys).sortWithinPartitions(*keys).select("value").write.text(path)


def _little_endian(number: Column, size: int) -> Column:
    """A number as hexadecimal digits of ``size`` bytes, the lowest first."""
    digits = F.lpad(F.hex(F.pmod(number.cast("bigint"), F.lit(1 << 8 * size))), 2 * size, "0")
    return F.concat(*[digits.substr(2 * i + 1, 2) for i in reversed(range(size))])


def _bitmap_head(width: Column, height: Column, stride: Column) -> Column:
    """The two headers of an uncompressed bitmap of three bytes a pixel whose first line is on top, in hexadecimal digits."""
    fields = (
        (14 + 40 + stride * height, 4), (F.lit(0), 4), (F.lit(14 + 40), 4),  # size, reserved, where the pixels begin
        (F.lit(40), 4), (width, 4), (-height, 4), (F.lit(1), 2), (F.lit(24), 2), (F.lit(0), 4), (stride * height, 4),
        (F.lit(2835), 4), (F.lit(2835), 4), (F.lit(0), 4), (F.lit(0), 4),
    )
    return F.concat(F.hex(F.lit("BM")), *[_little_endian(F.lit(0) + value, size) for value, size in fields])


def write_photos(pixels: DataFrame, path: str) -> None:
    """A pixel table (``image_id, width, height, x, y, rgb``) as bitmap files, in a directory ``image_id=...`` per image.

    Pixels become lines and lines an image, which is one file and one record. Spark's text writer writes the bytes of a
    value as they are; the line end it adds lies past the bitmap's size, where readers do not look.
    """
    digits = F.lpad(F.hex(F.pmod(F.col("rgb").cast("bigint"), F.lit(1 << 24))), 6, "0")
    pixel = F.concat(digits.substr(5, 2), digits.substr(3, 2), digits.substr(1, 2))
    padding = F.pmod(-3 * F.col("width"), F.lit(4))
    image = ["image_id", "width", "height"]
    cells = F.sort_array(F.collect_list(F.struct("x", pixel.alias("digits"))))
    lines = pixels.groupBy(*image, "y").agg(cells.alias("cells"))
    lines = lines.select(*image, "y", F.concat(F.array_join("cells.digits", ""), F.repeat(F.lit("00"), padding.cast("int"))).alias("line"))
    whole = lines.groupBy(*image).agg(F.sort_array(F.collect_list(F.struct("y", "line"))).alias("lines"))
    stride = 3 * F.col("width") + padding
    bitmap = F.concat(_bitmap_head(F.col("width"), F.col("height"), stride), F.array_join("lines.line", ""))
    whole.select("image_id", F.unhex(bitmap).cast("string").alias("value")).write.partitionBy("image_id").text(path)


def preview(df: DataFrame, n: int = 10, schema: bool = False) -> DataFrame:
    """The first ``n`` rows; ``schema`` prints the schema too."""
    if schema:
        df.printSchema()
    return df.limit(n)
