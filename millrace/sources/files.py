"""Text, table and photo files in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.articles import parse_pages, parse_revisions
from millrace.operators.index import document_records

PERSON_SCHEMA = "name string, gender string, birth_year int"
CAR_COLUMNS = ("buying", "maintain", "doors", "persons", "boot", "safety", "label")
# Header names of a film file and the names used here.
FILM_COLUMNS = {
    "Title": "title",
    "Release Year": "release_year",
    "Locations": "location",
    "Production Company": "company",
    "Distributor": "distributor",
    "Director": "director",
    "Writer": "writer",
    "Actor 1": "actor1",
    "Actor 2": "actor2",
    "Actor 3": "actor3",
}


def read_records(spark: SparkSession, path: str | list[str], end: str) -> DataFrame:
    """Text cut at every ``end``, as one column ``value``; records of no characters are dropped."""
    return spark.read.option("lineSep", end).text(path).filter("value <> ''")


def read_page_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``value``: text up to and with each ``</page>``. What follows the last page is a record too,
    without a revision, and goes when pages are parsed."""
    return read_records(spark, path, "</page>").select(F.concat("value", F.lit("</page>")).alias("value"))


def read_articles(spark: SparkSession, path: str | list[str], strict: bool = True) -> DataFrame:
    """Articles with at least one revision from page markup."""
    return parse_pages(read_page_records(spark, path), strict=strict)


def read_revisions(spark: SparkSession, path: str | list[str], strict: bool = True) -> DataFrame:
    """Revisions from page markup, a row each, when the articles as such are not needed."""
    return parse_revisions(read_page_records(spark, path), strict=strict)


def read_documents(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``doc_id, text`` from files of ``<Document id="...">`` records."""
    return document_records(read_records(spark, path, "</Document>"))


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``place, line``; ``place`` sorts as the lines stand in their files."""
    lines = spark.read.text(path)
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return lines.select(place.alias("place"), F.col("value").alias("line"))


def read_stop_words(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Distinct ``word``; lines starting with ``#`` are comments."""
    return spark.read.text(path).filter(~F.col("value").startswith("#")).select(F.col("value").alias("word")).distinct()


def read_csv_with_header(spark: SparkSession, path: str | list[str], schema: str | None = None) -> DataFrame:
    """CSV with a header line. Without a ``schema`` types are inferred, which reads the files twice."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def read_films(spark: SparkSession, path: str | list[str], infer: bool = False) -> DataFrame:
    """Film records with the columns of ``operators.films``.

    All columns are text; ``films.clean`` makes the year a number. ``infer`` lets Spark look at the
    values first, in one more pass, and changes those it takes for numbers: ``007`` becomes ``7``.
    """
    reader = spark.read.option("header", True).option("inferSchema", infer)
    table = reader.csv(path)
    return table.select(*[F.col(f"`{old}`").cast("string").alias(new) for old, new in FILM_COLUMNS.items()])


def read_csv_without_header(spark: SparkSession, path: str | list[str], names: Sequence[str]) -> DataFrame:
    """CSV of text columns named by position."""
    return spark.read.schema(", ".join(f"`{name}` string" for name in names)).csv(path)


def read_cars(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return read_csv_without_header(spark, path, CAR_COLUMNS)


def read_people(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``name, gender, birth_year, place``; a malformed line fails the query. ``place`` gives the
    order of the file."""
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    table = spark.read.schema(PERSON_SCHEMA).option("mode", "FAILFAST").csv(path)
    return table.select("*", place.alias("place"))


def read_photos(spark: SparkSession, path: str | list[str], strict: bool = True) -> DataFrame:
    """Photo files as a pixel table; ``image_id`` is the path and any alpha channel is dropped.

    Spark decodes the files on the executors. Bytes become numbers by way of Latin-1, in which
    byte and code point are the same, one image line at a time. A file that is no photo fails the
    query; with ``strict=False`` it is left out.
    """
    image = spark.read.format("image").option("dropInvalid", not strict).load(path).select("image.*")
    if strict:  # the reader marks a broken file with a height of -1
        broken = F.raise_error(F.concat(F.lit("not a photo: "), F.col("origin"))).cast("int")
        image = image.withColumn("height", F.when(F.col("height") < 0, broken).otherwise(F.col("height")))
    line_bytes = F.col("width") * F.col("nChannels")
    lines = image.select(
        F.col("origin").alias("image_id"), "width", "height", "nChannels", "data",
        F.explode(F.sequence(F.lit(0), F.col("height") - 1)).alias("y"),
    ).select(
        "image_id", "width", "height", "nChannels", "y",
        F.decode(F.substring("data", F.col("y") * line_bytes + 1, line_bytes), "ISO-8859-1").alias("line"),
    )
    values = lines.withColumn("v", F.transform(F.split("line", ""), F.ascii))
    cell = values.select(
        "image_id", "width", "height", "y", "nChannels", "v",
        F.explode(F.sequence(F.lit(0), F.col("width") - 1)).alias("x"),
    )
    first = F.col("x") * F.col("nChannels")
    blue = F.get("v", first)
    green = F.when(F.col("nChannels") >= 3, F.get("v", first + 1)).otherwise(blue)
    red = F.when(F.col("nChannels") >= 3, F.get("v", first + 2)).otherwise(blue)
    packed = F.shiftleft(red, 16) + F.shiftleft(green, 8) + blue
    return cell.select("image_id", "width", "height", "x", "y", packed.cast("int").alias("rgb"))
