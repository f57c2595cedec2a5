import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.functions.text import length_part
from millrace.operators import index
from millrace.sources import files, sinks

STOP = {"the", "a"}


def brute_positions(documents):
    found = []
    for doc_id, text in documents:
        for line_no, line in enumerate(line for line in text.split("\n") if line):
            for word_no, word in enumerate(line.split()):
                if word not in STOP:
                    found.append((doc_id, line_no, word_no, word))
    return sorted(found)


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(5)
    vocabulary = ["the", "a", "Ab", "cat", "dog", "x" * 12, "y" * 40, "zz"]
    texts = []
    for doc_id in range(60):
        lines = [" ".join(draw.choices(vocabulary, k=draw.randrange(0, 6))) for _ in range(draw.randrange(1, 8))]
        texts.append((doc_id, "\n".join(lines)))
    return texts


@pytest.fixture(scope="module")
def documents(spark, corpus):
    return spark.createDataFrame(corpus, "doc_id bigint, text string")


def test_positions(rows, documents, corpus):
    hits = index.word_positions(documents, STOP)
    assert rows(hits, "doc_id", "line_no", "word_no", "word") == sorted(brute_positions(corpus), key=repr)


def test_blank_lines_and_stop_words(spark, rows):
    frame = spark.createDataFrame([(7, "\nthe cat\n\n  \nThe dog")], "doc_id bigint, text string")
    hits = index.word_positions(frame, ["the"])
    assert rows(hits, "line_no", "word_no", "word") == [(0, 1, "cat"), (2, 0, "The"), (2, 1, "dog")]


def test_document_records(spark, rows):
    records = [('\n<Document id="12">\n\nthe cat\n\ndog',), ("\n\n\n",), ('<Document id="3">',)]
    frame = index.document_records(spark.createDataFrame(records, "value string"))
    assert rows(frame) == [(12, "the cat\ndog"), (3, "")]


def test_document_without_number_fails(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        index.document_records(spark.createDataFrame([("<Document>\nx",)], "value string")).collect()


def test_postings(documents, corpus):
    got = {(r.word, r.doc_id): (r.n, [tuple(p) for p in r.positions]) for r in index.postings(index.word_positions(documents, STOP)).collect()}
    want = {}
    for doc_id, line_no, word_no, word in brute_positions(corpus):
        want.setdefault((word, doc_id), []).append((line_no, word_no))
    assert got == {key: (len(places), places) for key, places in want.items()}


def test_document_postings_are_the_postings_of_all_texts(spark, rows, monkeypatch):
    """Ids once, repeated and null; equal texts; texts too long for a row, blank, null or without kept words."""
    monkeypatch.setattr(index, "IN_ROW", 40)
    texts = [
        (1, "cat the dog\n\ncat  cat\t dog\n the zz"), (2, "dog cat"), (2, "cat\ncat dog"), (3, "dog cat"), (3, "dog cat"),
        (None, "zz zz"), (None, "cat\nzz"), (4, "é cat\rÉ\x0bx " * 9), (5, ""), (6, None), (7, " the\n a"), (8, "\n \ncat"), (9, None), (9, "b"),
    ]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    table = spark.createDataFrame([(w,) for w in [*STOP, *STOP]], "word string")
    for some in (frame, frame.filter("doc_id IS NULL"), frame.limit(0), frame.filter("doc_id = 1")):
        want = index.postings(index.word_positions(some, STOP))
        for stop in (STOP, table):
            got = index.document_postings(some, stop)
            assert got.dtypes == want.dtypes and rows(got) == rows(want)
    other = frame.withColumnsRenamed({"doc_id": "id", "text": "body"})
    assert rows(index.document_postings(other, doc_id="id", text="body")) == rows(index.postings(index.word_positions(frame)))


def test_document_postings_shuffle_texts_once_and_no_hits(spark, tmp_path):
    """Texts of ids of their own are shuffled, once; what is grouped by word and document holds none of their hits."""
    letters = random.Random(3)
    texts = [(i, " ".join("".join(letters.choices("abcdefgh", k=4)) for _ in range(400))) for i in range(300)]
    spark.createDataFrame(texts, "doc_id bigint, text string").write.parquet(str(tmp_path / "texts"))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = index.document_postings(spark.read.parquet(str(tmp_path / "texts")))
        found.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    stages, sizes = [found._jdf.queryExecution().executedPlan()], []
    while stages:
        node = stages.pop()
        if node.nodeName() in ("AdaptiveSparkPlan", "ShuffleQueryStage"):
            stages.append(node.executedPlan() if node.nodeName() == "AdaptiveSparkPlan" else node.plan())
            continue
        if node.nodeName() == "Exchange":
            sizes.append(node.metrics().apply("shuffleRecordsWritten").value())
        stages.extend(node.children().apply(i) for i in range(node.children().size()))
    assert sum(n == 300 for n in sizes) <= 3 and sum(sizes) < 3000, sizes  # ids counted, counts and texts joined


def test_posting_lists_say_in_how_many_documents(documents):
    long_form = index.postings(index.word_positions(documents, STOP))
    found, want = index.posting_lists(long_form).collect(), long_form.collect()
    n_docs = Counter(r.word for r in want)
    assert sorted((r.word, r.doc_id, r.n, r.n_docs) for r in found) == sorted((r.word, r.doc_id, r.n, n_docs[r.word]) for r in want)


def test_stop_words_as_a_table(spark, documents):
    table = spark.createDataFrame([(w,) for w in [*STOP, *STOP]], "word string")
    listed = index.word_positions(documents, STOP)
    joined = index.word_positions(documents, table)
    assert joined.columns == listed.columns and sorted(joined.collect()) == sorted(listed.collect())


def test_counters(documents, corpus):
    hits = brute_positions(corpus)
    got = index.corpus_counters(documents, STOP).first()
    lines = sum(1 for _, text in corpus for line in text.split("\n") if line)
    assert tuple(got) == (len(hits), sum(h[3].startswith("A") for h in hits), lines)
    assert tuple(index.corpus_counters(documents.limit(0), STOP).first()) == (0, 0, 0)
    table = documents.sparkSession.createDataFrame([(w,) for w in STOP], "word string")
    assert tuple(index.corpus_counters(documents, table).first()) == tuple(got)
    assert tuple(index.corpus_counters(documents.limit(0), table).first()) == (0, 0, 0)


def test_layout_by_length(documents):
    words = index.word_positions(documents).select("word", "doc_id", "line_no", "word_no")
    placed = index.repartition_by_length(words, 10, split=3)
    assert placed.rdd.getNumPartitions() == 30
    homes = placed.select(F.spark_partition_id().alias("home"), "part", length_part(F.col("word"), 10).alias("want")).collect()
    assert len(homes) == words.count()
    assert all(r.home // 3 == r.part == r.want for r in homes)
    assert len({r.home for r in homes if r.part == 0}) == 3


def test_posting_files_read_as_one_report(spark, documents, corpus, tmp_path):
    table, text = str(tmp_path / "table"), str(tmp_path / "text")
    index.postings(index.word_positions(documents, STOP)).write.parquet(table)
    sinks.write_postings(spark.read.parquet(table), text, 10)

    places = {}
    for doc_id, line_no, word_no, word in brute_positions(corpus):
        places.setdefault(word, {}).setdefault(doc_id, []).append((line_no, word_no))
    for part in range(10):
        files_of_part = sorted((tmp_path / "text").glob(f"part={part}/part-*.txt"))
        got = "".join(f.read_text() for f in files_of_part)
        want = ""
        for word in sorted((w for w in places if min((len(w) - 1) // 3, 9) == part), key=lambda w: (-len(w), w)):
            docs = places[word]
            want += f"{word}\t{sum(map(len, docs.values()))}\n"
            for doc_id in sorted(docs):
                want += f"\t{doc_id} {len(docs[doc_id])}\n"
                want += "".join(f"\t\t{a} {b}\n" for a, b in docs[doc_id])
            want += "\n"
        assert got == want


def test_posting_files_without_ids_and_their_shuffle(spark, tmp_path):
    """Places of a null id have no document line; a place takes a few bytes of the shuffle, not a struct's 32."""
    table, text = str(tmp_path / "table"), str(tmp_path / "text")
    index.document_postings(spark.createDataFrame([(None, "cat\ncat"), (3, "cat")], "doc_id bigint, text string")).write.parquet(table)
    sinks.write_postings(spark.read.parquet(table), text, 10)
    assert "".join(f.read_text() for f in sorted((tmp_path / "text").glob("part=0/part-*.txt"))) == "cat\t3\n\t\t0 0\n\t\t1 0\n\t3 1\n\t\t0 0\n\n"
    piece = sinks.posting_pieces(spark.read.parquet(table)).filter("section = 1 AND doc_id IS NULL")
    assert piece.select(sinks._posting_numbers().alias("numbers")).first().numbers == "2\n0 0\n1 0"


def test_stop_word_file(spark, rows, tmp_path):
    path = tmp_path / "stop.txt"
    path.write_text("# a comment\nthe\na\nthe\n")
    assert rows(files.read_stop_words(spark, str(path))) == [("a",), ("the",)]


def test_default_stop_words(spark):
    assert index.stop_word_table(spark).count() == len(set(index.STOP_WORDS)) == 31
