"""Scans and sinks that no other test covers."""

from millrace.sources import files, sinks


def test_key_value_files(spark, tmp_path):
    counts = spark.createDataFrame([(f'w"{i}', i) for i in range(200)], "word string, n bigint")
    sinks.write_key_values(counts, str(tmp_path / "out"), "word", "n", 2)
    parts = sorted((tmp_path / "out").glob("part-*"))
    lines = [p.read_text().splitlines() for p in parts]
    assert len(parts) == 2 and min(map(len, lines)) > 50
    for part in lines:
        keys = [line.split("\t")[0] for line in part]
        assert keys == sorted(keys)
    assert sorted(line for part in lines for line in part) == sorted(f'w"{i}\t{i}' for i in range(200))


def test_lines_keep_file_order(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.txt").write_text("".join(f"{name}{i}\n" for i in range(300)))
    got = [r.line for r in files.read_lines(spark, str(tmp_path)).orderBy("place").collect()]
    assert got == [f"{name}{i}" for name in "ab" for i in range(300)]


def test_document_files(spark, rows, tmp_path):
    (tmp_path / "d.txt").write_text('<Document id="1">\nthe cat\n\n</Document>\n<Document id="22">dog\nx\n</Document>\n\n')
    assert rows(files.read_documents(spark, str(tmp_path))) == [(1, "the cat"), (22, "x")]


def test_records_of_nothing_are_dropped(spark, tmp_path):
    (tmp_path / "r.txt").write_text("a;;b;")
    assert sorted(r[0] for r in files.read_records(spark, str(tmp_path), ";").collect()) == ["a", "b"]


def test_csv_with_and_without_types(spark, tmp_path):
    (tmp_path / "t.csv").write_text("n,year\n1,2001\n2,n/a\n")
    assert dict(files.read_csv_with_header(spark, str(tmp_path)).dtypes) == {"n": "int", "year": "string"}
    typed = files.read_csv_with_header(spark, str(tmp_path), schema="n bigint, year string")
    assert [tuple(r) for r in typed.orderBy("n").collect()] == [(1, "2001"), (2, "n/a")]
