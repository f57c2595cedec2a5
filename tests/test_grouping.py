from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.functions.maps import count_map
from millrace.operators.grouping import grouped, in_maps, looked_up, map_rows
from millrace.shared import kept, new_folder, written


@pytest.fixture(scope="module")
def skewed(spark):
    """A key with a third of all rows, most of them different, far above any list; copies; a null key."""
    hot = spark.range(60_000).select(F.lit("hot").alias("k"), F.when(F.col("id") < 3000, 0).otherwise(F.col("id")).alias("v"))
    rest = spark.range(120_000).select(F.concat(F.lit("k"), F.col("id") % 50).alias("k"), (F.col("id") % 240).alias("v"))
    none = spark.createDataFrame([(None, 1), (None, None), (None, 1)], "k string, v bigint")
    return hot.union(rest).union(none)


def test_groups_are_whole(skewed):
    want = Counter((r.k, r.v) for r in skewed.collect())
    entries, rows = Counter(k for k, _ in want), Counter()
    for (k, _), n in want.items():
        rows[k] += n
    got = grouped(skewed, ["k"], ["v"]).collect()
    assert {(r.k, r.v): r.copies for r in got} == want and len(got) == len(want)
    assert all((r.n_entries, r.n_rows) == (entries[r.k], rows[r.k]) for r in got)
    assert entries["hot"] == 57_001 and rows["hot"] == 60_000


def test_empty(skewed):
    assert grouped(skewed.limit(0), ["k"], ["v"]).count() == 0


def test_maps_are_whole_and_bounded(skewed):
    """A key with a third of all rows becomes many maps; entries come back as they were."""
    entries = skewed.filter("v IS NOT NULL").groupBy("k", "v").agg(F.count("*").alias("n"))
    maps = written(in_maps(entries, ["k"], "v", "n", size=500))
    sizes = maps.groupBy("k").agg(F.count("*").alias("maps"), F.max("n_maps").alias("n_maps"), F.max(F.size("entries")).alias("largest"))
    hot = sizes.filter("k = 'hot'").first()
    assert hot.n_maps == 115 and 100 < hot.maps <= 115 and hot.largest < 700
    assert sizes.filter("k <=> 'k1'").first().maps == 1
    back = map_rows(maps, ["k"], "v", "n")
    assert back.exceptAll(entries.select("k", "v", "n")).count() == 0 and back.count() == entries.count()


def test_lookups_in_maps(spark, skewed, rows):
    entries = skewed.groupBy("k", "v").agg(F.count("*").alias("n"))  # a null entry among them
    maps = in_maps(entries, ["k"], "v", "n", size=500)
    wanted = spark.createDataFrame([("hot", 0), ("hot", 59_999), ("hot", -1), ("k1", 1), ("none", 1), (None, 1), ("k1", None)], "k string, v bigint")
    known = {(r.k, r.v): r.n for r in entries.filter("v IS NOT NULL").collect()}
    want = sorted(((r.k, r.v, known.get((r.k, r.v))) for r in wanted.collect()), key=repr)
    assert rows(looked_up(wanted, maps, ["k"], "v", "n")) == want
    assert in_maps(entries.limit(0), ["k"], "v", "n").count() == 0


def test_count_maps(spark):
    lists = [[3, 1, 3, None, 2, 3], [], [None], [7], None]
    df = spark.createDataFrame([(x,) for x in lists], "a array<int>")
    got = [r.m for r in df.select(count_map(F.col("a")).alias("m")).collect()]
    assert got == [{1: 1, 2: 1, 3: 3}, {}, {}, {7: 1}, None]
    words = spark.createDataFrame([(["b", "a", "b"],)], "a array<string>")
    assert words.select(count_map(F.col("a"))).first()[0] == {"a": 1, "b": 2}


def test_kept_until_the_block_ends(spark):
    frame = spark.range(10)
    with kept(frame) as stored:
        assert stored.count() == 10 and stored.storageLevel.useMemory
    assert not frame.storageLevel.useMemory
    with pytest.raises(ZeroDivisionError), kept(frame):
        raise ZeroDivisionError
    assert not frame.storageLevel.useMemory
    assert new_folder(spark) != new_folder(spark)
    again = written(frame.withColumn("x", F.lit(None).cast("string")))
    assert again.schema["x"].dataType.simpleString() == "string" and again.count() == 10
