import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.operators import categories
from millrace.sources import files


@pytest.fixture(scope="module")
def cars(spark):
    """The label follows from two of the features, so that a tree can learn it."""
    def of(divisor, *choices):
        return F.element_at(F.array(*map(F.lit, choices)), (F.floor(F.col("id") / divisor) % len(choices) + 1).cast("int"))

    frame = spark.range(1600).select(
        "id", of(1, "vhigh", "high", "med", "low").alias("buying"), of(4, "high", "low").alias("maintain"),
        of(8, "2", "3", "4").alias("doors"), of(24, "2", "more").alias("persons"), of(48, "small", "big").alias("boot"),
        of(7, "low", "med", "high").alias("safety"),
    )
    return frame.withColumn("label", F.when(F.expr("safety = 'low' OR persons = '2'"), "unacc").otherwise("acc"))


FEATURES = ["buying", "maintain", "doors", "persons", "boot", "safety"]


def test_index_order(spark, rows):
    frame = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "f string")
    assert rows(categories.category_indices(frame, ["f"])) == [("f", "a", 1.0), ("f", "b", 2.0), ("f", "c", 0.0)]


def test_one_hot_drops_the_last(spark):
    frame = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "f string")
    coded = categories.one_hot(frame, ["f"]).select("f", vector_to_array("f_vec")).distinct()
    assert {r[0]: r[1] for r in coded.collect()} == {"c": [1.0, 0.0], "a": [0.0, 1.0], "b": [0.0, 0.0]}


def test_one_hot_of_columns_of_different_sizes(cars):
    coded = categories.one_hot(cars, FEATURES)
    sizes = coded.select(*[F.size(vector_to_array(f"{f}_vec")) for f in FEATURES]).first()
    assert list(sizes) == [3, 1, 2, 1, 1, 2]


def test_many_values(spark):
    """More values than a driver should list; half of them come twice, so they are first."""
    ids = spark.range(150_000).select(F.format_string("v%06d", "id").alias("f"))
    ranked = categories.category_indices(ids.union(ids.where("f < 'v075000'")), ["f"])
    assert ranked.count() == 150_000
    assert ranked.where("value <> format_string('v%06d', cast(idx AS bigint))").count() == 0


def test_nulls_and_empty_tables(spark, rows):
    frame = spark.createDataFrame([("b", None), (None, None), ("a", None)], "f string, g string")
    assert rows(categories.category_indices(frame, ["f", "g"])) == [("f", "a", 0.0), ("f", "b", 1.0)]
    assert {r.f: r.f_idx for r in categories.one_hot(frame, ["f"]).collect()} == {"a": 0.0, "b": 1.0, None: None}
    assert categories.category_indices(frame.limit(0), ["f"]).count() == 0


def test_indices_are_those_of_a_fitted_indexer(cars):
    fitted = StringIndexer(inputCols=FEATURES, outputCols=[f"{f}_i" for f in FEATURES]).fit(cars)
    want = {(f, value, float(i)) for f, labels in zip(FEATURES, fitted.labelsArray, strict=True) for i, value in enumerate(labels)}
    assert {tuple(r) for r in categories.category_indices(cars, FEATURES).collect()} == want


def test_value_unknown_to_the_training_side(spark, cars):
    model = categories.train_tree(cars, FEATURES, "label")
    odd = cars.limit(5).withColumn("buying", F.lit("free"))
    assert model.transform(odd).count() == 5


def test_split_is_disjoint_whole_and_stable(cars):
    first, second = categories.split_rows(cars, 0.7, seed=3)
    assert first.unionAll(second).exceptAll(cars).count() == 0
    assert first.count() + second.count() == cars.count() and 0.65 < first.count() / cars.count() < 0.75
    again, _ = categories.split_rows(cars.repartition(9), 0.7, seed=3)
    assert again.exceptAll(first).count() == 0
    other, _ = categories.split_rows(cars, 0.7, seed=4)
    assert other.exceptAll(first).count() > 0


def test_tree(cars):
    training, test = categories.split_rows(cars, 0.7, seed=3)
    scored = categories.train_tree(training, FEATURES, "label").transform(test)
    row = categories.accuracy(scored, "label_idx").first()
    evaluator = MulticlassClassificationEvaluator(labelCol="label_idx", predictionCol="prediction", metricName="accuracy")
    assert row.accuracy == pytest.approx(evaluator.evaluate(scored))
    assert row.accuracy > 0.99 and row.n == test.count()


def test_csv_without_header(spark, rows, tmp_path):
    path = tmp_path / "cars.csv"
    path.write_text("vhigh,vhigh,2,2,small,low,unacc\nlow,low,5more,more,big,high,vgood\n")
    table = files.read_cars(spark, str(path))
    assert table.columns == list(files.CAR_COLUMNS)
    assert rows(table, "doors", "label") == [("2", "unacc"), ("5more", "vgood")]
