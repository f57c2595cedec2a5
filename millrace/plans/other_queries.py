"""Queries over people, points, categories and pixels."""

from __future__ import annotations

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.functions import pixels as px
from millrace.operators import categories, cohort, points, raster
from millrace.plans.registry import query
from millrace.plans.views import oracle, table, view
from millrace.shared import new_folder, written
from millrace.sources import files, sinks

# People.

PROJECTED = """
SELECT *, CASE WHEN lifestyle < 0.56 THEN 'poverty' WHEN lifestyle < 1.0 THEN 'modest'
               WHEN lifestyle IS NOT NULL THEN 'comfortable' END AS band
FROM (SELECT *, balance / nullif(retirement_years, 0) AS lifestyle FROM (
  SELECT *, death_age - retirement_age AS retirement_years,
         list_reduce(range(working_years)::DOUBLE[], lambda saved, i: saved * rate + contribution / 100.0::DOUBLE, 0.0::DOUBLE) AS balance
  FROM (SELECT *, retirement_age - start_age AS working_years,
               CASE WHEN gender = 'male' THEN 79 + (2018 - birth_year) // 20 ELSE 83 + (2018 - birth_year) // 30 END AS death_age,
               CASE lower(strategy) WHEN 'growth' THEN 1.045::DOUBLE WHEN 'balanced' THEN 1.035::DOUBLE
                    WHEN 'conservative' THEN 1.025::DOUBLE WHEN 'cash' THEN 1.01::DOUBLE END AS rate
        FROM people JOIN plans USING (name))))
"""


def _projected(spark, folder):
    return cohort.project(view(spark, folder, "people"), view(spark, folder, "plans"))


@query(
    "cohort_report",
    oracle(
        "SELECT name, gender, birth_year, start_age, retirement_age, working_years, strategy, contribution, "
        "round(balance, 1) AS payout, death_age, retirement_years, round(lifestyle * 100.0, 1) AS percent, band FROM projected",
        "people",
        "plans",
        projected=PROJECTED,
    ),
)
def cohort_report(spark, folder):
    return cohort.report(_projected(spark, folder))


@query(
    "cohort_summary",
    oracle(
        "SELECT strategy, band, count(*) AS n, round(avg(balance), 6) AS mean_balance FROM projected GROUP BY strategy, band",
        "people",
        "plans",
        projected=PROJECTED,
    ),
)
def cohort_summary(spark, folder):
    return cohort.summary(_projected(spark, folder)).withColumn("mean_balance", F.round("mean_balance", 6))


@query(
    "person_lookup",
    oracle(
        "SELECT c_name AS name, gender, birth_year FROM customer LEFT JOIN ("
        "SELECT name, arg_min(gender, place) AS gender, arg_min(birth_year, place) AS birth_year FROM register GROUP BY name"
        ") AS first ON first.name = c_name",
        "register",
    ),
)
def person_lookup(spark, folder):
    """The first entry of every customer in a register in which names repeat; some have none."""
    names = table(spark, folder, "customer").select(F.col("c_name").alias("name"))
    return cohort.find_people(names, view(spark, folder, "register"), order=["place"])


@query(
    "person_file_lookup",
    oracle("SELECT name, gender, birth_year FROM people", "people"),
)
def person_file_lookup(spark, folder):
    """People written as CSV without a header, and each looked up in the file."""
    path = new_folder(spark)
    people = view(spark, folder, "people")
    people.write.csv(path)
    return cohort.find_people(people, files.read_people(spark, path), order=["place"], missing="raise")


# Points.

HITS = "SELECT grp, count(*) FILTER (WHERE x * x + y * y <= 1) AS hits, count(*) AS points FROM points GROUP BY grp"


@query("circle_hits", oracle(HITS, "points"))
def circle_hits(spark, folder):
    return points.circle_hits(view(spark, folder, "points"))


@query(
    "circle_ratio",
    oracle(
        "SELECT cast(sum(hits) AS bigint) AS hits, cast(sum(points) AS bigint) AS points, "
        "round(4.0::DOUBLE * sum(hits) / sum(points), 9) AS ratio FROM hits",
        "points",
        hits=HITS,
    ),
)
def circle_ratio(spark, folder):
    ratio = points.circle_ratio(points.circle_hits(view(spark, folder, "points")))
    return ratio.withColumn("ratio", F.round("ratio", 9))


# Categories.

FEATURES = ("buying", "maintain", "doors", "persons", "boot", "safety")
INDEX = """
SELECT feature, value, cast(row_number() OVER (PARTITION BY feature ORDER BY count(*) DESC, value) - 1 AS double) AS idx
FROM (UNPIVOT cars ON buying, maintain, doors, persons, boot, safety, label INTO NAME feature VALUE value)
GROUP BY feature, value
"""


@query("label_index", oracle(INDEX, "cars"))
def label_index(spark, folder):
    return categories.category_indices(view(spark, folder, "cars"), [*FEATURES, "label"])


def _slots(feature: str) -> str:
    last = f"(SELECT max(idx) FROM indexed WHERE feature = '{feature}')"
    return f"CASE WHEN {feature}_i.idx = {last} THEN '' ELSE cast(cast({feature}_i.idx AS int) AS string) END AS {feature}"


@query(
    "one_hot",
    oracle(
        "SELECT row_order, row_part, row_supplier, "
        + ", ".join(_slots(f) for f in FEATURES)
        + " FROM cars "
        + " ".join(f"JOIN indexed {f}_i ON {f}_i.feature = '{f}' AND {f}_i.value = cars.{f}" for f in FEATURES),
        "cars",
        indexed=INDEX,
    ),
)
def one_hot(spark, folder):
    """For every row the slot that is set in each feature's vector, none for the last category."""
    coded = categories.one_hot(view(spark, folder, "cars"), FEATURES)

    def slot(feature):
        place = F.array_position(vector_to_array(f"{feature}_vec"), 1.0) - 1
        return F.when(place >= 0, place.cast("string")).otherwise("").alias(feature)

    return coded.select("row_order", "row_part", "row_supplier", *[slot(f) for f in FEATURES])


ROW = ["row_order", "row_part", "row_supplier", "doors"]


def _sides(spark, folder):
    return categories.split_rows(view(spark, folder, "cars"), 0.7, seed=7, keys=ROW)


def _scored(spark, folder):
    training, test = _sides(spark, folder)
    return categories.train_tree(training, FEATURES, "label").transform(test)


DRAW_SQL = "('0x' || md5(concat_ws('|', row_order, row_part, row_supplier, doors, '7'))[:8])::BIGINT % 1000000"
HELD = f"SELECT * FROM cars WHERE {DRAW_SQL} >= 700000"
LABELS = f"""
SELECT label, cast(row_number() OVER (ORDER BY count(*) DESC, label) - 1 AS double) AS label_idx
FROM cars WHERE {DRAW_SQL} < 700000 GROUP BY label
"""


@query(
    "tree_accuracy",
    oracle("SELECT count(*) AS n, true AS evaluators_agree FROM held", "cars", held=HELD),
)
def tree_accuracy(spark, folder):
    """The held-out rows scored, and whether MLlib's evaluator finds the same accuracy in them."""
    scored = written(_scored(spark, folder).select("label_idx", "prediction"))
    known = MulticlassClassificationEvaluator(labelCol="label_idx", metricName="accuracy").evaluate(scored)
    return categories.accuracy(scored, "label_idx").select("n", (F.abs(F.col("accuracy") - known) < 1e-9).alias("evaluators_agree"))


@query(
    "tree_predictions",
    oracle(
        "SELECT row_order, row_part, row_supplier, doors, label, label_idx, true AS known FROM held JOIN labels USING (label)",
        "cars",
        held=HELD,
        labels=LABELS,
    ),
)
def tree_predictions(spark, folder):
    """The held-out rows with their label's index, and whether the prediction is some label's index."""
    training, test = _sides(spark, folder)
    model = categories.train_tree(training, FEATURES, "label")
    known = F.col("prediction").isin(*map(float, range(len(model.stages[-2].labels))))
    return model.transform(test).select(*ROW, "label", "label_idx", known.alias("known"))


@query(
    "tree_single_feature",
    oracle(
        "SELECT row_order, row_part, row_supplier, doors, held.label, own.label_idx, said.label_idx AS prediction "
        "FROM held JOIN labels AS own ON own.label = held.label JOIN most ON most.buying = held.buying JOIN labels AS said ON said.label = most.label",
        "cars",
        held=HELD,
        labels=LABELS,
        most=f"SELECT buying, label FROM cars JOIN labels USING (label) WHERE {DRAW_SQL} < 700000 GROUP BY buying, label, label_idx "
        "QUALIFY row_number() OVER (PARTITION BY buying ORDER BY count(*) DESC, label_idx) = 1",
    ),
)
def tree_single_feature(spark, folder):
    """The predictions of a tree that sees one feature of three values: for each the label most frequent in training."""
    training, test = _sides(spark, folder)
    scored = categories.train_tree(training, ["buying"], "label").transform(test)
    return scored.select(*ROW, "label", "label_idx", "prediction")


@query(
    "prediction_accuracy",
    oracle(
        "SELECT round(a, 9) AS accuracy, round(1 - a, 9) AS test_error, n FROM ("
        "SELECT avg(CASE WHEN label = maintain THEN 1.0 ELSE 0.0 END) AS a, count(*) AS n FROM cars)",
        "cars",
    ),
)
def prediction_accuracy(spark, folder):
    """How often a row's line status predicts the status of its order."""
    rates = categories.accuracy(view(spark, folder, "cars"), "label", "maintain")
    return rates.select(F.round("accuracy", 9).alias("accuracy"), F.round("test_error", 9).alias("test_error"), "n")


@query(
    "split_is_whole",
    oracle("SELECT row_order, row_part, count(*) AS n FROM cars GROUP BY row_order, row_part", "cars"),
)
def split_is_whole(spark, folder):
    """Both sides of a split together are the table."""
    first, second = categories.split_rows(view(spark, folder, "cars"), 0.7, seed=7, keys=ROW)
    return first.union(second).groupBy("row_order", "row_part").agg(F.count(F.lit(1)).alias("n"))


@query("car_csv_scan", oracle("SELECT buying, persons, label, count(*) AS n FROM cars GROUP BY buying, persons, label", "cars"))
def car_csv_scan(spark, folder):
    """Cars written as CSV without a header and read back with columns named by position."""
    path = new_folder(spark)
    view(spark, folder, "cars").select(*files.CAR_COLUMNS).write.csv(path)
    return files.read_cars(spark, path).groupBy("buying", "persons", "label").agg(F.count(F.lit(1)).alias("n"))


# Pixels.

CHANNELS_SQL = "SELECT *, (rgb >> 16) & 255 AS r, (rgb >> 8) & 255 AS g, rgb & 255 AS b FROM {0}"
RGB = "cast(r * 65536 + g * 256 + b AS int) AS rgb"


def _pixels(spark, folder):
    return view(spark, folder, "pixels")


@query("photo_pixels", oracle("SELECT image_id, width, height, x, y, rgb FROM pixels", "pixels"))
def photo_pixels(spark, folder):
    """Images written as bitmap files, and their pixels as the photo reader finds them."""
    path = new_folder(spark)
    sinks.write_photos(_pixels(spark, folder), path)
    found = files.read_photos(spark, path)
    image = F.regexp_extract("image_id", r"/image_id=(\d+)/[^/]*$", 1).cast("bigint")
    return found.select(image.alias("image_id"), "width", "height", "x", "y", "rgb")


def _neighbours(source: str, weights, name: str) -> str:
    """The weighted sums of a filter by joining each pixel with all its neighbours."""
    side = round(len(weights) ** 0.5)
    offsets = ", ".join(
        f"({i % side - side // 2}, {i // side - side // 2}, {w})" for i, w in enumerate(weights) if w
    )

    def mirror(p: str, size: str) -> str:
        return f"CASE WHEN {p} < 0 THEN -1 - ({p}) WHEN {p} >= {size} THEN 2 * {size} - 1 - ({p}) ELSE {p} END"

    return f"""
SELECT c.image_id, c.width, c.height, c.x, c.y, cast(sum(w * n.r) AS bigint) AS {name}_r,
       cast(sum(w * n.g) AS bigint) AS {name}_g, cast(sum(w * n.b) AS bigint) AS {name}_b
FROM {source} c, (VALUES {offsets}) AS f(dx, dy, w), ({CHANNELS_SQL.format(source)}) n
WHERE n.image_id = c.image_id AND n.x = {mirror("c.x + dx", "c.width")} AND n.y = {mirror("c.y + dy", "c.height")}
GROUP BY ALL
"""


def _blur_sql(source: str) -> str:
    def level(c: str) -> str:
        return f"least(255, greatest(0, cast(floor(s_{c} / 159.0::DOUBLE + 0.5) AS int)))"

    return (
        f"SELECT image_id, width, height, x, y, cast({level('r')} * 65536 + {level('g')} * 256 + {level('b')} AS int) AS rgb "
        f"FROM ({_neighbours(source, raster.GAUSSIAN, 's')})"
    )


def _edge_sql(source: str, threshold: int) -> str:
    strength = " + ".join(f"abs({way}_{c})" for way in "vh" for c in "rgb")
    return (
        f"SELECT image_id, width, height, x, y, CASE WHEN {strength} >= {threshold} THEN 0 ELSE 16777215 END AS rgb "
        f"FROM ({_neighbours(source, raster.SOBEL_VERTICAL, 'v')}) "
        f"JOIN ({_neighbours(source, raster.SOBEL_HORIZONTAL, 'h')}) USING (image_id, width, height, x, y)"
    )


def _quantize_sql(source: str, levels: int) -> str:
    def level(c: str) -> str:
        return f"(({c} * {levels} // 256) * 255 // {levels - 1})"

    return (
        f"SELECT image_id, width, height, x, y, cast({level('r')} * 65536 + {level('g')} * 256 + {level('b')} AS int) AS rgb "
        f"FROM ({CHANNELS_SQL.format(source)})"
    )


@query(
    "px_channels",
    oracle(
        "SELECT image_id, cast(sum(r) AS bigint) AS red, cast(sum(g) AS bigint) AS green, cast(sum(b) AS bigint) AS blue, "
        f"count(*) FILTER (WHERE r * 65536 + g * 256 + b = rgb) AS same FROM ({CHANNELS_SQL.format('pixels')}) GROUP BY image_id",
        "pixels",
    ),
)
def px_channels(spark, folder):
    """Channels taken apart, added up, and put together again."""
    parts = [px.channel(F.col("rgb"), name) for name in raster.CHANNELS]
    sums = [F.sum(part).alias(name) for part, name in zip(parts, raster.CHANNELS)]
    same = F.count_if(px.pack(*parts) == F.col("rgb")).alias("same")
    return _pixels(spark, folder).groupBy("image_id").agg(*sums, same)


@query(
    "px_scalars",
    oracle(
        "SELECT image_id, x, y, cast(CASE WHEN x - 5 < 0 THEN 4 - x ELSE x - 5 END AS int) AS low, "
        "cast(CASE WHEN x + 5 >= width THEN 2 * width - 6 - x ELSE x + 5 END AS int) AS high, "
        "cast(least(255, greatest(0, floor(r * 1.5::DOUBLE - 60 + 0.5))) AS int) AS rounded, "
        "cast(floor(least(255, greatest(0, r * 1.5::DOUBLE - 60))) AS int) AS truncated, "
        "cast(abs(r - g) AS int) AS difference "
        f"FROM ({CHANNELS_SQL.format('pixels')})",
        "pixels",
    ),
)
def px_scalars(spark, folder):
    """Reflected coordinates, both clamps and a channel difference for every pixel."""
    red, green = (px.channel(F.col("rgb"), name) for name in ("red", "green"))
    brighter = red * F.lit(1.5) - 60
    return _pixels(spark, folder).select(
        "image_id", "x", "y",
        px.reflect(F.col("x") - 5, F.col("width")).alias("low"),
        px.reflect(F.col("x") + 5, F.col("width")).alias("high"),
        px.clamp_rounded(brighter).alias("rounded"),
        px.clamp_truncated(brighter).alias("truncated"),
        F.abs(red - green).alias("difference"),
    )


@query(
    "px_gray",
    oracle(
        "SELECT image_id, width, height, x, y, cast(((r + g + b) // 3) * 65793 AS int) AS rgb "
        f"FROM ({CHANNELS_SQL.format('pixels')})",
        "pixels",
    ),
)
def px_gray(spark, folder):
    return raster.grayscale(_pixels(spark, folder))


def _sepia_sql(source: str) -> str:
    def mixed(weights) -> str:
        sums = " + ".join(f"{c} * {w}::DOUBLE" for c, w in zip("rgb", weights))
        return f"cast(floor(least(255.0::DOUBLE, {sums})) AS int)"

    red, green, blue = (mixed(raster.SEPIA[name]) for name in raster.CHANNELS)
    return (
        f"SELECT image_id, width, height, x, y, cast({red} * 65536 + {green} * 256 + {blue} AS int) AS rgb "
        f"FROM ({CHANNELS_SQL.format(source)})"
    )


@query("px_sepia", oracle(_sepia_sql("pixels"), "pixels"))
def px_sepia(spark, folder):
    return raster.sepia(_pixels(spark, folder))


def _half_sql(source: str) -> str:
    return (
        "SELECT image_id, cast(width // 2 AS int) AS width, cast(height // 2 AS int) AS height, "
        f"cast(x // 2 AS int) AS x, cast(y // 2 AS int) AS y, rgb FROM {source} "
        "WHERE x % 2 = 0 AND y % 2 = 0 AND x < 2 * (width // 2) AND y < 2 * (height // 2)"
    )


@query("px_half", oracle(_half_sql("pixels"), "pixels"))
def px_half(spark, folder):
    return raster.half(_pixels(spark, folder))


@query("px_quantize", oracle(_quantize_sql("pixels", 5), "pixels"))
def px_quantize(spark, folder):
    return raster.reduce_colours(_pixels(spark, folder), 5)


@query("px_commands", oracle(_sepia_sql("smaller"), "pixels", smaller=_half_sql("pixels")))
def px_commands(spark, folder):
    return raster.apply_commands(_pixels(spark, folder), ["half", "sepia"])


SHARPEN = (0, -1, 0, -1, 5, -1, 0, -1, 0)


@query(
    "px_convolve",
    oracle(
        "SELECT image_id, width, height, x, y, cast(s_r AS int) AS red, cast(s_g AS int) AS green, cast(s_b AS int) AS blue "
        f"FROM ({_neighbours('pixels', SHARPEN, 's')})",
        "pixels",
    ),
)
def px_convolve(spark, folder):
    return raster.convolve(_pixels(spark, folder), SHARPEN)


@query("px_blur", oracle(_blur_sql("pixels"), "pixels"))
def px_blur(spark, folder):
    return raster.gaussian_blur(_pixels(spark, folder))


@query("px_sobel", oracle(_edge_sql("pixels", 128), "pixels"))
def px_sobel(spark, folder):
    return raster.sobel_edges(_pixels(spark, folder), 128)


MERGE = (
    "SELECT m.image_id, m.width, m.height, m.x, m.y, CASE WHEN m.rgb = 16777215 THEN o.rgb ELSE m.rgb END AS rgb "
    "FROM mask m JOIN other o USING (image_id, x, y)"
)


@query("px_merge", oracle(MERGE, "pixels", mask=_edge_sql("pixels", 300), other=_quantize_sql("pixels", 3)))
def px_merge(spark, folder):
    pixels = _pixels(spark, folder)
    return raster.merge_mask(raster.sobel_edges(pixels, 300), raster.reduce_colours(pixels, 3))


@query(
    "px_cartoon",
    oracle(MERGE, "pixels", blurred=_blur_sql("pixels"), mask=_edge_sql("blurred", 128), other=_quantize_sql("pixels", 3)),
)
def px_cartoon(spark, folder):
    return raster.cartoon(_pixels(spark, folder))


# The same filters in tiles of 8, so that the margins between tiles count.


@query("px_blur_tiles", oracle(_blur_sql("pixels"), "pixels"))
def px_blur_tiles(spark, folder):
    return raster.gaussian_blur(_pixels(spark, folder), tile=8)


@query("px_sobel_tiles", oracle(_edge_sql("pixels", 128), "pixels"))
def px_sobel_tiles(spark, folder):
    return raster.sobel_edges(_pixels(spark, folder), 128, tile=8)


@query(
    "px_cartoon_tiles",
    oracle(MERGE, "pixels", blurred=_blur_sql("pixels"), mask=_edge_sql("blurred", 128), other=_quantize_sql("pixels", 3)),
)
def px_cartoon_tiles(spark, folder):
    return raster.cartoon(_pixels(spark, folder), tile=8)


@query("px_size", oracle("SELECT image_id, width, height, count(*) AS n FROM pixels GROUP BY ALL", "pixels"))
def px_size(spark, folder):
    """Image sizes found from the pixels alone."""
    sized = raster.with_size(_pixels(spark, folder).drop("width", "height"))
    return sized.groupBy("image_id", "width", "height").agg(F.count(F.lit(1)).alias("n"))
