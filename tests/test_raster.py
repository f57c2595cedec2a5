import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import pixels as px
from millrace.operators import raster
from millrace.sources import files, sinks

SCHEMA = "image_id string, width int, height int, x int, y int, rgb int"


def table(spark, **images):
    rows = [
        (name, image.shape[1], image.shape[0], x, y, int(image[y, x]))
        for name, image in images.items()
        for y in range(image.shape[0])
        for x in range(image.shape[1])
    ]
    return spark.createDataFrame(rows, SCHEMA)


def picture(height, width, seed=0):
    return np.random.default_rng(seed).integers(0, 1 << 24, (height, width))


def arrays(df, *columns):
    """Images back as arrays, one per column; checks that every pixel is there once."""
    found = {}
    for r in df.collect():
        found.setdefault(r.image_id, []).append(r)
    result = {}
    for name, cells in found.items():
        width, height = cells[0].width, cells[0].height
        assert sorted((c.x, c.y) for c in cells) == [(x, y) for x in range(width) for y in range(height)]
        result[name] = [np.zeros((height, width), int) for _ in columns]
        for c in cells:
            for image, column in zip(result[name], columns):
                image[c.y, c.x] = c[column]
    return result


def channels(image):
    return [(image >> bits) & 255 for bits in (16, 8, 0)]


def pack(red, green, blue):
    return (red << 16) + (green << 8) + blue


def mirror(p, size):
    while not 0 <= p < size:
        p = -1 - p if p < 0 else 2 * size - 1 - p
    return p


def weighted(plane, weights):
    side = round(len(weights) ** 0.5)
    height, width = plane.shape
    total = np.zeros_like(plane)
    for i, w in enumerate(weights):
        ys = [mirror(y + i // side - side // 2, height) for y in range(height)]
        xs = [mirror(x + i % side - side // 2, width) for x in range(width)]
        total += w * plane[np.ix_(ys, xs)]
    return total


def blur(image):
    return pack(*[np.clip(np.floor(weighted(c, raster.GAUSSIAN) / 159.0 + 0.5).astype(int), 0, 255) for c in channels(image)])


def edges(image, threshold):
    strength = sum(abs(weighted(c, w)) for c in channels(image) for w in (raster.SOBEL_VERTICAL, raster.SOBEL_HORIZONTAL))
    return np.where(strength >= threshold, 0, 0xFFFFFF)


def few(image, levels):
    return pack(*[(c * levels // 256) * 255 // (levels - 1) for c in channels(image)])


SHAPES = [(25, 40), (1, 1), (1, 7), (6, 1), (2, 2), (8, 8), (15, 9), (17, 33)]


@pytest.fixture(scope="module")
def images():
    return {f"{h}x{w}": picture(h, w, seed=h * 100 + w) for h, w in SHAPES}


@pytest.fixture(scope="module")
def pixels(spark, images):
    return table(spark, **images).persist()


@pytest.mark.parametrize("tile", [8, 64])
def test_blur(pixels, images, tile):
    got = arrays(raster.gaussian_blur(pixels, tile), "rgb")
    for name, image in images.items():
        assert (got[name][0] == blur(image)).all(), name


@pytest.mark.parametrize("tile", [7, 64])
def test_edges(pixels, images, tile):
    got = arrays(raster.sobel_edges(pixels, 700, tile), "rgb")
    for name, image in images.items():
        assert (got[name][0] == edges(image, 700)).all(), name


@pytest.mark.parametrize("tile", [8, 64])
def test_cartoon(pixels, images, tile):
    got = arrays(raster.cartoon(pixels, 300, 4, tile), "rgb")
    assert len(got) == len(images)
    for name in got:
        image = images[name]
        mask = edges(blur(image), 300)
        assert (got[name][0] == np.where(mask == 0xFFFFFF, few(image, 4), mask)).all(), name


@pytest.mark.parametrize("weights", [(7,), (1, 2, 3, 4), (0, -1, 0, -1, 5, -1, 0, -1, 0), (0,) * 9, tuple(range(-12, 13)), (90000, -80000, 1, 0, 0, 2, 70000, 3, 4)])
def test_convolve(pixels, images, weights):
    got = arrays(raster.convolve(pixels, weights, 8), "red", "green", "blue")
    for name, image in images.items():
        for plane, c in zip(got[name], channels(image)):
            assert (plane == weighted(c, weights)).all(), name


def test_cartoon_by_steps(pixels):
    assert pixels.filter("width = 1").count() > 0  # mirrored over and over
    mask = raster.sobel_edges(raster.gaussian_blur(pixels), 300)
    steps = raster.merge_mask(mask, raster.reduce_colours(pixels, 4))
    assert sorted(steps.collect()) == sorted(raster.cartoon(pixels, 300, 4).collect())


def test_cartoon_shuffles_once(pixels):
    plan = raster.cartoon(pixels)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_tiles_are_bounded(spark):
    """One huge image is many small groups."""
    wide = spark.range(60_000).select(
        F.lit("p").alias("image_id"), F.lit(300).alias("width"), F.lit(200).alias("height"),
        (F.col("id") % 300).cast("int").alias("x"), (F.col("id") / 300).cast("int").alias("y"), F.lit(1).alias("rgb"),
    )
    sizes = raster._tiles(wide, 3, 64).groupBy("image_id", "tx", "ty").count().collect()
    assert len(sizes) == 4 * 3 and max(r["count"] for r in sizes) <= (127 + 6) ** 2


def test_missing_or_repeated_pixels_fail(spark):
    whole = table(spark, a=picture(6, 6))
    for broken in (whole.filter("x <> 2 OR y <> 3"), whole.union(whole.filter("x = 2 AND y = 3"))):
        with pytest.raises(Exception, match="every pixel"):
            raster.gaussian_blur(broken).collect()


def test_bad_arguments(pixels):
    for call in (
        lambda: raster.convolve(pixels, (1, 2, 3)),
        lambda: raster.convolve(pixels, ()),
        lambda: raster.sobel_edges(pixels, -1),
        lambda: raster.cartoon(pixels, -1),
        lambda: raster.reduce_colours(pixels, 1),
        lambda: raster.reduce_colours(pixels, 257),
        lambda: raster.apply_commands(pixels, ["half", "undo"]),
        lambda: raster.gaussian_blur(pixels, tile=4),
    ):
        with pytest.raises(ValueError):
            call()


def test_single_pixel_operators(pixels, images):
    gray = arrays(raster.grayscale(pixels), "rgb")
    brown = arrays(raster.sepia(pixels), "rgb")
    reduced = arrays(raster.reduce_colours(pixels, 26), "rgb")
    for name, image in images.items():
        r, g, b = channels(image)
        assert (gray[name][0] == (r + g + b) // 3 * 0x010101).all()
        mixed = [np.minimum(255, r * w[0] + g * w[1] + b * w[2]).astype(int) for w in raster.SEPIA.values()]
        assert (brown[name][0] == pack(*mixed)).all()
        assert (reduced[name][0] == few(image, 26)).all()


def test_half(pixels, images):
    got = arrays(raster.half(pixels), "rgb")
    for name, image in images.items():
        height, width = image.shape
        if height > 1 and width > 1:
            assert (got[name][0] == image[: height // 2 * 2 : 2, : width // 2 * 2 : 2]).all()
        else:
            assert name not in got


def test_commands(pixels):
    once = raster.apply_commands(pixels, ["half", "grayscale", "half"])
    assert sorted(once.collect()) == sorted(raster.half(raster.grayscale(raster.half(pixels))).collect())


def test_size(pixels):
    sized = raster.with_size(pixels.drop("width", "height"))
    assert sorted(sized.collect()) == sorted(pixels.collect())


def values(spark, column, data, type_="double"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {type_}").orderBy("i")
    return [r[0] for r in frame.select(column(F.col("v"))).collect()]


def test_clamp(spark):
    low, high = [-float(i) for i in range(300)], [255.0 + i for i in range(300)]
    assert set(values(spark, px.clamp_rounded, low)) == {0} and set(values(spark, px.clamp_rounded, high)) == {255}
    assert values(spark, px.clamp_rounded, [0.5, 254.49, 255.5, 255.99]) == [1, 254, 255, 255]
    assert values(spark, px.clamp_truncated, [-0.5, 0.99, 254.99, 255.0, 300.5]) == [0, 0, 254, 255, 255]


def test_reflect(spark):
    inside = [2, 1, 0, -1, -2, -3, 97, 98, 99, 100, 101, 102]
    want = [2, 1, 0, 0, 1, 2, 97, 98, 99, 99, 98, 97]
    assert values(spark, lambda v: px.reflect(v, F.lit(100)), inside, "int") == want


@pytest.mark.parametrize(
    "levels,pairs",
    [
        (2, {0: 0, 127: 0, 128: 255, 255: 255}),
        (3, {0: 0, 85: 0, 86: 127, 170: 127, 171: 255, 255: 255}),
        (26, {0: 0, 9: 0, 10: 10, 19: 10, 20: 20, 246: 244, 247: 255, 255: 255}),
    ],
)
def test_quantize(spark, levels, pairs):
    assert values(spark, lambda v: px.quantize(v, levels), list(pairs), "int") == list(pairs.values())


def png(array):
    """A PNG file of an H x W x C array of bytes (C = 1, 3 or 4)."""
    height, width, depth = array.shape

    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", width, height, 8, {1: 0, 3: 2, 4: 6}[depth], 0, 0, 0)
    lines = b"".join(b"\0" + array[y].tobytes() for y in range(height))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


@pytest.mark.parametrize("depth", [1, 3, 4])
def test_photo_files(spark, tmp_path, depth):
    data = np.random.default_rng(depth).integers(0, 256, (13, 21, depth), dtype=np.uint8)
    if depth == 4:
        data[..., 3] = 255
    (tmp_path / "p.png").write_bytes(png(data))
    (tmp_path / "broken.png").write_bytes(b"no image")
    with pytest.raises(Exception, match="not a photo"):
        files.read_photos(spark, str(tmp_path)).collect()
    got = arrays(files.read_photos(spark, str(tmp_path), strict=False), "rgb")
    assert len(got) == 1
    planes = [data[..., 0].astype(int)] * 3 if depth == 1 else [data[..., i].astype(int) for i in range(3)]
    assert (next(iter(got.values()))[0] == pack(*planes)).all()


@pytest.mark.parametrize("width", [1, 2, 3, 4, 21])  # lines of a bitmap are padded to four bytes
def test_photos_written_and_read(spark, tmp_path, width):
    rng = np.random.default_rng(width)
    images = {i: rng.integers(0, 1 << 24, (5 + i, width)) for i in range(3)}
    rows = [(i, width, len(a), x, y, int(a[y, x])) for i, a in images.items() for y in range(len(a)) for x in range(width)]
    table = spark.createDataFrame(rows, "image_id int, width int, height int, x int, y int, rgb int").repartition(4)
    sinks.write_photos(table, str(tmp_path / "photos"))
    found = files.read_photos(spark, str(tmp_path / "photos")).collect()
    got = {(int(r.image_id.split("image_id=")[1].split("/")[0]), r.width, r.height, r.x, r.y, r.rgb) for r in found}
    assert got == set(rows) and len(found) == len(rows)
