"""Image operators on a pixel table, any number of images at once.

Columns: ``image_id, width, height, x, y, rgb`` with one row per pixel and ``rgb`` packed as
``0x00RRGGBB``. ``with_size`` adds ``width`` and ``height`` where only the pixels are known.

Operators that look at neighbours cut images into square tiles with a margin and shuffle once, by
tile. A tile holds some thousands of rows however large its image, so one huge image spreads over the
cluster like many small ones. Inside a tile, each line is an array.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.pixels import (
    BLACK,
    CHANNEL_SHIFT,
    WHITE,
    channel,
    clamp_rounded,
    clamp_truncated,
    mean_channel,
    pack,
    quantize,
)

PIXEL = ("image_id", "width", "height", "x", "y", "rgb")
CHANNELS = tuple(CHANNEL_SHIFT)
TILE = 64

# Filters in row-major order, and the colour matrix of sepia.
GAUSSIAN = (
    2, 4, 5, 4, 2,
    4, 9, 12, 9, 4,
    5, 12, 15, 12, 5,
    4, 9, 12, 9, 4,
    2, 4, 5, 4, 2,
)
GAUSSIAN_SUM = 159.0
SOBEL_VERTICAL = (-1, 0, 1, -2, 0, 2, -1, 0, 1)
SOBEL_HORIZONTAL = (1, 2, 1, 0, 0, 0, -1, -2, -1)
SEPIA = {"red": (0.393, 0.769, 0.189), "green": (0.349, 0.686, 0.168), "blue": (0.272, 0.534, 0.131)}


def with_size(pixels: DataFrame) -> DataFrame:
    """Add ``width`` and ``height`` from the largest coordinates of each image."""
    sizes = pixels.groupBy("image_id").agg(
        (F.max("x") + 1).cast("int").alias("width"), (F.max("y") + 1).cast("int").alias("height")
    )
    return pixels.join(sizes, "image_id").select(*PIXEL)


# One pixel at a time.


def grayscale(pixels: DataFrame) -> DataFrame:
    mean = mean_channel(F.col("rgb"))
    return pixels.withColumn("rgb", pack(mean, mean, mean))


def sepia(pixels: DataFrame) -> DataFrame:
    red, green, blue = (channel(F.col("rgb"), name) for name in CHANNELS)

    def mixed(weights: Sequence[float]) -> Column:
        return clamp_truncated(red * weights[0] + green * weights[1] + blue * weights[2])

    return pixels.withColumn("rgb", pack(*[mixed(SEPIA[name]) for name in CHANNELS]))


def half(pixels: DataFrame) -> DataFrame:
    """Every second pixel of every second line; an odd last column or line is left out."""
    width, height = F.floor(F.col("width") / 2).cast("int"), F.floor(F.col("height") / 2).cast("int")
    kept = pixels.filter(
        (F.col("x") % 2 == 0) & (F.col("y") % 2 == 0) & (F.col("x") < 2 * width) & (F.col("y") < 2 * height)
    )
    return kept.select(
        "image_id", width.alias("width"), height.alias("height"),
        (F.col("x") / 2).cast("int").alias("x"), (F.col("y") / 2).cast("int").alias("y"), "rgb",
    )


def _quantized(rgb: Column, levels: int) -> Column:
    return pack(*[quantize(channel(rgb, name), levels) for name in CHANNELS])


def reduce_colours(pixels: DataFrame, levels: int = 3) -> DataFrame:
    """At most ``levels`` (2..256) values per channel."""
    return pixels.withColumn("rgb", _quantized(F.col("rgb"), levels))


def merge_mask(mask: DataFrame, other: DataFrame, colour: int = WHITE) -> DataFrame:
    """The mask, with the other image's pixels where the mask has exactly ``colour``."""
    under = other.select("image_id", "x", "y", F.col("rgb").alias("_other"))
    merged = F.when(F.col("rgb") == colour, F.col("_other")).otherwise(F.col("rgb"))
    return mask.join(under, ["image_id", "x", "y"]).withColumn("rgb", merged).select(*PIXEL)


# Neighbourhoods.


def _end(t: str, size: str, tile: int) -> str:
    """Where a tile ends along one axis. The last tile takes the rest, so it is the widest and
    never narrower than a margin."""
    return f"(CASE WHEN {t} < {size} DIV {tile} - 1 THEN ({t} + 1) * {tile} ELSE {size} END)"


def _place_along(pixels: DataFrame, axis: str, size: str, margin: int, tile: int) -> DataFrame:
    """Add ``p<axis>, t<axis>``: the places a pixel is needed at along one axis, and their tiles.

    A pixel is needed at its own place in its tile (use 0) and in the neighbour whose margin it is
    in (1), and near the edge of the image at places mirrored once (2, 3) or twice (4, 5) outside.
    An image narrower than half the margin is mirrored over and over; from 6 on a use is such a place.
    Uses are plain numbers and only such narrow images need lambdas, so that this is compiled.
    """
    last = f"greatest({size} DIV {tile} - 1, 0)"
    placed = pixels.selectExpr("*", f"least({axis} DIV {tile}, {last}) AS own")
    below = f"own > 0 AND {axis} < own * {tile} + {margin}"
    above = f"own < {last} AND {axis} >= (own + 1) * {tile} - {margin}"
    inner = f"{axis} BETWEEN {margin} AND {size} - {margin + 1}"
    there = f"sequence({-margin}, cast({size} AS int) + {margin - 1})"
    narrow = f"""transform(filter({there}, q -> pmod(q, 2 * {size}) IN ({axis}, 2 * {size} - 1 - {axis})),
        q -> q + {margin + 6})"""
    uses = f"""CASE WHEN {inner} AND NOT ({below}) AND NOT ({above}) THEN array(0)
        WHEN 2 * {size} < {margin} THEN {narrow}
        ELSE array(0, CASE WHEN {below} OR {above} THEN 1 END,
                   CASE WHEN {axis} < {margin} THEN 2 END, CASE WHEN {axis} >= {size} - {margin} THEN 3 END,
                   CASE WHEN {axis} - 2 * {size} >= -{margin} THEN 4 END,
                   CASE WHEN {axis} + {size} < {margin} THEN 5 END) END"""
    position = f"""CASE WHEN use >= 6 THEN use - {margin + 6} ELSE CASE use WHEN 2 THEN -1 - {axis} WHEN 3 THEN 2 * {size} - 1 - {axis}
        WHEN 4 THEN {axis} - 2 * {size} WHEN 5 THEN {axis} + 2 * {size} ELSE {axis} END END"""
    # A mirrored place is in the pixel's own tile: that one is at the edge and wider than the margin.
    home = f"CASE WHEN use <> 1 THEN own WHEN {below} THEN own - 1 ELSE own + 1 END"
    used = placed.select("*", F.explode(F.expr(uses)).alias("use")).filter("use IS NOT NULL")
    return used.selectExpr(
        *pixels.columns, f"cast({position} AS int) AS p{axis}", f"cast({home} AS int) AS t{axis}"
    )


def _tiles(pixels: DataFrame, margin: int, tile: int) -> DataFrame:
    """Pixels with their mirrored copies at ``px, py``, placed together by tile ``tx, ty``."""
    if tile <= 2 * margin:
        raise ValueError(f"tile {tile} is too small for a margin of {margin}")
    across = _place_along(pixels.select(*PIXEL), "x", "width", margin, tile)
    both = _place_along(across, "y", "height", margin, tile)
    return both.select("image_id", "width", "height", "tx", "ty", "px", "py", "rgb").repartition("image_id", "tx", "ty")


# Three channels in one bigint, 21 bits each. A weighted sum of packed pixels is the packed weighted
# sums of the channels, so a filter runs once and not three times. A lane holds sums below 2**20 in
# size; ``_BIAS`` makes all three positive, so that they can be cut out again.
_LANES = {"red": 42, "green": 21, "blue": 0}
_LIMIT = 1 << 20
_BIAS = sum(_LIMIT << place for place in _LANES.values())
_BROKEN = "raise_error('the pixel table must hold every pixel of an image exactly once')"


def _packed(**values: str) -> str:
    return " + ".join(f"shiftleft(cast({value} AS bigint), {_LANES[name]})" for name, value in values.items())


def _lane(packed: str, name: str) -> str:
    return f"((shiftright({packed} + {_BIAS}L, {_LANES[name]}) & {2 * _LIMIT - 1}) - {_LIMIT})"


def _channel(rgb: str, name: str) -> str:
    return f"(shiftright({rgb}, {CHANNEL_SHIFT[name]}) & 255)"


_LINE = ["image_id", "width", "height", "tx", "ty", "py"]


def _lines(pixels: DataFrame, margin: int, tile: int, **planes: str) -> DataFrame:
    """The lines of all tiles, margins included, with ``rgb`` and each of ``planes`` (SQL of ``rgb``)
    as arrays along x. Grouping runs on the tiles' shuffle; a line is no longer than a tile."""
    cell = "".join(f", '{name}', {sql}" for name, sql in planes.items())
    lines = (
        _tiles(pixels, margin, tile)
        .groupBy(*_LINE)
        .agg(F.expr(f"sort_array(collect_list(named_struct('px', px, 'rgb', rgb{cell})))").alias("cells"))
    )
    complete = f"cells.px = sequence(tx * {tile} - {margin}, {_end('tx', 'width', tile)} + {margin - 1})"
    return lines.selectExpr(
        *_LINE,
        f"CASE WHEN {complete} THEN cells.rgb ELSE {_BROKEN} END AS rgb",
        *[f"CASE WHEN {complete} THEN cells.{name} ELSE {_BROKEN} END AS {name}" for name in planes],
    )


def _side(weights: Sequence[int]) -> int:
    side = math.isqrt(len(weights))
    if side == 0 or side * side != len(weights):
        raise ValueError(f"non-square filter of {len(weights)} weights")
    return side


def _weighted_sums(
    lines: DataFrame,
    filters: Mapping[str, Sequence[int]],
    tile: int,
    left: int = 0,
    planes: Sequence[str] = ("packed",),
    keep: Sequence[str] = (),
) -> DataFrame:
    """Each filter's weighted sums over each of ``planes``, as arrays named ``<filter>_<plane>``.

    First each different row of weights along the line, then those sums over the lines above and
    below. Lines and arrays shrink to the tile and ``left`` around it. Written as SQL text: one
    string per column in place of hundreds of nested calls.
    """
    side = _side(next(iter(filters.values())))
    rows = {name: [tuple(w[i * side : (i + 1) * side]) for i in range(side)] for name, w in filters.items()}
    row_no = {row: n for n, row in enumerate(dict.fromkeys(r for each in rows.values() for r in each))}
    offsets = [i - side // 2 for i in range(side)]

    def along(row: Sequence[int], plane: str) -> str:
        terms = [f"{w} * get({plane}, i + {k})" for k, w in enumerate(row) if w]
        return f"transform(sequence(0, size({plane}) - {side}), i -> {' + '.join(terms) or '0L'})"

    def at(column: str, by: int) -> str:
        if by == 0:
            return column
        step = f"{'lag' if by < 0 else 'lead'}({column}, {abs(by)})"
        return f"{step} OVER (PARTITION BY image_id, tx, ty ORDER BY py)"

    summed = lines.selectExpr(
        *_LINE, *keep, *[f"{along(row, plane)} AS {plane}{n}" for row, n in row_no.items() for plane in planes]
    )
    used = sorted({(row_no[row], k) for each in rows.values() for k, row in enumerate(each)})
    stacked = summed.selectExpr(
        *_LINE,
        *keep,
        f"{at('py', offsets[-1])} - {at('py', offsets[0])} = {side - 1} AS whole",
        *[f"{at(f'{plane}{n}', offsets[k])} AS {plane}{n}_at{k}" for n, k in used for plane in planes],
    )
    inside = f"py BETWEEN ty * {tile} - {left} AND {_end('ty', 'height', tile)} + {left - 1}"

    def over_lines(each: list[tuple[int, ...]], plane: str) -> str:
        terms = [f"{plane}{row_no[row]}_at{k}" for k, row in enumerate(each) if any(row)]
        added = " + ".join(f"get({term}, i)" for term in terms) or "0L"
        last = f"{_end('tx', 'width', tile)} - tx * {tile} + {2 * left - 1}"
        total = f"transform(sequence(0, {last}), i -> {added})"
        # Said again here: the optimizer may evaluate a column before the filter below.
        return f"CASE WHEN NOT ({inside}) THEN NULL WHEN whole THEN {total} ELSE {_BROKEN} END"

    return stacked.filter(inside).selectExpr(
        *_LINE, *keep, *[f"{over_lines(each, plane)} AS {name}_{plane}" for name, each in rows.items() for plane in planes]
    )


def _pixels(lines: DataFrame, tile: int, cells: str, *columns: str) -> DataFrame:
    """Back to one row per pixel of the image, with ``columns`` as SQL of ``cell``, an element of ``cells``."""
    spots = lines.selectExpr(*_LINE, f"posexplode({cells}) AS (i, cell)")
    return spots.selectExpr(
        "image_id", "width", "height", f"cast(tx * {tile} + i AS int) AS x", "cast(py AS int) AS y", *columns
    )


def convolve(pixels: DataFrame, weights: Sequence[int], tile: int = TILE) -> DataFrame:
    """``red, green, blue``: weighted sums of an N by N filter around each pixel, edges reflected."""
    margin = _side(weights) // 2
    if 255 * sum(map(abs, weights)) < _LIMIT:
        packed = _packed(**{name: _channel("rgb", name) for name in CHANNELS})
        sums = _weighted_sums(_lines(pixels, margin, tile, packed=packed), {"sum": weights}, tile)
        channels = [f"cast({_lane('cell', name)} AS int) AS {name}" for name in CHANNELS]
        return _pixels(sums, tile, "sum_packed", *channels)
    # Sums too large for a lane: each channel by itself.
    planes = {name: f"cast({_channel('rgb', name)} AS bigint)" for name in CHANNELS}
    sums = _weighted_sums(_lines(pixels, margin, tile, **planes), {"sum": weights}, tile, planes=CHANNELS)
    channels = [f"cast(cell.sum_{name} AS int) AS {name}" for name in CHANNELS]
    return _pixels(sums, tile, "arrays_zip(sum_red, sum_green, sum_blue)", *channels)


def _smooth(sums: str) -> str:
    """Packed sums of the blur as packed pixels."""
    levels = {name: f"least(255, greatest(0, cast({_lane('v', name)} / {GAUSSIAN_SUM}D + 0.5D AS int)))" for name in CHANNELS}
    return f"transform({sums}, v -> {_packed(**levels)})"


def _outline(threshold: int) -> str:
    """Packed sums of both Sobel filters as black and white pixels."""
    strength = " + ".join(f"abs({_lane(way, name)})" for way in ("d", "a") for name in CHANNELS)
    return f"zip_with(down_packed, across_packed, (d, a) -> CASE WHEN {strength} >= {threshold} THEN {BLACK} ELSE {WHITE} END)"


def _check_threshold(threshold: int) -> None:
    if threshold < 0:
        raise ValueError(f"edge threshold must be at least zero, not {threshold}")


SOBEL = {"down": SOBEL_VERTICAL, "across": SOBEL_HORIZONTAL}
_PACKED_RGB = _packed(**{name: _channel("rgb", name) for name in CHANNELS})


def gaussian_blur(pixels: DataFrame, tile: int = TILE) -> DataFrame:
    sums = _weighted_sums(_lines(pixels, 2, tile, packed=_PACKED_RGB), {"blur": GAUSSIAN}, tile)
    rgb = " + ".join(f"shiftleft({_lane('cell', name)}, {CHANNEL_SHIFT[name]})" for name in CHANNELS)
    return _pixels(sums, tile, _smooth("blur_packed"), f"cast({rgb} AS int) AS rgb")


def sobel_edges(pixels: DataFrame, threshold: int = 128, tile: int = TILE) -> DataFrame:
    """Black where the colour changes by ``threshold`` or more, else white."""
    _check_threshold(threshold)
    sums = _weighted_sums(_lines(pixels, 1, tile, packed=_PACKED_RGB), SOBEL, tile)
    return _pixels(sums, tile, _outline(threshold), "cell AS rgb")


def cartoon(pixels: DataFrame, threshold: int = 128, levels: int = 3, tile: int = TILE) -> DataFrame:
    """The edges of the blurred image over the image in few colours.

    One shuffle and no join: tiles have a margin wide enough for blur and edges, and carry the
    original pixels along. Blurring mirrored pixels gives mirrored blurred pixels, because the
    filter is symmetric.
    """
    _check_threshold(threshold)
    lines = _lines(pixels, 3, tile, packed=_PACKED_RGB)
    blurred = _weighted_sums(lines, {"blur": GAUSSIAN}, tile, left=1, keep=["rgb"])
    smooth = blurred.selectExpr(*_LINE, "rgb", f"{_smooth('blur_packed')} AS packed")
    outlined = _weighted_sums(smooth, SOBEL, tile, keep=["rgb"])
    originals = f"slice(rgb, 4, {_end('tx', 'width', tile)} - tx * {tile})"  # without the margin of three
    both = outlined.selectExpr(*_LINE, f"{_outline(threshold)} AS edge", f"{originals} AS rgb")
    both = _pixels(both, tile, "arrays_zip(edge, rgb)", "cell.edge", "cell.rgb")
    few = _quantized(F.col("rgb"), levels)
    return both.select(*PIXEL[:5], F.when(F.col("edge") == BLACK, F.col("edge")).otherwise(few).alias("rgb"))


COMMANDS: dict[str, Callable[[DataFrame], DataFrame]] = {"half": half, "sepia": sepia, "grayscale": grayscale}


def apply_commands(pixels: DataFrame, commands: Sequence[str]) -> DataFrame:
    """Run ``half``, ``sepia`` and ``grayscale`` in any order over all images."""
    for command in commands:
        if command not in COMMANDS:
            raise ValueError(f"unknown command: {command}")
        pixels = pixels.transform(COMMANDS[command])
    return pixels
