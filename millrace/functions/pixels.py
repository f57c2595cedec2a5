"""Arithmetic on packed ``0x00RRGGBB`` pixels and on pixel coordinates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
CHANNEL_SHIFT = {"red": 16, "green": 8, "blue": 0}
BLACK = 0x000000
WHITE = 0xFFFFFF


def channel(rgb: Column, name: str) -> Column:
    """One channel of a packed pixel, 0..255."""
    return F.shiftright(rgb, CHANNEL_SHIFT[name]).bitwiseAND(F.lit(255))


def pack(red: Column, green: Column, blue: Column) -> Column:
    """Three channels back into one integer."""
    return (F.shiftleft(red, 16) + F.shiftleft(green, 8) + blue).cast("int")


def clamp_rounded(value: Column) -> Column:
    """Nearest integer, held within 0..255."""
    return F.least(F.lit(255), F.greatest(F.lit(0), (value + F.lit(0.5)).cast("int")))


def clamp_truncated(value: Column) -> Column:
    """Held within 0..255, fraction cut off."""
    return F.least(F.lit(255.0), F.greatest(F.lit(0.0), value)).cast("int")


def reflect(position: Column, size: Column) -> Column:
    """Mirror a coordinate back into ``0 .. size-1``: -1 becomes 0 and ``size`` becomes ``size-1``."""
    folded = F.pmod(position, 2 * size)
    return F.when(folded < size, folded).otherwise(2 * size - 1 - folded)


def quantize(value: Column, levels: int) -> Column:
    """Map a channel value to the nearest lower of ``levels`` evenly spread values."""
    if not 2 <= levels <= 256:
        raise ValueError(f"levels must be 2..256, not {levels}")
    bucket = F.floor(value * levels / 256)
    return F.floor(bucket * 255 / (levels - 1)).cast("int")


def mean_channel(rgb: Column) -> Column:
    """Integer mean of the three channels."""
    total = channel(rgb, "red") + channel(rgb, "green") + channel(rgb, "blue")
    return F.floor(total / 3).cast("int")
