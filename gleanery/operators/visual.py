"""Difference hashes of luminance rasters, as column expressions: decoding stays outside, everything after it is here."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Lobes of the Lanczos window, bits of its fixed-point weights, and the sides of the two rasters that are compared.
LOBES, PRECISION, SIDE = 3, 22, 16


def luminance(red: Column, green: Column, blue: Column) -> Column:
    """0 to 255 by the ITU-R 601-2 weights in 16-bit fixed point, rounded."""
    return F.shiftright(red * 19595 + green * 38470 + blue * 7471 + 32768, 16)


def upright(pixels: Column, width: Column, height: Column, orientation: Column) -> Column:
    """The rows of a raster, given line by line, turned as its EXIF orientation (1 to 8; anything else is 1) says."""
    turned = orientation.between(5, 8)
    w, h = F.when(turned, height).otherwise(width), F.when(turned, width).otherwise(height)
    across, down = width - 1, height - 1
    source = {2: lambda x, y: (across - x, y), 3: lambda x, y: (across - x, down - y), 4: lambda x, y: (x, down - y), 5: lambda x, y: (y, x), 6: lambda x, y: (y, down - x), 7: lambda x, y: (across - y, down - x), 8: lambda x, y: (across - y, x)}

    def at(x: Column, y: Column) -> Column:
        place = F.lit(None).cast("int")
        for k, of in source.items():
            i, j = of(x, y)
            place = F.when(orientation == k, j * width + i).otherwise(place)
        return F.get(pixels, place)

    plain = F.transform(F.sequence(F.lit(0), height - 1), lambda y: F.slice(pixels, y * width + 1, width))
    moved = F.transform(F.sequence(F.lit(0), h - 1), lambda y: F.transform(F.sequence(F.lit(0), w - 1), lambda x: at(x, y)))
    return F.when(orientation.between(2, 8), moved).otherwise(plain)


def weights(size: Column, out: int) -> Column:
    """Which of `size` samples give each of `out` resampled ones, and how much: array of struct(first, k), k in units of 2^-22.

    A Lanczos window of three lobes, as wide as the samples are apart on the larger of the two rasters, cut at the edges and normalised.
    """
    scale = size.cast("double") / out
    wide = F.greatest(scale, F.lit(1.0))

    def sinc(x: Column) -> Column:
        return F.when(x == 0, 1.0).otherwise(F.sin(x * math.pi) / (x * math.pi))

    def window(x: Column) -> Column:
        return F.when((x >= -LOBES) & (x < LOBES), sinc(x) * sinc(x / LOBES)).otherwise(0.0)

    def row(i: Column) -> Column:
        centre = (i + 0.5) * scale
        first = F.greatest((centre - wide * LOBES + 0.5).cast("int"), F.lit(0))
        last = F.least((centre + wide * LOBES + 0.5).cast("int"), size)
        return F.struct(first.alias("first"), F.transform(F.sequence(first, last - 1), lambda j: window((j - centre + 0.5) / wide)).alias("w"))

    def summed(x: Column) -> Column:
        return F.struct(x["first"].alias("first"), x["w"].alias("w"), F.aggregate(x["w"], F.lit(0.0), lambda t, v: t + v).alias("total"))

    def fixed(x: Column) -> Column:
        unit = lambda v: v / x["total"] * (1 << PRECISION)
        return F.struct(x["first"].alias("first"), F.transform(x["w"], lambda v: F.when(v < 0, F.ceil(unit(v) - 0.5)).otherwise(F.floor(unit(v) + 0.5)).cast("long")).alias("k"))

    return F.transform(F.transform(F.transform(F.sequence(F.lit(0), F.lit(out - 1)), row), summed), fixed)


def _resampled(line: Column, by: Column) -> Column:
    """A line of samples by weights, each rounded to 0 to 255."""
    sample = lambda w: F.shiftright(F.aggregate(F.zip_with(F.slice(line, w["first"] + 1, F.size(w["k"])), w["k"], lambda p, k: p * k), F.lit(1 << (PRECISION - 1)).cast("long"), lambda t, x: t + x), PRECISION)
    return F.transform(by, lambda w: F.least(F.greatest(sample(w), F.lit(0)), F.lit(255)))


def _columns(lines: Column, n: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda x: F.transform(lines, lambda line: F.get(line, x)))


def difference_hash(images: DataFrame, pixels: str = "pixels", width: str = "width", height: str = "height", orientation: str | None = None) -> DataFrame:
    """images with `words` (array of 16 numbers of 32 bits) and `visual_hash` (the same as 128 hex digits).

    pixels is an array of luminance values line by line. The raster is turned upright and resampled to 17 x 16 and to 16 x 17; a bit tells
    whether a sample is larger than its right neighbour in the first, then than the one below it in the second, line by line, most significant first. A raster
    whose size does not fit, with values missing or out of 0 to 255, has null for both.
    """
    w, h = F.col(width).cast("int"), F.col(height).cast("int")
    turn = F.coalesce(F.col(orientation).cast("int"), F.lit(1)) if orientation else F.lit(1)
    sound = (w > 0) & (h > 0) & (F.size(pixels) == w * h) & ~F.exists(pixels, lambda p: p.isNull() | (p < 0) | (p > 255))
    rows = _step(images, _lines=F.when(F.coalesce(sound, F.lit(False)), upright(F.transform(pixels, lambda p: p.cast("long")), w, h, turn)))
    rows = _step(rows, _w=F.size(F.get("_lines", F.lit(0))), _h=F.size("_lines"))
    for name, across, down in (("_a", SIDE + 1, SIDE), ("_b", SIDE, SIDE + 1)):
        lines, columns, x, y, grid = (f"{name}_{k}" for k in ("lines", "columns", "x", "y", "grid"))
        rows = _step(rows, **{x: F.when(F.col("_lines").isNotNull(), weights(F.col("_w"), across)), y: F.when(F.col("_lines").isNotNull(), weights(F.col("_h"), down))})
        # lines first, then columns
        rows = _step(rows, **{lines: _all_resampled("_lines", x)})
        rows = _step(rows, **{columns: _columns(F.col(lines), across)})
        rows = _step(rows, **{grid: _all_resampled(columns, y)})
    # grids stand column by column: [x][y]
    at = lambda g, x, y: F.get(F.get(g, x), y)
    cell = lambda i: (i % SIDE, F.floor(i / SIDE).cast("int"))
    every = F.sequence(F.lit(0), F.lit(SIDE * SIDE - 1))
    right = F.transform(every, lambda i: (at("_a_grid", cell(i)[0], cell(i)[1]) > at("_a_grid", cell(i)[0] + 1, cell(i)[1])).cast("long"))
    below = F.transform(every, lambda i: (at("_b_grid", cell(i)[0], cell(i)[1]) > at("_b_grid", cell(i)[0], cell(i)[1] + 1)).cast("long"))
    rows = _step(rows, _bits=F.when(F.col("_lines").isNotNull(), F.concat(right, below)))
    words = F.transform(F.sequence(F.lit(0), F.lit(15)), lambda k: F.aggregate(F.slice("_bits", k * 32 + 1, F.lit(32)), F.lit(0).cast("long"), lambda t, b: t * 2 + b))
    rows = _step(rows, words=F.when(F.col("_bits").isNotNull(), words))
    digits = F.lower(F.array_join(F.transform("words", lambda x: F.lpad(F.hex(x), 8, "0")), ""))
    return rows.withColumn("visual_hash", digits).select(*images.columns, "words", "visual_hash")


def _all_resampled(lines: str, by: str) -> Column:
    return F.transform(lines, lambda line: _resampled(line, F.col(by)))


def _step(rows: DataFrame, **columns: Column) -> DataFrame:
    """rows with further columns that come out of a generator: the optimiser would put what a plain column tells into the lambdas that use it, to be computed again for each element."""
    return rows.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))
