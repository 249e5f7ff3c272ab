"""Box arithmetic as column expressions. Null or NaN corners make a box invalid instead of silently spanning the image."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import REPAIR_TOLERANCE
from .rounding import rounded


def _clamp(x: Column, high) -> Column:
    return F.least(F.greatest(x, F.lit(0.0)), high if isinstance(high, Column) else F.lit(float(high)))


def _sound(*columns: Column) -> Column:
    out = F.lit(True)
    for c in columns:
        out = out & c.isNotNull() & ~F.isnan(c)
    return out


def clip_normalised(cx: Column, cy: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    """struct(cx, cy, w, h, repaired), or null if what is left inside the image is under one pixel on a side, or a value is missing."""
    l, r, t, b = cx - w / 2, cx + w / 2, cy - h / 2, cy + h / 2
    cl, cr, ct, cb = (_clamp(v, 1.0) for v in (l, r, t, b))
    moved = F.lit(False)
    for old, new in ((l, cl), (r, cr), (t, ct), (b, cb)):
        moved = moved | (F.abs(new - old) > REPAIR_TOLERANCE)
    keep = _sound(cx, cy, w, h) & ((cr - cl) * width >= 1.0) & ((cb - ct) * height >= 1.0)
    return F.when(keep, F.struct(((cl + cr) / 2).alias("cx"), ((ct + cb) / 2).alias("cy"), (cr - cl).alias("w"), (cb - ct).alias("h"), moved.alias("repaired")))


def clip_pixels(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column, digits: int = 6) -> Column:
    """A top-left pixel box as struct(cx, cy, w, h) of the image, rounded; null if a side has one pixel or less."""
    l, r, t, b = _clamp(x, width), _clamp(x + w, width), _clamp(y, height), _clamp(y + h, height)
    keep = _sound(x, y, w, h) & (r - l > 1.0) & (b - t > 1.0)
    out = {"cx": (l + r) / 2 / width, "cy": (t + b) / 2 / height, "w": (r - l) / width, "h": (b - t) / height}
    return F.when(keep, F.struct(*(rounded(v, digits).alias(k) for k, v in out.items())))


def clip_percent(x: Column, y: Column, w: Column, h: Column) -> Column:
    """A top-left box in percent, clamped to 0..100; null if nothing is left."""
    l, r, t, b = _clamp(x, 100), _clamp(x + w, 100), _clamp(y, 100), _clamp(y + h, 100)
    return F.when(_sound(x, y, w, h) & (r > l) & (b > t), F.struct(l.alias("x"), t.alias("y"), (r - l).alias("w"), (b - t).alias("h")))


def clip_strict(x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    """A pixel box kept in pixels: struct(x, y, w, h, changed, error); an empty or missing box is an error, not dropped."""
    l, r, t, b = _clamp(x, width), _clamp(x + w, width), _clamp(y, height), _clamp(y + h, height)
    empty = ~_sound(x, y, w, h) | (r <= l) | (b <= t)
    changed = (l != x) | (t != y) | (r - l != w) | (b - t != h)
    return F.struct(l.alias("x"), t.alias("y"), (r - l).alias("w"), (b - t).alias("h"), F.coalesce(changed, F.lit(True)).alias("changed"), F.when(empty, F.lit("empty")).alias("error"))


def corners_to_centre(xmin: Column, ymin: Column, xmax: Column, ymax: Column, width: Column, height: Column) -> Column:
    return F.struct(((xmin + xmax) / 2 / width).alias("cx"), ((ymin + ymax) / 2 / height).alias("cy"), ((xmax - xmin) / width).alias("w"), ((ymax - ymin) / height).alias("h"))


def top_left_to_centre(x: Column, y: Column, w: Column, h: Column, unit: Column, width: Column, height: Column) -> Column:
    """Units 'px' and 'pct'; anything else gives null."""
    sx = F.when(unit == "px", width.cast("double")).when(unit == "pct", F.lit(100.0))
    sy = F.when(unit == "px", height.cast("double")).when(unit == "pct", F.lit(100.0))
    return F.when(sx.isNotNull(), F.struct(((x + w / 2) / sx).alias("cx"), ((y + h / 2) / sy).alias("cy"), (w / sx).alias("w"), (h / sy).alias("h")))


def centre_to_coco(cx: Column, cy: Column, w: Column, h: Column, width: Column, height: Column, digits: int = 3) -> Column:
    """struct(x, y, w, h, area) in pixels, rounded."""
    bw, bh = w * width, h * height
    return F.struct(*(rounded(v, digits).alias(k) for k, v in {"x": (cx - w / 2) * width, "y": (cy - h / 2) * height, "w": bw, "h": bh, "area": bw * bh}.items()))


def centre_to_corners(cx: Column, cy: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    return F.struct(((cx - w / 2) * width).alias("x1"), ((cy - h / 2) * height).alias("y1"), ((cx + w / 2) * width).alias("x2"), ((cy + h / 2) * height).alias("y2"))


def between(start: Column, end: Column, at: Column, first: Column, last: Column) -> Column:
    """The value at `at` on the line from (start, first) to (end, last)."""
    return first + (at - start) / (end - start) * (last - first)
