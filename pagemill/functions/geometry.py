"""Boxes and polygons. A box is a struct of x1, y1, x2, y2; a polygon an array of points x, y."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.struct(x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


def bounding_box(polygon: Column) -> Column:
    """The box around a polygon; null for a null or empty one."""
    xs, ys = F.transform(polygon, lambda p: p["x"]), F.transform(polygon, lambda p: p["y"])
    return F.when(F.size(polygon) > 0, box(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys)))


def parse_polygon(text: Column) -> Column:
    """A polygon from JSON text, its points as ``{"x":, "y":}`` or ``[x, y]``; null for null or other."""
    pairs = F.from_json(text, "array<array<double>>")
    listed = F.transform(pairs, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))
    return F.when(F.regexp_replace(text, r"\s", "").startswith("[["), listed).otherwise(F.from_json(text, "array<struct<x:double,y:double>>"))


def rectangle(b: Column) -> Column:
    """The four corners of a box, clockwise from the top left."""
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    return F.array(corner(b["x1"], b["y1"]), corner(b["x2"], b["y1"]), corner(b["x2"], b["y2"]), corner(b["x1"], b["y2"]))


def iou(a: Column, b: Column) -> Column:
    """Intersection over union; 0.0 where the union is empty, null where a box is."""
    w = F.greatest(F.lit(0.0), F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"]))
    h = F.greatest(F.lit(0.0), F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"]))
    area = lambda r: F.greatest(F.lit(0.0), r["x2"] - r["x1"]) * F.greatest(F.lit(0.0), r["y2"] - r["y1"])
    union = area(a) + area(b) - w * h
    return F.when(union > 0, w * h / union).when(union <= 0, 0.0)


def to_percent(polygon: Column, width: Column, height: Column) -> Column:
    """Points in percent of the image at four decimals; a size of null or 0 counts as 1."""
    w = F.when(width != 0, width).otherwise(1).cast("double")
    h = F.when(height != 0, height).otherwise(1).cast("double")
    return F.transform(polygon, lambda p: F.array(F.bround((p["x"] / w) * 100, 4), F.bround((p["y"] / h) * 100, 4)))


def from_percent(points: Column, width: Column, height: Column) -> Column:
    """Percent points as pixels if the size is known, else as they are."""
    known = (width != 0) & (height != 0)
    x = lambda p: F.when(known, (F.get(p, F.lit(0)) / 100.0) * width).otherwise(F.get(p, F.lit(0)))
    y = lambda p: F.when(known, (F.get(p, F.lit(1)) / 100.0) * height).otherwise(F.get(p, F.lit(1)))
    return F.transform(points, lambda p: F.struct(x(p).alias("x"), y(p).alias("y")))


def centre_to_corners(cx: Column, cy: Column, w: Column, h: Column) -> Column:
    return box(cx - w / 2.0, cy - h / 2.0, cx + w / 2.0, cy + h / 2.0)


def unletterbox(b: Column, width: Column, height: Column, square: Column, left: Column, top: Column, input_size: int, min_size: float) -> Column:
    """A box of the square model input on the page: scaled, shifted, clamped; null if degenerate or
    smaller than ``min_size`` on a side."""
    scale = square.cast("double") / float(input_size)
    clamp = lambda v, hi: F.greatest(F.lit(0.0), F.least(hi.cast("double"), v))
    out = box(clamp(b["x1"] * scale - left, width), clamp(b["y1"] * scale - top, height), clamp(b["x2"] * scale - left, width), clamp(b["y2"] * scale - top, height))

    def keep(r: Column) -> Column:
        w, h = r["x2"] - r["x1"], r["y2"] - r["y1"]
        return F.when((w > 0) & (h > 0) & (w >= min_size) & (h >= min_size), r)

    return F.get(F.transform(F.array(out), keep), F.lit(0))


def crop_bounds(b: Column, width: Column, height: Column, padding: int = 8, min_size: int = 8) -> Column:
    """Integer bounds of a padded crop (round half to even), clamped; null if too small or if the
    page has no size."""
    r = lambda v: F.bround(v, 0).cast("int")
    left, top = F.greatest(F.lit(0), r(b["x1"]) - padding), F.greatest(F.lit(0), r(b["y1"]) - padding)
    right, bottom = F.least(width, r(b["x2"]) + padding), F.least(height, r(b["y2"]) + padding)
    ok = (width > 0) & (height > 0) & (right - left >= min_size) & (bottom - top >= min_size)
    return F.when(ok, F.struct(left.alias("left"), top.alias("top"), right.alias("right"), bottom.alias("bottom")))


def direction(b: Column, threshold: float = 1.35) -> Column:
    w, h = F.greatest(F.lit(1.0), b["x2"] - b["x1"]), F.greatest(F.lit(1.0), b["y2"] - b["y1"])
    return F.when(h / w >= threshold, "vertical").otherwise("horizontal")


def crop_to_page(polygon: Column, left: Column, top: Column, crop_height: Column, rotated: Column) -> Column:
    """Points of a crop on the page; a crop that was rotated is turned back first."""
    x = lambda p: F.when(rotated, p["y"]).otherwise(p["x"])
    y = lambda p: F.when(rotated, crop_height.cast("double") - p["x"]).otherwise(p["y"])
    return F.transform(polygon, lambda p: F.struct((left.cast("double") + x(p)).alias("x"), (top.cast("double") + y(p)).alias("y")))


def height(polygon: Column) -> Column:
    ys = F.transform(polygon, lambda p: p["y"])
    return F.coalesce(F.array_max(ys) - F.array_min(ys), F.lit(0.0))
