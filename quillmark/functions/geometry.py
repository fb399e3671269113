"""Boxes as Column expressions over ``struct<x0, y0, x1, y1>`` of doubles, origin at the top left."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SIDES = ("x0", "y0", "x1", "y1")
MIN_AREA, SCALE = 10, 1000


def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return F.struct(*(c.alias(n) for c, n in zip((x0, y0, x1, y1), SIDES, strict=True)))


def sides(b: Column) -> list[Column]:
    return [b[s] for s in SIDES]


def width(b: Column) -> Column:
    return b["x1"] - b["x0"]


def height(b: Column) -> Column:
    return b["y1"] - b["y0"]


def area(b: Column) -> Column:
    return width(b) * height(b)


def center_x(b: Column) -> Column:
    return (b["x0"] + b["x1"]) / 2


def center_y(b: Column) -> Column:
    return (b["y0"] + b["y1"]) / 2


def as_xywh(b: Column) -> Column:
    return F.array(b["x0"], b["y0"], width(b), height(b))


def as_center(b: Column) -> Column:
    return F.array(center_x(b), center_y(b), width(b), height(b))


def from_format(a: Column, fmt: Column) -> Column:
    """A box from four numbers in the format xyxy, xywh or cxcywh; null for others."""
    at = [a[k] for k in range(4)]
    half = [at[2] / 2, at[3] / 2]
    return (
        F.when(fmt == "xyxy", box(*at))
        .when(fmt == "xywh", box(at[0], at[1], at[0] + at[2], at[1] + at[3]))
        .when(fmt == "cxcywh", box(at[0] - half[0], at[1] - half[1], at[0] + half[0], at[1] + half[1]))
    )


def to_format(b: Column, fmt: Column) -> Column:
    return F.when(fmt == "xyxy", F.array(*sides(b))).when(fmt == "xywh", as_xywh(b)).when(fmt == "cxcywh", as_center(b))


def intersects(a: Column, b: Column) -> Column:
    """Touching counts."""
    return (a["x0"] <= b["x1"]) & (b["x0"] <= a["x1"]) & (a["y0"] <= b["y1"]) & (b["y0"] <= a["y1"])


def intersection_area(a: Column, b: Column) -> Column:
    w = F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"])
    h = F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"])
    return F.when((w > 0) & (h > 0), w * h).otherwise(F.lit(0.0))


def iou(a: Column, b: Column) -> Column:
    """Intersection over union; 0 where the union is."""
    both = intersection_area(a, b)
    union = area(a) + area(b) - both
    return F.when(union > 0, both / union).otherwise(F.lit(0.0))


def _clamped(c: Column, top: int) -> Column:
    return F.greatest(F.lit(0), F.least(c.cast("int"), F.lit(top)))


def scaled(b: Column, w: Column, h: Column, scale: int = SCALE) -> Column:
    """Whole numbers from 0 to ``scale``, truncated; null for a page without size."""
    ok = (w > 0) & (h > 0)
    return F.when(ok, box(*(_clamped(F.lit(float(scale)) * (c / d), scale) for c, d in zip(sides(b), (w, h, w, h), strict=True))))


def layout_box(b: Column, w: Column, h: Column) -> Column:
    """From 0 to 1000 with x1 > x0 and y1 > y0 unless that side is at 1000; null for a page without size."""
    x0, y0, x1, y1 = (_clamped((c / d) * 1000.0, SCALE) for c, d in zip(sides(b), (w, h, w, h), strict=True))
    grow = lambda low, high: F.when(high <= low, F.least(low + 1, F.lit(SCALE))).otherwise(high)
    return F.when((w > 0) & (h > 0), box(x0, y0, grow(x0, x1), grow(y0, y1)))


def layout_box_safe(b: Column, w: Column, h: Column, min_area: int = MIN_AREA) -> Column:
    """``struct<box, valid>``: valid from an area of ``min_area``; (0, 0, 1, 1) and invalid where there is no box."""
    n = layout_box(b, w, h)
    unit = box(*(F.lit(v) for v in (0, 0, 1, 1)))
    return F.struct(F.coalesce(n, unit).alias("box"), F.coalesce(area(n) >= min_area, F.lit(False)).alias("valid"))


def unscaled(b: Column, w: Column, h: Column, scale: int = SCALE) -> Column:
    return box(*((c / F.lit(float(scale))) * d for c, d in zip(sides(b), (w, h, w, h), strict=True)))


def merged(b: Column) -> Column:
    """Aggregate: the box around all boxes of a group; zeros for none."""
    return box(*(F.coalesce(f(b[s]), F.lit(0.0)) for f, s in ((F.min, "x0"), (F.min, "y0"), (F.max, "x1"), (F.max, "y1"))))


def expanded(b: Column, by: Column | float = 0.0, percent: Column | float = 0.0) -> Column:
    """Wider on all sides by a length, or by a share of its own size where ``percent`` is over 0."""
    by, percent = (F.lit(x) if not isinstance(x, Column) else x for x in (by, percent))
    dx, dy = (F.when(percent > 0, size * percent / 100).otherwise(by) for size in (width(b), height(b)))
    return box(b["x0"] - dx, b["y0"] - dy, b["x1"] + dx, b["y1"] + dy)


def clipped(b: Column, w: Column, h: Column) -> Column:
    inside = lambda c, top: F.greatest(F.lit(0.0), F.least(c, top))
    return box(inside(b["x0"], w), inside(b["y0"], h), inside(b["x1"], w), inside(b["y1"], h))


def contains(outer: Column, inner: Column, tolerance: float = 2.0) -> Column:
    return (inner["x0"] >= outer["x0"] - tolerance) & (inner["y0"] >= outer["y0"] - tolerance) & (inner["x1"] <= outer["x1"] + tolerance) & (inner["y1"] <= outer["y1"] + tolerance)


def center_distance(a: Column, b: Column) -> Column:
    dx, dy = center_x(a) - center_x(b), center_y(a) - center_y(b)
    return F.sqrt(dx * dx + dy * dy)


def box_findings(b: Column) -> Column:
    """Codes of what is wrong with a 0..1000 box: range, order (errors), area, aspect (warnings)."""
    x0, y0, x1, y1 = sides(b)
    ranged = (F.least(*sides(b)) < 0) | (F.greatest(*sides(b)) > SCALE)
    aspect = width(b) / F.when(height(b) > 0, height(b))
    return F.array_compact(
        F.array(
            F.when(ranged, "range"),
            F.when((x1 <= x0) | (y1 <= y0), "order"),
            F.when(area(b) < MIN_AREA, "area"),
            F.when((aspect > 50) | (aspect < 0.02), "aspect"),
        )
    )


def link(a: Column, b: Column) -> Column:
    """``[[a, b]]`` where both are there (0 counts), else ``[]``."""
    return F.when(a.isNotNull() & b.isNotNull(), F.array(F.array(a, b))).otherwise(F.array().cast("array<array<int>>"))


def hue(i: Column) -> Column:
    """Evenly spread hues, by the golden angle."""
    return (i * 137.5) % 360
