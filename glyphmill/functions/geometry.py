"""Boxes as struct<x1, y1, x2, y2> columns; all expressions stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIELDS = ("x1", "y1", "x2", "y2")


def box(x1, y1, x2, y2) -> Column:
    return F.struct(*[(c if isinstance(c, Column) else F.lit(c)).alias(n) for c, n in zip((x1, y1, x2, y2), FIELDS)])


def half_even(x: Column) -> Column:
    return F.bround(x, 0).cast("int")


def clamp(b: Column, width, height) -> Column:
    """Rounded half to even, inside the canvas, at least one pixel wide and high."""
    w, h = (x if isinstance(x, Column) else F.lit(x) for x in (width, height))
    within = lambda v, low, high: F.least(F.greatest(half_even(v), low), high)
    zero = F.lit(0)
    x1, y1 = within(b["x1"], zero, w - 1), within(b["y1"], zero, h - 1)
    x2, y2 = within(b["x2"], zero, w), within(b["y2"], zero, h)
    return box(x1, y1, F.when(x2 <= x1, F.least(x1 + 1, w)).otherwise(x2), F.when(y2 <= y1, F.least(y1 + 1, h)).otherwise(y2))


def valid(b: Column, width, height) -> Column:
    return (b["x1"] >= 0) & (b["x1"] < b["x2"]) & (b["x2"] <= width) & (b["y1"] >= 0) & (b["y1"] < b["y2"]) & (b["y2"] <= height)


def area(b: Column) -> Column:
    return F.greatest(b["x2"] - b["x1"], F.lit(0)) * F.greatest(b["y2"] - b["y1"], F.lit(0))


def intersection(a: Column, b: Column) -> Column:
    wide = F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"])
    high = F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"])
    return F.greatest(wide, F.lit(0)) * F.greatest(high, F.lit(0))


def overlap(a: Column, b: Column) -> Column:
    """Intersection by the smaller area; 0 where that is nothing."""
    base = F.least(area(a), area(b))
    return F.when(base > 0, intersection(a, b) / base).otherwise(F.lit(0.0))


def max_overlap(b: Column, others: Column) -> Column:
    """Largest overlap with an array of boxes; 0 with none."""
    return F.coalesce(F.array_max(F.transform(others, lambda o: overlap(b, o))), F.lit(0.0))


def max_pairwise_overlap(boxes: Column) -> Column:
    """Largest overlap of two boxes of one (short) array."""
    each = F.transform(boxes, lambda b, i: max_overlap(b, F.slice(boxes, i + 2, F.greatest(F.size(boxes) - i - 1, F.lit(0)))))
    return F.coalesce(F.array_max(each), F.lit(0.0))


def union(b: Column) -> list[Column]:
    """Aggregates for the union box of a group."""
    return [F.min(b["x1"]).alias("x1"), F.min(b["y1"]).alias("y1"), F.max(b["x2"]).alias("x2"), F.max(b["y2"]).alias("y2")]


def fit_in(b: Column, panel: Column, pad: int) -> Column:
    """b moved into the panel less a margin, its size kept."""
    w, h = b["x2"] - b["x1"], b["y2"] - b["y1"]
    x = F.greatest(panel["x1"] + pad, F.least(b["x1"], panel["x2"] - pad - w))
    y = F.greatest(panel["y1"] + pad, F.least(b["y1"], panel["y2"] - pad - h))
    return box(x, y, x + w, y + h)


def affine(angle: Column, scale: Column, tx: Column, ty: Column, width, height) -> list[Column]:
    """The six numbers of a turn by angle degrees and scaling about the centre, then a shift."""
    a, b = scale * F.cos(F.radians(angle)), scale * F.sin(F.radians(angle))
    cx, cy = (x / 2 if isinstance(x, Column) else F.lit(x / 2) for x in (width, height))
    return [a, b, (1 - a) * cx - b * cy + tx, -b, a, b * cx + (1 - a) * cy + ty]


def transformed(b: Column, m: list[Column]) -> Column:
    """The upright box around b's four corners after the affine map."""
    corners = [(b[x], b[y]) for x in ("x1", "x2") for y in ("y1", "y2")]
    xs, ys = [m[0] * x + m[1] * y + m[2] for x, y in corners], [m[3] * x + m[4] * y + m[5] for x, y in corners]
    return box(F.least(*xs), F.least(*ys), F.greatest(*xs), F.greatest(*ys))


def as_array(b: Column) -> Column:
    return F.array(*[b[n].cast("int") for n in FIELDS])
