"""Boxes as Column expressions.  ``xywh`` holds corner and size, ``xyxy`` two corners."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _corners(box: Column, form: str) -> tuple[Column, Column, Column, Column]:
    a, b, c, d = (F.get(box, F.lit(i)) for i in range(4))
    return (a, b, a + c, b + d) if form == "xywh" else (a, b, c, d)


def iou(p: Column, q: Column, form: str = "xywh") -> Column:
    """Intersection over union; 0 for missing, malformed or (as xyxy) all-zero boxes."""
    x1, y1, x2, y2 = _corners(p, form)
    u1, v1, u2, v2 = _corners(q, form)
    zero = F.lit(0)
    inter = F.greatest(zero, F.least(x2, u2) - F.greatest(x1, u1)) * F.greatest(zero, F.least(y2, v2) - F.greatest(y1, v1))
    union = (x2 - x1) * (y2 - y1) + (u2 - u1) * (v2 - v1) - inter
    ok = F.coalesce((F.size(p) == 4) & (F.size(q) == 4), F.lit(False))
    if form == "xyxy":
        nil = F.array(*(F.lit(0) for _ in range(4)))
        ok = ok & (p != nil) & (q != nil)
    return F.when(ok & (union > 0), inter / union).otherwise(0.0)


def polygon_to_xywh(points: Column) -> Column:
    """The box around a polygon, truncated to whole pixels."""
    xs, ys = F.transform(points, lambda p: p[0]), F.transform(points, lambda p: p[1])
    x, y = F.array_min(xs).cast("int"), F.array_min(ys).cast("int")
    return F.array(x, y, F.array_max(xs).cast("int") - x, F.array_max(ys).cast("int") - y)


def to_xyxy(xywh: Column) -> Column:
    return F.array(*_corners(xywh, "xywh"))


def to_xywh(xyxy: Column) -> Column:
    a, b, c, d = _corners(xyxy, "xyxy")
    return F.array(a, b, c - a, d - b)


def touches(p: Column, q: Column) -> Column:
    """Whether two xywh boxes overlap or share an edge."""
    x1, y1, x2, y2 = _corners(p, "xywh")
    u1, v1, u2, v2 = _corners(q, "xywh")
    return ~((x2 < u1) | (x1 > u2) | (y2 < v1) | (y1 > v2))


def clamp(box: Column, width: Column, height: Column) -> Column:
    """An xywh box cut to an image."""
    x1, y1, x2, y2 = _corners(box, "xywh")
    zero = F.lit(0)
    left, top = F.greatest(zero, x1), F.greatest(zero, y1)
    return F.array(left, top, F.least(x2, width) - left, F.least(y2, height) - top)
