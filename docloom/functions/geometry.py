"""Boxes as structs (x0, y0, x1, y1) and their measures as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def box(x0, y0, x1, y1) -> Column:
    f = lambda v: F.col(v) if isinstance(v, str) else v
    return F.struct(*[f(v).cast("double").alias(n) for v, n in zip((x0, y0, x1, y1), ("x0", "y0", "x1", "y1"), strict=True)])


def width(b: Column) -> Column:
    return b["x1"] - b["x0"]


def height(b: Column) -> Column:
    return b["y1"] - b["y0"]


def area(b: Column) -> Column:
    return width(b) * height(b)


def center(b: Column) -> Column:
    return F.struct(((b["x0"] + b["x1"]) / 2).alias("x"), ((b["y0"] + b["y1"]) / 2).alias("y"))


def expand(b: Column, x_margin: float, y_margin: float) -> Column:
    """Margins are shares of the box's own size."""
    dx, dy = width(b) * x_margin, height(b) * y_margin
    return box(b["x0"] - dx, b["y0"] - dy, b["x1"] + dx, b["y1"] + dy)


def rescale(b: Column, old: tuple[Column, Column], new: tuple[Column, Column]) -> Column:
    sx, sy = new[0] / old[0], new[1] / old[1]
    return box(b["x0"] * sx, b["y0"] * sy, b["x1"] * sx, b["y1"] * sy)


def fit_to(b: Column, bounds: Column) -> Column:
    x = lambda v: F.least(F.greatest(v, bounds["x0"]), bounds["x1"])
    y = lambda v: F.least(F.greatest(v, bounds["y0"]), bounds["y1"])
    return box(x(b["x0"]), y(b["y0"]), x(b["x1"]), y(b["y1"]))


def merged(b: Column) -> Column:
    """Aggregate: the box around all boxes of a group."""
    return box(F.min(b["x0"]), F.min(b["y0"]), F.max(b["x1"]), F.max(b["y1"]))


def _if_known(a: Column, b: Column, axis: str, value: Column) -> Column:
    """greatest() and least() pass over nulls, so a measure of a box that isn't there has to be null by itself."""
    ends = (a[f"{axis}0"], a[f"{axis}1"], b[f"{axis}0"], b[f"{axis}1"])
    return F.when(ends[0].isNotNull() & ends[1].isNotNull() & ends[2].isNotNull() & ends[3].isNotNull(), value)


def overlap_x(a: Column, b: Column) -> Column:
    """Null where either box is or lacks an end."""
    return _if_known(a, b, "x", F.greatest(F.lit(0.0), F.least(a["x1"], b["x1"]) - F.greatest(a["x0"], b["x0"])))


def overlap_y(a: Column, b: Column) -> Column:
    """Null where either box is or lacks an end."""
    return _if_known(a, b, "y", F.greatest(F.lit(0.0), F.least(a["y1"], b["y1"]) - F.greatest(a["y0"], b["y0"])))


def intersection_area(a: Column, b: Column) -> Column:
    return overlap_x(a, b) * overlap_y(a, b)


def intersection_share(a: Column, b: Column) -> Column:
    """Share of a's own area; 0 if it has none."""
    return F.when(area(a) == 0, F.lit(0.0)).otherwise(intersection_area(a, b) / area(a))


def iou(a: Column, b: Column) -> Column:
    both = intersection_area(a, b)
    union = area(a) + area(b) - both
    return F.when((both == 0) | (union == 0), F.lit(0.0)).otherwise(both / union)


def center_distance(a: Column, b: Column, x_weight: float = 1.0, y_weight: float = 1.0, absolute: bool = False) -> Column:
    dx = (a["x0"] + a["x1"] - b["x0"] - b["x1"]) / 2 * x_weight
    dy = (a["y0"] + a["y1"] - b["y0"] - b["y1"]) / 2 * y_weight
    return F.abs(dx) + F.abs(dy) if absolute else F.sqrt(dx * dx + dy * dy)


def corner_distance(a: Column, b: Column) -> Column:
    """Between the top-left corners."""
    return F.sqrt((a["x0"] - b["x0"]) * (a["x0"] - b["x0"]) + (a["y0"] - b["y0"]) * (a["y0"] - b["y0"]))


def gap(a: Column, b: Column) -> Column:
    """Shortest distance between two boxes; 0 where they touch, null where either box is or lacks an end."""
    dx = _if_known(a, b, "x", F.greatest(F.lit(0.0), b["x0"] - a["x1"], a["x0"] - b["x1"]))
    dy = _if_known(a, b, "y", F.greatest(F.lit(0.0), b["y0"] - a["y1"], a["y0"] - b["y1"]))
    return F.sqrt(dx * dx + dy * dy)


def line_order(b: Column, tolerance: float = 1.25) -> list[Column]:
    """Sort keys that put lines of nearly one height beside each other, left to right."""
    return [F.bround(b["y0"] / tolerance) * tolerance, b["x0"]]
