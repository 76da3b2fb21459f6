"""Rounding and scoring curves as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, digits: int = 0) -> Column:
    """Binary half-up rounding: ``floor(x * 10^d + 0.5) / 10^d``.

    ``F.round`` rounds the decimal text of a double instead (0.285 -> 0.29, -2.5 -> -3).
    """
    factor = float(10**digits)
    scaled = F.floor(value.cast("double") * F.lit(factor) + F.lit(0.5)).cast("double")
    return scaled if digits == 0 else scaled / F.lit(factor)


def whole(value: Column) -> Column:
    """Half-up rounding to an integer column."""
    return F.floor(value.cast("double") + F.lit(0.5)).cast("int")


def clamp(value: Column, low: float = 0.0, high: float = 100.0) -> Column:
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


Curve = Sequence[tuple[float, float]]


def piecewise(raw: Column, curve: Curve) -> Column:
    """Linear interpolation through ``curve``, flat beyond its ends, inside 0..100; null stays null.

    Anchors are known when the plan is built, so slopes end up as literals in one CASE expression.
    """
    points = sorted((float(x), float(y)) for x, y in curve)
    if not points:
        raise ValueError("a curve needs at least one anchor")

    def bounded(score: float) -> Column:
        return F.lit(max(0.0, min(100.0, score)))

    x = raw.cast("double")
    (first_x, first_y), (last_x, last_y) = points[0], points[-1]
    branches = F.when(x.isNull(), F.lit(None).cast("double")).when(x <= first_x, bounded(first_y))
    branches = branches.when(x >= last_x, bounded(last_y))
    for (x0, y0), (x1, y1) in zip(points, points[1:]):
        share = (x - F.lit(x0)) / F.lit(x1 - x0) if x1 > x0 else F.lit(0.0)
        between = F.lit(y0) + share * F.lit(y1 - y0)
        inside = 0.0 <= min(y0, y1) and max(y0, y1) <= 100.0
        branches = branches.when(x <= x1, between if inside else clamp(between))
    return branches.otherwise(bounded(last_y))
