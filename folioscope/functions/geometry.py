"""Box geometry as Column expressions.

Boxes are x, y, w, h in page units of 0..1000 from the top left, unless a name says corners (x0, y0, x1, y1).
Every operator that uses a tolerance names its own; they are not the same.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F


class Box(NamedTuple):
    x: Column
    y: Column
    w: Column
    h: Column

    @property
    def right(self) -> Column:
        return self.x + self.w

    @property
    def bottom(self) -> Column:
        return self.y + self.h

    @property
    def cx(self) -> Column:
        return self.x + self.w / 2

    @property
    def cy(self) -> Column:
        return self.y + self.h / 2

    @property
    def area(self) -> Column:
        return self.w * self.h


def box(prefix: str = "") -> Box:
    """The box in the columns prefix + x, y, w, h."""
    return Box(*(F.col(prefix + c) for c in "xywh"))


def corners(x0: Column, y0: Column, x1: Column, y1: Column) -> Box:
    return Box(x0, y0, x1 - x0, y1 - y0)


def _span(low: Column, high: Column, limit: float = 1000.0) -> tuple[Column, Column]:
    start = F.least(F.greatest(low, F.lit(0.0)), F.lit(limit))
    return start, F.least(F.greatest(high - low, F.lit(0.0)), F.lit(limit) - start)


def normalized(x0: Column, y0: Column, x1: Column, y1: Column, width: Column, height: Column) -> Box:
    """Points to page units: the corner is clamped first, then the size to what is left of the page."""
    x, w = _span(x0 * 1000 / width, x1 * 1000 / width)
    y, h = _span(y0 * 1000 / height, y1 * 1000 / height)
    return Box(x, y, w, h)


def clamped_corners(x0: Column, y0: Column, x1: Column, y1: Column, width: Column, height: Column) -> Box:
    """Pixels to page units with both corners clamped, so that a box over the edge loses width."""
    inside = lambda v: F.least(F.greatest(v, F.lit(0.0)), F.lit(1000.0))
    return corners(inside(x0 * 1000 / width), inside(y0 * 1000 / height), inside(x1 * 1000 / width), inside(y1 * 1000 / height))


def proposal_box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Struct x, y, w, h of proposed corners, null unless 0 <= x0 < x1 <= 1000 and likewise y. Never clamped."""
    good = (x0 >= 0) & (x0 < x1) & (x1 <= 1000) & (y0 >= 0) & (y0 < y1) & (y1 <= 1000)
    good = good & ~F.isnan(x0.cast("double")) & ~F.isnan(x1.cast("double"))
    return F.when(good, F.struct(x0.alias("x"), y0.alias("y"), (x1 - x0).alias("w"), (y1 - y0).alias("h")))


def center_in(inner: Box, outer: Box, margin: float = 0) -> Column:
    """The centre of inner lies in outer, borders included, widened by margin."""
    return inner.cx.between(outer.x - margin, outer.right + margin) & inner.cy.between(outer.y - margin, outer.bottom + margin)


def same_place(a: Box, b: Box, within: float = 15) -> Column:
    return (F.abs(a.cx - b.cx) < within) & (F.abs(a.cy - b.cy) < within)


def intersection(a: Box, b: Box) -> Column:
    zero = F.lit(0)
    wide = F.greatest(F.least(a.right, b.right) - F.greatest(a.x, b.x), zero)
    high = F.greatest(F.least(a.bottom, b.bottom) - F.greatest(a.y, b.y), zero)
    return wide * high


def overlap_of_smaller(a: Box, b: Box, least_area: float = 1) -> Column:
    """Shared area over the smaller area. The divisor is at least least_area; with 0 an empty box gives 0."""
    smaller = F.least(a.area, b.area)
    if least_area:
        return intersection(a, b) / F.greatest(smaller, F.lit(least_area))
    return F.coalesce(F.try_divide(intersection(a, b), smaller), F.lit(0.0))


def coverage(region: Box, candidate: Box) -> Column:
    """Shared area over the candidate's area."""
    return F.coalesce(F.try_divide(intersection(region, candidate), candidate.area), F.lit(0.0))


def projection_overlap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    """Shared length over the shorter length, at least 1."""
    shared = F.greatest(F.least(a1, b1) - F.greatest(a0, b0), F.lit(0))
    return shared / F.greatest(F.least(a1 - a0, b1 - b0), F.lit(1))


def distance(a: Box, b: Box) -> Column:
    return F.sqrt(F.pow(a.cx - b.cx, 2) + F.pow(a.cy - b.cy, 2))


def envelope(of: Box) -> list[Column]:
    """Aggregates for the smallest box around a group."""
    return [F.min(of.x).alias("x"), F.min(of.y).alias("y"), (F.max(of.right) - F.min(of.x)).alias("w"), (F.max(of.bottom) - F.min(of.y)).alias("h")]


def expanded_visual(of: Box, page_width: float = 1000, page_height: float = 1000) -> Box:
    """A visual with room for its labels: 8 % of the page at the sides, 10 % above, 14 % below but not into the foot."""
    x0, y0 = F.greatest(of.x - page_width * 0.08, F.lit(0.0)), F.greatest(of.y - page_height * 0.10, F.lit(0.0))
    x1 = F.least(of.right + page_width * 0.08, F.lit(float(page_width)))
    y1 = F.least(of.bottom + page_height * 0.14, F.lit(page_height * 0.87))
    return corners(x0, y0, x1, y1)


def to_pixels(of: Box, region: Box, width: Column, height: Column) -> Box:
    """Page units to pixels of an image of a region."""
    return Box((of.x - region.x) * width / region.w, (of.y - region.y) * height / region.h, of.w * width / region.w, of.h * height / region.h)


def to_page(of: Box, region: Box, width: Column, height: Column) -> Box:
    """Pixels of an image of a region to page units."""
    return Box(region.x + of.x * region.w / width, region.y + of.y * region.h / height, of.w * region.w / width, of.h * region.h / height)


def mercator_y(latitude: Column) -> Column:
    return F.log(F.tan(F.lit(0.7853981633974483) + F.radians(latitude) / 2))


def albers(longitude: Column, latitude: Column) -> tuple[Column, Column]:
    """Spherical Albers equal-area: standard parallels 29.5 and 45.5, origin 37.5 north 96 west (fixed values)."""
    import math

    p1, p2, p0, l0 = (math.radians(v) for v in (29.5, 45.5, 37.5, -96.0))
    n = (math.sin(p1) + math.sin(p2)) / 2
    c = math.cos(p1) ** 2 + 2 * n * math.sin(p1)
    rho0 = math.sqrt(c - 2 * n * math.sin(p0)) / n
    rho = F.sqrt(F.lit(c) - 2 * n * F.sin(F.radians(latitude))) / n
    theta = (F.radians(longitude) - l0) * n
    return rho * F.sin(theta), F.lit(rho0) - rho * F.cos(theta)
