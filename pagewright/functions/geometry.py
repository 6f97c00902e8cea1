"""Boxes as arrays of four numbers: left, top, right, bottom, measured from the top left corner."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
MIN_OVERLAP = 0.5
KNOWN = 0.001
CLIP_PAD = 3.0
IMAGE_WIDTH, IMAGE_HEIGHT, PAGE_BAND = (10, 400), (10, 200), (0.15, 0.85)


def box(l: Column, t: Column, r: Column, b: Column) -> Column:  # noqa: E741
    return F.array(l, t, r, b)


def union_of(a: Column, b: Column) -> Column:
    """G1, of two boxes."""
    return F.array(F.least(a[0], b[0]), F.least(a[1], b[1]), F.greatest(a[2], b[2]), F.greatest(a[3], b[3]))


def union_agg(c: Column) -> Column:
    """G1, of a group; zeros for none."""
    none = F.array(*[F.lit(0.0)] * 4)
    return F.when(F.count(c) == 0, none).otherwise(F.array(F.min(c[0]), F.min(c[1]), F.max(c[2]), F.max(c[3])))


def iou(a: Column, b: Column) -> Column:
    """G2; 0 for boxes that don't overlap."""
    w = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    h = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    area = lambda x: (x[2] - x[0]) * (x[3] - x[1])
    return F.when((w <= 0) | (h <= 0), F.lit(0.0)).otherwise(w * h / (area(a) + area(b) - w * h))


def same_band(a: Column, b: Column) -> Column:
    """Boxes that share a horizontal band."""
    return F.least(a[3], b[3]) - F.greatest(a[1], b[1]) > MIN_OVERLAP


def from_bottom(b: Column, height: Column) -> Column:
    """A box measured from the bottom left corner."""
    return F.array(F.round(b[0], 1), F.round(height - b[1], 1), F.round(b[2], 1), F.round(height - b[3], 1))


def clip(b: Column, width: Column, height: Column) -> Column:
    """A box from the bottom left corner, widened and kept on the page."""
    return F.array(F.greatest(b[0] - CLIP_PAD, F.lit(0.0)), F.greatest(height - b[1] - CLIP_PAD, F.lit(0.0)), F.least(b[2] + CLIP_PAD, width), F.least(height - b[3] + CLIP_PAD, height))


def known(b: Column) -> Column:
    """A box that is there and not all zero."""
    return F.coalesce(F.exists(b, lambda v: F.abs(v) > KNOWN), F.lit(False))


def image_candidate(b: Column, height: Column) -> Column:
    """An image the size of a formula, away from the page's head and foot."""
    w, h = b[2] - b[0], b[3] - b[1]
    return (w > IMAGE_WIDTH[0]) & (w < IMAGE_WIDTH[1]) & (h > IMAGE_HEIGHT[0]) & (h < IMAGE_HEIGHT[1]) & (b[1] >= height * PAGE_BAND[0]) & (b[3] <= height * PAGE_BAND[1])
