"""Derived measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent(part: Column, whole: Column, digits: int) -> Column:
    """``part`` as a rounded percentage of ``whole``; NULL for a zero whole."""
    return F.round(F.try_divide(part, whole) * 100, digits)


def like_ratio(likes: Column, views: Column) -> Column:
    return F.when(views > 0, percent(likes, views, 4)).otherwise(F.lit(0.0))


def engagement_rate(
    likes: Column, dislikes: Column, comments: Column, views: Column
) -> Column:
    return F.when(
        views > 0, percent(likes + dislikes + comments, views, 4)
    ).otherwise(F.lit(0.0))


RATIO_UNIT = 10_000  # ratios carry four decimals


def ratio_units(c: Column) -> Column:
    """A four-digit ratio in whole ten-thousandths.

    Whole numbers add up exactly in a DOUBLE (to 2^53), so a sum of them does not depend
    on how rows were partitioned, at a fraction of the cost of DECIMAL sums.
    """
    return F.rint(c * RATIO_UNIT)


def average(total: Column, n: Column) -> Column:
    return F.try_divide(total.cast("double"), n)


def average_ratio(units: Column, n: Column) -> Column:
    return average(units / RATIO_UNIT, n)
