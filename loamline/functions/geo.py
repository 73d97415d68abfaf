"""Projections and grids."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS = 6378137.0  # of the Web Mercator sphere, in metres
MERCATOR_LIMIT = 20037508.34


def latitude_of(y: Column) -> Column:
    """Web Mercator y in metres to degrees."""
    return F.atan(F.sinh(y / EARTH_RADIUS)) * 180.0 / math.pi


def longitude_of(x: Column) -> Column:
    return x / EARTH_RADIUS * 180.0 / math.pi


def grid(value: Column, digits: int = 2) -> Column:
    """Rounded half away from zero as a decimal, so that cells of different sources are equal."""
    return F.round(value.cast("decimal(38,9)"), digits)
