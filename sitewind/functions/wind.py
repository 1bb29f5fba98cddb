"""Wind direction sectors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sector labels clockwise from north. Even places are the exact multiples of 45
# degrees, odd places the open arcs between them.
SECTORS = [
    "N", "NNE", "NE", "ENE", "E", "ESE", "SE", "SSE",
    "S", "SSW", "SW", "WSW", "W", "WNW", "NW", "NNW",
]

_ARC = 4500  # hundredths of a degree between two exact directions


def sector_index(direction: Column) -> Column:
    """Place in :data:`SECTORS` of a direction in hundredths of a degree.

    An exact multiple of 45 degrees is a sector of its own; everything between two of them
    belongs to the one sector in between. NULL outside 0 <= direction < 360.
    """
    arc = F.floor(direction / F.lit(float(_ARC)))
    between = (direction % F.lit(_ARC) > 0).cast("int")
    inside = (direction >= 0) & (direction < 8 * _ARC)
    return F.when(inside, (arc * 2 + between).cast("int"))


def in_a_sector(direction: Column) -> Column:
    """Whether an unrounded direction, in degrees, rounds to one that has a sector.

    The same as asking for the sector, but on the plain column: the files can be filtered by it.
    """
    return (direction > F.lit(-0.005)) & (direction < F.lit(359.995))


def sector_label(index: Column) -> Column:
    # element_at on an array without NULLs is taken to never be NULL, even for a NULL index.
    labels = F.array(*[F.lit(label) for label in SECTORS])
    return F.when(index.isNotNull(), F.element_at(labels, index + 1))


# Sines and cosines are summed as whole millionths, which makes the sums exact.
_UNIT = 1e6


def direction_sine(direction: Column) -> Column:
    """Sine of a direction in hundredths of a degree, in whole millionths."""
    return F.floor(F.sin(F.radians(direction / F.lit(100.0))) * F.lit(_UNIT) + F.lit(0.5))


def direction_cosine(direction: Column) -> Column:
    """Cosine of a direction in hundredths of a degree, in whole millionths."""
    return F.floor(F.cos(F.radians(direction / F.lit(100.0))) * F.lit(_UNIT) + F.lit(0.5))


def mean_direction(sines: Column, cosines: Column) -> Column:
    """Direction in [0, 360), to 2 places, of summed unit vectors; NULL if they cancel out."""
    angle = F.degrees(F.atan2(sines.cast("double"), cosines.cast("double")))
    positive = F.when(angle < 0, angle + F.lit(360.0)).otherwise(angle)
    return F.when((sines != 0) | (cosines != 0), F.round(positive, 2) % F.lit(360.0))
