"""Great-circle distance and the grid that turns a radius search into an equi join."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0
KM_PER_DEGREE = EARTH_RADIUS_KM * math.pi / 180.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in kilometres on a sphere."""
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_dlat), 2.0) + F.cos(F.radians(lat1)) * F.cos(
        F.radians(lat2)
    ) * F.pow(F.sin(half_dlon), 2.0)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))


def bounding_box(lat: float, lon: float, radius_km: float) -> tuple[float, float, float, float]:
    """(lat low, lat high, lon low, lon high) that contains the whole circle."""
    dlat = radius_km / KM_PER_DEGREE
    edge = min(90.0, abs(lat) + dlat)
    reach = math.sin(min(math.pi / 2, radius_km / (2 * EARTH_RADIUS_KM)))
    shrink = math.sqrt(max(0.0, math.cos(math.radians(lat)) * math.cos(math.radians(edge))))
    dlon = 180.0 if reach >= shrink else math.degrees(2 * math.asin(reach / shrink))
    slack = 1e-9
    return lat - dlat - slack, lat + dlat + slack, lon - dlon - slack, lon + dlon + slack


class Grid:
    """Cells about one radius wide: latitude bands, each cut into whole longitude cells.

    The number of longitude cells of a band follows its latitude, so cells keep
    their width in kilometres everywhere and wrap around at 180 degrees.
    """

    def __init__(self, radius_km: float):
        self.radius_km = radius_km
        self.step = 1.01 * radius_km / KM_PER_DEGREE

    def band(self, lat: Column) -> Column:
        return F.floor(lat / F.lit(self.step)).cast("long")

    def _edge_cos(self, band: Column) -> Column:
        edge = F.greatest(F.abs(band * self.step), F.abs((band + 1) * self.step))
        return F.cos(F.radians(F.least(edge, F.lit(89.999))))

    def cells_in(self, band: Column) -> Column:
        """How many longitude cells a band has."""
        return F.greatest(
            F.floor(F.lit(360.0 / self.step) * self._edge_cos(band)).cast("long"), F.lit(1)
        ).cast("long")

    def cell(self, lon: Column, band: Column) -> Column:
        n = self.cells_in(band)
        return F.pmod(F.floor((lon + 180.0) * n / 360.0).cast("long"), n)

    def bands_around(self, lat: Column) -> Column:
        """Bands a circle around ``lat`` can touch."""
        reach = self.radius_km * 1.0001 / KM_PER_DEGREE
        return F.sequence(self.band(lat - reach), self.band(lat + reach))

    def cells_around(self, lat: Column, lon: Column, band: Column) -> Column:
        """Cells of ``band`` that a circle around (lat, lon) can touch."""
        n = self.cells_in(band)
        sine = math.sin(self.radius_km / (2 * EARTH_RADIUS_KM)) * 1.0001
        ratio = F.lit(sine) / F.sqrt(F.cos(F.radians(lat)) * self._edge_cos(band))
        dlon = F.when(ratio >= 1, F.lit(180.0)).otherwise(F.degrees(2 * F.asin(ratio)))
        low = F.floor((lon - dlon + 180.0) * n / 360.0).cast("long")
        high = F.floor((lon + dlon + 180.0) * n / 360.0).cast("long")
        span = F.when(high - low + 1 >= n, F.sequence(F.lit(0).cast("long"), n - 1)).otherwise(
            F.sequence(low, high)
        )
        return F.transform(span, lambda c: F.pmod(c, n))
