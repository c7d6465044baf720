"""Geographic column expressions: great-circle distance and box predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import EARTH_RADIUS_KM, Box


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine_km(
    lat1: str | Column = "pickup_latitude",
    lon1: str | Column = "pickup_longitude",
    lat2: str | Column = "dropoff_latitude",
    lon2: str | Column = "dropoff_longitude",
    radius_km: float = EARTH_RADIUS_KM,
) -> Column:
    """Great-circle distance in km (haversine, atan2 form).

    ``a = sin^2(dphi/2) cos^2(dlmb/2) + cos^2((phi1+phi2)/2) sin^2(dlmb/2)``
    lies in [0, 1] for ANY real angles; only rounding can push it a hair
    outside (then ``sqrt(1 - a)`` would be NaN). ``abs`` folds that rounding
    back in while a null stays null and a NaN stays NaN (``least``/``greatest``
    would turn NaN into 1 and null into 0), and ``a`` appears twice, as in the
    plain formula: a ``when`` clamp repeats it five times, and a filter on the
    distance (no subexpression elimination in filters) then costs ~10x.
    """
    lat1, lon1, lat2, lon2 = map(_col, (lat1, lon1, lat2, lon2))
    dphi = F.radians(lat2 - lat1)
    dlmb = F.radians(lon2 - lon1)
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlmb / 2), 2)
    return F.lit(radius_km) * 2 * F.atan2(F.sqrt(F.abs(a)), F.sqrt(F.abs(1 - a)))


def in_box(lon: str | Column, lat: str | Column, box: Box) -> Column:
    """Inclusive ``between`` on both axes; null or NaN coordinates do not pass."""
    return _col(lon).between(box.lon[0], box.lon[1]) & _col(lat).between(box.lat[0], box.lat[1])


def trip_in_box(box: Box) -> Column:
    """Both ends of the trip inside ``box`` (the loose cleaning box)."""
    return in_box("pickup_longitude", "pickup_latitude", box) & in_box("dropoff_longitude", "dropoff_latitude", box)
