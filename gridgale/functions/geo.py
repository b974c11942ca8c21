"""Distances on the sphere and shapes on the grid."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two Earth radii in use and the length of one degree of latitude, km.
RADIUS_TRACKS = 6371.0
RADIUS_EXTENT = 6378.1
KM_PER_DEG_LAT = 111.325


def cos_angle(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Cosine of the angle between two points, by the spherical law of cosines."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    return F.sin(p1) * F.sin(p2) + F.cos(F.radians(lon1 - lon2)) * F.cos(p1) * F.cos(p2)


def angle_to_km(cosine: Column, radius: float) -> Column:
    """Rounding can push the cosine past 1, where acos is NaN; such points coincide."""
    clamped = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))
    return F.lit(radius) * F.acos(clamped)


def distance_km(
    lon1: Column, lat1: Column, lon2: Column, lat2: Column, radius: float = RADIUS_TRACKS
) -> Column:
    return angle_to_km(cos_angle(lon1, lat1, lon2, lat2), radius)


def planar_distance(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Distance in degrees, ignoring the curvature."""
    dx, dy = lon1 - lon2, lat1 - lat2
    return F.sqrt(dx * dx + dy * dy)


def degree_of_longitude_km(latitude: Column) -> Column:
    return F.lit(math.pi / 180.0 * RADIUS_TRACKS) * F.cos(F.radians(latitude))


def region_area_km2(cells: Column, latitude: Column, res_lat: float, res_lon: float) -> Column:
    """Area of `cells` grid cells, all sized as at `latitude`."""
    return (
        cells * F.lit(res_lat * res_lon) * F.lit(KM_PER_DEG_LAT) * degree_of_longitude_km(latitude)
    )


def equal_area_diameter(area: Column) -> Column:
    return F.sqrt(area / F.lit(math.pi)) * F.lit(2.0)


def major_axis_from_ratio(area: Column, ratio: Column) -> Column:
    """Major axis of an ellipse, from its area and its minor-to-major ratio."""
    return F.sqrt(area / (F.lit(math.pi) * ratio))


def major_axis_from_eccentricity(area: Column, eccentricity: Column) -> Column:
    flattening = F.sqrt(F.lit(1.0) - eccentricity * eccentricity)
    return F.sqrt(area / (F.lit(math.pi) * flattening))


def eccentricity_from_ratio(ratio: Column) -> Column:
    return ratio * F.sqrt(F.lit(1.0) / (ratio * ratio) - F.lit(1.0))


def nearest_quarter(coordinate: Column) -> Column:
    """Nearest quarter degree; ties go to the even quarter."""
    return F.rint(coordinate * F.lit(4.0)) / F.lit(4.0)


def display_row(iy: Column, ny: int) -> Column:
    """Row number counted from the south."""
    return F.lit(ny - 1) - iy
