"""Geographic column expressions: box containment, great-circle distance
and boxes around a point."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ------------------------------------------------------------
EARTH_RADIUS_KM = 6371.0          # mean Earth radius used by the great-circle distance
METERS_PER_DEGREE = 111_320.0     # length of one degree of latitude, used for radius boxes


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x) if isinstance(x, str) else F.lit(x)


def strictly_inside(lat, lon, tl_y, tl_x, br_y, br_x) -> Column:
    """Point (lat, lon) strictly inside the axis-aligned box given by two corners.

    The box is the polygon of its four corners, so the corner order does not
    matter (plain min/max; boxes crossing the date line are not special-cased).
    Points on an edge are outside.
    """
    lat, lon = _c(lat), _c(lon)
    tl_y, tl_x, br_y, br_x = _c(tl_y), _c(tl_x), _c(br_y), _c(br_x)
    return (
        (lat > F.least(tl_y, br_y)) & (lat < F.greatest(tl_y, br_y))
        & (lon > F.least(tl_x, br_x)) & (lon < F.greatest(tl_x, br_x))
    )


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in kilometres between two points in degrees."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dlat = p2 - p1
    dlon = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(a))


def box_around(lat, lon, half_lat, half_lon) -> dict[str, Column]:
    """Box columns (tl_y, tl_x, br_y, br_x) centred on a point."""
    lat, lon, half_lat, half_lon = _c(lat), _c(lon), _c(half_lat), _c(half_lon)
    return {
        "tl_y": lat + half_lat, "tl_x": lon - half_lon,
        "br_y": lat - half_lat, "br_x": lon + half_lon,
    }


def radius_to_half_widths(radius_m, lat) -> tuple[Column, Column]:
    """Half widths in degrees of the box enclosing a circle of ``radius_m`` metres.

    A circle that holds a pole, or is wider than the globe, spans all longitudes
    (half width 361, so that the box holds them, both ends too, from any centre)."""
    radius_m, lat = _c(radius_m), _c(lat)
    half_lat = radius_m / F.lit(METERS_PER_DEGREE)
    half_lon = radius_m / (F.lit(METERS_PER_DEGREE) * F.greatest(F.cos(F.radians(lat)), F.lit(1e-9)))
    round_pole = (F.abs(lat) + half_lat >= 90.0) | (half_lon >= 180.0)
    return half_lat, F.when(round_pole, F.lit(361.0)).otherwise(half_lon)


def circle_half_widths(radius_m, lat) -> tuple[Column, Column]:
    """Half widths in degrees of the least box that holds a circle on the globe (a little more, for rounding);
    all longitudes for a circle that holds a pole."""
    angle = _c(radius_m) / F.lit(1000.0 * EARTH_RADIUS_KM)
    half_lat = F.degrees(angle) + F.lit(1e-6)
    reach = F.sin(F.least(angle, F.lit(1.5707963267948966))) / F.greatest(F.cos(F.radians(_c(lat))), F.lit(1e-12))
    half_lon = F.degrees(F.asin(F.least(reach, F.lit(1.0)))) + F.lit(1e-6)
    return half_lat, F.when(F.abs(_c(lat)) + half_lat >= 90.0, F.lit(361.0)).otherwise(half_lon)
