"""Great-circle distance and facility lookups as native column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from haulmetrics.schema import EARTH_RADIUS_KM


def _col(x) -> Column:
    if isinstance(x, Column):
        return x
    return F.col(x) if isinstance(x, str) else F.lit(float(x))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle km; arguments are columns, column names or numbers in degrees.

    Null when any coordinate is null (``least`` would skip the null and give half the globe).
    """
    phi1, phi2 = F.radians(_col(lat1)), F.radians(_col(lat2))
    half_dphi = (phi2 - phi1) / 2
    half_dlambda = (F.radians(_col(lon2)) - F.radians(_col(lon1))) / 2
    h = F.sin(half_dphi) * F.sin(half_dphi) + F.cos(phi1) * F.cos(phi2) * F.sin(half_dlambda) * F.sin(half_dlambda)
    return F.lit(2 * EARTH_RADIUS_KM) * F.asin(F.sqrt(F.when(h > 1, 1.0).otherwise(h)))


def degree_gap(lat1, lon1, lat2, lon2) -> Column:
    """Squared Euclidean distance in degrees (the clustering metric)."""
    dlat, dlon = _col(lat1) - _col(lat2), _col(lon1) - _col(lon2)
    return dlat * dlat + dlon * dlon


def facility_array(facilities: Sequence[tuple[float, float]], first_id: int = 0) -> Column:
    """Literal ``array<struct<id,lat,lon>>``; callers keep the list short."""
    return F.array(*[F.struct(F.lit(first_id + i).alias("id"), F.lit(float(lat)).alias("lat"),
                              F.lit(float(lon)).alias("lon"))
                     for i, (lat, lon) in enumerate(facilities)])


def nearest_in(array: Column, lat, lon) -> Column:
    """Nearest element of ``array<struct<id,lat,lon>>`` by degrees, lowest id on ties.

    Returns ``struct<gap,id,lat,lon>``; null when a coordinate is null.
    """
    lat, lon = _col(lat), _col(lon)
    scored = F.transform(array, lambda f: F.struct(
        degree_gap(lat, lon, f["lat"], f["lon"]).alias("gap"), f["id"].alias("id"),
        f["lat"].alias("lat"), f["lon"].alias("lon")))
    return F.when(lat.isNotNull() & lon.isNotNull(), F.array_min(scored))
