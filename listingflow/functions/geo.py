"""Distances and speeds as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import round_half_up

EARTH_RADIUS_M = 6_371_000.0


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle metres; null when any coordinate is null."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    h = half_lat * half_lat + half_lon * half_lon * F.cos(F.radians(lat1)) * F.cos(F.radians(lat2))
    # Not F.least(1, sqrt(h)): least skips nulls and would turn an unknown point into an antipode.
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.when(h > 1, F.lit(1.0)).otherwise(F.sqrt(h)))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    return haversine_m(lat1, lon1, lat2, lon2) / F.lit(1000.0)


def path_metres(points: Column) -> Column:
    """Metres along an ordered ``array<struct<lat, lon>>``; 0 for fewer than two points or null."""
    steps = F.size(points) - 1
    hops = F.zip_with(
        F.slice(points, F.lit(1), steps),
        F.slice(points, F.lit(2), steps),
        lambda a, b: haversine_m(a["lat"], a["lon"], b["lat"], b["lon"]),
    )
    total = F.aggregate(hops, F.lit(0.0), lambda acc, hop: acc + hop)
    return F.when(points.isNotNull() & (F.size(points) >= 2), total).otherwise(F.lit(0.0))


def walk_minutes(metres: Column, detour_factor: float, speed_m_per_min: float) -> Column:
    """Straight line to walking minutes, one decimal."""
    return round_half_up(metres * F.lit(float(detour_factor)) / F.lit(float(speed_m_per_min)), 1)


def implied_speed_kmh(km: Column, minutes: Column) -> Column:
    """km per hour, null when either measure is zero, negative or missing."""
    return F.when((minutes > 0) & (km > 0), km / (minutes / F.lit(60.0)))


def coordinate_text(value: Column) -> Column:
    """A coordinate at five decimals, trailing zeros dropped."""
    text = F.format_string("%.5f", round_half_up(value, 5))
    trimmed = F.regexp_replace(text, r"\.?0+$", "")
    return F.when(trimmed == "-0", F.lit("0")).otherwise(trimmed)


def route_key(mode: Column, from_lat: Column, from_lon: Column, to_lat: Column, to_lon: Column,
              when: Column | None = None, provider: Column | None = None) -> Column:
    """``mode[:provider]|when|lat,lng|lat,lng`` with coordinates at five decimals."""
    head = mode if provider is None else F.when(provider.isNull() | (provider == ""), mode).otherwise(
        F.concat(mode, F.lit(":"), provider)
    )
    moment = F.lit("") if when is None else F.coalesce(when, F.lit(""))
    ends = [
        F.concat(coordinate_text(lat), F.lit(","), coordinate_text(lon))
        for lat, lon in ((from_lat, from_lon), (to_lat, to_lon))
    ]
    return F.concat(head, F.lit("|"), moment, F.lit("|"), ends[0], F.lit("|"), ends[1])
