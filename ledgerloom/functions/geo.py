"""Checks and normal form of vehicle positions that arrive as text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, functions as F


@dataclass(frozen=True)
class Fence:
    """A region positions must lie in."""

    south: float
    north: float
    west: float
    east: float


def as_degrees(text: Column) -> Column:
    return F.trim(text).try_cast("double")


def gps_reason(lat: Column, lon: Column, fence: Fence | None = None) -> Column:
    """Why a position is refused, or ``ok``."""
    y, x = as_degrees(lat), as_degrees(lon)
    empty = lat.isNull() | lon.isNull() | (lat == "") | (lon == "")
    unreadable = y.isNull() | x.isNull() | F.isnan(y) | F.isnan(x)
    inside = y.between(-90, 90) & x.between(-180, 180)
    reason = (
        F.when(empty, "empty")
        .when(unreadable, "not_a_number")
        .when((y == 0) & (x == 0), "null_island")
        .when(~inside, "out_of_bounds")
    )
    if fence is not None:
        within = y.between(fence.south, fence.north) & x.between(fence.west, fence.east)
        reason = reason.when(~within, "outside_fence")
    return reason.otherwise("ok")


def gps_normalise(text: Column) -> Column:
    """Six decimals, halves rounded up (towards the north and the east)."""
    return F.floor(as_degrees(text) * 1e6 + 0.5).cast("double") / 1e6
