"""Direction rules for binarised eye images."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

DARK_LIMIT = 75


def zone(index: Column, size: Column) -> Column:
    """0, 1 or 2: the third of ``size`` that ``index`` falls in, edges to the middle."""
    return F.when(index * 3 < size, 0).when(index * 3 > size * 2, 2).otherwise(1)


def gaze_decision(left: Column, centre: Column, right: Column, top: Column, middle: Column, bottom: Column) -> Column:
    """The strict majority decides; a tie gives no action (null)."""
    ahead = (
        F.when((top > middle) & (top > bottom), "front")
        .when((middle > top) & (middle > bottom), "stop")
        .when((bottom > top) & (bottom > middle), "back")
    )
    return (
        F.when((right > left) & (right > centre), "right")
        .when((centre > left) & (centre > right), ahead)
        .when((left > centre) & (left > right), "left")
    )
