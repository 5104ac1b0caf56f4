"""Ratios and rounding with the same result on every engine."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"


def money(value: Column) -> Column:
    return value.cast(MONEY)


def safe_ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` as double; null when the bottom is zero or null."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def round_half_up(value: Column, places: int) -> Column:
    """Round through a decimal, so a binary fraction never decides a tie."""
    return F.round(value.cast("decimal(28,8)"), places)


def ratio_pct(top: Column, bottom: Column, places: int = 1) -> Column:
    return round_half_up(safe_ratio(top, bottom) * 100, places).cast("double")


def average_money(total: Column, count: Column) -> Column:
    return round_half_up(safe_ratio(total, count), 2).cast(MONEY)


def finite(value: Column) -> Column:
    """Null in place of NaN and the infinities."""
    infinite = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    return F.when(~infinite, value)
