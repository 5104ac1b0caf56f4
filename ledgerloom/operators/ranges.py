"""Pairs of rows of one key whose dates lie within some days of each other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def day_number(day: Column) -> Column:
    return F.unix_date(day).cast("bigint")


def pairs_within_days(
    left: DataFrame, right: DataFrame, key: str, left_day: str, right_day: str, max_days: int
) -> DataFrame:
    """Join rows with ``0 < right_day - left_day <= max_days`` (calendar days) per key.

    Both sides are also keyed by a bin of ``max_days`` days, so that one key is spread
    over its whole time span; a left row goes to its own bin and the next, a right row
    to exactly one, hence no pair is found twice. Right columns other than the key
    must be named differently from the left ones.
    """
    width = F.lit(max_days)
    left_bin = F.floor(day_number(F.col(left_day)) / width)
    binned_left = left.withColumn("_bin", F.explode(F.array(left_bin, left_bin + 1)))
    binned_right = right.withColumn("_bin", F.floor(day_number(F.col(right_day)) / width))
    gap = F.datediff(F.col(right_day), F.col(left_day))
    return (
        binned_left.join(binned_right, [key, "_bin"])
        .where((gap > 0) & (gap <= max_days))
        .withColumn("days_between", gap)
        .drop("_bin")
    )


def later_within_days(per_day: DataFrame, key: str, day: str, max_days: int, totals: dict[str, Column]) -> DataFrame:
    """Aggregates over the following ``max_days`` days of a frame with one row per key and day.

    The rows of one key are bounded by the calendar, so a plain window is safe here.
    """
    ahead = W.partitionBy(key).orderBy(day_number(F.col(day))).rangeBetween(1, max_days)
    return per_day.withColumns({name: expr.over(ahead) for name, expr in totals.items()})
