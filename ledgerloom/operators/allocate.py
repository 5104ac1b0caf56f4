"""Consecutive ids for a batch of new rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import settled

ROW_BITS = 33


def last_id(existing: DataFrame, column: str, base: int | Column) -> Column:
    """The highest id in use, or ``base`` for an empty table (a scalar subquery)."""
    highest = existing.agg(F.max(column).cast("bigint").alias("last")).scalar()
    return F.coalesce(highest, (base if isinstance(base, Column) else F.lit(base)).cast("bigint"))


def numbered_by(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """Add the place of each row in ``order`` (together unique), from 1.

    Rows are dealt out by ranges of the order and sorted inside; each range's first place
    comes from the sizes of those before it, one row a range. Gaps between values do not
    matter. The dealt rows are written once, so both uses see the same ranges.
    """
    placed = settled(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_place", F.monotonically_increasing_id()))
    part, inside = F.shiftright("_place", ROW_BITS), F.col("_place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_part", before.alias("_before"))
    joined = placed.withColumn("_part", part).join(offsets, "_part")
    return joined.withColumn(name, F.col("_before") + inside + 1).drop("_place", "_part", "_before")


def allocate_sequence_ids(new: DataFrame, order: str, existing: DataFrame, column: str, base: int | Column) -> DataFrame:
    """Number ``new`` by ``order`` (a unique value), continuing after the ids in use."""
    numbered = numbered_by(new, [F.col(order)], "_nth")
    return numbered.withColumn(column, last_id(existing, column, base) + F.col("_nth")).drop("_nth")
