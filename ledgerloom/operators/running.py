"""Running totals along a sequence, without sorting a whole sequence in one task.

A sequence is cut into blocks of its position column. Totals run inside each block,
and the blocks' own totals, one row each, carry over from block to block. A key that
holds a third of all rows is thereby spread over as many tasks as it has blocks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

BLOCK = "_block"
BLOCK_ROWS = 100_000


def position_block(position: Column, width: int = BLOCK_ROWS) -> Column:
    """A block of ``width`` positions; positions that are unique bound its rows."""
    return F.floor(position.cast("decimal(38,0)") / width).cast("bigint")


def running_by_block(
    df: DataFrame,
    keys: Sequence[str],
    block: Column,
    order: Sequence[Column],
    totals: Mapping[str, tuple[str, Column]],
) -> DataFrame:
    """Add running ``sum`` or ``max`` columns over ``order`` per key.

    ``block`` must never decrease along ``order``. ``totals`` maps a new column to
    ``("sum" | "max", expression)``. Keys must not be null.
    """
    aggregates = {"sum": F.sum, "max": F.max}
    blocked = df.withColumn(BLOCK, block)
    inside = W.partitionBy(*keys, BLOCK).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    earlier = W.partitionBy(*keys).orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)

    local = blocked.withColumns({name: aggregates[kind](expr).over(inside) for name, (kind, expr) in totals.items()})
    per_block = blocked.groupBy(*keys, BLOCK).agg(
        *[aggregates[kind](expr).alias(f"_all_{name}") for name, (kind, expr) in totals.items()]
    )
    carried = per_block.select(
        *keys,
        BLOCK,
        *[aggregates[kind](f"_all_{name}").over(earlier).alias(f"_carry_{name}") for name, (kind, _) in totals.items()],
    )
    joined = local.join(carried, [*keys, BLOCK], "left")
    combined = {}
    for name, (kind, _) in totals.items():
        carry = F.col(f"_carry_{name}")
        if kind == "sum":
            combined[name] = F.col(name) + F.coalesce(carry, F.lit(0))
        else:
            combined[name] = F.greatest(F.col(name), carry)
    return joined.withColumns(combined).drop(BLOCK, *[f"_carry_{name}" for name in totals])


def consecutive_runs(
    df: DataFrame, keys: Sequence[str], position: str, flag: Column, width: int = BLOCK_ROWS
) -> DataFrame:
    """Runs of neighbouring positions where ``flag`` holds: keys, first, last, length."""
    flagged = df.where(flag).select(*keys, position)
    counted = running_by_block(
        flagged, keys, position_block(F.col(position), width), [F.col(position)], {"_seen": ("sum", F.lit(1))}
    )
    return (
        counted.groupBy(*keys, (F.col(position) - F.col("_seen")).alias("_run"))
        .agg(
            F.min(position).alias("first_position"),
            F.max(position).alias("last_position"),
            F.count(F.lit(1)).alias("run_length"),
        )
        .drop("_run")
    )


def is_increasing(df: DataFrame, keys: Sequence[str], position: str, value: str, width: int = BLOCK_ROWS) -> DataFrame:
    """Per key: lowest value, and whether values never fall along the positions.

    Steps are checked inside each block, then between the end of one block and the
    start of the next; only one row per block takes part in the second check.
    """
    blocked = df.where(F.col(value).isNotNull()).select(
        *keys, position, value, position_block(F.col(position), width).alias(BLOCK)
    )
    inside = W.partitionBy(*keys, BLOCK).orderBy(position)
    steps = blocked.withColumn("_falls", (F.col(value) < F.lag(value).over(inside)).cast("int"))
    per_block = steps.groupBy(*keys, BLOCK).agg(
        F.min(value).alias("_low"),
        F.coalesce(F.max("_falls"), F.lit(0)).alias("_falls"),
        F.min_by(value, position).alias("_first"),
        F.max_by(value, position).alias("_last"),
    )
    previous = F.lag("_last").over(W.partitionBy(*keys).orderBy(BLOCK))
    between = per_block.withColumn("_gap_falls", (F.col("_first") < previous).cast("int"))
    return between.groupBy(*keys).agg(
        F.min("_low").alias("lowest"),
        (F.greatest(F.max("_falls"), F.max("_gap_falls")) == 0).alias("increasing"),
    )


def previous_by_block(
    df: DataFrame, keys: Sequence[str], block: Column, order: Sequence[str], value: str, name: str
) -> DataFrame:
    """Add ``name``: the ``value`` of the key's preceding row along ``order``."""
    blocked = df.withColumn(BLOCK, block)
    inside = W.partitionBy(*keys, BLOCK).orderBy(*order)
    local = blocked.withColumns({"_row": F.row_number().over(inside), name: F.lag(value).over(inside)})
    last = F.max_by(F.struct(value), F.struct(*order))[value]
    before = W.partitionBy(*keys).orderBy(BLOCK)
    carried = (
        blocked.groupBy(*keys, BLOCK).agg(last.alias("_last"))
        .select(*keys, BLOCK, F.lag("_last").over(before).alias("_carry"))
    )
    joined = local.join(carried, [*keys, BLOCK], "left")
    return joined.withColumn(name, F.when(F.col("_row") == 1, F.col("_carry")).otherwise(F.col(name))).drop(
        BLOCK, "_row", "_carry"
    )
