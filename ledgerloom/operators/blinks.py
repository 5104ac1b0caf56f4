"""Blinks in a stream of frames: the halt rule and the on/off switch."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..session import settled
from .running import BLOCK_ROWS, consecutive_runs, position_block, running_by_block

HALT_FRAMES = 5
SWITCH_BLINKS = 4
BLINK_GAP = 10


def blink_halts(frames: DataFrame, keys: list[str], frame: str, dark: str, width: int = BLOCK_ROWS) -> DataFrame:
    """Runs of five or more frames without dark pixels; motors stop at the fifth."""
    runs = consecutive_runs(frames, keys, frame, F.col(dark) == 0, width)
    return runs.where(F.col("run_length") >= HALT_FRAMES).withColumn(
        "halt_frame", F.col("first_position") + (HALT_FRAMES - 1)
    )


def blink_toggles(
    frames: DataFrame, keys: list[str], frame: str, dark: str, gap: int = BLINK_GAP, width: int = BLOCK_ROWS
) -> DataFrame:
    """One row per switch: the frame that ends every fourth blink in a row, and the state after it.

    A blink is a dark-free run shorter than the halt rule. Blinks are in a row while the
    next starts at most ``gap`` frames after the last one ended and no halt lies between.
    Starting state is ON, so the first switch gives OFF.
    """
    runs = settled(consecutive_runs(frames, keys, frame, F.col(dark) == 0, width))
    block, order = position_block(F.col("first_position"), width), [F.col("first_position")]
    is_blink = F.col("run_length") < HALT_FRAMES

    # Runs up to and including each one; the previous run's end is the highest end before it.
    ends = running_by_block(
        runs.select(*keys, F.col("last_position").alias("first_position"), F.lit(None).cast("bigint").alias("run_length"))
        .unionByName(runs.select(*keys, "first_position", F.col("run_length"))),
        keys,
        block,
        [F.col("first_position"), F.col("run_length").asc_nulls_last()],
        {"_last_end": ("max", F.when(F.col("run_length").isNull(), F.col("first_position")))},
    ).where(F.col("run_length").isNotNull())
    steps = settled(
        ends.withColumn(
            "_opens",
            (F.col("_last_end").isNull() | (F.col("first_position") - F.col("_last_end") > gap) | ~is_blink).cast("int"),
        )
    )
    numbered = running_by_block(steps, keys, block, order, {"_nth": ("sum", is_blink.cast("int"))})
    grouped = running_by_block(
        numbered, keys, block, order,
        # Blinks counted before the current row opens a group; halts count as openers too.
        {"_base": ("max", F.when(F.col("_opens") == 1, F.col("_nth") - is_blink.cast("int")))},
    )
    in_row = F.col("_nth") - F.col("_base")
    switches = settled(grouped.where(is_blink & (in_row % SWITCH_BLINKS == 0)))
    counted = running_by_block(switches, keys, block, order, {"_switch": ("sum", F.lit(1))})
    return counted.select(
        *keys,
        (F.col("first_position") + F.col("run_length") - 1).alias("frame"),
        F.when(F.col("_switch") % 2 == 1, "OFF").otherwise("ON").alias("state"),
    )
