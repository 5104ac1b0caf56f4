"""Numbers stored as arrays: statistics per variable and dark pixels per zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType

from ..functions.gaze import DARK_LIMIT, gaze_decision, zone
from ..functions.numbers import finite


def array_variable_stats(arrays: DataFrame, name: str, values: str) -> DataFrame:
    """Per variable: rows, shape, dimensions, size, range and mean of all elements.

    ``values`` is an array of any depth; its rows are the first dimension, and the others are as long as their longest array.
    """
    kind, depth = arrays.schema[values].dataType, 0
    while isinstance(kind, ArrayType):
        kind, depth = kind.elementType, depth + 1
    flat, longest = F.col(values), []
    for level in range(depth):
        if level:
            longest.append(F.array_max(F.transform(flat, F.size)))
            flat = F.flatten(F.filter(flat, lambda x: x.isNotNull()))
        else:
            longest.append(F.size(flat))
    per_row = arrays.select(name, flat.alias("_v"), *[n.cast("bigint").alias(f"_long{i}") for i, n in enumerate(longest)]).select(
        name,
        *[f"_long{i}" for i in range(depth)],
        F.size("_v").cast("bigint").alias("_size"),
        F.array_min("_v").cast("double").alias("_min"),
        F.array_max("_v").cast("double").alias("_max"),
        F.aggregate("_v", F.lit(0.0), lambda total, x: total + x.cast("double")).alias("_sum"),
    )
    n, size = F.count(F.lit(1)), F.sum("_size")
    return per_row.groupBy(name).agg(
        F.concat_ws("x", n, *[F.max(f"_long{i}") for i in range(depth)]).alias("shape"),
        F.lit(depth + 1).alias("ndim"),
        size.alias("size"),
        F.min("_min").alias("min"),
        F.max("_max").alias("max"),
        F.round(finite(F.try_divide(F.sum("_sum"), size)).cast("decimal(28,10)"), 6).cast("double").alias("mean"),
    )


def gaze_zone_counts(
    pixels: DataFrame, keys: list[str], row: str, column: str, rows: int, columns: int, intensity: str
) -> DataFrame:
    """Dark pixels per horizontal and vertical third of each eye image."""
    dark = F.col(intensity) <= DARK_LIMIT
    across, down = zone(F.col(column), F.lit(columns)), zone(F.col(row), F.lit(rows))
    names = {"dark_left": (across, 0), "dark_centre": (across, 1), "dark_right": (across, 2),
             "dark_top": (down, 0), "dark_middle": (down, 1), "dark_bottom": (down, 2)}
    return pixels.groupBy(*keys).agg(
        *[F.count_if(dark & (part == which)).alias(name) for name, (part, which) in names.items()]
    )


def with_decision(counts: DataFrame) -> DataFrame:
    zones = [F.col(f"dark_{z}") for z in ("left", "centre", "right", "top", "middle", "bottom")]
    return counts.withColumn("action", gaze_decision(*zones))


def array_zone_counts(frames: DataFrame, pixels: str, rows: int, columns: int) -> DataFrame:
    """The same counts for images stored as one array per row, without exploding them."""

    def dark_in(part, which: int):
        return F.size(F.filter(pixels, lambda v, k: (v <= DARK_LIMIT) & (part(k) == which))).cast("bigint")

    def across(k):
        return zone(k % columns, F.lit(columns))

    def down(k):
        return zone(F.floor(k / columns), F.lit(rows))

    names = {"dark_left": (across, 0), "dark_centre": (across, 1), "dark_right": (across, 2),
             "dark_top": (down, 0), "dark_middle": (down, 1), "dark_bottom": (down, 2)}
    return frames.withColumns({name: dark_in(part, which) for name, (part, which) in names.items()})
