"""Exact percentiles with linear interpolation, by narrowing a bracket around each wanted rank.

A sketch of fixed size brackets each rank. One pass counts the values below and inside each bracket; a
bracket with more than ``RANKED`` different values is narrowed by a sketch of the values inside it, to a
share of about two ``GRID`` steps each time, until it holds no more. Only then are its values, each with its
count, ranked: the ranking never sees more than that, whatever the size of the data. The values are
written once to the shared folder, the driver holds two numbers per bracket.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..session import settled

ACCURACY, RANKED, GRID = 20_000, 100_000, 256


@dataclass
class Bracket:
    """The values from ``low`` to ``high`` around position ``at`` of one key's ``n`` values, of which ``below`` are smaller."""

    key: tuple
    point: str
    at: float
    least: float
    most: float
    low: float
    high: float
    below: int = 0
    inside: int = 0
    ready: bool = False


def _frame(values: DataFrame, keys: list[str], brackets: list[Bracket]) -> DataFrame:
    """The brackets as a frame; a row per key and point."""
    named = {"_point": StringType(), "_at": DoubleType(), "_low": DoubleType(), "_high": DoubleType(), "_below": LongType(), "_inside": LongType()}
    schema = StructType([StructField(k, values.schema[k].dataType) for k in keys] + [StructField(name, kind) for name, kind in named.items()])
    rows = [(*b.key, b.point, float(b.at), float(b.low), float(b.high), b.below, b.inside) for b in brackets]
    return F.broadcast(values.sparkSession.createDataFrame(rows, schema))


def _counted(values: DataFrame, keys: list[str], brackets: list[Bracket]) -> dict[tuple, tuple]:
    """For each bracket the values below, inside, the different ones inside, and the neighbours beside it."""
    v, inside = F.col("_v"), F.col("_v").between(F.col("_low"), F.col("_high"))
    rows = values.join(_frame(values, keys, brackets), keys).groupBy(*keys, "_point").agg(
        F.count_if(v < F.col("_low")).alias("below"), F.count_if(inside).alias("inside"),
        F.approx_count_distinct(F.when(inside, v)).alias("different"),
        F.max(F.when(v < F.col("_low"), v)).alias("before"), F.min(F.when(v > F.col("_high"), v)).alias("after"),
    ).collect()
    return {tuple(r[: len(keys) + 1]): tuple(r[len(keys) + 1 :]) for r in rows}


def _narrowed(values: DataFrame, keys: list[str], brackets: list[Bracket], accuracy: int) -> None:
    """Draw the brackets closer around their positions, by a sketch of the values inside."""
    share = (F.col("_at") - F.col("_below")) / F.greatest(F.col("_inside") - 1, F.lit(1))
    margin = 2.0 / accuracy
    inside = values.join(_frame(values, keys, brackets), keys).where(F.col("_v").between(F.col("_low"), F.col("_high")))
    # A sketch takes constant shares: it is asked for all of a grid, of which the ones around the position are used.
    steps = [i / GRID for i in range(GRID + 1)]
    rows = inside.groupBy(*keys, "_point").agg(F.percentile_approx("_v", steps, accuracy).alias("steps"), F.first(share).alias("share")).collect()
    found = {tuple(r[: len(keys) + 1]): (r["steps"], r["share"]) for r in rows}
    for b in brackets:
        values_at, at = found[(*b.key, b.point)]
        low, high = math.floor((at - margin) * GRID), math.ceil((at + margin) * GRID)
        b.low, b.high = max(b.low, values_at[max(0, low)]), min(b.high, values_at[min(GRID, high)])


def exact_percentiles(
    df: DataFrame, value: Column, points: Mapping[str, float], keys: Sequence[str] = (), accuracy: int = ACCURACY, ranked: int = RANKED
) -> DataFrame:
    """One row per key with a double column for each entry of ``points``; without keys one row, of nulls if there is no value.

    ``keys`` must be few (a column name, a site) and not null: their brackets are one small row each.
    """
    spark, given = df.sparkSession, list(keys)
    values = df.select(*given, value.cast("double").alias("_v")).where(F.col("_v").isNotNull())
    keys = given or ["_all"]
    values = settled(values if given else values.withColumn("_all", F.lit(0)))
    margin = 2.0 / accuracy
    shares = {name: [max(0.0, p - margin), min(1.0, p + margin)] for name, p in points.items()}
    rows = values.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most"),
        *[F.percentile_approx("_v", s, accuracy).alias(f"_b_{name}") for name, s in shares.items()],
    ).collect()
    brackets = [
        Bracket(tuple(r[k] for k in keys), name, p * (r["_n"] - 1), r["_least"], r["_most"], *r[f"_b_{name}"]) for r in rows for name, p in points.items()
    ]
    while open_ := [b for b in brackets if not b.ready]:
        counts = _counted(values, keys, open_)
        wide = []
        for b in open_:
            b.below, b.inside, different, before, after = counts[(*b.key, b.point)]
            first, last = math.floor(b.at), math.ceil(b.at)
            if first < b.below:  # one step, or far beside what the sketch said
                b.low = before if first == b.below - 1 else b.least
            elif last >= b.below + b.inside:
                b.high = after if last == b.below + b.inside else b.most
            elif different <= ranked or b.low == b.high:
                b.ready = True
            else:
                wide.append(b)
        if wide:
            bounds = [(b.low, b.high) for b in wide]
            _narrowed(values, keys, wide, accuracy)
            for b, was in zip(wide, bounds):
                b.ready = (b.low, b.high) == was  # values too frequent to be told apart: few different ones
    columns = [F.max(F.when(F.col("_point") == name, F.col("_found"))).alias(name) for name in points]
    if not brackets:
        empty = spark.createDataFrame([], StructType([*[values.schema[k] for k in given]]).add("_point", StringType()).add("_found", DoubleType()))
        return empty.groupBy(*given).agg(*columns)
    inside = values.join(_frame(values, keys, brackets), keys).where(F.col("_v").between(F.col("_low"), F.col("_high")))
    counted = inside.groupBy(*keys, "_point", "_at", "_below", "_v").agg(F.count(F.lit(1)).alias("_c"))
    upto = W.partitionBy(*keys, "_point").orderBy("_v").rowsBetween(W.unboundedPreceding, 0)
    placed = counted.withColumn("_cum", F.col("_below") + F.sum("_c").over(upto))

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("_cum") > rank, F.col("_v")))

    lower, upper = at(F.floor("_at")), at(F.ceil("_at"))
    between = F.max(F.col("_at") - F.floor("_at"))
    found = placed.groupBy(*keys, "_point").agg((lower + (upper - lower) * between).alias("_found"))
    return found.groupBy(*given).agg(*columns)
