"""Keep-first, top rows and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def top_per_group(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows per key. Spark limits each task to ``n`` rows before the shuffle."""
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("_rank") <= n).drop("_rank")


def keep_first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return top_per_group(df, keys, order, 1)


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """A report of ``n`` rows; the order must end in a unique column."""
    return df.orderBy(*order).limit(n)


def union_keep_existing(existing: DataFrame, batch: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Existing rows and a new batch, one row per key; the existing row wins."""
    tagged = existing.withColumn("_age", F.lit(0)).unionByName(
        batch.withColumn("_age", F.lit(1)), allowMissingColumns=True
    )
    return keep_first_by_key(tagged, keys, [F.col("_age"), *map(F.col, order)]).drop("_age")


def union_with_defaults(old: DataFrame, new: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Two versions of a table: columns one side lacks are added, then given defaults."""
    both = old.unionByName(new, allowMissingColumns=True)
    return both.withColumns({name: F.coalesce(F.col(name), F.lit(value)) for name, value in defaults.items()})
