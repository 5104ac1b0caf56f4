"""Column profiles as mergeable sketches, kept per batch.

One scan gives, for each batch and column, counts, moments, a HyperLogLog sketch of the different values and
a KLL sketch of the numbers. Profiles of batches are small rows; they are kept beside the data, and any
set of them is merged into the profile of all of it without reading the data again. ``profile.py`` has the
exact figures. A KLL rank is off by about 1 % of the values (``KLL_SIZE`` 200), a distinct count by
about 2 % (``HLL_BITS`` 12).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .profile import NAME, as_number, cell_texts, rounded

KLL_SIZE, HLL_BITS, FAN_IN = 200, 12, 32
QUARTILES = {"percentile_25": 0.25, "median": 0.5, "percentile_75": 0.75}
_SUMS = ("total_values", "non_null_count", "number_count")


def batch_profiles(df: DataFrame, columns: Sequence[str], batch: Column) -> DataFrame:
    """``batch``, ``column_name`` and the sketches of each column, in one scan of those columns."""

    def sketch(name: str, text: Column) -> Column:
        number = as_number(text)
        return F.struct(
            F.lit(name).alias(NAME), F.count(F.lit(1)).alias("total_values"), F.count(text).alias("non_null_count"), F.count(number).alias("number_count"),
            F.min(number).alias("min"), F.max(number).alias("max"), F.sum(number).alias("sum"),
            F.hll_sketch_agg(text, HLL_BITS).alias("different"), F.kll_sketch_agg_double(number, KLL_SIZE).alias("ranks"),
        ).alias(f"_{name}")

    texts = cell_texts(df, columns)
    wide = df.select(batch.alias("batch"), *[t.alias(c) for c, t in texts.items()]).groupBy("batch")
    each = wide.agg(*[sketch(c, F.col(f"`{c}`")) for c in columns])
    return each.select("batch", F.inline(F.array(*[F.col(f"`_{c}`") for c in columns])))


def merged_profiles(profiles: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Profiles of batches drawn together, a row per column (and ``keys``). ``FAN_IN`` sketches meet in a row at a time."""
    keys = [*keys, NAME]
    one = [F.sum(c).alias(c) for c in (*_SUMS, "sum")] + [F.min("min").alias("min"), F.max("max").alias("max"), F.hll_union_agg("different").alias("different")]
    most = profiles.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first().n or 0
    while True:
        joined = F.aggregate(
            F.collect_list("ranks"), F.lit(None).cast("binary"), lambda total, x: F.when(total.isNull(), x).otherwise(F.kll_sketch_merge_double(total, x))
        ).alias("ranks")
        if most <= FAN_IN:
            return profiles.groupBy(*keys).agg(*one, joined)
        # Any grouping of the batches gives the same sums; sketches differ within their error.
        group = F.pmod(F.xxhash64(F.col("batch").cast("string"), "total_values", "sum"), F.lit(-(-most // (FAN_IN // 2))))
        profiles = profiles.groupBy(*keys, group.alias("batch")).agg(*one, joined)
        most = -(-most // (FAN_IN // 2))


def sketched_statistics(merged: DataFrame) -> DataFrame:
    """Counts, range, mean and approximate distinct values and quartiles, from merged profiles; numbers are null for columns that hold others."""
    numeric = (F.col("number_count") > 0) & (F.col("number_count") == F.col("non_null_count"))
    at = lambda p: F.when(numeric, F.kll_sketch_get_quantile_double("ranks", F.lit(p)))
    only = lambda value: F.when(numeric, rounded(value))
    return merged.select(
        *[c for c in merged.columns if c not in (*_SUMS, "sum", "min", "max", "different", "ranks")],
        "total_values", (F.col("total_values") - F.col("non_null_count")).alias("null_count"), "non_null_count",
        F.hll_sketch_estimate("different").alias("unique_values"),
        only(F.col("min")).alias("min"), only(F.col("max")).alias("max"), only(F.try_divide("sum", "number_count")).alias("mean"),
        *[rounded(at(p)).alias(name) for name, p in QUARTILES.items()],
    )
