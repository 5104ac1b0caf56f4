"""Column profiles of a table, all columns in a fixed number of passes.

Columns are unpivoted to ``(column_name, value)`` rows, or aggregated side by side where that
serves. Counts, moments and lengths are partial aggregates with one group per column; distinct
values and top values come from one frequency table that is combined before its shuffle.
``sketches.py`` has the mergeable, approximate form.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numbers import finite
from ..session import settled
from .order_stats import exact_percentiles
from .rows import top_per_group
from .running import is_increasing

NAME, VALUE = "column_name", "value"

# Words that make a column boolean, and their meaning when counted.
BOOLEAN_WORDS = ("true", "false", "True", "False", "yes", "no", "Yes", "No", "0", "1", "0.0", "1.0")
TRUE_WORDS = ("true", "1", "yes")
FALSE_WORDS = ("false", "0", "no")
# Words that stand for a missing value in delimited text.
MISSING_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)
# Name parts that mark a numeric column as a time.
TIME_WORDS = ("time", "timestamp", "date", "epoch", "unix", "sec", "ms", "ns")

EPOCH_FLOOR = 1e9
CATEGORY_RATIO = 0.05
CATEGORY_VALUES = 50
SAMPLE_VALUES = 5
TOP_VALUES = 10


def cell_texts(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    """Every value as text; words for a missing value are null."""
    text = lambda name: F.col(name).cast("string")
    return {c: F.when(~text(c).isin(*MISSING_WORDS), text(c)) for c in columns}


def to_rows(df: DataFrame, position: str, columns: Sequence[str]) -> DataFrame:
    """``(_pos, column_name, value)`` with every value as text."""
    texts = df.select(F.col(position).alias("_pos"), *[t.alias(c) for c, t in cell_texts(df, columns).items()])
    return texts.unpivot(["_pos"], list(columns), NAME, VALUE)


def as_number(text: Column) -> Column:
    """The finite number a text stands for; infinities are no numbers."""
    return finite(text.try_cast("double"))


def as_time(text: Column) -> Column:
    """Epoch seconds when the text is a number, else a date or timestamp text."""
    number = as_number(text)
    return F.when(number.isNotNull(), F.timestamp_seconds(number)).otherwise(text.try_cast("timestamp"))


def rounded(value: Column) -> Column:
    return F.round(finite(value).cast("decimal(28,10)"), 6).cast("double")


def frequencies(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(VALUE).isNotNull()).groupBy(NAME, VALUE).agg(F.count(F.lit(1)).alias("value_count"))


def distinct_counts(rows: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct values per column; only their digests are shuffled."""
    if approximate:
        return rows.groupBy(NAME).agg(F.approx_count_distinct(VALUE).alias("unique_values"))
    value = F.col(VALUE)
    seen = rows.where(value.isNotNull()).groupBy(NAME, F.sha2(value, 256).alias("_digest")).agg(F.first(F.lit(1)).alias("_one"))
    return seen.groupBy(NAME).agg(F.count(F.lit(1)).alias("unique_values"))


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column: nulls, any-null flag, and the table's total of null cells."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    total = sum((F.col(c) for c in df.columns), F.lit(0).cast("bigint"))
    return (
        counted.withColumn("total_null_cells", total)
        .unpivot(["total_null_cells"], list(df.columns), NAME, "null_count")
        .select(NAME, "null_count", (F.col("null_count") > 0).alias("has_nulls"), "total_null_cells")
    )


def base_stats(rows: DataFrame, approximate: bool = False) -> DataFrame:
    """Values, nulls and different values per column, in one scan; only digests are shuffled, or sketches."""
    value = F.col(VALUE)
    if approximate:
        return rows.groupBy(NAME).agg(
            F.count(F.lit(1)).alias("total_values"), F.count_if(value.isNull()).alias("null_count"), F.count(value).alias("non_null_count"),
            F.approx_count_distinct(value).alias("unique_values"),
        )
    seen = rows.groupBy(NAME, F.sha2(value, 256).alias("_digest")).agg(F.count(F.lit(1)).alias("_n"))
    missing = F.col("_digest").isNull()
    return seen.groupBy(NAME).agg(
        F.sum("_n").alias("total_values"), F.coalesce(F.sum(F.when(missing, F.col("_n"))), F.lit(0)).alias("null_count"),
        F.coalesce(F.sum(F.when(~missing, F.col("_n"))), F.lit(0)).alias("non_null_count"), F.count_if(~missing).alias("unique_values"),
    )


def sample_values(rows: DataFrame, n: int = SAMPLE_VALUES) -> DataFrame:
    """The first non-null values of each column, by position."""
    first = top_per_group(rows.where(F.col(VALUE).isNotNull()), [NAME], [F.col("_pos")], n)
    ordered = F.array_sort(F.collect_list(F.struct("_pos", VALUE)))
    return first.groupBy(NAME).agg(F.transform(ordered, lambda item: item[VALUE]).alias("sample_values"))


def numeric_stats(rows: DataFrame, approximate: bool = False) -> DataFrame:
    """Columns whose values are all numbers: spread, moments, quartiles. ``rows`` are scanned once; their numbers are written."""
    points = {"percentile_25": 0.25, "median": 0.5, "percentile_75": 0.75}
    parsed = settled(rows.where(F.col(VALUE).isNotNull()).select(NAME, as_number(F.col(VALUE)).alias("_number")))
    number = F.col("_number")
    moments = (
        parsed.groupBy(NAME)
        .agg(
            F.count(F.lit(1)).alias("_values"), F.count(number).alias("_numbers"),
            F.min(number).alias("min"), F.max(number).alias("max"), F.avg(number).alias("mean"), F.stddev_samp(number).alias("std"),
            *([F.percentile_approx(number, p).alias(name) for name, p in points.items()] if approximate else []),
        )
        .where(F.col("_values") == F.col("_numbers"))
        .drop("_values", "_numbers")
    )
    if not approximate:
        numbers = parsed.join(moments.select(NAME), NAME, "left_semi")
        moments = moments.join(exact_percentiles(numbers, number, points, [NAME]), NAME)
    return moments.select(
        NAME, *[rounded(F.col(c)).alias(c) for c in ("min", "max", "mean", "median", "std", "percentile_25", "percentile_75")]
    )


def top_values(rows: DataFrame, n: int = TOP_VALUES) -> DataFrame:
    order = [F.col("value_count").desc(), F.col(VALUE)]
    return top_per_group(frequencies(rows), [NAME], order, n)


def boolean_counts(rows: DataFrame) -> DataFrame:
    """Columns that hold boolean words only: how many mean true, how many false."""
    word = F.lower(F.col(VALUE))
    return (
        rows.groupBy(NAME)
        .agg(
            F.count_if(~F.col(VALUE).isin(*BOOLEAN_WORDS)).alias("_other"),
            F.count(VALUE).alias("_values"),
            F.count_if(word.isin(*TRUE_WORDS)).alias("true_count"),
            F.count_if(word.isin(*FALSE_WORDS)).alias("false_count"),
        )
        .where((F.col("_other") == 0) & (F.col("_values") > 0))
        .drop("_other", "_values")
    )


def text_lengths(rows: DataFrame) -> DataFrame:
    length = F.length(VALUE)
    return rows.groupBy(NAME).agg(
        rounded(F.avg(length)).alias("avg_length"),
        F.coalesce(F.min(length), F.lit(0)).alias("min_length"),
        F.coalesce(F.max(length), F.lit(0)).alias("max_length"),
    )


def time_ranges(rows: DataFrame) -> DataFrame:
    """Earliest and latest moment and the seconds between; unreadable values are ignored."""
    moment = as_time(F.col(VALUE))
    spans = rows.groupBy(NAME).agg(F.min(moment).alias("earliest"), F.max(moment).alias("latest"))
    micros = F.unix_micros("latest") - F.unix_micros("earliest")
    return spans.withColumn("time_range_seconds", rounded(micros / F.lit(1e6)))


def names_a_time(name: Column) -> Column:
    """Whole name parts only, so ``items`` is no time although it contains ``ms``."""
    return F.arrays_overlap(F.split(F.lower(name), "[^a-z0-9]+"), F.array(*map(F.lit, TIME_WORDS)))


def _facts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """What the types of all columns rest on but for their different values; one wide aggregate, unpivoted afterwards."""

    def facts(name: str) -> Column:
        text, number = F.col(f"`{name}`"), as_number(F.col(f"`{name}`"))
        return F.struct(
            F.lit(name).alias(NAME), F.count(F.lit(1)).alias("total_values"), F.count(text).alias("non_null_count"), F.count(number).alias("_numbers"),
            F.min(number).alias("_lowest"), F.count_if(~text.isin(*BOOLEAN_WORDS)).alias("_no_boolean"), F.count(text.try_cast("timestamp")).alias("_dates"),
        ).alias(f"_{name}")

    wide = df.select(*[t.alias(c) for c, t in cell_texts(df, columns).items()]).agg(*[facts(c) for c in columns])
    return wide.select(F.inline(F.array(*[F.col(f"`_{c}`") for c in columns])))


def classify_columns(df: DataFrame, position: str, columns: Sequence[str]) -> DataFrame:
    """``column_name, detected_type``: empty, boolean, numeric, timestamp, categorical or text.

    One scan for the facts, one for the different values, and one of the columns that may be rising times.
    """
    facts = settled(_facts(df, columns))
    all_numbers = F.col("_numbers") == F.col("non_null_count")
    no_gaps = F.col("non_null_count") == F.col("total_values")
    candidates = [r[0] for r in facts.where(all_numbers & no_gaps & (F.col("_lowest") > EPOCH_FLOOR)).select(NAME).collect()]
    rows = to_rows(df, position, columns)
    if candidates:
        numbers = to_rows(df, position, candidates).select("_pos", NAME, as_number(F.col(VALUE)).alias("_number"))
        rising = is_increasing(numbers, [NAME], "_pos", "_number").select(NAME, "increasing")
    else:
        rising = facts.select(NAME, F.lit(False).alias("increasing"))

    every = facts.join(distinct_counts(rows), NAME, "left").join(rising, NAME, "left")
    unique = F.coalesce("unique_values", F.lit(0))
    few = (unique / F.greatest(F.col("total_values"), F.lit(1)) < CATEGORY_RATIO) | (unique <= CATEGORY_VALUES)
    kind = (
        F.when(F.col("non_null_count") == 0, "empty")
        .when((F.col("_no_boolean") == 0) & (unique <= 2), "boolean")
        .when(all_numbers & (names_a_time(F.col(NAME)) | F.coalesce("increasing", F.lit(False))), "timestamp")
        .when(all_numbers, "numeric")
        .when(F.col("_dates") == F.col("non_null_count"), "timestamp")
        .when(few, "categorical")
        .otherwise("text")
    )
    return every.select(
        NAME, kind.alias("detected_type"), "total_values",
        (F.col("total_values") - F.col("non_null_count")).alias("null_count"), "non_null_count",
        unique.alias("unique_values"),
    )


def profile_summary(df: DataFrame, position: str, columns: Sequence[str]) -> DataFrame:
    """Per detected type: columns, null cells; with the table's row and column counts."""
    kinds = classify_columns(df, position, columns)
    return kinds.groupBy("detected_type").agg(
        F.count(F.lit(1)).alias("column_count"),
        F.max("total_values").alias("num_rows"),
        F.sum("null_count").alias("null_cells"),
        (F.sum("null_count") > 0).alias("has_nulls"),
    ).withColumn("num_columns", F.lit(len(columns)).cast("bigint"))
