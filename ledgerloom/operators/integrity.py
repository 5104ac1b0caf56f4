"""Reference checks, reconciliation and snapshot differences."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class ForeignKey:
    name: str
    child: str
    column: str
    parent: str
    parent_column: str


def _tagged(table: DataFrame, fields: Sequence[tuple[Column, ...]], names: Sequence[str]) -> DataFrame:
    """One row per row of the table and entry of ``fields``, without those whose value is null."""
    each = F.array(*[F.struct(*[c.alias(n) for c, n in zip(field, names)]) for field in fields])
    return table.select(F.inline(each)).where(F.col("_value").isNotNull())


def fk_violations(frames: Mapping[str, DataFrame], keys: Iterable[ForeignKey]) -> DataFrame:
    """Per foreign key: rows, and distinct values, that have no parent.

    Each table is read once as a child and once as a parent, whatever its number of keys: their values
    are tagged with the key and with the parent column they refer to, and meet in one join. Child rows are
    counted per value first, so a frequent value is one row in it.
    """
    keys = list(keys)
    children, parents = {}, {}
    for fk in keys:
        target, tag = frames[fk.parent].schema[fk.parent_column].dataType, F.lit(f"{fk.parent}.{fk.parent_column}")
        value = F.col(f"`{fk.column}`")
        if frames[fk.child].schema[fk.column].dataType != target:  # a value that its parent's type cannot hold has no parent
            value = F.coalesce(value.try_cast(target).cast("string"), F.concat(F.lit("not a key: "), value.cast("string")))
        children.setdefault(fk.child, []).append((F.lit(fk.name), tag, value.cast("string")))
        parents.setdefault(fk.parent, {})[fk.parent_column] = (tag, F.col(f"`{fk.parent_column}`").cast("string"))
    referring = [_tagged(frames[t], fields, ("foreign_key", "_tag", "_value")) for t, fields in children.items()]
    known = [_tagged(frames[t], list(fields.values()), ("_tag", "_value")) for t, fields in parents.items()]
    counted = reduce(DataFrame.unionByName, referring).groupBy("foreign_key", "_tag", "_value").agg(F.count(F.lit(1)).alias("_rows"))
    orphans = counted.join(reduce(DataFrame.unionByName, known), ["_tag", "_value"], "left_anti")
    found = orphans.groupBy("foreign_key").agg(F.sum("_rows").alias("orphan_rows"), F.count(F.lit(1)).alias("orphan_values"))
    every = frames[keys[0].child].sparkSession.createDataFrame([(fk.name,) for fk in keys], "foreign_key string")
    zero = F.lit(0).cast("bigint")
    return every.join(found, "foreign_key", "left").select(
        "foreign_key", F.coalesce("orphan_rows", zero).alias("orphan_rows"), F.coalesce("orphan_values", zero).alias("orphan_values")
    )


def table_row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("total_rows")) for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def manifest_reconcile(catalogue: DataFrame, listing: DataFrame, path: str) -> DataFrame:
    """Where each path is known: ``both``, ``catalogue_only`` or ``storage_only``."""
    left = catalogue.groupBy(path).agg(F.count(F.lit(1)).alias("catalogue_rows"))
    right = listing.groupBy(path).agg(F.count(F.lit(1)).alias("storage_rows"))
    status = (
        F.when(F.col("storage_rows").isNull(), "catalogue_only")
        .when(F.col("catalogue_rows").isNull(), "storage_only")
        .otherwise("both")
    )
    return left.join(right, path, "full_outer").select(
        path,
        F.coalesce("catalogue_rows", F.lit(0)).alias("catalogue_rows"),
        F.coalesce("storage_rows", F.lit(0)).alias("storage_rows"),
        status.alias("status"),
    )


def spend_reconciliation(staged: DataFrame, loaded: DataFrame, amount: str) -> DataFrame:
    def total(df: DataFrame) -> Column:
        return df.agg(F.coalesce(F.sum(amount), F.lit(0)).cast("decimal(28,2)").alias("total")).scalar()

    base = staged.agg(F.coalesce(F.sum(amount), F.lit(0)).cast("decimal(28,2)").alias("staged_total"))
    return base.withColumn("loaded_total", total(loaded)).withColumns(
        {
            "difference": (F.col("staged_total") - F.col("loaded_total")).cast("decimal(28,2)"),
            "reconciled": F.col("staged_total") == F.col("loaded_total"),
        }
    )


def snapshot_updates(old: DataFrame, new: DataFrame, key: str, column: str) -> DataFrame:
    """Rows present in both snapshots with both values of ``column``."""
    return old.select(key, F.col(column).alias("old_value")).join(
        new.select(key, F.col(column).alias("new_value")), key
    )


def updated_rows(old: DataFrame, new: DataFrame, key: str, column: str) -> DataFrame:
    """Only rows whose value differs, nulls compared as values."""
    pairs = snapshot_updates(old, new, key, column)
    return pairs.where(~F.col("old_value").eqNullSafe(F.col("new_value")))


def batch_validate(df: DataFrame, batch: Sequence[str], rules: Mapping[str, Column]) -> DataFrame:
    """Per batch: rows, failures of each rule, rows that fail none.

    A rule is a condition that must hold; an unknown result counts as a failure.
    """
    failed = {name: ~F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}
    any_failed = reduce(lambda a, b: a | b, failed.values())
    return df.groupBy(*batch).agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(test).alias(f"{name}_failures") for name, test in failed.items()],
        F.count_if(~any_failed).alias("valid_rows"),
    )
