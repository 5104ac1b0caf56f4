"""Upserts, tables of batches, and watermarks over plain Parquet."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


class DuplicateSourceKeys(ValueError):
    """Two source rows address the same target row."""


def duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return source.groupBy(*keys).agg(F.count(F.lit(1)).alias("source_rows")).where(F.col("source_rows") > 1)


def require_unique(source: DataFrame, keys: Sequence[str]) -> None:
    clash = duplicate_keys(source, keys).limit(1).collect()
    if clash:
        raise DuplicateSourceKeys(f"several source rows for {clash[0].asDict()}")


def merge_upsert(target: DataFrame, source: DataFrame, key: str, updates: Sequence[str]) -> DataFrame:
    """Update ``updates`` where the key matches, insert the other source rows.

    Written as a left join plus an insert branch: a small staging set is broadcast by
    AQE and the large target is not shuffled, which a full outer join would force.
    """
    changes = source.select(
        F.col(key), F.lit(True).alias("_hit"), *[F.col(name).alias(f"_new_{name}") for name in updates]
    )
    updated = target.join(changes, key, "left").select(
        *[
            (F.when(F.col("_hit"), F.col(f"_new_{name}")).otherwise(F.col(name)).alias(name) if name in updates else F.col(name))
            for name in target.columns
        ]
    )
    present = target.select(key).join(source.select(key), key, "left_semi")
    inserted = source.join(present, key, "left_anti").select(*[c for c in target.columns if c in source.columns])
    return updated.unionByName(inserted, allowMissingColumns=True)


class BatchTable:
    """A Parquet folder with one partition per batch, ``batch=N``.

    A repeated batch overwrites its own partition, so it leaves no second copy. What
    belongs to a key over all batches is worked out when the table is read. ``compact`` puts
    the batches up to a number into one folder, ``upto=N``; a repeat of such a batch is not seen.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def write(self, df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def _found(self, pattern: str) -> dict[int, str]:
        """Folders that match, by the number in their name."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{pattern}")
        names = [s.getPath().toString() for s in path.getFileSystem(conf).globStatus(path) or []]
        return {int(re.search(r"=(\d+)(/_SUCCESS)?$", n)[1]): n.removesuffix("/_SUCCESS") for n in names}

    def read(self, before: int | None = None) -> DataFrame | None:
        """All batches with their ``batch`` column, or those before one; None while there is none."""
        bases, batches = self._found("upto=*/_SUCCESS"), self._found("batch=*")
        last = max(bases, default=-1)
        later = [batches[n] for n in sorted(batches) if n > last and (before is None or n < before)]
        frames = [self.spark.read.parquet(bases[last])] if bases else []
        if later:
            frames.append(self.spark.read.option("basePath", self.path).parquet(*later).withColumn("batch", F.col("batch").cast("int")))
        if not frames:
            return None
        rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        return rows if before is None else rows.where(F.col("batch") < before)

    def read_batch(self, batch: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/batch={batch}")

    def compact(self, upto: int, reduced: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> None:
        """Rewrite all batches up to a number as one folder, its rows ``reduced`` (with a ``batch`` column); then remove theirs.

        The new folder counts once it is complete, so a failure on the way changes nothing. Not while another job reads.
        """
        rows = self.read(before=upto + 1)
        if rows is None or upto in self._found("upto=*/_SUCCESS"):
            return
        reduced(rows).write.mode("overwrite").parquet(f"{self.path}/upto={upto}")
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        old = [p for n, p in self._found("batch=*").items() if n <= upto] + [p for n, p in self._found("upto=*").items() if n < upto]
        for name in old:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)


WATERMARKS = "table_name string, watermark timestamp"


def watermark_read(control: DataFrame, table_name: str) -> Column:
    """The watermark of a table as a scalar; null before its first load."""
    return control.where(F.col("table_name") == table_name).agg(F.max("watermark").alias("watermark")).scalar()


def watermark_advance(control: DataFrame, table_name: str, moment) -> DataFrame:
    """The control rows with the table's watermark at ``moment``."""
    row = control.sparkSession.createDataFrame([(table_name, moment)], WATERMARKS)
    return merge_upsert(control, row, "table_name", ["watermark"])
