"""Keyed tables in Parquet that are loaded in increments, each load all or nothing.

A table is dealt by a hash of its key into a fixed number of parts. A load rewrites the parts that its
source touches and no others, into a folder of its own (``load=N/part=K``), with the moment up to which
it has read its source as a column. Spark's committer writes ``_SUCCESS`` there last: a load without it
does not exist, and its number is used again. Readers take each part from the newest load that has it, so
untouched parts keep their files. The watermark is the moment of the newest load; it needs no second
write. ``vacuum`` removes parts that a newer load has replaced.

One writer at a time. Rows with a null key match nothing and are inserted by every load that has them.
A load without rows changes nothing, the watermark included.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..session import settled
from .merge import merge_upsert, require_unique

PARTS = 64
MOMENT, PART = "_loaded_to", "_part"


class LoadedTable:
    """The table below ``path`` with the columns of ``schema``; ``parts`` must stay as it was at the first load."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema: StructType, parts: int = PARTS):
        self.spark, self.path, self.key, self.schema, self.parts = spark, path.rstrip("/"), key, schema, parts

    # --- what is there ----------------------------------------------------------

    def _found(self, pattern: str) -> list[str]:
        """Paths that match a pattern below the table's, in whatever store it is."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{pattern}")
        return [s.getPath().toString() for s in path.getFileSystem(conf).globStatus(path) or []]

    def _number(self, path: str, name: str) -> int:
        return int(path.rsplit(f"{name}=", 1)[1].split("/", 1)[0])

    def loads(self) -> list[int]:
        """The loads that were completed, oldest first."""
        return sorted(self._number(p, "load") for p in self._found("load=*/_SUCCESS"))

    def _newest(self) -> dict[int, int]:
        """For each part the newest load that has it."""
        done, newest = set(self.loads()), {}
        for path in self._found(f"load=*/{PART}=*"):
            load, part = self._number(path, "load"), self._number(path, PART)
            if load in done:
                newest[part] = max(load, newest.get(part, load))
        return newest

    def part_of(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.parts)).cast("int")

    def read(self, parts: Sequence[int] | None = None) -> DataFrame:
        """All rows, or those of some parts."""
        newest = self._newest()
        paths = [f"{self.path}/load={load}/{PART}={part}" for part, load in sorted(newest.items()) if parts is None or part in parts]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def watermark(self) -> datetime | None:
        """The moment up to which the newest load had read its source; None before the first one."""
        for load in reversed(self.loads()):
            row = self.spark.read.schema(f"{MOMENT} timestamp").parquet(f"{self.path}/load={load}").agg(F.max(MOMENT).alias("moment")).first()
            if row.moment is not None:
                return row.moment
        return None

    # --- changes ------------------------------------------------------------------

    def upsert(self, source: DataFrame, updates: Sequence[str], moment: datetime | Column | None = None) -> list[int]:
        """Update ``updates`` where the key matches, insert the other rows; returns the parts rewritten.

        ``moment`` is the table's watermark afterwards; null leaves it as it was. Raises if two source rows have one key.
        """
        rows = settled(source.withColumn(PART, self.part_of()))
        require_unique(rows.where(F.col(self.key).isNotNull()), [self.key])
        touched = sorted(r[0] for r in rows.select(PART).distinct().collect())  # at most ``parts`` numbers
        if not touched:
            return []
        merged = merge_upsert(self.read(touched), rows.drop(PART), self.key, updates)
        at = moment if isinstance(moment, Column) else F.lit(moment if moment is not None else self.watermark())
        whole = merged.select(*self.schema.names).withColumns({MOMENT: at.cast("timestamp"), PART: self.part_of()})
        number = max([0, *self.loads()]) + 1
        whole.repartition(PART).write.mode("overwrite").partitionBy(PART).parquet(f"{self.path}/load={number}")
        return touched

    def vacuum(self) -> int:
        """Remove parts that a newer load has replaced, and loads that were not completed; returns how many folders."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        newest, done = self._newest(), self.loads()
        gone = [p for p in self._found("load=*") if self._number(p, "load") not in done]
        for path in self._found(f"load=*/{PART}=*"):
            load = self._number(path, "load")
            if load in done[:-1] and load != newest[self._number(path, PART)]:  # the newest load holds the watermark
                gone.append(path)
        for name in gone:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(conf).delete(path, True)
        return len(gone)


def load_newer_files(
    table: LoadedTable, folder: str, read: Callable[[datetime | None], DataFrame], parse: Callable[[DataFrame], DataFrame], glob: str = "*.json"
) -> DataFrame | None:
    """Load the files below ``folder`` that are newer than the table's watermark; returns the rows read, None if no file is newer.

    ``read(since)`` gives files modified after a moment, with a column ``modified``; ``parse`` makes the table's rows of
    them. The newest moment is taken before files are read: what arrives meanwhile is left to the next load.
    """
    since = table.watermark()
    files = table.spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder).select("modificationTime")
    newer = files if since is None else files.where(F.col("modificationTime") > F.lit(since))
    newest = newer.agg(F.max("modificationTime").alias("at")).first().at
    if newest is None:
        return None
    rows = settled(parse(read(since).where(F.col("modified") <= F.lit(newest))))
    table.upsert(rows, [c for c in table.schema.names if c != table.key], newest)
    return rows


def load_newer_rows(table: LoadedTable, source: DataFrame, changed: str) -> list[int]:
    """Load the rows of ``source`` whose ``changed`` is after the table's watermark, of each key the last one; returns the parts rewritten."""
    since = table.watermark()
    newer = source if since is None else source.where(F.col(changed) > F.lit(since))
    last = F.max_by(F.struct(*table.schema.names), F.struct(changed, F.xxhash64(*table.schema.names)))
    rows = settled(newer.groupBy(F.col(table.key).alias("_of")).agg(last.alias("row"), F.max(changed).alias("_changed")))
    newest = rows.agg(F.max("_changed").alias("at")).first().at
    return table.upsert(rows.select("row.*"), [c for c in table.schema.names if c != table.key], newest)
