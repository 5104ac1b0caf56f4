"""Writers: flattened sets, samples, object stores, files by key, SQL tables."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ..operators.merge import BatchTable
from ..operators.rows import keep_first_by_key, top_n
from .fileranges import opened


def append_unique(table: BatchTable, batch: DataFrame, key: str, order: list[str], number: int) -> None:
    """Add the rows of a flattened batch whose key no earlier batch has; rows already there win.

    Only the new rows are written, as the partition of the batch. Earlier ones are read for
    their key column alone.
    """
    fresh = keep_first_by_key(batch, [key], [F.col(c) for c in order])
    earlier = table.read(before=number)
    if earlier is not None:
        fresh = fresh.join(earlier.select(key), key, "left_anti").select(*batch.columns)
    table.write(fresh, number)


def write_sample_csv(df: DataFrame, path: str, key: str, rows: int = 100) -> None:
    top_n(df, rows, F.col(key)).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def truncate_and_load(df: DataFrame, path: str) -> None:
    """Idempotent full refresh; the path's scheme decides the store."""
    df.write.mode("overwrite").parquet(path)


def write_file_per_key(df: DataFrame, path: str, key: str, content: str) -> None:
    """The texts of each key, a line each, in one file ``path/key=value/part-N.txt``, as a text sink partitioned by ``key`` lays them out.

    For as many files as rows: each task writes its own in place, where a sink moves file by file when it commits.
    A repeated task writes the same files again.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, inner = opened(path)
        rows = ((k.as_py(), t.as_py()) for batch in batches for k, t in zip(batch["key"], batch["text"]))
        part, files = f"part-{TaskContext.get().partitionId():05d}.txt", 0
        for value, lines in groupby(rows, key=lambda row: row[0]):
            folder = f"{inner}/{key}={'__HIVE_DEFAULT_PARTITION__' if value is None else value}"
            store.create_dir(folder, recursive=True)
            with store.open_output_stream(f"{folder}/{part}") as file:
                for _, line in lines:
                    file.write(b"" if line is None else line.encode())
                    file.write(b"\n")
            files += 1
        yield pa.RecordBatch.from_pydict({"files": pa.array([files], pa.int64())})

    rows = df.select(F.col(key).cast("string").alias("key"), F.col(content).alias("text"))
    dealt = rows.repartition("key").sortWithinPartitions("key")
    dealt.mapInArrow(write, "files bigint").write.format("noop").mode("overwrite").save()


def write_jdbc_table(df: DataFrame, url: str, table: str, properties: dict[str, str]) -> None:
    """Replace a SQL table; credentials come from the caller."""
    df.write.option("truncate", True).jdbc(url, table, mode="overwrite", properties=properties)
