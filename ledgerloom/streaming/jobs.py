"""What all streaming jobs share: file sources and runs over what is there now."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter


def file_stream(spark: SparkSession, folder: str, schema, pattern: str = "*.parquet", files_per_batch: int = 1000) -> DataFrame:
    """A stream of Parquet files as they arrive in ``folder``."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def run_available(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process what the source holds and stop; the checkpoint remembers how far that was."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def each_batch(stream: DataFrame, handle: Callable[[DataFrame, int], None], mode: str = "append") -> DataStreamWriter:
    return stream.writeStream.outputMode(mode).foreachBatch(handle)


def to_files(stream: DataFrame, path: str, *partitions: str) -> DataStreamWriter:
    """Append a stream to Parquet files; a repeated batch leaves no second copy."""
    writer = stream.writeStream.outputMode("append").format("parquet").option("path", path)
    return writer.partitionBy(*partitions) if partitions else writer
