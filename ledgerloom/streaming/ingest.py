"""Bundles and uploads as streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.merge import BatchTable
from ..plans.catalogue import bronze_rows, lineage_append, manifest_ingest
from ..sources import bundles
from ..sources.sinks import append_unique
from .jobs import each_batch


def bundle_stream(spark: SparkSession, folder: str, one_per_file: bool = True) -> DataFrame:
    """``(file, value)`` of arriving bundle files; bulk exports hold one bundle per line."""
    texts = spark.readStream.text(folder, wholetext=one_per_file)
    return texts.select(F.col("_metadata.file_path").alias("file"), "value")


def land_resources(stream: DataFrame, parser: Callable[[DataFrame], DataFrame], table: BatchTable, key: str) -> DataStreamWriter:
    """Flatten one resource type and add what earlier batches do not hold."""

    def land(batch: DataFrame, number: int) -> None:
        flat = parser(bundles.bundle_entries(batch))
        append_unique(table, flat, key, [c for c in flat.columns if c != key], number)

    return each_batch(stream, land)


def first_resources(stream: DataFrame, parser: Callable[[DataFrame], DataFrame], key: str) -> DataFrame:
    """Flattened resources of one type, each key once: the first to arrive. No earlier batch is read again.

    The state store holds every key seen; with very many of them let it be the one on disk
    (``spark.sql.streaming.stateStore.providerClass``).
    """
    return parser(bundles.bundle_entries(stream)).dropDuplicates([key])


def register_uploads(uploads: DataFrame, catalogue: BatchTable, lineage: BatchTable) -> DataStreamWriter:
    """Catalogue and lineage rows for uploads whose content is new.

    Repeats are found by comparing hashes with the catalogue, however late they come. Lineage
    follows the rows the catalogue took.
    """

    def register(batch: DataFrame, number: int) -> None:
        earlier = catalogue.read(before=number)
        known = batch.limit(0) if earlier is None else earlier
        catalogue.write(manifest_ingest(batch, known.select("file_hash")), number)
        lineage.write(lineage_append(catalogue.read_batch(number)), number)

    return each_batch(uploads, register)


def first_uploads(uploads: DataFrame, within: str) -> DataFrame:
    """Catalogue rows of uploads whose content was not uploaded before ``within`` that time, without reading the catalogue.

    The state store keeps a content's hash until the latest upload seen is so much later. An upload
    older than that is passed over, and a content that comes again after it is taken as new:
    ``missed_uploads`` finds the former, ``manifest_ingest`` removes the latter.
    """
    timed = uploads.withWatermark("upload_time_utc", within)
    return bronze_rows(timed.dropDuplicatesWithinWatermark(["file_hash"]))


def missed_uploads(uploads: DataFrame, catalogue: DataFrame) -> DataFrame:
    """Catalogue rows of uploads that came too late for ``first_uploads``; a batch job over what has arrived."""
    return manifest_ingest(uploads, catalogue)
