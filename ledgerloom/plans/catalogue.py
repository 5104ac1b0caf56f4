"""File catalogue: ingest, lineage, user views, quality and activity metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.files import (
    dataset_folder, detect_modality, file_extension, has_numeric_owner, object_path, owner_slug, safe_name,
)
from ..operators.integrity import ForeignKey
from ..operators.rows import keep_first_by_key

MEGABYTE = 1024 * 1024
FOREIGN_KEYS = tuple(
    ForeignKey(f"{child}.{column}", child, column, parent, parent_column)
    for child, column, parent, parent_column in (
        ("file", "user_id", "user", "user_id"),
        ("daily_uploads", "user_id", "user", "user_id"),
        ("researcher_stats", "user_id", "user", "user_id"),
        ("lineage", "bronze_file_id", "file", "upload_id"),
        ("lineage", "silver_aggregation_id", "silver", "silver_id"),
    )
)
ROOT_FOLDER = "root"


def bronze_rows(uploads: DataFrame) -> DataFrame:
    """Catalogue columns of uploaded files.

    ``uploads(upload_id, filename, file_size, file_hash, user_id, owner_name, owner_email,
    dataset, upload_time_utc)``.
    """
    name = safe_name(F.col("filename"))
    owner = owner_slug(F.col("owner_name"), F.col("owner_email"))
    return uploads.select(
        "upload_id",
        name.alias("filename"),
        object_path(owner, F.col("dataset"), F.col("filename")).alias("file_path"),
        "file_size",
        "file_hash",
        file_extension(name).alias("file_extension"),
        detect_modality(name).alias("modality"),
        "user_id",
        F.coalesce(dataset_folder(F.col("dataset")), F.lit(ROOT_FOLDER)).alias("dataset_name"),
        "upload_time_utc",
        F.lit("raw").alias("processing_status"),
        F.col("owner_name").alias("researcher_name"),
        F.col("owner_email").alias("researcher_email"),
    )


def manifest_ingest(uploads: DataFrame, catalogue: DataFrame) -> DataFrame:
    """New catalogue rows: the earliest upload of each content the catalogue does not hold.

    Repeats are dropped before anything is written. Uploads are reduced to one row per
    hash before the comparison with the catalogue.
    """
    fresh = keep_first_by_key(uploads, ["file_hash"], [F.col("upload_time_utc"), F.col("upload_id")])
    known = catalogue.select("file_hash").distinct()
    return bronze_rows(fresh.join(known, "file_hash", "left_anti"))


def lineage_append(ingested: DataFrame) -> DataFrame:
    return ingested.select(
        F.col("upload_id").alias("bronze_file_id"),
        F.col("dataset_name").alias("source_dataset"),
        F.col("file_path").alias("source_file_path"),
        F.col("researcher_name").alias("source_researcher"),
        F.col("researcher_email").alias("source_researcher_email"),
        "upload_time_utc",
        F.lit("ingestion").alias("transformation_type"),
        F.lit("success").alias("status"),
    )


def newest_first(files: DataFrame) -> DataFrame:
    return files.orderBy(F.col("upload_time_utc").desc(), "upload_id")


def active_files_for_user(files: DataFrame, user_id) -> DataFrame:
    return files.where((F.col("user_id") == user_id) & ~F.col("is_deleted"))


def modality_hub(files: DataFrame, modality: str) -> DataFrame:
    return files.where((F.col("modality") == modality) & ~F.col("is_deleted"))


def files_with_lineage(files: DataFrame, lineage: DataFrame) -> DataFrame:
    steps = lineage.select(F.col("bronze_file_id").alias("upload_id"), "transformation_type", "status")
    return files.where(~F.col("is_deleted")).join(steps, "upload_id", "left")


def files_by_folder(files: DataFrame) -> DataFrame:
    folder = F.coalesce(F.nullif(F.col("dataset_name"), F.lit("")), F.lit("Uncategorized"))
    return files.groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("file_count"))


def file_type_stats(files: DataFrame) -> DataFrame:
    """One row for the whole catalogue. ``files(filename, file_size, is_uploaded)``."""
    name = F.col("filename")
    size = F.coalesce(F.sum("file_size"), F.lit(0)).cast("decimal(28,8)")
    return files.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(F.contains(name, F.lit("channels"))).alias("channels_files"),
        F.count_if(F.contains(name, F.lit("timestamps"))).alias("timestamps_files"),
        F.count_if(F.endswith(name, F.lit(".csv"))).alias("csv_files"),
        F.round(size / F.lit(MEGABYTE), 4).cast("decimal(18,4)").alias("total_size_mb"),
        F.count_if("is_uploaded").alias("uploaded_files"),
    )


def gold_daily_uploads(files: DataFrame) -> DataFrame:
    """Per day, user and modality: files, bytes, datasets. Datasets are counted from one row each."""
    keys = [F.to_date("upload_time_utc").alias("date"), "user_id", "modality"]
    per_dataset = files.groupBy(*keys, "dataset_name").agg(
        F.count(F.lit(1)).alias("_files"), F.sum("file_size").alias("_bytes")
    )
    return per_dataset.groupBy("date", "user_id", "modality").agg(
        F.sum("_files").alias("file_count"),
        F.coalesce(F.sum("_bytes"), F.lit(0)).alias("total_size_bytes"),
        F.count("dataset_name").alias("unique_datasets"),
    )


def gold_researcher_stats(files: DataFrame, quality: DataFrame) -> DataFrame:
    """Per user: uploads, bytes, datasets, files per modality, activity, average score.

    ``quality(upload_id, score)`` may lack files. Files are reduced to one row per user,
    dataset and day first; both distinct counts then come from that small frame. Scores join
    files by their ids alone.
    """
    day = F.to_date("upload_time_utc")
    per_day = files.groupBy("user_id", "dataset_name", day.alias("_day")).agg(
        F.count(F.lit(1)).alias("_files"),
        F.sum("file_size").alias("_bytes"),
        *[F.count_if(F.col("modality") == kind).alias(f"_{kind}") for kind in ("lidar", "radar", "wifi")],
        F.count_if(F.contains("filename", F.lit("channel"))).alias("_channels"),
    )
    totals = per_day.groupBy("user_id").agg(
        F.sum("_files").alias("total_uploads"),
        F.sum("_bytes").alias("total_storage_bytes"),
        F.countDistinct("dataset_name").alias("total_datasets"),
        *[F.sum(f"_{kind}").alias(f"{kind}_count") for kind in ("lidar", "radar", "wifi", "channels")],
        F.min("_day").alias("first_upload_date"),
        F.max("_day").alias("last_upload_date"),
        F.countDistinct("_day").alias("active_days"),
    )
    # Only a file's user and score meet; a user may be null.
    scored = files.select("upload_id", "user_id").join(quality.where(F.col("score").isNotNull()).select("upload_id", "score"), "upload_id")
    scores = scored.groupBy(F.col("user_id").alias("_user")).agg(
        F.try_divide(F.sum(F.col("score").cast("decimal(18,4)")).cast("double"), F.count(F.lit(1)).cast("double")).alias("_score")
    )
    return totals.join(scores, F.col("user_id").eqNullSafe(F.col("_user")), "left").select(
        *totals.columns, F.round(F.col("_score").cast("decimal(28,8)"), 4).cast("double").alias("avg_quality_score")
    )


def gold_quality_metrics(files: DataFrame, quality: DataFrame) -> DataFrame:
    """Per day and modality: valid, invalid and repeated files, scores, nulls, format errors.

    ``quality(upload_id, score, has_format_error)``. A file is valid with a score of at
    least 0.5 and no format error; a repeat is any but the first file of its content.
    """
    first = F.min(F.struct("upload_time_utc", "upload_id"))
    originals = files.groupBy("file_hash").agg(first["upload_id"].alias("upload_id")).select(
        "upload_id", F.lit(True).alias("_original")
    )
    joined = files.join(quality, "upload_id", "left").join(originals, "upload_id", "left")
    format_error = F.coalesce("has_format_error", F.lit(False))
    valid = F.coalesce(F.col("score") >= 0.5, F.lit(False)) & ~format_error
    score = F.col("score").cast("decimal(18,4)")
    average = F.try_divide(F.sum(score).cast("double"), F.count(score).cast("double"))
    return joined.groupBy(F.to_date("upload_time_utc").alias("date"), "modality").agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(valid).alias("valid_files"),
        F.count_if(~valid).alias("invalid_files"),
        F.count_if(F.col("_original").isNull()).alias("duplicate_files"),
        F.round(average.cast("decimal(28,8)"), 4).cast("double").alias("avg_quality_score"),
        F.min(F.col("score").cast("double")).alias("min_quality_score"),
        F.max(F.col("score").cast("double")).alias("max_quality_score"),
        F.count_if(F.col("score").isNull()).alias("null_value_count"),
        F.count_if(format_error).alias("format_error_count"),
    )


def silver_aggregate_stats(files: DataFrame) -> DataFrame:
    """Per modality: files, records, bytes, repeats, nulls, score, duration.

    ``files(modality, file_hash, record_count, file_size, null_count, started, finished)``.
    The score is 1 - (repeats + nulls) / (files + records), never below 0.
    """
    per_hash = files.groupBy("modality", "file_hash").agg(
        F.count(F.lit(1)).alias("_files"),
        F.sum("record_count").alias("_records"),
        F.sum("file_size").alias("_bytes"),
        F.sum("null_count").alias("_nulls"),
        F.min("started").alias("_started"),
        F.max("finished").alias("_finished"),
    )
    rows = per_hash.groupBy("modality").agg(
        F.sum("_files").alias("source_file_count"),
        F.sum("_records").alias("total_records"),
        F.sum("_bytes").alias("data_size_bytes"),
        F.sum(F.col("_files") - 1).alias("duplicate_count"),
        F.sum("_nulls").alias("null_count"),
        (F.unix_timestamp(F.max("_finished")) - F.unix_timestamp(F.min("_started"))).alias("processing_duration_seconds"),
    )
    bad = F.col("duplicate_count") + F.col("null_count")
    score = 1 - F.try_divide(bad.cast("double"), (F.col("source_file_count") + F.col("total_records")).cast("double"))
    return rows.withColumn(
        "quality_score", F.greatest(F.round(score.cast("decimal(28,8)"), 4).cast("double"), F.lit(0.0))
    )


def path_quality(paths: DataFrame, path: str) -> DataFrame:
    verdict = F.when(has_numeric_owner(F.col(path)), "bad").otherwise("good")
    return paths.withColumn("path_quality", verdict)
