"""Uploaded data files: manifest, point-cloud headers, delimited text."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.files import detect_modality, file_extension, point_dtype
from ..session import settled
from .fileranges import RANGE_BYTES, read_digests, read_headers, read_records

# Header keywords with one value and with one value per field.
PCD_SCALARS = ("version", "width", "height", "points", "data")
PCD_ARRAYS = ("fields", "size", "type", "count")
# Separators in the order they are tried.
SEPARATORS = (",", ";", "\t", "|")
# A quoted field with its doubled quotes and line breaks.
QUOTED = r'"(?:[^"]|"")*"'


def read_manifest(spark: SparkSession, path: str, glob: str = "*", modified_after: datetime | None = None) -> DataFrame:
    """One row per file with size, time, SHA-256, extension and modality; files are hashed in chunks, whatever their size."""
    files = read_digests(spark, path, glob)
    return manifest(files if modified_after is None else files.where(F.col("modificationTime") > F.lit(modified_after)))


def manifest(files: DataFrame) -> DataFrame:
    """Manifest rows from ``path, length, modificationTime`` and ``file_hash`` or ``content``."""
    hashed = F.col("file_hash") if "file_hash" in files.columns else F.sha2("content", 256)
    name = F.substring_index("path", "/", -1)
    return files.select(
        "path",
        name.alias("filename"),
        F.col("length").alias("file_size"),
        F.col("modificationTime").alias("modified"),
        hashed.alias("file_hash"),
        file_extension(name).alias("file_extension"),
        detect_modality(name).alias("modality"),
    )


def read_point_headers(spark: SparkSession, path: str, glob: str = "*.pcd") -> DataFrame:
    """``(file, header)`` of every point-cloud file: its keyword lines up to the DATA line. Points behind it are not read."""
    return read_headers(spark, path, PCD_SCALARS + PCD_ARRAYS, "data", glob)


# The text up to and including the DATA line, whatever its case.
UP_TO_DATA = r"(?ims)\A.*?^[ \t]*data\b[^\r\n]*"


def _values_of(key: str) -> Column:
    """The words after ``key`` on its last header line, as an array; null when absent."""
    lines = F.filter("lines", lambda words: F.upper(F.get(words, F.lit(0))) == key)
    words = F.get(lines, F.size(lines) - 1)
    return F.slice(words, F.lit(2), F.size(words))


def pcd_headers(files: DataFrame) -> DataFrame:
    """One row per point-cloud header ``(file, header)``: scalars and field arrays.

    Everything behind the DATA line is cut off before lines are split.
    """
    cut = files.select("file", F.coalesce(F.regexp_substr("header", F.lit(UP_TO_DATA)), "header").alias("head"))
    words = F.transform(F.split("head", r"\r?\n"), lambda line: F.split(F.trim(F.regexp_replace(line, r"\s+", " ")), " "))
    opened = cut.select(
        "file", F.filter(words, lambda w: (F.get(w, F.lit(0)) != "") & ~F.get(w, F.lit(0)).startswith("#")).alias("lines")
    )
    values = opened.select("file", *[_values_of(name.upper()).alias(name) for name in PCD_SCALARS + PCD_ARRAYS])
    return values.select(
        "file",
        *[F.get(name, F.lit(0)).alias(name) for name in PCD_SCALARS],
        *[F.coalesce(F.col(name), F.array().cast("array<string>")).alias(name) for name in PCD_ARRAYS],
    )


def pcd_schema(headers: DataFrame) -> DataFrame:
    """One row per field of each header: position, name, points, shown type."""
    fields = headers.select("file", "points", "size", "type", F.posexplode("fields").alias("field_position", "field"))
    return fields.select(
        "file",
        "field_position",
        "field",
        F.coalesce(F.col("points").try_cast("bigint"), F.lit(0)).alias("points"),
        point_dtype(
            F.get("type", F.col("field_position")), F.get("size", F.col("field_position"))
        ).alias("dtype"),
    )


def detect_dialects(files: DataFrame, text: str) -> DataFrame:
    """Adds ``separator`` and ``column_count`` from the lines of each file's text, quoted parts left out.

    The first separator wins that splits the header line into several columns and gives
    no line more columns than the header. Where none does, the file has one column and
    counts as semicolon text.
    """
    unquoted = F.regexp_replace(F.rtrim(text), QUOTED, "")
    lines = F.split(unquoted, r"\r?\n")

    def splitter(separator: str):
        return lambda line: F.size(F.split(line, f"[{separator}]"))

    separator, columns = F, F
    for candidate in SEPARATORS:
        width = splitter(candidate)
        header = width(F.get(lines, F.lit(0)))
        widest = F.array_max(F.transform(lines, width))
        fits = (header > 1) & (widest <= header)
        separator, columns = separator.when(fits, candidate), columns.when(fits, header)
    return files.withColumns({"separator": separator.otherwise(";"), "column_count": columns.otherwise(1)})


def file_dialects(records: DataFrame) -> DataFrame:
    """``file``, ``separator``, ``column_count`` of delimited files given as records, by the rule of ``detect_dialects``.

    Records are reduced to their number of columns under each separator before anything is shuffled.
    """
    unquoted = F.regexp_replace("record", QUOTED, "")
    widths = {f"w{i}": F.size(F.split(unquoted, f"[{s}]")) for i, s in enumerate(SEPARATORS)}
    first = [F.min_by(w, "start").alias(f"header_{w}") for w in widths]
    counted = records.select("file", "start", *[w.alias(name) for name, w in widths.items()]).groupBy("file").agg(*first, *[F.max(w).alias(w) for w in widths])
    separator, columns = F, F
    for i, candidate in enumerate(SEPARATORS):
        header = F.col(f"header_w{i}")
        fits = (header > 1) & (F.col(f"w{i}") <= header)
        separator, columns = separator.when(fits, candidate), columns.when(fits, header)
    return counted.select("file", separator.otherwise(";").alias("separator"), columns.otherwise(1).alias("column_count"))


def read_by_dialect(spark: SparkSession, path: str, schema: str, glob: str = "*", range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All delimited files below ``path``, each read by its own separator, as one frame with ``file``.

    Files are read in ranges. The first record of a file is its header; missing fields and values of another
    type are null, further fields are passed over.
    """
    records = read_records(spark, path, glob, range_bytes)
    first = records.groupBy("file").agg(F.min("start").alias("first"))
    dialects = settled(file_dialects(records).join(first, "file"))
    placed = records.join(dialects, "file").where(F.col("start") > F.col("first"))
    parsed = F
    for candidate in SEPARATORS:
        parsed = parsed.when(F.col("separator") == candidate, F.from_csv("record", schema, {"sep": candidate, "escape": '"', "multiLine": "true"}))
    return placed.select("file", parsed.alias("r")).select("file", "r.*")
