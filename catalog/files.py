"""Files: catalogue, lineage, metrics, headers, profiles, vectors, de-identification."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ledgerloom.functions import dates, files as names, privacy as redaction
from ledgerloom.operators import integrity, matrices, profile, rows, sketches, vector_index, vectors
from ledgerloom.operators.running import is_increasing
from ledgerloom.plans import catalogue, privacy
from ledgerloom.session import settled, shared_dir
from ledgerloom.sources import datafiles, sinks

from .bindings import pick, text
from .registry import query

# --- scans ----------------------------------------------------------------------


@query("parquet_scan", "SELECT * FROM lineitem")
def parquet_scan(frames):
    return frames.table("lineitem")


@query(
    "binary_manifest_scan",
    """SELECT source || '/' || filename AS path, filename, octet_length(encode(text)) AS file_size, upload_time_utc AS modified, sha256(text) AS file_hash,
              regexp_extract(filename, '[^.]*$') AS file_extension, modality
       FROM documents JOIN (SELECT upload_id, modality, filename, upload_time_utc FROM files) ON doc_id = upload_id""",
)
def binary_manifest_scan(frames):
    documents = frames.table("documents").select(F.col("doc_id").alias("upload_id"), F.encode("text", "UTF-8").alias("content"))
    stored = documents.join(frames.files.select("upload_id", "file_path", "upload_time_utc"), "upload_id").select(
        F.col("file_path").alias("path"), F.octet_length("content").cast("bigint").alias("length"),
        F.col("upload_time_utc").alias("modificationTime"), "content",
    )
    return datafiles.manifest(stored).withColumn("modified", F.col("modified").cast("timestamp_ntz"))


@query(
    "csv_dialect_scan",
    """WITH t AS (SELECT doc_id, string_split(regexp_replace(regexp_replace(shown, '[ ]+$', ''), '"([^"]|"")*"', '', 'g'), chr(10)) AS lines
                  FROM (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN '"x, ""y; z"|' || chr(10) || '",name' || chr(10) || '"1,2",' || doc_id ELSE text END AS shown FROM documents)),
            w AS (SELECT doc_id, len(string_split(lines[1], ',')) AS c, list_max([len(string_split(x, ',')) for x in lines]) AS cm,
                         len(string_split(lines[1], ';')) AS s, list_max([len(string_split(x, ';')) for x in lines]) AS sm,
                         len(string_split(lines[1], chr(9))) AS t, list_max([len(string_split(x, chr(9))) for x in lines]) AS tm,
                         len(string_split(lines[1], '|')) AS p, list_max([len(string_split(x, '|')) for x in lines]) AS pm FROM t)
       SELECT doc_id, CASE WHEN c > 1 AND cm <= c THEN ',' WHEN s > 1 AND sm <= s THEN ';' WHEN t > 1 AND tm <= t THEN chr(9)
                           WHEN p > 1 AND pm <= p THEN '|' ELSE ';' END AS separator,
              CAST(CASE WHEN c > 1 AND cm <= c THEN c WHEN s > 1 AND sm <= s THEN s WHEN t > 1 AND tm <= t THEN t
                        WHEN p > 1 AND pm <= p THEN p ELSE 1 END AS INTEGER) AS column_count FROM w""",
)
def csv_dialect_scan(frames):
    """Every fifth text is a file with separators and a line break inside quotes."""
    quoted = F.concat(F.lit('"x, ""y; z"|\n",name\n"1,2",'), text(F.col("doc_id")))
    shown = F.when(F.col("doc_id") % 5 == 0, quoted).otherwise(F.col("text"))
    return datafiles.detect_dialects(frames.table("documents").withColumn("text", shown), "text").select("doc_id", "separator", "column_count")


PCD = """
    SELECT CAST(doc_id AS VARCHAR) AS file, '0.7' AS version, CAST(n_chars AS VARCHAR) AS width, '1' AS height,
           CASE WHEN doc_id % 5 <> 0 THEN CAST(n_chars AS VARCHAR) END AS points, 'ascii' AS data,
           ['x', 'y', 'z', 'rgb'] AS fields, CASE doc_id % 2 WHEN 0 THEN ['4', '4', '4', '8'] ELSE ['4', '4'] END AS size,
           CASE doc_id % 3 WHEN 0 THEN ['F', 'F', 'F', 'U'] WHEN 1 THEN ['F', 'I', 'Q', 'U'] ELSE ['F', 'F', 'F'] END AS type
    FROM documents"""


@query("pcd_header_scan", f"SELECT file, version, width, height, points, data, array_to_string(fields, ' ') AS fields, array_to_string(size, ' ') AS size, array_to_string(type, ' ') AS type, '1 1 1 1' AS count FROM ({PCD})")
def pcd_header_scan(frames):
    headers = datafiles.pcd_headers(frames.pcd_files)
    return headers.withColumns({c: F.array_join(c, " ") for c in ("fields", "size", "type", "count")})


@query(
    "pcd_schema_catalog",
    f"""SELECT file, CAST(k AS INTEGER) AS field_position, fields[k + 1] AS field, CAST(coalesce(points, '0') AS BIGINT) AS points,
               CASE type[k + 1] WHEN 'F' THEN 'Float' WHEN 'U' THEN 'Unsigned Integer' WHEN 'I' THEN 'Integer'
                    ELSE coalesce(type[k + 1], 'Unknown') END || ' (' || coalesce(size[k + 1], 'Unknown') || ' bytes)' AS dtype
        FROM ({PCD}), (SELECT unnest(range(4)) AS k)""",
)
def pcd_schema_catalog(frames):
    return datafiles.pcd_schema(datafiles.pcd_headers(frames.pcd_files))


# --- files by ranges --------------------------------------------------------------


@query(
    "manifest_of_files",
    """SELECT page_id, octet_length(encode(coalesce(html, ''))) + 1 AS file_size, sha256(coalesce(html, '') || chr(10)) AS file_hash FROM pages""",
)
def manifest_of_files(frames):
    """Every page as a file of its own, hashed in chunks."""
    path = shared_dir(frames.spark, "pages")
    sinks.write_file_per_key(frames.table("pages").select("page_id", F.coalesce("html", F.lit("")).alias("html")), path, "page_id", "html")
    found = datafiles.read_manifest(frames.spark, path, "part-*")
    return found.select(F.regexp_extract("path", "page_id=([0-9]+)", 1).cast("bigint").alias("page_id"), "file_size", "file_hash")


@query(
    "point_headers_of_files",
    """SELECT s_suppkey AS file, '.7' AS version, CAST(s_suppkey AS VARCHAR) AS points, 'binary' AS data, 'x y z' AS fields, '4 4 ' || (1 + s_nationkey % 8) AS size
       FROM supplier""",
)
def point_headers_of_files(frames):
    """A point cloud per supplier; the points have no line feed and are larger than a chunk for the first one."""
    path, key = shared_dir(frames.spark, "clouds"), F.col("s_suppkey").cast("string")
    lines = ("VERSION .7", "FIELDS x y z", F.concat(F.lit("SIZE 4 4 "), (1 + F.col("s_nationkey") % 8).cast("string")), "TYPE F F F", F.concat(F.lit("POINTS "), key), "DATA binary")
    points = F.repeat(F.lit("z"), F.when(F.col("s_suppkey") <= 1, 5_000_000).otherwise(2000))
    content = F.concat_ws("\n", *[line if not isinstance(line, str) else F.lit(line) for line in lines], points)
    sinks.write_file_per_key(frames.table("supplier").select("s_suppkey", content.alias("value")), path, "s_suppkey", "value")
    headers = datafiles.pcd_headers(datafiles.read_point_headers(frames.spark, path, "part-*"))
    file = F.regexp_extract("file", "s_suppkey=([0-9]+)", 1).cast("bigint").alias("file")
    return headers.select(file, "version", "points", "data", *[F.array_join(c, " ").alias(c) for c in ("fields", "size")])


@query(
    "delimited_files_scan",
    """SELECT o_orderkey, o_orderstatus, 'two' || chr(10) || 'lines, "' || o_orderpriority || '"; | end' AS note, o_totalprice FROM orders""",
)
def delimited_files_scan(frames):
    """Orders in delimited files, read in ranges; separators, quotes and line breaks stand inside quotes."""
    path = shared_dir(frames.spark, "delimited")
    note = F.concat(F.lit('two\nlines, "'), F.col("o_orderpriority"), F.lit('"; | end'))
    written = frames.table("orders").select("o_orderkey", "o_orderstatus", note.alias("note"), "o_totalprice")
    written.write.options(header=True, quoteAll=True, escape='"', sep="|").csv(path)
    read = datafiles.read_by_dialect(frames.spark, path, "o_orderkey bigint, o_orderstatus string, note string, o_totalprice double", "part-*", range_bytes=300_000)
    return read.drop("file")


# --- names and sizes --------------------------------------------------------------


@query("file_extension", "SELECT page_id, CASE WHEN contains(url, '.') THEN lower(regexp_extract(url, '[^.]*$')) ELSE 'unknown' END AS extension FROM pages")
def file_extension(frames):
    return frames.table("pages").select("page_id", names.file_extension(F.col("url")).alias("extension"))


@query("detect_modality", "SELECT upload_id, modality FROM files")
def detect_modality(frames):
    return frames.uploads.select("upload_id", names.detect_modality(F.col("filename")).alias("modality"))


@query(
    "classify_legacy_file",
    """SELECT upload_id, CASE WHEN upload_id % 6 IN (0, 5) THEN 'csv' WHEN upload_id % 2 = 0 THEN 'timestamps' ELSE 'channels' END AS kind
       FROM uploads""",
)
def classify_legacy_file(frames):
    prefix = pick(F.col("upload_id") % 2, "timestamps_", "channels_")
    return frames.uploads.select("upload_id", names.classify_legacy_file(F.concat(prefix, F.col("filename"))).alias("kind"))


SLUG = "CASE WHEN owner_name IS NOT NULL THEN lower(split_part(owner_name, ' ', 1)) ELSE replace(lower(split_part(owner_email, '@', 1)), '.', '_') END"
SAFE_NAME = "replace(filename, ' ', '_')"


@query("owner_slug", f"SELECT upload_id, {SLUG} AS slug FROM uploads")
def owner_slug(frames):
    return frames.uploads.select("upload_id", names.owner_slug(F.col("owner_name"), F.col("owner_email")).alias("slug"))


@query("object_path", f"SELECT upload_id, {SLUG} || coalesce('/' || dataset, '') || '/' || {SAFE_NAME} AS path FROM uploads")
def object_path(frames):
    owner = names.owner_slug(F.col("owner_name"), F.col("owner_email"))
    return frames.uploads.select("upload_id", names.object_path(owner, F.col("dataset"), F.col("filename")).alias("path"))


@query(
    "human_size",
    """SELECT doc_id, CASE WHEN size = 0 THEN '0 B' WHEN size < 1024 THEN size || ' B'
              WHEN size < 1048576 THEN CAST(round(CAST(size AS DECIMAL(28,8)) / 1024, 1)::DECIMAL(28,1) AS VARCHAR) || ' KB'
              ELSE CAST(CAST(round(CAST(size AS DECIMAL(28,8)) / 1048576, 2) AS DECIMAL(28,2)) AS VARCHAR) || ' MB' END AS shown
       FROM (SELECT doc_id, n_chars * doc_id AS size FROM documents)""",
)
def human_size(frames):
    size = F.col("n_chars") * F.col("doc_id")
    return frames.table("documents").select("doc_id", names.human_size(size).alias("shown"))


@query("short_time", "SELECT event_id, left(CAST(ts AS VARCHAR), 16) AS shown FROM events")
def short_time(frames):
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return frames.table("events").select("event_id", dates.short_time(stamp).alias("shown"))


@query(
    "clean_dtype",
    """SELECT event_id, CASE event_type WHEN 'view' THEN 'Integer (64-bit)' WHEN 'click' THEN 'Float (32-bit)'
              WHEN 'signup' THEN 'Complex128' WHEN 'error' THEN 'String / Object' ELSE 'purchase' END AS label FROM events""",
)
def clean_dtype(frames):
    raw = F.col("event_type")
    dtype = (
        F.when(raw == "view", "<int64").when(raw == "click", "float32")
        .when(raw == "signup", "[('real','<f8')]").when(raw == "error", "object").otherwise(raw)
    )
    return frames.table("events").select("event_id", names.clean_dtype(dtype).alias("label"))


@query(
    "utc_pacific",
    """SELECT event_id, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'US/Pacific' AS pacific, ts AS back FROM events""",
)
def utc_pacific(frames):
    local = dates.to_pacific(F.col("ts").cast("timestamp"))
    back = dates.from_pacific(local)
    return frames.table("events").select(
        "event_id", local.cast("timestamp_ntz").alias("pacific"), back.cast("timestamp_ntz").alias("back")
    )


# --- catalogue ----------------------------------------------------------------------

FILE_COLUMNS = "upload_id, filename, file_size, file_hash, file_path, file_extension, modality, user_id, dataset_name, upload_time_utc, is_deleted"


def _plain_time(df):
    return df.withColumn("upload_time_utc", F.col("upload_time_utc").cast("timestamp_ntz"))


@query("active_files_for_user", f"SELECT {FILE_COLUMNS} FROM files WHERE user_id = 'src3' AND NOT is_deleted")
def active_files_for_user(frames):
    return _plain_time(catalogue.active_files_for_user(frames.files, "src3"))


@query("modality_hub", f"SELECT {FILE_COLUMNS} FROM files WHERE modality = 'lidar' AND NOT is_deleted")
def modality_hub(frames):
    return _plain_time(catalogue.modality_hub(frames.files, "lidar"))


@query("newest_first", "SELECT upload_id, upload_time_utc FROM files ORDER BY upload_time_utc DESC, upload_id")
def newest_first(frames):
    return _plain_time(catalogue.newest_first(frames.files).select("upload_id", "upload_time_utc"))


@query(
    "files_with_lineage",
    f"""SELECT {FILE_COLUMNS}, transformation_type, status FROM files LEFT JOIN lineage ON upload_id = bronze_file_id WHERE NOT is_deleted""",
)
def files_with_lineage(frames):
    return _plain_time(catalogue.files_with_lineage(frames.files, frames.lineage))


@query("files_by_folder", "SELECT coalesce(nullif(dataset_name, ''), 'Uncategorized') AS folder, count(*) AS file_count FROM files GROUP BY 1")
def files_by_folder(frames):
    return catalogue.files_by_folder(frames.files)


@query(
    "file_type_stats",
    """SELECT count(*) AS total_files, count(*) FILTER (contains(filename, 'channels')) AS channels_files,
              count(*) FILTER (contains(filename, 'timestamps')) AS timestamps_files, count(*) FILTER (filename LIKE '%.csv') AS csv_files,
              CAST(round(CAST(sum(file_size) AS DOUBLE) / 1048576, 4) AS DECIMAL(18,4)) AS total_size_mb,
              count(*) FILTER (NOT is_deleted) AS uploaded_files FROM files""",
)
def file_type_stats(frames):
    return catalogue.file_type_stats(frames.files.withColumn("is_uploaded", ~F.col("is_deleted")))


@query(
    "path_quality_split",
    """SELECT path, CASE WHEN regexp_matches(split_part(path, '/', 1), '^[0-9]+$') THEN 'bad' ELSE 'good' END AS path_quality
       FROM (SELECT CASE WHEN is_deleted THEN upload_id || '/' || filename ELSE file_path END AS path FROM files)""",
)
def path_quality_split(frames):
    path = F.when(F.col("is_deleted"), F.concat_ws("/", "upload_id", "filename")).otherwise(F.col("file_path"))
    return catalogue.path_quality(frames.files.select(path.alias("path")), "path")


INGESTED = f"""
    SELECT upload_id, {SAFE_NAME} AS filename, {SLUG} || coalesce('/' || dataset, '') || '/' || {SAFE_NAME} AS file_path, file_size, file_hash,
           regexp_extract(filename, '[^.]*$') AS file_extension, (SELECT modality FROM files f WHERE f.upload_id = u.upload_id) AS modality,
           user_id, coalesce(dataset, 'root') AS dataset_name, upload_time_utc, 'raw' AS processing_status,
           owner_name AS researcher_name, owner_email AS researcher_email
    FROM uploads u WHERE file_hash NOT IN (SELECT sha256(text) FROM documents WHERE lang = 'de')
    QUALIFY row_number() OVER (PARTITION BY file_hash ORDER BY upload_time_utc, upload_id) = 1"""


@query("manifest_ingest", INGESTED)
def manifest_ingest(frames):
    """German texts are in the catalogue already."""
    known = frames.table("documents").where(F.col("lang") == "de").select(F.sha2("text", 256).alias("file_hash"))
    return _plain_time(catalogue.manifest_ingest(frames.uploads, known))


@query(
    "lineage_append",
    f"""SELECT upload_id AS bronze_file_id, dataset_name AS source_dataset, file_path AS source_file_path, researcher_name AS source_researcher,
               researcher_email AS source_researcher_email, upload_time_utc, 'ingestion' AS transformation_type, 'success' AS status
        FROM ({INGESTED})""",
)
def lineage_append(frames):
    return catalogue.lineage_append(manifest_ingest(frames))


@query(
    "manifest_reconcile",
    """SELECT coalesce(c.file_hash, s.file_hash) AS file_hash, coalesce(c.n, 0) AS catalogue_rows, coalesce(s.n, 0) AS storage_rows,
              CASE WHEN s.n IS NULL THEN 'catalogue_only' WHEN c.n IS NULL THEN 'storage_only' ELSE 'both' END AS status
       FROM (SELECT file_hash, count(*) AS n FROM files GROUP BY 1) c
       FULL JOIN (SELECT sha256(text || CASE WHEN lang = 'fr' THEN '!' ELSE '' END) AS file_hash, count(*) AS n FROM documents GROUP BY 1) s
       ON c.file_hash = s.file_hash""",
)
def manifest_reconcile(frames):
    """French texts changed in the store since they were catalogued."""
    stored = F.concat("text", F.when(F.col("lang") == "fr", "!").otherwise(""))
    return integrity.manifest_reconcile(frames.files, frames.table("documents").select(F.sha2(stored, 256).alias("file_hash")), "file_hash")


@query(
    "gold_daily_uploads",
    """SELECT CAST(upload_time_utc AS DATE) AS date, user_id, modality, count(*) AS file_count, CAST(sum(file_size) AS BIGINT) AS total_size_bytes,
              count(DISTINCT dataset_name) AS unique_datasets FROM files GROUP BY 1, 2, 3""",
)
def gold_daily_uploads(frames):
    return catalogue.gold_daily_uploads(frames.files)


AVG_SCORE = "CAST(round(CAST(CAST(sum(CAST(score AS DECIMAL(18,4))) AS DOUBLE) / nullif(count(score), 0) AS DECIMAL(28,8)), 4) AS DOUBLE)"


@query(
    "gold_researcher_stats",
    f"""SELECT user_id, count(*) AS total_uploads, CAST(sum(file_size) AS BIGINT) AS total_storage_bytes, count(DISTINCT dataset_name) AS total_datasets,
               count(*) FILTER (modality = 'lidar') AS lidar_count, count(*) FILTER (modality = 'radar') AS radar_count,
               count(*) FILTER (modality = 'wifi') AS wifi_count, count(*) FILTER (contains(filename, 'channel')) AS channels_count,
               min(CAST(upload_time_utc AS DATE)) AS first_upload_date, max(CAST(upload_time_utc AS DATE)) AS last_upload_date,
               count(DISTINCT CAST(upload_time_utc AS DATE)) AS active_days, {AVG_SCORE} AS avg_quality_score
        FROM files LEFT JOIN file_quality USING (upload_id) GROUP BY 1""",
)
def gold_researcher_stats(frames):
    return catalogue.gold_researcher_stats(frames.files, frames.file_quality)


@query(
    "gold_quality_metrics",
    f"""WITH f AS (SELECT *, row_number() OVER (PARTITION BY file_hash ORDER BY upload_time_utc, upload_id) > 1 AS repeated FROM files)
        SELECT CAST(upload_time_utc AS DATE) AS date, modality, count(*) AS total_files,
               count(*) FILTER (coalesce(score >= 0.5, false) AND NOT coalesce(has_format_error, false)) AS valid_files,
               count(*) FILTER (NOT (coalesce(score >= 0.5, false) AND NOT coalesce(has_format_error, false))) AS invalid_files,
               count(*) FILTER (repeated) AS duplicate_files, {AVG_SCORE} AS avg_quality_score, min(score) AS min_quality_score,
               max(score) AS max_quality_score, count(*) FILTER (score IS NULL) AS null_value_count,
               count(*) FILTER (coalesce(has_format_error, false)) AS format_error_count
        FROM f LEFT JOIN file_quality USING (upload_id) GROUP BY 1, 2""",
)
def gold_quality_metrics(frames):
    return catalogue.gold_quality_metrics(frames.files, frames.file_quality)


@query(
    "silver_aggregate_stats",
    """SELECT *, greatest(CAST(round(CAST(1 - CAST(duplicate_count + null_count AS DOUBLE) / (source_file_count + total_records) AS DECIMAL(28,8)), 4) AS DOUBLE), 0) AS quality_score
       FROM (SELECT modality, count(*) AS source_file_count, CAST(sum(len(string_split(text, chr(10)))) AS BIGINT) AS total_records,
                    CAST(sum(file_size) AS BIGINT) AS data_size_bytes, count(*) - count(DISTINCT file_hash) AS duplicate_count,
                    count(*) FILTER (dataset_name IS NULL) AS null_count,
                    CAST(epoch(max(upload_time_utc)) - epoch(min(upload_time_utc)) AS BIGINT) AS processing_duration_seconds
             FROM files JOIN documents ON upload_id = doc_id GROUP BY 1)""",
)
def silver_aggregate_stats(frames):
    lines = frames.table("documents").select(
        F.col("doc_id").alias("upload_id"), F.size(F.split("text", "\n")).cast("bigint").alias("record_count")
    )
    measured = frames.files.join(lines, "upload_id").withColumns(
        {
            "null_count": F.col("dataset_name").isNull().cast("bigint"),
            "started": F.col("upload_time_utc"),
            "finished": F.col("upload_time_utc"),
        }
    )
    return catalogue.silver_aggregate_stats(measured)


# --- profiles -----------------------------------------------------------------------

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]
DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
LABEL_COLUMNS = ["doc_id", "quality", "toxic"]


def _event_rows(frames):
    return profile.to_rows(frames.table("events"), "event_id", EVENT_COLUMNS)


UPLOAD_COLUMNS = ["upload_id", "filename", "file_size", "file_hash", "user_id", "owner_name", "owner_email", "dataset", "upload_time_utc"]


@query(
    "null_counts",
    f"""WITH c AS (SELECT unnest({UPLOAD_COLUMNS}) AS column_name, unnest([{', '.join(f'count(*) - count({c})' for c in UPLOAD_COLUMNS)}]) AS null_count FROM uploads)
        SELECT column_name, null_count, null_count > 0 AS has_nulls, CAST((SELECT sum(null_count) FROM c) AS BIGINT) AS total_null_cells FROM c""",
)
def null_counts(frames):
    return profile.null_counts(frames.uploads)


def _rounded(expr: str) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(28,10)), 6) AS DOUBLE)"


NUMERIC = ", ".join(
    f"{_rounded(expr)} AS {name}"
    for name, expr in {
        "min": "min(v)", "max": "max(v)", "mean": "avg(v)", "median": "quantile_cont(v, 0.5)", "std": "stddev_samp(v)",
        "percentile_25": "quantile_cont(v, 0.25)", "percentile_75": "quantile_cont(v, 0.75)",
    }.items()
)


@query(
    "column_profile_numeric",
    f"""SELECT column_name, {NUMERIC} FROM (SELECT column_name, value, TRY_CAST(value AS DOUBLE) AS v FROM event_texts) GROUP BY 1
        HAVING count(value) = count(v) AND count(v) > 0""",
)
def column_profile_numeric(frames):
    return profile.numeric_stats(_event_rows(frames))


@query(
    "column_profile_base",
    """SELECT column_name, count(*) AS total_values, count(*) FILTER (value IS NULL) AS null_count, count(value) AS non_null_count,
              count(DISTINCT value) AS unique_values, array_to_string(list(value ORDER BY pos)[1:5], '|') AS sample_values
       FROM event_texts GROUP BY 1""",
)
def column_profile_base(frames):
    samples = profile.sample_values(_event_rows(frames)).withColumn("sample_values", F.array_join("sample_values", "|"))
    return profile.base_stats(_event_rows(frames)).join(samples, "column_name", "left")


WITHIN = {"unique_values": 0.1, "median": 0.03, "percentile_25": 0.03, "percentile_75": 0.03}


@query(
    "column_profile_sketches",
    """SELECT column_name, count(*) AS total_values, count(*) - count(value) AS null_count, true AS sketches_are_close
       FROM event_texts GROUP BY 1""",
)
def column_profile_sketches(frames):
    """Sketches per event type, merged; their figures are held against the exact ones, ranks within 3 % of the spread."""
    events = frames.table("events").withColumn("kind", F.col("event_type"))
    kept = settled(sketches.batch_profiles(events, EVENT_COLUMNS, F.col("kind")))
    found = sketches.sketched_statistics(sketches.merged_profiles(kept))
    exact = profile.base_stats(_event_rows(frames)).select("column_name", F.col("unique_values").alias("exact_unique"))
    numbers = profile.numeric_stats(_event_rows(frames)).select("column_name", *[F.col(c).alias(f"exact_{c}") for c in ("min", "max", "median", "percentile_25", "percentile_75")])
    both = found.join(exact, "column_name").join(numbers, "column_name", "left")
    close = F.abs(F.col("unique_values") - F.col("exact_unique")) <= WITHIN["unique_values"] * F.col("exact_unique") + 1
    spread = F.col("exact_max") - F.col("exact_min")
    for name in ("median", "percentile_25", "percentile_75"):
        close &= F.coalesce(F.abs(F.col(name) - F.col(f"exact_{name}")) <= WITHIN[name] * spread, F.col(f"exact_{name}").isNull() & F.col(name).isNull())
    return both.select("column_name", "total_values", "null_count", close.alias("sketches_are_close"))


@query(
    "column_profile_topk",
    """SELECT * FROM (SELECT column_name, value, count(*) AS value_count FROM document_texts WHERE value IS NOT NULL GROUP BY 1, 2)
       QUALIFY row_number() OVER (PARTITION BY column_name ORDER BY value_count DESC, value) <= 10""",
)
def column_profile_topk(frames):
    return profile.top_values(profile.to_rows(frames.table("documents"), "doc_id", DOCUMENT_COLUMNS))


@query(
    "column_profile_boolean",
    """SELECT column_name, count(*) FILTER (value = '1') AS true_count, count(*) FILTER (value = '0') AS false_count
       FROM label_texts GROUP BY 1 HAVING count(*) FILTER (value NOT IN ('0', '1')) = 0""",
)
def column_profile_boolean(frames):
    return profile.boolean_counts(profile.to_rows(frames.table("labels"), "doc_id", LABEL_COLUMNS))


@query(
    "column_profile_text",
    f"""SELECT column_name, {_rounded('avg(length(value))')} AS avg_length, CAST(min(length(value)) AS INTEGER) AS min_length,
               CAST(max(length(value)) AS INTEGER) AS max_length FROM document_texts GROUP BY 1""",
)
def column_profile_text(frames):
    return profile.text_lengths(profile.to_rows(frames.table("documents"), "doc_id", DOCUMENT_COLUMNS))


@query(
    "column_profile_timestamp",
    f"""SELECT 'ts' AS column_name, min(ts) AS earliest, max(ts) AS latest,
               {_rounded('epoch_us(max(ts)) / 1e6 - epoch_us(min(ts)) / 1e6')} AS time_range_seconds FROM events
        UNION ALL SELECT 'event_id', make_timestamp(min(event_id) * 1000000), make_timestamp(max(event_id) * 1000000),
               CAST(max(event_id) - min(event_id) AS DOUBLE) FROM events""",
)
def column_profile_timestamp(frames):
    ranges = profile.time_ranges(profile.to_rows(frames.table("events"), "event_id", ["ts", "event_id"]))
    return ranges.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("earliest", "latest")})


def _classified(texts: str) -> str:
    """Types worked out from ``(pos, column_name, value)`` by the same rules, in SQL."""
    return f"""
        SELECT column_name, n AS total_values, n - nn AS null_count, nn AS non_null_count, u AS unique_values,
               CASE WHEN nn = 0 THEN 'empty' WHEN words = nn AND u <= 2 THEN 'boolean'
                    WHEN numbers = nn AND (list_has_any(regexp_split_to_array(lower(column_name), '[^a-z0-9]+'),
                         ['time', 'timestamp', 'date', 'epoch', 'unix', 'sec', 'ms', 'ns']) OR (nn = n AND lowest > 1e9 AND falls = 0)) THEN 'timestamp'
                    WHEN numbers = nn THEN 'numeric' WHEN moments = nn THEN 'timestamp'
                    WHEN u / n < 0.05 OR u <= 50 THEN 'categorical' ELSE 'text' END AS detected_type
        FROM (SELECT column_name, count(*) AS n, count(value) AS nn, count(DISTINCT value) AS u, count(v) AS numbers, min(v) AS lowest,
                     count(*) FILTER (v < before) AS falls, count(TRY_CAST(value AS TIMESTAMP)) AS moments,
                     count(*) FILTER (lower(value) IN ('true', 'false', 'yes', 'no', '0', '1', '0.0', '1.0')) AS words
              FROM (SELECT *, lag(v) OVER (PARTITION BY column_name ORDER BY pos) AS before FROM (SELECT *, TRY_CAST(value AS DOUBLE) AS v FROM {texts}))
              GROUP BY 1)"""


@query(
    "classify_column",
    _classified("(SELECT pos, column_name, value FROM event_texts UNION ALL SELECT event_id, 'epoch', CAST(event_id + 1700000000 AS VARCHAR) FROM events)"),
)
def classify_column(frames):
    events = frames.table("events").withColumn("epoch", F.col("event_id") + 1700000000)
    return profile.classify_columns(events, "event_id", [*EVENT_COLUMNS, "epoch"])


@query(
    "profile_summary",
    f"""SELECT detected_type, count(*) AS column_count, max(total_values) AS num_rows, CAST(sum(null_count) AS BIGINT) AS null_cells, sum(null_count) > 0 AS has_nulls,
               CAST(3 AS BIGINT) AS num_columns FROM ({_classified('label_texts')}) GROUP BY 1""",
)
def profile_summary(frames):
    return profile.profile_summary(frames.table("labels"), "doc_id", LABEL_COLUMNS)


@query(
    "monotonic_epoch_check",
    """WITH s AS (SELECT 'by_id' AS series, event_id AS pos, CAST(event_id + 1700000000 AS DOUBLE) AS v FROM events
                  UNION ALL SELECT 'by_value', event_id, value FROM events),
            d AS (SELECT *, lag(v) OVER (PARTITION BY series ORDER BY pos) AS before FROM s)
       SELECT series, min(v) AS lowest, count(*) FILTER (v < before) = 0 AS increasing FROM d GROUP BY 1""",
)
def monotonic_epoch_check(frames):
    events = frames.table("events")
    by_id = events.select(F.lit("by_id").alias("series"), "event_id", (F.col("event_id") + 1700000000).cast("double").alias("v"))
    by_value = events.select(F.lit("by_value").alias("series"), "event_id", F.col("value").alias("v"))
    return is_increasing(by_id.unionByName(by_value), ["series"], "event_id", "v", width=1000)


@query("head_sample", "SELECT doc_id, lang, source FROM documents ORDER BY doc_id LIMIT 20")
def head_sample(frames):
    return rows.top_n(frames.table("documents").select("doc_id", "lang", "source"), 20, F.col("doc_id"))


# --- arrays and vectors ---------------------------------------------------------------


@query(
    "array_variable_stats",
    """SELECT label, count(DISTINCT vec_id) || 'x' || max(len(embedding)) AS shape, 2 AS ndim, CAST(sum(len(embedding)) AS BIGINT) AS size,
              CAST(min(list_min(embedding)) AS DOUBLE) AS min, CAST(max(list_max(embedding)) AS DOUBLE) AS max,
              CAST(round(CAST(sum(list_sum([x::DOUBLE for x in embedding])) / sum(len(embedding)) AS DECIMAL(28,10)), 6) AS DOUBLE) AS mean
       FROM embeddings GROUP BY 1""",
)
def array_variable_stats(frames):
    return matrices.array_variable_stats(frames.table("embeddings"), "label", "embedding")


COSINE = "list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), q.query)"


@query(
    "embedding_topk_cosine",
    f"""WITH c AS (SELECT label, k, avg(CAST(embedding[k] AS DOUBLE)) AS m FROM embeddings, (SELECT unnest(range(1, 65)) AS k) GROUP BY 1, 2),
            q AS (SELECT label, list(m ORDER BY k) AS query FROM c GROUP BY 1)
        SELECT label AS query_id, vec_id, round(similarity, 9) AS similarity FROM
        (SELECT q.label, vec_id, {COSINE} AS similarity FROM embeddings e JOIN q ON e.label = q.label)
        QUALIFY row_number() OVER (PARTITION BY label ORDER BY similarity DESC, vec_id) <= 10""",
)
def embedding_topk_cosine(frames):
    """The vectors nearest to the mean of their label."""
    found = vectors.topk_cosine(frames.table("embeddings"), frames.label_queries, "label", 10)
    return found.withColumn("similarity", F.round("similarity", 9))


EXACT = """SELECT q.vec_id AS query_id, e.vec_id, round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 9) AS similarity,
                  CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[])), 9) DESC, e.vec_id) AS INT) AS rank
           FROM embeddings q, embeddings e WHERE q.vec_id % 100 = 0"""
NEIGHBOURS, PROBED = 10, 0.75


def _vector_index(frames):
    """The index over all vectors, and those whose id is divisible by 100 as queries."""
    index = vector_index.build_index(frames.table("embeddings"), shared_dir(frames.spark, "vectors"))
    asked = frames.table("embeddings").where(F.col("vec_id") % 100 == 0).select(F.col("vec_id").alias("query_id"), "embedding")
    return index, asked


@query("embedding_index_search")
def embedding_index_search(frames):
    """The nearest vectors in three quarters of the lists; approximate, so checked by ``embedding_index_recall``."""
    index, asked = _vector_index(frames)
    return vector_index.search(index, asked, NEIGHBOURS, math.ceil(PROBED * len(index.centres)))


@query("embedding_index_exact", f"SELECT * FROM ({EXACT}) WHERE rank <= {NEIGHBOURS}")
def embedding_index_exact(frames):
    """All lists probed: every row is in the index."""
    index, asked = _vector_index(frames)
    return vector_index.search(index, asked, NEIGHBOURS, len(index.centres))


@query("embedding_index_recall", "SELECT count(*) AS queries, true AS recall_is_high FROM embeddings WHERE vec_id % 100 = 0")
def embedding_index_recall(frames):
    """The recall of the search against the exact answer is 0.95 or more."""
    index, asked = _vector_index(frames)
    found = settled(vector_index.search(index, asked, NEIGHBOURS, math.ceil(PROBED * len(index.centres))))
    exact = vector_index.search(index, asked, NEIGHBOURS, len(index.centres))
    return vector_index.recall(found, exact).select("queries", (F.col("recall") >= 0.95).alias("recall_is_high"))


@query(
    "embedding_refresh_check",
    """WITH d AS (SELECT doc_id, sha256(text) AS h FROM documents),
            v AS (SELECT CASE WHEN lang = 'de' THEN doc_id + 1000000000 ELSE doc_id END AS doc_id,
                         CASE WHEN source = 'src1' THEN sha256('') ELSE sha256(text) END AS h FROM documents)
       SELECT coalesce(d.doc_id, v.doc_id) AS doc_id, CASE WHEN v.doc_id IS NULL THEN 'missing' WHEN d.doc_id IS NULL THEN 'orphan'
              WHEN d.h = v.h THEN 'current' ELSE 'stale' END AS status FROM d FULL JOIN v ON d.doc_id = v.doc_id""",
)
def embedding_refresh_check(frames):
    """A store that has German texts under other ids and src1 as it was before it changed."""
    documents = frames.table("documents")
    current = documents.select("doc_id", F.sha2("text", 256).alias("h"))
    stored = documents.select(
        F.when(F.col("lang") == "de", F.col("doc_id") + 1000000000).otherwise(F.col("doc_id")).alias("doc_id"),
        F.when(F.col("source") == "src1", F.sha2(F.lit(""), 256)).otherwise(F.sha2("text", 256)).alias("h"),
    )
    return vectors.store_consistency(current, stored, "doc_id", "h")


# --- de-identification ----------------------------------------------------------------


# Written out apart from the library's own patterns.
REDACTED = (
    ("[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+[.][A-Za-z]{2,}", "[EMAIL REMOVED]"),
    ('https?://[^ \\t\\r\\n<>"]+', "[URL REMOVED]"),
    ("\\b[0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}[.][0-9]{1,3}\\b", "[IP REMOVED]"),
    ("([+][0-9]{1,3}[ .-]?)?([(][0-9]{3}[)] ?|[0-9]{3}[ .-])[0-9]{3}[ .-]?[0-9]{4}\\b", "[PHONE REMOVED]"),
)


def _redact_sql(expr: str) -> str:
    for pattern, token in REDACTED:
        expr = f"regexp_replace({expr}, '{pattern}', '{token}', 'g')"
    return expr


@query("deid_redact_text", f"SELECT doc_id, {_redact_sql('text')} AS redacted FROM documents")
def deid_redact_text(frames):
    return frames.table("documents").select("doc_id", redaction.redact_text(F.col("text")).alias("redacted"))


@query("deid_redact_urls", f"SELECT page_id, {_redact_sql('html')} AS redacted FROM (SELECT page_id, url || ' ' || html AS html FROM pages)")
def deid_redact_urls(frames):
    page = F.concat_ws(" ", "url", "html")
    return frames.table("pages").select("page_id", redaction.redact_text(page).alias("redacted"))


@query("deid_drop_identifiers", "SELECT c_custkey AS patient, c_nationkey AS state, c_acctbal AS balance FROM customer")
def deid_drop_identifiers(frames):
    people = frames.table("customer").select(
        F.col("c_custkey").alias("patient"), F.col("c_name").alias("NAME"), F.col("c_nationkey").alias("state"),
        F.col("c_mktsegment").alias("plan"), F.col("c_acctbal").alias("balance"),
    )
    return privacy.drop_identifiers(people)


@query(
    "deid_generalise",
    """WITH pop AS (SELECT CAST(100 + c_nationkey AS VARCHAR) AS z, count(*) * 350 AS population FROM customer GROUP BY 1)
       SELECT c_custkey AS person_id, CASE WHEN population IS NULL OR population < 20000 THEN '000' ELSE z END AS zip_3digit,
              CASE WHEN c_custkey % 110 >= 35 THEN CAST(1900 + c_custkey % 110 AS INTEGER) END AS birth_year,
              CASE WHEN 2024 - (1900 + c_custkey % 110) > 89 THEN '90+' ELSE CAST(2024 - (1900 + c_custkey % 110) AS VARCHAR) END AS age_band,
              CAST(2010 + c_custkey % 9 AS INTEGER) AS admission_date_year, CAST(2011 + c_custkey % 9 AS INTEGER) AS discharge_date_year
       FROM customer LEFT JOIN pop ON z = CAST(100 + c_nationkey AS VARCHAR)""",
)
def deid_generalise(frames):
    customer = frames.table("customer")
    region = text(F.lit(100) + F.col("c_nationkey"))
    people = customer.select(
        F.col("c_custkey").alias("person_id"), F.concat(region, F.lit("42")).alias("zip"),
        F.make_date((1900 + F.col("c_custkey") % 110).cast("int"), F.lit(6), F.lit(15)).alias("birth_date"),
        F.make_date((2010 + F.col("c_custkey") % 9).cast("int"), F.lit(12), F.lit(31)).alias("admission_date"),
        F.make_date((2011 + F.col("c_custkey") % 9).cast("int"), F.lit(1), F.lit(1)).alias("discharge_date"),
    )
    population = customer.groupBy(region.alias("zip_3digit")).agg((F.count(F.lit(1)) * 350).alias("population"))
    return privacy.generalise(people, population, 2024)


@query(
    "deid_tokenise",
    "SELECT o_orderkey, o_custkey AS customer, sha256('s1' || o_custkey) AS patient_token FROM orders",
)
def deid_tokenise(frames):
    """Orders with the token of their customer, checked through the restricted map."""
    orders = privacy.tokenise(frames.table("orders").select("o_orderkey", "o_custkey"), "o_custkey", "s1")
    restricted = privacy.token_map(frames.table("orders"), "o_custkey", "s1")
    return orders.join(restricted, "patient_token").select("o_orderkey", F.col("o_custkey").alias("customer"), "patient_token")


@query(
    "deid_tokenise_numbers",
    "SELECT sha256('s1|o_orderkey|' || o_orderkey) AS o_orderkey_token, sha256('s1|o_custkey|' || o_custkey) AS o_custkey_token, o_orderstatus FROM orders",
)
def deid_tokenise_numbers(frames):
    """Record and account numbers as tokens."""
    return privacy.tokenise_columns(frames.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus"), ["o_orderkey", "o_custkey"], "s1")
