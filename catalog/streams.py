"""Loads, watermarks and streams. Each works in a folder of its own below the shared one."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import loads
from ledgerloom.operators.merge import BatchTable
from ledgerloom.plans import telemetry as positions_batch
from ledgerloom.session import shared_dir
from ledgerloom.sources import bundles, sinks
from ledgerloom.streaming import alerts, gaze, ingest, positions
from ledgerloom.streaming.jobs import file_stream, run_available, to_files

from .bindings import Frames
from .registry import query
from .telemetry import DECISION, LATEST, REJECTS, plain_time


def _folder(frames: Frames, purpose: str) -> str:
    return shared_dir(frames.spark, purpose)


CUTS = (0.25, 0.5, 0.75)


def _feed(frames: Frames, table: str, folder: str, job, order=None) -> None:
    """Let a table arrive as several files along ``order`` (its first column), and run ``job(stream)`` after each."""
    given = frames.table(table)
    place = (F.col(given.columns[0]) if order is None else order).cast("double")
    cuts = given.select(place.alias("place")).approxQuantile("place", CUTS, 0.01)
    for low, high in zip([None, *cuts], [*cuts, None]):
        some = given
        some = some if low is None else some.where(place > low)
        some = some if high is None else some.where(place <= high)
        some.write.mode("append").parquet(f"{folder}/arriving")
        run_available(job(file_stream(frames.spark, f"{folder}/arriving", given.schema, "part-*")), f"{folder}/progress")


# --- loads ------------------------------------------------------------------------


@query(
    "flattened_parquet_sink",
    """SELECT * FROM merge_target UNION ALL
       SELECT * FROM merge_staging WHERE encounter_token NOT IN (SELECT encounter_token FROM merge_target)""",
)
def flattened_parquet_sink(frames):
    """Three batches, the last of them sent twice."""
    table = BatchTable(frames.spark, _folder(frames, "flattened"))
    for number, batch in ((1, frames.merge_target), (2, frames.merge_staging), (2, frames.merge_staging)):
        sinks.append_unique(table, batch, "encounter_token", ["total_claim_cost"], number)
    return table.read().drop("batch")


@query(
    "sample_export",
    "SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer ORDER BY c_custkey LIMIT 100",
)
def sample_export(frames):
    path = _folder(frames, "sample")
    customers = frames.table("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    sinks.write_sample_csv(customers, path, "c_custkey")
    return frames.spark.read.option("header", True).schema(customers.schema).csv(path)


@query("object_store_sink", "SELECT * FROM orders")
def object_store_sink(frames):
    path = _folder(frames, "store")
    sinks.truncate_and_load(frames.table("orders"), path)
    return frames.spark.read.parquet(path)


@query("truncate_and_load", "SELECT * FROM merge_staging")
def truncate_and_load(frames):
    """Loaded twice, the second load replaces the first."""
    path = _folder(frames, "refresh")
    sinks.truncate_and_load(frames.merge_target, path)
    sinks.truncate_and_load(frames.merge_staging, path)
    return frames.spark.read.parquet(path)


def _increments(frames):
    """Two incremental loads of patient bundles from real files: those of even patients, then of all others.

    Returns the table and the rows that each load read.
    """
    spark, folder = frames.spark, _folder(frames, "increments")
    landing, read = f"{folder}/landing", []
    schema = bundles.parse_patients(bundles.bundle_entries(frames.patient_bundles.limit(0))).schema
    table = loads.LoadedTable(spark, f"{folder}/patient", "fhir_patient_id", schema, 16)
    for odd in (0, 1):
        arriving = frames.patient_bundles.where(F.substring_index("file", "/", -1).cast("bigint") % 2 == odd)
        arriving.select("value").write.mode("append").text(landing)
        read.append(loads.load_newer_files(
            table, landing, lambda since: bundles.read_bundles(spark, landing, since, one_per_file=False, glob="part-*"),
            lambda files: bundles.parse_patients(bundles.bundle_entries(files)), "part-*",
        ))
    return table, read


@query("incremental_file_filter", "SELECT 2 AS load_number, * FROM fhir_patient WHERE CAST(fhir_patient_id AS BIGINT) % 2 = 1")
def incremental_file_filter(frames):
    """What the second load read: the patients of the files after the watermark, and no others."""
    _, read = _increments(frames)
    return read[1].select(F.lit(2).alias("load_number"), "*")


@query("incremental_load", "SELECT * FROM fhir_patient")
def incremental_load(frames):
    """The merged set after both loads."""
    table, _ = _increments(frames)
    return table.read()


FIRST_DAY, NEXT_DAY = "1995-06-17", "1997-03-01"
ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"]


def _orders_until(frames, day=None):
    orders = frames.table("orders").select(*ORDER_COLUMNS)
    return orders if day is None else orders.where(F.col("o_orderdate") <= F.lit(day).cast("date"))


def _order_loads(frames, *days):
    """Orders as they were known up to each day, loaded one after the other."""
    table = loads.LoadedTable(frames.spark, _folder(frames, "orders"), "o_orderkey", _orders_until(frames).schema, 16)
    for day in days:
        loads.load_newer_rows(table, _orders_until(frames, day), "o_orderdate")
        yield table


@query("watermark_read", f"SELECT 'orders' AS table_name, CAST(max(o_orderdate) AS TIMESTAMP) AS watermark FROM orders WHERE o_orderdate <= DATE '{NEXT_DAY}'")
def watermark_read(frames):
    """The watermark that travels with the rows, after two loads."""
    *_, table = _order_loads(frames, FIRST_DAY, NEXT_DAY)
    found = frames.spark.createDataFrame([("orders", table.watermark())], "table_name string, watermark timestamp")
    return plain_time(found, "watermark")


@query(
    "watermark_advance",
    " UNION ALL ".join(
        f"SELECT {number} AS load_number, CAST(max(o_orderdate) AS TIMESTAMP) AS watermark, count(*) AS table_rows FROM orders WHERE {condition}"
        for number, condition in ((1, f"o_orderdate <= DATE '{FIRST_DAY}'"), (2, f"o_orderdate <= DATE '{NEXT_DAY}'"), (3, "true"))
    ),
)
def watermark_advance(frames):
    """Watermark and rows of the table after each of three loads."""
    seen = [(number, table.watermark(), table.read().count()) for number, table in enumerate(_order_loads(frames, FIRST_DAY, NEXT_DAY, None), 1)]
    return plain_time(frames.spark.createDataFrame(seen, "load_number int, watermark timestamp, table_rows bigint"), "watermark")


@query(
    "pruned_upsert",
    f"""SELECT o_orderkey, o_custkey, o_orderdate, CASE WHEN o_orderdate > DATE '{FIRST_DAY}' AND o_orderkey % 64 = 1 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice
        FROM orders WHERE o_orderdate <= DATE '{FIRST_DAY}' OR o_orderkey % 64 = 1""",
)
def pruned_upsert(frames):
    """Some later orders, with another price, put into those of the first days."""
    *_, table = _order_loads(frames, FIRST_DAY)
    later = _orders_until(frames).where((F.col("o_orderdate") > F.lit(FIRST_DAY).cast("date")) & (F.col("o_orderkey") % 64 == 1))
    table.upsert(later.withColumn("o_totalprice", F.col("o_totalprice") + 1), ["o_custkey", "o_orderdate", "o_totalprice"])
    return table.read()


# --- streams ----------------------------------------------------------------------


@query("gps_stream_latest", LATEST)
def gps_stream_latest(frames):
    folder = _folder(frames, "positions")
    table = BatchTable(frames.spark, f"{folder}/latest")
    _feed(frames, "events", folder, lambda events: positions.keep_latest(Frames._gps(events), frames.routes, table))
    return plain_time(positions.current(table))


@query("gps_stream_reject_rates", REJECTS)
def gps_stream_reject_rates(frames):
    folder = _folder(frames, "rejects")
    table = BatchTable(frames.spark, f"{folder}/counts")
    _feed(frames, "events", folder, lambda events: positions.count_rejects(Frames._gps(events), frames.routes, table))
    return plain_time(positions.rates(table), "window_start")


def _closed_rates(frames, order):
    """Daily counts closed a day after the latest update, as updates arrive along ``order``; and the counts of all batches."""
    folder = _folder(frames, "windows")
    table = BatchTable(frames.spark, f"{folder}/counts")
    jobs = {
        "closed": lambda gps: to_files(positions.closed_rates(gps, frames.routes, "1 day"), f"{folder}/rates"),
        "all": lambda gps: positions.count_rejects(gps, frames.routes, table),
    }
    for name, job in jobs.items():
        _feed(frames, "events", f"{folder}/{name}", lambda events, job=job: job(Frames._gps(events)), order)
    return frames.spark.read.parquet(f"{folder}/rates"), table


CLOSED = f"SELECT * FROM ({REJECTS}) WHERE window_start + INTERVAL 2 DAY <= (SELECT max(ts) FROM gps_checked)"


@query("gps_stream_closed_rates", CLOSED)
def gps_stream_closed_rates(frames):
    """Updates come in the order of their time; each window is returned once."""
    closed, _ = _closed_rates(frames, F.col("event_id"))
    return plain_time(closed, "window_start")


@query("gps_stream_late_rates", CLOSED)
def gps_stream_late_rates(frames):
    """Updates come in another order: what windows counted in time, and what came late, make up all of them."""
    closed, table = _closed_rates(frames, F.col("value"))
    late = positions.late_rates(table, closed)
    both = closed.unionByName(late).groupBy("window_start", "reason").agg(F.sum("updates").alias("updates"))
    return plain_time(both, "window_start")


KNOWN = "reason = 'ok' AND route_no IN (SELECT route_no FROM routes)"


@query(
    "gps_history",
    f"""SELECT event_id, route_no, ts, floor(y * 1e6 + 0.5) / 1e6 AS lat, floor(x * 1e6 + 0.5) / 1e6 AS lon, CAST(ts AS DATE) AS day
        FROM gps_checked WHERE {KNOWN}""",
)
def gps_history(frames):
    folder = _folder(frames, "history")
    _feed(frames, "events", folder, lambda events: positions.history(Frames._gps(events), frames.routes, f"{folder}/points"))
    return plain_time(frames.spark.read.parquet(f"{folder}/points"))


@query("gps_history_batch", f"SELECT event_id, route_no FROM gps_checked WHERE {KNOWN}")
def gps_history_batch(frames):
    accepted = positions_batch.accepted_positions(frames.gps_updates)
    return accepted.join(frames.routes.select("route_no"), "route_no", "left_semi").select("event_id", "route_no")


@query("bundle_stream_ingest", "SELECT * FROM fhir_patient")
def bundle_stream_ingest(frames):
    """Bundles exported line by line, streamed in and flattened."""
    folder = _folder(frames, "bundles")
    frames.patient_bundles.select("value").write.text(f"{folder}/landing")
    table = BatchTable(frames.spark, f"{folder}/patient")
    arriving = ingest.bundle_stream(frames.spark, f"{folder}/landing", one_per_file=False)
    run_available(ingest.land_resources(arriving, bundles.parse_patients, table, "fhir_patient_id"), f"{folder}/progress")
    return table.read().drop("batch")


@query("bundle_stream_first", "SELECT * FROM fhir_patient")
def bundle_stream_first(frames):
    """Bundles that all arrive twice; keys seen are kept as state."""
    folder = _folder(frames, "first-bundles")
    for _ in range(2):
        frames.patient_bundles.select("value").write.mode("append").text(f"{folder}/landing")
        arriving = ingest.bundle_stream(frames.spark, f"{folder}/landing", one_per_file=False)
        run_available(to_files(ingest.first_resources(arriving, bundles.parse_patients, "fhir_patient_id"), f"{folder}/patient"), f"{folder}/progress")
    return frames.spark.read.parquet(f"{folder}/patient")


@query(
    "upload_stream_dedupe",
    """SELECT sha256(text) AS file_hash, 'success' AS status FROM documents GROUP BY 1""",
)
def upload_stream_dedupe(frames):
    folder = _folder(frames, "uploads")
    catalogue, lineage = (BatchTable(frames.spark, f"{folder}/{name}") for name in ("catalogue", "lineage"))

    def register(documents):
        arriving = Frames(frames.spark, frames.sf_dir)
        arriving.table = lambda name: documents
        return ingest.register_uploads(arriving.uploads, catalogue, lineage)

    _feed(frames, "documents", folder, register)
    steps = lineage.read().select(F.col("bronze_file_id").alias("upload_id"), "status")
    return catalogue.read().join(steps, "upload_id").select("file_hash", "status")


@query("upload_stream_within", "SELECT sha256(text) AS file_hash FROM documents GROUP BY 1")
def upload_stream_within(frames):
    """First uploads by state alone, then those that came too late."""
    folder = _folder(frames, "first-uploads")

    def register(documents):
        arriving = Frames(frames.spark, frames.sf_dir)
        arriving.table = lambda name: documents
        return to_files(ingest.first_uploads(arriving.uploads, "10 days"), f"{folder}/catalogue")

    _feed(frames, "documents", folder, register, F.col("n_chars"))
    catalogue = frames.spark.read.parquet(f"{folder}/catalogue")
    missed = ingest.missed_uploads(frames.uploads, catalogue)
    return catalogue.select("file_hash").union(missed.select("file_hash"))


UPDATES = "(SELECT user_id AS account_number, ts, event_id AS update_id, CAST(value * 12 AS DECIMAL(15,2)) AS balance FROM events)"
MESSAGE = "'Alert: Account ' || account_number || ' balance dropped below $1000. Interest rate may change.' AS message"


def _balances(events):
    return events.select(
        F.col("user_id").alias("account_number"), F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").alias("update_id"),
        (F.col("value") * 12).cast("decimal(15,2)").alias("balance"),
    )


@query("balance_alert_stream", f"SELECT account_number, ts, balance, {MESSAGE} FROM {UPDATES} WHERE balance < 1000")
def balance_alert_stream(frames):
    folder = _folder(frames, "alerts")

    def job(events):
        return to_files(alerts.low_balances(_balances(events)), f"{folder}/alerts")

    _feed(frames, "events", folder, job)
    return plain_time(frames.spark.read.parquet(f"{folder}/alerts"))


@query(
    "balance_crossing_stream",
    f"""SELECT account_number, ts, update_id, balance, {MESSAGE} FROM
        (SELECT *, lag(balance) OVER (PARTITION BY account_number ORDER BY ts, update_id) AS before FROM {UPDATES})
        WHERE balance < 1000 AND (before IS NULL OR before >= 1000)""",
)
def balance_crossing_stream(frames):
    """Updates in the order of their time: none is late."""
    folder = _folder(frames, "crossings")
    job = lambda events: to_files(alerts.crossings(_balances(events)), f"{folder}/found", "kind")
    _feed(frames, "events", folder, job, F.col("ts").cast("timestamp"))
    return plain_time(frames.spark.read.parquet(f"{folder}/found").where("kind = 'crossing'").drop("kind"))


@query("gaze_stream", f"SELECT frame_id, {DECISION} AS action FROM gaze_counts")
def gaze_stream(frames):
    folder = _folder(frames, "gaze")

    def job(embeddings):
        images = embeddings.select(
            F.col("vec_id").alias("frame_id"),
            F.transform("embedding", lambda v: F.lit(75.0) + v.cast("double") * F.lit(200.0)).alias("pixels"),
        )
        actions = gaze.decisions(images, "pixels", 8, 8).select("frame_id", "action")
        return to_files(actions, f"{folder}/actions")

    _feed(frames, "embeddings", folder, job)
    return frames.spark.read.parquet(f"{folder}/actions")


@query(
    "blink_halt_stream",
    """SELECT stream, min(frame) + 4 AS halt_frame
       FROM (SELECT event_id % 5 AS stream, event_id // 5 AS frame, event_id // 5 - row_number() OVER (PARTITION BY event_id % 5 ORDER BY event_id) AS g
             FROM events WHERE value > 40) GROUP BY stream, g HAVING count(*) >= 5""",
)
def blink_halt_stream(frames):
    folder = _folder(frames, "halts")

    def job(events):
        eyes = events.select(
            (F.col("event_id") % 5).alias("stream"), F.floor(F.col("event_id") / 5).alias("frame"),
            F.when(F.col("value") > 40, 0).otherwise(10).alias("dark"),
        )
        return to_files(gaze.halts(eyes), f"{folder}/halts")

    _feed(frames, "events", folder, job)
    return frames.spark.read.parquet(f"{folder}/halts").where("halt_frame is not null").select("stream", "halt_frame")
