"""Vehicle positions and eye control."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions.geo import Fence, gps_normalise, gps_reason
from ledgerloom.operators import blinks, matrices
from ledgerloom.plans import telemetry

from .registry import query

SIX_PLACES = "floor({0} * 1e6 + 0.5) / 1e6"
LATEST = f"""
    SELECT route_no, ts, event_id, {SIX_PLACES.format('y')} AS lat, {SIX_PLACES.format('x')} AS lon
    FROM gps_checked WHERE reason = 'ok' AND route_no IN (SELECT route_no FROM routes)
    QUALIFY row_number() OVER (PARTITION BY route_no ORDER BY ts DESC, event_id DESC) = 1"""
REJECTS = """
    SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, CASE WHEN reason = 'ok' AND route_no NOT IN (SELECT route_no FROM routes)
           THEN 'unknown_route' ELSE reason END AS reason, count(*) AS updates FROM gps_checked GROUP BY 1, 2"""
ROUTE_COLUMNS = "route_no, driver_name, source, source_lat, source_long, destination"


def plain_time(df, column="ts"):
    return df.withColumn(column, F.col(column).cast("timestamp_ntz"))


@query(
    "route_initial_state",
    f"""SELECT {ROUTE_COLUMNS}, source AS current_location, source_lat AS current_location_lat, source_long AS current_location_long FROM routes""",
)
def route_initial_state(frames):
    return telemetry.initial_state(frames.routes)


@query("route_lookup", f"SELECT {ROUTE_COLUMNS} FROM routes WHERE route_no = 8 AND driver_name = 'Driver 1'")
def route_lookup(frames):
    return telemetry.route_lookup(frames.routes, 8, "Driver 1")


@query("route_duplicates", "SELECT route_no % 7 AS route_no, count(*) AS routes FROM routes GROUP BY 1 HAVING count(*) > 1")
def route_duplicates(frames):
    """Routes renumbered by driver, so that several share a number."""
    return telemetry.duplicate_routes(frames.routes.withColumn("route_no", F.col("route_no") % 7))


@query("gps_validate", "SELECT event_id, reason FROM gps_checked")
def gps_validate(frames):
    return telemetry.with_reason(frames.gps_updates).select("event_id", "reason")


@query(
    "gps_validate_fence",
    """SELECT event_id, CASE WHEN reason = 'ok' AND NOT (y BETWEEN -89 AND 40 AND x BETWEEN -170 AND 10) THEN 'outside_fence' ELSE reason END AS reason
       FROM gps_checked""",
)
def gps_validate_fence(frames):
    fence = Fence(south=-89, north=40, west=-170, east=10)
    return frames.gps_updates.select("event_id", gps_reason(F.col("lat"), F.col("lon"), fence).alias("reason"))


@query(
    "gps_normalise",
    f"SELECT event_id, {SIX_PLACES.format('CAST(value AS DOUBLE) / 7')} AS up, {SIX_PLACES.format('(-CAST(value AS DOUBLE) / 7)')} AS down FROM events",
)
def gps_normalise_both(frames):
    seventh = F.col("value") / 7
    return frames.table("events").select(
        "event_id", gps_normalise(seventh.cast("string")).alias("up"), gps_normalise((-seventh).cast("string")).alias("down")
    )


@query("gps_latest", LATEST)
def gps_latest(frames):
    return plain_time(telemetry.latest_positions(frames.gps_updates, frames.routes))


@query("gps_reject_rates", REJECTS)
def gps_reject_rates(frames):
    return plain_time(telemetry.reject_rates(frames.gps_updates, frames.routes), "window_start")


@query("gaze_zone_counts", "SELECT * FROM gaze_counts")
def gaze_zone_counts(frames):
    return matrices.gaze_zone_counts(frames.eye_pixels, ["frame_id"], "i", "j", 8, 8, "intensity")


DECISION = """
    CASE WHEN dark_right > dark_left AND dark_right > dark_centre THEN 'right'
         WHEN dark_centre > dark_left AND dark_centre > dark_right THEN
              CASE WHEN dark_top > dark_middle AND dark_top > dark_bottom THEN 'front'
                   WHEN dark_middle > dark_top AND dark_middle > dark_bottom THEN 'stop'
                   WHEN dark_bottom > dark_top AND dark_bottom > dark_middle THEN 'back' END
         WHEN dark_left > dark_centre AND dark_left > dark_right THEN 'left' END"""


@query("gaze_decision", f"SELECT frame_id, {DECISION} AS action FROM gaze_counts")
def gaze_decision(frames):
    return matrices.with_decision(gaze_zone_counts(frames)).select("frame_id", "action")


@query(
    "blink_halt",
    "SELECT stream, first_position, last_position, run_length, first_position + 4 AS halt_frame FROM blink_runs WHERE run_length >= 5",
)
def blink_halt(frames):
    return blinks.blink_halts(frames.blink_frames, ["stream"], "frame", "dark", width=500)


BLINK_SEQUENCES = """
    WITH RECURSIVE r AS (SELECT *, row_number() OVER (PARTITION BY stream ORDER BY first_position) AS n FROM blink_runs),
    walk AS (SELECT stream, n, last_position, CASE WHEN run_length < 5 THEN 1 ELSE 0 END AS in_row, false AS switched FROM r WHERE n = 1
             UNION ALL
             SELECT r.stream, r.n, r.last_position,
                    CASE WHEN r.run_length >= 5 THEN 0 WHEN r.first_position - w.last_position > 10 THEN 1 ELSE w.in_row + 1 END,
                    r.run_length < 5 AND r.first_position - w.last_position <= 10 AND (w.in_row + 1) % 4 = 0
             FROM walk w JOIN r ON r.stream = w.stream AND r.n = w.n + 1)
    SELECT stream, last_position AS frame,
           CASE WHEN row_number() OVER (PARTITION BY stream ORDER BY last_position) % 2 = 1 THEN 'OFF' ELSE 'ON' END AS state
    FROM walk WHERE switched"""


@query("blink_toggle", BLINK_SEQUENCES)
def blink_toggle(frames):
    return blinks.blink_toggles(frames.blink_frames, ["stream"], "frame", "dark", width=500)
