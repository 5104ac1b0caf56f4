"""Vehicle positions: routes, checks, last known place, refusals."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.geo import Fence, gps_normalise, gps_reason

POINT = ("", "_lat", "_long")


def initial_state(routes: DataFrame) -> DataFrame:
    """A new route stands at its source."""
    return routes.withColumns({f"current_location{part}": F.col(f"source{part}") for part in POINT})


def route_lookup(routes: DataFrame, route_no: int, driver: str | None = None) -> DataFrame:
    wanted = routes.where(F.col("route_no") == route_no)
    return wanted if driver is None else wanted.where(F.col("driver_name") == driver)


def duplicate_routes(routes: DataFrame) -> DataFrame:
    """Route numbers a lookup cannot answer, since several routes carry them."""
    return routes.groupBy("route_no").agg(F.count(F.lit(1)).alias("routes")).where(F.col("routes") > 1)


def with_reason(updates: DataFrame, fence: Fence | None = None) -> DataFrame:
    return updates.withColumn("reason", gps_reason(F.col("lat"), F.col("lon"), fence))


def accepted_positions(updates: DataFrame, fence: Fence | None = None) -> DataFrame:
    checked = with_reason(updates, fence).where(F.col("reason") == "ok").drop("reason")
    return checked.withColumns({"lat": gps_normalise(F.col("lat")), "lon": gps_normalise(F.col("lon"))})


def latest_positions(updates: DataFrame, routes: DataFrame, fence: Fence | None = None) -> DataFrame:
    """The newest valid position per known route; a later arrival never beats a newer time."""
    newest = (
        accepted_positions(updates, fence)
        .groupBy("route_no")
        .agg(F.max_by(F.struct("ts", "event_id", "lat", "lon"), F.struct("ts", "event_id")).alias("p"))
    )
    return routes.select("route_no").join(newest, "route_no").select("route_no", "p.*")


def reject_rates(updates: DataFrame, routes: DataFrame | None = None, window: str = "1 day") -> DataFrame:
    """Updates per time window and reason; with ``routes`` an unknown route is a reason too."""
    checked = with_reason(updates)
    if routes is not None:
        known = routes.select("route_no").distinct().withColumn("_known", F.lit(True))
        unknown = (F.col("reason") == "ok") & F.col("_known").isNull()
        checked = checked.join(known, "route_no", "left").withColumn(
            "reason", F.when(unknown, "unknown_route").otherwise(F.col("reason"))
        )
    return checked.groupBy(F.window("ts", window).alias("w"), "reason").agg(F.count(F.lit(1)).alias("updates")).select(
        F.col("w.start").alias("window_start"), "reason", "updates"
    )
