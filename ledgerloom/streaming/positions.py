"""Vehicle positions as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.geo import Fence
from ..operators.merge import BatchTable
from ..plans.telemetry import accepted_positions, latest_positions, reject_rates
from .jobs import each_batch


def keep_latest(updates: DataFrame, routes: DataFrame, table: BatchTable, fence: Fence | None = None) -> DataStreamWriter:
    """Write the newest valid position per known route of each batch; ``current`` reads the newest of all."""

    def add(batch: DataFrame, number: int) -> None:
        table.write(latest_positions(batch, routes, fence), number)

    return each_batch(updates, add)


def _newest(rows: DataFrame) -> DataFrame:
    newest = F.max_by(F.struct("ts", "event_id", "lat", "lon", "batch"), F.struct("ts", "event_id"))
    return rows.groupBy("route_no").agg(newest.alias("p")).select("route_no", "p.*")


def current(table: BatchTable) -> DataFrame:
    """The newest position per route over all batches; late and repeated batches change nothing."""
    return _newest(table.read()).drop("batch")


def compact_latest(table: BatchTable, upto: int) -> None:
    """Keep one row per route of the batches up to a number."""
    table.compact(upto, _newest)


def count_rejects(updates: DataFrame, routes: DataFrame, table: BatchTable, window: str = "1 day") -> DataStreamWriter:
    """Write the counts per window and reason of each batch; ``rates`` adds them up, late updates included."""

    def add(batch: DataFrame, number: int) -> None:
        table.write(reject_rates(batch, routes, window), number)

    return each_batch(updates, add)


def rates(table: BatchTable) -> DataFrame:
    """Updates per window and reason over all batches, the open window included."""
    return table.read().groupBy("window_start", "reason").agg(F.sum("updates").alias("updates"))


def closed_rates(updates: DataFrame, routes: DataFrame, delay: str, window: str = "1 day") -> DataFrame:
    """Counts per window and reason, each returned once: when the latest update seen is ``delay`` past the window's end.

    The state store holds the open windows only. Updates that come after their window was closed
    are in no count; ``late_rates`` tells how many they are.
    """
    return reject_rates(updates.withWatermark("ts", delay), routes, window)


def late_rates(table: BatchTable, closed: DataFrame) -> DataFrame:
    """Updates per closed window and reason that ``closed_rates`` did not count, from the counts of all batches."""
    counted = closed.select("window_start", "reason", F.col("updates").alias("_counted"))
    windows = closed.select("window_start").distinct()
    every = rates(table).join(windows, "window_start").join(counted, ["window_start", "reason"], "left")
    late = F.col("updates") - F.coalesce("_counted", F.lit(0))
    return every.select("window_start", "reason", late.alias("updates")).where("updates > 0")


def history(updates: DataFrame, routes: DataFrame, path: str, fence: Fence | None = None) -> DataStreamWriter:
    """Append every accepted point of a known route, in folders by day."""
    points = accepted_positions(updates, fence).join(routes.select("route_no"), "route_no", "left_semi").withColumn("day", F.to_date("ts"))
    return points.writeStream.outputMode("append").format("parquet").partitionBy("day").option("path", path)
