"""Where the query modules enter their queries and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bindings import Frames
from .oracle_frames import with_frames

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``function(frames)`` under ``name``, with its SQL if there is one."""

    def enter(function: Callable[[Frames], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: function(Frames(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = with_frames(sql)
        return function

    return enter
