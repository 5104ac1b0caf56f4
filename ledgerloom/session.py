"""Session set-up and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "ledgerloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on (UTC, ANSI, AQE).

    Cluster sizing (executors, memory, shuffle partitions) stays with the caller.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name below the cluster's shared checkpoint folder.

    ``spark.checkpoint.dir`` names the folder all executors can reach. Only a local
    session may do without it; it then gets one of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="ledgerloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def set_for(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting of the session for the jobs inside."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shuffles_freed(spark: SparkSession) -> AbstractContextManager[None]:
    """Shuffle files of the jobs inside go when their job ends, not when the driver happens to collect garbage."""
    return set_for(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


TASK_ROWS = 100_000
"""Narrow rows that a task of a step writes at least, if their number is known before."""


def settled(df: DataFrame, most: int | None = None) -> DataFrame:
    """``df`` computed once, written to the shared folder and read back.

    For operators whose later steps use a costly frame several times. The files outlive
    lost executors, and readers see real sizes and only the columns they ask for.
    Of a frame known to have ``most`` narrow rows at most, no more tasks write than these ask
    for: many tiny files cost more than their rows.
    """
    spark = df.sparkSession
    if most is not None:
        df = df.coalesce(max(1, -(-most // TASK_ROWS)))
    path = shared_dir(spark, "step")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
