"""Session defaults, shared scratch space and tables of a checked size."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SMALL_SIDE_ROWS = 10_000

_local_scratch: dict[str, str] = {}


def build_session(app_name: str = "labelkit", master: str | None = None) -> SparkSession:
    """A session with AQE, UTC and Arrow on; everything else stays with the cluster."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir``, shared by all executors.

    A machine-local folder is only acceptable when the executors live in this
    very process, so without the setting this works in local mode alone, and not
    on ``local-cluster``, whose executors are other processes.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    context = spark.sparkContext
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _local_scratch:
        _local_scratch[context.applicationId] = tempfile.mkdtemp(prefix="labelkit-")
    return _local_scratch[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    return os.path.join(scratch_root(spark), f"{name}-{uuid.uuid4().hex}")


def stage_table(df: DataFrame, name: str, session: SparkSession | None = None) -> DataFrame:
    """Write ``df`` to the shared scratch folder and continue from the written table.

    Used where two branches of a plan must see the very same physical rows (range
    boundaries come from a sample, so they may not be derived twice).  The table
    survives the loss of any executor.  ``session`` reads it, by default that of ``df``.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return (session or df.sparkSession).read.schema(df.schema).parquet(path)


def counting_table(df: DataFrame, name: str) -> DataFrame:
    """A staged table to take small statistics from, in a session whose actions are one job each.

    Adaptive execution runs every exchange as a job of its own.  That pays for plans whose
    sizes are not known; counts per bucket of a narrow table have a fixed size.
    """
    session = df.sparkSession.newSession()
    session.conf.set("spark.sql.adaptive.enabled", "false")
    return stage_table(df, name, session)


def sized_table(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """A staged table with its row count, to decide whether it may be broadcast.

    For aggregates that are usually small but have no proven bound, such as the labels of
    a table; callers must have a shuffle-based way beyond ``SMALL_SIDE_ROWS``.
    """
    table = stage_table(df, name)
    return table, table.count()
