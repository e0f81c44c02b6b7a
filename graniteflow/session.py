"""Session construction and the one place that decides where lineage is cut."""

from __future__ import annotations

import os
import re
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings the engine is tuned for; a cluster supplies its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("graniteflow")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def visible_to_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it, whatever folder the driver was started in."""
    root, env = str(Path(__file__).resolve().parents[1]), spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH")) if x)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by spark.checkpoint.dir; a private one is made only on a local master with none set.

    A folder of one machine would lose its files with that machine, so a cluster without a named folder is an error.
    """
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="graniteflow-"))


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the checkpoint folder so that lost executors never replay what led to it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def broadcast_if_small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """The table, marked for a broadcast if a count says that it has few rows; as it is otherwise, for the planner to decide."""
    return F.broadcast(df) if df.count() <= rows else df
