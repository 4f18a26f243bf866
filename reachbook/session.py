"""Session settings: broadcasts by measured size, and a local session.

The package relies on adaptive execution, on by default, for picking join
methods, coalescing partitions and splitting skewed join partitions.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

MEASURED_BROADCASTS = {
    # No broadcast on an estimate: the planner does not know how far an exploded
    # or joined table grows.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    # The date bounds are literals already; pruning by a join's other side would
    # only copy that side's plan, twice as much text per join.
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "false",
    # A side that has been shuffled is broadcast if it measured no more than this.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
}


def measure_broadcasts(spark: SparkSession) -> SparkSession:
    """Broadcast a join side only once its size has been measured at run time."""
    for name, value in MEASURED_BROADCASTS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cpus: str | int | None = None, **options: str) -> SparkSession:
    """A session for tests, checks and the benchmark; on a cluster use your own."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        **options,
    }
    builder = SparkSession.builder.master(f"local[{cpus or os.cpu_count()}]").appName("reachbook")
    for name, value in settings.items():
        builder = builder.config(name, value)
    return measure_broadcasts(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder that the session names, which driver and executors
    share. A session on one machine that names none gets one of its own; on a
    cluster that is an error, as a local folder would not be found elsewhere."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not context.master.split("[")[0] == "local":
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            folder = tempfile.mkdtemp(prefix="checkpoints-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()
