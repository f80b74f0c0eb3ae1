"""Session settings and lineage cutting."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def local_session(cores: str = "8", name: str = "callsieve") -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in RUNTIME.items():
        builder = builder.config(key, value)
    return (
        builder.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CALLSIEVE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.python.unix.domain.socket.enabled", "true")
        .getOrCreate()
    )


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings that results depend on."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names. Only a local session may do without the setting; it then gets a folder of its own."""
    context = spark.sparkContext
    named = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="callsieve-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for files of one run, in the shared folder; left to the cluster's clean-up of it, as checkpoints are."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the :func:`shared_folder`."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
