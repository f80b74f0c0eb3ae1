"""Shared helpers: table reading, scratch tables in the shared folder, and text rules all operators agree on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the text rules, as a regular-expression class body (Java and Python).
SPACE = r"\x20\x09-\x0D"
#: ASCII capitals and their small letters; other letters keep their case.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; only a local session without it gets a folder of its own."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="callsieve-shared-")
        context.setCheckpointDir(named)
    return named


def small_batches(df: DataFrame, most_bytes: int = 8_000_000) -> DataFrame:
    """``df``, with the session's Arrow batches kept to ``most_bytes``: batches of long texts would else fill a Python worker's memory."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most_bytes))
    return df


def written(df: DataFrame, parted_by: str | None = None) -> DataFrame:
    """``df`` as a table in the shared folder, so that neither lost executors nor reuse compute it again.

    Like checkpoints, these tables are left to the cluster's clean-up of that folder.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"
    df.write.parquet(path, partitionBy=parted_by)
    return spark.read.schema(df.schema).parquet(path)


def n_words(text: Column) -> Column:
    """Number of words (runs without white space); 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def pieces_of(total: int, each: int, least: int = 1) -> int:
    """How many pieces of about ``each`` rows make up ``total`` rows."""
    return max(least, -(-total // each))
