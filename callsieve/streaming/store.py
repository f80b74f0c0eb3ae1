"""The blacklist as versions: an append-only log of entries, snapshots of it, and a table of pointers.

    <folder>/delta/batch=N       entries of micro-batch N, never changed once committed
    <folder>/latency/batch=N     latency sketches of micro-batch N
    <folder>/snapshot/<name>     latest entry per number at some time
    <folder>/version/version=K   one row: the snapshot, the last batch in it, and the epoch

A reader looks up the newest version once and then reads files that nobody changes: its snapshot and the batches after it. A compaction writes a new snapshot
beside the old one and becomes visible with its version row only, which is one file and committed as a whole. A reset opens an epoch: a version with
an empty snapshot through all batches so far, and a new checkpoint folder, so that numbers can be listed again.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ENTRY = ("phone_number string, probability double, calls_observed long, event_id string, blacklisted_at double, produced_at double, ts_us long")
LATENCY = "events long, entries long, processing binary, end_to_end binary, produced long"
VERSION = "snapshot string, through_batch long, epoch long"
#: Batch numbers begin anew with each epoch's checkpoint; epochs are kept apart by this many.
EPOCH_BATCHES = 10 ** 12


class BlacklistStore:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _read(self, name: str, schema: str, number: str) -> DataFrame:
        """A table of numbered folders; empty where nothing has been written yet."""
        try:
            return self.spark.read.schema(f"{schema}, {number} long").parquet(f"{self.folder}/{name}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], f"{schema}, {number} long")

    def newest(self) -> tuple[int, str | None, int, int]:
        """(version, snapshot folder or None, last batch in it, epoch); before any version, version -1 of epoch 0."""
        row = self._read("version", VERSION, "version").orderBy(F.desc("version")).limit(1).collect()
        return (row[0]["version"], row[0]["snapshot"], row[0]["through_batch"], row[0]["epoch"]) if row else (-1, None, -1, 0)

    def _publish(self, version: int, snapshot: str | None, through: int, epoch: int) -> int:
        row = self.spark.createDataFrame([(snapshot, through, epoch)], VERSION).coalesce(1)
        # Fails if another writer has published this version: its work then stands, and the caller starts again.
        row.write.mode("errorifexists").parquet(f"{self.folder}/version/version={version}")
        return version

    def delta(self, batch: int) -> str:
        return f"{self.folder}/delta/batch={self.newest()[3] * EPOCH_BATCHES + batch}"

    def latency(self, batch: int) -> str:
        return f"{self.folder}/latency/batch={self.newest()[3] * EPOCH_BATCHES + batch}"

    def checkpoint(self) -> str:
        return f"{self.folder}/checkpoint/epoch-{self.newest()[3]}"

    def history(self) -> DataFrame:
        """All entries ever written."""
        return self._read("delta", ENTRY, "batch")

    def latencies(self) -> DataFrame:
        return self._read("latency", LATENCY, "batch")

    def _latest(self, entries: DataFrame) -> DataFrame:
        rest = [c for c in entries.columns if c != "phone_number"]
        return entries.groupBy("phone_number").agg(F.max_by(F.struct(*rest), F.struct("ts_us", "event_id", "batch")).alias("e")).select("phone_number", "e.*")

    def _at(self, version: tuple[int, str | None, int, int], through: int | None = None) -> DataFrame:
        _, snapshot, after, _ = version
        entries = self.history().filter(F.col("batch") > after)
        if through is not None:
            entries = entries.filter(F.col("batch") <= through)
        if snapshot is not None:
            entries = entries.unionByName(self.spark.read.schema(f"{ENTRY}, batch long").parquet(f"{self.folder}/snapshot/{snapshot}"))
        return self._latest(entries)

    def current(self) -> DataFrame:
        """The latest entry of every listed number: the newest snapshot with what was written after it."""
        return self._at(self.newest())

    def compact(self) -> int:
        """Write a snapshot of the current state and publish it; the number of the new version."""
        version = self.newest()
        through = self.history().agg(F.max("batch")).first()[0]
        through = max(version[2], -1 if through is None else through)
        name = uuid.uuid4().hex
        self._at(version, through).write.parquet(f"{self.folder}/snapshot/{name}")
        return self._publish(version[0] + 1, name, through, version[3])

    def reset(self) -> int:
        """Open a new epoch with an empty blacklist. The log stays; the next stream run has a checkpoint of its own."""
        version, _, _, epoch = self.newest()
        return self._publish(version + 1, None, (epoch + 1) * EPOCH_BATCHES - 1, epoch + 1)
