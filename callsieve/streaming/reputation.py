"""Streaming reputation: burst limit, geo flag, Beta counts and report weight per reporter.

Reports and validations come in one stream keyed by reporter. Within a batch a reporter's rows are taken
in (t, seq) order; sources must deliver them in that order from batch to batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import scoring
from ..operators.burst import BURST_LIMIT, GAP_SECONDS
from ..operators.reputation import PRIOR

STATE = "right long, wrong long, burst long, last_t double, geo_flag boolean"
OUTPUT = ("seq long, user_id long, phone_number string, scam_category string, t double, accepted boolean, burst_count long,"
          " geo_flag boolean, alpha double, beta double, total_reports long")
COLUMNS = [c.split()[0] for c in OUTPUT.split(", ")]


def mixed_stream(reports: DataFrame, validations: DataFrame) -> DataFrame:
    """One stream of both kinds; the geo test is made here, natively."""
    odd = ~scoring.geo_consistent(F.col("registered_country"), F.col("report_country"))
    told = reports.select(F.col("report_seq").alias("seq"), "user_id", "t", "phone_number", "scam_category",
                          odd.alias("odd_country"), F.lit(None).cast("boolean").alias("was_correct"))
    judged = validations.select("seq", "user_id", "t", F.lit(None).cast("string").alias("phone_number"),
                                F.lit(None).cast("string").alias("scam_category"), F.lit(False).alias("odd_country"), "was_correct")
    return told.unionByName(judged)


class ReporterState(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("reporter", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timer_values) -> Iterator[pd.DataFrame]:
        right, wrong, burst, last, geo = self.state.get() if self.state.exists() else (0, 0, 0, None, False)
        if last is not None and last < 0:
            last = None
        out = []
        for r in pd.concat(list(rows)).sort_values(["t", "seq"]).itertuples():
            if r.phone_number is None or r.phone_number != r.phone_number:
                right, wrong = (right + 1, wrong) if r.was_correct else (right, wrong + 1)
                continue
            if last is None or r.t - last > GAP_SECONDS:
                burst = 0
            accepted = burst < BURST_LIMIT
            if accepted:
                burst, last, geo = burst + 1, float(r.t), bool(geo or r.odd_country)
            out.append((int(r.seq), int(key[0]), r.phone_number, r.scam_category, float(r.t), accepted, burst, geo,
                        PRIOR + right, PRIOR + wrong, right + wrong))
        self.state.update((right, wrong, burst, -1.0 if last is None else last, geo))
        yield pd.DataFrame(out, columns=COLUMNS)

    def close(self) -> None:
        pass


def report_stream(mixed: DataFrame) -> DataFrame:
    """Every report with its acceptance, reputation and weight at that moment."""
    states = mixed.groupBy("user_id").transformWithStateInPandas(
        statefulProcessor=ReporterState(), outputStructType=OUTPUT, outputMode="Append", timeMode="None")
    score = scoring.reputation(F.col("alpha"), F.col("beta"), F.col("total_reports"), F.col("burst_count"), F.col("geo_flag"))
    return states.withColumn("reputation", F.when(F.col("accepted"), score)).withColumn(
        "user_weight", F.when(F.col("accepted"), scoring.report_weight(F.round("reputation", 9))))
