"""Reports on streams: reporter state, then number state, to the decision on each report.

The first operator folds a reporter's reports and validations in order (burst limit, geo flag, Beta counts), the second a number's accepted reports (count,
sum of weights, weight per category). Both wait for the watermark, so the order of arrival does not matter within its delay. Reports of unknown
reporters get their row and touch no state.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions import scoring
from ..operators.burst import BURST_LIMIT, GAP_SECONDS
from ..operators.reputation import PRIOR, consensus_decision
from .ordered import InOrder, dated, in_order
from .reputation import COLUMNS, OUTPUT, mixed_stream

JUDGED = ("seq long, user_id long, phone_number string, t double, accepted boolean, burst_count long, geo_flag boolean, reputation double,"
          " user_weight double, number_reports long, weighted_score double, dominant_category string")


class OrderedReporter(InOrder):
    """The reporter's state before each of its reports; ``repeat`` keeps reports and validations of one number apart."""

    unique = "repeat"
    order = ["ts_us", "seq"]

    def open_state(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("reporter", "right long, wrong long, burst long, last_t double, geo_flag boolean")

    def fold(self, key, rows: pd.DataFrame) -> pd.DataFrame:
        right, wrong, burst, last, geo = self.state.get() if self.state.exists() else (0, 0, 0, None, False)
        judged = rows["was_correct"].notna().to_numpy()
        correct = (rows["was_correct"] == True).to_numpy()  # noqa: E712
        rights, wrongs = right + (judged & correct).cumsum(), wrong + (judged & ~correct).cumsum()
        t, odd = rows["t"].to_numpy(dtype=float), rows["odd_country"].to_numpy(dtype=bool)
        told = np.flatnonzero(~judged)
        accepted, bursts, geos = np.zeros(len(told), bool), np.zeros(len(told), np.int64), np.zeros(len(told), bool)
        for n, i in enumerate(told):  # the burst rule depends on the last accepted report
            if last is None or t[i] - last > GAP_SECONDS:
                burst = 0
            if burst < BURST_LIMIT:
                accepted[n], burst, last, geo = True, burst + 1, float(t[i]), bool(geo or odd[i])
            bursts[n], geos[n] = burst, geo
        self.state.update((int(rights[-1]), int(wrongs[-1]), int(burst), last, bool(geo)))
        out = rows.iloc[told].assign(user_id=key[0], accepted=accepted, burst_count=bursts, geo_flag=geos, alpha=PRIOR + rights[told],
                                     beta=PRIOR + wrongs[told], total_reports=rights[told] + wrongs[told])
        return out[COLUMNS]

    def forget(self, key, newest_us: int) -> None:
        self.state.clear()


class NumberConsensus(StatefulProcessor):
    """Count, mean weight and heaviest category of a number after each accepted report.

    The reporters of one batch are released to the same watermark, so reports ordered inside a batch are ordered overall.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.sums = handle.getValueState("sums", "n long, weight double")
        self.categories = handle.getMapState("categories", "category string", "weight double, first long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = pd.concat(list(rows), ignore_index=True)
        taken = held[held["accepted"]].sort_values(["t", "seq"], ignore_index=True)
        if len(taken):
            n, weight = self.sums.get() if self.sums.exists() else (0, 0.0)
            counts, sums = n + np.arange(1, len(taken) + 1), weight + taken["user_weight"].to_numpy(dtype=float).cumsum()
            self.sums.update((int(counts[-1]), float(sums[-1])))
            known = {k[0]: list(v) for k, v in self.categories.iterator()}
            names = taken["scam_category"].fillna("")
            best: list[str | None] = []
            for name, own, seq in zip(names, taken["user_weight"], taken["seq"]):
                entry = known.setdefault(name, [0.0, int(seq)])
                entry[0], entry[1] = entry[0] + float(own), min(entry[1], int(seq))
                best.append(max(known, key=lambda c: (round(known[c][0], 9), -known[c][1])) or None)
            for name in names.unique():
                self.categories.updateValue((name,), tuple(known[name]))
            taken = taken.assign(number_reports=counts, weighted_score=np.minimum(1.0, np.round(sums / counts, 9)), dominant_category=best)
        other = held[~held["accepted"]].assign(number_reports=None, weighted_score=None, dominant_category=None)
        names = [c.split()[0] for c in JUDGED.split(", ")]
        for part in (taken, other):
            if len(part):
                yield part.assign(phone_number=key[0])[names]

    def close(self) -> None:
        pass


def decision_stream(reports: DataFrame, validations: DataFrame, reporters: DataFrame, delay: str = "10 minutes", idle_s: float | None = None) -> DataFrame:
    """The rows of the batch operator ``report_decisions``, from streams of reports and validations and a table of reporters.

    Needs ``t`` (seconds) as in the batch operator. Rows later than ``delay`` are dropped by the watermark, repeated numbers count once, rows without a time are
    left out.
    """
    known = reporters.select("user_id").distinct().withColumn("known", F.lit(True))
    mixed = mixed_stream(reports, validations).join(known, "user_id", "left")
    seen = mixed.filter("known").withColumn("ts", F.timestamp_micros((F.col("t") * 1_000_000).cast("long"))).withColumn(
        "repeat", F.concat(F.when(F.col("was_correct").isNull(), "r").otherwise("v"), F.col("seq"))).drop("known")
    states = in_order(dated(seen, delay), "user_id", OrderedReporter(idle_s), OUTPUT)
    score = scoring.reputation(F.col("alpha"), F.col("beta"), F.col("total_reports"), F.col("burst_count"), F.col("geo_flag"))
    weighed = states.withColumn("reputation", F.when(F.col("accepted"), score)).withColumn(
        "user_weight", F.when(F.col("accepted"), scoring.report_weight(F.round("reputation", 9))))
    judged = weighed.select("seq", "user_id", "phone_number", "scam_category", "t", "accepted", "burst_count", "geo_flag", "reputation", "user_weight").groupBy(
        "phone_number").transformWithStateInPandas(statefulProcessor=NumberConsensus(), outputStructType=JUDGED, outputMode="Append", timeMode="None")
    if_accepted = lambda c: F.when(F.col("accepted"), F.col(c)).alias(c)
    decided = judged.select(
        F.col("seq").alias("report_seq"), "user_id", "phone_number", F.when(F.col("accepted"), "accepted").otherwise("throttled").alias("status"),
        if_accepted("burst_count"), if_accepted("geo_flag"), "reputation", "user_weight", "weighted_score", "number_reports", "dominant_category",
        F.when(F.col("accepted"), consensus_decision(F.col("weighted_score"), F.col("number_reports"))).alias("decision"))
    lost = mixed.filter("known is null and was_correct is null").select(
        F.col("seq").alias("report_seq"), "user_id", "phone_number", F.lit("error").alias("status"),
        *[F.lit(None).cast(dict(decided.dtypes)[c]).alias(c) for c in decided.columns[4:]])
    return decided.unionByName(lost)
