"""Report sessions and the burst limit per reporter.

Rule: a reporter's counter returns to 0 when more than ``gap`` seconds have passed since the last
*accepted* report; with the counter at ``limit`` a report is throttled and changes nothing.

Read literally this is a fold over all reports of a reporter in one task. It need not be. A gap of more
than ``gap`` between consecutive reports always resets the counter, so sessions are independent, and a
session of at most ``limit`` reports is accepted whole. In a longer session the accepted reports come in
batches of ``limit`` consecutive ones: the batch that starts at position i is followed by the batch that
starts at the first report later than ``t[i + limit - 1] + gap``. This successor is computed for all
positions at once, and the batches that really occur are those reachable from position 1. Doubling the
successor links finds them in log2(batches) joins, whatever the length of the session.

Positions are counted over sampled ranges of (reporter, time), so that a reporter's reports spread over as many tasks as
their number calls for, also if all lie within a few seconds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .prefix import numbered, ranged, running

GAP_SECONDS, BURST_LIMIT = 300.0, 10


def slot_of(t: str, gap: float):
    return F.floor(F.col(t) / gap)


def slot_sessions(reports: DataFrame, gap: float = GAP_SECONDS) -> DataFrame:
    """Session number of each (user, slot of ``gap`` seconds).

    Reports in one slot always share a session, so the window runs over the slots of a user, whose
    number is bounded by the time span, and not over the reports.
    """
    slots = reports.groupBy("user_id", slot_of("t", gap).alias("slot")).agg(
        F.min("t").alias("first_t"), F.max("t").alias("last_t"), F.count("*").alias("n"))
    by_time = Window.partitionBy("user_id").orderBy("slot")
    starts = F.coalesce((F.col("first_t") - F.lag("last_t").over(by_time) > gap).cast("int"), F.lit(1))
    return slots.withColumn("starts", starts).withColumn("session", F.sum("starts").over(by_time)).drop("starts")


def report_sessions(reports: DataFrame, gap: float = GAP_SECONDS) -> DataFrame:
    return slot_sessions(reports, gap).groupBy("user_id", "session").agg(
        F.min("first_t").alias("session_start"), F.max("last_t").alias("session_end"), F.sum("n").alias("reports"))


def batch_starts(rows: DataFrame, gap: float, limit: int, ranges: int | None = None) -> DataFrame:
    """Positions at which an accepted batch starts. ``rows``: user_id, session, pos, t of long sessions."""
    keys = ["user_id", "session"]
    last = rows.select(*keys, (F.col("pos") - (limit - 1)).alias("pos"), (F.col("t") + gap).alias("until"))
    asked = rows.select(*keys, "pos").join(last, [*keys, "pos"])
    # How many reports are not later than ``until``: a running count with the questions mixed in.
    mixed = (rows.select(*keys, "t", F.lit(1).alias("is_report"), "pos")
             .unionByName(asked.select(*keys, F.col("until").alias("t"), F.lit(0).alias("is_report"), "pos")))
    by_time = [F.col("t"), F.desc("is_report"), F.col("pos")]
    mixed = ranged(mixed, [*map(F.col, keys), *by_time], "range", ranges)
    counted = running(mixed, keys, by_time, F.col("range"), sums={"seen": F.col("is_report")})
    sizes = rows.groupBy(*keys).agg(F.max("pos").alias("size"))
    links = counted.filter("is_report = 0").join(sizes, keys).filter("seen < size").select(
        *keys, "pos", (F.col("seen") + 1).alias("next"))
    links = cut_lineage(links)
    found = rows.filter("pos = 1").select(*keys, "pos")
    while not links.isEmpty():
        reached = found.join(links, [*keys, "pos"]).select(*keys, F.col("next").alias("pos"))
        found = cut_lineage(found.unionByName(reached))
        second = links.select(*keys, F.col("pos").alias("next"), F.col("next").alias("after"))
        links = cut_lineage(links.join(second, [*keys, "next"]).select(*keys, "pos", F.col("after").alias("next")))
    return found


def burst_throttle(reports: DataFrame, gap: float = GAP_SECONDS, limit: int = BURST_LIMIT, ranges: int | None = None) -> DataFrame:
    """Reports with ``accepted`` and the counter after the report. Needs user_id, report_seq, t.

    ``ranges``: into how many pieces of (reporter, time) all reports are cut; by default as many as a shuffle has.
    """
    keys = ["user_id", "session"]
    slots = slot_sessions(reports, gap)
    sizes = slots.groupBy(*keys).agg(F.sum("n").alias("session_reports"))
    placed = (reports.withColumn("slot", slot_of("t", gap))
              .join(slots.join(sizes, keys).select(*keys, "slot", "session_reports"), ["user_id", "slot"]))
    placed = ranged(placed, [*keys, "t", "report_seq"], "range", ranges)
    placed = cut_lineage(numbered(placed, keys, [F.col("t"), F.col("report_seq")], F.col("range"), "pos"))
    long = placed.filter(F.col("session_reports") > limit)
    batch = batch_starts(long.select(*keys, "pos", "t"), gap, limit, ranges).select(
        *keys, F.posexplode(F.sequence("pos", F.col("pos") + limit - 1)).alias("offset", "pos"))
    short = F.col("session_reports") <= limit
    return placed.join(batch, [*keys, "pos"], "left").select(
        *reports.columns, "session", (short | F.col("offset").isNotNull()).alias("accepted"),
        F.when(short, F.col("pos")).when(F.col("offset").isNotNull(), F.col("offset") + 1).otherwise(limit)
        .cast("long").alias("burst_count"))
