"""Reporter reputation and weighted consensus on numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scoring
from ..session import cut_lineage
from .burst import burst_throttle
from .prefix import numbered, running

PRIOR = 2.0
MIN_CONSENSUS = 3
TIME_CHUNK_SECONDS = 3600.0
SEQ_CHUNK = 1_000_000


def time_chunk(t: str = "t", seconds: float = TIME_CHUNK_SECONDS) -> Column:
    return F.floor(F.col(t) / seconds)


def known_reports(reports: DataFrame, reporters: DataFrame) -> DataFrame:
    return reports.join(reporters.select("user_id"), "user_id")


def unknown_reports(reports: DataFrame, reporters: DataFrame) -> DataFrame:
    return reports.join(reporters.select("user_id"), "user_id", "left_anti").withColumn("reason", F.lit("Unknown user"))


def default_reports(reports: DataFrame, reporters: DataFrame, country: str = "TW") -> DataFrame:
    """Reports with their reporter's profile; unknown reporters get a fresh default one."""
    side = reporters.select("user_id", F.col("registered_country").alias("known_country"))
    return reports.drop("registered_country").join(side, "user_id", "left").select(
        "*", F.coalesce("known_country", F.lit(country)).alias("registered_country"),
        F.lit(PRIOR).alias("alpha"), F.lit(PRIOR).alias("beta"),
        F.col("known_country").isNull().alias("auto_registered")).drop("known_country")


def reputation_table(reporters: DataFrame, validations: DataFrame, reports: DataFrame) -> DataFrame:
    """Every registered reporter's reputation after all validations."""
    judged = validations.groupBy("user_id").agg(
        F.count_if("was_correct").alias("right"), F.count_if(~F.col("was_correct")).alias("wrong"))
    away = reports.groupBy("user_id").agg(F.bool_or(
        ~scoring.geo_consistent(F.col("registered_country"), F.col("report_country"))).alias("geo_flag"))
    table = reporters.select("user_id").join(judged, "user_id", "left").join(away, "user_id", "left").select(
        "user_id", (F.lit(PRIOR) + F.coalesce("right", F.lit(0))).alias("alpha"),
        (F.lit(PRIOR) + F.coalesce("wrong", F.lit(0))).alias("beta"),
        (F.coalesce("right", F.lit(0)) + F.coalesce("wrong", F.lit(0))).alias("total_reports"),
        F.coalesce("geo_flag", F.lit(False)).alias("geo_flag"))
    score = scoring.reputation(F.col("alpha"), F.col("beta"), F.col("total_reports"), F.lit(0), F.col("geo_flag"))
    return table.withColumn("score", score).withColumn("tier", scoring.reputation_tier(F.round("score", 9))).withColumn(
        "report_weight", scoring.report_weight(F.round("score", 9)))


def leaderboard(table: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` best reporters, ties by registration order; the rank window sees only those ``n`` rows."""
    top = table.orderBy(F.desc(F.round("score", 9)), "user_id").limit(n)
    place = F.row_number().over(Window.orderBy(F.desc(F.round("score", 9)), "user_id"))
    return top.select(place.alias("rank"), "user_id", "tier", F.round("score", 3).alias("score"), "total_reports",
                      F.round(F.col("alpha") / (F.col("alpha") + F.col("beta")), 3).alias("accuracy"))


def beta_running(validations: DataFrame) -> DataFrame:
    right = F.col("was_correct").cast("long")
    table = running(validations, ["user_id"], [F.col("t"), F.col("seq")], time_chunk(), sums={"r": right, "w": 1 - right})
    return table.select("seq", "user_id", (PRIOR + F.col("r")).alias("alpha"), (PRIOR + F.col("w")).alias("beta"),
                        (F.col("r") + F.col("w")).alias("total_reports"))


def geo_flag_running(reports: DataFrame) -> DataFrame:
    odd = ~scoring.geo_consistent(F.col("registered_country"), F.col("report_country"))
    return running(reports, ["user_id"], [F.col("t"), F.col("report_seq")], time_chunk(),
                   maxes={"geo_flag": odd}).select("report_seq", "user_id", "geo_flag")


def reputation_as_of(reports: DataFrame, validations: DataFrame) -> DataFrame:
    """Reports with their reporter's counts from the validations before them.

    Validations carry 1 and reports 0 in the same time-ordered running sums, so no range join is needed.
    """
    nothing = F.lit(0).cast("long")
    right = F.col("was_correct").cast("long")
    carried = [c for c in reports.columns if c not in ("user_id", "t")]
    asked = reports.select("user_id", "t", F.col("report_seq").alias("seq"), F.struct(*carried).alias("report"),
                           nothing.alias("right"), nothing.alias("wrong"))
    told = validations.select("user_id", "t", "seq", right.alias("right"), (1 - right).alias("wrong"))
    mixed = asked.unionByName(told, allowMissingColumns=True)
    table = running(mixed, ["user_id"], [F.col("t"), F.col("seq")], time_chunk(), sums={"r": F.col("right"), "w": F.col("wrong")})
    return table.filter("report is not null").select(
        "user_id", "t", "report.*", (PRIOR + F.col("r")).alias("alpha"), (PRIOR + F.col("w")).alias("beta"),
        (F.col("r") + F.col("w")).alias("total_reports"))


def consensus_decision(score: Column, reports: Column) -> Column:
    """Decision with the rule that BLOCK needs enough reports."""
    plain = scoring.decision(score)
    return F.when((plain == "BLOCK") & (reports < MIN_CONSENSUS), "REVIEW").otherwise(plain)


def running_consensus(reports: DataFrame, order: list[str] = ("report_seq",), chunk: Column | None = None) -> DataFrame:
    """Count, mean weight and decision of a number after each report."""
    chunk = F.floor(F.col("report_seq") / SEQ_CHUNK) if chunk is None else chunk
    table = running(reports, ["phone_number"], [F.col(c) for c in order], chunk,
                    sums={"number_reports": F.lit(1).cast("long"), "weight_sum": F.col("user_weight")})
    score = F.least(F.lit(1.0), F.round(F.col("weight_sum") / F.col("number_reports"), 9))
    return table.withColumn("weighted_score", score).drop("weight_sum").withColumn(
        "decision", consensus_decision(F.col("weighted_score"), F.col("number_reports")))


def running_dominant_category(reports: DataFrame, order: list[str] = ("report_seq",), chunk: Column | None = None) -> DataFrame:
    """Heaviest category of a number after each report, ties to the one reported first.

    Category sums never fall, so the heaviest category at a row is the running maximum over each row's
    own category sum. Two running passes do it, for any number of categories.
    """
    chunk = F.floor(F.col("report_seq") / SEQ_CHUNK) if chunk is None else chunk
    columns = [F.col(c) for c in order]
    own = running(reports, ["phone_number", "scam_category"], columns, chunk,
                  sums={"own_sum": F.col("user_weight")}, maxes={"neg_first": -F.col("report_seq")})
    mark = F.struct(F.round("own_sum", 9).alias("s"), F.col("neg_first").alias("f"), F.col("scam_category").alias("c"))
    best = running(own, ["phone_number"], columns, chunk, maxes={"best": mark})
    return best.select(*reports.columns, F.col("best.c").alias("dominant_category"))


def phone_consensus(reports: DataFrame) -> DataFrame:
    """Final mean weight, decision without the minimum, and dominant category per number."""
    parts = reports.groupBy("phone_number", "scam_category").agg(
        F.sum("user_weight").alias("w"), F.count("*").alias("n"), F.min("report_seq").alias("first"))
    table = parts.groupBy("phone_number").agg(
        F.sum("n").alias("reports"), F.sum("w").alias("w"),
        F.max_by("scam_category", F.struct(F.round("w", 9), -F.col("first"))).alias("dominant_category"))
    score = F.least(F.lit(1.0), F.round(F.col("w") / F.col("reports"), 9))
    return table.select("phone_number", "reports", score.alias("weighted_score"), "dominant_category",
                        scoring.decision(score).alias("decision"))


def blacklist_candidates(consensus: DataFrame) -> DataFrame:
    return consensus.filter("decision = 'BLOCK'")


def report_ids(reports: DataFrame) -> DataFrame:
    """RPT-000001, RPT-000002, ... in report order."""
    table = numbered(reports, [], [F.col("report_seq")], F.floor(F.col("report_seq") / SEQ_CHUNK), "n")
    return table.select("report_seq", F.format_string("RPT-%06d", "n").alias("report_id"))


def report_decisions(reports: DataFrame, validations: DataFrame, reporters: DataFrame) -> DataFrame:
    """The whole submission pipeline: lookup, burst limit, geo flag, weight as of the report, consensus.

    Rejected reports come back with status ``error`` or ``throttled`` and empty figures.
    """
    checked = cut_lineage(burst_throttle(known_reports(reports, reporters)))
    accepted = checked.filter("accepted").drop("accepted", "session")
    odd = ~scoring.geo_consistent(F.col("registered_country"), F.col("report_country"))
    flagged = running(accepted, ["user_id"], [F.col("t"), F.col("report_seq")], time_chunk(), maxes={"geo_flag": odd})
    weighed = reputation_as_of(flagged, validations)
    score = scoring.reputation(F.col("alpha"), F.col("beta"), F.col("total_reports"), F.col("burst_count"), F.col("geo_flag"))
    # Each running pass reads its input twice, so stacked passes start from a written table.
    weighed = cut_lineage(weighed.withColumn("reputation", score).withColumn(
        "user_weight", scoring.report_weight(F.round("reputation", 9))))
    order = ["t", "report_seq"]
    judged = running_dominant_category(running_consensus(weighed, order, time_chunk()), order, time_chunk())
    done = judged.select(
        "report_seq", "user_id", "phone_number", F.lit("accepted").alias("status"), "burst_count", "geo_flag", "reputation",
        "user_weight", "weighted_score", "number_reports", "dominant_category", "decision")
    held = checked.filter("not accepted").select("report_seq", "user_id", "phone_number", F.lit("throttled").alias("status"))
    lost = unknown_reports(reports, reporters).select("report_seq", "user_id", "phone_number", F.lit("error").alias("status"))
    return done.unionByName(held, allowMissingColumns=True).unionByName(lost, allowMissingColumns=True)


def high_confidence(scored: DataFrame, floor: float = 0.8, n: int = 5) -> DataFrame:
    return scored.filter(F.col("spam_proba") >= floor).orderBy(F.desc("spam_proba"), "phone_number").limit(n)


def merged_blacklist(candidates: DataFrame, stream: DataFrame | None) -> DataFrame:
    """Consensus candidates and stream entries in one list; a missing stream list counts as empty."""
    left = candidates.select("phone_number", "weighted_score", F.lit(True).alias("a"))
    if stream is None:
        right = left.limit(0).select("phone_number", F.lit(0.0).alias("probability"), F.lit(True).alias("b"))
    else:
        right = stream.select("phone_number", "probability", F.lit(True).alias("b"))
    return left.join(right, "phone_number", "full_outer").select(
        "phone_number", "weighted_score", "probability", F.coalesce("a", F.lit(False)).alias("by_consensus"),
        F.coalesce("b", F.lit(False)).alias("by_stream"),
        (F.coalesce(F.col("a").cast("int"), F.lit(0)) + F.coalesce(F.col("b").cast("int"), F.lit(0))).alias("entries"))


def service_stats(predictions: DataFrame, reports: DataFrame, candidates: DataFrame) -> DataFrame:
    """Totals of predictions, reports and listed numbers, and the mean latency."""
    return predictions.agg(
        F.count("*").alias("total_predictions"),
        F.count_if("by_model").alias("total_model_predictions"),
        F.round(F.coalesce(F.avg("latency_ms"), F.lit(0.0)), 3).alias("avg_latency_ms")).select(
        "*", reports.agg(F.count("*")).scalar().alias("total_reports"),
        candidates.agg(F.count("*")).scalar().alias("blacklisted_numbers"))
