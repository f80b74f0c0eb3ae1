"""Score, tier and weight rules as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
REPUTATION_TIERS = [("tier_4", 0.85, 1.00), ("tier_3", 0.65, 0.65), ("tier_2", 0.40, 0.35), ("tier_1", 0.0, 0.10)]
HOME_REGION = ["TW", "HK", "SG", "JP"]
TRAVEL_COUNTRIES = ["TW", "HK", "SG"]
PROBABILITY_TIERS = [("HIGH", 0.7), ("MEDIUM", 0.4), ("LOW", 0.15), ("SAFE", 0.0)]
TIER_ADVICE = {
    "HIGH": "🔴 Immediate block recommended. Add to Redis blacklist.",
    "MEDIUM": "🟡 Flag for human review. Monitor call patterns.",
    "LOW": "🟠 Display warning label to user.",
    "SAFE": "🟢 No action needed.",
}


def tier(value: Column, steps: list[tuple[str, float]]) -> Column:
    """First step whose floor the value reaches; the last step catches the rest."""
    chain = F.when(value >= steps[0][1], steps[0][0])
    for name, floor in steps[1:-1]:
        chain = chain.when(value >= floor, name)
    return chain.otherwise(steps[-1][0])


def risk_tier(rate: Column, weighted: Column, voip: Column) -> Column:
    return (F.when((rate >= 0.7) | ((weighted >= 50) & (voip > 0.8)), "HIGH")
            .when((rate >= 0.3) | (weighted >= 20), "MEDIUM")
            .when(rate >= 0.1, "LOW").otherwise("SAFE"))


def heuristic_score(is_voip: Column, reports: Column, duration: Column, country: Column) -> Column:
    parts = (
        F.when(is_voip, 0.35).otherwise(0.0)
        + F.when(reports > 0, F.least(F.lit(0.4), 0.1 * F.log1p(reports))).otherwise(0.0)
        + F.when(duration < 5, 0.10).when((duration > 30) & (duration < 180), 0.05).otherwise(0.0)
        + F.when(country.isin(HOME_REGION), 0.0).otherwise(0.15))
    return F.least(parts, F.lit(1.0))


def probability_tier(p: Column) -> Column:
    return tier(p, PROBABILITY_TIERS)


def tier_advice(level: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in TIER_ADVICE.items() for x in pair])[level]


def reputation(alpha: Column, beta: Column, total: Column, burst: Column, geo: Column) -> Column:
    raw = (0.60 * alpha / (alpha + beta) + F.least(F.lit(0.20), 0.04 * F.log1p(total))
           - F.least(F.lit(0.15), 0.03 * burst) - F.when(geo, 0.10).otherwise(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), raw))


def reputation_tier(score: Column) -> Column:
    return tier(score, [(n, floor) for n, floor, _ in REPUTATION_TIERS])


def report_weight(score: Column) -> Column:
    chain = F.when(score >= REPUTATION_TIERS[0][1], REPUTATION_TIERS[0][2])
    for _, floor, weight in REPUTATION_TIERS[1:-1]:
        chain = chain.when(score >= floor, weight)
    return chain.otherwise(REPUTATION_TIERS[-1][2])


def decision(score: Column) -> Column:
    return tier(score, [("BLOCK", 0.85), ("REVIEW", 0.50), ("SUSPECT", 0.15), ("SAFE", 0.0)])


def geo_consistent(registered: Column, country: Column) -> Column:
    return (registered == country) | country.isin(TRAVEL_COUNTRIES)
