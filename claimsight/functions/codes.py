"""Fixed values of the scoring rules and the expressions that use them."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Risk by procedure code, and the risk of any other code.
PROCEDURE_RISK = {
    "27447": 0.90,
    "29827": 0.85,
    "27130": 0.88,
    "29881": 0.80,
    "93306": 0.65,
    "99291": 0.70,
    "99213": 0.10,
    "99223": 0.25,
    "93000": 0.20,
    "80053": 0.05,
    "85025": 0.05,
    "80061": 0.05,
    "82947": 0.05,
    "97110": 0.10,
    "97012": 0.10,
    "97140": 0.10,
    "97530": 0.10,
}
DEFAULT_RISK = 0.30

# Orthopaedic procedures and cardiovascular diagnoses.
ORTHOPAEDIC_PROCEDURES = ["27447", "29827", "29881", "27130"]
CARDIAC_DIAGNOSES = ["I10", "I25.10", "I48.0", "I50.9"]

# Rule names in reporting order with their scores.
RULE_SCORES = {
    "AMOUNT_3X_PROVIDER_AVG": 0.78,
    "EXTREME_AMOUNT": 0.88,
    "PROCEDURE_DIAGNOSIS_MISMATCH": 0.93,
    "HIGH_VOLUME_PROVIDER": 0.62,
}

# Lower bounds of the risk tiers, and the alert threshold.
TIERS = [("CRITICAL", 0.90), ("HIGH", 0.70), ("MEDIUM", 0.40)]
LOWEST_TIER = "LOW"
ALERT_THRESHOLD = 0.65

# Bucket bounds of the two latency histograms, in seconds.
SCORING_BUCKETS = [0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0]
INFERENCE_BUCKETS = [0.001, 0.005, 0.01, 0.025, 0.05, 0.1, 0.25]


def procedure_risk(code: Column) -> Column:
    """Risk of a procedure code. The table has 17 entries: a literal map, no join."""
    table = F.create_map(*[F.lit(v) for v in chain(*PROCEDURE_RISK.items())])
    return F.coalesce(F.try_element_at(table, code), F.lit(DEFAULT_RISK))


def in_both_sets(
    left: Column, left_set: list[str], right: Column, right_set: list[str]
) -> Column:
    """True where both codes are members of their set; null codes are not."""
    hit = left.isin(left_set) & right.isin(right_set)
    return F.coalesce(hit, F.lit(False))


def risk_tier(score: Column) -> Column:
    """Tier of a score, lower bounds included."""
    tier = F.lit(LOWEST_TIER)
    for name, bound in reversed(TIERS):
        tier = F.when(score >= bound, F.lit(name)).otherwise(tier)
    return tier
