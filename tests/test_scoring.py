"""Golden rows of rules, blending and tiers, and facts that follow from them."""

import pytest
from pyspark.sql import functions as F

from claimsight.functions.codes import PROCEDURE_RISK, procedure_risk, risk_tier
from claimsight.functions.fields import token
from claimsight.operators import quality
from claimsight.operators import scoring as sc

COLUMNS = (
    "claim_id string, amount_cents bigint, avg_cents_30d bigint, claim_count_30d bigint, "
    "procedure_code string, diagnosis_code string"
)


def ruled(spark, *rows):
    df = spark.createDataFrame([(f"c{i}", *r) for i, r in enumerate(rows)], COLUMNS)
    got = sc.apply_rules(df).orderBy("claim_id").collect()
    return [(r.rule_points, list(r.triggered_rules)) for r in got]


def test_each_rule(spark):
    names = list(sc.RULE_SCORES)
    got = ruled(
        spark,
        (30_001, 10_000, 5, "99213", "I10"),
        (30_000, 10_000, 5, "99213", "I10"),
        (5_000_001, 4_000_000, 5, "99213", "I10"),
        (5_000_000, 4_000_000, 5, "99213", "I10"),
        (875_000, 919_500, 47, "27447", "I10"),
        (100, 100, 201, "99213", "M54.5"),
        (100, 100, 200, "99213", "M54.5"),
        (6_000_000, 1_000, 300, "29881", "I50.9"),
        (100, 0, 1, None, None),
    )
    assert got == [
        (7800, [names[0]]),
        (0, []),
        (8800, [names[1]]),
        (0, []),
        (9300, [names[2]]),
        (6200, [names[3]]),
        (0, []),
        (9300, names),
        (0, []),
    ]


@pytest.mark.parametrize(
    "rule,ml,final,level,alert",
    [
        (9300, 8910, 0.93, "CRITICAL", True),
        (0, 8500, 0.51, "MEDIUM", False),
        (0, 500, 0.03, "LOW", False),
        (0, 10000, 0.60, "MEDIUM", False),
        (6200, 6700, 0.65, "MEDIUM", True),
        (6200, 6600, 0.644, "MEDIUM", False),
        (7800, 9800, 0.90, "CRITICAL", True),
        (8800, 9130, 0.8998, "HIGH", True),
        (7800, None, 0.78, "HIGH", True),
    ],
)
def test_blend_golden_rows(spark, rule, ml, final, level, alert):
    df = spark.createDataFrame([(rule, ml)], "rule_points bigint, m bigint")
    scored = sc.blend(df, F.col("m"))
    row = scored.first()
    assert (row.fraud_score, row.risk_level) == (final, level)
    assert (sc.above_threshold(scored).count() == 1) == alert


def test_model_alone_never_alerts(spark):
    df = spark.range(0, 10001).select(F.lit(0).cast("bigint").alias("rule_points"), "id")
    assert sc.above_threshold(sc.blend(df, F.col("id"))).count() == 0


def test_tier_bounds_are_included(spark):
    df = spark.createDataFrame([(0.9,), (0.8999,), (0.7,), (0.4,), (0.3999,)], "s double")
    got = [r[0] for r in df.select(risk_tier(F.col("s"))).collect()]
    assert got == ["CRITICAL", "HIGH", "HIGH", "MEDIUM", "LOW"]


def test_risk_lookup(spark):
    df = spark.createDataFrame([(c,) for c in [*PROCEDURE_RISK, "00000", None]], "c string")
    got = {r.c: r.r for r in df.select("c", procedure_risk(F.col("c")).alias("r")).collect()}
    assert got == {**PROCEDURE_RISK, "00000": 0.30, None: 0.30}


def test_average_rounds_halves_up(spark):
    df = spark.createDataFrame([(3, 2), (5, 2), (7, 3), (10**17 + 1, 2)], "t bigint, n bigint")
    got = [r[0] for r in df.select(sc.average_cents("t", "n")).collect()]
    assert got == [2, 3, 2, (10**17 + 2) // 2]


def test_token_value(spark):
    df = spark.createDataFrame([("MBR-4521",), (None,)], "m string")
    assert [r[0] for r in df.select(token("m")).collect()] == ["e64259a9a38c28f3", None]


def test_scores_stay_in_range_and_alerts_are_scored(spark, claims):
    scored = sc.score_claims(quality.dedup(claims), volume=20).cache()
    assert scored.filter("fraud_score < 0 OR fraud_score > 1").count() == 0
    alerts = sc.above_threshold(scored)
    assert alerts.count() > 0
    assert alerts.join(scored, "claim_id", "left_anti").count() == 0
    assert scored.filter("claim_count_30d <= 3").filter(
        F.array_contains("triggered_rules", "AMOUNT_3X_PROVIDER_AVG") & F.expr("avg_cents_30d > 1")
    ).count() == 0
    scored.unpersist()


def test_first_and_second_of_duplicates(spark):
    df = spark.createDataFrame(
        [
            ("m", "p", "x", "c1", 0),
            ("m", "p", "x", "c2", 86400),
            ("m", "p", "x", "c3", 2 * 86400 + 1),
            ("m", "p", "x", "c4", 2 * 86400 + 1),
            ("m", "p", "y", "c5", 10),
        ],
        "member_id string, provider_npi string, procedure_code string, claim_id string, s bigint",
    ).withColumn("event_time", F.timestamp_seconds("s"))
    got = {r.claim_id: r.duplicate for r in sc.duplicate_claims(df).collect()}
    assert got == {"c1": False, "c2": True, "c3": False, "c4": True, "c5": False}


def test_suppression(spark):
    alerts = spark.createDataFrame([("a",), ("b",)], "claim_id string")
    earlier = spark.createDataFrame([("b",), ("b",)], "claim_id string")
    assert [r[0] for r in sc.suppress_repeats(alerts, earlier).collect()] == ["a"]


def test_first_claim_and_previous_second_come_from_one_aggregation(spark, claims):
    """Two joins at most: the day's carried second, and back to the rows."""
    from claimsight.operators.scoring import duplicate_claims

    plan = duplicate_claims(claims)._jdf.queryExecution().optimizedPlan().toString()
    base = claims._jdf.queryExecution().optimizedPlan().toString()
    assert "Join " not in base and plan.count("Join ") == 2
