"""Rules, score blending, tiers and alerts.

Scores are computed in ten-thousandths and money in cents, so every comparison
and every rounding is exact and the same in batch, stream and SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsight.functions.codes import (
    ALERT_THRESHOLD,
    CARDIAC_DIAGNOSES,
    ORTHOPAEDIC_PROCEDURES,
    RULE_SCORES,
    in_both_sets,
    procedure_risk,
    risk_tier,
)
from claimsight.functions.fields import hour_of_day, is_weekend, row_digest
from claimsight.operators.quantiles import exact_quantiles
from claimsight.operators.timeline import (
    previous_second,
    rolling_frame,
    running_totals,
    with_second,
    SEC,
    fold_copies,
    unfold_copies,
)
from claimsight.session import materialize

UNIT = 10_000
PROVIDER_TTL, MEMBER_TTL = 30, 90
ORDER_COLUMNS = ["claim_id", "amount_cents", "procedure_code", "diagnosis_code", "status"]


def average_cents(total: str, n: str) -> Column:
    """Average rounded to whole cents, halves up, in whole-number arithmetic."""
    return F.expr(f"(2 * {total} + {n}) div (2 * {n})")


def arrival_order(df: DataFrame, provider: str = "provider_npi", member: str = "member_id"):
    """Adds ``arrival``: decides the order of claims with the same time."""
    return df.withColumn("arrival", _digest(provider, member))


def _digest(provider: str, member: str) -> Column:
    return row_digest(*ORDER_COLUMNS, provider, member)


def running_profiles(
    df: DataFrame,
    *,
    provider: str = "provider_npi",
    member: str = "member_id",
    provider_ttl: int = PROVIDER_TTL,
    member_ttl: int = MEMBER_TTL,
    copies: bool = False,
    provider_carry: DataFrame | None = None,
    member_carry: DataFrame | None = None,
    store=materialize,
) -> DataFrame:
    """Claim with the running state of its provider and member.

    The state of a key restarts after a pause of its time to live; the claim
    itself is part of the state it is compared with. Set ``copies`` if many
    rows may be equal in all columns (see ``timeline.running_totals``). The
    carries are the states that earlier claims left. Claims that are not cached are stored
    by ``store``; a ``session.WorkTables`` lets the caller remove them afterwards.
    """
    # Stored once: sizes, totals and rows of both keys are read from it.
    digest = None if "arrival" in df.columns else _digest(provider, member)
    ordered = fold_copies(df) if copies else df
    if not ordered.is_cached:
        ordered = store(ordered, "claims-to-profile")
    if digest is not None:
        ordered = ordered.withColumn("arrival", digest)
    lean = ["arrival", "event_time", *(["copies"] if copies else [])]
    result = running_totals(
        ordered,
        [provider],
        provider_ttl,
        order=["arrival"],
        source=ordered.select(provider, "amount_cents", *lean),
        carry=provider_carry,
        digest=digest,
        store=store,
    ).withColumnRenamed("n", "claim_count_30d")
    result = running_totals(
        result,
        [member],
        member_ttl,
        order=["arrival", "claim_count_30d"],
        cents=None,
        source=ordered.select(member, *lean),
        carry=member_carry,
        digest=digest,
        store=store,
    ).withColumnRenamed("n", "member_claim_count_90d")
    if copies:
        one = F.lit(1)
        result = unfold_copies(
            result,
            {
                "claim_count_30d": one,
                "member_claim_count_90d": one,
                "total_cents": F.col("amount_cents"),
            },
        )
    average = average_cents("total_cents", "claim_count_30d")
    return result.withColumn("avg_cents_30d", average).drop("total_cents")


def rules(
    *,
    multiple: int = 3,
    extreme_cents: int = 5_000_000,
    volume: int = 200,
) -> dict[str, Column]:
    """Condition of every rule on the columns of :func:`running_profiles`."""
    average = F.col("avg_cents_30d")
    return {
        "AMOUNT_3X_PROVIDER_AVG": (average > 0)
        & (F.col("amount_cents") > average * multiple),
        "EXTREME_AMOUNT": F.col("amount_cents") > extreme_cents,
        "PROCEDURE_DIAGNOSIS_MISMATCH": in_both_sets(
            F.col("procedure_code"),
            ORTHOPAEDIC_PROCEDURES,
            F.col("diagnosis_code"),
            CARDIAC_DIAGNOSES,
        ),
        "HIGH_VOLUME_PROVIDER": F.col("claim_count_30d") > volume,
    }


def apply_rules(df: DataFrame, **thresholds) -> DataFrame:
    """Adds ``rule_points`` (ten-thousandths) and ``triggered_rules``."""
    fired = rules(**thresholds)
    points = [
        F.when(cond, F.lit(round(RULE_SCORES[name] * UNIT))).otherwise(0)
        for name, cond in fired.items()
    ]
    names = F.array(*[F.when(cond, F.lit(name)) for name, cond in fired.items()])
    return df.withColumns(
        {
            "rule_points": F.greatest(*points).cast("bigint"),
            "triggered_rules": F.filter(names, lambda x: x.isNotNull()),
        }
    )


def blend(df: DataFrame, model_points: Column | None = None) -> DataFrame:
    """Adds the final score: the rules alone or six parts model, four parts rules.

    A missing model score counts as zero.
    """
    ml = F.coalesce(model_points, F.lit(0)) if model_points is not None else F.lit(0)
    ml = ml.cast("bigint")
    mixed = F.floor((ml * 6 + F.col("rule_points") * 4 + 5) / 10).cast("bigint")
    final = F.greatest(F.col("rule_points"), mixed)
    scored = df.withColumns({"ml_points": ml, "fraud_points": final})
    scored = scored.withColumns(
        {
            "rule_score": F.col("rule_points") / UNIT,
            "ml_score": F.col("ml_points") / UNIT,
            "fraud_score": F.col("fraud_points") / UNIT,
        }
    )
    return scored.withColumn("risk_level", risk_tier(F.col("fraud_score")))


def model_inputs(df: DataFrame) -> DataFrame:
    """Adds the columns of the model vector that come from the claim itself."""
    average = F.col("avg_cents_30d") / 100
    amount = F.col("amount_cents") / 100
    return df.withColumns(
        {
            "avg_amount_30d": average,
            "amount_ratio": amount / F.greatest(average, F.lit(1.0)),
            "hour_of_day": hour_of_day("event_time"),
            "is_weekend": is_weekend("event_time"),
            "procedure_risk": procedure_risk(F.col("procedure_code")),
        }
    )


def above_threshold(df: DataFrame, threshold: float = ALERT_THRESHOLD) -> DataFrame:
    """Scored claims that become alerts."""
    return df.filter(F.col("fraud_score") >= threshold)


def suppress_repeats(
    alerts: DataFrame, earlier: DataFrame, key: str = "claim_id"
) -> DataFrame:
    """Alerts for claims that have not been alerted before."""
    return alerts.join(earlier.select(key), key, "left_anti")


def repeated_procedure(df: DataFrame, limit: int = 5, days: int = 1) -> DataFrame:
    """Flags claims whose provider billed the procedure more than ``limit`` times in a day."""
    framed = rolling_frame(
        df, ["provider_npi", "procedure_code"], days, spread=False
    ).withColumnRenamed("n", "same_procedure_24h")
    return framed.drop("total_cents", "max_cents").withColumn(
        "repeated_procedure", F.coalesce(F.col("same_procedure_24h") > limit, F.lit(False))
    )


def duplicate_claims(
    df: DataFrame,
    keys: tuple[str, ...] = ("member_id", "provider_npi", "procedure_code"),
    hours: int = 24,
) -> DataFrame:
    """Flags claims that repeat an earlier claim with the same keys within ``hours``.

    Earlier means an earlier second, or the same second and a smaller claim id.
    Copies of one claim are no duplicates of each other: dedup removes those.
    """
    keys = list(keys)
    first = {"first_id": F.min("claim_id")}
    prior = previous_second(df, keys, name="prior_sec", also=first)
    near = F.col(SEC) - F.col("prior_sec") <= hours * 3600
    return (
        with_second(prior, "event_time")
        .withColumn(
            "duplicate",
            F.coalesce(near, F.lit(False))
            | F.coalesce(F.col("claim_id") > F.col("first_id"), F.lit(False)),
        )
        .drop(SEC, "prior_sec", "first_id")
    )


def procedure_limits(history: DataFrame, quantile: float = 0.99) -> DataFrame:
    """Highest usual amount per procedure, in cents."""
    return exact_quantiles(
        history, ["procedure_code"], "amount_cents", {"limit_cents": quantile}
    )


def above_limit(df: DataFrame, limits: DataFrame, on: str, limit: str) -> DataFrame:
    """Flags claims above the limit of their procedure or provider.

    The limits are stored first: with their size known, Spark broadcasts a small
    table and leaves the claims where they are.
    """
    return df.join(materialize(limits, "limits"), on, "left").withColumn(
        "above_limit", F.coalesce(F.col("amount_cents") > F.col(limit), F.lit(False))
    )


def score_claims(
    df: DataFrame,
    model=None,
    carries: dict[str, DataFrame] | None = None,
    store=materialize,
    **thresholds,
) -> DataFrame:
    """Full scoring: running state, rules, optional model, tiers.

    ``model`` is a fitted ``operators.models`` model or None for rules only; ``carries``
    the states of earlier claims and ``store`` a place for tables, as :func:`running_profiles`
    takes them.
    """
    profiles = running_profiles(df, store=store, **(carries or {}))
    profiled = model_inputs(apply_rules(profiles, **thresholds))
    if model is None:
        return blend(profiled)
    from claimsight.operators.models import predict

    predicted = predict(profiled, model)
    points = F.round(F.col("fraud_probability") * UNIT, 0)
    return blend(predicted, points).drop("fraud_probability", "model_version")
