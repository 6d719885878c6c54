"""Joins of claims with dimensions, scores and other feeds.

No side is marked for broadcast: Spark broadcasts a side whose file or shuffle
size is below its threshold and shuffles it otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimsight.functions.codes import procedure_risk


def with_procedure_risk(df: DataFrame) -> DataFrame:
    return df.withColumn("procedure_risk", procedure_risk(F.col("procedure_code")))


def enrich(claims: DataFrame, providers: DataFrame, members: DataFrame) -> DataFrame:
    """Claims with provider, member and procedure attributes; unknown keys stay."""
    p = providers.select(
        F.col("npi").alias("provider_npi"),
        "specialty",
        F.col("status").alias("provider_status"),
    )
    m = members.select("member_id", "plan_id", F.col("status").alias("member_status"))
    joined = claims.join(p, "provider_npi", "left").join(m, "member_id", "left")
    return with_procedure_risk(joined)


def investigate(
    claims: DataFrame,
    providers: DataFrame,
    scores: DataFrame,
    *,
    since: Column,
    min_score: float = 0.75,
    status: str = "ACTIVE",
) -> DataFrame:
    """Claims of active providers with a high score since a date, highest first."""
    p = providers.filter(F.col("status") == status).select(
        F.col("npi").alias("provider_npi"), F.col("name").alias("provider_name")
    )
    s = scores.filter(F.col("fraud_score") > min_score).select(
        "claim_id", "fraud_score", "triggered_rules"
    )
    return (
        claims.filter(F.col("service_date") >= since)
        .join(s, "claim_id")
        .join(p, "provider_npi")
        .select(
            "claim_id",
            "procedure_code",
            "amount",
            "provider_name",
            "fraud_score",
            "triggered_rules",
        )
        .orderBy(F.desc("fraud_score"), "claim_id")
    )


def merge_feeds(*feeds: DataFrame) -> DataFrame:
    """One frame of all feeds; columns a feed lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), feeds)


def compare_scores(
    champion: DataFrame, challenger: DataFrame, score: str = "fraud_score"
) -> DataFrame:
    """Both scores and their difference for claims both have scored."""
    return champion.select("claim_id", F.col(score).alias("champion")).join(
        challenger.select("claim_id", F.col(score).alias("challenger")), "claim_id"
    ).withColumn("delta", F.col("challenger") - F.col("champion"))


def agreement(compared: DataFrame, tier) -> DataFrame:
    """Rows and mean difference for every pair of risk tiers."""
    return compared.groupBy(
        tier(F.col("champion")).alias("champion_level"),
        tier(F.col("challenger")).alias("challenger_level"),
    ).agg(F.count(F.lit(1)).alias("n"), F.avg("delta").alias("mean_delta"))
