"""Batch plans: raw zone to silver, silver to gold, scoring with alerts."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsight.functions.fields import cents, token
from claimsight.operators import quality, tables
from claimsight.operators.features import claim_features, member_features, provider_features
from claimsight.operators.scoring import above_threshold, score_claims, suppress_repeats
from claimsight.schemas import CORRUPT
from claimsight.session import WorkTables
from claimsight.sources.claims import read_bronze


def silver(
    raw: DataFrame,
    run_date: date,
    run_time: datetime,
    *,
    dedup: bool = True,
    positive: bool = False,
) -> tuple[DataFrame, Observation]:
    """Raw claims as clean rows with tokens; counts come with the first action."""
    timed = quality.normalize_event_time(raw)
    kept, counts = quality.observe_malformed(timed)
    if positive:
        kept = quality.positive_amount(kept)
    tokens = kept.withColumns(
        {
            "service_date": F.col("service_date").try_cast("date"),
            "event_date": F.col("event_time").cast("date"),
            "amount_cents": cents("amount"),
            "member_id_token": token("member_id"),
            "provider_npi_token": token("provider_npi"),
        }
    )
    clean = quality.drop_identifiers(tokens).drop(CORRUPT, "year", "month", "day")
    if dedup:
        clean = quality.dedup(clean)
    return quality.stamp(clean, run_date, run_time, "ingested_at"), counts


def run_silver(
    spark: SparkSession,
    bronze: str,
    target: str,
    run_date: date,
    run_time: datetime,
    **options,
) -> dict[str, int]:
    """Merge the claims of a run into silver; returns the counts.

    Claims of earlier runs stay: an event date is rewritten with what it held. A claim id that
    is known keeps its latest version by event time, whichever date that lies on.
    """
    clean, counts = silver(read_bronze(spark, bronze), run_date, run_time, **options)
    tables.merge_rows(clean, target, "claim_id", "event_date", ("event_time",))
    return counts.get


def run_gold(
    spark: SparkSession, silver_path: str, root: str, run_time: datetime
) -> dict[str, DataFrame]:
    """Provider and member profiles and the claim vectors that join them.

    The profiles are read back before the join: they are not computed twice, and
    their real size decides between broadcast and shuffle.
    """
    claims = spark.read.parquet(silver_path)
    when = F.lit(run_time)
    providers = tables.write_table(
        provider_features(claims).withColumn("computed_at", when), f"{root}/provider_features"
    )
    members = tables.write_table(
        member_features(claims).withColumn("computed_at", when), f"{root}/member_features"
    )
    vectors = claim_features(
        claims, providers.drop("computed_at"), members.drop("computed_at")
    ).withColumn("feature_date", when)
    return {
        "provider_features": providers,
        "member_features": members,
        "claim_features": tables.write_table(
            vectors, f"{root}/claim_features", ["processing_date"]
        ),
    }


def run_scoring(
    claims: DataFrame,
    target: str,
    scored_at: datetime,
    model=None,
    earlier_alerts: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Score claims and add them, and the new alerts, to the tables of earlier runs.

    Each run has its own partition of both tables, and a rerun replaces its own. Alerts of
    other runs, and ``earlier_alerts``, are not given again; runs without any alert, or
    without any claim, are runs like others. Returns the run's scored claims and new alerts;
    :func:`latest_scores` reads the claims of all runs.
    """
    run = scored_at.strftime("%Y%m%dT%H%M%S")
    work = WorkTables()
    scored = score_claims(quality.dedup(claims), model, store=work).withColumn(
        "scored_at", F.lit(scored_at)
    )
    path = f"{target}/scored/run={run}"
    scored.drop("arrival").write.mode("overwrite").parquet(path)
    work.remove()
    stored = claims.sparkSession.read.parquet(path)
    alerts = above_threshold(stored)
    if earlier_alerts is not None:
        alerts = suppress_repeats(alerts, earlier_alerts)
    known = _runs(claims.sparkSession, f"{target}/alerts", stored.schema["claim_id"])
    if known is not None:
        alerts = suppress_repeats(alerts, known.filter(F.col("run") != run))
    path = f"{target}/alerts/run={run}"
    alerts.write.mode("overwrite").parquet(path)
    return stored, claims.sparkSession.read.schema(stored.schema).parquet(path)


def _runs(spark: SparkSession, path: str, *fields: T.StructField) -> DataFrame | None:
    """The given fields and the run of all rows of a table, None if there was no run yet."""
    if not tables.exists(spark, path):
        return None
    schema = T.StructType([*fields, T.StructField("run", T.StringType())])
    return spark.read.schema(schema).parquet(path)


def latest_scores(spark: SparkSession, target: str) -> DataFrame:
    """Claims of all runs, each as its last run scored it."""
    fields = spark.read.option("mergeSchema", "true").parquet(f"{target}/scored").drop("run").schema
    scored = _runs(spark, f"{target}/scored", *fields)
    return quality.dedup(scored, "claim_id", ("run",))


def all_alerts(spark: SparkSession, target: str, schema: T.StructType) -> DataFrame:
    """Alerts of all runs; a claim is alerted once."""
    return _runs(spark, f"{target}/alerts", *schema.fields)
