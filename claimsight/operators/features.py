"""Provider and member profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimsight.functions.fields import (
    DAY,
    day_of,
    hour_of_day,
    is_weekend,
    ratio_to_average,
    sample_deviation,
    square,
)
from claimsight.operators.quantiles import exact_quantiles
from claimsight.operators.timeline import (
    DAYNO,
    SEC,
    previous_second,
    rolling_frame,
    with_second,
)
from claimsight.session import materialize


def _timed(df: DataFrame, at: str) -> DataFrame:
    return (
        with_second(df, at).filter(F.col(SEC).isNotNull()).withColumn(DAYNO, day_of(SEC))
    )


def last_seconds(df: DataFrame, keys: list[str], *, at: str = "event_time") -> DataFrame:
    """Last second of every key."""
    return _timed(df, at).groupBy(*keys).agg(F.max(SEC).alias("last_sec"))


def latest_window(
    df: DataFrame,
    keys: list[str],
    days: list[int],
    kind: str,
    *,
    at: str = "event_time",
    cents: str = "amount_cents",
) -> DataFrame:
    """Profile of each key over the ``days`` before (and with) its last row.

    Equals the last row of a rolling range frame, but needs no frame at all:
    whole days come from totals per key, kind and day, combined before the
    shuffle, and only the first, partly covered day is read row by row. One row
    per key and window: ``days, n, total_cents, squares, max_cents, kinds``.
    """
    timed = _timed(df, at)
    parts = [
        F.count(F.lit(1)).alias("n"),
        F.sum(cents).alias("total_cents"),
        F.sum(square(F.col(cents))).cast("decimal(35,0)").alias("squares"),
        F.max(cents).alias("max_cents"),
    ]
    daily = timed.groupBy(*keys, DAYNO, kind).agg(*parts, F.max(SEC).alias("last"))
    lasts = daily.groupBy(*keys).agg(F.max("last").alias("last"))
    windows = lasts.select(
        *keys,
        F.explode(F.array(*[F.lit(d) for d in days])).alias("days"),
        F.col("last").alias("key_last"),
    )
    whole = (
        daily.drop("last")
        .join(windows, keys)
        .filter(F.col(DAYNO) > day_of("key_last") - F.col("days"))
        .drop("key_last", DAYNO)
    )
    first_days = windows.select(
        *keys,
        "days",
        (day_of("key_last") - F.col("days")).alias(DAYNO),
        (F.col("key_last") - F.col("days") * DAY).alias("from_sec"),
    )
    partly = (
        timed.select(*keys, kind, cents, SEC, DAYNO)
        .join(first_days, [*keys, DAYNO])
        .filter(F.col(SEC) >= F.col("from_sec"))
        .groupBy(*keys, "days", kind)
        .agg(*parts)
    )
    merged = [
        F.sum("n").alias("n"),
        F.sum("total_cents").alias("total_cents"),
        F.sum("squares").cast("decimal(35,0)").alias("squares"),
        F.max("max_cents").alias("max_cents"),
    ]
    return (
        whole.unionByName(partly)
        .groupBy(*keys, "days", kind)
        .agg(*merged)
        .groupBy(*keys, "days")
        .agg(*merged, F.count(kind).alias("kinds"))
    )


def latest_rows(
    df: DataFrame, keys: list[str], days: int, *, at: str = "event_time"
) -> DataFrame:
    """The rows inside each key's last window.

    Joined on key and day, not on the key alone, so that the rows of one large
    key stay spread over many tasks.
    """
    reach = F.sequence(day_of("last_sec") - days, day_of("last_sec"))
    wanted = last_seconds(df, keys, at=at).select(
        *keys, "last_sec", F.explode(reach).alias(DAYNO)
    )
    return (
        _timed(df, at)
        .join(wanted, [*keys, DAYNO])
        .filter(F.col(SEC) >= F.col("last_sec") - days * DAY)
        .drop(SEC, DAYNO, "last_sec")
    )


def provider_features(
    df: DataFrame, days: int = 30, key: str = "provider_npi_token"
) -> DataFrame:
    """Provider profile at its last claim, named after a 30-day window."""
    w = latest_window(df, [key], [days], "procedure_code")
    return w.select(
        key,
        F.col("n").alias(f"claim_count_{days}d"),
        (F.col("total_cents") / F.col("n") / 100).alias(f"avg_amount_{days}d"),
        (sample_deviation(F.col("n"), F.col("total_cents"), F.col("squares")) / 100).alias(
            f"stddev_amount_{days}d"
        ),
        (F.col("max_cents") / 100).alias(f"max_amount_{days}d"),
        F.col("kinds").alias(f"distinct_procedures_{days}d"),
    )


def member_features(
    df: DataFrame,
    days: int = 90,
    key: str = "member_id_token",
    provider: str = "provider_npi_token",
) -> DataFrame:
    """Member profile at the member's last claim."""
    w = latest_window(df, [key], [days], provider)
    return w.select(
        key,
        F.col("n").alias(f"claim_count_{days}d"),
        (F.col("total_cents") / 100).alias(f"total_amount_{days}d"),
        F.col("kinds").alias(f"distinct_providers_{days}d"),
    )


def provider_behaviour(
    df: DataFrame, days: tuple[int, ...] = (30, 60, 90), key: str = "provider_npi"
) -> DataFrame:
    """Count, average and distinct procedures over several windows side by side."""
    w = latest_window(df, [key], list(days), "procedure_code")
    columns = []
    for d in days:
        here = F.col("days") == d
        columns += [
            F.max(F.when(here, F.col("n"))).alias(f"claim_count_{d}d"),
            F.max(F.when(here, F.col("total_cents") / F.col("n") / 100)).alias(
                f"avg_amount_{d}d"
            ),
            F.max(F.when(here, F.col("kinds"))).alias(f"distinct_procedures_{d}d"),
        ]
    return w.groupBy(key).agg(*columns)


def provider_stats(
    df: DataFrame, days: int = 30, key: str = "provider_npi", denied: str = "REJECTED"
) -> DataFrame:
    """Claims, members, average, procedure diversity and denial rate per provider.

    Diversity is the number of different procedures over the number of claims.
    """
    rows = latest_rows(df, [key], days)
    flagged = F.when(F.col("status") == denied, 1).otherwise(0)
    per_pair = rows.groupBy(key, "member_id", "procedure_code").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("amount_cents").alias("total"),
        F.sum(flagged).alias("denied"),
    )
    per_member = per_pair.groupBy(key, "member_id").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.sum("denied").alias("denied")
    )
    sums = per_member.groupBy(key).agg(
        F.sum("n").alias("claim_count"),
        F.count("member_id").alias("unique_members"),
        F.sum("total").alias("total"),
        F.sum("denied").alias("denied"),
    )
    procedures = (
        per_pair.groupBy(key, "procedure_code")
        .agg(F.sum("n").alias("n"))
        .groupBy(key)
        .agg(F.count("procedure_code").alias("procedures"))
    )
    return sums.join(procedures, key).select(
        key,
        "claim_count",
        "unique_members",
        (F.col("total") / F.col("claim_count") / 100).alias("avg_claim_value"),
        (F.col("procedures") / F.col("claim_count")).alias("procedure_diversity"),
        (F.col("denied") / F.col("claim_count")).alias("denial_rate"),
    )


def entropy(df: DataFrame, key: str, kind: str, name: str) -> DataFrame:
    """Shannon entropy (natural logarithm) of ``kind`` per key."""
    counts = df.groupBy(key, kind).agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n").cast("double")
    return counts.groupBy(key).agg(
        (F.log(F.sum(n)) - F.sum(n * F.log(n)) / F.sum(n)).alias(name)
    )


def time_since_last_claim(df: DataFrame, key: str) -> DataFrame:
    """Seconds since the key's last earlier second with a claim; null for the first."""
    return (
        previous_second(df, [key])
        .withColumn(
            "seconds_since_last_claim",
            F.unix_seconds("event_time") - F.col("previous_sec"),
        )
        .drop("previous_sec")
    )


def procedure_rarity(df: DataFrame, group: str = "specialty") -> DataFrame:
    """Minus the logarithm of the procedure's share within the group."""
    counts = df.groupBy(group, "procedure_code").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy(group).agg(F.sum("n").alias("group_n"))
    return counts.join(totals, group).select(
        group,
        "procedure_code",
        "n",
        (-F.log(F.col("n") / F.col("group_n"))).alias("rarity_score"),
    )


def provider_p95(df: DataFrame, days: int = 30, key: str = "provider_npi") -> DataFrame:
    """95th percentile of the amounts in the provider's last window, in cents."""
    rows = latest_rows(df, [key], days)
    return exact_quantiles(rows, [key], "amount_cents", {"p95_cents": 0.95})


def active_keys(
    df: DataFrame, key: str, days: int = 30, *, at: str = "event_time"
) -> DataFrame:
    """Keys with a row in the last ``days`` days before the newest row of all."""
    lasts = last_seconds(df, [key], at=at)
    newest = lasts.agg(F.max("last_sec")).scalar()
    return lasts.filter(F.col("last_sec") > newest - days * DAY)


def claim_features(
    claims: DataFrame, providers: DataFrame, members: DataFrame
) -> DataFrame:
    """Each claim with the latest profile of its provider and member.

    Plain left joins without a broadcast hint: profile tables read from files
    are broadcast if their size allows it, larger ones are shuffled and large
    keys split at run time.
    """
    joined = claims.join(providers, "provider_npi_token", "left").join(
        members, "member_id_token", "left"
    )
    return _claim_vector(joined, [])


def claim_features_at_time(claims: DataFrame) -> DataFrame:
    """Each claim with the profiles as they stood at its own time.

    The claims are stored once, and both profiles are taken from them. Claims with the first
    profile are stored too, so shuffle files of one frame at a time are held.
    """
    claims = materialize(claims, "timed-claims")
    p = rolling_frame(
        claims, ["provider_npi_token"], 30, kind="procedure_code"
    ).withColumnsRenamed(
        {"n": "p_n", "total_cents": "p_total", "max_cents": "p_max", "squares": "p_sq"}
    )
    p = p.withColumnRenamed("kinds", "distinct_procedures_30d")
    both = rolling_frame(
        materialize(p, "provider-timed"),
        ["member_id_token"],
        90,
        kind="provider_npi_token",
        spread=False,
        source=claims,
    )
    named = both.select(
        *claims.columns,
        F.col("p_n").alias("claim_count_30d"),
        (F.col("p_total") / F.col("p_n") / 100).alias("avg_amount_30d"),
        (sample_deviation(F.col("p_n"), F.col("p_total"), F.col("p_sq")) / 100).alias(
            "stddev_amount_30d"
        ),
        (F.col("p_max") / 100).alias("max_amount_30d"),
        "distinct_procedures_30d",
        F.col("n").alias("claim_count_90d"),
        (F.col("total_cents") / 100).alias("total_amount_90d"),
        F.col("kinds").alias("distinct_providers_90d"),
    )
    return _claim_vector(named, ["distinct_procedures_30d"])


def _claim_vector(joined: DataFrame, more: list[str]) -> DataFrame:
    amount = F.col("amount").cast("double")
    shaped = (
        joined.withColumn("hour_of_day", hour_of_day("event_time"))
        .withColumn("is_weekend", is_weekend("event_time"))
        .withColumn("amount_ratio", ratio_to_average(amount, F.col("avg_amount_30d")))
    )
    columns = [
        "claim_id",
        "provider_npi_token",
        "member_id_token",
        "amount",
        "procedure_code",
        "diagnosis_code",
        "event_time",
        "hour_of_day",
        "is_weekend",
        "claim_count_30d",
        "avg_amount_30d",
        "stddev_amount_30d",
        "amount_ratio",
        "max_amount_30d",
        "claim_count_90d",
        "total_amount_90d",
        "distinct_providers_90d",
    ]
    tail = [c for c in ("processing_date",) if c in joined.columns]
    return shaped.select(*columns, *more, *tail)
