"""Summaries over claims, scored claims and timings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimsight.functions.codes import ALERT_THRESHOLD
from claimsight.operators.quantiles import exact_quantiles


def provider_summary(df: DataFrame, key: str = "provider_npi") -> DataFrame:
    """Count, average (whole cents) and maximum per provider, largest average first."""
    return (
        df.groupBy(key)
        .agg(
            F.count(F.lit(1)).alias("total"),
            F.sum("amount_cents").alias("_sum"),
            F.max("amount_cents").alias("max_cents"),
        )
        .withColumn("avg_cents", F.expr("(2 * _sum + total) div (2 * total)"))
        .drop("_sum")
        .orderBy(F.desc("avg_cents"), key)
    )


def rows_per_date(df: DataFrame, column: str = "processing_date") -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(column)


def latest(df: DataFrame, n: int = 5, tie: tuple[str, ...] = ("claim_id",)) -> DataFrame:
    """The newest rows; ties are decided so that the answer is always the same."""
    return df.orderBy(F.desc("event_time"), *tie).limit(n)


def deviating_claims(df: DataFrame, min_ratio: float = 3.0, n: int = 10) -> DataFrame:
    """Claims furthest above their provider's average."""
    return (
        df.filter(F.col("amount_ratio") > min_ratio)
        .orderBy(F.desc("amount_ratio"), "claim_id", F.desc("amount"))
        .limit(n)
    )


def analyst_profile(
    df: DataFrame, *, min_claims: int = 100, n: int = 50, key: str = "provider_npi"
) -> DataFrame:
    """Average, count, distinct members and 95th percentile of busy providers."""
    pairs = df.groupBy(key, "member_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("amount_cents").alias("total")
    )
    sums = (
        pairs.groupBy(key)
        .agg(
            F.sum("n").alias("claim_count"),
            F.sum("total").alias("_total"),
            F.count("member_id").alias("unique_members"),
        )
        .filter(F.col("claim_count") > min_claims)
    )
    tails = exact_quantiles(df, [key], "amount_cents", {"p95_cents": 0.95})
    average = F.col("_total") / F.col("claim_count") / 100
    return (
        sums.join(tails, key)
        .select(
            key,
            average.alias("avg_claim"),
            "claim_count",
            "unique_members",
            (F.col("p95_cents") / 100).alias("p95_amount"),
        )
        .orderBy(F.desc("avg_claim"), key)
        .limit(n)
    )


def outcome(score: str = "fraud_score", threshold: float = ALERT_THRESHOLD) -> Column:
    """fraud, legitimate, or error where there is no score."""
    return (
        F.when(F.col(score) >= threshold, "fraud")
        .when(F.col(score).isNotNull(), "legitimate")
        .otherwise("error")
    )


def outcome_counts(df: DataFrame) -> DataFrame:
    return df.groupBy(outcome().alias("result")).agg(F.count(F.lit(1)).alias("n"))


def risk_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("risk_level").agg(F.count(F.lit(1)).alias("n"))


def cumulative_histogram(
    df: DataFrame, value: str, bounds: list[float], by: list[str]
) -> DataFrame:
    """Cumulative bucket counts (``le`` bounds and +Inf), rows and sum per group.

    All buckets are counted in one aggregation and only then turned into rows.
    """
    counts = [F.count(F.when(F.col(value) <= b, 1)).alias(f"_b{i}") for i, b in enumerate(bounds)]
    wide = df.groupBy(*by).agg(
        *counts, F.count(value).alias("_all"), F.sum(value).alias("value_sum")
    )
    cells = [
        F.struct(
            F.lit(i).alias("bucket"),
            F.lit(str(b)).alias("le"),
            F.lit(float(b)).alias("bound"),
            F.col(f"_b{i}").alias("cumulative"),
        )
        for i, b in enumerate(bounds)
    ]
    cells.append(
        F.struct(
            F.lit(len(bounds)).alias("bucket"),
            F.lit("+Inf").alias("le"),
            F.lit(float("inf")).alias("bound"),
            F.col("_all").alias("cumulative"),
        )
    )
    return wide.select(*by, "value_sum", F.explode(F.array(*cells)).alias("c")).select(
        *by, "c.bucket", "c.le", "c.bound", "c.cumulative", "value_sum"
    )


def histogram_quantiles(hist: DataFrame, by: list[str], quantiles: list[float]) -> DataFrame:
    """Quantiles from cumulative buckets, linear inside a bucket.

    In the open last bucket the answer is the largest finite bound.
    """
    w = Window.partitionBy(*by).orderBy("bucket")
    total = F.max("cumulative").over(Window.partitionBy(*by))
    steps = hist.select(
        *by,
        "bound",
        "cumulative",
        F.coalesce(F.lag("bound").over(w), F.lit(0.0)).alias("low"),
        F.coalesce(F.lag("cumulative").over(w), F.lit(0)).alias("below"),
        total.alias("total"),
    ).withColumn("quantile", F.explode(F.array(*[F.lit(q) for q in quantiles])))
    rank = F.col("quantile") * F.col("total")
    hit = steps.filter(
        (F.col("cumulative") >= rank)
        & ((F.col("below") < rank) | ((F.col("below") == 0) & (rank == 0)))
    )
    share = (rank - F.col("below")) / (F.col("cumulative") - F.col("below"))
    inner = F.col("low") + (F.col("bound") - F.col("low")) * share
    last = F.col("bound") == float("inf")
    return hit.select(
        *by, "quantile", F.when(last, F.col("low")).otherwise(inner).alias("value")
    )


def alert_rollup(alerts: DataFrame) -> DataFrame:
    """Alerts by rule, provider and month with subtotals (ALL)."""
    rows = alerts.select(
        F.explode("triggered_rules").alias("rule"),
        "provider_npi",
        F.date_format("event_time", "yyyy-MM").alias("period"),
        "amount_cents",
    )
    levels = ["rule", "provider_npi", "period"]
    grouped = rows.rollup(*levels).agg(
        F.count(F.lit(1)).alias("alerts"),
        F.sum("amount_cents").alias("amount_cents"),
        *[F.grouping(c).alias(f"_{c}") for c in levels],
    )
    return grouped.select(
        *[F.when(F.col(f"_{c}") == 1, "ALL").otherwise(F.col(c)).alias(c) for c in levels],
        "alerts",
        "amount_cents",
    )


def score_distribution(df: DataFrame, buckets: int = 20) -> DataFrame:
    """Scored claims per risk level and score bucket."""
    bucket = F.least(F.expr(f"fraud_points div {10_000 // buckets}"), F.lit(buckets - 1))
    return df.groupBy("risk_level", bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def monthly_report(scored: DataFrame) -> DataFrame:
    """Claims, amount, denied and flagged claims per month."""
    return (
        scored.groupBy(F.date_format("event_time", "yyyy-MM").alias("month"))
        .agg(
            F.count(F.lit(1)).alias("claims"),
            F.sum("amount_cents").alias("amount_cents"),
            F.count(F.when(F.col("status") == "REJECTED", 1)).alias("denied"),
            F.count(F.when(F.col("fraud_score") >= ALERT_THRESHOLD, 1)).alias("flagged"),
        )
        .orderBy("month")
    )


def throughput(df: DataFrame, at: str, label: Column, every: str = "1 minute") -> DataFrame:
    """Rows per time window and label."""
    return (
        df.groupBy(F.window(at, every).alias("w"), label.alias("result"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), "result", "n")
    )


def sliding_counts(
    df: DataFrame, at: str, size: str, slide: str, by: list[str]
) -> DataFrame:
    """Counts in sliding windows. Rows are counted per slide first, so that the
    copies a sliding window makes are copies of counts and not of rows."""
    slices = df.groupBy(F.window(at, slide).alias("s"), *by).agg(F.count(F.lit(1)).alias("n"))
    return over_slices(slices.select(F.col("s.start").alias("window_start"), *by, "n"), size, slide, by)


def over_slices(slices: DataFrame, size: str, slide: str, by: list[str]) -> DataFrame:
    """Sliding windows from the counts of their slides (``window_start``, by, ``n``)."""
    return (
        slices.groupBy(F.window("window_start", size, slide).alias("w"), *by)
        .agg(F.sum("n").alias("n"))
        .select(F.col("w.start").alias("window_start"), *by, "n")
    )


def log_bucket(value: str, bits: int = 6) -> Column:
    """Lower bound of the logarithmic bucket of a whole number of 0 or more.

    A bucket keeps the ``bits`` leading binary digits: at most 2^(1 - bits) of the value wide.
    Counts per bucket add up over batches, machines and time.
    """
    shift = f"greatest(0, length(bin({value})) - {bits})"
    return F.expr(f"shiftleft(shiftright({value}, {shift}), {shift})")


def bucket_quantiles(
    counts: DataFrame, by: list[str], low: str, n: str, quantiles: list[float], name: str
) -> DataFrame:
    """Quantiles from counts per bucket: the bucket in which the wanted rank lies."""
    group = Window.partitionBy(*by)
    sums = counts.select(
        *by,
        low,
        F.sum(n).over(group.orderBy(low)).alias("_upto"),
        F.sum(n).over(group).alias("_total"),
        F.explode(F.array(*[F.lit(q) for q in quantiles])).alias("quantile"),
    )
    hit = sums.filter(F.col("_upto") >= F.col("quantile") * F.col("_total"))
    return hit.groupBy(*by, "quantile").agg(F.min(low).alias(name))


def latency_quantiles(
    df: DataFrame, at: str, micros: str, every: str = "2 minutes"
) -> DataFrame:
    """Exact median, 95th and 99th percentile of a timing per time window."""
    timed = df.select(F.window(at, every)["start"].alias("window_start"), micros)
    return exact_quantiles(
        timed, ["window_start"], micros, {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    )
