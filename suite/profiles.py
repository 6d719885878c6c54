"""Rolling windows, running state and profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimsight.functions.fields import sample_deviation
from claimsight.operators import features as ft
from claimsight.operators.scoring import running_profiles
from claimsight.operators.timeline import rolling_frame
from suite.fixture import PROVIDERS_CTE, claims, providers, result, tokenized, with_claims
from suite.registry import query

DEVIATION = (
    "round(sqrt(CAST(CAST({n} AS HUGEINT) * {q} - CAST({s} AS HUGEINT) * {s} AS DOUBLE)"
    " / (CAST({n} AS DOUBLE) * (CAST({n} AS DOUBLE) - 1))) / 100, 4)"
)
ROLLING_30 = (
    "OVER (PARTITION BY {k} ORDER BY sec RANGE BETWEEN {w} PRECEDING AND CURRENT ROW)"
)


def deviation():
    return F.round(
        sample_deviation(F.col("n"), F.col("total_cents"), F.col("squares")) / 100, 4
    )


W30 = ROLLING_30.format(k="provider_npi", w=30 * 86400)
W90 = ROLLING_30.format(k="member_id", w=90 * 86400)


@query(
    "rolling_provider_30d",
    with_claims(
        f""", s AS (SELECT claim_id, provider_npi, procedure_code, amount_cents, sec,
    count(*) {W30} AS n, sum(amount_cents) {W30} AS t, max(amount_cents) {W30} AS m,
    sum(CAST(amount_cents AS HUGEINT) * amount_cents) {W30} AS q,
    count(DISTINCT procedure_code) {W30} AS k
  FROM claims)
SELECT claim_id, provider_npi, procedure_code, amount_cents, sec AS event_sec, n AS claim_count_30d,
  CAST(t AS BIGINT) / n / 100 AS avg_amount_30d,
  CASE WHEN n > 1 THEN {DEVIATION.format(n="n", s="t", q="q")} END AS stddev_amount_30d,
  m / 100 AS max_amount_30d, k AS distinct_procedures_30d FROM s"""
    ),
)
def rolling_provider_30d(spark, sf_dir):
    df = rolling_frame(claims(spark, sf_dir), ["provider_npi"], 30, kind="procedure_code")
    return result(
        df,
        "claim_id",
        "provider_npi",
        "procedure_code",
        "amount_cents",
        F.unix_seconds("event_time").alias("event_sec"),
        F.col("n").alias("claim_count_30d"),
        (F.col("total_cents") / F.col("n") / 100).alias("avg_amount_30d"),
        deviation().alias("stddev_amount_30d"),
        (F.col("max_cents") / 100).alias("max_amount_30d"),
        F.col("kinds").alias("distinct_procedures_30d"),
    )


@query(
    "rolling_member_90d",
    with_claims(
        f"""
SELECT claim_id, member_id, provider_npi, amount_cents, sec AS event_sec,
  count(*) {W90} AS claim_count_90d, CAST(sum(amount_cents) {W90} AS BIGINT) / 100 AS total_amount_90d,
  count(DISTINCT provider_npi) {W90} AS distinct_providers_90d
FROM claims"""
    ),
)
def rolling_member_90d(spark, sf_dir):
    df = rolling_frame(
        claims(spark, sf_dir), ["member_id"], 90, kind="provider_npi", spread=False
    )
    return result(
        df,
        "claim_id",
        "member_id",
        "provider_npi",
        "amount_cents",
        F.unix_seconds("event_time").alias("event_sec"),
        F.col("n").alias("claim_count_90d"),
        (F.col("total_cents") / 100).alias("total_amount_90d"),
        F.col("kinds").alias("distinct_providers_90d"),
    )


LATEST = """, lasts AS (SELECT {k}, max(sec) AS last_sec FROM claims GROUP BY {k}),
win AS (SELECT c.* FROM claims c JOIN lasts l ON c.{k} = l.{k} AND c.sec >= l.last_sec - {w})"""

PROVIDER_FEATURES_SQL = f"""
SELECT substr(sha256(provider_npi), 1, 16) AS provider_npi_token, count(*) AS claim_count_30d,
  CAST(sum(amount_cents) AS BIGINT) / count(*) / 100 AS avg_amount_30d,
  CASE WHEN count(*) > 1 THEN {DEVIATION.format(n="count(*)", s="sum(amount_cents)", q="sum(CAST(amount_cents AS HUGEINT) * amount_cents)")} END AS stddev_amount_30d,
  max(amount_cents) / 100 AS max_amount_30d, count(DISTINCT procedure_code) AS distinct_procedures_30d
FROM win GROUP BY provider_npi"""


@query(
    "provider_features",
    with_claims(LATEST.format(k="provider_npi", w=30 * 86400) + PROVIDER_FEATURES_SQL),
)
def provider_features(spark, sf_dir):
    df = ft.provider_features(tokenized(claims(spark, sf_dir)))
    return result(df.withColumn("stddev_amount_30d", F.round("stddev_amount_30d", 4)))


@query(
    "member_features",
    with_claims(
        LATEST.format(k="member_id", w=90 * 86400)
        + """
SELECT substr(sha256(member_id), 1, 16) AS member_id_token, count(*) AS claim_count_90d,
  CAST(sum(amount_cents) AS BIGINT) / 100 AS total_amount_90d,
  count(DISTINCT provider_npi) AS distinct_providers_90d
FROM win GROUP BY member_id"""
    ),
)
def member_features(spark, sf_dir):
    return result(ft.member_features(tokenized(claims(spark, sf_dir))))


BEHAVIOUR = ", ".join(
    f"""count(*) FILTER (WHERE age <= {d * 86400}) AS claim_count_{d}d,
  CAST(sum(amount_cents) FILTER (WHERE age <= {d * 86400}) AS BIGINT)
    / count(*) FILTER (WHERE age <= {d * 86400}) / 100 AS avg_amount_{d}d,
  count(DISTINCT procedure_code) FILTER (WHERE age <= {d * 86400}) AS distinct_procedures_{d}d"""
    for d in (30, 60, 90)
)


@query(
    "provider_behaviour",
    with_claims(
        f""", aged AS (SELECT *, max(sec) OVER (PARTITION BY provider_npi) - sec AS age FROM claims)
SELECT provider_npi, {BEHAVIOUR} FROM aged GROUP BY provider_npi"""
    ),
)
def provider_behaviour(spark, sf_dir):
    return result(ft.provider_behaviour(claims(spark, sf_dir)))


@query(
    "provider_stats_30d",
    with_claims(
        LATEST.format(k="provider_npi", w=30 * 86400)
        + """
SELECT provider_npi, count(*) AS claim_count, count(DISTINCT member_id) AS unique_members,
  CAST(sum(amount_cents) AS BIGINT) / count(*) / 100 AS avg_claim_value,
  count(DISTINCT procedure_code) / count(*) AS procedure_diversity,
  count(*) FILTER (WHERE status = 'REJECTED') / count(*) AS denial_rate
FROM win GROUP BY provider_npi"""
    ),
)
def provider_stats_30d(spark, sf_dir):
    return result(ft.provider_stats(claims(spark, sf_dir)))


def _entropy_sql(key, kind):
    return with_claims(
        f""", c AS (SELECT {key}, {kind}, count(*) AS n FROM claims GROUP BY ALL)
SELECT {key}, round(ln(sum(n)) - sum(n * ln(n)) / sum(n), 6) + 0 AS entropy
FROM c GROUP BY {key}"""
    )


@query("procedure_entropy", _entropy_sql("provider_npi", "procedure_code"))
def procedure_entropy(spark, sf_dir):
    df = ft.entropy(claims(spark, sf_dir), "provider_npi", "procedure_code", "entropy")
    return result(df, "provider_npi", (F.round("entropy", 6) + 0).alias("entropy"))


@query("diagnosis_entropy", _entropy_sql("member_id", "diagnosis_code"))
def diagnosis_entropy(spark, sf_dir):
    df = ft.entropy(claims(spark, sf_dir), "member_id", "diagnosis_code", "entropy")
    return result(df, "member_id", (F.round("entropy", 6) + 0).alias("entropy"))


@query(
    "time_since_last_claim",
    with_claims(
        """, points AS (SELECT DISTINCT member_id, sec FROM claims),
gaps AS (SELECT member_id, sec, sec - lag(sec) OVER (PARTITION BY member_id ORDER BY sec) AS gap FROM points)
SELECT claim_id, member_id, sec AS event_sec, gap AS seconds_since_last_claim
FROM claims JOIN gaps USING (member_id, sec)"""
    ),
)
def time_since_last_claim(spark, sf_dir):
    df = ft.time_since_last_claim(claims(spark, sf_dir), "member_id")
    return result(
        df,
        "claim_id",
        "member_id",
        F.unix_seconds("event_time").alias("event_sec"),
        "seconds_since_last_claim",
    )


@query(
    "procedure_rarity",
    with_claims(
        f""", {PROVIDERS_CTE},
c AS (SELECT specialty, procedure_code, count(*) AS n FROM claims JOIN providers ON provider_npi = npi GROUP BY ALL)
SELECT specialty, procedure_code, n, round(-ln(n / sum(n) OVER (PARTITION BY specialty)), 6) AS rarity_score FROM c"""
    ),
)
def procedure_rarity(spark, sf_dir):
    c = claims(spark, sf_dir)
    p = providers(spark, sf_dir).select(F.col("npi").alias("provider_npi"), "specialty")
    df = ft.procedure_rarity(c.join(p, "provider_npi"))
    return result(df.withColumn("rarity_score", F.round("rarity_score", 6)))


@query(
    "provider_p95_30d",
    with_claims(
        LATEST.format(k="provider_npi", w=30 * 86400)
        + """
SELECT provider_npi, quantile_cont(amount_cents, 0.95) AS p95_cents FROM win GROUP BY provider_npi"""
    ),
)
def provider_p95_30d(spark, sf_dir):
    return result(ft.provider_p95(claims(spark, sf_dir)))


@query(
    "active_providers",
    with_claims(
        """, lasts AS (SELECT provider_npi, max(sec) AS last_sec FROM claims GROUP BY provider_npi)
SELECT count(*) AS active_providers FROM lasts
WHERE last_sec > (SELECT max(last_sec) FROM lasts) - 30 * 86400"""
    ),
)
def active_providers(spark, sf_dir):
    df = ft.active_keys(claims(spark, sf_dir), "provider_npi")
    return result(df.agg(F.count(F.lit(1)).alias("active_providers")))


DIGEST_SQL = (
    "md5(concat_ws('|', claim_id, CAST(amount_cents AS VARCHAR), procedure_code,"
    " diagnosis_code, status, provider_npi, member_id))"
)


def state_sql(key, ttl_days, out, source, order="sec, arrival"):
    """Running count and sum with restarts, as CTEs ``gaps``, ``runs``."""
    return f"""{out}_gaps AS (SELECT *, CASE WHEN sec - lag(sec) OVER w < {ttl_days * 86400} THEN 0 ELSE 1 END AS fresh
  FROM {source} WINDOW w AS (PARTITION BY {key} ORDER BY {order})),
{out}_runs AS (SELECT * EXCLUDE (fresh), sum(fresh) OVER (PARTITION BY {key} ORDER BY {order} ROWS UNBOUNDED PRECEDING) AS run
  FROM {out}_gaps),
{out} AS (SELECT * EXCLUDE (run), count(*) OVER r AS {out}_n, CAST(sum(amount_cents) OVER r AS BIGINT) AS {out}_total
  FROM {out}_runs WINDOW r AS (PARTITION BY {key}, run ORDER BY {order} ROWS UNBOUNDED PRECEDING))"""


STATE_SQL = f""", ordered AS (SELECT *, {DIGEST_SQL} AS arrival FROM claims),
{state_sql("provider_npi", 30, "prov", source="ordered")},
{state_sql("member_id", 90, "memb", source="prov", order="sec, arrival, prov_n")},
profiled AS (SELECT * EXCLUDE (prov_n, memb_n, prov_total, memb_total), prov_n AS claim_count_30d,
  (2 * prov_total + prov_n) // (2 * prov_n) AS avg_cents_30d, memb_n AS member_claim_count_90d FROM memb)"""


@query(
    "running_state",
    with_claims(
        STATE_SQL
        + """
SELECT claim_id, provider_npi, member_id, sec AS event_sec, amount_cents, claim_count_30d,
  avg_cents_30d / 100 AS avg_amount_30d, member_claim_count_90d FROM profiled"""
    ),
)
def running_state(spark, sf_dir):
    df = running_profiles(claims(spark, sf_dir))
    return result(
        df,
        "claim_id",
        "provider_npi",
        "member_id",
        F.unix_seconds("event_time").alias("event_sec"),
        "amount_cents",
        "claim_count_30d",
        (F.col("avg_cents_30d") / 100).alias("avg_amount_30d"),
        "member_claim_count_90d",
    )
