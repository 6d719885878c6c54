"""Rules, scores, alerts and the joins around them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from claimsight.functions.codes import PROCEDURE_RISK, risk_tier
from claimsight.operators import features as ft
from claimsight.operators import joins as jn
from claimsight.operators import quality
from claimsight.operators import scoring as sc
from claimsight.operators.timeline import as_of_join
from claimsight.plans.batch import all_alerts, latest_scores, run_gold, run_scoring, run_silver
from claimsight.session import materialize, work_path
from suite.fixture import (
    MEMBERS_CTE,
    PROVIDERS_CTE,
    claims,
    members,
    providers,
    result,
    tokenized,
    with_claims,
)
from suite.profiles import DEVIATION, LATEST, STATE_SQL, W30, W90
from suite.quality_checks import COMPLETE, DEDUP_CTE, MESSAGES, RUN_DATE, RUN_TIME, messages
from suite.registry import query

RISK_VALUES = ", ".join(f"('{k}', {v})" for k, v in PROCEDURE_RISK.items())
RISK_CTE = f"risks(code, risk) AS (VALUES {RISK_VALUES})"

RULES_SQL = """, ruled AS (SELECT *,
  CASE WHEN avg_cents_30d > 0 AND amount_cents > 3 * avg_cents_30d THEN 7800 ELSE 0 END AS r1,
  CASE WHEN amount_cents > 5000000 THEN 8800 ELSE 0 END AS r2,
  CASE WHEN procedure_code IN ('27447', '29827', '29881', '27130')
        AND diagnosis_code IN ('I10', 'I25.10', 'I48.0', 'I50.9') THEN 9300 ELSE 0 END AS r3,
  CASE WHEN claim_count_30d > 200 THEN 6200 ELSE 0 END AS r4 FROM profiled),
scored AS (SELECT *, greatest(r1, r2, r3, r4) AS points,
  concat_ws(',', CASE WHEN r1 > 0 THEN 'AMOUNT_3X_PROVIDER_AVG' END, CASE WHEN r2 > 0 THEN 'EXTREME_AMOUNT' END,
    CASE WHEN r3 > 0 THEN 'PROCEDURE_DIAGNOSIS_MISMATCH' END,
    CASE WHEN r4 > 0 THEN 'HIGH_VOLUME_PROVIDER' END) AS triggered_rules FROM ruled),
tiered AS (SELECT *, points / 10000 AS fraud_score, CASE WHEN points >= 9000 THEN 'CRITICAL' WHEN points >= 7000 THEN 'HIGH'
    WHEN points >= 4000 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level FROM scored)"""

# Scores are taken on claims without repeated ids: the source key is unique.
SCORED_SQL = DEDUP_CTE + STATE_SQL.replace("FROM claims)", "FROM deduped)") + RULES_SQL


def scored_claims(spark, sf_dir):
    return sc.score_claims(quality.dedup(claims(spark, sf_dir)))


@query(
    "alerts_by_risk_level",
    with_claims(
        SCORED_SQL
        + """
SELECT risk_level, count(*) AS alerts FROM tiered WHERE points >= 6500 GROUP BY risk_level"""
    ),
)
def alerts_by_risk_level(spark, sf_dir):
    alerts = sc.above_threshold(scored_claims(spark, sf_dir))
    return result(alerts.groupBy("risk_level").agg(F.count(F.lit(1)).alias("alerts")))


@query(
    "scored_claims",
    with_claims(
        SCORED_SQL
        + """
SELECT claim_id, provider_npi, amount_cents, claim_count_30d, member_claim_count_90d, points / 10000 AS rule_score,
  fraud_score, risk_level, triggered_rules FROM tiered"""
    ),
)
def scored(spark, sf_dir):
    return result(
        scored_claims(spark, sf_dir),
        "claim_id",
        "provider_npi",
        "amount_cents",
        "claim_count_30d",
        "member_claim_count_90d",
        "rule_score",
        "fraud_score",
        "risk_level",
        "triggered_rules",
    )


@query(
    "blended_scores",
    with_claims(
        SCORED_SQL
        + f""", {RISK_CTE}, blended AS (SELECT t.*, CASE WHEN status <> 'PENDING' THEN
    CAST(round(coalesce(risk, 0.30) * 10000) AS BIGINT) ELSE 0 END AS ml FROM tiered t LEFT JOIN risks ON procedure_code = code)
SELECT claim_id, ml / 10000 AS ml_score, greatest(points, (6 * ml + 4 * points + 5) // 10) / 10000 AS fraud_score,
  CASE WHEN greatest(points, (6 * ml + 4 * points + 5) // 10) >= 9000 THEN 'CRITICAL'
    WHEN greatest(points, (6 * ml + 4 * points + 5) // 10) >= 7000 THEN 'HIGH'
    WHEN greatest(points, (6 * ml + 4 * points + 5) // 10) >= 4000 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
FROM blended"""
    ),
)
def blended_scores(spark, sf_dir):
    """Rules blended with the procedure risk as model score; pending claims have none."""
    ruled = sc.model_inputs(sc.apply_rules(sc.running_profiles(quality.dedup(claims(spark, sf_dir)))))
    points = F.when(F.col("status") != "PENDING", F.round(F.col("procedure_risk") * sc.UNIT))
    return result(sc.blend(ruled, points), "claim_id", "ml_score", "fraud_score", "risk_level")


@query(
    "alerts_above_threshold",
    with_claims(
        SCORED_SQL
        + """
SELECT claim_id, fraud_score, risk_level, triggered_rules FROM tiered WHERE fraud_score >= 0.65"""
    ),
)
def alerts_above_threshold(spark, sf_dir):
    return result(
        sc.above_threshold(scored_claims(spark, sf_dir)),
        "claim_id",
        "fraud_score",
        "risk_level",
        "triggered_rules",
    )


@query(
    "suppressed_alerts",
    with_claims(
        SCORED_SQL
        + """
SELECT claim_id, risk_level FROM tiered WHERE points >= 6500
AND claim_id NOT IN (SELECT claim_id FROM claims WHERE event_time < TIMESTAMP '1998-01-01')"""
    ),
)
def suppressed_alerts(spark, sf_dir):
    """Alerts whose claim id was not seen, and alerted, before 1998."""
    alerts = sc.above_threshold(scored_claims(spark, sf_dir))
    earlier = claims(spark, sf_dir).filter("event_time < '1998-01-01'")
    return result(sc.suppress_repeats(alerts, earlier), "claim_id", "risk_level")


@query(
    "rules_on_sliding_stats",
    with_claims(
        f""", framed AS (SELECT *, count(*) {W30} AS n, CAST(sum(amount_cents) {W30} AS BIGINT) AS t FROM claims),
profiled AS (SELECT * EXCLUDE (n, t), n AS claim_count_30d, (2 * t + n) // (2 * n) AS avg_cents_30d FROM framed)"""
        + RULES_SQL
        + """
SELECT triggered_rules, risk_level, count(*) AS n, CAST(sum(amount_cents) AS BIGINT) AS amount_cents
FROM tiered GROUP BY ALL"""
    ),
)
def rules_on_sliding_stats(spark, sf_dir):
    """The rules on the true sliding window in place of the running state."""
    framed = ft.rolling_frame(claims(spark, sf_dir), ["provider_npi"], 30, spread=False)
    profiled = framed.withColumn("avg_cents_30d", sc.average_cents("total_cents", "n"))
    scored = sc.blend(sc.apply_rules(profiled.withColumnRenamed("n", "claim_count_30d")))
    rules = F.array_join("triggered_rules", ",").alias("triggered_rules")
    return result(
        scored.groupBy(rules, "risk_level").agg(
            F.count(F.lit(1)).alias("n"), F.sum("amount_cents").alias("amount_cents")
        )
    )


@query(
    "repeated_procedure_24h",
    with_claims(
        """
SELECT claim_id, provider_npi, procedure_code, sec AS event_sec, count(*) OVER w AS same_procedure_24h,
  CAST(count(*) OVER w > 5 AS BIGINT) AS repeated_procedure FROM claims
WINDOW w AS (PARTITION BY provider_npi, procedure_code ORDER BY sec RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW)"""
    ),
)
def repeated_procedure_24h(spark, sf_dir):
    return result(
        sc.repeated_procedure(claims(spark, sf_dir)),
        "claim_id",
        "provider_npi",
        "procedure_code",
        F.unix_seconds("event_time").alias("event_sec"),
        "same_procedure_24h",
        "repeated_procedure",
    )


@query(
    "duplicate_claims_24h",
    with_claims(
        """, firsts AS (SELECT member_id, procedure_code, sec, min(claim_id) AS first_id FROM claims GROUP BY ALL),
gaps AS (SELECT *, sec - lag(sec) OVER (PARTITION BY member_id, procedure_code ORDER BY sec) AS gap FROM firsts)
SELECT claim_id, member_id, procedure_code, sec AS event_sec,
  CAST(coalesce(gap <= 86400, false) OR claim_id > first_id AS BIGINT) AS duplicate
FROM claims JOIN gaps USING (member_id, procedure_code, sec)"""
    ),
)
def duplicate_claims_24h(spark, sf_dir):
    """Same member and procedure within a day, whoever the provider."""
    df = sc.duplicate_claims(claims(spark, sf_dir), ("member_id", "procedure_code"))
    return result(
        df,
        "claim_id",
        "member_id",
        "procedure_code",
        F.unix_seconds("event_time").alias("event_sec"),
        "duplicate",
    )


def _duplicate_sql(keys):
    return with_claims(
        f""", firsts AS (SELECT {keys}, sec, min(claim_id) AS first_id FROM claims GROUP BY ALL),
gaps AS (SELECT *, sec - lag(sec) OVER (PARTITION BY {keys} ORDER BY sec) AS gap FROM firsts)
SELECT claim_id, sec AS event_sec, CAST(coalesce(gap <= 86400, false) OR claim_id > first_id AS BIGINT) AS duplicate
FROM claims JOIN gaps USING ({keys}, sec)"""
    )


def _duplicates(spark, sf_dir, *keys):
    # Stored, so that the claims are derived once and their shuffle files are gone by then.
    c = materialize(claims(spark, sf_dir).select("claim_id", "event_time", *keys), "claims")
    df = sc.duplicate_claims(c, keys)
    return result(df, "claim_id", F.unix_seconds("event_time").alias("event_sec"), "duplicate")


@query("prior_claims_24h", _duplicate_sql("member_id, provider_npi, procedure_code"))
def prior_claims_24h(spark, sf_dir):
    """Same member, provider and procedure within a day."""
    return _duplicates(spark, sf_dir, "member_id", "provider_npi", "procedure_code")


@query("billed_twice_24h", _duplicate_sql("member_id, provider_npi, procedure_code, amount_cents"))
def billed_twice_24h(spark, sf_dir):
    """Same member, provider, procedure and amount within a day."""
    return _duplicates(spark, sf_dir, "member_id", "provider_npi", "procedure_code", "amount_cents")


# Three runs: a quiet one without any alert, claims before 1999, the others and some again.
RUNS_SQL = DEDUP_CTE + """, turned AS (SELECT *, CASE WHEN amount_cents = 0 AND procedure_code = '99213' THEN 0
    WHEN event_time < TIMESTAMP '1999-01-01' THEN 1 ELSE 2 END AS turn FROM deduped),
turns AS (SELECT * FROM turned UNION ALL SELECT * REPLACE (2 AS turn) FROM turned WHERE turn = 1 AND claim_id LIKE '%-1')""" + (
    STATE_SQL.replace("FROM claims)", "FROM turns)")
    .replace("PARTITION BY provider_npi", "PARTITION BY turn, provider_npi")
    .replace("PARTITION BY member_id", "PARTITION BY turn, member_id")
    + RULES_SQL
)


def scored_runs(spark, sf_dir):
    c = quality.dedup(claims(spark, sf_dir))
    turn = (
        F.when((F.col("amount_cents") == 0) & (F.col("procedure_code") == "99213"), 0)
        .when(F.col("event_time") < "1999-01-01", 1)
        .otherwise(2)
    )
    c = materialize(c.withColumn("turn", turn), "turns")
    again = c.filter("turn = 1 AND claim_id LIKE '%-1'")
    target = work_path(spark, "runs")
    for k, rows in enumerate((c.filter("turn = 0"), c.filter("turn = 1"), c.filter("turn = 2").unionByName(again))):
        stored, _ = run_scoring(rows.drop("turn"), target, datetime(2001, 8, 2 + k))
    return target, stored.schema


@query(
    "scored_after_two_runs",
    with_claims(
        RUNS_SQL
        + """, newest AS (SELECT *, max(turn) OVER (PARTITION BY claim_id) AS last_turn FROM tiered)
SELECT claim_id, claim_count_30d, member_claim_count_90d, fraud_score, risk_level, '2001080' || (2 + turn) || 'T000000' AS run
FROM newest WHERE turn = last_turn"""
    ),
)
def scored_after_two_runs(spark, sf_dir):
    """Claims of three runs, the first without alerts; repeated claims as scored last."""
    target, _ = scored_runs(spark, sf_dir)
    return result(
        latest_scores(spark, target),
        "claim_id",
        "claim_count_30d",
        "member_claim_count_90d",
        "fraud_score",
        "risk_level",
        "run",
    )


@query(
    "alerts_after_two_runs",
    with_claims(
        RUNS_SQL
        + """, alerts AS (SELECT *, min(turn) OVER (PARTITION BY claim_id) AS first_turn FROM tiered WHERE points >= 6500)
SELECT claim_id, risk_level, fraud_score, '2001080' || (2 + turn) || 'T000000' AS run FROM alerts WHERE turn = first_turn"""
    ),
)
def alerts_after_two_runs(spark, sf_dir):
    """Alerts of three runs; a claim that is scored again is not alerted again."""
    target, schema = scored_runs(spark, sf_dir)
    return result(all_alerts(spark, target, schema), "claim_id", "risk_level", "fraud_score", "run")


@query(
    "above_procedure_limit",
    with_claims(
        """, limits AS (SELECT procedure_code, quantile_cont(amount_cents, 0.99) AS limit_cents FROM claims GROUP BY 1)
SELECT claim_id, procedure_code, amount_cents, limit_cents FROM claims JOIN limits USING (procedure_code)
WHERE amount_cents > limit_cents"""
    ),
)
def above_procedure_limit(spark, sf_dir):
    c = claims(spark, sf_dir)
    df = sc.above_limit(c, sc.procedure_limits(c), "procedure_code", "limit_cents")
    return result(
        df.filter("above_limit"), "claim_id", "procedure_code", "amount_cents", "limit_cents"
    )


@query(
    "above_provider_p95",
    with_claims(
        LATEST.format(k="provider_npi", w=30 * 86400)
        + """, limits AS (SELECT provider_npi, quantile_cont(amount_cents, 0.95) AS p95_cents FROM win GROUP BY 1)
SELECT claim_id, provider_npi, amount_cents, p95_cents FROM claims JOIN limits USING (provider_npi)
WHERE amount_cents > p95_cents"""
    ),
)
def above_provider_p95(spark, sf_dir):
    c = claims(spark, sf_dir)
    df = sc.above_limit(c, ft.provider_p95(c), "provider_npi", "p95_cents")
    return result(
        df.filter("above_limit"), "claim_id", "provider_npi", "amount_cents", "p95_cents"
    )


@query(
    "procedure_risk",
    with_claims(
        f""", {RISK_CTE}
SELECT claim_id, procedure_code, CAST(coalesce(risk, 0.30) AS DOUBLE) AS procedure_risk
FROM claims LEFT JOIN risks ON procedure_code = code"""
    ),
)
def procedure_risk(spark, sf_dir):
    df = jn.with_procedure_risk(claims(spark, sf_dir))
    return result(df, "claim_id", "procedure_code", "procedure_risk")


@query(
    "feature_vector_columns",
    with_claims(
        SCORED_SQL
        + f""", {RISK_CTE}
SELECT claim_id, amount_cents / 100 AS amount, claim_count_30d, avg_cents_30d / 100 AS avg_amount_30d,
  (amount_cents / 100) / greatest(avg_cents_30d / 100, 1.0) AS amount_ratio,
  hour(event_time) AS hour_of_day, CAST(dayofweek(event_time) IN (0, 6) AS BIGINT) AS is_weekend,
  CAST(coalesce(risk, 0.30) AS DOUBLE) AS procedure_risk, member_claim_count_90d
FROM tiered LEFT JOIN risks ON procedure_code = code"""
    ),
)
def feature_vector_columns(spark, sf_dir):
    df = sc.model_inputs(sc.running_profiles(quality.dedup(claims(spark, sf_dir))))
    return result(
        df,
        "claim_id",
        (F.col("amount_cents") / 100).alias("amount"),
        "claim_count_30d",
        "avg_amount_30d",
        "amount_ratio",
        "hour_of_day",
        "is_weekend",
        "procedure_risk",
        "member_claim_count_90d",
    )


CLAIM_VECTOR_SQL = """, pf AS (SELECT provider_npi, count(*) AS claim_count_30d,
    CAST(sum(amount_cents) AS BIGINT) / count(*) / 100 AS avg_amount_30d, max(amount_cents) / 100 AS max_amount_30d
  FROM (SELECT *, max(sec) OVER (PARTITION BY provider_npi) AS last FROM claims) WHERE sec >= last - 30 * 86400 GROUP BY 1),
mf AS (SELECT member_id, count(*) AS claim_count_90d, CAST(sum(amount_cents) AS BIGINT) / 100 AS total_amount_90d,
    count(DISTINCT provider_npi) AS distinct_providers_90d
  FROM (SELECT *, max(sec) OVER (PARTITION BY member_id) AS last FROM claims) WHERE sec >= last - 90 * 86400 GROUP BY 1),
claim_vectors AS (SELECT claim_id, substr(sha256(provider_npi), 1, 16) AS provider_npi_token, amount_cents / 100 AS amount,
  hour(event_time) AS hour_of_day, CAST(dayofweek(event_time) IN (0, 6) AS BIGINT) AS is_weekend, claim_count_30d, avg_amount_30d,
  CASE WHEN avg_amount_30d > 0 THEN (amount_cents / 100) / avg_amount_30d ELSE 1.0 END AS amount_ratio,
  max_amount_30d, claim_count_90d, total_amount_90d, distinct_providers_90d
FROM claims LEFT JOIN pf USING (provider_npi) LEFT JOIN mf USING (member_id))"""
VECTOR = [
    "claim_id",
    "provider_npi_token",
    "amount",
    "hour_of_day",
    "is_weekend",
    "claim_count_30d",
    "avg_amount_30d",
    "amount_ratio",
    "max_amount_30d",
    "claim_count_90d",
    "total_amount_90d",
    "distinct_providers_90d",
]


def claim_vectors(spark, sf_dir):
    """Claims with their profiles. Claims and profiles are stored, so the claims are derived once."""
    c = materialize(tokenized(claims(spark, sf_dir)), "claims")
    p = materialize(ft.provider_features(c), "provider-features")
    return ft.claim_features(c, p, materialize(ft.member_features(c), "member-features"))


@query("claim_features", with_claims(CLAIM_VECTOR_SQL + "\nSELECT * FROM claim_vectors"))
def claim_features(spark, sf_dir):
    return result(claim_vectors(spark, sf_dir), *VECTOR)


@query(
    "claim_features_at_time",
    with_claims(
        f""", s AS (SELECT *, count(*) {W30} AS n, sum(amount_cents) {W30} AS t, max(amount_cents) {W30} AS m,
    sum(CAST(amount_cents AS HUGEINT) * amount_cents) {W30} AS q, count(DISTINCT procedure_code) {W30} AS kinds,
    count(*) {W90} AS mn, sum(amount_cents) {W90} AS mt, count(DISTINCT provider_npi) {W90} AS mk FROM claims)
SELECT claim_id, substr(sha256(provider_npi), 1, 16) AS provider_npi_token, amount_cents / 100 AS amount,
  hour(event_time) AS hour_of_day, CAST(dayofweek(event_time) IN (0, 6) AS BIGINT) AS is_weekend,
  n AS claim_count_30d, CAST(t AS BIGINT) / n / 100 AS avg_amount_30d,
  CASE WHEN n > 1 THEN {DEVIATION.format(n="n", s="t", q="q")} END AS stddev_amount_30d,
  CASE WHEN t > 0 THEN (amount_cents / 100) / (CAST(t AS BIGINT) / n / 100) ELSE 1.0 END AS amount_ratio,
  m / 100 AS max_amount_30d, mn AS claim_count_90d, CAST(mt AS BIGINT) / 100 AS total_amount_90d,
  mk AS distinct_providers_90d, kinds AS distinct_procedures_30d FROM s"""
    ),
)
def claim_features_at_time(spark, sf_dir):
    df = ft.claim_features_at_time(tokenized(claims(spark, sf_dir)))
    stddev = F.round("stddev_amount_30d", 4).alias("stddev_amount_30d")
    return result(df, *VECTOR, stddev, "distinct_procedures_30d")


@query(
    "as_of_features",
    with_claims(
        """, days AS (SELECT provider_npi, CAST(event_time AS DATE) AS day, count(*) AS n,
    CAST(sum(amount_cents) AS BIGINT) AS total_cents FROM claims GROUP BY ALL),
history AS (SELECT provider_npi, day + INTERVAL 1 DAY AS feature_time, n AS day_claims, total_cents AS day_cents FROM days)
SELECT c.claim_id, c.provider_npi, c.sec AS event_sec, c.amount_cents,
  CASE WHEN epoch(c.event_time) - epoch(h.feature_time) <= 86400 THEN day_claims END AS day_claims,
  CASE WHEN epoch(c.event_time) - epoch(h.feature_time) <= 86400 THEN day_cents END AS day_cents
FROM claims c ASOF LEFT JOIN history h ON c.provider_npi = h.provider_npi AND c.event_time >= h.feature_time"""
    ),
)
def as_of_features(spark, sf_dir):
    """Claims with the provider's daily totals known at the time, at most a day old."""
    c = claims(spark, sf_dir)
    daily = c.groupBy("provider_npi", F.to_date("event_time").alias("day")).agg(
        F.count(F.lit(1)).alias("day_claims"), F.sum("amount_cents").alias("day_cents")
    )
    history = daily.select(
        "provider_npi",
        F.date_add("day", 1).cast("timestamp").alias("feature_time"),
        "day_claims",
        "day_cents",
    )
    df = as_of_join(c, history, ["provider_npi"])
    return result(
        df,
        "claim_id",
        "provider_npi",
        F.unix_seconds("event_time").alias("event_sec"),
        "amount_cents",
        "day_claims",
        "day_cents",
    )


@query(
    "enriched_claims",
    with_claims(
        f""", {PROVIDERS_CTE}, {MEMBERS_CTE}, {RISK_CTE}
SELECT claim_id, specialty, p.status AS provider_status, plan_id, m.status AS member_status,
  CAST(coalesce(risk, 0.30) AS DOUBLE) AS procedure_risk
FROM claims c LEFT JOIN providers p ON provider_npi = npi LEFT JOIN members m ON c.member_id = m.member_id
LEFT JOIN risks ON procedure_code = code"""
    ),
)
def enriched_claims(spark, sf_dir):
    df = jn.enrich(claims(spark, sf_dir), providers(spark, sf_dir), members(spark, sf_dir))
    return result(
        df,
        "claim_id",
        "specialty",
        "provider_status",
        "plan_id",
        "member_status",
        "procedure_risk",
    )


@query(
    "investigation",
    with_claims(
        SCORED_SQL
        + f""", {PROVIDERS_CTE}
SELECT claim_id, procedure_code, amount_cents / 100 AS amount, p.name AS provider_name, fraud_score, triggered_rules
FROM tiered JOIN providers p ON provider_npi = npi
WHERE service_date >= DATE '1999-01-01' AND fraud_score > 0.75 AND p.status = 'ACTIVE'"""
    ),
)
def investigation(spark, sf_dir):
    c = quality.dedup(claims(spark, sf_dir))
    df = jn.investigate(
        c,
        providers(spark, sf_dir),
        sc.score_claims(c),
        since=F.lit("1999-01-01").cast("date"),
    )
    return result(df)


@query(
    "merged_feeds",
    with_claims(
        """, feeds AS (SELECT claim_id, amount_cents, sec, status, NULL AS op FROM claims WHERE status <> 'APPROVED'
  UNION ALL SELECT claim_id, amount_cents, sec, status, 'c' FROM claims WHERE status <> 'PENDING'),
best AS (SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY sec DESC, amount_cents DESC, op DESC NULLS LAST, status DESC) AS rn FROM feeds)
SELECT claim_id, amount_cents, sec AS event_sec, op, status FROM best WHERE rn = 1"""
    ),
)
def merged_feeds(spark, sf_dir):
    """A direct feed and a change feed with claims in common, one row per claim."""
    c = claims(spark, sf_dir).select("claim_id", "amount_cents", "event_time", "status")
    direct = c.filter("status <> 'APPROVED'")
    changed = c.filter("status <> 'PENDING'").withColumn("op", F.lit("c"))
    df = quality.dedup(jn.merge_feeds(direct, changed))
    event_sec = F.unix_seconds("event_time").alias("event_sec")
    return result(df, "claim_id", "amount_cents", event_sec, "op", "status")


def _tier_sql(col):
    return (
        f"CASE WHEN {col} >= 0.90 THEN 'CRITICAL' WHEN {col} >= 0.70 THEN 'HIGH'"
        f" WHEN {col} >= 0.40 THEN 'MEDIUM' ELSE 'LOW' END"
    )


@query(
    "champion_challenger",
    with_claims(
        SCORED_SQL
        + f""", strict AS (SELECT claim_id, points / 10000 AS champion, greatest(CASE WHEN avg_cents_30d > 0
    AND amount_cents > 2 * avg_cents_30d THEN 7800 ELSE 0 END, CASE WHEN amount_cents > 2000000 THEN 8800 ELSE 0 END, r3,
    CASE WHEN claim_count_30d > 100 THEN 6200 ELSE 0 END) / 10000 AS challenger FROM tiered)
SELECT {_tier_sql("champion")} AS champion_level, {_tier_sql("challenger")} AS challenger_level, count(*) AS n,
  round(avg(challenger - champion), 6) AS mean_delta FROM strict GROUP BY 1, 2"""
    ),
)
def champion_challenger(spark, sf_dir):
    """The usual thresholds against stricter ones."""
    profiled = sc.running_profiles(quality.dedup(claims(spark, sf_dir)))
    usual = sc.blend(sc.apply_rules(profiled))
    strict = sc.blend(sc.apply_rules(profiled, multiple=2, extreme_cents=2_000_000, volume=100))
    df = jn.agreement(jn.compare_scores(usual, strict), risk_tier)
    return result(df.withColumn("mean_delta", F.round("mean_delta", 6)))


@query(
    "gold_from_bronze",
    with_claims(
        MESSAGES
        + f""", best AS (SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY event_time DESC, amount_cents DESC,
    diagnosis_code DESC, substr(sha256(member_id), 1, 16) DESC, procedure_code DESC,
    substr(sha256(provider_npi), 1, 16) DESC, service_date DESC, status DESC) AS rn
  FROM messages WHERE {COMPLETE}), silver AS (SELECT * FROM best WHERE rn = 1)"""
        + CLAIM_VECTOR_SQL.replace("FROM claims", "FROM silver")
        + "\nSELECT * FROM claim_vectors"
    ),
)
def gold_from_bronze(spark, sf_dir):
    """Raw lines in a folder through silver to the gold claim vectors, all as tables."""
    bronze, silver_path = work_path(spark, "bronze"), work_path(spark, "silver")
    m = messages(spark, sf_dir).withColumns(
        {"year": F.substring("submitted_at", 1, 4), "month": F.lit("01"), "day": F.lit("01")}
    )
    lines = m.hint("rebalance", "year").write.partitionBy("year", "month", "day")
    lines.option("compression", "gzip").json(bronze)
    run_silver(spark, bronze, silver_path, RUN_DATE, RUN_TIME)
    made = run_gold(spark, silver_path, work_path(spark, "gold"), RUN_TIME)
    return result(made["claim_features"], *VECTOR)
