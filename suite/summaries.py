"""Reports, histograms, time windows, evaluation, drift and graph."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimsight.functions.codes import SCORING_BUCKETS
from claimsight.operators import evaluation as ev
from claimsight.operators import features as ft
from claimsight.operators import forest as fo
from claimsight.operators import graph as gr
from claimsight.operators import reports as rp
from claimsight.operators import scoring as sc
from claimsight.operators.models import FEATURES
from claimsight.session import materialize
from claimsight.streaming.flows import sliding_profiles
from suite.fixture import claims, result, table, with_claims
from suite.registry import query
from suite.scores import CLAIM_VECTOR_SQL, SCORED_SQL, claim_vectors, scored_claims


@query(
    "provider_summary",
    with_claims(
        """
SELECT provider_npi, count(*) AS total, max(amount_cents) AS max_cents,
  CAST((2 * sum(amount_cents) + count(*)) // (2 * count(*)) AS BIGINT) AS avg_cents FROM claims GROUP BY 1"""
    ),
)
def provider_summary(spark, sf_dir):
    return result(rp.provider_summary(claims(spark, sf_dir)))


@query(
    "rows_per_date",
    with_claims(
        "\nSELECT strftime(event_time, '%Y-%m-%d') AS event_date, count(*) AS n FROM claims GROUP BY 1"
    ),
)
def rows_per_date(spark, sf_dir):
    c = claims(spark, sf_dir).withColumn("event_date", F.to_date("event_time"))
    return result(rp.rows_per_date(c, "event_date"))


@query("claim_count", with_claims("\nSELECT count(*) AS n FROM claims"))
def claim_count(spark, sf_dir):
    return result(claims(spark, sf_dir).agg(F.count(F.lit(1)).alias("n")))


@query(
    "latest_claims",
    with_claims(
        """
SELECT claim_id, provider_npi, procedure_code, diagnosis_code, amount_cents, sec AS event_sec FROM claims
ORDER BY event_time DESC, claim_id, amount_cents LIMIT 5"""
    ),
)
def latest_claims(spark, sf_dir):
    return result(
        rp.latest(claims(spark, sf_dir), tie=("claim_id", "amount_cents")),
        "claim_id",
        "provider_npi",
        "procedure_code",
        "diagnosis_code",
        "amount_cents",
        F.unix_seconds("event_time").alias("event_sec"),
    )


@query(
    "deviating_claims",
    with_claims(
        CLAIM_VECTOR_SQL
        + """
SELECT claim_id, amount, avg_amount_30d, amount_ratio, claim_count_30d, hour_of_day, is_weekend FROM claim_vectors
WHERE amount_ratio > 3.0 ORDER BY amount_ratio DESC, claim_id, amount DESC LIMIT 10"""
    ),
)
def deviating_claims(spark, sf_dir):
    return result(
        rp.deviating_claims(claim_vectors(spark, sf_dir)),
        "claim_id",
        "amount",
        "avg_amount_30d",
        "amount_ratio",
        "claim_count_30d",
        "hour_of_day",
        "is_weekend",
    )


@query(
    "analyst_profile",
    with_claims(
        """
SELECT provider_npi, CAST(sum(amount_cents) AS BIGINT) / count(*) / 100 AS avg_claim, count(*) AS claim_count,
  count(DISTINCT member_id) AS unique_members, quantile_cont(amount_cents, 0.95) / 100 AS p95_amount
FROM claims GROUP BY 1 HAVING count(*) > 100 ORDER BY avg_claim DESC, provider_npi LIMIT 50"""
    ),
)
def analyst_profile(spark, sf_dir):
    return result(rp.analyst_profile(claims(spark, sf_dir)))


@query(
    "outcome_counts",
    with_claims(
        SCORED_SQL
        + """
SELECT CASE WHEN points >= 6500 THEN 'fraud' ELSE 'legitimate' END AS result, count(*) AS n FROM tiered GROUP BY 1"""
    ),
)
def outcome_counts(spark, sf_dir):
    return result(rp.outcome_counts(scored_claims(spark, sf_dir)))


@query(
    "risk_level_counts",
    with_claims(SCORED_SQL + "\nSELECT risk_level, count(*) AS n FROM tiered GROUP BY 1"),
)
def risk_level_counts(spark, sf_dir):
    return result(rp.risk_counts(scored_claims(spark, sf_dir)))


# Timings: the value column of the events as milliseconds.
def timings(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        "event_type",
        F.round(F.col("value") * 1000).cast("bigint").alias("micros"),
        (F.round(F.col("value") * 1000) / 1_000_000).alias("seconds"),
    )


TIMINGS_CTE = """timings AS (SELECT ts, event_type, CAST(round(value * 1000) AS BIGINT) AS micros,
  round(value * 1000) / 1000000 AS seconds FROM events)"""
BOUNDS = ", ".join(f"({i}, '{b}', {b})" for i, b in enumerate(SCORING_BUCKETS))
HIST_CTE = f"""{TIMINGS_CTE}, bounds(bucket, le, bound) AS (VALUES {BOUNDS}, ({len(SCORING_BUCKETS)}, '+Inf', 'inf'::DOUBLE)),
hist AS (SELECT event_type, CAST(bucket AS BIGINT) AS bucket, le, CAST(bound AS DOUBLE) AS bound,
    count(*) FILTER (WHERE seconds <= CAST(bound AS DOUBLE)) AS cumulative
  FROM timings, bounds GROUP BY ALL)"""


@query(
    "latency_histogram",
    f"""WITH {HIST_CTE}, sums AS (SELECT event_type, CAST(sum(micros) AS BIGINT) AS sum_micros FROM timings GROUP BY 1)
SELECT event_type, bucket, le, cumulative, sum_micros FROM hist JOIN sums USING (event_type)""",
)
def latency_histogram(spark, sf_dir):
    t = timings(spark, sf_dir)
    h = rp.cumulative_histogram(t, "seconds", SCORING_BUCKETS, ["event_type"])
    sums = F.round(F.col("value_sum") * 1_000_000).cast("bigint").alias("sum_micros")
    return result(h, "event_type", "bucket", "le", "cumulative", sums)


@query(
    "histogram_quantiles",
    f"""WITH {HIST_CTE}, steps AS (SELECT *, coalesce(lag(bound) OVER w, 0.0) AS low, coalesce(lag(cumulative) OVER w, 0) AS below,
    max(cumulative) OVER (PARTITION BY event_type) AS total FROM hist WINDOW w AS (PARTITION BY event_type ORDER BY bucket)),
qs(quantile) AS (VALUES (0.5::DOUBLE), (0.95::DOUBLE), (0.99::DOUBLE))
SELECT event_type, quantile, round(CASE WHEN bound = 'inf'::DOUBLE THEN low
  ELSE low + (bound - low) * ((quantile * total - below) / (cumulative - below)) END, 9) AS value
FROM steps, qs WHERE cumulative >= quantile * total AND below < quantile * total""",
)
def histogram_quantiles(spark, sf_dir):
    t = timings(spark, sf_dir)
    h = rp.cumulative_histogram(t, "seconds", SCORING_BUCKETS, ["event_type"])
    q = rp.histogram_quantiles(h, ["event_type"], [0.5, 0.95, 0.99])
    return result(q.withColumn("value", F.round("value", 9)))


@query(
    "latency_quantiles",
    f"""WITH {TIMINGS_CTE}
SELECT strftime(time_bucket(INTERVAL 2 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
  quantile_cont(micros, 0.5) AS p50, quantile_cont(micros, 0.95) AS p95, quantile_cont(micros, 0.99) AS p99
FROM timings GROUP BY 1""",
)
def latency_quantiles(spark, sf_dir):
    return result(rp.latency_quantiles(timings(spark, sf_dir), "ts", "micros"))


@query(
    "throughput_per_minute",
    f"""WITH {TIMINGS_CTE}
SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
  CASE WHEN event_type = 'error' THEN 'fraud' ELSE 'legitimate' END AS result, count(*) AS n FROM timings GROUP BY ALL""",
)
def throughput_per_minute(spark, sf_dir):
    label = F.when(F.col("event_type") == "error", "fraud").otherwise("legitimate")
    return result(rp.throughput(timings(spark, sf_dir), "ts", label))


@query(
    "alerts_last_30_minutes",
    """WITH a AS (SELECT ts, CASE WHEN value >= 30 THEN 'CRITICAL' WHEN value >= 15 THEN 'HIGH' END AS risk_level FROM events),
x AS (SELECT date_trunc('minute', ts) - to_minutes(CAST(i AS BIGINT)) AS start, risk_level FROM a, range(30) t(i) WHERE risk_level IS NOT NULL)
SELECT strftime(start, '%Y-%m-%d %H:%M:%S') AS window_start, risk_level, count(*) AS n FROM x GROUP BY ALL""",
)
def alerts_last_30_minutes(spark, sf_dir):
    level = F.when(F.col("value") >= 30, "CRITICAL").when(F.col("value") >= 15, "HIGH")
    a = table(spark, sf_dir, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), level.alias("risk_level")
    )
    df = rp.sliding_counts(
        a.filter("risk_level IS NOT NULL"), "ts", "30 minutes", "1 minute", ["risk_level"]
    )
    return result(df)


@query(
    "short_sliding_windows",
    """WITH x AS (SELECT time_bucket(INTERVAL 10 MINUTE, ts) - to_minutes(CAST(10 * i AS BIGINT)) AS start, event_type FROM events, range(6) t(i))
SELECT strftime(start, '%Y-%m-%d %H:%M:%S') AS window_start, event_type, count(*) AS n FROM x GROUP BY ALL""",
)
def short_sliding_windows(spark, sf_dir):
    e = timings(spark, sf_dir)
    return result(rp.sliding_counts(e, "ts", "1 hour", "10 minutes", ["event_type"]))


@query(
    "sliding_provider_windows",
    with_claims(
        """, x AS (SELECT date_trunc('day', event_time) - to_days(CAST(i AS INT)) AS start, * FROM claims, range(30) t(i))
SELECT strftime(start, '%Y-%m-%d') AS window_start, provider_npi, count(*) AS claim_count,
  CAST(sum(amount_cents) AS BIGINT) AS total_cents, max(amount_cents) AS max_cents FROM x GROUP BY ALL"""
    ),
)
def sliding_provider_windows(spark, sf_dir):
    df = sliding_profiles(claims(spark, sf_dir))
    day = F.date_format("window_start", "yyyy-MM-dd").alias("window_start")
    return result(df, day, "provider_npi", "claim_count", "total_cents", "max_cents")


@query(
    "alert_rollup",
    with_claims(
        SCORED_SQL
        + """, fired AS (SELECT unnest(string_split(triggered_rules, ',')) AS rule, provider_npi,
    strftime(event_time, '%Y-%m') AS period, amount_cents FROM tiered WHERE points >= 6500)
SELECT CASE WHEN grouping(rule) = 1 THEN 'ALL' ELSE rule END AS rule,
  CASE WHEN grouping(provider_npi) = 1 THEN 'ALL' ELSE provider_npi END AS provider_npi,
  CASE WHEN grouping(period) = 1 THEN 'ALL' ELSE period END AS period, count(*) AS alerts,
  CAST(sum(amount_cents) AS BIGINT) AS amount_cents
FROM fired GROUP BY ROLLUP (rule, provider_npi, period)"""
    ),
)
def alert_rollup(spark, sf_dir):
    return result(rp.alert_rollup(sc.above_threshold(scored_claims(spark, sf_dir))))


@query(
    "score_distribution",
    with_claims(
        SCORED_SQL
        + """
SELECT risk_level, CAST(least(points // 500, 19) AS BIGINT) AS bucket, count(*) AS n FROM tiered GROUP BY ALL"""
    ),
)
def score_distribution(spark, sf_dir):
    return result(rp.score_distribution(scored_claims(spark, sf_dir)))


@query(
    "monthly_report",
    with_claims(
        SCORED_SQL
        + """
SELECT strftime(event_time, '%Y-%m') AS month, count(*) AS claims, CAST(sum(amount_cents) AS BIGINT) AS amount_cents,
  count(*) FILTER (WHERE status = 'REJECTED') AS denied, count(*) FILTER (WHERE points >= 6500) AS flagged
FROM tiered GROUP BY 1"""
    ),
)
def monthly_report(spark, sf_dir):
    return result(rp.monthly_report(scored_claims(spark, sf_dir)))


PSI_FEATURES = ["amount_cents", "claim_count_30d", "member_claim_count_90d", "hour_of_day"]
EDGES = ", ".join(f"quantile_cont(v, {i / 10}) AS e{i}" for i in range(1, 10))
BIN = " + ".join(f"CAST(v > e{i} AS INT)" for i in range(1, 10))


@query(
    "feature_drift",
    with_claims(
        SCORED_SQL
        + f""", split AS (SELECT *, CAST(hour(event_time) AS BIGINT) AS hour_of_day,
    CASE WHEN sec <= (SELECT quantile_cont(sec, 0.5) FROM tiered) THEN 'baseline' ELSE 'current' END AS side FROM tiered),
long AS (UNPIVOT (SELECT side, {", ".join(PSI_FEATURES)} FROM split) ON {", ".join(PSI_FEATURES)} INTO NAME feature VALUE v),
edges AS (SELECT feature, {EDGES} FROM long WHERE side = 'baseline' GROUP BY feature),
bins AS (SELECT feature, {BIN} AS bin, count(*) FILTER (WHERE side = 'baseline') AS b, count(*) FILTER (WHERE side = 'current') AS c
  FROM long JOIN edges USING (feature) GROUP BY ALL),
shares AS (SELECT feature, greatest(b / sum(b) OVER w, 0.0001) AS p, greatest(c / sum(c) OVER w, 0.0001) AS q
  FROM bins WINDOW w AS (PARTITION BY feature))
SELECT feature, round(sum((q - p) * ln(q / p)), 6) AS psi, CAST(sum((q - p) * ln(q / p)) > 0.2 AS BIGINT) AS drifted
FROM shares GROUP BY feature"""
    ),
)
def feature_drift(spark, sf_dir):
    """Features of the earlier half of the claims against the later half."""
    scored = scored_claims(spark, sf_dir).select("event_time", *PSI_FEATURES)
    df = ev.time_split(materialize(scored, "drift"), 0.5)
    psi = ev.population_stability(
        df.filter("is_train"), df.filter("NOT is_train"), PSI_FEATURES
    )
    return result(psi.withColumn("psi", F.round("psi", 6)))


# Label for the quality measures: the claim was rejected or its amount is extreme.
LABEL_SQL = "CASE WHEN status = 'REJECTED' OR amount_cents > 4000000 THEN 1 ELSE 0 END"


def labelled(spark, sf_dir):
    return scored_claims(spark, sf_dir).withColumn("label", F.expr(LABEL_SQL))


@query(
    "weekly_quality",
    with_claims(
        SCORED_SQL
        + f""", w AS (SELECT date_trunc('week', event_time) AS week, points >= 6500 AS f, {LABEL_SQL} = 1 AS l FROM tiered),
c AS (SELECT week, count(*) FILTER (WHERE f AND l) AS tp, count(*) FILTER (WHERE f AND NOT l) AS fp,
  count(*) FILTER (WHERE NOT f AND l) AS fn, count(*) FILTER (WHERE NOT f AND NOT l) AS tn FROM w GROUP BY 1)
SELECT strftime(week, '%Y-%m-%d') AS week, tp, fp, fn, tn, CASE WHEN fp + tn > 0 THEN fp / (fp + tn) END AS fp_rate,
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp) END AS precision, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) END AS recall FROM c"""
    ),
)
def weekly_quality(spark, sf_dir):
    flagged = F.when(F.col("fraud_points") >= 6500, 1).otherwise(0)
    df = ev.weekly_quality(labelled(spark, sf_dir).withColumn("flag", flagged), "flag", "label")
    return result(df.withColumn("week", F.date_format("week", "yyyy-MM-dd")))


COUNTS_SQL = f""", counts AS (SELECT points, count(*) FILTER (WHERE {LABEL_SQL} = 1) AS pos,
  count(*) FILTER (WHERE {LABEL_SQL} = 0) AS neg FROM tiered GROUP BY points)"""


@query(
    "ranking_quality",
    with_claims(
        SCORED_SQL
        + COUNTS_SQL
        + """, s AS (SELECT pos, neg, sum(pos) OVER d AS tp, sum(neg) OVER d AS fp, sum(pos) OVER () AS p, sum(neg) OVER () AS n
  FROM counts WINDOW d AS (ORDER BY points DESC))
SELECT CAST(sum(neg * (2 * tp - pos)) AS DOUBLE) / (2 * CAST(max(p) AS DOUBLE) * CAST(max(n) AS DOUBLE)) AS auc_roc,
  round(sum(pos * (CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE))) / CAST(max(p) AS DOUBLE), 9) AS average_precision FROM s"""
    ),
)
def ranking_quality(spark, sf_dir):
    q = ev.ranking_quality(ev.score_counts(labelled(spark, sf_dir)))
    return result(q.withColumn("average_precision", F.round("average_precision", 9)))


@query(
    "precision_at_top",
    with_claims(
        SCORED_SQL
        + COUNTS_SQL
        + """, s AS (SELECT pos, pos + neg AS size, CAST(sum(pos + neg) OVER (ORDER BY points DESC) AS BIGINT) AS upto,
    CAST(ceil(CAST(sum(pos + neg) OVER () AS BIGINT) * 0.1::DOUBLE) AS BIGINT) AS k FROM counts)
SELECT max(k) AS k, round(sum(pos * greatest(0, least(size, k - (upto - size))) / size) / max(k), 9) AS precision_at_k FROM s"""
    ),
)
def precision_at_top(spark, sf_dir):
    q = ev.precision_at(ev.score_counts(labelled(spark, sf_dir)))
    return result(q.withColumn("precision_at_k", F.round("precision_at_k", 9)))


@query(
    "stratified_split",
    with_claims(
        """, placed AS (SELECT status, claim_id, amount_cents, CAST('0x' || substr(md5(concat_ws('|', claim_id, CAST(amount_cents AS VARCHAR))), 1, 8) AS BIGINT) AS pos FROM claims),
cuts AS (SELECT status, quantile_cont(pos, 0.8) AS cut FROM placed GROUP BY 1)
SELECT claim_id, amount_cents, status, CAST(pos <= cut AS BIGINT) AS is_train FROM placed JOIN cuts USING (status)"""
    ),
)
def stratified_split(spark, sf_dir):
    key = ["claim_id", "amount_cents"]
    df = ev.stratified_split(claims(spark, sf_dir), "status", key)
    return result(df, "claim_id", "amount_cents", "status", "is_train")


@query(
    "time_split",
    with_claims(
        """
SELECT claim_id, sec AS event_sec, CAST(sec <= (SELECT quantile_cont(sec, 0.8) FROM claims) AS BIGINT) AS is_train FROM claims"""
    ),
)
def time_split(spark, sf_dir):
    df = ev.time_split(claims(spark, sf_dir))
    return result(df, "claim_id", F.unix_seconds("event_time").alias("event_sec"), "is_train")


@query(
    "amount_anomalies",
    with_claims(
        """, med AS (SELECT procedure_code, quantile_cont(amount_cents, 0.5) AS m FROM claims GROUP BY 1),
off AS (SELECT c.*, CAST(2 * amount_cents - 2 * m AS BIGINT) AS o FROM claims c JOIN med USING (procedure_code)),
mad AS (SELECT procedure_code, quantile_cont(abs(o), 0.5) AS d FROM off GROUP BY 1),
z AS (SELECT off.*, CASE WHEN d > 0 THEN CAST(floor(o * 674500.0::DOUBLE / d) AS BIGINT) ELSE 0 END AS z_micro FROM off JOIN mad USING (procedure_code))
SELECT claim_id, procedure_code, amount_cents, z_micro FROM z WHERE z_micro > (SELECT quantile_cont(z_micro, 0.95) FROM z)"""
    ),
)
def amount_anomalies(spark, sf_dir):
    df = ev.amount_anomalies(claims(spark, sf_dir)).filter("anomaly")
    return result(df, "claim_id", "procedure_code", "amount_cents", "z_micro")


@query("isolation_anomalies")
def isolation_anomalies(spark, sf_dir):
    """Claims that few random splits set apart, by all features of a claim (isolation forest)."""
    columns = [c for c in FEATURES if c != "is_weekend"]
    vectors = sc.model_inputs(sc.running_profiles(claims(spark, sf_dir)))
    vectors = vectors.withColumn("amount", F.col("amount_cents") / 100).select("claim_id", *columns)
    df = fo.isolation_anomalies(materialize(vectors, "vectors"), columns, ["claim_id"])
    return result(df.filter("anomaly"), "claim_id", "isolation_micro")


@query(
    "provider_risk_score",
    with_claims(
        SCORED_SQL
        + """, per AS (SELECT provider_npi, count(*) AS claims, count(DISTINCT procedure_code) AS procedures,
    CAST(count(*) FILTER (WHERE status = 'REJECTED') * 1000000 // count(*) AS BIGINT) AS denial_micro,
    CAST(count(*) FILTER (WHERE points >= 6500) * 1000000 // count(*) AS BIGINT) AS alert_micro FROM tiered GROUP BY 1)
SELECT provider_npi, claims, procedures, denial_micro, alert_micro,
  (percent_rank() OVER (ORDER BY claims) + percent_rank() OVER (ORDER BY procedures)
   + percent_rank() OVER (ORDER BY denial_micro) + percent_rank() OVER (ORDER BY alert_micro)) / 4 AS risk_score FROM per"""
    ),
)
def provider_risk_score(spark, sf_dir):
    kinds = scored_claims(spark, sf_dir).groupBy("provider_npi", "procedure_code").agg(
        F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("status") == "REJECTED", 1)).alias("denied"),
        F.count(F.when(F.col("fraud_points") >= 6500, 1)).alias("alerts"),
    )
    per = kinds.groupBy("provider_npi").agg(
        F.sum("n").alias("claims"),
        F.count("procedure_code").alias("procedures"),
        F.expr("sum(denied) * 1000000 div sum(n)").alias("denial_micro"),
        F.expr("sum(alerts) * 1000000 div sum(n)").alias("alert_micro"),
    )
    metrics = ["claims", "procedures", "denial_micro", "alert_micro"]
    df = ev.provider_risk(materialize(per, "metrics"), metrics)
    return result(df, "provider_npi", *metrics, "risk_score")


@query(
    "shared_member_links",
    with_claims(
        """, pairs AS (SELECT DISTINCT provider_npi, member_id FROM claims),
anchors AS (SELECT member_id, min(provider_npi) AS anchor FROM pairs GROUP BY 1)
SELECT anchor, provider_npi AS provider, count(*) AS shared_members FROM pairs JOIN anchors USING (member_id)
WHERE provider_npi > anchor GROUP BY ALL"""
    ),
)
def shared_member_links(spark, sf_dir):
    return result(gr.shared_member_links(claims(spark, sf_dir)))


@query(
    "shared_member_pairs",
    with_claims(
        """, pairs AS (SELECT DISTINCT provider_npi, member_id FROM claims)
SELECT x.provider_npi AS left, y.provider_npi AS right, count(*) AS shared_members FROM pairs x JOIN pairs y
  ON x.member_id = y.member_id AND x.provider_npi < y.provider_npi GROUP BY ALL HAVING count(*) >= 3"""
    ),
)
def shared_member_pairs(spark, sf_dir):
    """Pairs of providers with three or more members in common."""
    return result(gr.shared_member_pairs(claims(spark, sf_dir), 3))


# Communities: providers that billed the same member for the same day; the rest stand alone.
GROUPS = ["member_id", "service_date"]
COMMUNITY_SQL = """, pairs AS (SELECT DISTINCT provider_npi, member_id, service_date FROM claims),
edges AS (SELECT DISTINCT x.provider_npi AS a, y.provider_npi AS b FROM pairs x JOIN pairs y
  ON x.member_id = y.member_id AND x.service_date = y.service_date AND x.provider_npi <> y.provider_npi),
reach AS (SELECT DISTINCT provider_npi AS node, provider_npi AS label FROM pairs
  UNION SELECT e.b, r.label FROM reach r JOIN edges e ON e.a = r.node),
communities AS (SELECT node, min(label) AS community FROM reach GROUP BY node)"""


def communities(spark, sf_dir):
    links = gr.group_links(claims(spark, sf_dir), GROUPS)
    return gr.communities(links, "anchor", "provider")


@query(
    "provider_communities",
    with_claims(
        COMMUNITY_SQL
        + "\nSELECT node, community FROM communities WHERE node IN (SELECT a FROM edges)"
    ).replace("WITH claims", "WITH RECURSIVE claims"),
)
def provider_communities(spark, sf_dir):
    return result(communities(spark, sf_dir))


@query(
    "community_fraud_rate",
    with_claims(
        COMMUNITY_SQL
        + """
SELECT community, count(DISTINCT provider_npi) AS providers, count(*) AS claims,
  count(*) FILTER (WHERE amount_cents > 5000000) AS flagged, count(*) FILTER (WHERE amount_cents > 5000000) / count(*) AS fraud_rate
FROM claims JOIN communities ON provider_npi = node GROUP BY community"""
    ).replace("WITH claims", "WITH RECURSIVE claims"),
)
def community_fraud_rate(spark, sf_dir):
    flag = F.when(F.col("amount_cents") > 5_000_000, 1).otherwise(0)
    c = claims(spark, sf_dir).withColumn("flag", flag)
    return result(gr.community_rates(c, communities(spark, sf_dir), "flag"))
