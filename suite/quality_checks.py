"""Scans, cleaning, checks, privacy and table maintenance."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsight.functions import addresses
from claimsight.functions.codes import (
    CARDIAC_DIAGNOSES,
    ORTHOPAEDIC_PROCEDURES,
    in_both_sets,
)
from claimsight.functions.fields import composite_token, masked_token, token
from claimsight.operators import quality, tables
from claimsight.operators.versions import VersionedTable
from claimsight.plans.batch import silver
from claimsight.session import materialize, work_path
from claimsight.sources import changes as ch
from claimsight.sources import claims as src
from claimsight.sources import files
from suite.fixture import (
    MEMBERS_CTE,
    MESSAGES_CTE,
    PROVIDERS_CTE,
    as_text_messages,
    claims,
    members,
    providers,
    result,
    table,
    tokenized,
    with_claims,
)
from suite.registry import query

RUN_DATE = date(2001, 8, 2)
RUN_TIME = datetime(2001, 8, 2, 2, 0, 0)
MESSAGES = ", " + MESSAGES_CTE
COMPLETE = (
    "claim_id IS NOT NULL AND member_id IS NOT NULL AND provider_npi IS NOT NULL"
    " AND amount_cents IS NOT NULL"
)


def messages(spark, sf_dir):
    return as_text_messages(claims(spark, sf_dir))


@query(
    "read_bronze",
    with_claims(
        MESSAGES
        + """
SELECT claim_id, member_id, amount_cents, strftime(service_date, '%Y-%m-%d') AS service_date,
  strftime(event_time, '%Y-%m-%dT%H:%M:%S') AS submitted_at,
  strftime(event_time, '%Y') AS year, strftime(event_time, '%m') AS month FROM messages"""
    ),
)
def read_bronze(spark, sf_dir):
    """Claims written as JSON lines below date folders and read back."""
    m = messages(spark, sf_dir)
    at = F.try_to_timestamp("submitted_at")
    root = work_path(spark, "bronze")
    (
        m.withColumns(
            {
                "year": F.date_format(at, "yyyy"),
                "month": F.date_format(at, "MM"),
                "day": F.lit("01"),
            }
        )
        .hint("rebalance", "year", "month")
        .write.partitionBy("year", "month", "day")
        .option("compression", "gzip")
        .json(root)
    )
    df = src.read_bronze(spark, root)
    cents = F.round(F.col("amount") * 100).cast("bigint").alias("amount_cents")
    return result(
        df, "claim_id", "member_id", cents, "service_date", "submitted_at", "year", "month"
    )


@query(
    "write_and_read_table",
    with_claims(
        """
SELECT substr(sha256(member_id), 1, 16) AS member_id_token, amount_cents,
  strftime(event_time, '%Y-%m') AS month FROM claims"""
    ),
)
def write_and_read_table(spark, sf_dir):
    df = tokenized(claims(spark, sf_dir)).select(
        "member_id_token", "amount_cents", F.date_format("event_time", "yyyy-MM").alias("month")
    )
    stored = tables.write_table(df, work_path(spark, "table"), ["month"])
    return result(stored)


@query(
    "drop_malformed",
    with_claims(MESSAGES + f"\nSELECT claim_id, amount_cents FROM messages WHERE {COMPLETE}"),
)
def drop_malformed(spark, sf_dir):
    df = quality.drop_malformed(messages(spark, sf_dir))
    return result(df, "claim_id", (F.col("amount") * 100).cast("bigint").alias("amount_cents"))


@query(
    "malformed_report",
    with_claims(
        MESSAGES
        + f"""
SELECT count(*) AS rows_read, count(*) FILTER (WHERE {COMPLETE}) AS rows_kept,
  count(*) FILTER (WHERE NOT ({COMPLETE})) AS rows_dropped,
  count(*) FILTER (WHERE claim_id IS NULL) AS missing_claim_id,
  count(*) FILTER (WHERE member_id IS NULL) AS missing_member_id,
  count(*) FILTER (WHERE provider_npi IS NULL) AS missing_provider_npi,
  count(*) FILTER (WHERE amount_cents IS NULL) AS missing_amount FROM messages"""
    ),
)
def malformed_report(spark, sf_dir):
    return result(quality.malformed_report(messages(spark, sf_dir)))


@query(
    "normalize_event_time",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN NULL
  ELSE CAST(floor(epoch(ts)) AS BIGINT) END AS event_sec FROM events""",
)
def normalize_event_time(spark, sf_dir):
    """Times as text; the text of errors is unreadable."""
    e = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.concat(F.lit("at "), F.col("ts").cast("string")))
        .otherwise(F.col("ts").cast("string"))
        .alias("submitted_at"),
    )
    df = quality.normalize_event_time(e)
    return result(df, "event_id", F.unix_seconds("event_time").alias("event_sec"))


@query(
    "tokenize",
    with_claims(
        """
SELECT claim_id, substr(sha256(member_id), 1, 16) AS member_id_token,
  substr(sha256(provider_npi), 1, 16) AS provider_npi_token, amount_cents FROM claims"""
    ),
)
def tokenize(spark, sf_dir):
    df = tokenized(claims(spark, sf_dir))
    return result(df, "claim_id", "member_id_token", "provider_npi_token", "amount_cents")


@query(
    "composite_and_masked_tokens",
    """SELECT c_custkey, sha256(concat_ws('|', c_name, NULLIF(c_mktsegment, 'MACHINERY'))) AS subject_token,
  'TKN-' || substr(sha256(c_name), 1, 6) AS name_token FROM customer""",
)
def composite_and_masked_tokens(spark, sf_dir):
    segment = F.when(F.col("c_mktsegment") != "MACHINERY", F.col("c_mktsegment"))
    return result(
        table(spark, sf_dir, "customer"),
        "c_custkey",
        composite_token("c_name", segment).alias("subject_token"),
        masked_token("c_name").alias("name_token"),
    )


RESTRICTED = """
SELECT c_custkey, c_mktsegment AS plan_id FROM customer"""


@query("restricted_view", RESTRICTED)
def restricted_view(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(
        "c_custkey", F.col("c_name").alias("name"), F.col("c_mktsegment").alias("plan_id")
    )
    return result(quality.restricted_view(c, authorised=False))


@query(
    "stamped_claims",
    with_claims(
        """
SELECT claim_id, '2001-08-02' AS processing_date, '2001-08-02 02:00:00' AS ingested_at,
  strftime(date_trunc('month', event_time), '%Y-%m-%d') AS month FROM claims"""
    ),
)
def stamped_claims(spark, sf_dir):
    c = quality.month_of(claims(spark, sf_dir)).withColumn("_trace", F.lit(1))
    df = quality.stamp(quality.strip_internal(c), RUN_DATE, RUN_TIME, "ingested_at")
    return result(df, "claim_id", "processing_date", "ingested_at", "month")


@query(
    "audit_stamp",
    with_claims(
        f"""
SELECT claim_id, 'core_claims' AS source_system, 'claims-feed-v1' AS connector_id,
  '{RUN_TIME:%Y-%m-%d %H:%M:%S}' AS extracted_at, 'claims.v3' AS schema_version, CAST(0 AS BIGINT) AS phi_tokenized,
  (SELECT count(*) FROM claims) AS record_count, CAST(36 AS BIGINT) AS id_chars FROM claims"""
    ),
)
def audit_stamp(spark, sf_dir):
    df = quality.audit_stamp(
        claims(spark, sf_dir).select("claim_id"),
        source_system="core_claims",
        connector_id="claims-feed-v1",
        extracted_at=RUN_TIME,
        schema_version="claims.v3",
        phi_tokenized=False,
    )
    return result(df.withColumn("id_chars", F.length("event_id")).drop("event_id"))


@query(
    "valid_json",
    """WITH lines AS (SELECT event_id, CASE WHEN event_type = 'error' THEN substr(props, 1, 3) ELSE props END AS value FROM events)
SELECT CASE WHEN json_valid(value) THEN 'kept' ELSE 'skipped' END AS outcome, count(*) AS n,
  CAST(sum(event_id) AS BIGINT) AS id_sum FROM lines GROUP BY 1""",
)
def valid_json(spark, sf_dir):
    """Lines of event properties; those of errors are cut off."""
    e = table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.substring("props", 1, 3))
        .otherwise(F.col("props"))
        .alias("value"),
    )
    kind = F.when(src.is_json(F.col("value")), "kept").otherwise("skipped").alias("outcome")
    return result(
        e.groupBy(kind).agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("id_sum"))
    )


@query(
    "parse_claim_lines",
    with_claims(
        MESSAGES
        + """
SELECT claim_id, provider_npi, member_id, amount_cents, strftime(event_time, '%Y-%m-%dT%H:%M:%S') AS submitted_at
FROM messages WHERE status <> 'PENDING'"""
    ),
)
def parse_claim_lines(spark, sf_dir):
    """JSON lines of claims; those of pending claims lose their closing brace."""
    m = messages(spark, sf_dir)
    line = F.to_json(F.struct(*m.columns))
    cut = F.when(F.col("status") == "PENDING", F.expr("left(value, length(value) - 1)"))
    lines = m.select(line.alias("value"), "status").select(
        F.coalesce(cut, F.col("value")).alias("value")
    )
    good, _ = quality.split_parsed(src.parse_lines(lines))
    cents = F.round(F.col("amount") * 100).cast("bigint").alias("amount_cents")
    return result(good, "claim_id", "provider_npi", "member_id", cents, "submitted_at")


@query(
    "positive_amount",
    with_claims("\nSELECT claim_id, amount_cents FROM claims WHERE amount_cents > 0"),
)
def positive_amount(spark, sf_dir):
    return result(
        quality.positive_amount(claims(spark, sf_dir)), "claim_id", "amount_cents"
    )


@query(
    "code_in_set",
    with_claims(
        """
SELECT claim_id, procedure_code, diagnosis_code FROM claims
WHERE procedure_code IN ('27447', '29827', '29881', '27130')
  AND diagnosis_code IN ('I10', 'I25.10', 'I48.0', 'I50.9')"""
    ),
)
def code_in_set(spark, sf_dir):
    hit = in_both_sets(
        F.col("procedure_code"),
        ORTHOPAEDIC_PROCEDURES,
        F.col("diagnosis_code"),
        CARDIAC_DIAGNOSES,
    )
    return result(
        claims(spark, sf_dir).filter(hit), "claim_id", "procedure_code", "diagnosis_code"
    )


DEDUP_CTE = """, deduped AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY
    event_time DESC, amount_cents DESC, diagnosis_code DESC, member_id DESC, procedure_code DESC,
    provider_npi DESC, service_date DESC, status DESC) AS rn FROM claims) WHERE rn = 1)"""


@query(
    "dedup_claims",
    with_claims(
        DEDUP_CTE
        + """
SELECT claim_id, provider_npi, member_id, procedure_code, diagnosis_code, amount_cents, sec AS event_sec, status FROM deduped"""
    ),
)
def dedup_claims(spark, sf_dir):
    return result(
        quality.dedup(claims(spark, sf_dir)),
        "claim_id",
        "provider_npi",
        "member_id",
        "procedure_code",
        "diagnosis_code",
        "amount_cents",
        F.unix_seconds("event_time").alias("event_sec"),
        "status",
    )


@query(
    "missing_providers",
    with_claims(
        f""", {PROVIDERS_CTE}
SELECT claim_id, provider_npi, amount_cents FROM claims WHERE provider_npi NOT IN (SELECT npi FROM providers)"""
    ),
)
def missing_providers(spark, sf_dir):
    df = quality.missing_reference(
        claims(spark, sf_dir), providers(spark, sf_dir), "provider_npi", "npi"
    )
    return result(df, "claim_id", "provider_npi", "amount_cents")


@query(
    "repeated_claim_ids",
    with_claims("\nSELECT claim_id, count(*) AS n FROM claims GROUP BY 1 HAVING count(*) > 1"),
)
def repeated_claim_ids(spark, sf_dir):
    return result(quality.repeated_keys(claims(spark, sf_dir)))


@query(
    "silver_claims",
    with_claims(
        MESSAGES
        + f""", best AS (SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY event_time DESC, amount_cents DESC,
    diagnosis_code DESC, substr(sha256(member_id), 1, 16) DESC, procedure_code DESC,
    substr(sha256(provider_npi), 1, 16) DESC, service_date DESC, status DESC) AS rn
  FROM messages WHERE {COMPLETE})
SELECT claim_id, procedure_code, diagnosis_code, amount_cents / 100 AS amount,
  strftime(service_date, '%Y-%m-%d') AS service_date, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time,
  status, substr(sha256(member_id), 1, 16) AS member_id_token,
  substr(sha256(provider_npi), 1, 16) AS provider_npi_token,
  strftime(event_time, '%Y-%m-%d') AS event_date, '2001-08-02' AS processing_date,
  '2001-08-02 02:00:00' AS ingested_at FROM best WHERE rn = 1"""
    ),
)
def silver_claims(spark, sf_dir):
    clean, _ = silver(messages(spark, sf_dir), RUN_DATE, RUN_TIME)
    return result(clean.drop("amount_cents", "submitted_at"))


# Change feed: every claim is created pending, gets its final status a day
# later if it has one, and is deleted two days later if its amount is zero.
CHANGES_CTE = DEDUP_CTE + """,
changes AS (
SELECT claim_id, member_id, amount_cents, 'PENDING' AS status, 'c' AS op, sec * 1000 AS ts_ms, 0 AS stage FROM deduped
UNION ALL SELECT claim_id, member_id, amount_cents, status, 'u', (sec + 86400) * 1000, 1 FROM deduped WHERE status <> 'PENDING'
UNION ALL SELECT claim_id, member_id, amount_cents, status, 'd', (sec + 2 * 86400) * 1000, 2 FROM deduped WHERE amount_cents = 0)"""


def change_lines(spark, sf_dir):
    """The change feed as JSON: creates flat, later changes in envelopes."""
    c = quality.dedup(claims(spark, sf_dir)).withColumn(
        "ms", F.unix_seconds("event_time") * 1000
    )
    row = lambda status: F.struct(
        F.lit(None).cast("bigint").alias("id"),
        "claim_id",
        "provider_npi",
        "member_id",
        "procedure_code",
        "diagnosis_code",
        F.format_string("%.2f", F.col("amount_cents") / 100).alias("amount"),
        F.col("service_date").cast("string").alias("service_date"),
        F.col("event_time").cast("string").alias("submitted_at"),
        status.alias("status"),
    )
    none = F.lit(None).cast(ch.CLAIM_ROW)
    flat = row(F.lit("PENDING"))
    final = row(F.col("status"))
    created = F.to_json(
        F.struct(
            *[flat[f.name].alias(f.name) for f in ch.CLAIM_ROW.fields],
            F.lit("c").alias("__op"),
            F.col("ms").alias("__ts_ms"),
        )
    )
    updated = F.to_json(
        F.struct(
            row(F.lit("PENDING")).alias("before"),
            final.alias("after"),
            F.lit("u").alias("op"),
            (F.col("ms") + 86_400_000).alias("ts_ms"),
        )
    )
    deleted = F.to_json(
        F.struct(
            final.alias("before"),
            none.alias("after"),
            F.lit("d").alias("op"),
            (F.col("ms") + 2 * 86_400_000).alias("ts_ms"),
        )
    )
    # All lines of a claim in one pass; a delete is followed by a tombstone.
    line = lambda text: F.struct(text.alias("value"))
    gone = F.col("amount_cents") == 0
    lines = F.array(
        line(created),
        F.when(F.col("status") != "PENDING", line(updated)),
        F.when(gone, line(deleted)),
        F.when(gone, line(F.lit(None).cast("string"))),
    )
    present = F.filter(lines, lambda x: x.isNotNull())
    return c.select(F.explode(present).alias("line")).select("line.value")


def changes(spark, sf_dir):
    return ch.read_changes(change_lines(spark, sf_dir))


def amount_cents():
    return F.round(F.col("amount").cast("double") * 100).cast("bigint").alias("amount_cents")


@query(
    "read_changes",
    with_claims(
        CHANGES_CTE + "\nSELECT claim_id, member_id, amount_cents, status, op, ts_ms FROM changes"
    ),
)
def read_changes(spark, sf_dir):
    return result(
        changes(spark, sf_dir), "claim_id", "member_id", amount_cents(), "status", "op", "ts_ms"
    )



def _state_sql(condition):
    return with_claims(
        CHANGES_CTE
        + f""", last AS (SELECT *, row_number() OVER (PARTITION BY claim_id ORDER BY ts_ms DESC, stage DESC) AS rn
  FROM changes WHERE {condition})
SELECT claim_id, member_id, amount_cents, status FROM last WHERE rn = 1 AND op <> 'd'"""
    )


@query("state_as_of", _state_sql("ts_ms <= CAST(epoch(TIMESTAMP '1998-07-01') AS BIGINT) * 1000"))
def state_as_of(spark, sf_dir):
    moment = F.unix_seconds(F.lit("1998-07-01").cast("timestamp")) * 1000
    df = ch.state_as_of(changes(spark, sf_dir), moment)
    return result(df, "claim_id", "member_id", amount_cents(), "status")


@query("apply_changes", _state_sql("true"))
def apply_changes(spark, sf_dir):
    """The state of mid 1998 brought up to date by all later changes."""
    feed = changes(spark, sf_dir)
    moment = F.unix_seconds(F.lit("1998-07-01").cast("timestamp")) * 1000
    base = ch.state_as_of(feed, moment)
    df = ch.apply_changes(base, feed.filter(F.col("ts_ms") > moment))
    return result(df, "claim_id", "member_id", amount_cents(), "status")


@query(
    "insert_ignore",
    with_claims(
        """, firsts AS (SELECT DISTINCT provider_npi FROM claims WHERE sec < 883612800)
SELECT provider_npi, min(procedure_code) AS procedure_code FROM claims
WHERE provider_npi NOT IN (SELECT provider_npi FROM firsts WHERE provider_npi = 'NPI-005')
GROUP BY provider_npi"""
    ),
)
def insert_ignore(spark, sf_dir):
    """Providers to add to a catalogue that knows only the hot one."""
    c = claims(spark, sf_dir)
    known = c.filter("provider_npi = 'NPI-005' AND event_time < '1998-01-01'")
    new = c.select("provider_npi", "procedure_code")
    target = known.select("provider_npi").distinct()
    return result(tables.insert_ignore(target, new, "provider_npi"))


@query(
    "erase_subjects",
    with_claims(
        f""", {MEMBERS_CTE}
SELECT claim_id, substr(sha256(member_id), 1, 16) AS member_id_token, amount_cents FROM claims
WHERE member_id NOT IN (SELECT member_id FROM members WHERE status = 'INACTIVE')"""
    ),
)
def erase_subjects(spark, sf_dir):
    """Inactive members ask for erasure."""
    gone = members(spark, sf_dir).filter("status = 'INACTIVE'")
    tokens = gone.select(token("member_id").alias("member_id_token"))
    df = tables.erase_subjects(tokenized(claims(spark, sf_dir)), tokens, "member_id_token")
    return result(df, "claim_id", "member_id_token", "amount_cents")


@query(
    "unexpired_claims",
    with_claims(
        """
SELECT claim_id, sec AS event_sec FROM claims
WHERE CAST(event_time AS DATE) >= DATE '2003-06-30' - INTERVAL 7 YEAR"""
    ),
)
def unexpired_claims(spark, sf_dir):
    c = claims(spark, sf_dir).withColumn("event_date", F.to_date("event_time"))
    df = tables.unexpired(c, date(2003, 6, 30))
    return result(df, "claim_id", F.unix_seconds("event_time").alias("event_sec"))


@query(
    "compact_table",
    with_claims(
        """
SELECT claim_id, provider_npi, member_id, procedure_code, diagnosis_code, amount_cents, status,
  strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, strftime(event_time, '%Y') AS year FROM claims"""
    ),
)
def compact_table(spark, sf_dir):
    """Three appends leave small files per year; they are merged, all rows are read back."""
    cols = "claim_id provider_npi member_id procedure_code diagnosis_code amount_cents status event_time".split()
    year = F.date_format("event_time", "yyyy").alias("year")
    c = claims(spark, sf_dir).select(*cols, year)
    t = VersionedTable(spark, work_path(spark, "compact"), "year")
    for k in range(3):
        t.append(c.filter(F.pmod(F.xxhash64("claim_id"), F.lit(3)) == k))
    t.compact()
    t.clean()
    return result(t.read())


def change_table(spark, sf_dir):
    """Changes with the month of the service date, the partition of the tables below."""
    return changes(spark, sf_dir).withColumn("month", F.substring("service_date", 1, 7))


@query("merged_table", _state_sql("true"))
def merged_table(spark, sf_dir):
    """Changes up to mid 1998, later ones in two parts, each merged into the table."""
    feed = materialize(change_table(spark, sf_dir), "feed")
    cuts = [F.unix_seconds(F.lit(d).cast("timestamp")) * 1000 for d in ("1998-07-01", "2000-01-01")]
    t = VersionedTable(spark, work_path(spark, "merged"), "month")
    t.merge_changes(feed.filter(F.col("ts_ms") <= cuts[0]), "claim_id")
    t.merge_changes(feed.filter((F.col("ts_ms") > cuts[0]) & (F.col("ts_ms") <= cuts[1])), "claim_id")
    t.merge_changes(feed.filter(F.col("ts_ms") > cuts[1]), "claim_id")
    t.clean()
    return result(t.read(), "claim_id", "member_id", amount_cents(), "status")


@query(
    "insert_ignored_table",
    with_claims(
        """, turns AS (SELECT *, CASE WHEN sec < 946684800 THEN 0 ELSE 1 END AS turn FROM claims),
firsts AS (SELECT claim_id, min(turn) AS turn FROM turns GROUP BY claim_id)
SELECT t.claim_id, strftime(min(event_time), '%Y') AS year, min(t.turn)::BIGINT AS turn
FROM turns t JOIN firsts f ON t.claim_id = f.claim_id AND t.turn = f.turn GROUP BY t.claim_id"""
    ),
)
def insert_ignored_table(spark, sf_dir):
    """Claims of two turns; ids that the table has are left alone, also when a turn repeats."""
    rows = claims(spark, sf_dir).select(
        "claim_id",
        F.date_format("event_time", "yyyy").alias("year"),
        F.when(F.col("event_time") < "2000-01-01", 0).otherwise(1).cast("bigint").alias("turn"),
    )
    t = VersionedTable(spark, work_path(spark, "ignored"), "year")
    for turn in (0, 1, 0):
        t.insert_ignore(rows.filter(F.col("turn") == turn), "claim_id")
    return result(t.read())


@query(
    "expired_table",
    with_claims(
        """
SELECT claim_id, strftime(event_time, '%Y-%m-%d') AS event_date, amount_cents FROM claims
WHERE CAST(event_time AS DATE) >= DATE '2003-06-30' - INTERVAL 7 YEAR"""
    ),
)
def expired_table(spark, sf_dir):
    """Days beyond the retention time are dropped from the table."""
    rows = claims(spark, sf_dir).select(
        "claim_id", "amount_cents", F.to_date("event_time").alias("event_date")
    )
    t = VersionedTable(spark, work_path(spark, "expired"), "event_date")
    t.append(rows)
    t.expire(date(2003, 6, 30))
    t.clean()
    return result(t.read())


@query(
    "snapshot_as_of",
    with_claims(
        """
SELECT provider_npi, count(*) AS n FROM claims WHERE event_time < TIMESTAMP '1998-01-01' GROUP BY 1"""
    ),
)
def snapshot_as_of(spark, sf_dir):
    """Yearly snapshots of the table; read as it was in mid 1998."""
    c = claims(spark, sf_dir).select("provider_npi", "claim_id", "event_time")
    root = work_path(spark, "snapshots")
    for year in (1997, 1998, 1999):
        day = datetime(year, 1, 1)
        tables.snapshot_write(c.filter(F.col("event_time") < F.lit(day)), root, day)
    df = tables.snapshot_as_of(spark, root, datetime(1998, 6, 30))
    return result(df.groupBy("provider_npi").agg(F.count(F.lit(1)).alias("n")))


@query(
    "json_logs",
    """SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS log_sec,
  CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(1 AS BIGINT) AS parsed FROM events""",
)
def json_logs(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("at"), F.col("props").alias("message")
    )
    schema = T.StructType([T.StructField("k", T.LongType())])
    return result(
        files.parse_json_logs(e, schema, at="at"), "event_id", "log_sec", "k", "parsed"
    )

AGENTS = [
    "Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36",
    "Mozilla/5.0 (Windows NT 10.0; Win64; x64; rv:121.0) Gecko/20100101 Firefox/121.0",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 17_1 like Mac OS X) AppleWebKit/605.1 (KHTML, like Gecko) Version/17.1 Mobile/15E148 Safari/604.1",
    "curl/8.5.0",
]


def addressed_logs(spark, sf_dir):
    """Events as log lines whose message holds an address, in six ways to write one, and an agent."""
    e = table(spark, sf_dir, "events").withColumns(
        {"u": F.expr("CAST(user_id % 256 AS INT)"), "e": F.expr("CAST(event_id % 256 AS INT)")}
    )
    last = F.format_string("10.%d.0.%d", "u", "e")
    ways = [
        last,
        F.concat(last, F.lit(":443")),
        F.format_string("fd00:%X::%x", "u", "e"),
        F.format_string("[2001:db8::%x:%x]:8080", "u", "e"),
        F.concat(F.lit("::ffff:"), last),
        F.format_string("300.%d.0.%d", "u", "e"),
    ]
    client = F.get(F.array(*ways), F.expr("CAST(event_id % 6 AS INT)"))
    agent = F.get(F.array(*map(F.lit, AGENTS)), F.expr("CAST(user_id % 5 AS INT)"))
    message = F.to_json(F.struct(client.alias("client"), agent.alias("agent")))
    return e.select("event_id", F.col("ts").cast("timestamp").alias("at"), message.alias("message"))


@query(
    "normalized_logs",
    """WITH e AS (SELECT event_id, event_id % 6 AS way, user_id % 5 AS who, user_id % 256 AS u, event_id % 256 AS b,
  CAST(floor(epoch(ts)) AS BIGINT) AS log_sec FROM events)
SELECT event_id, log_sec,
  CASE WHEN way IN (0, 1, 4) THEN repeat('0', 20) || printf('ffff0a%02x00%02x', u, b)
       WHEN way = 2 THEN printf('fd00%04x', u) || repeat('0', 20) || printf('%04x', b)
       WHEN way = 3 THEN '20010db8' || repeat('0', 16) || printf('%04x%04x', u, b) END AS address_digits,
  CASE WHEN way IN (0, 1, 4) THEN coalesce(n_name, r_name) WHEN way = 2 THEN r_name WHEN way = 3 THEN 'EXAMPLE' END AS network,
  CASE who WHEN 0 THEN 'chrome' WHEN 1 THEN 'firefox' WHEN 2 THEN 'safari' WHEN 3 THEN 'curl' END AS agent_family,
  CAST(CASE who WHEN 0 THEN 120 WHEN 1 THEN 121 WHEN 2 THEN 17 WHEN 3 THEN 8 END AS BIGINT) AS agent_major,
  CASE who WHEN 0 THEN 'linux' WHEN 1 THEN 'windows' WHEN 2 THEN 'ios' WHEN 3 THEN 'other' END AS agent_platform
FROM e LEFT JOIN nation ON n_nationkey = u LEFT JOIN region ON r_regionkey = u // 16""",
)
def normalized_logs(spark, sf_dir):
    """Log lines with normalised time, address and agent, and the network of the address.

    A nation owns a /16 inside its part of a region's /12, so the smaller network must win.
    """
    schema = T.StructType([T.StructField("client", T.StringType()), T.StructField("agent", T.StringType())])
    logs = files.parse_json_logs(addressed_logs(spark, sf_dir), schema, at="at", address="client", agent="agent")
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    block = F.expr("CAST(r_regionkey * 16 AS INT)")
    owners = [
        n.select(F.format_string("10.%d.0.0/16", F.col("n_nationkey").cast("int")).alias("cidr"), F.col("n_name").alias("network")),
        r.select(F.format_string("10.%d.0.0/12", block).alias("cidr"), F.col("r_name").alias("network")),
        r.select(F.format_string("fd00:%x::/28", block).alias("cidr"), F.col("r_name").alias("network")),
        r.agg(F.lit("2001:db8::/32").alias("cidr"), F.lit("EXAMPLE").alias("network")),
    ]
    networks = reduce(DataFrame.unionByName, owners)
    found = addresses.with_network(logs, "address_digits", networks, "cidr", ["network"])
    columns = "event_id log_sec address_digits network agent_family agent_major agent_platform".split()
    return result(found, *columns)


@query(
    "map_segments",
    with_claims(
        """
SELECT claim_id, provider_npi, CASE WHEN status <> 'PENDING' THEN amount_cents / 100 END AS amount,
  concat_ws(',', diagnosis_code, procedure_code) AS icd10_codes,
  CASE WHEN status <> 'PENDING' THEN CAST(1 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS mapped FROM claims"""
    ),
)
def map_segments(spark, sf_dir):
    """Claims as segments; pending ones carry an amount that is no number."""
    code = lambda c: F.struct(F.col(c).alias("HI01"))
    text = F.format_string("%.2f", F.col("amount_cents") / 100)
    segments = claims(spark, sf_dir).select(
        F.col("claim_id").alias("CLM01"),
        F.col("provider_npi").alias("NM109"),
        F.when(F.col("status") != "PENDING", text).otherwise("n/a").alias("CLM02"),
        F.array(code("diagnosis_code"), code("procedure_code")).alias("HI"),
    )
    df = files.map_segments(segments, F.lit(RUN_TIME))
    return result(df, "claim_id", "provider_npi", "amount", "icd10_codes", "mapped")


@query(
    "media_manifest",
    """SELECT 'documents/' || source || '/' || doc_id || '.txt' AS path, 'document' AS kind,
  CAST(octet_length(encode(text)) AS BIGINT) AS size, sha256(text) AS content_hash FROM documents""",
)
def media_manifest(spark, sf_dir):
    """Document texts as media files."""
    d = table(spark, sf_dir, "documents")
    media = d.select(
        F.concat_ws(
            "/", F.lit("documents"), "source", F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
        ).alias("path"),
        F.lit(RUN_TIME).alias("modificationTime"),
        F.col("text").cast("binary").alias("content"),
    )
    return result(files.media_manifest(media), "path", "kind", "size", "content_hash")


@query(
    "read_tabular",
    """SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM (
  SELECT s_suppkey, s_name, CAST(s_nationkey AS BIGINT) AS s_nationkey, s_acctbal FROM supplier)""",
)
def read_tabular(spark, sf_dir):
    """Suppliers written as delimited text and read with a fixed schema."""
    root = work_path(spark, "csv")
    table(spark, sf_dir, "supplier").write.option("header", True).csv(root)
    schema = T.StructType.fromDDL(
        "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE"
    )
    return result(src.read_tabular(spark, root, schema).drop("_corrupt_record"))
