"""Claims, providers and members derived from the given tables, in both engines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsight.functions.fields import token
from claimsight.session import apply_settings

# Codes the claims are given.
PROCEDURES = (
    "27447,29827,27130,29881,93306,99291,99213,99223,93000,80053,85025,80061,82947,"
    "97110,97012,97140,97530,00000"
)
DIAGNOSES = (
    "I10,I25.10,I48.0,I50.9,Z82.49,M17.11,M75.1,S72.001A,M54.5,Z00.00,E11.9,Z13.6,"
    "G89.29,S93.401A"
)
SPECIALTIES = ["CARDIOLOGY", "ORTHOPEDICS", "LABORATORY", "PHYSIOTHERAPY"]
HOT_PROVIDER = "NPI-005"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    apply_settings(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def claims_from(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Claims view over order lines (batch or stream) and orders."""
    lines = lineitem.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_discount"
    )
    heads = orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    joined = lines.join(heads, lines.l_orderkey == heads.o_orderkey)
    return joined.selectExpr(
        "concat('CLM-', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS claim_id",
        f"CASE WHEN l_suppkey % 2 = 0 THEN '{HOT_PROVIDER}' "
        "ELSE concat('NPI-S', CAST(l_suppkey AS STRING)) END AS provider_npi",
        "concat('MBR-', CAST(o_custkey AS STRING)) AS member_id",
        f"element_at(split('{PROCEDURES}', ','), CAST(l_partkey % 18 AS INT) + 1) AS procedure_code",
        f"element_at(split('{DIAGNOSES}', ','), CAST(l_orderkey % 14 AS INT) + 1) AS diagnosis_code",
        "CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(round(l_discount * 100) AS BIGINT)"
        " * CAST(round(l_discount * 100) AS BIGINT) div 100 AS amount_cents",
        "date_sub(CAST(o_orderdate AS DATE), l_linenumber % 4) AS service_date",
        "timestampadd(SECOND, CAST((l_orderkey * 7919 + l_linenumber * 613) % 86400 AS INT),"
        " CAST(o_orderdate AS TIMESTAMP)) AS event_time",
        "CASE o_orderstatus WHEN 'P' THEN 'PENDING' WHEN 'O' THEN 'APPROVED'"
        " ELSE 'REJECTED' END AS status",
    ).withColumn("amount", (F.col("amount_cents") / F.lit(100)).cast("decimal(12,2)"))


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claims_from(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"))


CLAIMS_CTE = f"""claims AS (
SELECT concat('CLM-', CAST(l_orderkey AS VARCHAR), '-', CAST(l_linenumber AS VARCHAR)) AS claim_id,
       CASE WHEN l_suppkey % 2 = 0 THEN '{HOT_PROVIDER}' ELSE concat('NPI-S', CAST(l_suppkey AS VARCHAR)) END AS provider_npi,
       concat('MBR-', CAST(o_custkey AS VARCHAR)) AS member_id,
       string_split('{PROCEDURES}', ',')[CAST(l_partkey % 18 AS INT) + 1] AS procedure_code,
       string_split('{DIAGNOSES}', ',')[CAST(l_orderkey % 14 AS INT) + 1] AS diagnosis_code,
       CAST(round(l_extendedprice * 100) AS BIGINT) * CAST(round(l_discount * 100) AS BIGINT) * CAST(round(l_discount * 100) AS BIGINT) // 100 AS amount_cents,
       CAST(o_orderdate AS DATE) - CAST(l_linenumber % 4 AS INT) AS service_date,
       o_orderdate + to_seconds((l_orderkey * 7919 + l_linenumber * 613) % 86400) AS event_time,
       CASE o_orderstatus WHEN 'P' THEN 'PENDING' WHEN 'O' THEN 'APPROVED' ELSE 'REJECTED' END AS status,
       CAST(epoch(o_orderdate) AS BIGINT) + (l_orderkey * 7919 + l_linenumber * 613) % 86400 AS sec
FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def with_claims(sql: str) -> str:
    """SQL over ``claims``; further CTEs may follow as ``, name AS (...)``."""
    return f"WITH {CLAIMS_CTE}{sql}"


def providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider table: odd suppliers and the hot provider. Those of nation 0 are missing."""
    s = table(spark, sf_dir, "supplier")
    names = ", ".join(f"'{x}'" for x in SPECIALTIES)
    own = s.filter("s_suppkey % 2 = 1 AND s_nationkey <> 0").selectExpr(
        "concat('NPI-S', CAST(s_suppkey AS STRING)) AS npi",
        "s_name AS name",
        f"element_at(array({names}), CAST(s_suppkey % 4 AS INT) + 1) AS specialty",
        "CASE WHEN s_acctbal < 0 THEN 'SUSPENDED' ELSE 'ACTIVE' END AS status",
    )
    hot = s.agg(F.count(F.lit(1))).selectExpr(
        f"'{HOT_PROVIDER}' AS npi",
        "'Suspect Clinic' AS name",
        f"'{SPECIALTIES[0]}' AS specialty",
        "'ACTIVE' AS status",
    )
    return own.unionByName(hot)


PROVIDERS_CTE = f"""providers AS (
SELECT concat('NPI-S', CAST(s_suppkey AS VARCHAR)) AS npi, s_name AS name,
       [{", ".join(f"'{x}'" for x in SPECIALTIES)}][CAST(s_suppkey % 4 AS INT) + 1] AS specialty,
       CASE WHEN s_acctbal < 0 THEN 'SUSPENDED' ELSE 'ACTIVE' END AS status
FROM supplier WHERE s_suppkey % 2 = 1 AND s_nationkey <> 0
UNION ALL SELECT '{HOT_PROVIDER}', 'Suspect Clinic', '{SPECIALTIES[0]}', 'ACTIVE')"""


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.selectExpr(
        "concat('MBR-', CAST(c_custkey AS STRING)) AS member_id",
        "c_mktsegment AS plan_id",
        "CASE WHEN c_acctbal < 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status",
    )


MEMBERS_CTE = """members AS (
SELECT concat('MBR-', CAST(c_custkey AS VARCHAR)) AS member_id, c_mktsegment AS plan_id,
       CASE WHEN c_acctbal < 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS status
FROM customer)"""


def tokenized(df: DataFrame) -> DataFrame:
    """Claims with tokens in place of the two identifiers."""
    return df.withColumns(
        {
            "member_id_token": token("member_id"),
            "provider_npi_token": token("provider_npi"),
        }
    ).drop("member_id", "provider_npi")


def as_text_messages(df: DataFrame) -> DataFrame:
    """Claims as raw messages: amounts and times as text or numbers of the feed.

    Claims of amount zero lose their member, rejected claims below ten lose their
    amount, so that the checks have something to find.
    """
    return df.select(
        "claim_id",
        "provider_npi",
        F.lit("Clinic of the feed").alias("provider_name"),
        F.expr("CASE WHEN amount_cents > 0 THEN member_id END").alias("member_id"),
        "procedure_code",
        "diagnosis_code",
        F.expr(
            "CASE WHEN NOT (status = 'REJECTED' AND amount_cents < 1000) THEN amount END"
        ).alias("amount"),
        F.date_format("service_date", "yyyy-MM-dd").alias("service_date"),
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss").alias("submitted_at"),
        "status",
    )


MESSAGES_CTE = """messages AS (
SELECT claim_id, provider_npi,
       CASE WHEN amount_cents > 0 THEN member_id END AS member_id,
       procedure_code, diagnosis_code,
       CASE WHEN NOT (status = 'REJECTED' AND amount_cents < 1000) THEN amount_cents END AS amount_cents,
       service_date, event_time, sec, status
FROM claims)"""


def result(df: DataFrame, *cols) -> DataFrame:
    """Final projection of a query: plain text, whole numbers and doubles only."""
    df = df.select(*cols) if cols else df
    out = []
    for f in df.schema.fields:
        kind, c = f.dataType.typeName(), F.col(f"`{f.name}`")
        if kind in ("byte", "short", "integer"):
            c = c.cast("bigint")
        elif kind == "boolean":
            c = c.cast("bigint")
        elif kind in ("decimal", "float"):
            c = c.cast("double")
        elif kind in ("timestamp", "timestamp_ntz"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind == "date":
            c = F.date_format(c, "yyyy-MM-dd")
        elif kind == "array":
            c = F.array_join(c, ",")
        out.append(c.alias(f.name))
    return df.select(*out)
