"""Explicit schemas. Nothing is inferred when reading."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)


def _schema(columns: str) -> T.StructType:
    """Schema from ``name TYPE`` pairs; needs no running session."""
    kinds = {
        "STRING": T.StringType(),
        "BIGINT": T.LongType(),
        "DATE": T.DateType(),
        "TIMESTAMP": T.TimestampType(),
        "MONEY": MONEY,
    }
    pairs = [c.split() for c in columns.split(",")]
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in pairs])


PROVIDERS = _schema(
    "npi STRING, name STRING, specialty STRING, license_no STRING, status STRING, "
    "created_at TIMESTAMP"
)

MEMBERS = _schema("member_id STRING, plan_id STRING, status STRING, enrolled_at DATE")

# One raw claim as it arrives (JSON line, topic value or change-log row).
CLAIM_MESSAGE = _schema(
    "claim_id STRING, provider_npi STRING, provider_name STRING, member_id STRING, "
    "procedure_code STRING, diagnosis_code STRING, amount MONEY, "
    "service_date STRING, submitted_at STRING, status STRING"
)

CORRUPT = "_corrupt_record"

# Claim row of the source database, used inside change envelopes.
CLAIM_ROW = _schema(
    "id BIGINT, claim_id STRING, provider_npi STRING, member_id STRING, "
    "procedure_code STRING, diagnosis_code STRING, amount STRING, service_date STRING, "
    "submitted_at STRING, status STRING"
)

CHANGE_ENVELOPE = T.StructType(
    [
        T.StructField("before", CLAIM_ROW),
        T.StructField("after", CLAIM_ROW),
        T.StructField("op", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
    ]
)

CHANGE_FLAT = T.StructType(
    CLAIM_ROW.fields
    + [T.StructField("__op", T.StringType()), T.StructField("__ts_ms", T.LongType())]
)

# Columns every valid claim must carry.
REQUIRED = ["claim_id", "member_id", "provider_npi", "amount"]

# Direct identifiers that never leave the raw zone.
IDENTIFIERS = [
    "member_id",
    "provider_npi",
    "provider_name",
    "name",
    "cpf",
    "dob",
    "address",
    "phone",
]
