"""Other feeds: JSON log lines, mapped segments, media files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsight.functions.addresses import address_digits, client_of


def parse_json_logs(
    df: DataFrame,
    schema: T.StructType,
    *,
    message: str = "message",
    at: str | None = None,
    address: str | None = None,
    agent: str | None = None,
) -> DataFrame:
    """Log lines with a JSON message as columns; unparseable lines are marked.

    ``at`` names a time column that is normalised to UTC seconds (``log_sec``), ``address`` a
    field that gives 32 hex digits (``address_digits``) and ``agent`` one that gives
    ``agent_family``, ``agent_major`` and ``agent_platform``.
    """
    fields = F.from_json(message, schema)
    out = df.withColumn("_log", fields)
    parsed = out.select(
        *[c for c in df.columns if c != message],
        *[F.col(f"_log.{f.name}").alias(f.name) for f in schema.fields],
        F.try_parse_json(F.col(message)).isNotNull().alias("parsed"),
    )
    if at:
        parsed = parsed.withColumn("log_sec", F.unix_seconds(at))
    if address:
        parsed = parsed.withColumn("address_digits", address_digits(F.col(address)))
    if agent:
        client = client_of(F.col(agent))
        parsed = parsed.withColumns({f"agent_{f}": client[f] for f in ("family", "major", "platform")})
    return parsed


# Segment names of a mapped claim file.
SEGMENT_FIELDS = {"CLM01": "claim_id", "NM109": "provider_npi", "CLM02": "amount"}


def map_segments(df: DataFrame, ingested_at: Column) -> DataFrame:
    """Segment columns as canonical claims.

    ``HI`` is an array of structs with a code ``HI01``. ``mapped`` is false for
    rows whose id is missing or whose amount is no number: those belong into
    quarantine.
    """
    renamed = df.withColumnsRenamed(SEGMENT_FIELDS)
    return renamed.select(
        "claim_id",
        "provider_npi",
        F.col("amount").try_cast("decimal(12,2)").alias("amount"),
        F.transform("HI", lambda s: s["HI01"]).alias("icd10_codes"),
        ingested_at.alias("ingested_at"),
    ).withColumn("mapped", F.col("claim_id").isNotNull() & F.col("amount").isNotNull())


# Kinds of media by file suffix.
MEDIA_KINDS = {
    "document": ["pdf", "txt", "doc", "docx"],
    "image": ["png", "jpg", "jpeg", "tif", "tiff"],
    "audio": ["mp3", "wav", "ogg"],
    "video": ["mp4", "mov", "avi"],
}


def media_manifest(files: DataFrame) -> DataFrame:
    """Size, type, time and content hash of files (path, modificationTime, content)."""
    suffix = F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1))
    kind = F.lit("other")
    for name, suffixes in MEDIA_KINDS.items():
        kind = F.when(suffix.isin(suffixes), name).otherwise(kind)
    return files.select(
        "path",
        F.regexp_extract("path", r"([^/]+)$", 1).alias("file_name"),
        kind.alias("kind"),
        F.octet_length("content").cast("bigint").alias("size"),
        "modificationTime",
        F.sha2("content", 256).alias("content_hash"),
    )


def read_media(spark: SparkSession, root: str) -> DataFrame:
    """Media files below a folder as a manifest."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    return media_manifest(reader.load(root))
