"""Readers for claims: raw files, tables, topics and text lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsight.schemas import CLAIM_MESSAGE, CORRUPT, MEMBERS, PROVIDERS

CORRUPT_FIELD = T.StructField(CORRUPT, T.StringType())


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType(schema.fields + [CORRUPT_FIELD])


def read_bronze(
    spark: SparkSession, root: str, schema: T.StructType = CLAIM_MESSAGE
) -> DataFrame:
    """Raw JSON lines below ``year=/month=/day=`` folders.

    The folder columns are kept as text, so filters on them prune folders.
    Unreadable lines arrive in ``_corrupt_record``.
    """
    folders = [T.StructField(c, T.StringType()) for c in ("year", "month", "day")]
    wide = T.StructType(_with_corrupt(schema).fields + folders)
    return (
        spark.read.schema(wide)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(root)
    )


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or Parquet files if ``name`` is a path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def parse_lines(
    df: DataFrame, schema: T.StructType = CLAIM_MESSAGE, keep: str | None = None
) -> DataFrame:
    """Text column ``value`` to typed columns plus ``_corrupt_record``.

    Works on batch and stream. A line that is JSON but no object is corrupt too. ``keep``
    names a column for the text itself.
    """
    text = [F.col("value").alias(keep)] if keep else []
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = F.from_json(F.col("value"), _with_corrupt(schema), options)
    # Generated, not projected: a filter on a parsed column would parse (and make) the line again.
    return df.select(F.explode(F.array(parsed)).alias("_m"), "value").select(
        *[F.col(f"_m.{f.name}").alias(f.name) for f in schema.fields],
        F.when(F.col("_m").isNull(), F.col("value"))
        .otherwise(F.col(f"_m.{CORRUPT}"))
        .alias(CORRUPT),
        *text,
    )


def is_json(value: Column) -> Column:
    """True for text that is valid JSON of any kind."""
    return F.try_parse_json(value).isNotNull()


def read_claims_stream(
    spark: SparkSession,
    *,
    path: str | None = None,
    servers: str | None = None,
    topic: str = "raw.claims.new",
    start: str = "earliest",
    per_trigger: int = 1_000_000,
    files_per_trigger: int = 64,
) -> DataFrame:
    """Stream of raw claim lines as ``value``: a folder of text files or a topic.

    A topic needs the public Kafka connector on the class path. The limits bound
    the rows of one micro-batch, and with it the rows one key can have in a task.
    """
    if path is not None:
        return (
            spark.readStream.format("text")
            .option("maxFilesPerTrigger", files_per_trigger)
            .load(path)
        )
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", start)
        .option("maxOffsetsPerTrigger", per_trigger)
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def read_dimensions(
    spark: SparkSession,
    *,
    jdbc_url: str | None = None,
    options: dict[str, str] | None = None,
    root: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Provider and member tables from a database or from Parquet folders."""
    if jdbc_url is not None:
        reader = lambda t: spark.read.jdbc(jdbc_url, t, properties=options or {})
        return reader("providers"), reader("members")
    return (
        spark.read.schema(PROVIDERS).parquet(f"{root}/providers"),
        spark.read.schema(MEMBERS).parquet(f"{root}/members"),
    )


def read_tabular(
    spark: SparkSession, path: str, schema: T.StructType, *, stream: bool = False, **options
) -> DataFrame:
    """Delimited text with a header and a fixed schema."""
    reader = spark.readStream if stream else spark.read
    wide = _with_corrupt(schema)
    return reader.schema(wide).options(header=True, mode="PERMISSIVE", **options).csv(path)
