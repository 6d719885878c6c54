"""Cleaning, checks and privacy of claim rows."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from claimsight.functions.fields import event_time
from claimsight.schemas import CORRUPT, IDENTIFIERS, REQUIRED


def _complete(required: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])


def drop_malformed(df: DataFrame, required: list[str] = REQUIRED) -> DataFrame:
    """Rows with a value in every required column."""
    return df.filter(_complete(required))


def observe_malformed(
    df: DataFrame, required: list[str] = REQUIRED, name: str = "malformed"
) -> tuple[DataFrame, Observation]:
    """Counts read, kept and dropped rows while the rows flow by.

    No extra pass: the numbers are there once an action on the frame is done.
    """
    seen = Observation(name)
    kept = F.count(F.when(_complete(required), 1))
    total = F.count(F.lit(1))
    observed = df.observe(
        seen, total.alias("read"), kept.alias("kept"), (total - kept).alias("dropped")
    )
    return drop_malformed(observed, required), seen


def malformed_report(df: DataFrame, required: list[str] = REQUIRED) -> DataFrame:
    """Read, kept and dropped rows, and missing values per required column."""
    kept = F.count(F.when(_complete(required), 1))
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("rows_read"),
        kept.alias("rows_kept"),
        (total - kept).alias("rows_dropped"),
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"missing_{c}") for c in required],
    )


def normalize_event_time(df: DataFrame, source: str = "submitted_at") -> DataFrame:
    """Adds ``event_time`` from text; unreadable text gives null."""
    return df.withColumn("event_time", event_time(source))


def positive_amount(df: DataFrame) -> DataFrame:
    return df.filter(F.col("amount") > 0)


def drop_identifiers(df: DataFrame, columns: list[str] = IDENTIFIERS) -> DataFrame:
    """Without the columns that name a person or clinic."""
    return df.drop(*columns)


def restricted_view(
    df: DataFrame, authorised: bool, columns: list[str] = IDENTIFIERS
) -> DataFrame:
    """The frame as a caller may see it: identifiers only with authorisation."""
    return df if authorised else drop_identifiers(df, columns)


def strip_internal(df: DataFrame) -> DataFrame:
    """Without columns that start with an underscore."""
    return df.select(*[c for c in df.columns if not c.startswith("_")])


def stamp(df: DataFrame, run_date: date, run_time: datetime, time_column: str) -> DataFrame:
    """Adds ``processing_date`` and a run time, both fixed for the whole run."""
    return df.withColumns({"processing_date": F.lit(run_date), time_column: F.lit(run_time)})


def audit_stamp(
    df: DataFrame,
    *,
    source_system: str,
    connector_id: str,
    extracted_at: datetime,
    schema_version: str,
    phi_tokenized: bool,
    record_count: int | None = None,
) -> DataFrame:
    """Adds where a row came from, an id of its own, and the number of records extracted.

    ``record_count`` is what the extraction reported; without it the rows are counted.
    """
    if record_count is None:
        record_count = df.count()
    return df.withColumns(
        {
            "event_id": F.uuid(),
            "source_system": F.lit(source_system),
            "connector_id": F.lit(connector_id),
            "extracted_at": F.lit(extracted_at),
            "schema_version": F.lit(schema_version),
            "phi_tokenized": F.lit(phi_tokenized),
            "record_count": F.lit(record_count).cast("bigint"),
        }
    )


def month_of(df: DataFrame, at: str = "event_time") -> DataFrame:
    """Adds the month as partition column."""
    return df.withColumn("month", F.date_trunc("month", at).cast("date"))


def dedup(df: DataFrame, key: str = "claim_id", order: tuple[str, ...] = ("event_time",)):
    """One row per key: the greatest by ``order``, then by all other columns.

    An aggregation, not a window: copies of one key are reduced before the
    shuffle, however many there are.
    """
    rest = sorted(c for c in df.columns if c != key and c not in order)
    best = F.max(F.struct(*order, *rest)).alias("_best")
    rows = df.groupBy(key).agg(best)
    return rows.select(
        *[F.col(key) if c == key else F.col(f"_best.{c}").alias(c) for c in df.columns]
    )


def missing_reference(df: DataFrame, dim: DataFrame, column: str, dim_column: str):
    """Rows whose reference is not in the dimension table."""
    known = dim.select(F.col(dim_column).alias(column))
    return df.join(known, column, "left_anti")


def repeated_keys(df: DataFrame, key: str = "claim_id") -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def split_parsed(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that could be parsed, and the text of those that could not."""
    good = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    bad = df.filter(F.col(CORRUPT).isNotNull()).select(F.col(CORRUPT).alias("value"))
    return good, bad
