"""Change feeds: decoding, state at a time, merging into a table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsight.schemas import CHANGE_ENVELOPE, CHANGE_FLAT, CLAIM_ROW


def read_changes(df: DataFrame, value: str = "value") -> DataFrame:
    """JSON changes, enveloped or flat, as rows with ``op`` and ``ts_ms``.

    Tombstones (null values) and rows without an operation are left out. A
    delete carries the row as it was before.
    """
    kept = df.filter(F.col(value).isNotNull())
    # Both forms have no field in common, so one pass reads either. It is generated, not
    # projected: a filter on a parsed column would parse (and make) the text again.
    either = T.StructType(CHANGE_ENVELOPE.fields + CHANGE_FLAT.fields)
    both = kept.select(F.explode(F.array(F.from_json(value, either))).alias("c"))
    row = F.coalesce(F.col("c.after"), F.col("c.before"))
    enveloped = F.col("c.op").isNotNull()
    columns = [
        F.when(enveloped, row[f.name]).otherwise(F.col(f"c.{f.name}")).alias(f.name)
        for f in CLAIM_ROW.fields
    ]
    return both.select(
        *columns,
        F.coalesce(F.col("c.op"), F.col("c.__op")).alias("op"),
        F.coalesce(F.col("c.ts_ms"), F.col("c.__ts_ms")).alias("ts_ms"),
    ).filter(F.col("op").isNotNull())


def latest_changes(changes: DataFrame, key: str = "claim_id") -> DataFrame:
    """The last change of every key. An aggregation: large keys shrink early.

    At equal times the later step of a row's life wins: create, update, delete.
    """
    stage = F.when(F.col("op") == "d", 2).when(F.col("op") == "u", 1).otherwise(0)
    rest = [c for c in changes.columns if c not in (key, "ts_ms")]
    last = F.max(F.struct("ts_ms", stage.alias("_stage"), *rest)).alias("_last")
    picked = changes.groupBy(key).agg(last)
    return picked.select(
        *[F.col(key) if c == key else F.col(f"_last.{c}").alias(c) for c in changes.columns]
    )


def state_as_of(changes: DataFrame, moment_ms: int | Column, key: str = "claim_id"):
    """Rows as they stood at a time, deleted ones left out."""
    known = latest_changes(changes.filter(F.col("ts_ms") <= moment_ms), key)
    return known.filter(F.col("op") != "d").drop("op", "ts_ms")


def apply_changes(target: DataFrame, changes: DataFrame, key: str = "claim_id"):
    """The target after inserting, updating and deleting by the last changes."""
    last = latest_changes(changes, key)
    untouched = target.join(last.select(key), key, "left_anti")
    written = last.filter(F.col("op") != "d").select(*target.columns)
    return untouched.select(*target.columns).unionByName(written)
