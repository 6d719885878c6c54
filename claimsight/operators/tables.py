"""Writing and maintaining tables. Tables are Parquet folders or catalog tables."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def ensure_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def write_table(
    df: DataFrame,
    name: str,
    partition_by: list[str] | None = None,
    *,
    max_records_per_file: int = 10_000_000,
) -> DataFrame:
    """Create or replace a table; a path if ``name`` has a slash. Reads it back.

    Partitioned output is rebalanced: few files per partition value, and a large
    value is split over several tasks at run time.
    """
    partition_by = partition_by or []
    writer = (
        balanced(df, partition_by).write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option("compression", "snappy")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy(*partition_by)
    )
    spark = df.sparkSession
    if "/" in name:
        writer.parquet(name)
        return spark.read.parquet(name)
    writer.format("parquet").saveAsTable(name)
    return spark.table(name)


def balanced(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Rows of a partition value brought together, large values split again."""
    return df.hint("rebalance", *partition_by) if partition_by else df


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace just the partitions that occur in ``df``: a rerun changes nothing."""
    (
        balanced(df, partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def insert_ignore(target: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The rows to append: one per key that the target does not have yet."""
    columns = [c for c in new.columns if c != key]
    first = new.groupBy(key).agg(F.min(F.struct(*columns)).alias("_row"))
    rows = first.select(key, *[F.col(f"_row.{c}").alias(c) for c in columns])
    return rows.join(target.select(key), key, "left_anti").select(*new.columns)


def erase_subjects(df: DataFrame, subjects: DataFrame, on: str) -> DataFrame:
    """The table without the rows of the given subjects."""
    return df.join(subjects.select(on), on, "left_anti")


def replace_partitions(rows: DataFrame, touched: DataFrame, path: str, partition: str) -> None:
    """Give the touched partitions of a table these rows and no others.

    The rows are staged in a work table first: a folder is never read and overwritten in one
    job. A touched partition that gets no row is removed; null is a partition like others.
    """
    from claimsight.session import materialize, work_path

    spark = rows.sparkSession
    touched = materialize(touched.select(partition).distinct(), "touched")
    stage = work_path(spark, "staged")
    rows.write.partitionBy(partition).parquet(stage)
    fresh = spark.read.schema(rows.schema).parquet(stage)
    overwrite_partitions(fresh, path, [partition])
    left = fresh.select(F.col(partition).alias("_left")).distinct()
    emptied = touched.join(left, F.col(partition).eqNullSafe(F.col("_left")), "left_anti")
    # Partition values are few (days of the table), never rows.
    for row in emptied.select(F.col(partition).cast("string")).toLocalIterator():
        _delete_partition(spark, path, partition, row[0])


def in_partitions(df: DataFrame, touched: DataFrame, partition: str) -> DataFrame:
    """Rows of the partitions that occur in ``touched``, null among them."""
    values = touched.select(F.col(partition).alias("_touched")).distinct()
    return df.join(values, F.col(partition).eqNullSafe(F.col("_touched")), "left_semi")


def merge_rows(
    new: DataFrame, path: str, key: str, partition: str, order: tuple[str, ...]
) -> None:
    """Merge rows into a partitioned table: one row per key, the greatest by ``order``.

    Rewritten are the partitions of the new rows and those where their keys lie so far; other
    rows of these partitions stay. The first call makes the table.
    """
    from claimsight.operators.quality import dedup
    from claimsight.session import materialize

    spark = new.sparkSession
    new = materialize(new, "merge")
    if not exists(spark, path):
        overwrite_partitions(new, path, [partition])
        return
    old = spark.read.schema(new.schema).parquet(path)
    held = old.join(new.select(key).distinct(), key, "left_semi").select(partition)
    touched = materialize(held.unionByName(new.select(partition)).distinct(), "touched")
    rows = dedup(in_partitions(old, touched, partition).unionByName(new), key, order)
    replace_partitions(rows.select(*new.columns), touched, path, partition)


def erase_in_table(path: str, subjects: DataFrame, on: str, partition: str) -> None:
    """Erase subjects from a partitioned table, rewriting only touched partitions."""
    from claimsight.session import materialize

    df = subjects.sparkSession.read.parquet(path)
    touched = df.join(subjects.select(on), on, "left_semi").select(partition).distinct()
    touched = materialize(touched, "touched")
    kept = erase_subjects(in_partitions(df, touched, partition), subjects, on)
    replace_partitions(kept.select(*df.columns), touched, path, partition)


def exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, none if it does not exist."""
    if not exists(spark, path):
        return []
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory())


def remove(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _delete_partition(spark: SparkSession, path: str, partition: str, value: str | None) -> None:
    """Remove a partition's folder, named as Spark names it (null and escaped values too)."""
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    remove(spark, f"{path}/{names.getPartitionPathString(partition, value)}")


def unexpired(df: DataFrame, today: date | Column, years: int = 7, at: str = "event_date"):
    """Rows not older than the retention time (a filter that prunes partitions)."""
    return df.filter(F.col(at) >= F.add_months(F.lit(today), -12 * years))


def compact(
    spark: SparkSession,
    source: str,
    target: str,
    partition_by: list[str],
    *,
    max_records_per_file: int = 10_000_000,
    files_per_partition: int = 1,
) -> dict[str, int]:
    """Rewrite small files as larger ones; both row counts and checksums are compared.

    Raises if the copy differs. ``files_per_partition`` spreads large partitions.
    """
    df = spark.read.parquet(source)
    spread = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_partition))
    (
        df.repartition(*[F.col(c) for c in partition_by], spread)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_records_per_file)
        .option("compression", "snappy")
        .partitionBy(*partition_by)
        .parquet(target)
    )
    before, after = checksum(df), checksum(spark.read.parquet(target).select(*df.columns))
    if before != after:
        raise RuntimeError(f"compaction changed the table: {before} became {after}")
    return before


def checksum(df: DataFrame) -> dict[str, int]:
    """Row count and an order-independent sum over row hashes."""
    hashes = F.xxhash64(*df.columns).cast("decimal(20,0)")
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(hashes).alias("h")).first()
    return {"rows": row["n"], "hash": int(row["h"] or 0)}


def snapshot_write(df: DataFrame, root: str, taken_at: datetime) -> None:
    """Keep a full copy of the table under its time."""
    stamp = taken_at.strftime("%Y%m%dT%H%M%S")
    df.write.mode("overwrite").option("compression", "snappy").parquet(
        f"{root}/snapshot_ts={stamp}"
    )


def list_snapshots(spark: SparkSession, root: str) -> list[str]:
    """Times of all snapshots, from the folder names."""
    names = folders(spark, root)
    return sorted(n.split("=", 1)[1] for n in names if n.startswith("snapshot_ts="))


def snapshot_as_of(spark: SparkSession, root: str, moment: datetime) -> DataFrame:
    """The table as of the last snapshot taken until ``moment``."""
    stamp = moment.strftime("%Y%m%dT%H%M%S")
    known = [s for s in list_snapshots(spark, root) if s <= stamp]
    if not known:
        raise ValueError(f"no snapshot until {stamp}")
    return spark.read.parquet(f"{root}/snapshot_ts={known[-1]}")
