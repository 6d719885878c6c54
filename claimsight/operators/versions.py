"""Partitioned tables that change in one step.

A change stages its rows in a new version folder and then switches a pointer file, which lists
the partition folders that make up the table. Readers follow the pointer, so they see the table
before a change or after it, never half of it. Partitions that a change does not touch stay
where they are. One writer at a time: a second one is refused at the switch.
"""

from __future__ import annotations

import json
import math
from collections import defaultdict
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimsight.operators.quality import dedup
from claimsight.operators.tables import balanced, checksum, exists, folders, insert_ignore, remove
from claimsight.session import materialize
from claimsight.sources.changes import latest_changes

POINTER = "current.json"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


@dataclass
class Version:
    """What the pointer says: number, schema, and folders as version=N/partition=value."""

    number: int = 0
    schema: dict | None = None
    folders: list[str] = field(default_factory=list)


class VersionedTable:
    """A Parquet table below ``path``, partitioned by one column."""

    def __init__(self, spark: SparkSession, path: str, partition: str):
        self.spark, self.path, self.partition = spark, path, partition
        jvm = spark._jvm
        self._folder = jvm.org.apache.hadoop.fs.Path(path)
        self._fs = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())

    # Pointer -------------------------------------------------------------------------------

    def current(self) -> Version:
        if not exists(self.spark, f"{self.path}/{POINTER}"):
            return Version()
        lines = self.spark.read.text(f"{self.path}/{POINTER}", wholetext=True)
        return Version(**json.loads(lines.first()[0]))

    def _switch(self, before: Version, after: Version) -> None:
        """Make ``after`` the table, in one rename; refuse if another writer was faster."""
        jvm = self.spark._jvm
        paths = [
            jvm.org.apache.hadoop.fs.Path(self._folder, name)
            for name in (f"{POINTER}.{after.number}.tmp", POINTER)
        ]
        out = self._fs.create(paths[0], True)
        out.write(bytearray(json.dumps(after.__dict__).encode()))
        out.close()
        if self.current().number != before.number:
            raise RuntimeError(f"{self.path} was changed meanwhile")
        overwrite = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._folder.toUri(), self.spark._jsc.hadoopConfiguration()
        )
        context.rename(*paths, overwrite)

    def _publish(self, before: Version, kept: list[str], rows: DataFrame | None) -> None:
        """Stage ``rows`` as new folders and let the table be these and the ``kept`` ones."""
        number = before.number + 1
        schema, added = before.schema, []
        if rows is not None:
            stage = f"{self.path}/version={number}"
            # A folder of this number is what a writer left that stopped before its switch.
            rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
                self.partition
            ).parquet(stage)
            added = [f"version={number}/{f}" for f in folders(self.spark, stage)]
            schema = schema or rows.schema.jsonValue()
        self._switch(before, Version(number, schema, kept + added))

    # Reading -------------------------------------------------------------------------------

    def read(self) -> DataFrame:
        """The table as it is now."""
        return self._read(self.current())

    def _read(self, version: Version, only: list[str] | None = None) -> DataFrame:
        """Rows of the version, or of some of its folders."""
        schema = T.StructType.fromJson(version.schema)
        found = version.folders if only is None else only
        if not found:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", self.path)
        return reader.parquet(*[f"{self.path}/{f}" for f in found]).select(schema.names)

    def _names(self, values: DataFrame) -> set[str]:
        """Folder names of partition values. Values are few (days of a table), never rows."""
        naming = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
        rows = values.select(F.col(self.partition).cast("string")).distinct().collect()
        return {naming.getPartitionPathString(self.partition, r[0]) for r in rows}

    @staticmethod
    def _split(version: Version, names: set[str]) -> tuple[list[str], list[str]]:
        """Folders of the named partitions, and the others."""
        inside = [f for f in version.folders if f.split("/")[1] in names]
        return inside, [f for f in version.folders if f.split("/")[1] not in names]

    # Changes -------------------------------------------------------------------------------

    def append(self, rows: DataFrame) -> None:
        """Add rows as folders of their own; nothing is rewritten."""
        before = self.current()
        self._publish(before, before.folders, balanced(rows, [self.partition]))

    def insert_ignore(self, rows: DataFrame, key: str) -> None:
        """Add one row for each key that the table does not have yet."""
        before = self.current()
        if before.schema is not None:
            rows = insert_ignore(self._read(before), rows, key)
        else:
            rows = insert_ignore(rows.limit(0), rows, key)
        self._publish(before, before.folders, balanced(rows, [self.partition]))

    def upsert(self, rows: DataFrame, key: str, order: tuple[str, ...]) -> None:
        """Add rows or replace those of their keys, the greatest by ``order`` wins."""
        before = self.current()
        if before.schema is None:
            self._publish(before, [], balanced(dedup(rows, key, order), [self.partition]))
            return
        rows = materialize(rows.select(T.StructType.fromJson(before.schema).names), "upsert")
        inside, others = self._touched(before, rows, rows.select(key))
        merged = dedup(self._read(before, inside).unionByName(rows), key, order)
        self._publish(before, others, balanced(merged, [self.partition]))

    def merge_changes(self, changes: DataFrame, key: str) -> None:
        """Insert, update and delete by the last change of every key (``op``, ``ts_ms``)."""
        before = self.current()
        last = materialize(latest_changes(changes, key), "last-changes")
        written = last.filter(F.col("op") != "d").drop("op", "ts_ms")
        if before.schema is None:
            self._publish(before, [], balanced(written, [self.partition]))
            return
        written = written.select(T.StructType.fromJson(before.schema).names)
        inside, others = self._touched(before, written, last.select(key))
        kept = self._read(before, inside).join(last.select(key), key, "left_anti")
        rows = kept.select(written.columns).unionByName(written)
        self._publish(before, others, balanced(rows, [self.partition]))

    def _touched(self, before: Version, written: DataFrame, keys: DataFrame):
        """Folders where the keys lie or rows are written to, and the others."""
        key = keys.columns[0]
        held = self._read(before).join(keys.distinct(), key, "left_semi").select(self.partition)
        return self._split(before, self._names(held.unionByName(written.select(self.partition))))

    def erase(self, subjects: DataFrame, on: str) -> None:
        """Remove the rows of the given subjects; only their partitions are rewritten."""
        before = self.current()
        gone = subjects.select(on).distinct()
        held = self._read(before).join(gone, on, "left_semi").select(self.partition)
        inside, others = self._split(before, self._names(held))
        if inside:
            kept = self._read(before, inside).join(gone, on, "left_anti")
            self._publish(before, others, balanced(kept, [self.partition]))

    def expire(self, today: date, years: int = 7) -> None:
        """Drop whole partitions (days) that are older than the retention time; null days stay.

        No row is read or written.
        """
        before = self.current()
        try:
            limit = today.replace(year=today.year - years)
        except ValueError:  # 29 February
            limit = today.replace(year=today.year - years, day=28)
        kept = []
        for f in before.folders:
            value = f.split("/")[1].split("=", 1)[1]
            if value == NULL_PARTITION or date.fromisoformat(value) >= limit:
                kept.append(f)
        if len(kept) < len(before.folders):
            self._publish(before, kept, None)

    # Upkeep --------------------------------------------------------------------------------

    def _sizes(self, version: Version) -> dict[str, tuple[int, int]]:
        """Bytes and data files of every folder."""
        found = {}
        for f in version.folders:
            files = self._fs.listStatus(self.spark._jvm.org.apache.hadoop.fs.Path(self._folder, f))
            sizes = [s.getLen() for s in files if not s.getPath().getName().startswith(("_", "."))]
            found[f] = (sum(sizes), len(sizes))
        return found

    def compact(self, target_bytes: int = 256 << 20) -> list[str]:
        """Rewrite folders of small files as files of about ``target_bytes``; returns them.

        A folder is rewritten if its files are smaller than half of that on average and its
        partition has several of them, in one folder or more. Folders of large files stay as
        they are. A partition is cut by its bytes, so a large one is written by many tasks.
        Row counts and checksums of old and new rows are compared before the switch.
        """
        before = self.current()
        small: dict[str, list[tuple[str, int, int]]] = defaultdict(list)
        for f, (size, files) in self._sizes(before).items():
            if files and size / files < target_bytes / 2:
                small[f.split("/")[1]].append((f, size, files))
        todo = {p: fs for p, fs in small.items() if sum(n for _, _, n in fs) > 1}
        pieces = {p: math.ceil(sum(s for _, s, _ in fs) / target_bytes) for p, fs in todo.items()}
        todo = {p: fs for p, fs in todo.items() if sum(n for _, _, n in fs) > pieces[p]}
        chosen = sorted(f for fs in todo.values() for f, _, _ in fs)
        if not chosen:
            return []
        rows = self._read(before, chosen)
        naming = F.concat(F.lit(f"{self.partition}="), F.coalesce(F.col(self.partition).cast("string"), F.lit(NULL_PARTITION)))
        cuts = self.spark.createDataFrame(
            [(p, pieces[p]) for p in todo], "_name STRING, _pieces INT"
        )
        salt = F.pmod(F.xxhash64(*rows.columns), F.coalesce(F.col("_pieces"), F.lit(1)))
        dealt = rows.withColumn("_name", naming).join(cuts, "_name", "left").withColumn("_piece", salt)
        dealt = dealt.repartition("_name", "_piece").select(rows.columns)
        others = [f for f in before.folders if f not in set(chosen)]
        number = before.number + 1
        stage = f"{self.path}/version={number}"
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
            self.partition
        ).parquet(stage)
        after = Version(number, before.schema, [f"version={number}/{f}" for f in folders(self.spark, stage)])
        if checksum(rows) != checksum(self._read(after)):
            raise RuntimeError(f"compaction of {self.path} changed rows")
        after.folders = others + after.folders
        self._switch(before, after)
        return chosen

    def clean(self) -> None:
        """Remove folders that no reader of the current version needs.

        Call it when no reader is left that started before the last change.
        """
        now = self.current()
        needed = set(now.folders)
        for version in folders(self.spark, self.path):
            if not version.startswith("version="):
                continue
            inside = folders(self.spark, f"{self.path}/{version}")
            for f in inside:
                if f"{version}/{f}" not in needed:
                    remove(self.spark, f"{self.path}/{version}/{f}")
            if not any(f"{version}/{f}" in needed for f in inside):
                remove(self.spark, f"{self.path}/{version}")
