"""Tables published together, one version at a time.

A version is a set of tables, a table a set of parts (a month, a group of keys, or just one), a part a folder
of Parquet files. A draft writes the parts that changed into fresh folders and takes over the others as they
are. Publishing appends one file to the ``manifest`` dataset, with a row per part of the new version; that file
is the switch. Readers look at the newest version of the manifest, so whatever happens to a run before it,
they see the old version whole, and after it the new one whole.

One writer at a time: a draft can be published only while the version it was made from is the newest.
Versions older than the last ``keep`` ones are retired with the folders that none of the kept ones uses,
drafts that were never published included.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import OWN_FILES, shuffles_dropped

#: Label of a table that has one part.
WHOLE = "whole"

_PART = "part"
_MANIFEST = (
    "table_name string, part string, folder string, n_rows bigint, key_low bigint, key_high bigint, odd_keys bigint,"
    " schema string, version bigint"
)


class StaleDraft(RuntimeError):
    """Another version was published since the draft was begun."""


@dataclass(frozen=True)
class Part:
    """A part of a published table; ``key_low`` and ``key_high`` bound its whole-number keys, ``odd_keys`` counts the others."""

    table: str
    part: str
    folder: str
    n_rows: int
    key_low: int | None
    key_high: int | None
    odd_keys: int
    schema: str

    def may_hold(self, low: int | None, high: int | None, odd: int) -> bool:
        """Whether a key of the given bounds, or an odd one, may be in the part."""
        if odd and self.odd_keys:
            return True
        return None not in (low, self.key_low) and self.key_low <= high and low <= self.key_high


class SnapshotStore:
    """The versions under one folder."""

    def __init__(self, spark: SparkSession, root: str, keep: int = 2) -> None:
        self.spark, self.root, self.keep = spark, root.rstrip("/"), max(1, keep)

    def _manifest(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifest")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return None
            raise

    def versions(self) -> list[int]:
        """Published versions that are not retired, oldest first."""
        found = self._manifest()
        return [] if found is None else sorted(r.version for r in found.select("version").distinct().collect())

    def version(self) -> int | None:
        """The newest version."""
        return max(self.versions(), default=None)

    def parts(self, version: int | None = None) -> list[Part]:
        """Parts of a version, by default the newest; as many rows as there are months, tables and groups of keys."""
        version = self.version() if version is None else version
        if version is None:
            return []
        rows = self._manifest().where(F.col("version") == version).drop("version").orderBy("table_name", "part").collect()
        return [Part(*row) for row in rows]

    def read(self, table: str, parts: Sequence[str] | None = None, version: int | None = None) -> DataFrame:
        """A published table, or the named parts of it that exist; other parts' folders are not touched."""
        own = [p for p in self.parts(version) if p.table == table]
        if not own:
            raise FileNotFoundError(f"no published table {table} under {self.root}")
        return read_parts(self.spark, own if parts is None else [p for p in own if p.part in set(parts)], own[0].schema)

    def draft(self) -> Draft:
        return Draft(self)

    def retire(self) -> None:
        """Remove versions before the last ``keep`` ones, and folders that no kept version uses."""
        versions = self.versions()
        kept, old = versions[-self.keep :], versions[: -self.keep]
        if not kept:
            return
        used = {run_folder(p.folder) for v in kept for p in self.parts(v)}
        files = _FileSystem(self.spark, self.root)
        for version in old:
            files.remove(f"{self.root}/manifest/version={version}")
        # A run's folder goes when none of its parts is in use, single parts of it before.
        for run in files.children(f"{self.root}/data"):
            if run not in used and int(run.rsplit("/", 1)[1].split("-")[0]) <= kept[-1]:
                files.remove(run)
        parts = {p.folder for v in kept for p in self.parts(v)}
        for run in used:
            for table in files.children(run):
                held = files.children(table)
                if any(h.rsplit("/", 1)[1].startswith(f"{_PART}=") for h in held):
                    for part in held:
                        if part.rsplit("/", 1)[1].startswith(f"{_PART}=") and part not in parts:
                            files.remove(part)


def run_folder(folder: str) -> str:
    """The folder of the run that wrote a part: two levels above it."""
    return folder.rsplit("/", 2)[0]


def read_parts(spark: SparkSession, parts: Sequence[Part], schema: str) -> DataFrame:
    """The rows of some parts; no rows if there are none."""
    kind = T.StructType.fromJson(json.loads(schema))
    folders = [p.folder for p in parts if p.n_rows]
    return spark.read.schema(kind).parquet(*folders) if folders else spark.createDataFrame([], kind)


class Draft:
    """A version in the making; nothing of it is seen before ``publish``."""

    def __init__(self, store: SnapshotStore) -> None:
        self.store, self.spark = store, store.spark
        self.base = store.version()
        self.before = {(p.table, p.part): p for p in store.parts(self.base)} if self.base is not None else {}
        self.number = (self.base or 0) + 1
        self._folder = f"{store.root}/data/{self.number}-{uuid.uuid4().hex}"
        self._parts: dict[tuple[str, str], Part] = {}

    def old_parts(self, table: str) -> list[Part]:
        """Parts of a table in the version the draft started from."""
        return [p for (name, _), p in sorted(self.before.items()) if name == table]

    def old(self, table: str, parts: Sequence[Part] | None = None) -> DataFrame | None:
        """Rows of a table, or of some of its parts, in the version the draft started from."""
        own = self.old_parts(table)
        return read_parts(self.spark, own if parts is None else parts, own[0].schema) if own else None

    def write(
        self, table: str, df: DataFrame | Sequence[DataFrame], part: Column | None = None, key: Column | None = None
    ) -> list[str]:
        """Write a table's new parts, one for each value of ``part`` (default: one part); their labels.

        All parts are written in one go, with the bounds of the whole-number ``key`` noted for each. A part
        of the same label in the old version is replaced. Of several ``df`` of the same columns, the rows of each
        are shuffled and written before those of the next.
        """
        frames = [df] if isinstance(df, DataFrame) else list(df)
        df = frames[0]
        label = F.lit(WHOLE) if part is None else part
        folder = f"{self._folder}/{table}"
        with shuffles_dropped(self.spark):
            for frame in frames:
                rows = frame.withColumn(_PART, label)
                if part is not None:
                    rows = rows.hint("rebalance", _PART)  # a task for each part, or several for a large one
                rows.write.mode("append").option("compression", OWN_FILES).partitionBy(_PART).parquet(folder)
        kind = T.StructType([*df.schema.fields, T.StructField(_PART, T.StringType())])
        written = self.spark.read.schema(kind).parquet(folder)
        number = F.lit(None).cast("bigint") if key is None else key.cast("string").try_cast("bigint")
        odd = F.count_if(number.isNull()) if key is not None else F.lit(0).cast("bigint")
        found = written.groupBy(_PART).agg(F.count(F.lit(1)).alias("n"), F.min(number).alias("low"), F.max(number).alias("high"), odd.alias("odd"))
        schema = df.schema.json()
        labels = []
        for row in found.collect():
            self._parts[table, row[_PART]] = Part(table, row[_PART], f"{folder}/{_PART}={row[_PART]}", row.n, row.low, row.high, row.odd, schema)
            labels.append(row[_PART])
        if not labels and (table, WHOLE) not in self._parts and part is None:
            self._parts[table, WHOLE] = Part(table, WHOLE, f"{folder}/{_PART}={WHOLE}", 0, None, None, 0, schema)
        return labels

    def keep(self, table: str, without: Sequence[str] = ()) -> None:
        """Take over the old version's parts of a table, but those named and those written anew."""
        for part in self.old_parts(table):
            if part.part not in set(without):
                self._parts.setdefault((table, part.part), part)

    def read(self, table: str, parts: Sequence[str] | None = None) -> DataFrame:
        """A table as the draft has it so far, or the named parts of it that have rows."""
        own = [p for (name, _), p in sorted(self._parts.items()) if name == table]
        return read_parts(self.spark, own if parts is None else [p for p in own if p.part in set(parts)], own[0].schema)

    def has(self, table: str) -> bool:
        return any(name == table for name, _ in self._parts)

    def publish(self) -> int | None:
        """Make the draft the newest version, by one file, and retire old ones; its number. Without any part it publishes nothing."""
        if self.store.version() != self.base:
            raise StaleDraft(f"version {self.store.version()} was published after {self.base}")
        if not self._parts:
            return self.base
        rows = [
            (p.table, p.part, p.folder, p.n_rows, p.key_low, p.key_high, p.odd_keys, p.schema, self.number) for p in self._parts.values()
        ]
        manifest = self.spark.createDataFrame(rows, _MANIFEST).coalesce(1)
        manifest.write.mode("append").partitionBy("version").parquet(f"{self.store.root}/manifest")
        self.store.retire()
        return self.number


class _FileSystem:
    """Listing and removing folders in whatever store Spark reads."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def children(self, folder: str) -> list[str]:
        """Paths of what a folder holds, as continuations of ``folder``; none if it is not there."""
        path = self._path(folder)
        if not self._files.exists(path):
            return []
        return sorted(f"{folder}/{status.getPath().getName()}" for status in self._files.listStatus(path))

    def remove(self, folder: str) -> None:
        self._files.delete(self._path(folder), True)


def remove_folder(spark: SparkSession, folder: str) -> None:
    """Remove a folder, if it is there."""
    _FileSystem(spark, folder).remove(folder)
