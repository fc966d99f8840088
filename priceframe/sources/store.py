"""A store of tables that are published together: partition folders by version, and a manifest that is put in place last.

    folder/_manifests/000000000007.json   what version 7 consists of: for every table its partition folders and their versions
    folder/master/v=7/snapshot_date=…     the partitions that version 7 wrote; others stay where an earlier version put them

Readers resolve a manifest and read the folders it names, so they see all tables of one version or of the one before, whatever
a writer is doing or has left behind. A commit writes only partitions it replaces; the new manifest is renamed into place, and
fails if another writer has put that version there. Unreferenced folders are removed by vacuum().

A manifest holds one entry for each partition (a date or a month of a table), which is what a driver may hold; rows never pass
through it.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_BLANK = "__HIVE_DEFAULT_PARTITION__"


def key_of(name: str) -> str:
    """The value in a partition folder's name."""
    value = unquote(name.partition("=")[2])
    return "" if value == _BLANK else value


@dataclass(frozen=True)
class Manifest:
    """version 0 is the empty store. tables: table -> partition folder -> the version that wrote it; notes are the writer's."""

    version: int = 0
    tables: dict[str, dict[str, int]] = field(default_factory=dict)
    notes: dict[str, str] = field(default_factory=dict)

    def keys(self, table: str) -> set[str]:
        return {key_of(name) for name in self.tables.get(table, {})}


class Store:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._jvm = spark._jvm.org.apache.hadoop.fs
        self._store = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, below: str):
        return self._jvm.Path(f"{self.folder}/{below}" if below else self.folder)

    def _list(self, below: str) -> list[str]:
        path = self._path(below)
        return [f.getPath().getName() for f in self._store.listStatus(path)] if self._store.exists(path) else []

    def _versions(self) -> list[int]:
        return sorted(int(m[1]) for name in self._list("_manifests") if (m := re.fullmatch(r"(\d+)\.json", name)))

    def manifest(self, version: int | None = None) -> Manifest:
        """The newest manifest, or that of a version."""
        known = self._versions()
        if version is None:
            version = known[-1] if known else 0
        if not version:
            return Manifest()
        text = self.spark.read.text(str(self._path(f"_manifests/{version:012d}.json")), wholetext=True).first()[0]
        own = json.loads(text)
        return Manifest(version, own["tables"], own["notes"])

    def read(self, table: str, schema: T.StructType, keys: Iterable[str] | None = None, at: Manifest | None = None, kind: str = "parquet") -> DataFrame:
        """A table's rows, of some keys only those partitions' folders are listed and read. schema: the table's columns, the
        partition column among them."""
        own = (at or self.manifest()).tables.get(table, {})
        wanted = None if keys is None else set(keys)
        paths = [f"{self.folder}/{table}/v={v}/{name}" for name, v in own.items() if wanted is None or key_of(name) in wanted]
        if not paths:
            return self.spark.createDataFrame([], schema)
        column = next(iter(own)).partition("=")[0]
        reader = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("v", T.LongType())])).option("basePath", f"{self.folder}/{table}")
        rows = reader.option("header", True).option("escape", '"').option("multiLine", True).csv(paths) if kind == "csv" else reader.parquet(*paths)
        blank = {f.name: F.coalesce(F.col(f.name), F.lit("")) if f.name == column or kind == "csv" else F.col(f.name) for f in schema.fields}
        return rows.select(*[c.alias(name) for name, c in blank.items()])

    def begin(self, base: Manifest | None = None) -> Commit:
        return Commit(self, base or self.manifest())

    def vacuum(self, keep: int = 2) -> None:
        """Remove manifests but the newest, and folders that those left do not name. No writer may be at work."""
        known = self._versions()
        for version in known[:-keep]:
            self._store.delete(self._path(f"_manifests/{version:012d}.json"), False)
        left = [self.manifest(v) for v in known[-keep:]]
        for table in self._list(""):
            if table.startswith("_"):
                continue
            named = {(v, name) for m in left for name, v in m.tables.get(table, {}).items()}
            for folder in self._list(table):
                version = int(folder.partition("=")[2])
                partitions = self._list(f"{table}/{folder}")
                for name in partitions:
                    if "=" in name and (version, name) not in named:
                        self._store.delete(self._path(f"{table}/{folder}/{name}"), True)
                if not any(v == version for v, _ in named):
                    self._store.delete(self._path(f"{table}/{folder}"), True)


class Commit:
    """One new version. Nothing of it is seen before finish()."""

    def __init__(self, store: Store, base: Manifest):
        self.store, self.base = store, base
        self.version = base.version + 1
        self.tables = {table: dict(names) for table, names in base.tables.items()}
        self.notes = dict(base.notes)

    def replace(self, table: str, rows: DataFrame, column: str, keys: Iterable[str] | None = None, kind: str = "parquet") -> set[str]:
        """Write rows, partitioned by a column, instead of the partitions of some keys (all, if none are named); keys that have
        no rows any more go. Gives the keys that have."""
        folder = f"{self.store.folder}/{table}/v={self.version}"
        writer = rows.write.mode("overwrite").partitionBy(column)
        if kind == "csv":
            writer.option("header", True).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("compression", "gzip").csv(folder)
        else:
            writer.option("compression", "zstd").parquet(folder)
        wrote = [name for name in self.store._list(f"{table}/v={self.version}") if name.startswith(f"{column}=")]
        self.drop(table, self.base.keys(table) if keys is None else keys)
        self.tables.setdefault(table, {}).update({name: self.version for name in wrote})
        return {key_of(name) for name in wrote}

    def drop(self, table: str, keys: Iterable[str]) -> None:
        gone = set(keys)
        self.tables[table] = {name: v for name, v in self.tables.get(table, {}).items() if key_of(name) not in gone}

    def finish(self, **notes: str) -> Manifest:
        """Put the manifest in place; another writer's version of the same number is an error."""
        self.notes |= notes
        store, jvm = self.store._store, self.store._jvm
        draft, place = self.store._path(f"_manifests/.{uuid.uuid4().hex}"), self.store._path(f"_manifests/{self.version:012d}.json")
        out = store.create(draft, True)
        out.write(bytearray(json.dumps({"tables": self.tables, "notes": self.notes}, sort_keys=True).encode()))
        out.close()
        if store.exists(place):
            store.delete(draft, False)
            raise FileExistsError(f"version {self.version} was published by another writer")
        none = self.store.spark.sparkContext._gateway.new_array(jvm.Options.Rename, 0)
        jvm.FileContext.getFileContext(place.toUri(), self.store.spark._jsc.hadoopConfiguration()).rename(draft, place, none)
        return Manifest(self.version, self.tables, self.notes)
