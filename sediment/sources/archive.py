"""Snapshots as sets of named tables."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import cached_property, reduce
from pathlib import Path
from typing import Protocol
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sediment.errors import InvalidSnapshot
from sediment.functions.names import common
from sediment.operators.lookup import BROADCAST_BYTES
from sediment.sources import sqlite, versions
from sediment.specs import SNAPSHOT
from sediment.staging import filesystem


@dataclass(frozen=True)
class Constraints:
    """What a store declares about a table: NOT NULL columns, unique keys, column defaults."""

    not_null: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    defaults: dict[str, object] = field(default_factory=dict)
    # Whether the store itself keeps `_id` present and unique.
    sure_ids: bool = False

    def to_json(self) -> str:
        defaults = {k: {"bytes": v.hex()} if isinstance(v, bytes) else {"value": v} for k, v in self.defaults.items()}
        return json.dumps([self.not_null, self.unique, defaults, self.sure_ids])

    @classmethod
    def from_json(cls, text: str) -> "Constraints":
        not_null, unique, defaults, sure_ids = json.loads(text)
        values = {k: bytes.fromhex(v["bytes"]) if "bytes" in v else v["value"] for k, v in defaults.items()}
        return cls(tuple(not_null), tuple(map(tuple, unique)), values, sure_ids)


# Folder next to the tables of a written archive, and its columns.
CONSTRAINTS = "_constraints"
CONSTRAINT_ROWS = "table_name string, declared string"


class Archive(Protocol):
    path: str

    def tables(self) -> list[str]: ...

    def schema(self, table: str) -> T.StructType: ...

    def read(self, table: str, columns: Sequence[str] | None = None) -> DataFrame: ...

    def constraints(self, table: str) -> Constraints: ...

    def scan_group(self, table: str) -> tuple | None:
        """Equal for archives whose table one scan can read; None if there is no such scan."""


@dataclass
class FrameArchive:
    """Tables that are already DataFrames."""

    path: str
    frames: Mapping[str, DataFrame]
    declared: Mapping[str, Constraints] = field(default_factory=dict)

    def tables(self) -> list[str]:
        return list(self.frames)

    def schema(self, table: str) -> T.StructType:
        return self.frames[table].schema

    def read(self, table: str, columns: Sequence[str] | None = None) -> DataFrame:
        df = self.frames[table]
        return df if columns is None else df.select(*columns)

    def constraints(self, table: str) -> Constraints:
        return self.declared.get(table, Constraints())

    def scan_group(self, table: str) -> None:
        return None


@dataclass
class ParquetArchive:
    """A folder with one Parquet folder per table, or the newest version of one at the time it is first asked."""

    spark: SparkSession
    path: str

    @cached_property
    def root(self) -> str:
        return versions.current(self.spark, self.path)

    def tables(self) -> list[str]:
        return self._tables

    @cached_property
    def _tables(self) -> list[str]:
        fs, root = filesystem(self.spark, self.root)
        if not fs.exists(root):
            raise InvalidSnapshot(f"no such snapshot: {self.path}")
        names = (s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory())
        return sorted(n for n in names if not n.startswith(("_", ".")))

    @cached_property
    def _schemas(self) -> dict[str, T.StructType]:
        return {}

    def schema(self, table: str) -> T.StructType:
        if table not in self._schemas:
            self._schemas[table] = self.spark.read.parquet(f"{self.root}/{table}").schema
        return self._schemas[table]

    def read(self, table: str, columns: Sequence[str] | None = None) -> DataFrame:
        df = self.spark.read.schema(self.schema(table)).parquet(f"{self.root}/{table}")
        return df if columns is None else df.select(*columns)

    @cached_property
    def _declared(self) -> dict[str, Constraints]:
        """What a merge or conversion wrote next to its tables; a folder from elsewhere declares nothing."""
        fs, path = filesystem(self.spark, f"{self.root}/{CONSTRAINTS}")
        if not fs.exists(path):
            return {}
        # One row per table.
        found = self.spark.read.schema(CONSTRAINT_ROWS).parquet(f"{self.root}/{CONSTRAINTS}").collect()
        return {r["table_name"]: Constraints.from_json(r["declared"]) for r in found}

    def constraints(self, table: str) -> Constraints:
        return self._declared.get(table, Constraints())

    def folder_columns(self, table: str) -> tuple[str, ...]:
        """Columns whose values are folder names, from the first folder on each level."""
        found, (fs, path) = [], filesystem(self.spark, f"{self.root}/{table}")
        while True:
            folders = [s.getPath() for s in fs.listStatus(path) if s.isDirectory() and "=" in s.getPath().getName()]
            if not folders:
                return tuple(found)
            path = folders[0]
            found.append(unquote(path.getName().split("=", 1)[0]))

    def scan_group(self, table: str) -> tuple:
        return "parquet", self.schema(table).json(), self.folder_columns(table)


@dataclass
class SqliteArchive:
    """One SQLite file, read only, on a folder that all executors share."""

    spark: SparkSession
    path: str

    @cached_property
    def _catalog(self) -> dict[str, sqlite.TableInfo]:
        return sqlite.catalog(self.path)

    def tables(self) -> list[str]:
        return list(self._catalog)

    def schema(self, table: str) -> T.StructType:
        return self._catalog[table].schema

    def read(self, table: str, columns: Sequence[str] | None = None) -> DataFrame:
        return sqlite.read(self.spark, self.path, self._catalog[table], columns)

    def constraints(self, table: str) -> Constraints:
        info = self._catalog[table]
        return Constraints(info.not_null, info.unique, info.defaults, info.sure_ids)

    def info(self, table: str) -> sqlite.TableInfo:
        return self._catalog[table]

    def scan_group(self, table: str) -> tuple:
        return "sqlite", self.schema(table).json(), self._catalog[table].has_rowid, self._catalog[table].untyped


def open_archive(spark: SparkSession, source: "str | Archive") -> Archive:
    """An archive from a path: a SQLite file, or a folder of Parquet tables."""
    if not isinstance(source, str):
        return source
    if "://" not in source and Path(source).is_file():
        if not sqlite.is_sqlite(source):
            raise InvalidSnapshot(f"not a SQLite file: {source}")
        return SqliteArchive(spark, source)
    return ParquetArchive(spark, source.rstrip("/"))


# Stored snapshots of one schema that are read by a scan each.
SCANS = 8

_SCHEME = "^([a-z0-9]+):/+"
# What Hive-style folders say for a null.
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def read_union(
    spark: SparkSession, archives: Sequence[tuple[int, Archive]], table: str, columns: Sequence[str], shape
) -> DataFrame | None:
    """One DataFrame over `table` of all `archives`, each row with its snapshot_id.

    Stored snapshots of one schema are read by one scan, however many there are; up to SCANS of them, not in folders by value, by a scan each, as
    then no row's snapshot has to be told by its path. Only `columns` are read, as far as
    a snapshot has them. `shape(df, keep)` brings one snapshot's frame to the common columns; columns in `keep` stay.
    """
    grouped: dict[tuple, list[tuple[int, Archive]]] = {}
    for i, a in archives:
        kind = a.scan_group(table)
        grouped.setdefault((i,) if kind is None else kind, []).append((i, a))
    parts = []
    for members in grouped.values():
        i, first = members[0]
        wanted = common(first.schema(table).names, columns)
        if isinstance(first, SqliteArchive):
            files = [(i, a.path) for i, a in members]
            parts.append(shape(sqlite.read_many(spark, files, first.info(table), wanted), (SNAPSHOT,)))
        elif isinstance(first, ParquetArchive) and (len(members) > SCANS or first.folder_columns(table)):
            parts.append(_one_scan(spark, members, table, wanted, shape))
        elif isinstance(first, ParquetArchive):
            for i, a in members:
                stored = spark.read.schema(a.schema(table)).option("recursiveFileLookup", "true").parquet(f"{a.root}/{table}")
                parts.append(shape(stored.select(*wanted), ()).select(F.lit(i).cast("int").alias(SNAPSHOT), "*"))
        else:
            shaped = shape(first.read(table, wanted), ())
            parts.append(shaped.select(F.lit(i).cast("int").alias(SNAPSHOT), "*"))
    return reduce(lambda x, y: x.unionByName(y), parts) if parts else None


def _one_scan(
    spark: SparkSession,
    members: list[tuple[int, ParquetArchive]],
    table: str,
    columns: Sequence[str],
    shape,
) -> DataFrame:
    """One multi-path scan; the folder of the file a row comes from tells its snapshot.

    Columns held by folder names are taken from the path, as folders of several tables cannot be inferred at
    once. A file in none of the listed folders stops the job.
    """
    folders = []
    for i, a in members:
        fs, path = filesystem(spark, f"{a.root}/{table}")
        uri = fs.makeQualified(path).toUri().toString().rstrip("/")
        # One path is written `file:/x` or `file:///x`: all spellings are listed here, so none is looked for in each row.
        folders += [(i, name) for name in dict.fromkeys([uri, *(re.sub(_SCHEME, rf"\1:{s}", uri) for s in ("/", "//", "///"))])]
    first = members[0][1]
    schema, held = first.schema(table), first.folder_columns(table)
    stored = T.StructType([f for f in schema.fields if f.name not in held])
    reader = spark.read.schema(stored).option("recursiveFileLookup", "true")
    df = reader.parquet(*(f"{a.root}/{table}" for _, a in members))
    file = F.col("_metadata.file_path")
    # Told for every row, so by plain cuts: patterns over paths cost more than all else a scan does.
    folder = _parent(file)
    for _ in held:
        folder = F.when(F.substring_index(folder, "/", -1).contains("="), _parent(folder)).otherwise(folder)
    values = [_folder_value(file, schema[c]) if c in held else F.col(c) for c in columns]
    shaped = shape(df.select(*values, folder.alias("_folder")), ("_folder",))
    names = spark.createDataFrame(folders, f"{SNAPSHOT} int, _name string")
    # A row per snapshot the caller listed; those are broadcast unless their names alone are too much.
    small = sum(8 + len(name.encode()) for _, name in folders) <= BROADCAST_BYTES
    joined = shaped.join(F.broadcast(names) if small else names, F.col("_folder") == F.col("_name"), "left")
    unknown = F.raise_error(F.concat(F.lit("file of no listed snapshot: "), F.col("_folder"))).cast("int")
    return joined.select(
        F.coalesce(F.col(SNAPSHOT), unknown).alias(SNAPSHOT), *(c for c in shaped.columns if c != "_folder")
    )


def _parent(path: Column) -> Column:
    return F.left(path, F.length(path) - F.length(F.substring_index(path, "/", -1)) - 1)


def _folder_value(file: Column, field: T.StructField) -> Column:
    """A column's value from the folder names of a file's path: escaped once as a name and once as a URI."""
    pattern = f"/{re.escape(quote(quote(field.name, safe='')))}=([^/]*)/|/{re.escape(quote(field.name))}=([^/]*)/"
    found = F.coalesce(*(F.nullif(F.regexp_extract(file, pattern, i), F.lit("")) for i in (1, 2)))
    plus = F.regexp_replace(found, r"\+", "%2B")
    text = F.try_url_decode(F.regexp_replace(F.try_url_decode(plus), r"\+", "%2B"))
    return F.nullif(text, F.lit(_NULL_FOLDER)).cast(field.dataType).alias(field.name)
