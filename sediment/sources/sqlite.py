"""SQLite files as a Spark data source: one task per range of row ids."""

from __future__ import annotations

import json
import sqlite3
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from heapq import heappop, heappush
from pathlib import Path
from urllib.parse import quote

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

from sediment.specs import SNAPSHOT

# Fixed value: the first bytes of a SQLite file.
MAGIC = b"SQLite format 3\x00"
FORMAT = "sediment_sqlite"
BATCH_ROWS = 20_000
ROWS_PER_TASK = 500_000
# Ranges of one file at most; a table of more rows than MAX_TASKS * ROWS_PER_TASK (a file of some 100 GB) has larger tasks, which stream
# their rows in batches.
MAX_TASKS = 5_000
# Bytes a row has at least, all told: a file's size bounds how many ranges row ids are cut into.
LEAST_ROW_BYTES = 16
# Neighbouring ids looked at to guess a range's rows.
PROBED = 8


@dataclass(frozen=True)
class TableInfo:
    name: str
    schema: T.StructType
    not_null: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...]
    defaults: dict[str, object]
    has_rowid: bool
    # Whether `_id` is the row id, and so present and unique.
    sure_ids: bool = False
    # Columns without a type.
    untyped: tuple[str, ...] = ()


def is_sqlite(path: str) -> bool:
    with open(path, "rb") as f:
        return f.read(len(MAGIC)) == MAGIC


class Text(bytes):
    """A text as stored, to tell it from a blob."""

    def decoded(self) -> str:
        return decoded(self)


# Fixed value: characters that stand for the bytes 0x80 to 0xFF of what is no text, of the private range.
STRAY = 0x10FE00
# Fixed value: how the UTF-8 form of one of them begins.
STRAY_BYTES = (b"\xf4\x8f\xba", b"\xf4\x8f\xbb")


def decoded(raw: bytes) -> str:
    """The text of some bytes, different for different ones.

    Bytes that are not UTF-8 become a private character each, and so do the bytes of such a character that was there before.
    """
    try:
        text = raw.decode()
        if not any(s in raw for s in STRAY_BYTES):
            return text
    except UnicodeDecodeError:
        text = raw.decode("utf-8", "surrogateescape")
    return "".join(_escaped(c) for c in text)


def _escaped(c: str) -> str:
    if 0xDC80 <= ord(c) <= 0xDCFF:
        return chr(STRAY + ord(c) - 0xDC00)
    if STRAY + 0x80 <= ord(c) <= STRAY + 0xFF:
        return "".join(chr(STRAY + b) for b in c.encode())
    return c


def encoded(text: str) -> bytes:
    """The bytes `decoded` made a text of."""
    stray = {STRAY + b: 0xDC00 + b for b in range(0x80, 0x100)}
    return text.translate(stray).encode("utf-8", "surrogateescape")


# Fixed value: what a value begins with that is not held as its plain bytes, then a letter for its storage class.
MARK = b"\x00sediment\x00"
CLASSES = {"i": "integer", "r": "real", "t": "text", "b": "blob"}


def tagged(value, untyped: bool = True) -> bytes:
    """A value of a binary column as bytes.

    In a column without a type, different ones for different values and storage classes: plain bytes are a text if they are UTF-8
    and a blob if not, all else is marked. In a column of blobs a text is its plain bytes too, and numbers are marked.
    """
    if not isinstance(value, bytes):
        return MARK + (b"r" if isinstance(value, float) else b"i") + repr(value).encode()
    text = isinstance(value, Text)
    plain = not value.startswith(MARK) and (not untyped or text != broken(value))
    return bytes(value) if plain else MARK + (b"t" if text else b"b") + value


def restored(value: bytes, untyped: bool = True):
    """The value `tagged` made bytes of; a text comes as the bytes it was stored as."""
    if not value.startswith(MARK):
        return Text(value) if untyped and not broken(value) else value
    letter, rest = value[len(MARK) : len(MARK) + 1], value[len(MARK) + 1 :]
    return {b"t": Text, b"b": bytes, b"r": float, b"i": int}[letter](rest)


def stored(column: Column) -> Column:
    """What a column without a type held: `class` (integer, real, text or blob), `text` of what is no blob, `bytes` of what is."""
    letter = F.substring(column, len(MARK) + 1, 1).cast("string")
    marked = F.substring(column, 1, len(MARK)) == F.lit(MARK)
    value = F.when(marked, F.substring(column, len(MARK) + 2, 2**31 - 1)).otherwise(column)
    names = F.create_map(*(F.lit(x) for kv in CLASSES.items() for x in kv))
    kind = F.when(marked, names[letter]).when(F.is_valid_utf8(column.cast("string")), "text").otherwise("blob")
    return F.struct(
        F.when(column.isNotNull(), kind).alias("class"),
        F.when(kind != "blob", F.make_valid_utf8(value.cast("string"))).alias("text"),
        F.when(kind == "blob", value).alias("bytes"),
    )


def broken(raw: bytes) -> bool:
    """Whether some bytes are no UTF-8 text."""
    try:
        raw.decode()
    except UnicodeDecodeError:
        return True
    return False


def connect(path: str) -> sqlite3.Connection:
    """A connection that cannot write."""
    connection = sqlite3.connect(f"file:{quote(str(Path(path).absolute()))}?mode=ro", uri=True)
    connection.text_factory = Text
    return connection


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def spark_type(declared: str) -> T.DataType:
    """Spark type for a declared column type, by SQLite's affinity rules."""
    upper = (declared or "").upper()
    if "INT" in upper or "BOOL" in upper:
        return T.LongType()
    if any(part in upper for part in ("CHAR", "CLOB", "TEXT")):
        return T.StringType()
    if any(part in upper for part in ("REAL", "FLOA", "DOUB")):
        return T.DoubleType()
    # Without a type a column holds whatever it is given, mostly blobs.
    return T.BinaryType() if "BLOB" in upper or not upper.strip() else T.StringType()


def catalog(path: str) -> dict[str, TableInfo]:
    """All tables of the file with their columns and declared constraints. Reads no rows."""
    with connect(path) as c:
        c.text_factory = str
        names = [r[0] for r in c.execute("select name from sqlite_master where type = 'table'")]
        return {n: _table_info(c, n) for n in names}


def _table_info(c: sqlite3.Connection, table: str) -> TableInfo:
    columns = c.execute(f"pragma table_info({quoted(table)})").fetchall()
    fields = [T.StructField(name, spark_type(kind)) for _, name, kind, *_ in columns]
    primary = tuple(name for _, name, *_, place in sorted(columns, key=lambda r: r[5]) if place)
    unique = [primary] if primary else []
    for _, index, is_unique, _, partial in c.execute(f"pragma index_list({quoted(table)})").fetchall():
        members = tuple(r[2] for r in c.execute(f"pragma index_info({quoted(index)})"))
        if is_unique and not partial and None not in members:
            unique.append(members)
    # A leading `_id` is renumbered, so nothing it declares can be broken.
    renumbered = bool(columns) and columns[0][1] == "_id"
    not_null = [name for _, name, _, required, _, place in columns if required or place]
    id_type = {name: (kind or "").strip().upper() for _, name, kind, *_ in columns}.get("_id")
    defaults = {
        name: c.execute(f"select {text}").fetchone()[0] for _, name, _, _, text, _ in columns if text is not None
    }
    return TableInfo(
        table,
        T.StructType(fields),
        tuple(n for n in not_null if not (renumbered and n == "_id")),
        tuple(k for k in dict.fromkeys(unique) if not (renumbered and k == ("_id",))),
        defaults,
        _has_rowid(c, table),
        primary == ("_id",) and (id_type == "INTEGER" or "_id" in (n for _, n, _, required, *_ in columns if required)),
        tuple(name for _, name, kind, *_ in columns if not (kind or "").strip()),
    )


def _has_rowid(c: sqlite3.Connection, table: str) -> bool:
    try:
        c.execute(f"select rowid from {quoted(table)} limit 0")
    except sqlite3.OperationalError:
        return False
    return True


@dataclass
class RowRange(InputPartition):
    """Rows of one file with row ids from `low` to `high`; all rows if there is no row id."""

    snapshot: int
    path: str
    low: int | None = None
    high: int | None = None


def fitted(value, kind: T.DataType, untyped: bool = False):
    """The value as `kind`, or None: a SQLite column may hold values of any type.

    A text in a column of numbers is none: one that looks like a number would have been stored as one.
    """
    if value is None:
        return None
    if isinstance(kind, T.LongType):
        whole = isinstance(value, int) or (isinstance(value, float) and value.is_integer())
        return int(value) if whole and -(2**63) <= value < 2**63 else None
    if isinstance(kind, T.DoubleType):
        return float(value) if isinstance(value, (int, float)) else None
    if isinstance(kind, T.BinaryType):
        return tagged(value, untyped)
    return decoded(value) if isinstance(value, bytes) else str(value)


def plain_array(values: tuple, kind: T.DataType, arrow: pa.DataType, untyped: bool = False) -> pa.Array | None:
    """A column at once, if each of its values is of the type, and each text is UTF-8; else None."""
    try:
        if isinstance(kind, T.StringType):
            if any(isinstance(v, bytes) and not isinstance(v, Text) for v in values):
                return None
            raw = pa.array(values, pa.binary())
            data = raw.buffers()[2]
            if data is not None and any(s in memoryview(data).tobytes() for s in STRAY_BYTES):
                return None
            # The cast checks that it is UTF-8.
            return raw.cast(arrow)
        if isinstance(kind, T.BinaryType):
            if any(isinstance(v, Text) != untyped or v.startswith(MARK) for v in values if isinstance(v, bytes)):
                return None
            if untyped:
                pa.array(values, pa.binary()).cast(pa.string())
        # Arrow would cut off what follows a point.
        elif any(isinstance(v, (Text, float) if isinstance(kind, T.LongType) else Text) for v in values):
            return None
        return pa.array(values, arrow)
    except (pa.ArrowInvalid, pa.ArrowTypeError, pa.ArrowNotImplementedError, OverflowError, TypeError):
        return None


def column_array(values: tuple, kind: T.DataType, arrow: pa.DataType, untyped: bool = False) -> pa.Array:
    """A column, value by value only if one of them is of another type."""
    found = plain_array(values, kind, arrow, untyped)
    return pa.array([fitted(v, kind, untyped) for v in values], arrow) if found is None else found


def changed(value, kind: T.DataType) -> bool:
    """Whether a value is not read as what it is: it has no place in the type, a text has bytes or characters that were escaped, or
    a blob is among texts. Binary columns keep all bytes."""
    if value is None or isinstance(kind, T.BinaryType):
        return False
    if isinstance(kind, T.StringType) and isinstance(value, bytes):
        return not isinstance(value, Text) or decoded(value).encode() != value
    return fitted(value, kind) is None


# Columns of the count of values that do not fit their column's type.
MISFITS = T.StructType(
    [T.StructField(SNAPSHOT, T.IntegerType()), T.StructField("column", T.StringType()), T.StructField("n", T.LongType())]
)


class SqliteReader(DataSourceReader):
    """Reads one table of one or more files; a column SNAPSHOT tells the files apart."""

    def __init__(self, options: dict, schema: T.StructType):
        self.files = json.loads(options["files"])
        self.table = options["table"]
        self.has_rowid = options.get("has_rowid", "true") == "true"
        self.rows_per_task = int(options.get("rows_per_task", ROWS_PER_TASK))
        self.count_misfits = options.get("misfits", "false") == "true"
        self.untyped = set(json.loads(options.get("untyped", "[]")))
        self.tagged = SNAPSHOT in schema.names
        self.output = schema
        self.columns = T.StructType([f for f in schema.fields if f.name != SNAPSHOT])
        if self.count_misfits:
            self.columns = catalog(self.files[0][1])[self.table].schema

    def partitions(self) -> Sequence[InputPartition]:
        if not self.has_rowid:
            return [RowRange(i, path) for i, path in self.files]
        return [part for i, path in self.files for part in self._ranges(i, path)]

    def _ranges(self, snapshot: int, path: str) -> list[RowRange]:
        """Ranges of row ids of about as many rows each, found by looking up some ids, not by reading rows.

        A range's rows are guessed from the smallest gap between neighbours at its ends and middle. The largest one is halved, and both
        halves are drawn in to the ids they hold, until none is too large or there are as many as the file's size can ask for.
        So ids far apart, or in a few clusters, give neither empty tasks nor large ones.
        """
        table, per_task = quoted(self.table), self.rows_per_task
        up, down = (f"select rowid from {table} where rowid {op} ? order by rowid {way} limit {PROBED}" for op, way in ((">=", "asc"), ("<=", "desc")))
        with connect(path) as c:

            def range_of(low: int, high: int) -> tuple[int, int, int]:
                probes = (c.execute(sql, (at,)).fetchall() for sql, at in ((up, low), (up, low + (high - low) // 2), (down, high)))
                gaps = (max(abs(ids[-1][0] - ids[0][0]) // (len(ids) - 1), 1) for ids in probes if len(ids) > 1)
                return -((high - low) // min(gaps, default=1) + 1), low, high

            low, high = c.execute(f"select min(rowid), max(rowid) from {table}").fetchone()
            if low is None:
                return [RowRange(snapshot, path, 0, -1)]
            ranges, most = [range_of(low, high)], min(MAX_TASKS, 2 * (Path(path).stat().st_size // (per_task * LEAST_ROW_BYTES)) + 2)
            while len(ranges) < most and -ranges[0][0] > per_task:
                rows, a, b = heappop(ranges)
                # The left half holds whole tasks.
                step = (b - a + 1) * per_task // -rows
                middle = a + max(-(-(-rows) // per_task) // 2, 1) * step - 1
                heappush(ranges, range_of(a, c.execute(down, (middle,)).fetchone()[0]))
                heappush(ranges, range_of(c.execute(up, (middle + 1,)).fetchone()[0], b))
        return [RowRange(snapshot, path, a, b) for a, b in sorted((a, b) for _, a, b in ranges)]

    def read(self, partition: RowRange) -> Iterator[pa.RecordBatch]:
        columns = ", ".join(quoted(f.name) for f in self.columns.fields) or "null"
        query, bounds = f"select {columns} from {quoted(self.table)}", ()
        if partition.low is not None:
            query, bounds = f"{query} where rowid between ? and ?", (partition.low, partition.high)
        connection = connect(partition.path)
        try:
            cursor = connection.execute(query, bounds)
            while rows := cursor.fetchmany(BATCH_ROWS):
                yield self.misfit_batch(rows, partition.snapshot) if self.count_misfits else self.batch(rows, partition.snapshot)
        finally:
            connection.close()

    def batch(self, rows: list[tuple], snapshot: int) -> pa.RecordBatch:
        arrow = to_arrow_schema(self.output)
        held = dict(zip(self.columns.names, zip(*rows)))
        values = [
            pa.array([snapshot] * len(rows), arrow.field(f.name).type)
            if self.tagged and f.name == SNAPSHOT
            else column_array(held[f.name], f.dataType, arrow.field(f.name).type, f.name in self.untyped)
            for f in self.output.fields
        ]
        return pa.RecordBatch.from_arrays(values, schema=arrow)

    def misfit_batch(self, rows: list[tuple], snapshot: int) -> pa.RecordBatch:
        """Values are only looked at where a column could not be read at once."""
        held = dict(zip(self.columns.names, zip(*rows)))
        arrow = to_arrow_schema(self.columns)
        lost = []
        for f in self.columns.fields:
            values, untyped = held[f.name], f.name in self.untyped
            read = plain_array(values, f.dataType, arrow.field(f.name).type, untyped)
            lost.append(sum(changed(v, f.dataType) for v in values) if read is None else 0)
        return pa.RecordBatch.from_arrays(
            [pa.array([snapshot] * len(lost), pa.int32()), pa.array(self.columns.names), pa.array(lost, pa.int64())],
            schema=to_arrow_schema(MISFITS),
        )


class SqliteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        return catalog(json.loads(self.options["files"])[0][1])[self.options["table"]].schema

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return SqliteReader(dict(self.options), schema)


def register(spark: SparkSession) -> None:
    # Sent by value, so executors need no copy of this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(SqliteSource)


def _scan(spark: SparkSession, files: Sequence[tuple[int, str]], info: TableInfo, schema: T.StructType, **options):
    register(spark)
    absolute = [[i, str(Path(path).absolute())] for i, path in files]
    reader = spark.read.format(FORMAT).schema(schema).option("files", json.dumps(absolute)).option("table", info.name)
    reader = reader.option("untyped", json.dumps(info.untyped))
    return reader.option("has_rowid", "true" if info.has_rowid else "false").options(**options).load()


def read(
    spark: SparkSession,
    path: str,
    info: TableInfo,
    columns: Sequence[str] | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """A table of one file; only `columns` leave it."""
    wanted = info.schema if columns is None else T.StructType([info.schema[c] for c in columns])
    return _scan(spark, [(0, path)], info, wanted, rows_per_task=rows_per_task)


def read_many(
    spark: SparkSession, files: Sequence[tuple[int, str]], info: TableInfo, columns: Sequence[str]
) -> DataFrame:
    """A table of several files of the same schema in one scan, with SNAPSHOT ahead of the columns."""
    fields = [T.StructField(SNAPSHOT, T.IntegerType()), *(info.schema[c] for c in columns)]
    return _scan(spark, files, info, T.StructType(fields))


def misfits(spark: SparkSession, files: Sequence[tuple[int, str]], info: TableInfo) -> DataFrame:
    """(SNAPSHOT, column, n): how many values of each file's columns are not read as they are.

    They become null if they are of another type; bytes that are not UTF-8 become private characters, and a blob among texts a text.
    Columns without a type lose nothing, and columns of blobs keep the bytes of a text.
    """
    counted = _scan(spark, files, info, MISFITS, misfits="true")
    return counted.groupBy(SNAPSHOT, "column").agg(F.sum("n").alias("n")).where("n > 0")
