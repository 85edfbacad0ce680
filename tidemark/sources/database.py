"""Key windows read in the database: it hashes rows and XORs children itself, and a window that fails is a row and not a
failed job. A Python data source over any DB-API driver."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from contextlib import suppress
from dataclasses import asdict, dataclass
from importlib import import_module

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tidemark.operators.capture import diff_windows
from tidemark.scratch import cut
from tidemark.sources.windows import MAX_WINDOWS

HASHES = pa.schema([("window_no", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64()), ("pk", pa.int64()), ("row_hash", pa.int64()), ("error", pa.string())])
HASHES_DDL = "window_no bigint, lo bigint, hi bigint, pk bigint, row_hash bigint, error string"


@dataclass(frozen=True)
class DbChild:
    """A child table; ``row_filter`` is a condition in the database's SQL."""

    table: str
    fk: str
    hashed: Sequence[str]
    row_filter: str | None = None


@dataclass(frozen=True)
class DbEntity:
    """A primary table with its children, and how to reach and to ask its database. Names and conditions are the caller's
    configuration and go into the SQL as they are.

    ``connect`` is ``module:function``, importable where tasks run: it takes ``database`` and gives a DB-API connection.
    ``row_hash`` and ``fold`` are the database's functions, ``mark`` its place-holder; the defaults hash as
    ``operators.capture.entity_hashes`` with ``exact=False`` does. The connection decides about isolation; a window's
    statements stand in one transaction of it.
    """

    connect: str
    database: str
    table: str
    pk: str
    hashed: Sequence[str]
    children: Sequence[DbChild] = ()
    row_hash: str = "CRC32(CONCAT_WS(',', {}))"
    fold: str = "BIT_XOR({})"
    mark: str = "?"

    def __post_init__(self):
        bare = [x.table for x in (self, *self.children) if not x.hashed]
        if bare:
            raise ValueError(f"no hashed columns: {', '.join(bare)}")

    def text(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def of(text: str) -> DbEntity:
        d = json.loads(text)
        return DbEntity(**{**d, "children": [DbChild(**c) for c in d["children"]]})

    def open(self):
        module, _, function = self.connect.partition(":")
        return getattr(import_module(module), function)(self.database)

    def primary_sql(self, inside: str) -> str:
        return f"SELECT {self.pk}, {self.row_hash.format(', '.join(self.hashed))} FROM {self.table} WHERE {self.pk} {inside}"

    def child_sql(self, child: DbChild, inside: str) -> str:
        own = f" AND ({child.row_filter})" if child.row_filter else ""
        return f"SELECT {child.fk}, {self.fold.format(self.row_hash.format(', '.join(child.hashed)))} FROM {child.table} WHERE {child.fk} {inside}{own} GROUP BY {child.fk}"


def _pairs(connection, sql: str, values: Sequence[int], fetch: int) -> tuple[np.ndarray, np.ndarray]:
    cursor, parts = connection.cursor(), []
    try:
        cursor.execute(sql, tuple(values))
        while rows := cursor.fetchmany(fetch):
            parts.append(np.array([(int(k), int(h)) for k, h in rows], np.int64))
    finally:
        cursor.close()
    both = np.concatenate(parts) if parts else np.empty((0, 2), np.int64)
    return both[:, 0], both[:, 1]


def _hashes(connection, entity: DbEntity, inside: str, values: Sequence[int], fetch: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys and folded hashes of what is ``inside``; children without a primary row fall away."""
    keys, hashes = _pairs(connection, entity.primary_sql(inside), values, fetch)
    order = np.argsort(keys, kind="stable")
    keys, hashes = keys[order], hashes[order]
    for child in entity.children:
        fks, folds = _pairs(connection, entity.child_sql(child, inside), values, fetch)
        at = np.searchsorted(keys, fks)
        mine = at < len(keys)
        mine[mine] = keys[at[mine]] == fks[mine]
        hashes[at[mine]] ^= folds[mine]
    return keys, hashes


class _Reader:
    """Reads windows one after another over one connection, a new one after a failure."""

    def __init__(self, entity: DbEntity, fetch: int, tries: int):
        self.entity, self.fetch, self.tries, self.connection = entity, fetch, max(1, tries), None

    def read(self, inside: str, values: Sequence[int]) -> tuple[np.ndarray, np.ndarray] | str:
        """Keys and hashes, or the message of the last failure. Whatever a driver raises is the window's failure."""
        for _ in range(self.tries):
            try:
                self.connection = self.connection or self.entity.open()
                found = _hashes(self.connection, self.entity, inside, values, self.fetch)
                self.connection.rollback()
                return found
            except Exception as e:
                error = f"{type(e).__name__}: {e}"
                self.close()
        return error

    def close(self) -> None:
        connection, self.connection = self.connection, None
        if connection is not None:
            with suppress(Exception):
                connection.close()


def _batch(number: Sequence[int] | int, lo, hi, keys, hashes, error) -> pa.RecordBatch:
    n = len(lo)
    columns = [np.full(n, number, np.int64), lo, hi, keys, hashes, [error] * n]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, HASHES.types)], schema=HASHES)


@dataclass
class WindowRange(InputPartition):
    first: int
    last: int


class KeyWindowReader(DataSourceReader):
    def __init__(self, options):
        self.entity = DbEntity.of(options["entity"])
        self.lo, self.hi, self.rows = int(options["lo"]), int(options["hi"]), int(options.get("rows", "500000"))
        self.fetch, self.tries, self.parts = int(options.get("fetch", "10000")), int(options.get("tries", "1")), int(options.get("partitions", "200"))
        if self.rows < 1 or self.parts < 1:
            raise ValueError("rows and partitions must be positive")
        self.n = (self.hi - self.lo) // self.rows + 1 if self.hi >= self.lo else 0
        if self.n > MAX_WINDOWS:
            raise ValueError(f"{self.n} windows; {MAX_WINDOWS} at most")

    def partitions(self) -> list[WindowRange]:
        parts = min(self.n, self.parts)
        edges = [self.n * k // parts for k in range(parts + 1)] if parts else []
        return [WindowRange(a, b - 1) for a, b in zip(edges, edges[1:])] or [WindowRange(0, -1)]

    def read(self, partition: WindowRange) -> Iterator[pa.RecordBatch]:
        reader = _Reader(self.entity, self.fetch, self.tries)
        try:
            for w in range(partition.first, partition.last + 1):
                lo = self.lo + w * self.rows
                hi = min(lo + self.rows - 1, self.hi)
                found = reader.read(f"BETWEEN {self.entity.mark} AND {self.entity.mark}", (lo, hi))
                if isinstance(found, str):
                    yield _batch(w, [lo], [hi], [None], [None], found)
                else:
                    n = len(found[0])
                    yield _batch(w, np.full(n, lo, np.int64), np.full(n, hi, np.int64), *found, None)
        finally:
            reader.close()


class KeyWindows(DataSource):
    """Format ``key_windows``: rows HASHES_DDL. A key that is there has ``pk`` and ``row_hash``; a window that failed is one
    row with its ``error`` and no key, whatever it had read before."""

    @classmethod
    def name(cls) -> str:
        return "key_windows"

    def schema(self) -> str:
        return HASHES_DDL

    def reader(self, schema) -> KeyWindowReader:
        return KeyWindowReader(self.options)


def database_envelope(entity: DbEntity) -> tuple[int, int] | None:
    """(lo, hi) of the primary table's keys, None if it has none."""
    connection = entity.open()
    try:
        cursor = connection.cursor()
        cursor.execute(f"SELECT MIN({entity.pk}), MAX({entity.pk}) FROM {entity.table}")
        lo, hi = cursor.fetchone()
    finally:
        connection.close()
    return None if lo is None else (int(lo), int(hi))


def database_hashes(spark: SparkSession, entity: DbEntity, lo: int, hi: int, **options: int) -> DataFrame:
    """Rows HASHES_DDL of the keys from ``lo`` to ``hi``. Options: ``rows`` of keys a window, ``fetch`` rows a call,
    ``tries`` a window, ``partitions`` at most, which is how many connections there may be."""
    spark.dataSource.register(KeyWindows)
    return spark.read.format("key_windows").options(entity=entity.text(), lo=lo, hi=hi, **options).load()


def targeted_hashes(keys: DataFrame, entity: DbEntity, rows: int = 500, fetch: int = 10_000, tries: int = 1) -> DataFrame:
    """Rows HASHES_DDL of the given keys (pk): each task asks for its keys in lists of ``rows``. The keys of a list that
    fails come back one by one with its ``error``, as windows of one key."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = _Reader(entity, fetch, tries)
        try:
            for batch in batches:
                every = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
                for k in range(0, len(every), rows):
                    some = every[k : k + rows]
                    found = reader.read(f"IN ({', '.join([entity.mark] * len(some))})", some.tolist())
                    if isinstance(found, str):
                        yield _batch(some, some, some, [None] * len(some), [None] * len(some), found)
                    else:
                        yield _batch(found[0], found[0], found[0], *found, None)
        finally:
            reader.close()

    return keys.where("pk IS NOT NULL").select(F.col("pk").cast("bigint")).distinct().mapInArrow(ask, HASHES_DDL)


def database_changes(found: DataFrame, snapshot: DataFrame, judged: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """(changes, failed) of hashes read from a database against a snapshot (pk, row_hash): (pk, op, row_hash), and
    (window_no, lo, hi, error). The database is read once. Keys of failed windows aren't judged; ``judged`` narrows the
    snapshot to what was asked for, as a semi join with targeted keys does."""
    found = cut(found, "database-hashes")
    failed = found.where("error IS NOT NULL").select("window_no", "lo", "hi", "error")
    current = found.where("error IS NULL").select("pk", "row_hash")
    known = snapshot if judged is None else judged(snapshot)
    return diff_windows(current, known, failed.select("window_no", "lo", "hi"), failed.select("window_no")), failed
