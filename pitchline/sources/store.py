"""Stored tables with one commit: runs of rows, named by a manifest.

A table is a list of *runs*. A transaction writes new runs into folders of their
own and then publishes a manifest, one small JSON file that names the runs of every
table, by one rename. Readers resolve the newest manifest once and read the runs it
names: all tables of one transaction or none. A transaction that fails leaves folders
that no manifest names; a later commit removes them.

Rows are never changed in place. A *keyed* table holds the newest row of a key (by
``batch_id``; a row marked ``gone`` ends its key), a *summed* table is merged by its
own function, and an *added* table holds all rows. Runs are levelled: ``fan`` runs of
one level are merged into one of the next, so a reader meets at most ``fan`` runs a
level and a logarithm of the transactions in levels, whatever the history.

The rename is atomic on HDFS and POSIX file systems; two writers on one store are
not supported, as a streaming query has one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUN = "run"


class Table(NamedTuple):
    """Columns, partition columns and how rows of one key are merged.

    ``keys`` names the key of a keyed table; ``merge`` merges the rows of a summed one.
    """

    schema: str
    partitions: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()
    merge: Callable[[DataFrame], DataFrame] | None = None

    @property
    def columns(self) -> list[str]:
        return T.StructType.fromDDL(self.schema).names


class Files:
    """The file system of a folder, through the session's Hadoop configuration."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark._jsc.hadoopConfiguration())
        self._jvm = spark._jvm

    def names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return [s.getPath().getName() for s in self._fs.listStatus(path)] if self._fs.exists(path) else []

    def text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, path: str, text: str) -> None:
        """Write ``text`` beside ``path`` and rename it there; a file of that name stays and fails the call."""
        folder, name = path.rsplit("/", 1)
        draft = self._path(f"{folder}/.{name}-{uuid.uuid4().hex}")
        out = self._fs.create(draft, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if self._fs.exists(self._path(path)) or not self._fs.rename(draft, self._path(path)):
            self._fs.delete(draft, False)
            raise FileExistsError(path)

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


class Manifests:
    """Numbered JSON files of a folder, of which the newest counts and the last ``keep`` stay."""

    def __init__(self, spark: SparkSession, folder: str, keep: int = 2):
        self.files, self.folder, self.keep = Files(spark, folder), folder, keep

    def numbers(self) -> list[int]:
        """Newest first."""
        return sorted((int(n[:-5]) for n in self.files.names(self.folder) if n.endswith(".json") and n[:-5].isdigit()), reverse=True)

    def _path(self, number: int) -> str:
        return f"{self.folder}/{number:020d}.json"

    def read(self, number: int) -> dict:
        return json.loads(self.files.text(self._path(number)))

    def newest(self) -> dict | None:
        numbers = self.numbers()
        return self.read(numbers[0]) if numbers else None

    def commit(self, content: dict) -> list[dict]:
        """Publish ``content`` as the newest and return all manifests that stay, newest first."""
        numbers = self.numbers()
        number = numbers[0] + 1 if numbers else 0
        self.files.publish(self._path(number), json.dumps(content))
        for old in numbers[self.keep - 1 :]:
            self.files.remove(self._path(old))
        return [content, *[self.read(n) for n in numbers[: self.keep - 1]]]


class Snapshot:
    """The tables as one manifest names them."""

    def __init__(self, store: "Store", manifest: dict):
        self.store, self.manifest = store, manifest

    @property
    def batch(self) -> int:
        return self.manifest["batch"]

    def runs(self, name: str) -> list[dict]:
        return self.manifest["tables"].get(name, [])

    def rows(self, name: str, runs: list[dict] | None = None) -> DataFrame:
        """All stored rows of a table, older rows of a key included."""
        table = self.store.tables[name]
        runs = self.runs(name) if runs is None else runs
        schema = f"{table.schema}, {RUN} STRING"
        reader = self.store.spark.read.schema(schema)
        if not runs:
            return self.store.spark.createDataFrame([], schema).drop(RUN)
        base = f"{self.store.root}/data/{name}"
        return reader.option("basePath", base).parquet(*[f"{base}/{RUN}={r['name']}" for r in runs]).drop(RUN)

    def current(self, name: str, rows: DataFrame | None = None) -> DataFrame:
        """One row a key; ``rows`` may be a part of the table that holds whole keys."""
        rows = self.rows(name) if rows is None else rows
        return merged(self.store.tables[name], rows, single=len(self.runs(name)) == 1, ended=False)


def merged(table: Table, rows: DataFrame, single: bool = False, ended: bool = True) -> DataFrame:
    """The rows merged by key; ``ended`` keeps the rows that end a key."""
    if table.merge is not None:
        return rows if single else table.merge(rows)
    if not table.keys:
        return rows
    if not single:
        values = [c for c in rows.columns if c not in table.keys]
        newest = rows.groupBy(*table.keys).agg(F.expr(f"max_by(struct({', '.join(values)}), batch_id) AS v"))
        rows = newest.select(*[c if c in table.keys else F.col(f"v.{c}").alias(c) for c in rows.columns])
    return rows.where("NOT gone") if "gone" in rows.columns and not ended else rows


class Store:
    def __init__(self, spark: SparkSession, root: str, tables: dict[str, Table], fan: int = 8):
        self.spark, self.root, self.tables, self.fan = spark, root.rstrip("/"), tables, fan
        self.manifests = Manifests(spark, f"{self.root}/manifest")

    def snapshot(self) -> Snapshot:
        return Snapshot(self, self.manifests.newest() or {"batch": -1, "tables": {}})

    def begin(self, batch: int) -> "Transaction":
        return Transaction(self, self.snapshot(), batch)


class Transaction:
    """New runs for some tables, visible to others only after ``commit``."""

    WRITERS = 4

    def __init__(self, store: Store, before: Snapshot, batch: int):
        self.store, self.before, self.batch = store, before, batch
        self._pool, self._writes = ThreadPoolExecutor(self.WRITERS), []
        self.tables = {name: list(runs) for name, runs in before.manifest["tables"].items()}

    def write(self, name: str, df: DataFrame, level: int = 0) -> None:
        """Add ``df`` as a run, written beside other runs; ``commit`` waits for all of them.

        Rows are rebalanced by partition: small partitions become one file each.
        """
        run = {"name": f"{self.batch:012d}-{level}-{uuid.uuid4().hex}", "level": level}
        table = self.store.tables[name]
        writer = df.select(*table.columns)
        writer = (writer.hint("rebalance", *table.partitions) if table.partitions else writer.hint("rebalance")).write
        if table.partitions:
            writer = writer.partitionBy(*table.partitions)
        self._writes.append(self._pool.submit(writer.parquet, f"{self.store.root}/data/{name}/{RUN}={run['name']}"))
        self.tables.setdefault(name, []).append(run)

    def replace(self, name: str, df: DataFrame) -> None:
        """Let ``df`` be all of the table."""
        self.tables[name] = []
        self.write(name, df)

    def settle(self) -> None:
        """Wait for the writes; the first failure is raised."""
        while self._writes:
            self._writes.pop(0).result()

    def compact(self, name: str) -> None:
        """Merge ``fan`` runs of a level into one of the next, as often as there are so many."""
        level = 0
        while True:
            runs = self.tables.get(name, [])
            here = [r for r in runs if r["level"] == level]
            if len(here) >= self.store.fan:
                self.settle()
                rows = merged(self.store.tables[name], self.before.rows(name, here))
                self.tables[name] = [r for r in runs if r["level"] != level]
                self.write(name, rows, level + 1)
            elif not any(r["level"] > level for r in runs):
                return
            level += 1

    def commit(self, **notes) -> None:
        """Publish all runs by one rename; folders that no kept manifest names go afterwards."""
        for name in list(self.tables):
            self.compact(name)
        self.settle()
        self._pool.shutdown()
        kept = self.store.manifests.commit({"batch": self.batch, "tables": self.tables, **notes})
        files = self.store.manifests.files
        for name in self.store.tables:
            folder = f"{self.store.root}/data/{name}"
            named = {f"{RUN}={r['name']}" for m in kept for r in m["tables"].get(name, [])}
            for run in files.names(folder):
                if run.startswith(f"{RUN}=") and run not in named:
                    files.remove(f"{folder}/{run}")
