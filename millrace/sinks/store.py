"""Parquet tables under one root that change together: a commit is one new file, ``_log/<number>.json``.

Every commit writes its rows to new folders (``<table>/batch=<number>[/event_date=<day>]``) and then names, in one small
file that is renamed into place, the folders that make up each table. Until that rename readers see the old tables,
after it the new ones, whatever step a writer stops at. Files are never changed; ``vacuum`` deletes what no kept
commit names.

A table with keys is an upsert log: a batch holds only the rows it brings, and of equal keys the latest batch wins when
the table is read (merge on read). ``compact`` rewrites the days that are spread over many batches. Written bytes
therefore follow the increment, not the size of the days it touches. Days with one batch are read without any merge.

One writer at a time; a second one finds its number taken and fails with ``Conflict`` before it is visible.
"""

import datetime as dt
import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.dedupe import dedupe_last

DATE = "event_date"
BATCH = "batch"
_LOG = "_log"
NO_DATE = "__HIVE_DEFAULT_PARTITION__"
MOST_BATCHES = 8


class Conflict(RuntimeError):
    """Another writer has committed since the snapshot was taken."""


class Files:
    """The few file operations a commit needs, on whatever file system the path names."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _open(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self._conf)

    def names(self, path: str) -> list[str]:
        p, system = self._open(path)
        return sorted(s.getPath().getName() for s in system.listStatus(p)) if system.exists(p) else []

    def exists(self, path: str) -> bool:
        p, system = self._open(path)
        return system.exists(p)

    def read(self, path: str) -> str:
        p, system = self._open(path)
        stream = system.open(p)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        p, system = self._open(path)
        stream = system.create(p, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def rename(self, old: str, new: str) -> bool:
        p, system = self._open(old)
        return system.rename(p, self._jvm.org.apache.hadoop.fs.Path(new))

    def delete(self, path: str) -> None:
        p, system = self._open(path)
        system.delete(p, True)


def without(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is not in ``other``; a null (an open window end) equals a null."""
    taken = other.select(*[F.col(c).alias(f"_taken_{c}") for c in keys])
    equal = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_taken_{c}")) for c in keys])
    return df.join(taken, equal, "left_anti")


@dataclass(frozen=True)
class Change:
    """New rows of a table. With ``keys`` they replace stored rows of equal keys and must be one per key; without, they
    are added. ``dated`` tables have the column ``event_date``. ``replace`` drops what was there."""

    table: str
    rows: DataFrame
    keys: Sequence[str] = ()
    dated: bool = True
    replace: bool = False


@dataclass(frozen=True)
class Snapshot:
    """The tables as of one commit. ``marks`` are numbers committed with them."""

    store: "Store"
    number: int = 0
    tables: dict[str, dict] = field(default_factory=dict)
    marks: dict[str, int] = field(default_factory=dict)

    def has(self, table: str) -> bool:
        return table in self.tables

    def days(self, table: str) -> list[dt.date]:
        """The days a dated table has rows for, in order."""
        parts = self.tables.get(table, {}).get("parts", {})
        return sorted(dt.date.fromisoformat(p) for p in parts if p != NO_DATE)

    def read(self, table: str, days: Iterable[dt.date] | None = None, since: int = 0) -> DataFrame:
        """The table, merged. ``days``: only these days, whose files alone are listed; ``since``: only rows of batches
        after that commit (a compacted batch holds older rows too)."""
        about = self.tables[table]
        parts = about["parts"]
        if days is not None:
            parts = {str(d): parts[str(d)] for d in sorted(set(days)) if str(d) in parts}
        keys, single, first, later = about["keys"], [], [], []
        for part, batches in parts.items():
            batches = [b for b in batches if b > since]
            if keys and len(batches) > 1:
                first.append((part, batches[0]))
                later += [(part, b) for b in batches[1:]]
            else:
                single += [(part, b) for b in batches]
        rows = self._scan(table, single).drop(BATCH)
        if first:
            last = self._scan(table, later)
            # A batch has one row for each key.
            last = (dedupe_last(last, keys, [BATCH]) if len({b for _, b in later}) > 1 else last).drop(BATCH)
            rows = rows.unionByName(without(self._scan(table, first).drop(BATCH), last, keys)).unionByName(last)
        return rows

    def _scan(self, table: str, found: list[tuple[str, int]]) -> DataFrame:
        about, spark = self.tables[table], self.store.spark
        schema = T.StructType.fromJson(about["schema"]).add(BATCH, T.LongType())
        schema = schema.add(DATE, T.DateType()) if about["dated"] else schema
        if not found:
            return spark.createDataFrame([], schema)
        folder = f"{self.store.root}/{table}"
        paths = [f"{folder}/{BATCH}={b}" + (f"/{DATE}={part}" if about["dated"] else "") for part, b in found]
        return spark.read.schema(schema).option("basePath", folder).parquet(*paths)


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark)

    def _numbers(self) -> list[int]:
        names = self.files.names(f"{self.root}/{_LOG}")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _entry(self, number: int) -> str:
        return f"{self.root}/{_LOG}/{number:012d}.json"

    def snapshot(self, number: int | None = None) -> Snapshot:
        """The latest commit, or the one named; an empty snapshot before the first."""
        if number is None:
            numbers = self._numbers()
            if not numbers:
                return Snapshot(self)
            number = numbers[-1]
        return Snapshot(self, number, **json.loads(self.files.read(self._entry(number))))

    def read(self, table: str) -> DataFrame:
        return self.snapshot().read(table)

    def _write(self, change: Change, number: int) -> list[str]:
        folder = f"{self.root}/{change.table}/{BATCH}={number}"
        rows = change.rows
        if change.dated:
            rows = rows.hint("rebalance", DATE).sortWithinPartitions(DATE, *[c for c in change.keys if c != DATE])
        # An attempt that stopped before its commit may have left files under this number.
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
        if not change.dated:
            writer.parquet(folder)
            return [""]
        writer.partitionBy(DATE).parquet(folder)
        head = f"{DATE}="
        return [n.removeprefix(head) for n in self.files.names(folder) if n.startswith(head)]

    def commit(self, base: Snapshot, changes: Sequence[Change], marks: dict[str, int] | None = None) -> Snapshot:
        """Write the changes on top of ``base`` and make them visible together, with ``marks``."""
        number = base.number + 1
        if self.files.exists(self._entry(number)):
            raise Conflict(f"commit {number} of {self.root} is taken")
        tables = {name: about | {"parts": dict(about["parts"])} for name, about in base.tables.items()}
        for change in changes:
            fields = [f for f in change.rows.schema.fields if not (change.dated and f.name == DATE)]
            old = tables.get(change.table)
            known = T.StructType.fromJson(old["schema"]).fields if old else []
            names = {f.name for f in known}
            fields = fields if change.replace else known + [f for f in fields if f.name not in names]
            parts = {} if old is None or change.replace else old["parts"]
            for part in self._write(change, number):
                parts[part] = [*parts.get(part, []), number]
            tables[change.table] = {
                "schema": json.loads(T.StructType(fields).json()), "keys": list(change.keys), "dated": change.dated,
                "parts": parts,
            }
        return self._publish(number, tables, base.marks | (marks or {}))

    def _publish(self, number: int, tables: dict, marks: dict) -> Snapshot:
        draft = f"{self.root}/{_LOG}/.{number:012d}.draft"
        self.files.write(draft, json.dumps({"tables": tables, "marks": marks}))
        if self.files.exists(self._entry(number)) or not self.files.rename(draft, self._entry(number)):
            raise Conflict(f"commit {number} of {self.root} is taken")
        return Snapshot(self, number, tables, marks)

    def compact(self, base: Snapshot, most: int = MOST_BATCHES) -> Snapshot:
        """Rewrite every day (or undated table) that is spread over more than ``most`` batches as one batch."""
        number, tables, wrote = base.number + 1, dict(base.tables), False
        for name, about in base.tables.items():
            crowded = {p: b for p, b in about["parts"].items() if len(b) > most}
            if not crowded:
                continue
            part = Snapshot(self, base.number, {name: about | {"parts": crowded}}, {})
            change = Change(name, part.read(name), about["keys"], about["dated"])
            parts = {p: b for p, b in about["parts"].items() if p not in crowded}
            parts |= {p: [number] for p in self._write(change, number)}
            tables[name], wrote = about | {"parts": parts}, True
        return self._publish(number, tables, base.marks) if wrote else base

    def vacuum(self, keep: int = 10) -> None:
        """Delete all but the last ``keep`` commits and the files that none of these name. Readers of a snapshot have
        that many commits of time."""
        numbers = self._numbers()
        kept = [self.snapshot(n) for n in numbers[-keep:]]
        # The log goes first: what it names must exist.
        for n in numbers[:-keep]:
            self.files.delete(self._entry(n))
        names = {name for s in kept for name in s.tables}
        for name in names:
            used = {(b, p) for s in kept if name in s.tables for p, bs in s.tables[name]["parts"].items() for b in bs}
            dated = any(name in s.tables and s.tables[name]["dated"] for s in kept)
            for folder in self.files.names(f"{self.root}/{name}"):
                number = folder.removeprefix(f"{BATCH}=")
                if not number.isdigit() or int(number) > numbers[-1]:
                    continue
                path = f"{self.root}/{name}/{folder}"
                if not any(b == int(number) for b, _ in used):
                    self.files.delete(path)
                elif dated:
                    for day in self.files.names(path):
                        if day.startswith(f"{DATE}=") and (int(number), day.removeprefix(f"{DATE}=")) not in used:
                            self.files.delete(f"{path}/{day}")


def is_store(spark: SparkSession, root: str) -> bool:
    return Files(spark).exists(f"{root.rstrip('/')}/{_LOG}")
