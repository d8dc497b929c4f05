"""Serving tables as parquet folders.

Three kinds, all written with plain parquet jobs:

* ``KeyedTable``: one row per key, the newest wins. Every micro-batch adds a folder named after
  its batch id, so a replayed batch overwrites its own folder and changes nothing. Reading
  takes the newest row per key. ``compact`` merges the folders into one.
* ``DayLog``: a keyed table that only grows, because the time is part of the key. Batches become
  runs of a day, runs of a day are merged in levels, and a commit file names the live ones.
* ``SnapshotTable``: replaced as a whole. Every write is a new version folder, and readers take
  the newest version that has its success marker.

One writer per table.
"""

from __future__ import annotations

import json
import re
from dataclasses import asdict, dataclass, field
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetpulse.operators.scoring import newest_per_key
from fleetpulse.schema import SERVING_TABLES
from fleetpulse.session import filesystem, remove


def completed_folders(spark: SparkSession, path: str, prefix: str) -> dict[int, str]:
    """Completed folders ``<prefix><number>`` below ``path``, by number."""
    fs, root = filesystem(spark, path)
    if not fs.exists(root):
        return {}
    found = {}
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        number = name[len(prefix) :]
        if name.startswith(prefix) and number.isdigit():
            marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}/_SUCCESS")
            if fs.exists(marker):
                found[int(number)] = f"{path}/{name}"
    return found


def commit_number(spark: SparkSession, root: str, batch_id: int) -> int:
    """A number for a micro-batch that grows over restarts, and stays when the batch is replayed.

    Batch ids begin at 0 again when a stream starts with a new checkpoint. Each stream notes under
    ``root/_runs`` from which number on it counts; a new one goes on after everything written there.
    """
    run = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if run is None:
        return batch_id
    fs, folder = filesystem(spark, f"{root}/_runs")
    names = [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []
    for name in names:
        base, _, known = name.partition(".")
        if known == run:
            return int(base) + batch_id
    base = 0
    root_path = folder.getParent()
    for table in fs.listStatus(root_path) if fs.exists(root_path) else []:
        if table.isDirectory():
            for written in fs.listStatus(table.getPath()):
                number = re.search(r"(?:slice=\w+-|version=|batch=)(\d+)$", written.getPath().getName())
                base = max(base, int(number[1]) + 1 if number else 0)
    fs.mkdirs(filesystem(spark, f"{root}/_runs/{base}.{run}")[1])
    return base + batch_id


@dataclass(frozen=True)
class KeyedTable:
    path: str
    schema: str
    keys: tuple[str, ...]
    newest_by: str | None

    @classmethod
    def named(cls, root: str, name: str) -> "KeyedTable":
        schema, keys, newest_by = SERVING_TABLES[name]
        kind = DayLog if newest_by in keys else KeyedTable
        return kind(f"{root}/{name}", schema, tuple(keys), newest_by)

    def upsert(self, df: DataFrame, batch_id: int, combine: bool = True) -> None:
        """Write a batch. ``combine`` reduces it to one row per key first, which costs a
        shuffle and pays off when keys repeat a lot; readers get one row per key either way."""
        rows = df.select(*T.StructType.fromDDL(self.schema).names)
        if combine:
            rows = newest_per_key(rows, list(self.keys), self.newest_by)
        rows.write.mode("overwrite").parquet(f"{self.path}/slice=batch-{batch_id}")

    def _slices(self, spark: SparkSession) -> tuple[dict[int, str], dict[int, str]]:
        return (
            completed_folders(spark, self.path, "slice=merged-"),
            completed_folders(spark, self.path, "slice=batch-"),
        )

    def exists(self, spark: SparkSession) -> bool:
        return any(self._slices(spark))

    def read(self, spark: SparkSession) -> DataFrame:
        """The newest row per key. An empty frame before the first write."""
        merged, batches = self._slices(spark)
        base = max(merged, default=-1)
        paths = [merged[base]] if merged else []
        paths += [path for number, path in sorted(batches.items()) if number > base]
        if not paths:
            return spark.createDataFrame([], self.schema)
        rows = spark.read.schema(self.schema).parquet(*paths)
        return newest_per_key(rows, list(self.keys), self.newest_by)

    def compact(self, spark: SparkSession) -> None:
        """Merge all slices into one.

        Slices that the previous merge already covers are removed; the ones merged now stay
        until the next time, for readers that have listed them.
        """
        merged, batches = self._slices(spark)
        previous, newest = max(merged, default=-1), max(batches, default=-1)
        if newest <= previous:
            return
        self.read(spark).write.mode("overwrite").parquet(f"{self.path}/slice=merged-{newest}")
        outdated = [path for number, path in merged.items() if number < previous]
        outdated += [path for number, path in batches.items() if number <= previous]
        for path in outdated:
            remove(spark, path)


@dataclass(frozen=True)
class Run:
    """Sorted-out rows of one day: where they are, their level, and how many batches they hold."""

    path: str
    day: int
    level: int
    batches: int


@dataclass(frozen=True)
class Commit:
    """What a ``DayLog`` consists of after a batch."""

    through: int = -1  # newest batch that is in
    runs: list[Run] = field(default_factory=list)
    replaced: list[str] = field(default_factory=list)  # runs that readers of the commit before may still use
    rewritten: int = 0  # batches' worth of runs merged so far, a batch counted every time


@dataclass(frozen=True)
class DayLog(KeyedTable):
    """Rows whose key holds their time, in runs by day.

    A batch adds a run to each day it has rows of. As soon as a day has ``fanout`` runs of a level
    they are merged into one of the next, so a row is rewritten as often as the logarithm of the
    batches of its day to that base, and days that get no more rows are left alone. A commit file
    lists the live runs: readers open it and nothing else, however many batches there were. It is
    written last, under a name of its own, so a batch is in as a whole or not at all; one that is
    in already changes nothing.
    """

    fanout: int = 8

    def _day(self) -> Column:
        """Days since 1970 in UTC; rows without a time are kept under day -1."""
        return F.coalesce(F.expr(f"unix_micros({self.newest_by}) div 86400000000"), F.lit(-1).cast("bigint"))

    def _commits(self, spark: SparkSession) -> list[tuple[int, str]]:
        """(number, name) of the commit files, the newest last. Their names end with the newest batch."""
        fs, root = filesystem(spark, self.path)
        if not fs.exists(root):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        found = [(re.fullmatch(r"commit=(\d+)\.batch=-?\d+", n), n) for n in names]
        return sorted((int(m[1]), n) for m, n in found if m)

    def commit(self, spark: SparkSession) -> Commit:
        """The newest commit; an empty one before the first batch."""
        found = self._commits(spark)
        if not found:
            return Commit()
        fs, path = filesystem(spark, f"{self.path}/{found[-1][1]}")
        stream = fs.open(path)
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        made = json.loads(text)
        return Commit(made["through"], [Run(**r) for r in made["runs"]], made["replaced"], made["rewritten"])

    def _write_commit(self, spark: SparkSession, now: Commit, before: Commit) -> None:
        """The two newest commits stay, and the runs that either of them names."""
        found = self._commits(spark)
        number = found[-1][0] + 1 if found else 0
        fs, draft = filesystem(spark, f"{self.path}/_commit")
        stream = fs.create(draft, True)
        try:
            stream.write(bytearray(json.dumps(asdict(now)).encode()))
        finally:
            stream.close()
        path = filesystem(spark, f"{self.path}/commit={number}.batch={now.through}")[1]
        if not fs.rename(draft, path):
            raise RuntimeError(f"commit not written: {path}")
        for _, name in found[:-1]:
            fs.delete(filesystem(spark, f"{self.path}/{name}")[1], False)
        for old in before.replaced:
            remove(spark, f"{self.path}/{old}")

    def _write_runs(self, rows: DataFrame, folder: str) -> list[tuple[str, int]]:
        """Write the rows by day; (path, day) of what was written."""
        spark = rows.sparkSession
        target = f"{self.path}/{folder}"
        rows.withColumn("day", self._day()).write.mode("overwrite").partitionBy("day").parquet(target)
        fs, made = filesystem(spark, target)
        names = [s.getPath().getName() for s in fs.listStatus(made) if s.isDirectory()]
        return [(f"{folder}/{n}", int(n.partition("=")[2])) for n in sorted(names)]

    def _rows(self, spark: SparkSession, runs: list[Run]) -> DataFrame:
        if not runs:
            return spark.createDataFrame([], self.schema)
        rows = spark.read.schema(self.schema).parquet(*[f"{self.path}/{r.path}" for r in runs])
        return newest_per_key(rows, list(self.keys), self.newest_by)

    def _merged(self, spark: SparkSession, now: Commit, due: list[list[Run]], folder: str) -> Commit:
        """``now`` with each group of runs, all of one day, as one run of the next level."""
        taken = {r.path: r for group in due for r in group}
        one = {group[0].day: (max(r.level for r in group) + 1, sum(r.batches for r in group)) for group in due}
        written = self._write_runs(self._rows(spark, list(taken.values())), folder)
        made = [Run(path, day, *one[day]) for path, day in written]
        return Commit(
            now.through,
            [r for r in now.runs if r.path not in taken] + made,
            now.replaced + list(taken),
            now.rewritten + sum(r.batches for r in taken.values()),
        )

    def upsert(self, df: DataFrame, batch_id: int, combine: bool = True) -> None:
        spark, before = df.sparkSession, self.commit(df.sparkSession)
        if batch_id <= before.through:
            return
        rows = df.select(*T.StructType.fromDDL(self.schema).names)
        if combine:
            rows = newest_per_key(rows, list(self.keys), self.newest_by)
        fresh = [Run(path, day, 0, 1) for path, day in self._write_runs(rows, f"runs/batch-{batch_id}")]
        now = Commit(batch_id, before.runs + fresh, [], before.rewritten)
        while True:
            by_level = lambda r: (r.level, r.day)
            groups = [list(g) for _, g in groupby(sorted(now.runs, key=by_level), by_level)]
            due = [g for g in groups if len(g) >= self.fanout]
            if not due:
                break
            level = due[0][0].level
            due = [g for g in due if g[0].level == level]  # a day is in it once
            now = self._merged(spark, now, due, f"runs/merged-{batch_id}-{level + 1}")
        self._write_commit(spark, now, before)

    def exists(self, spark: SparkSession) -> bool:
        return bool(self.commit(spark).runs)

    def read(self, spark: SparkSession, first_day: int | None = None, last_day: int | None = None) -> DataFrame:
        """The newest row per key, of all days or of those from ``first_day`` to ``last_day``."""
        runs = [
            r for r in self.commit(spark).runs
            if (first_day is None or r.day >= first_day) and (last_day is None or r.day <= last_day)
        ]
        return self._rows(spark, runs)

    def compact(self, spark: SparkSession) -> None:
        """Merge every day that has several runs into one. Not needed for the levels to work."""
        before = self.commit(spark)
        by_day = lambda r: r.day
        due = [list(g) for _, g in groupby(sorted(before.runs, key=by_day), by_day)]
        due = [g for g in due if len(g) > 1]
        if due:
            now = Commit(before.through, before.runs, [], before.rewritten)
            self._write_commit(spark, self._merged(spark, now, due, f"runs/compact-{before.through}"), before)


@dataclass(frozen=True)
class SnapshotTable:
    path: str
    schema: str

    @classmethod
    def named(cls, root: str, name: str) -> "SnapshotTable":
        return cls(f"{root}/{name}", SERVING_TABLES[name][0])

    def replace(self, df: DataFrame, keep: int = 2, version: int | None = None) -> int:
        """Write a new version and return its number. The ``keep`` newest versions stay.

        A stream passes its batch id as ``version``, so a replay writes the same version again.
        """
        spark = df.sparkSession
        versions = completed_folders(spark, self.path, "version=")
        number = max(versions, default=-1) + 1 if version is None else version
        columns = T.StructType.fromDDL(self.schema).names
        df.select(*columns).write.mode("overwrite").parquet(f"{self.path}/version={number}")
        older = sorted(n for n in versions if n < number)
        for old in older[: max(0, len(older) + 1 - keep)]:
            remove(spark, versions[old])
        return number

    def newest(self, spark: SparkSession) -> int:
        """Number of the newest version, -1 before the first."""
        return max(completed_folders(spark, self.path, "version="), default=-1)

    def exists(self, spark: SparkSession) -> bool:
        return self.newest(spark) >= 0

    def read(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """The newest version, or the newest one below ``before``."""
        versions = completed_folders(spark, self.path, "version=")
        if before is not None:
            versions = {n: path for n, path in versions.items() if n < before}
        if not versions:
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(versions[max(versions)])
