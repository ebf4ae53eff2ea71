"""Versioned Parquet tables for the incremental path (S6, I2 storage).

An upsert never rewrites files it reads: ``stage`` and ``stage_parts`` write
into a fresh folder, and ``commit`` publishes everything staged at once, as one
small state file ``{root}/_state/{version}.json`` that names the folders of
every table. Readers open the newest state file only, so what they read does
not grow with the number of commits.

A state file is created only if it does not exist. Of two writers that started
from the same state, the second finds its version taken, raises ``Conflict``
and starts again from the new state. (The store must offer create-if-absent, as
HDFS does; on an object store without it, run one writer.)

The ids of applied batches are empty files in ``{root}/_batches``, so a replay
is found by one existence check. ``vacuum`` deletes what old states alone name.

Whole tables are one folder. Day-partitioned tables have a folder per day, and
their entry names it with the range of numeric event ids in it; a commit writes
the days it touches and keeps the other days' folders.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PART_DIR = "__p"
NULL_PART = "__null__"


class Conflict(Exception):
    """Another writer committed first."""


def hadoop_path(spark: SparkSession, path: str):
    """A Hadoop path and its file system."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(sc._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    p, fs = hadoop_path(spark, path)
    return bool(fs.exists(p))


def _children(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Names and modification times (ms) in a folder."""
    p, fs = hadoop_path(spark, folder)
    if not fs.exists(p):
        return []
    return [(s.getPath().getName(), s.getModificationTime()) for s in fs.listStatus(p)]


class Entry:
    """A committed (or staged) state of one table: a folder, or per day a
    folder and the least and greatest numeric event id in it."""

    def __init__(self, path: str | None = None, parts: dict[str, list] | None = None,
                 schema: str | None = None):
        self.path, self.parts, self.schema = path, parts, schema
        self.touched: set[str] | None = None  # days rewritten by a staged upsert

    def as_json(self) -> dict:
        return {"path": self.path, "parts": self.parts, "schema": self.schema}

    def folders(self) -> set[str]:
        paths = [self.path] if self.parts is None else [p[0] for p in self.parts.values()]
        return {p.split(f"/{PART_DIR}=")[0] for p in paths}


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # ---------------------------------------------------------- the state
    def _versions(self) -> list[int]:
        return sorted(int(n.split(".")[0]) for n, _ in _children(self.spark, f"{self.root}/_state")
                      if n.endswith(".json") and n[0].isdigit())

    def _state(self, version: int) -> dict[str, Entry] | None:
        p, fs = hadoop_path(self.spark, f"{self.root}/_state/{version:010d}.json")
        stream = fs.open(p)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return {t: Entry(**e) for t, e in json.loads(text).items()}
        except ValueError:
            return None  # its writer died while writing it

    def snapshot(self) -> tuple[int, dict[str, Entry]]:
        """Number to commit from, and the current entry of each table."""
        versions = self._versions()
        for v in reversed(versions):
            state = self._state(v)
            if state is not None:
                return versions[-1], state
        return versions[-1] if versions else 0, {}

    def current(self) -> dict[str, Entry]:
        return self.snapshot()[1]

    def _marker(self, batch_id: str) -> str:
        return f"{self.root}/_batches/{hashlib.md5(batch_id.encode()).hexdigest()}"

    def processed(self, batch_id: str) -> bool:
        return path_exists(self.spark, self._marker(batch_id))

    def commit(self, staged: dict[str, Entry], batch_id: str, base: int,
               current: dict[str, Entry]) -> None:
        """Publish ``current`` with the staged entries as the state after ``base``.

        The batch is marked after that. A writer that dies in between leaves an
        applied batch unmarked; applying it again changes nothing.
        """
        state = {t: e.as_json() for t, e in (current | staged).items()}
        p, fs = hadoop_path(self.spark, f"{self.root}/_state/{base + 1:010d}.json")
        if fs.exists(p):
            raise Conflict(f"state {base + 1} exists")
        try:
            out = fs.create(p, False)
        except Exception as e:
            if "already exists" in str(e):
                raise Conflict(f"state {base + 1} exists") from e
            raise
        try:
            out.write(bytearray(json.dumps(state).encode()))
        finally:
            out.close()
        p, fs = hadoop_path(self.spark, self._marker(batch_id))
        fs.create(p, True).close()

    def vacuum(self, keep: int = 2, older_than_s: float = 86_400) -> list[str]:
        """Delete states but the newest ``keep`` and the folders that no kept
        state names, if older than ``older_than_s`` (a running writer's staged
        folders are younger). Returns what was deleted."""
        versions = self._versions()
        used: set[str] = set()
        for v in versions[-keep:]:
            for e in (self._state(v) or {}).values():
                used |= e.folders()
        before = (time.time() - older_than_s) * 1000
        gone = [f"{self.root}/_state/{v:010d}.json" for v in versions[:-keep]]
        for table, _ in _children(self.spark, self.root):
            if not table.startswith("_"):
                gone += [f"{self.root}/{table}/{n}" for n, t in _children(self.spark, f"{self.root}/{table}")
                         if f"{self.root}/{table}/{n}" not in used and t < before]
        for path in gone:
            p, fs = hadoop_path(self.spark, path)
            fs.delete(p, True)
        return gone

    # ---------------------------------------------------------- reading
    def read(self, table: str, current: dict[str, Entry] | None = None,
             days: set[str] | None = None) -> DataFrame | None:
        """The table, or for a partitioned table only ``days`` of it."""
        entry = (self.current() if current is None else current).get(table)
        if entry is None:
            return None
        if entry.parts is None:
            return self.spark.read.parquet(entry.path)
        schema = T.StructType.fromJson(json.loads(entry.schema))
        paths = [p[0] for d, p in sorted(entry.parts.items()) if days is None or d in days]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    # ---------------------------------------------------------- writing
    def _folder(self, table: str) -> str:
        return f"{self.root}/{table}/{uuid.uuid4().hex}"

    def stage(self, table: str, df: DataFrame) -> Entry:
        """Write ``df`` as the next whole version of ``table`` (not yet visible)."""
        from tidemark.plans.medallion import write_model

        path = self._folder(table)
        write_model(df, path, mode="errorifexists")
        return Entry(path=path)

    def stage_parts(self, table: str, df: DataFrame, day: Column, touched: set[str] | None,
                    current: dict[str, Entry], id_column: str | None = None) -> Entry:
        """Write the rows of the ``touched`` days (null: of all); keep all others.

        ``df`` must hold the complete new content of every touched day. A
        touched day left without rows disappears. With ``id_column`` the range
        of its numeric values is kept for each day.
        """
        from tidemark.plans.medallion import write_model

        folder = self._folder(table)
        tagged = df.withColumn(PART_DIR, F.coalesce(day.cast("string"), F.lit(NULL_PART)))
        write_model(tagged, folder, mode="errorifexists", partition_by=PART_DIR)
        parts = {n.split("=", 1)[1]: [f"{folder}/{n}", None, None]
                 for n, _ in _children(self.spark, folder) if n.startswith(PART_DIR + "=")}
        if id_column and parts:
            written = self.spark.read.schema(tagged.schema).parquet(folder)
            for r in id_ranges(written, PART_DIR, id_column).collect():  # a row per day
                parts[r["p"]][1:] = [r["lo"], r["hi"]]
        prev = current.get(table)
        kept = {} if prev is None or touched is None else {
            d: p for d, p in prev.parts.items() if d not in touched}
        return Entry(parts={**kept, **parts}, schema=df.schema.json())


def id_ranges(df: DataFrame, day: str, id_column: str) -> DataFrame:
    """``p, lo, hi``: least and greatest numeric id of each day. A day with ids
    that are no numbers has no range, so it is never ruled out."""
    number = F.col(id_column).try_cast("bigint")
    odd = F.count_if(F.col(id_column).isNotNull() & number.isNull()) > 0
    return df.groupBy(F.col(day).cast("string").alias("p")).agg(
        F.when(~odd, F.coalesce(F.min(number), F.lit(1))).alias("lo"),
        F.when(~odd, F.coalesce(F.max(number), F.lit(0))).alias("hi"))


def days_with_ids(entry: Entry, lo: int | None, hi: int | None) -> set[str]:
    """Days whose id range meets ``lo..hi`` (no range given: any day may)."""
    if lo is None or hi is None:
        return set(entry.parts)
    return {d for d, (_, a, b) in entry.parts.items() if a is None or (a <= hi and lo <= b)}


def day_values(df: DataFrame, day: Column) -> set[str]:
    """Distinct partition days of ``df`` (a short list: one per day)."""
    rows = df.select(F.coalesce(day.cast("string"), F.lit(NULL_PART)).alias("d")).distinct().collect()
    return {r["d"] for r in rows}
