"""Commit log of a published table: what was read, what is staged, what is published.

Beside the table at ``<target>`` lies ``<target>.commits/run=<number>``:

* ``rows``: the full content of every output partition that the run changes,
  one row per time bucket and so small; ``state``: likewise for the segment state.
* ``record``: one line of JSON, written when all that is staged is complete: the
  newest source partition read, the load type, the row counts.
* ``published``: written when the table (and catalog entry) hold the staged rows.

Publishing replaces whole partitions by what is staged, so it can be repeated:
a run that died on the way is finished by the next one, and one that died before
its record leaves nothing behind. The source mark is in the record, not in the
output: rows whose own time is ahead of, or behind, their arrival don't move it.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass
class Commit:
    run: int
    grain: str
    load_type: str
    source_mark: str | None  # start of the newest source partition read, ISO
    rows_read: int
    rows_rejected: int
    rows_held: int = 0  # late rows set aside, see plans/job.py
    has_rows: bool = True
    has_state: bool = False
    replaces: bool = True  # whether the staged rows stand for all samples of their partitions, or are added to earlier ones

    @property
    def mark(self) -> dt.datetime | None:
        return dt.datetime.fromisoformat(self.source_mark) if self.source_mark else None


class CommitLog:
    def __init__(self, spark: SparkSession, target: str):
        self.spark = spark
        self.root = target.rstrip("/") + ".commits"
        self.state_path = target.rstrip("/") + ".state"
        self._jvm = spark.sparkContext._jvm
        self._hadoop = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, path: str):
        hpath = self._jvm.org.apache.hadoop.fs.Path(path)
        return hpath.getFileSystem(self._hadoop), hpath

    def _exists(self, path: str) -> bool:
        fs, p = self._path(path)
        return fs.exists(p)

    def run_path(self, run: int, part: str = "") -> str:
        return f"{self.root}/run={run:06d}" + (f"/{part}" if part else "")

    def delete(self, path: str) -> None:
        fs, p = self._path(path)
        fs.delete(p, True)

    def _write(self, path: str, text: str) -> None:
        """Whole or not at all: written aside and renamed."""
        fs, p = self._path(path)
        aside = self._path(path + ".tmp")[1]
        out = fs.create(aside, True)
        out.write(bytearray(text.encode()))
        out.close()
        fs.delete(p, False)
        if not fs.rename(aside, p):
            raise OSError(f"can't rename to {path}")

    def _read(self, path: str) -> str:
        fs, p = self._path(path)
        stream = fs.open(p)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def runs(self) -> list[int]:
        """Numbers of the runs in the log, one listing (a full load clears it, see ``forget``)."""
        fs, p = self._path(self.root)
        if not fs.exists(p):
            return []
        names = (st.getPath().getName() for st in fs.listStatus(p))
        return sorted(int(n[4:]) for n in names if n.startswith("run=") and n[4:].isdigit())

    def commit(self, run: int) -> Commit | None:
        path = self.run_path(run, "record")
        return Commit(**json.loads(self._read(path))) if self._exists(path) else None

    def record(self, commit: Commit) -> None:
        self._write(self.run_path(commit.run, "record"), json.dumps(asdict(commit)))

    def published(self, run: int) -> dict | None:
        path = self.run_path(run, "published")
        return json.loads(self._read(path)) if self._exists(path) else None

    def mark_published(self, run: int, table: str | None) -> None:
        self._write(self.run_path(run, "published"), json.dumps({"table": table}))

    def forget(self, before: int) -> None:
        """Removes the runs before ``before``: a later one stands for all that they did."""
        for run in self.runs():
            if run < before:
                self.delete(self.run_path(run))

    def staged(self, run: int, part: str, schema=None) -> DataFrame:
        reader = self.spark.read.schema(schema) if schema is not None else self.spark.read
        return reader.parquet(self.run_path(run, part))


def newest_partition(spark: SparkSession, path: str, parts: Sequence[str], listed: list[str] | None = None) -> dt.datetime | None:
    """Start of the newest partition that holds files, by descending the directories along the largest key.

    One listing a level, more only where the newest directories are empty; no history is listed.
    ``listed`` receives the listed directories.
    """
    jvm, hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(hadoop)

    def visible(p) -> list:
        if listed is not None:
            listed.append(p.toString())
        return [st for st in fs.listStatus(p) if not st.getPath().getName().startswith(("_", "."))]

    def descend(p, rest: Sequence[str], found: tuple[int, ...]):
        entries = visible(p)
        if not rest:
            return found if any(st.isFile() for st in entries) else None
        keys = {}
        for st in entries:
            name, _, value = st.getPath().getName().partition("=")
            if st.isDirectory() and name == rest[0] and value.lstrip("-").isdigit():
                keys[int(value)] = st.getPath()
        for k in sorted(keys, reverse=True):
            if (got := descend(keys[k], rest[1:], (*found, k))) is not None:
                return got
        return None

    got = descend(root, list(parts), ()) if fs.exists(root) else None
    if got is None:
        return None
    year, month, day, hour = (*got, *(None, 1, 1, 0)[len(got) :])
    return dt.datetime(year, month, day, hour)
