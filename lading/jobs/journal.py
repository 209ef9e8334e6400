"""The journal of runs: who works on a run, how far it is, and whether it is to stop.

A run keeps small JSON files in ``journal/run=<id>`` of the store: ``claim``, made only where there is
none, so that one driver works on a run; numbered records, of which the last says how the run stands
(``pending``, ``running`` with its counts so far, or how it ended); and ``stop``, once somebody asks for
it. Tasks look for ``stop`` while they copy, and give no more results when it is there.
"""

from __future__ import annotations

import json
import os
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..constants import FAILED, PENDING, RUNNING
from ..functions.keys import parse_instant
from ..operators.sets import run_lookup
from ..schemas import JOURNAL, JOURNAL_JSON
from . import records
from .stopping import JOURNAL_FOLDER, StopFlag, record_numbers, run_folder
from .store import ObjectRoot

COUNTS = ("total_objects", "uploaded", "deleted", "skipped", "failed")


class RunClaimedError(RuntimeError):
    """Another driver works on the run, or ended without giving it back."""


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


def _create_once(spark: SparkSession, root: ObjectRoot, key: str, text: bytes) -> bool:
    """Writes a file only where there is none; whether it did. One of several writers succeeds, on
    local file systems and on those whose Hadoop client creates files in one step."""
    if root.files.type_name == "local":
        path = root.path(key)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        try:
            file = os.open(path, os.O_CREAT | os.O_EXCL | os.O_WRONLY, 0o666)
        except FileExistsError:
            return False
        with os.fdopen(file, "wb") as out:
            out.write(text)
        return True
    context = spark.sparkContext
    path = context._jvm.org.apache.hadoop.fs.Path(f"{root.uri}/{key}")
    files = path.getFileSystem(context._jsc.hadoopConfiguration())
    try:
        out = files.create(path, False)
    except Exception:
        if files.exists(path):
            return False
        raise
    out.write(bytearray(text))
    out.close()
    return True


class Journal:
    """The writer of one run's records. Making it claims the run."""

    def __init__(
        self, spark: SparkSession, store: str, run_id: str, identity: dict,
        resumed_from: str | None = None, take_over: bool = False,
    ):
        self.root, self.run_id = ObjectRoot(store), run_id
        self.stop = StopFlag(store, run_id)
        self._base = {
            "sync_id": run_id, **identity, "start_time": _now(), "resumed_from": resumed_from}
        if take_over:
            self.root.delete(f"{run_folder(run_id)}/claim")
        if not _create_once(spark, self.root, f"{run_folder(run_id)}/claim", json.dumps(self._base).encode()):
            raise RunClaimedError(
                f"run {run_id!r} is claimed; if its driver is gone, resume it under another id or "
                "take it over")
        self.root.delete(f"{run_folder(run_id)}/stop")
        self._next = 1 + max(record_numbers(self.root, run_id), default=-1)
        self.record(PENDING)

    def record(self, status: str, **counts: int) -> None:
        row = {
            **self._base, "seq": self._next, "status": status, "updated_at": _now(),
            **{name: counts.get(name, 0) for name in COUNTS}}
        self.root.write(f"{run_folder(self.run_id)}/{self._next:06d}.json", [json.dumps(row).encode()])
        self._next += 1

    def end(self, status: str, **counts: int) -> None:
        """The last record; the claim is given back."""
        self.record(status, **counts)
        self.root.delete(f"{run_folder(self.run_id)}/claim")


def read_journal(spark: SparkSession, store: str) -> DataFrame:
    """The last record of every run."""
    try:
        rows = spark.read.schema(JOURNAL_JSON).option("pathGlobFilter", "*.json").option(
            "recursiveFileLookup", True).json(f"{store}/{JOURNAL_FOLDER}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], JOURNAL)
    times = {name: parse_instant(name) for name in ("start_time", "updated_at")}
    last = F.row_number().over(Window.partitionBy("sync_id").orderBy(F.desc("seq")))
    return rows.withColumns(times).withColumn("_nth", last).filter("_nth = 1").select(*JOURNAL.names)


def run_records(spark: SparkSession, store: str, run_id: str | None = None) -> DataFrame:
    """How each run, or one, stands: its journal's record while it goes on or where it broke off, else its
    state row."""
    open_runs = read_journal(spark, store).filter(F.col("status").isin(PENDING, RUNNING, FAILED))
    return run_lookup(open_runs, records.read_states(spark, store), run_id)
