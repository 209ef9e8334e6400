"""Runs that are claimed, journalled, stopped, killed and gone on with."""

import hashlib
import os
import signal
import subprocess
import sys
import textwrap
import threading
import time
from pathlib import Path

import pytest

from lading.jobs import journal, records, runs
from lading.jobs.checkpoints import CheckpointLog
from lading.jobs.stopping import StopFlag, ancestors, request_stop
from lading.plans.options import SyncOptions

OPTIONS = SyncOptions(source_bucket="s", target_bucket="t")


def _put(root, count, size=10):
    files = {f"d{k % 7}/{k:04d}": bytes([k % 256]) * size for k in range(count)}
    for key, body in files.items():
        path = Path(root, key)
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(body)
    return files


def _listing(inventory, files):
    return inventory(*[(k, len(v), hashlib.md5(v).hexdigest(), "2024-01-01") for k, v in files.items()])


def _count(root):
    return sum(len([n for n in names if not n.startswith(".")]) for _, _, names in os.walk(root))


def test_one_driver_claims_a_run(spark, tmp_path):
    store = str(tmp_path)
    first = journal.Journal(spark, store, "r", {"source_bucket": "s"})
    with pytest.raises(journal.RunClaimedError):
        journal.Journal(spark, store, "r", {})
    assert journal.run_records(spark, store, "r").first().status == "pending"
    first.record("running", uploaded=3)
    row = journal.run_records(spark, store, "r").first()
    assert (row.origin, row.status, row.uploaded, row.source_bucket) == ("checkpoint", "running", 3, "s")
    second = journal.Journal(spark, store, "r", {}, take_over=True)
    second.end("failed")
    assert journal.run_records(spark, store).first().status == "failed"
    journal.Journal(spark, store, "r", {}).end("completed")
    assert journal.run_records(spark, store).collect() == []
    won = []

    def race(k):
        try:
            won.append(journal.Journal(spark, store, "raced", {"source_bucket": str(k)}))
        except journal.RunClaimedError:
            pass

    threads = [threading.Thread(target=race, args=(k,)) for k in range(8)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) == 1


def test_lines_of_runs(spark, tmp_path):
    store = str(tmp_path)
    for run, before in (("a", None), ("b", "a"), ("c", "b"), ("self", "self")):
        journal.Journal(spark, store, run, {}, before).end("completed")
    assert ancestors(store, "c") == ["c", "b", "a"] and ancestors(store, "self") == ["self"]
    assert ancestors(store, "unknown") == ["unknown"]


def test_runs_leave_journal_and_state(spark, inventory, tmp_path):
    files = _put(tmp_path / "s", 5)
    source, store = _listing(inventory, files), str(tmp_path / "store")
    told = []
    summary = runs.run_sync(
        source, source.limit(0), OPTIONS, store, str(tmp_path / "s"), str(tmp_path / "t"), sync_id="one",
        progress=lambda counts: told.append(journal.run_records(spark, store, "one").first())).first()
    assert (summary.status, summary.uploaded) == ("completed", 5)
    assert [(r.status, r.origin, r.total_objects) for r in told] == [("running", "checkpoint", 5)]
    row = journal.run_records(spark, store, "one").first()
    assert (row.status, row.origin, row.uploaded) == ("completed", "state", 5)
    with pytest.raises(runs.EmptySourceError):
        runs.run_sync(source.limit(0), source, SyncOptions(delete=True), store, "", "", sync_id="two")
    assert journal.run_records(spark, store, "two").first().status == "failed"


def test_a_rerun_under_one_id_forgets_the_earlier_attempt(spark, inventory, tmp_path):
    files = _put(tmp_path / "s", 6)
    store, roots = str(tmp_path / "store"), (str(tmp_path / "s"), str(tmp_path / "t"))
    source = _listing(inventory, files)
    runs.run_sync(source, source.limit(0), OPTIONS, store, *roots, sync_id="one", task_bytes=1, batches=3)
    assert records.read_checkpoints(spark, store, "one").count() == 6
    fewer = source.filter("key < 'd1'")
    runs.run_sync(fewer, source.limit(0), OPTIONS, store, *roots, sync_id="one")
    assert records.read_checkpoints(spark, store, "one").count() == fewer.count()


def test_logs_are_put_together(spark, tmp_path):
    store = str(tmp_path)
    log = records.checkpoint_log(store, "r", "s", "t", 3)
    results = [{"key": f"k{k}", "success": k % 4 != 0} for k in range(20)]
    assert list(log.through(iter(results))) == results
    list(CheckpointLog(store, log.folder, "s", "t", 3).through(iter(results[:5])))
    folder = tmp_path / "checkpoints" / "run=r"
    assert _count(folder) == 6
    keys = {r["key"] for r in results if r["success"]}
    assert {r.key for r in records.read_checkpoints(spark, store, "r").collect()} == keys
    for _ in range(2):
        records.checkpoint_compact(spark, store, "r")
        assert [p.name[:12] for p in folder.iterdir()] == ["attempt=base"]
        assert sorted(r.key for r in records.read_checkpoints(spark, store).collect()) == sorted(keys)
    records.checkpoint_compact(spark, store, "nothing")


def test_a_stopped_run_leaves_true_counts(spark, inventory, tmp_path):
    files = _put(tmp_path / "s", 60)
    store, roots = str(tmp_path / "store"), (str(tmp_path / "s"), str(tmp_path / "t"))
    source = _listing(inventory, files)
    orphan = _listing(inventory, {"orphan": b"1"})
    told = []

    def progress(counts):
        told.append(counts)
        if len(told) == 2:
            request_stop(store, "one")

    first = runs.run_sync(
        source, orphan, SyncOptions(source_bucket="s", target_bucket="t", delete=True), store, *roots,
        sync_id="one", task_bytes=4096 * 6, batches=6, progress=progress).first()
    done = _count(tmp_path / "t")
    assert first.status == "cancelled" and len(told) == 2 and 0 < done < 60
    assert (first.uploaded, first.deleted, first.total_objects) == (done, 0, 60)
    row = journal.run_records(spark, store, "one").first()
    assert (row.status, row.uploaded) == ("cancelled", done)
    assert records.watermark(spark, store, "s", "t", "", "") is None
    second = runs.run_sync(source, orphan.limit(0), OPTIONS, store, *roots, resume="one").first()
    assert (second.status, second.skipped, second.uploaded) == ("completed", done, 60 - done)
    assert _count(tmp_path / "t") == 60


def test_tasks_see_the_flag(tmp_path):
    flag = StopFlag(str(tmp_path), "r")
    assert not flag.raised()
    request_stop(str(tmp_path), "r")
    # Within a second it does not look again, unless it is told to.
    assert not flag.raised() and flag.raised(now=True) and flag.raised()


def test_a_killed_run_goes_on_where_its_log_ends(spark, inventory, tmp_path):
    """The driver dies after 900 of 1,000 objects of one batch; at most 200 are copied again."""
    files = _put(tmp_path / "s", 1000)
    store, roots = str(tmp_path / "store"), (str(tmp_path / "s"), str(tmp_path / "t"))
    script = textwrap.dedent(f"""
        import os, time
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "2").config("spark.driver.memory", "1g")
                 .config("spark.checkpoint.dir", {str(tmp_path / "c")!r}).getOrCreate())
        spark.sparkContext.setLogLevel("OFF")
        from lading import SyncOptions, run_sync
        from lading.jobs import objects, store

        class Slow(store.ObjectRoot):
            def write(self, key, pieces, headers=None):
                time.sleep(0.01)
                return super().write(key, pieces, headers)

        objects.ObjectRoot = Slow
        rows = spark.read.parquet({str(tmp_path / "listing")!r})
        run_sync(rows, rows.limit(0), SyncOptions(source_bucket="s", target_bucket="t"), {store!r},
                 {roots[0]!r}, {roots[1]!r}, sync_id="one", batches=1, checkpoint_every=50)
    """)
    source = _listing(inventory, files)
    source.write.parquet(str(tmp_path / "listing"))
    child = subprocess.Popen(
        [sys.executable, "-c", script], cwd=Path(__file__).parents[1], start_new_session=True,
        stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL)
    end = time.time() + 240
    while child.poll() is None and _count(tmp_path / "t") < 900 and time.time() < end:
        time.sleep(0.005)
    os.killpg(child.pid, signal.SIGKILL)
    child.wait()
    time.sleep(1)
    done = _count(tmp_path / "t")
    assert 900 <= done < 1000
    assert journal.run_records(spark, store, "one").first().status == "running"
    row = runs.run_sync(source, source.limit(0), OPTIONS, store, *roots, resume="one").first()
    assert row.status == "completed" and _count(tmp_path / "t") == 1000
    assert row.uploaded <= 1000 - done + 200 and row.skipped == 1000 - row.uploaded
