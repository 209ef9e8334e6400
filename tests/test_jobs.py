import hashlib
import os
from dataclasses import replace
from datetime import datetime
from pathlib import Path

import pytest

from lading.jobs import objects, records, runs
from lading.jobs.store import ObjectRoot
from lading.plans.options import SyncOptions, ValidateOptions
from lading.schemas import ACL, HEAD
from lading.sources.bodies import content_digest, content_scan
from lading.sources.inventory import tree_inventory
from lading.streaming.incremental import incremental_sync_stream

FILES = {
    "a.txt": b"alpha", "dir/b.txt": b"beta", "dir/with blank.txt": b"gamma",
    "dir/deep/er/c.bin": bytes(range(256)) * 500, "skip.tmp": b"tmp", "empty": b"",
}


def _tree(root, files=FILES):
    for key, body in files.items():
        path = root / key
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(body)
    return str(root)


def _found(root):
    return {
        os.path.relpath(os.path.join(folder, name), root): open(os.path.join(folder, name), "rb").read()
        for folder, _, names in os.walk(root) for name in names
    }


@pytest.fixture
def place(tmp_path):
    target = tmp_path / "target"
    target.mkdir()
    return _tree(tmp_path / "source"), str(target), str(tmp_path / "store")


def _listing(inventory, files=FILES, prefix=""):
    return inventory(*[
        (prefix + k, len(v), hashlib.md5(v).hexdigest(), "2024-01-01") for k, v in files.items()])


OPTIONS = SyncOptions(source_bucket="s", target_bucket="t", exclude_patterns=("*.tmp",))


def test_tree_listing_reads_no_body(spark, place):
    listing = tree_inventory(spark, place[0])
    got = {r.key: r.size for r in listing.collect()}
    assert got == {k: len(v) for k, v in FILES.items()}
    below = tree_inventory(spark, "file://" + place[0], "dir/")
    assert {r.key for r in below.collect()} == {k for k in FILES if k.startswith("dir/")}
    plan = listing._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema", 1)[1]


def test_live_listing_finds_every_object(spark, place):
    got = {r.key: r.size for r in objects.list_objects(spark, place[0]).collect()}
    assert got == {k: len(v) for k, v in FILES.items()}
    for prefix in ("dir/", "dir/de", "dir/b", "a", "none/"):
        below = objects.list_objects(spark, "file:" + place[0], prefix).collect()
        assert {r.key for r in below} == {k for k in FILES if k.startswith(prefix)}
    seen = objects.list_objects(spark, place[0]).filter("key = 'a.txt'").first().last_modified
    assert abs(seen.timestamp() - os.path.getmtime(os.path.join(place[0], "a.txt"))) < 1


def test_small_bodies_and_digests(spark, place):
    small = content_scan(spark, place[0], 1000)
    assert {r.key for r in small.collect()} == {
        k for k, v in FILES.items() if 0 < len(v) <= 1000}
    assert {r.key: r.md5 for r in content_digest(small).collect()}["a.txt"] == hashlib.md5(
        b"alpha").hexdigest()
    keys = spark.createDataFrame([("dir/deep/er/c.bin",), ("empty",), ("gone",)], "key string")
    got = {r.key: r.md5 for r in objects.digest_objects(keys, place[0], 1000).collect()}
    assert got == {k: hashlib.md5(FILES[k]).hexdigest() for k in ("dir/deep/er/c.bin", "empty")} | {
        "gone": None}


def test_mirror_copies_then_has_nothing_to_do(spark, inventory, place):
    source_root, target_root, store = place
    source = _listing(inventory)
    empty = _listing(inventory, {"x": b""}).limit(0)
    summary = runs.run_sync(
        source, empty, OPTIONS, store, source_root, target_root, batches=2).first()
    assert (summary.status, summary.uploaded, summary.failed) == ("completed", 5, 0)
    assert _found(target_root) == {k: v for k, v in FILES.items() if k != "skip.tmp"}
    again = runs.run_sync(
        source, _listing(inventory, {k: v for k, v in FILES.items() if k != "skip.tmp"}),
        OPTIONS, store, source_root, target_root, batches=2).first()
    assert (again.total_objects, again.uploaded, again.transferred_bytes) == (0, 0, 0)
    assert records.read_states(spark, store).count() == 2


def test_one_failure_does_not_stop_the_rest_and_resume_retries_it(spark, inventory, place):
    source_root, target_root, store = place
    files = {**FILES, "lost": b"lost"}
    source = _listing(inventory, files)
    empty = source.limit(0)
    told = []
    first = runs.run_sync(
        source, empty, OPTIONS, store, source_root, target_root, batches=3, task_bytes=5000,
        progress=told.append).first()
    assert len(told) == 3 and told[-1] == {
        "processed": 6, "uploaded": 5, "skipped": 0, "failed": 1, "total": 6}
    assert (first.status, first.uploaded, first.failed) == ("completed_with_errors", 5, 1)
    assert [f.key for f in first.failed_list] == ["lost"]
    assert records.read_checkpoints(spark, store).count() == 5
    _tree(Path(source_root), {"lost": b"lost"})
    second = runs.run_sync(
        source, empty, OPTIONS, store, source_root, target_root, resume=first.sync_id).first()
    assert (second.skipped, second.uploaded, second.failed) == (5, 1, 0)
    assert records.read_checkpoints(spark, store, second.sync_id).count() == 6
    third = runs.run_sync(
        source, empty, OPTIONS, store, source_root, target_root, resume=second.sync_id).first()
    assert (third.skipped, third.total_objects) == (6, 0)
    assert _found(target_root)["lost"] == b"lost"


def test_dry_run_leaves_everything_alone(spark, inventory, place):
    source_root, target_root, store = place
    _tree(Path(target_root), {"orphan": b"o"})
    options = replace(OPTIONS, dry_run=True, delete=True)
    summary = runs.run_sync(
        _listing(inventory), _listing(inventory, {"orphan": b"o"}), options, store,
        source_root, target_root).first()
    assert (summary.uploaded, summary.deleted, summary.dry_run) == (5, 1, True)
    assert _found(target_root) == {"orphan": b"o"}
    assert records.watermark(spark, store, "s", "t", "", "") is None
    assert records.read_checkpoints(spark, store).count() == 0


def test_prefixes_delete_and_watermark(spark, inventory, tmp_path, monkeypatch):
    monkeypatch.setattr(runs, "_now", lambda: "2026-01-01 10:00:00.123450")
    source_root = _tree(tmp_path / "source", {"src/a": b"1", "src/b": b"2"})
    target_root = _tree(tmp_path / "target", {"dst/b": b"2", "dst/orphan": b"3", "else/x": b"4"})
    store = str(tmp_path / "store")
    options = SyncOptions(
        source_bucket="s", target_bucket="t", source_prefix="src/", target_prefix="dst/",
        delete=True, since_last_sync=True)
    source = _listing(inventory, {"src/a": b"1", "src/b": b"2"})
    target = _listing(inventory, {"dst/b": b"2", "dst/orphan": b"3", "else/x": b"4"})
    row = runs.run_sync(source, target, options, store, source_root, target_root).first()
    assert (row.uploaded, row.deleted, row.failed) == (1, 1, 0)
    assert _found(target_root) == {"dst/a": b"1", "dst/b": b"2", "else/x": b"4"}
    mark = records.watermark(spark, store, "s", "t", "src/", "dst/")
    # Text of an instant has no trailing zeros, so the instants are compared.
    assert datetime.fromisoformat(mark) == row.start_time
    assert records.watermark(spark, store, "s", "t", "src/", "other/") is None
    later = runs.run_sync(source, target.limit(0), options, store, source_root, target_root).first()
    assert later.skipped == 2 and later.uploaded == 0


def test_an_empty_source_deletes_nothing_unless_told_to(spark, inventory, place):
    source_root, target_root, store = place
    _tree(Path(target_root), {"k": b"1"})
    target = _listing(inventory, {"k": b"1"})
    empty = target.limit(0)
    options = replace(OPTIONS, delete=True)
    with pytest.raises(runs.EmptySourceError):
        runs.run_sync(empty, target, options, store, source_root, target_root)
    assert _found(target_root) == {"k": b"1"}
    row = runs.run_sync(
        empty, target, replace(options, allow_empty_source=True), store, source_root,
        target_root).first()
    assert row.deleted == 1 and _found(target_root) == {}


def test_metadata_and_lists_follow_the_copies(spark, inventory, place):
    source_root, target_root, store = place
    heads = spark.createDataFrame(
        [tuple({"bucket": "s", "key": k, "metadata": {"k": k}, "content_type": "text/plain"}.get(f.name)
               for f in HEAD.fields) for k in FILES], HEAD)
    lists = spark.createDataFrame(
        [("s", "a.txt", ("o", None), [(("CanonicalUser", "i", None, None, None), "READ")])], ACL)
    options = replace(OPTIONS, target_prefix="new/", preserve_metadata=True, preserve_acl=True)
    runs.run_sync(_listing(inventory), _listing(inventory).limit(0), options, store, source_root,
                  target_root, heads, lists)
    assert {r.key: r.metadata for r in records.read_heads(spark, store).collect()} == {
        f"new/{k}": {"k": k} for k in FILES if k != "skip.tmp"}
    copied = records.read_acls(spark, store).collect()
    assert [(r.bucket, r.key, r.owner.display_name) for r in copied] == [("t", "new/a.txt", "")]


def test_cancelled_runs_leave_a_state(spark, tmp_path):
    runs.cancel_sync(spark, OPTIONS, str(tmp_path), "sync-x", "2024-01-01 00:00:00")
    row = records.read_states(spark, str(tmp_path)).first()
    assert (row.sync_id, row.status, str(row.start_time)) == (
        "sync-x", "cancelled", "2024-01-01 00:00:00")


def test_checkpoint_can_keep_failed_keys(spark, tmp_path):
    results = spark.createDataFrame([("a", True), ("b", False)], "key string, success boolean")
    records.checkpoint_write(results, str(tmp_path), "r", "s", "t", include_failed=True)
    assert records.read_checkpoints(spark, str(tmp_path)).count() == 2
    records.checkpoint_write(results, str(tmp_path), "r", "s", "t")
    assert records.read_checkpoints(spark, str(tmp_path)).count() == 1


def test_copy_object_defaults_to_the_same_key(spark, place):
    mapping = spark.createDataFrame(
        [("a.txt", None), ("dir/b.txt", "moved/b")], "source_key string, target_key string")
    got = objects.copy_object(mapping, place[0], place[1], part_bytes=2).collect()
    assert all(r.success for r in got)
    assert _found(place[1]) == {"a.txt": b"alpha", "moved/b": b"beta"}


def test_delete_of_an_absent_object_succeeds(spark, place):
    gone = spark.createDataFrame([("nothing", 1)], "key string, size long")
    assert objects.delete_objects(gone, place[1]).first().success


def test_keys_cannot_leave_the_root(tmp_path):
    root = ObjectRoot(str(tmp_path))
    for key in ("../x", "a/../../x", "/etc/x", "a//b", "folder/"):
        with pytest.raises(ValueError):
            root.write(key, [b"x"])


def test_a_broken_copy_leaves_nothing_behind(tmp_path):
    root = ObjectRoot(str(tmp_path))
    root.write("k", [b"old"])

    def pieces():
        yield b"new"
        raise OSError("lost connection")

    with pytest.raises(OSError):
        root.write("k", pieces())
    assert _found(str(tmp_path)) == {"k": b"old"}


def test_validation_run_reads_undecided_bodies_only(spark, inventory, tmp_path):
    files = {"same": b"aaaa", "tampered": b"bbbb", "longer": b"cc", "absent": b"d"}
    source_root = _tree(tmp_path / "source", files)
    target_root = _tree(tmp_path / "target", {"same": b"aaaa", "tampered": b"BBBB", "longer": b"ccc"})

    def heads(contents):
        return spark.createDataFrame(
            [tuple({"key": k, "content_length": len(v), "metadata": {}}.get(f.name)
                   for f in HEAD.fields) for k, v in contents.items()], HEAD)

    options = ValidateOptions(source_bucket="s", target_bucket="t", check_acl=False)
    store = str(tmp_path / "store")
    told = []
    report = runs.run_validation(
        _listing(inventory, files), heads(files),
        heads({"same": b"aaaa", "tampered": b"BBBB", "longer": b"ccc"}), options, store,
        source_root, target_root, validation_id="val-1", progress=told.append).first()
    assert told == [{"processed": 4, "failed": 3, "total": 4}]
    assert (report.summary.total_objects, report.summary.content_passed) == (4, 1)
    assert {f.key: f.errors[0].split(":")[0] for f in report.failed_objects} == {
        "tampered": "content_mismatch", "longer": "content_mismatch",
        "absent": "Target object not found"}
    read = spark.read.parquet(f"{store}/runs/val-1/source_md5")
    assert {r.key for r in read.collect()} == {"same", "tampered"}


def test_stream_handles_each_file_once(spark, inventory, tmp_path):
    feed, plans = str(tmp_path / "feed"), str(tmp_path / "plans")
    target = inventory(("a", 1, "x"))

    def run():
        incremental_sync_stream(
            spark, feed, lambda: target, SyncOptions(), plans, str(tmp_path / "offsets")
        ).awaitTermination()

    inventory(("a", 1, "x", "2024-01-01"), ("b", 1, "y", "2024-01-01"),
              ("b", 2, "z", "2024-01-02")).write.parquet(feed)
    run()
    run()
    inventory(("a", 5, "w", "2024-01-03")).write.mode("append").parquet(feed)
    run()
    rows = spark.read.parquet(plans).orderBy("batch", "key").collect()
    assert [(r.batch, r.key, r.size, r.action) for r in rows] == [
        (0, "a", 1, "unchanged"), (0, "b", 2, "copy"), (1, "a", 5, "copy")]
