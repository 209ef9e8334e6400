"""Live heads as a data source, listings of large folders, and the stream's memory of versions."""

import hashlib
import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lading.jobs import heads, objects, runs
from lading.jobs.heads import KeyRange, inventory_of, live_heads, shares
from lading.jobs.store import ObjectRoot
from lading.plans.options import SyncOptions, ValidateOptions
from lading.streaming.incremental import incremental_sync_stream

FILES = {
    "a.txt": b"alpha", "dir/b.txt": b"beta", "dir/with blank.txt": b"gamma", "dir/deep/er/c": b"123",
    "dir2/é": b"x", "dir2/_u": b"", "z": b"zz", "m/1": b"1", "m/2": b"2", "m/n/3": b"3",
}


def _put(root, files=FILES):
    for key, body in files.items():
        path = Path(root, key)
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(body)
    return str(root)


@pytest.mark.parametrize("tasks", [1, 3, 50])
@pytest.mark.parametrize("names", [2, 10_000])
def test_shares_cover_every_object_once(tmp_path, monkeypatch, tasks, names):
    monkeypatch.setattr(heads, "PLANNED_NAMES", names)
    root = ObjectRoot(_put(tmp_path))
    for keys in (KeyRange(), KeyRange("dir"), KeyRange("m/n"), KeyRange(low="dir2/", high="m/2"),
                 KeyRange("none"), KeyRange("m/", high="m/1")):
        found = [o["key"] for s in shares(root, keys, tasks) for o in heads.objects_of(root, s, keys)]
        assert sorted(found) == sorted(k for k in FILES if keys.holds(k))


def test_a_prefix_leaves_folders_alone(tmp_path):
    root = ObjectRoot(_put(tmp_path))
    assert {s.folder for s in shares(root, KeyRange("m/n"), 50)} <= {"", "m", "m/n"}


def test_heads_of_a_store(spark, tmp_path):
    root = _put(tmp_path)
    (tmp_path / f".{'ab' * 16}.lading-part").write_bytes(b"unfinished")
    rows = {r.key: r for r in live_heads(spark, "file:" + root, bucket="b", etags="md5").collect()}
    assert set(rows) == set(FILES)
    for key, body in FILES.items():
        r = rows[key]
        assert (r.bucket, r.content_length, r.etag, r.storage_class, r.metadata) == (
            "b", len(body), hashlib.md5(body).hexdigest(), "STANDARD", {})
        assert abs(r.last_modified.timestamp() - os.path.getmtime(tmp_path / key)) < 1
    assert {r.etag for r in live_heads(spark, root).collect()} == {""}


def test_key_ranges_reach_the_listing(spark, tmp_path):
    root = _put(tmp_path)
    for prefix, first, last in (("dir/", "", None), ("", "m/n/3", "m/n/3"), ("", "dir2/", "m/2"), ("m", "n", None)):
        found = {r.key for r in live_heads(spark, root, prefix, first=first, last=last).collect()}
        assert found == {
            k for k in FILES if k.startswith(prefix) and k >= first and (last is None or k <= last)}
    assert live_heads(spark, root, "m/n/", tasks=50).rdd.getNumPartitions() < live_heads(
        spark, root, tasks=50).rdd.getNumPartitions()


def test_filters_of_one_frame_do_not_reach_another(spark, tmp_path):
    every = live_heads(spark, _put(tmp_path))
    some = every.filter("key like 'm/%'")
    assert (some.count(), every.count(), every.filter("key = 'z'").union(some).count()) == (3, len(FILES), 4)


def test_validation_works_from_live_heads_alone(spark, tmp_path):
    source = _put(tmp_path / "s")
    _put(tmp_path / "t", {**FILES, "z": b"yy", "dir/b.txt": b"longer"} | {"extra": b""})
    os.remove(tmp_path / "t" / "m" / "1")
    s_heads, t_heads = live_heads(spark, source), live_heads(spark, str(tmp_path / "t"))
    report = runs.run_validation(
        inventory_of(s_heads), s_heads, t_heads,
        ValidateOptions(check_acl=False, metadata_fields=("ContentLength",)), str(tmp_path / "store"),
        source, str(tmp_path / "t"), validation_id="val").first()
    assert {f.key for f in report.failed_objects} == {"z", "dir/b.txt", "m/1"}
    assert report.summary.content_passed == len(FILES) - 3


def test_a_large_folder_is_listed_by_several_tasks(spark, tmp_path):
    files = {f"flat/{k:05d}": b"" for k in range(700)} | {"flat/sub/x": b"1", "other/y": b"2"}
    root = _put(tmp_path, files)
    listed = objects.list_objects(spark, root, names_at_once=100)
    rows = listed.withColumn("file", F.input_file_name()).collect()
    assert sorted(r.key for r in rows) == sorted(files)
    assert len({r.file for r in rows if r.key.startswith("flat/0")}) > 3
    assert {r.key for r in objects.list_objects(spark, root, "flat/0001", 50).collect()} == {
        k for k in files if k.startswith("flat/0001")}


def test_older_versions_in_later_files_are_not_planned(spark, inventory, tmp_path):
    feed, plans = str(tmp_path / "feed"), str(tmp_path / "plans")
    target = inventory(("a", 2, "a2"), ("b", 1, "b1"))

    def run(*rows):
        inventory(*rows).write.mode("append").parquet(feed)
        incremental_sync_stream(
            spark, feed, lambda: target, SyncOptions(), plans, str(tmp_path / "offsets")
        ).awaitTermination()

    run(("a", 2, "a2", "2024-01-02"), ("b", 1, "b1", "2024-01-01"))
    # An older version and a repeat are nothing new; a newer version and a new key are.
    run(("a", 1, "a1", "2024-01-01"), ("b", 1, "b1", "2024-01-01"), ("c", 1, "c1", "2023-01-01"))
    run(("c", 9, "c0", "2022-01-01"), ("a", 3, "a3", "2024-01-03"), ("a", 1, "a1", "2024-01-01"))
    run(("a", 2, "a2", "2024-01-02"))
    rows = spark.read.parquet(plans).orderBy("batch", "key").collect()
    assert [(r.batch, r.key, r.size, r.action, r.reason) for r in rows] == [
        (0, "a", 2, "unchanged", None), (0, "b", 1, "unchanged", None), (1, "c", 1, "copy", "missing"),
        (2, "a", 3, "copy", "etag")]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "").find("RocksDB") < 0
