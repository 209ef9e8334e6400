"""Objects in parts: copied by several tasks, digested, compared by composite ETags."""

import hashlib
import os
import subprocess
import sys
import textwrap
import threading
import time
from dataclasses import replace
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lading.jobs import objects, parts, runs, tasks
from lading.jobs.store import ObjectRoot
from lading.operators.parts import composite_etag, part_bytes_of, part_plan
from lading.plans.options import SyncOptions, ValidateOptions
from lading.schemas import HEAD

BIG = os.urandom(200 * 1000 + 17)


def _composite(body, each):
    digests = [hashlib.md5(body[k:k + each]).digest() for k in range(0, max(len(body), 1), each)]
    if len(digests) == 1:
        return hashlib.md5(body).hexdigest()
    return f"{hashlib.md5(b''.join(digests)).hexdigest()}-{len(digests)}"


def _objects(spark, *rows):
    return spark.createDataFrame(rows, "key string, target_key string, size long")


def _put(root, files):
    for key, body in files.items():
        path = Path(root, key)
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(body)


def _found(root):
    return {
        os.path.relpath(os.path.join(folder, name), root): Path(folder, name).read_bytes()
        for folder, _, names in os.walk(root) for name in names}


def test_one_object_is_written_by_several_tasks(spark, tmp_path):
    files = {"big": BIG, "dir/empty": b"", "dir/small": b"x"}
    _put(tmp_path / "s", files)
    listed = _objects(spark, ("big", "to/big", len(BIG)), ("dir/empty", "to/empty", 0),
                      ("dir/small", "small", 1))
    moved, manifest = parts.copy_in_parts(
        listed, str(tmp_path / "s"), "file:" + str(tmp_path / "t"), "run", 1000, 10_000)
    rows = {r.key: r for r in moved.collect()}
    assert all(r.success and r.error is None for r in rows.values())
    assert _found(tmp_path / "t") == {"to/big": BIG, "to/empty": b"", "small": b"x"}
    by_task = manifest.filter("key = 'big'").groupBy("task").count().collect()
    assert len(by_task) > 5 and sum(r["count"] for r in by_task) == 201
    etags = {r.key: (r.etag, r.n_parts) for r in parts.manifest_etags(manifest).collect()}
    assert etags == {
        "big": (_composite(BIG, 1000), 201), "dir/empty": (hashlib.md5(b"").hexdigest(), 1),
        "dir/small": (hashlib.md5(b"x").hexdigest(), 1)}
    # Finishing again, as a task that is tried again does, changes nothing.
    again = parts.finish_parts(listed, manifest, str(tmp_path / "t"), "run").collect()
    assert all(r.success for r in again) and _found(tmp_path / "t")["to/big"] == BIG


def test_a_part_that_fails_leaves_no_object(spark, tmp_path):
    _put(tmp_path / "s", {"short": b"12345", "fine": b"abcdef"})
    _put(tmp_path / "t", {"short": b"old"})
    listed = _objects(spark, ("short", "short", 9), ("fine", "fine", 6), ("gone", "gone", 4))
    moved, _ = parts.copy_in_parts(listed, str(tmp_path / "s"), str(tmp_path / "t"), "run", 2)
    rows = {r.key: (r.success, r.error is None, r.target_key) for r in moved.collect()}
    assert rows == {"short": (False, False, None), "fine": (True, True, "fine"), "gone": (False, False, None)}
    assert _found(tmp_path / "t") == {"short": b"old", "fine": b"abcdef"}


def test_a_killed_task_is_tried_again(tmp_path):
    """In a process of its own, whose session allows tasks to fail: a Python worker dies in mid-copy."""
    _put(tmp_path / "s", {"big": BIG})
    script = textwrap.dedent(f"""
        import os
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "1g")
                 .config("spark.checkpoint.dir", {str(tmp_path / "c")!r}).getOrCreate())
        spark.sparkContext.setLogLevel("OFF")
        from lading.jobs import parts, store

        class Dying(store.ObjectRoot):
            def write_part(self, key, upload, number, offset, pieces):
                mark = {str(tmp_path / "died")!r}
                if number == 100 and not os.path.exists(mark):
                    # Half of the part is there already.
                    super().write_part(key, upload, number, offset, [next(iter(pieces))[:500]])
                    open(mark, "w").close()
                    os._exit(1)
                return super().write_part(key, upload, number, offset, pieces)

        parts.ObjectRoot = Dying
        rows = spark.createDataFrame([("big", "big", {len(BIG)})], "key string, target_key string, size long")
        moved, manifest = parts.copy_in_parts(
            rows, {str(tmp_path / "s")!r}, {str(tmp_path / "t")!r}, "run", 1000, 50_000)
        print("RESULT", moved.first().success, manifest.count(), manifest.select("task").distinct().count())
    """)
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=Path(__file__).parents[1], capture_output=True, text=True,
        timeout=300)
    result = done.stdout.split("RESULT")[1].split()
    assert result[:2] == ["True", "201"] and int(result[2]) > 1
    assert (tmp_path / "died").exists()
    assert hashlib.md5((tmp_path / "t" / "big").read_bytes()).digest() == hashlib.md5(BIG).digest()
    assert list(_found(tmp_path / "t")) == ["big"]


@pytest.mark.parametrize("kind", ["hdfs", "s3"])
def test_stores_without_writes_at_offsets(tmp_path, kind):
    """Parts are objects of their own there, which are put together."""
    from pyarrow import fs

    class Other:
        """A local file system under another name."""

        def __init__(self):
            self.type_name, self.real = kind, fs.LocalFileSystem()

        def __getattr__(self, name):
            return getattr(self.real, name)

    root = ObjectRoot(str(tmp_path))
    root.files, root.renames = Other(), kind == "hdfs"
    upload = "ab" * 16
    (tmp_path / "d" / f".{upload}.lading-part").mkdir(parents=True)
    for number, offset in ((2, 4), (1, 0), (2, 4)):
        assert root.write_part("d/k", upload, number, offset, [b"abcdefg"[offset:offset + 4]]) in (3, 4)
    assert [name for name, _ in root.entries("d")] == []
    root.finish("d/k", upload, 2, 7, 2)
    root.finish("d/k", upload, 2, 7, 2)
    assert _found(tmp_path) == {"d/k": b"abcdefg"}
    with pytest.raises(OSError):
        root.finish("d/other", upload, 2, 7, 2)


def test_sync_copies_large_objects_in_parts(spark, inventory, tmp_path):
    files = {"big": BIG, "small": b"x", "skip.tmp": BIG}
    _put(tmp_path / "s", files)
    (tmp_path / "t").mkdir()
    source = inventory(*[(k, len(v), hashlib.md5(v).hexdigest(), "2024-01-01") for k, v in files.items()])
    options = SyncOptions(exclude_patterns=("*.tmp",), split_bytes=1000)
    summary = runs.run_sync(
        source, source.limit(0), replace(options, part_size=1), str(tmp_path / "store"),
        str(tmp_path / "s"), str(tmp_path / "t")).first()
    assert (summary.status, summary.uploaded, summary.transferred_bytes) == (
        "completed", 2, len(BIG) + 1)
    assert _found(tmp_path / "t") == {"big": BIG, "small": b"x"}


def test_part_sizes_grow_with_the_object(spark):
    sizes = spark.createDataFrame([(None,), (0,), (8,), (10**6,)], "size long").select(
        part_bytes_of(F.col("size"), 8, 1000).alias("each")).collect()
    assert [r.each for r in sizes] == [8, 8, 8, 1000]
    rows = part_plan(spark.createDataFrame([("k", 10)], "key string, size long"), F.lit(4), ("size",))
    assert [tuple(r) for r in rows.collect()] == [("k", 1, 0, 4, 10), ("k", 2, 4, 4, 10), ("k", 3, 8, 2, 10)]


def test_composite_etags_of_all_possible_part_sizes(spark, tmp_path):
    body = BIG[:10_000]
    cases = {
        "usual": (8 * 128, "usual"), "rounded": (3 * 128, "rounded"), "least": (3334, "least"),
        "one": (20_000, "one part")}
    _put(tmp_path, {k: body for k in cases} | {"odd": body})
    rows = [(k, len(body), -(-len(body) // each)) for k, (each, _) in cases.items()] + [
        ("odd", len(body), 7), ("missing", 500, 3)]
    found = {r.key: r.etags for r in parts.composite_digests(
        spark.createDataFrame(rows, "key string, size long, parts long"), str(tmp_path), 128,
        task_bytes=4000).collect()}
    for key, (each, _) in cases.items():
        want = _composite(body, each)
        if "-" not in want:
            want = f"{hashlib.md5(hashlib.md5(body).digest()).hexdigest()}-1"
        assert want in found[key], key
    # 1,500 bytes is neither usual, nor the least size for seven parts, nor a whole multiple.
    assert _composite(body, 1500) not in found["odd"] and "missing" not in found


def _heads(spark, rows):
    return spark.createDataFrame(
        [tuple({"key": k, "content_length": n, "etag": e, "metadata": {}}.get(f.name) for f in HEAD.fields)
         for k, n, e in rows], HEAD)


def test_validation_sees_through_composite_etags(spark, inventory, tmp_path):
    body, other = BIG[:30_000], BIG[1:30_001]
    plain, each = hashlib.md5(body).hexdigest(), 8000
    files = {k: body for k in ("same", "both", "odd", "plain", "changed", "swapped")}
    _put(tmp_path / "s", files)
    _put(tmp_path / "t", {**files, "changed": other})
    source = inventory(*[(k, len(v), "", "2024-01-01") for k, v in files.items()])
    s_heads = _heads(spark, [
        ("same", 30_000, plain), ("both", 30_000, _composite(body, 5000)), ("odd", 30_000, plain),
        ("plain", 30_000, plain), ("changed", 30_000, plain), ("swapped", 30_000, _composite(body, each))])
    t_heads = _heads(spark, [
        ("same", 30_000, f'"{_composite(body, each)}"'), ("both", 30_000, _composite(body, each)),
        ("odd", 30_000, _composite(body, 7777)), ("plain", 30_000, hashlib.md5(other).hexdigest()),
        ("changed", 30_000, _composite(other, each)), ("swapped", 30_000, plain)])
    options = ValidateOptions(check_metadata=False, check_acl=False, etag_part_unit=1000)
    store = str(tmp_path / "store")

    def run(name, **given):
        return runs.run_validation(
            source, s_heads, t_heads, options, store, *given.values(), validation_id=name).first()

    report = run("val", s=str(tmp_path / "s"), t=str(tmp_path / "t"))
    assert {f.key: f.errors[0].split(":")[1].strip() for f in report.failed_objects} == {
        "plain": "ETag mismatch", "changed": "MD5 mismatch"}
    # Whole bodies are read only where no part size gave the ETag again.
    read = spark.read.parquet(f"{store}/runs/val/to_read")
    assert sorted(r.key for r in read.collect()) == ["changed", "odd"]
    # By heads alone, a composite ETag is compared like any other.
    assert len(run("heads").failed_objects) == 6


def test_calls_of_a_task_overlap():
    together, most, lock = 0, 0, threading.Lock()

    def slow(row):
        nonlocal together, most
        with lock:
            together += 1
            most = max(most, together)
        time.sleep(0.02)
        with lock:
            together -= 1
        return None if row["n"] % 5 == 4 else row

    taken = []

    def rows():
        for n in range(40):
            taken.append(n)
            yield {"n": n}

    out = []
    for result in tasks.overlapped(slow, rows(), 8):
        out.append(result["n"])
        assert len(taken) <= result["n"] + 2 * 8
    assert out == [n for n in range(40) if n % 5 < 4] and 4 <= most <= 8
    assert list(tasks.overlapped(slow, rows(), 1))[0] == {"n": 0}


def test_asked_versions_are_refused(spark, tmp_path):
    _put(tmp_path / "s", {"a": b"1", "b": b"2"})
    mapping = spark.createDataFrame(
        [("a", None, None), ("b", None, "v7")], "source_key string, target_key string, version_id string")
    rows = {r.key: (r.success, r.error) for r in objects.copy_object(
        mapping, str(tmp_path / "s"), str(tmp_path / "t")).collect()}
    assert rows["a"] == (True, None) and not rows["b"][0] and "v7" in rows["b"][1]
    assert _found(tmp_path / "t") == {"a": b"1"}


def test_body_digests_take_every_object(spark, tmp_path):
    files = {"a": b"1" * 10, "_hidden": b"h", "d/.dot": b"dd", "empty": b"", "long": BIG}
    _put(tmp_path, files)
    rows = {r.key: (r.length, r.md5) for r in objects.body_digests(spark, str(tmp_path), 100).collect()}
    assert rows == {k: (len(v), hashlib.md5(v).hexdigest()) for k, v in files.items()}
