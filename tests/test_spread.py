"""Work on objects is spread over tasks, and each input of a validation is evaluated once."""

import hashlib
import os

from pyspark.sql import functions as F

from lading.jobs import objects, runs
from lading.jobs.heads import inventory_of, live_heads
from lading.jobs.store import CALLS_AT_ONCE, ObjectRoot
from lading.plans.options import ValidateOptions


def test_bodies_of_one_split_are_written_by_many_tasks(spark, tmp_path):
    bodies = spark.range(200).coalesce(1).selectExpr(
        "concat('d/', id) as key", "cast(repeat('x', cast(id as int)) as binary) as content")
    written = objects.write_objects(bodies, str(tmp_path / "s"))
    tasks = written.select(F.spark_partition_id().alias("t"), "key", "size").collect()
    assert len({r.t for r in tasks}) > 1
    assert {(r.key, r.size) for r in tasks} == {(f"d/{n}", n) for n in range(200)}
    digests = {r.key: r.md5 for r in objects.body_digests(spark, str(tmp_path / "s"), 100).collect()}
    assert digests == {f"d/{n}": hashlib.md5(b"x" * n).hexdigest() for n in range(200)}


def test_calls_of_a_local_store_do_not_overlap(tmp_path):
    assert ObjectRoot(str(tmp_path)).calls == 1 < CALLS_AT_ONCE


def test_names_of_other_shares_are_not_looked_up(tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).write_bytes(b"1")
    os.symlink(tmp_path / "none", tmp_path / "c")
    seen = []
    root = ObjectRoot(str(tmp_path))
    assert [n for n, *_ in root.scan("", lambda name: seen.append(name) or name == "b")] == ["b"]
    assert sorted(seen) == ["a", "b", "c"]


def test_a_validation_lists_each_side_once(spark, tmp_path):
    for side in ("s", "t"):
        (tmp_path / side / "d").mkdir(parents=True)
        for n in range(5):
            (tmp_path / side / "d" / str(n)).write_bytes(b"%d" % n)
    looked = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            looked.add(batch.num_rows)
            yield batch

    heads = live_heads(spark, str(tmp_path / "s"))
    counting = heads.mapInArrow(counted, heads.schema)
    report = runs.run_validation(
        inventory_of(heads), counting, live_heads(spark, str(tmp_path / "t")),
        ValidateOptions(check_acl=False, metadata_fields=("ContentLength",)), str(tmp_path / "store"),
        str(tmp_path / "s"), str(tmp_path / "t")).first()
    assert report.summary.total_objects == report.summary.content_passed == 5
    assert looked.value == 5
