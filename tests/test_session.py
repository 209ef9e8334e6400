"""Where intermediate tables may lie, and what listings hold."""

import pytest

from lading import session
from lading.functions.keys import instant
from lading.jobs.objects import balanced, list_objects
from lading.operators.parts import part_plan
from lading.sources.inventory import tree_inventory


class _Context:
    master = "spark://host:7077"

    def getCheckpointDir(self):
        return None


class _Session:
    sparkContext = _Context()

    class conf:
        @staticmethod
        def get(_, default):
            return default


def test_cluster_without_shared_folder_is_an_error():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(_Session())


@pytest.mark.parametrize("master, local", [
    ("local", True), ("local[8]", True), ("local-cluster[3,2,1000]", False), ("yarn", False)])
def test_local_masters(master, local):
    assert session.is_local(master) == local


def test_listings_hold_names_of_every_kind(spark, tmp_path):
    names = {"d/.env": 1, "d/.hid/x": 2, "_under": 3, "empty": 0, "plain.txt": 4}
    for name, size in names.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(b"x" * size)
    (tmp_path / f".{'0' * 32}.lading-part").write_bytes(b"unfinished")
    for listing in (list_objects, tree_inventory):
        assert {r.key: r.size for r in listing(spark, str(tmp_path)).collect()} == names


def test_offsets_are_resolved(spark):
    rows = spark.range(1).select(
        instant("2024-01-01T00:00:00+02:00").cast("string"), instant("2024-01-01T00:00:00Z")
        .cast("string"), instant(None).cast("string")).first()
    assert tuple(rows) == ("2023-12-31 22:00:00", "2024-01-01 00:00:00", None)
    with pytest.raises(ValueError):
        instant("yesterday")


def test_one_huge_object_makes_few_tasks(spark):
    plan = spark.createDataFrame(
        [("a", 1), ("huge", 5 * 1024 ** 4), ("z", 1)], "key string, size long")
    spread = balanced(plan, 1 << 30)
    assert spread.rdd.getNumPartitions() <= 3 and spread.count() == 3


def test_null_size_is_one_empty_part(spark):
    plan = spark.createDataFrame([("k", None)], "key string, size long")
    assert [tuple(r) for r in part_plan(plan).collect()] == [("k", 1, 0, 0)]
