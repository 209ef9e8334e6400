"""What the physical plans look like: pushdown, pruning, shuffles, join kinds."""

import pytest
from pyspark.sql import functions as F

from lading.operators import joins
from lading.operators.filters import checkpoint_filter, modified_since
from lading.plans import sync
from lading.plans import validate as checks
from lading.plans.options import SyncOptions, ValidateOptions
from lading.sources.inventory import inventory_scan, list_page


def _plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def stored(spark, tmp_path):
    """Two stored inventories, and joins that are never small enough to broadcast."""
    rows = spark.range(2000).selectExpr(
        "'b' as bucket", "'s/' || id as key", "timestamp_ntz'2024-01-01 00:00:00' as last_modified",
        "id as size", "'STANDARD' as storage_class", "md5(string(id)) as etag",
        "cast(null as string) as version_id")
    paths = []
    for name in ("source", "target"):
        paths.append(str(tmp_path / name))
        rows.write.parquet(paths[-1])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield [inventory_scan(spark, p) for p in paths]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


OPTIONS = SyncOptions("sb", "tb", "s/", "s/", since="2024-01-01 00:00:00", delete=True)


def test_filters_and_columns_reach_the_scan(spark, stored, tmp_path):
    frame = modified_since(
        inventory_scan(spark, str(tmp_path / "source"), "s/1"), "2024-01-01 00:00:00"
    ).select("key", "size")
    plan = _plan(frame)
    assert "StringStartsWith(key,s/1)" in plan
    assert "GreaterThanOrEqual(last_mod" in plan
    assert "ReadSchema: struct<key:string,last_modified:timestamp_ntz,size:bigint>" in plan


def test_point_page_is_a_top_k(stored):
    plan = _plan(list_page(stored[0], "s/", continuation_token="s/5"))
    assert "TakeOrderedAndProject" in plan and "GreaterThan(key,s/5)" in plan


def test_diff_shuffles_each_side_once(stored):
    plan = _plan(joins.diff_join(*stored, "s/", "s/", repeated_keys=False))
    assert "Aggregate" not in plan
    assert plan.count("Exchange hashpartitioning") == 2
    assert "SortMergeJoin" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


def test_anti_join_carries_only_the_key(stored):
    plan = _plan(joins.orphan_anti_join(*stored, "s/", "s/"))
    assert "LeftAnti" in plan and "NestedLoop" not in plan
    assert "ReadSchema: struct<key:string>" in plan


def test_checkpoint_and_target_share_one_shuffle_of_the_source(spark, stored):
    checkpoint = spark.range(500).selectExpr(
        "'sb' as source_bucket", "'tb' as target_bucket", "'s/' || id as key")
    for plan in (sync.sync_plan, sync.mirror_plan):
        text = _plan(plan(*stored, OPTIONS, checkpoint))
        assert text.count("Exchange hashpartitioning") == 3, text
        assert "NestedLoop" not in text
    text = _plan(checkpoint_filter(stored[0], checkpoint, "sb", "tb"))
    assert "LeftAnti" in text


def test_mirror_reads_each_inventory_once(stored):
    plan = _plan(sync.mirror_plan(*stored, OPTIONS))
    assert "FullOuter" in plan and plan.count("FileScan parquet") == 2


def test_validation_shuffles_the_source_once(spark, stored):
    listing = stored[0]
    heads = listing.select(
        "bucket", "key", F.col("size").alias("content_length"), F.lit("t").alias("content_type"),
        F.lit("m").alias("content_md5"), "last_modified", "etag", "storage_class",
        F.create_map(F.lit("a"), F.lit("b")).alias("metadata"), "version_id",
        F.lit("c").alias("cache_control"), F.lit("e").alias("expires"))
    plan = _plan(checks.validate(listing, heads, heads, ValidateOptions(check_acl=False)))
    assert plan.count("Exchange hashpartitioning") == 3 and "NestedLoop" not in plan


def test_checks_read_only_the_columns_they_need(spark, stored, tmp_path):
    stored[0].select(
        "key", F.col("size").alias("content_length"), F.lit("t").alias("content_type"),
        "last_modified", "etag", F.create_map(F.lit("a"), F.lit("b")).alias("metadata"),
    ).write.parquet(str(tmp_path / "heads"))
    heads = spark.read.parquet(str(tmp_path / "heads"))
    plan = _plan(checks.content_check(stored[0], heads, heads, ValidateOptions()))
    assert plan.count("struct<key:string,content_length:bigint,last_modified:timestamp_ntz,etag:string>") == 2
    assert "metadata:map" not in plan and "ReadSchema: struct<key:string>" in plan
    orphans = _plan(joins.orphan_anti_join(*stored, "s/", "s/"))
    assert "etag" not in orphans


def test_small_checkpoints_are_broadcast_by_size(spark, stored):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    checkpoint = spark.range(500).selectExpr(
        "'sb' as source_bucket", "'tb' as target_bucket", "'s/' || id as key")
    assert "BroadcastHashJoin" in _plan(checkpoint_filter(stored[0], checkpoint, "sb", "tb"))


def test_small_source_filters_the_target_where_it_is_read(spark, stored):
    """The semi-join sits below the target's shuffle."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    plan = _plan(sync.sync_plan(stored[0], stored[1], OPTIONS, small_source=True))
    assert "NestedLoop" not in plan
    above, below = plan.split("LeftSemi", 1)
    assert "t_key" in above and "Exchange hashpartitioning" in above


def test_repeated_keys_cost_no_further_shuffle(stored):
    plan = _plan(joins.diff_join(*stored, "s/", "s/", repeated_keys=True))
    assert plan.count("Exchange hashpartitioning") == 2 and "partial_max" in plan


def _executions(spark, what):
    """The plans that Spark ran while ``what`` was done."""
    seen = spark._jsparkSession.sharedState().statusStore()
    before = seen.executionsCount()
    what()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(10_000)
    return [
        seen.executionsList().apply(k).physicalPlanDescription()
        for k in range(before, seen.executionsCount())]


def test_running_totals_move_rows_once(spark, stored):
    """One range exchange of the rows, from what was written; what is left moves one row per slice."""
    from lading.operators.running import running_totals

    made = []
    ran = _executions(spark, lambda: made.append(
        running_totals(stored[0].select("key", "size"), ["key"], {"t": F.col("size")}, 4)))
    assert sum("rangepartitioning" in p for p in ran) == 1
    assert sum("/source" in p for p in ran) == 1, "the input is evaluated once"
    plan = _plan(made[0])
    assert plan.count("Exchange") - plan.count("BroadcastExchange") == 1 and "SinglePartition" in plan
    rows = made[0].orderBy("key").collect()
    total = 0
    for r in rows:
        total += r.size
        assert r.t == total


def test_previews_evaluate_a_plan_once(spark, stored):
    from lading.operators.limits import plan_preview
    from lading.plans.reports import migration_preview_text

    for preview in (plan_preview, lambda plan: migration_preview_text(plan, "a", "b")):
        plan = sync.mirror_plan(stored[0].filter("size > 3"), stored[1], OPTIONS)
        ran = _executions(spark, lambda: preview(plan).collect())
        assert sum("/source" in p for p in ran) == 1 and sum("/target" in p for p in ran) == 1


def test_pages_open_the_files_they_need(spark, stored, tmp_path):
    from lading.sources.pages import indexed_page, write_page_index

    write_page_index(stored[0], str(tmp_path / "pages"), 20)
    for prefix, delimiter, most, token in (
            ("s/", None, 50, "s/15"), ("s/19", None, 1000, None), ("s/", "/", 5, None), ("s/", "9", 300, None),
            ("none", None, 10, None), ("", None, 10, "s/9990"), ("s/1", None, 10, "s/0"), ("", None, 3000, None)):
        page = indexed_page(spark, str(tmp_path / "pages"), prefix, delimiter, most, token)
        want = list_page(stored[0], prefix, delimiter, most, token)
        assert [r.key for r in page.collect()] == [r.key for r in want.collect()]
        if most == 50:
            assert len(page.inputFiles()) <= 2


def test_only_differing_ranges_are_joined(spark, stored, tmp_path):
    from lading.plans import ranges

    rows = stored[0].withColumn("key", F.concat(
        F.lit("s/"), F.pmod(F.col("size"), F.lit(100)).cast("string"), F.lit("/x/"), F.col("size").cast("string")))
    changed = rows.filter("size <> 505").withColumn("etag", F.when(
        F.col("size").isin(5, 105), F.lit("other")).otherwise(F.col("etag")))
    extra = rows.filter("size = 7").withColumn("key", F.lit("s/7/x/new"))
    paths = [str(tmp_path / "a"), str(tmp_path / "b")]
    ranges.store_listing(rows, paths[0], "s/")
    ranges.store_listing(changed.unionByName(extra), paths[1], "s/")
    leaves = ranges.differing_leaves(spark, *paths).collect()
    assert {r.branch for r in leaves} == {"5/x", "7/x"} and len(leaves) <= 4
    found = ranges.diff_by_ranges(spark, *paths)
    want = joins.diff_join(rows, changed.unionByName(extra), "s/", "s/")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, want.collect()))
    assert sorted((r.rel_key, r.reason) for r in found.collect()) == [
        ("5/x/105", "etag"), ("5/x/5", "etag"), ("5/x/505", "missing")]
    # Of 2,000 rows, those of a few leaves reach the join.
    assert "In(branch" in _plan(found)
    read = spark.read.parquet(paths[0] + "/rows").join(
        ranges.differing_leaves(spark, *paths).withColumnRenamed("branch", "b"),
        (F.col("branch") == F.col("b")) & (ranges._leaf(F.col("rel_key")) == F.col("leaf")), "left_semi")
    assert read.count() < 100
