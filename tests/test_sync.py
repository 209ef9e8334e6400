from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lading.operators import filters, joins, limits, parts, running, runs, sets
from lading.plans import sync
from lading.plans.options import SyncOptions
from lading.sources import inventory as inv


def _rows(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def test_diff_reasons(inventory):
    source = inventory(("same", 1, "x"), ("etag", 1, "x"), ("size", 1, "x"), ("new", 1, "x"),
                       ("quoted", 1, '"q"'), ("bare", None, None))
    target = inventory(("same", 1, "x"), ("etag", 1, "y"), ("size", 2, "x"),
                       ("quoted", 1, "q"), ("bare", 0, ""))
    # Nothing shows that the copy without ETag and time is up to date.
    assert _rows(joins.diff_join(source, target), "key", "reason") == [
        ("bare", "time"), ("etag", "etag"), ("new", "missing"), ("size", "size")]


def test_live_listings_compare_times(inventory):
    source = inventory(("edited", 1, "", "2024-01-02"), ("copied", 1, "", "2024-01-01"),
                       ("tagged", 1, "", "2024-01-02"))
    target = inventory(("edited", 1, "", "2024-01-01"), ("copied", 1, "", "2024-01-02"),
                       ("tagged", 1, "x", "2024-01-03"))
    assert _rows(joins.diff_join(source, target), "key", "reason") == [("edited", "time")]


def test_orphans(inventory):
    source = inventory(("file1.txt", 100), ("file2.txt", 200))
    target = inventory(("file1.txt", 100), ("file2.txt", 200), ("orphan.txt", 50))
    assert _rows(joins.orphan_anti_join(source, target), "key") == [("orphan.txt",)]


def test_orphans_keep_their_full_key(inventory):
    source = inventory(("src/file1.txt", 100))
    target = inventory(("dst/file1.txt", 100), ("dst/orphan.txt", 50), ("else/x", 1))
    found = joins.orphan_anti_join(source, target, "src/", "dst/")
    assert _rows(found, "key", "rel_key") == [("dst/orphan.txt", "orphan.txt")]


def test_target_keys_lose_their_prefix(inventory):
    target = inventory(("target/key1.txt", 1), ("target/key2.txt", 2))
    assert _rows(joins.keyed_target(target, "target/"), "rel_key") == [("key1.txt",), ("key2.txt",)]


def test_time_filters_differ_on_missing_times(inventory):
    listing = inventory(("new", 1, "", "2026-04-13 12:00:00"), ("old", 1, "", "2026-04-10 12:00:00"),
                        ("edge", 1, "", "2026-04-12 00:00:00"), ("none", 1, "", None))
    since = "2026-04-12 00:00:00"
    assert _rows(filters.modified_since(listing, since), "key") == [("edge",), ("new",)]
    assert _rows(filters.since_filter(listing, since), "key") == [("edge",), ("new",), ("none",)]
    assert filters.since_filter(listing, None).count() == 4


@pytest.fixture
def planned(spark, inventory):
    source = inventory(
        ("s/done", 1, "x", "2020-01-01"), ("s/old", 2, "x", "2020-01-01"), ("s/same", 4, "x"),
        ("s/x.tmp", 8, "x"), ("s/copy", 16, "x", "2025-01-01"), ("s/changed", 32, "x"),
        ("s/hidden/a", 64, "x"), ("other", 128, "x"))
    target = inventory(("t/same", 4, "x"), ("t/changed", 32, "y"), ("t/orphan", 3, "x"),
                       ("t/old", 2, "x"))
    checkpoint = spark.createDataFrame(
        [("sb", "tb", "s/done"), ("sb", "zz", "s/copy"), ("sb", "tb", "s/done")],
        "source_bucket string, target_bucket string, key string")
    options = SyncOptions(
        source_bucket="sb", target_bucket="tb", source_prefix="s/", target_prefix="t/",
        since="2024-01-01 00:00:00", exclude_patterns=("*.tmp", "t/hidden/*"), delete=True)
    return source, target, options, checkpoint


EXPECTED = [
    ("s/changed", "copy", "etag"), ("s/copy", "copy", "missing"), ("s/done", "skip_checkpoint", None),
    ("s/hidden/a", "copy", "missing"), ("s/old", "skip_since", None), ("s/same", "unchanged", None),
    ("s/x.tmp", "filtered", None),
]


def test_first_rule_decides(planned):
    plan = sync.sync_plan(*planned)
    assert _rows(plan, "key", "action", "reason") == EXPECTED
    assert _rows(plan.filter("key = 's/copy'"), "target_key", "target_included") == [("t/copy", True)]


def test_mirror_adds_orphans_in_one_pass(planned):
    plan = sync.mirror_plan(*planned, all_rows=True)
    assert _rows(plan, "key", "action", "reason") == sorted(
        EXPECTED + [("t/orphan", "delete", "orphan")], key=lambda r: r[0])
    acting = sync.mirror_plan(*planned)
    assert {r.action for r in acting.collect()} == {"copy", "delete"}
    source, target, options, checkpoint = planned
    kept = sync.mirror_plan(source, target, replace(options, delete=False), checkpoint)
    assert kept.filter("action = 'delete'").count() == 0


def test_dry_run_applies_both_glob_tests(planned):
    preview = sync.dry_run_plan(sync.mirror_plan(*planned))
    assert _rows(preview, "key", "skipped", "reason") == [
        ("s/changed", False, "[DRY-RUN] Would upload"), ("s/copy", False, "[DRY-RUN] Would upload"),
        ("s/hidden/a", True, "filtered"), ("t/orphan", False, "[DRY-RUN] Would delete")]


def test_summary_accounting(spark, planned):
    plan = sync.mirror_plan(*planned, all_rows=True)
    results = spark.createDataFrame(
        [("s/changed", True, False, None, 32), ("s/copy", False, False, "boom", 16),
         ("s/hidden/a", True, True, None, 64)],
        "key string, success boolean, skipped boolean, error string, size long")
    deletes = spark.createDataFrame(
        [("t/orphan", True), ("t/bad", False)], "key string, success boolean")
    row = sync.sync_summary(plan, results, planned[2], "id", deletes=deletes).first()
    assert row.status == "completed_with_errors"
    assert (row.total_objects, row.processed_objects, row.uploaded) == (3, 3, 1)
    assert (row.deleted, row.skipped, row.failed) == (1, 3, 2)
    assert (row.total_bytes, row.transferred_bytes) == (127, 32)
    assert [tuple(f) for f in row.failed_list] == [("s/copy", "boom")]
    assert row.duration_seconds is None


def test_empty_plan_counts_zero(spark, inventory):
    empty = inventory(("x", 1)).limit(0)
    results = spark.createDataFrame(
        [], "key string, success boolean, skipped boolean, error string, size long")
    row = sync.sync_summary(
        sync.sync_plan(empty, empty, SyncOptions()), results, SyncOptions(), "id").first()
    assert row.status == "completed" and row.total_bytes == 0 and row.failed_list == []


def test_parts(spark):
    mib = 1024 * 1024
    objects = spark.createDataFrame(
        [("two", 10 * mib), ("one", 5 * mib), ("rest", 5 * mib + 1), ("empty", 0)],
        "key string, size long")
    planned = parts.part_plan(objects, 5 * mib)
    assert _rows(planned, "key", "part_number", "offset", "length") == [
        ("empty", 1, 0, 0), ("one", 1, 0, 5 * mib), ("rest", 1, 0, 5 * mib),
        ("rest", 2, 5 * mib, 1), ("two", 1, 0, 5 * mib), ("two", 2, 5 * mib, 5 * mib)]


def test_manifest_blocks_are_whole_and_ordered(spark):
    uploaded = spark.range(1, 2501).select(
        F.lit("k").alias("key"), F.col("id").alias("part_number"), F.lit("e").alias("etag"))
    blocks = parts.part_order(uploaded.orderBy(F.rand(1))).orderBy("block").collect()
    numbers = [p.part_number for b in blocks for p in b.parts]
    assert numbers == list(range(1, 2501))
    assert [len(b.parts) for b in blocks] == [1000, 1000, 500]


def test_pages_walk_the_whole_listing(inventory):
    listing = inventory(*[(f"p/{i:03d}", i) for i in range(25)], ("q/1", 1), ("p/d/1", 1))
    seen, token = [], None
    while True:
        page = inv.list_page(listing, "p/", "/", 10, token)
        summary = inv.page_summary(listing, "p/", "/", 10, token).first()
        keys = [r.key for r in page.orderBy("key").collect()]
        assert summary.key_count == len(keys)
        seen += keys
        token = summary.next_continuation_token
        if not summary.is_truncated:
            break
        assert token == keys[-1]
    assert seen == [f"p/{i:03d}" for i in range(25)] and token is None


def test_page_that_ends_exactly_is_not_truncated(inventory):
    row = inv.page_summary(inventory(("a", 1), ("b", 1)), max_keys=2).first()
    assert (row.is_truncated, row.next_continuation_token, row.key_count) == (False, None, 2)


def test_latest_row_of_a_key_wins(inventory):
    feed = inventory(("k", 1, "a", "2024-01-01"), ("k", 2, "b", "2024-01-03"),
                     ("k", 3, "c", "2024-01-02"), ("k", 9, "z", None), ("l", 1, "a", None))
    assert _rows(inv.latest_per_key(feed), "key", "size") == [("k", 2), ("l", 1)]


def test_running_totals_match_one_ordered_pass(spark):
    rows = spark.range(5000).select(
        F.expr("if(id % 3 = 0, 7, id * 31 % 997)").alias("at"), F.col("id").alias("key"),
        F.expr("id % 13").alias("n"))
    got = running.running_totals(rows, ["at", "key"], {"total": F.col("n"), "seen": F.lit(1)}, 16)
    total = 0
    ordered = got.orderBy("at", "key").collect()
    for position, row in enumerate(ordered, 1):
        total += row.n
        assert (row.total, row.seen) == (total, position)
    assert len(ordered) == 5000 and "_slice" not in got.columns


def test_byte_slices_bound_the_work_of_a_task(spark):
    sizes = spark.range(2000).select(
        F.format_string("k%05d", "id").alias("key"),
        F.expr("if(id = 777, 50000000, id % 1000)").alias("size"))
    per_task = running.byte_slices(sizes, 1_000_000).groupBy("task").agg(
        F.sum(F.col("size") + 4096).alias("bytes"), F.max("size").alias("largest"),
        F.count("*").alias("n")).collect()
    assert sum(r.n for r in per_task) == 2000
    assert all(r.bytes <= 1_000_000 + r.largest + 4096 for r in per_task)


def test_progress_runs_in_completion_order(spark):
    results = spark.createDataFrame(
        [("b", True, False, 5, 1), ("a", True, True, 9, 2), ("c", False, False, 7, 3)],
        "key string, success boolean, skipped boolean, size long, completed_at int")
    got = runs.progress_counts(results).orderBy("completed_at").collect()
    assert [(r.key, r.processed, r.uploaded_so_far, r.skipped_so_far, r.failed_so_far,
             r.bytes_so_far) for r in got] == [
        ("b", 1, 1, 0, 0, 5), ("a", 2, 1, 1, 0, 5), ("c", 3, 1, 1, 1, 5)]


def test_history_puts_newest_first_and_undated_last(spark):
    states = spark.createDataFrame(
        [("old", "2024-01-01"), ("none", None), ("new", "2024-06-01"), ("a", "2024-06-01")],
        "sync_id string, at string").selectExpr(
            "sync_id", "cast(at as timestamp_ntz) as last_sync_time")
    assert [r.sync_id for r in limits.sync_history(states, 4).collect()] == [
        "a", "new", "old", "none"]
    assert limits.sync_history(states, 1).count() == 1


def test_run_lookup_prefers_the_checkpoint(spark):
    saved = spark.createDataFrame([("r1", "running")], "sync_id string, status string")
    states = spark.createDataFrame(
        [("r1", "completed"), ("r2", "completed")], "sync_id string, status string")
    assert _rows(sets.run_lookup(saved, states), "sync_id", "origin", "status") == [
        ("r1", "checkpoint", "running"), ("r2", "state", "completed")]
    assert sets.run_lookup(saved, states, "r3").count() == 0


def test_key_sets(spark, inventory):
    assert _rows(sets.key_except(inventory(("s/a",)), inventory(("t/a",), ("t/b",), ("t/b",)),
                                 "s/", "t/"), "rel_key") == [("b",)]
    done = spark.createDataFrame(
        [("s", "t", "a"), ("s", "t", "b")], "source_bucket string, target_bucket string, key string")
    assert sets.checkpoint_union(done, done).count() == 2


def test_preview_cuts_and_counts(inventory):
    listing = inventory(*[(f"{i:02d}" + "a" * 60, 1024, "", "2024-01-01 10:00:00")
                          for i in range(60)])
    rows = limits.plan_preview(listing).collect()
    assert len(rows) == 50 and {r.more for r in rows} == {10}
    assert all(len(r.shown_key) == 38 and r.shown_size == "1.00 KB"
               and r.shown_time == "2024-01-01T10:00:00" for r in rows)


def test_one_key_with_a_third_of_all_rows(inventory, spark):
    """A feed that repeats one key is reduced before any join."""
    hot = spark.range(3000).selectExpr(
        "'b' as bucket", "if(id % 3 = 0, 'hot', 'k' || id) as key",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) as last_modified",
        "id as size", "cast(null as string) as storage_class", "cast(id as string) as etag",
        "cast(null as string) as version_id")
    target = inventory(("k1", 1, "1"), ("gone", 1, "a", "2024-01-01"), ("gone", 2, "b", "2024-01-02"))
    options = SyncOptions(repeated_keys=True, delete=True)
    for source in (hot, inv.latest_per_key(hot)):
        plan = sync.mirror_plan(source, target, options, all_rows=True)
        assert plan.count() == 2002
        assert _rows(plan.filter("key = 'hot'"), "size", "action") == [(2997, "copy")]
        assert _rows(plan.filter("action = 'delete'"), "key", "size") == [("gone", 2)]
    assert joins.orphan_anti_join(hot, target, repeated_keys=True).count() == 1
    assert joins.mirror_status(hot, target, repeated_keys=True).count() == 2002
