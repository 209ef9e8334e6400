import json

from pyspark.sql import functions as F

from lading.plans import reports
from lading.sources.runs import report_scan, state_scan


def _summary(spark, **changes):
    columns = {
        "sync_id": F.lit("sync-1"), "status": F.lit("completed_with_errors"),
        "source_bucket": F.lit("src"), "target_bucket": F.lit("dst"),
        "source_prefix": F.lit("a/"), "target_prefix": F.lit(None).cast("string"),
        "preserve_metadata": F.lit(True), "preserve_acl": F.lit(False), "dry_run": F.lit(False),
        "total_objects": F.lit(12345), "processed_objects": F.lit(12345), "uploaded": F.lit(95),
        "deleted": F.lit(1), "skipped": F.lit(2), "failed": F.lit(5),
        "total_bytes": F.lit(1048576), "transferred_bytes": F.lit(512),
        "duration_seconds": F.lit(1800.0),
        "start_time": F.lit("2024-01-01 10:00:00").cast("timestamp_ntz"),
        "end_time": F.lit(None).cast("timestamp_ntz"),
        "failed_list": F.expr("transform(sequence(1, 12), i -> struct('k' || i as key, 'boom' as error))"),
        **changes,
    }
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()])


def test_sync_report(spark):
    lines = reports.sync_report_text(_summary(spark)).first().report.split("\n")
    assert lines[:3] == ["=" * 60, "SYNC REPORT", "=" * 60] and lines[-1] == "=" * 60
    for line in ("  Sync ID: sync-1", "  Status:  COMPLETED_WITH_ERRORS", "  End:     N/A",
                 "  Duration: 30.0m", "    Objects: 12,345", "    Failed: 5",
                 "    Preserve metadata: yes", "    Preserve ACL: no"):
        assert line in lines
    assert not any("dry-run" in line for line in lines)
    preview = reports.sync_report_text(_summary(spark, dry_run=F.lit(True))).first().report
    assert "    Mode:  preview (dry-run)" in preview


def test_migration_report_lists_ten_failures(spark):
    text = reports.migration_report_text(_summary(spark)).first().report
    assert "    Total size: 1.00 MB" in text and "    Transferred: 512.00 B" in text
    assert text.count(": boom") == 10 and "    - k1: boom" in text
    none = F.expr("cast(array() as array<struct<key:string,error:string>>)")
    assert "Failed objects (" not in reports.migration_report_text(
        _summary(spark, failed_list=none)).first().report


def test_validation_report(spark):
    row = spark.range(1).selectExpr(
        "'val-1' as validation_id", "'2024-01-01T10:00:00' as timestamp", "'completed' as status",
        "'src' as source_bucket", "'dst' as target_bucket", "'' as prefix",
        "true as check_content", "true as check_metadata", "false as check_acl",
        """named_struct('total_objects', 100L, 'content_passed', 95L, 'content_failed', 5L,
             'metadata_passed', 98L, 'metadata_failed', 2L, 'metadata_skipped', 0L,
             'acl_passed', 0L, 'acl_failed', 0L, 'acl_skipped', 100L) as summary""",
        "cast(null as double) as duration_seconds",
        "array(named_struct('key', 'bad', 'errors', array('content_mismatch: x', 'acl_mismatch'))) as failed_objects")
    lines = reports.validation_report_text(row).first().report.split("\n")
    for line in ("    Passed:  95", "    Failed:  2", "    Skipped: 100", "    - bad",
                 "      content_mismatch: x", "  Duration:  0.0s"):
        assert line in lines


def test_previews(spark, inventory):
    listing = inventory(("file1.txt", 1024, "", "2024-01-01 10:00:00"), ("file2.txt", 2048))
    text = reports.migration_preview_text(listing, "src", "dst").first().preview
    assert "  Prefix:  /" in text.split("\n")
    assert "  file1.txt" + " " * 29 + "      1.00 KB 2024-01-01T10:00:00 " in text.split("\n")
    assert "more objects" not in text
    many = inventory(*[(f"f{i:02d}", 1) for i in range(60)])
    assert "  ... 10 more objects" in reports.migration_preview_text(many, "s", "d").first().preview
    empty = reports.sync_preview_text(listing.limit(0), "s", "d").first().preview
    assert "    Objects: 0" in empty and "Since:" not in empty
    assert "  Since:   2024-01-01" in reports.sync_preview_text(
        listing, "s", "d", "2024-01-01").first().preview


def test_json_keeps_absent_values(spark):
    doc = json.loads(reports.report_json(_summary(spark)).first().json)
    assert doc["sync_id"] == "sync-1" and doc["end_time"] is None
    assert len(doc["failed_list"]) == 12


def test_indented_state_files(spark, tmp_path):
    good = {"sync_id": "s1", "source_bucket": "b", "last_sync_time": "2024-01-01T10:00:00",
            "status": "completed"}
    (tmp_path / "s1.json").write_text(json.dumps(good, indent=2))
    (tmp_path / "s2.json").write_text(json.dumps({**good, "sync_id": "s2"}, indent=2))
    (tmp_path / "broken.json").write_text('{"sync_id": "s3", ')
    rows = state_scan(spark, str(tmp_path)).select("sync_id", "last_sync_time", "status").collect()
    assert sorted(r.sync_id for r in rows) == ["s1", "s2"]
    assert {str(r.last_sync_time) for r in rows} == {"2024-01-01 10:00:00"}


def test_indented_reports(spark, tmp_path):
    for name in ("val-1", "val-2"):
        (tmp_path / f"{name}.json").write_text(json.dumps(
            {"validation_id": name, "summary": {"total_objects": 3},
             "failed_objects": [{"key": "k", "errors": ["e"]}]}, indent=2))
    assert report_scan(spark, str(tmp_path)).count() == 2
    one = report_scan(spark, str(tmp_path), "val-2").first()
    assert one.summary.total_objects == 3 and one.failed_objects[0].errors == ["e"]
