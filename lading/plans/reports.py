"""Reports: one text or JSON column computed from each summary row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import FAILED_ROWS_IN_TEXT, PREVIEW_KEY_CHARS, PREVIEW_ROWS, PREVIEW_TIME_CHARS
from ..functions.text import format_duration, format_size, labelled, thousands
from ..operators.limits import held_for_preview, preview_totals, shown_rows

_RULE = "=" * 60


def _text(name: str, default: str = "N/A") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(default))


def _time(name: str) -> Column:
    return F.coalesce(F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("N/A"))


def _count(name: str) -> Column:
    return thousands(F.coalesce(F.col(name), F.lit(0)))


def _bytes(name: str) -> Column:
    return format_size(F.coalesce(F.col(name), F.lit(0)))


def _yes_no(name: str) -> Column:
    return F.when(F.col(name), F.lit("yes")).otherwise("no")


def _lines(*parts: Column | str) -> Column:
    """Lines joined by line breaks; a null column is a line left out."""
    return F.concat_ws("\n", *[F.lit(p) if isinstance(p, str) else p for p in parts])


def _spread(array: Column, render) -> Column:
    """Rendered entries as one block of lines; null where there is none."""
    shown = F.slice(F.coalesce(array, F.array()), 1, FAILED_ROWS_IN_TEXT)
    return F.when(F.size(shown) > 0, F.array_join(F.transform(shown, render), "\n"))


def _sync_head(title: str) -> list:
    return [
        _RULE, title, _RULE, "",
        labelled("Sync ID:", _text("sync_id")),
        labelled("Status:", F.upper(_text("status"))),
        labelled("Start:", _time("start_time")),
        labelled("End:", _time("end_time")),
        labelled("Duration:", format_duration(F.coalesce("duration_seconds", F.lit(0.0)))),
        "",
        "  Source:",
        labelled("  Bucket:", _text("source_bucket")),
        labelled("  Prefix:", _text("source_prefix", "")),
        "",
        "  Target:",
        labelled("  Bucket:", _text("target_bucket")),
        labelled("  Prefix:", _text("target_prefix", "")),
        "",
        "  Options:",
        labelled("  Preserve metadata:", _yes_no("preserve_metadata")),
        labelled("  Preserve ACL:", _yes_no("preserve_acl")),
    ]


def sync_report_text(summaries: DataFrame, column: str = "report") -> DataFrame:
    """Sync report of each summary row."""
    text = _lines(
        *_sync_head("SYNC REPORT"),
        F.when(F.col("dry_run"), labelled("  Mode:", F.lit("preview (dry-run)"))),
        "",
        "  Statistics:",
        labelled("  Objects:", _count("total_objects")),
        labelled("  Uploaded:", _count("uploaded")),
        labelled("  Deleted:", _count("deleted")),
        labelled("  Skipped:", _count("skipped")),
        labelled("  Failed:", _count("failed")),
        "",
        _RULE,
    )
    return summaries.select("sync_id", text.alias(column))


def migration_report_text(summaries: DataFrame, column: str = "report") -> DataFrame:
    """The longer form: bytes moved and the first failed objects."""
    failures = _spread(F.col("failed_list"), lambda f: F.concat(
        F.lit("    - "), F.coalesce(f["key"], F.lit("N/A")), F.lit(": "),
        F.coalesce(f["error"], F.lit("unknown error")),
    ))
    some = failures.isNotNull()
    text = _lines(
        *_sync_head("MIGRATION REPORT"),
        "",
        "  Statistics:",
        labelled("  Objects:", _count("total_objects")),
        labelled("  Processed:", _count("processed_objects")),
        labelled("  Failed:", _count("failed")),
        labelled("  Total size:", _bytes("total_bytes")),
        labelled("  Transferred:", _bytes("transferred_bytes")),
        F.when(some, F.lit("")),
        F.when(some, F.lit("  Failed objects (first 10):")),
        failures,
        "",
        _RULE,
    )
    return summaries.select("sync_id", text.alias(column))


def validation_report_text(reports: DataFrame, column: str = "report") -> DataFrame:
    """Validation report of each report row (``summary`` struct, ``failed_objects`` array)."""
    def fmt(label: str, value: Column) -> Column:
        return labelled(label, value, 10)

    def counted(name: str) -> Column:
        return _count(f"summary.{name}")

    def check(title: str, name: str) -> list:
        on = F.coalesce(F.col(f"check_{name}"), F.lit(True))
        return [
            "",
            fmt(title, F.lit("")),
            F.when(on, fmt("  Passed:", counted(f"{name}_passed"))),
            F.when(on, fmt("  Failed:", counted(f"{name}_failed"))),
            F.when(~on, fmt("  Skipped:", counted(f"{name}_skipped"))),
        ]

    failures = _spread(F.col("failed_objects"), lambda f: F.concat_ws(
        "\n",
        F.concat(F.lit("    - "), F.coalesce(f["key"], F.lit("N/A"))),
        F.transform(f["errors"], lambda e: F.concat(F.lit("      "), e)),
    ))
    some = failures.isNotNull()
    text = _lines(
        _RULE, "VALIDATION REPORT", _RULE, "",
        fmt("Validation ID:", _text("validation_id")),
        fmt("Timestamp:", _text("timestamp")),
        fmt("Status:", F.upper(_text("status"))),
        fmt("Duration:", format_duration(F.coalesce("duration_seconds", F.lit(0.0)))),
        "",
        "  Source:",
        fmt("  Bucket:", _text("source_bucket")),
        fmt("  Prefix:", _text("prefix", "")),
        "",
        "  Target:",
        fmt("  Bucket:", _text("target_bucket")),
        "",
        "  Summary:",
        fmt("  Objects:", counted("total_objects")),
        "",
        fmt("  Content check:", F.lit("")),
        fmt("  Passed:", counted("content_passed")),
        fmt("  Failed:", counted("content_failed")),
        *check("  Metadata check:", "metadata"),
        *check("  ACL check:", "acl"),
        F.when(some, F.lit("")),
        F.when(some, F.lit("  Failed objects (first 10):")),
        failures,
        "",
        _RULE,
    )
    return reports.select("validation_id", text.alias(column))


def migration_preview_text(
    objects: DataFrame, source_bucket: str, target_bucket: str, source_prefix: str = "",
    column: str = "preview",
) -> DataFrame:
    """Totals and the first 50 objects of a plan as one text; the plan is evaluated once."""
    objects = held_for_preview(objects)
    row = F.concat(
        F.lit("  "), F.rpad("shown_key", PREVIEW_KEY_CHARS, " "), F.lit(" "),
        F.lpad("shown_size", F.greatest(F.lit(12), F.length("shown_size")), F.lit(" ")),
        F.lit(" "), F.rpad("shown_time", PREVIEW_TIME_CHARS + 1, " "),
    )
    # At most 50 rows are gathered here.
    table = shown_rows(objects, PREVIEW_ROWS).agg(
        F.array_join(F.transform(
            F.array_sort(F.collect_list(F.struct("shown_key", row.alias("line")))),
            lambda r: r["line"],
        ), "\n")
    ).scalar()
    more = F.col("objects") - PREVIEW_ROWS
    text = _lines(
        _RULE, "MIGRATION PREVIEW", _RULE, "",
        labelled("Source:", F.lit(source_bucket)),
        labelled("Prefix:", F.lit(source_prefix or "/")),
        labelled("Target:", F.lit(target_bucket)),
        "",
        "  Statistics:",
        labelled("  Objects:", thousands("objects")),
        labelled("  Total size:", format_size("bytes")),
        "",
        "  Objects to migrate:",
        f"  {'Key':<{PREVIEW_KEY_CHARS}} {'Size':>12} {'Last modified':<20}",
        "  " + "-" * 56,
        F.when(F.col("objects") > 0, F.col("table")),
        F.when(more > 0, F.concat(F.lit("  ... "), more.cast("string"), F.lit(" more objects"))),
        "",
        _RULE,
    )
    return preview_totals(objects).select("objects", "bytes", table.alias("table")).select(
        text.alias(column)
    )


def sync_preview_text(
    objects: DataFrame, source_bucket: str, target_bucket: str, since: str | None = None,
    column: str = "preview",
) -> DataFrame:
    text = _lines(
        _RULE, "SYNC PREVIEW", _RULE, "",
        labelled("Source:", F.lit(source_bucket)),
        labelled("Target:", F.lit(target_bucket)),
        *([labelled("Since:", F.lit(since))] if since else []),
        "",
        "  Statistics:",
        labelled("  Objects:", thousands("objects")),
        labelled("  Total size:", format_size("bytes")),
        "",
        _RULE,
    )
    return preview_totals(objects).select(text.alias(column))


def report_json(rows: DataFrame, column: str = "json") -> DataFrame:
    """Each row as one JSON document; absent values appear as null."""
    document = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
    return rows.select(document.alias(column))
