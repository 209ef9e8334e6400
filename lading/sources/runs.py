"""Run states and validation reports kept as JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.keys import parse_instant
from ..schemas import REPORT_JSON, STATE_JSON


def _json(spark: SparkSession, path: str, schema, multi_line: bool) -> DataFrame:
    return (
        spark.read.schema(schema).option("multiLine", multi_line)
        .option("mode", "DROPMALFORMED").json(path)
    )


def state_scan(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """All run states below ``path``; unreadable ones are left out.

    ``multi_line`` reads one indented document per file; without it, one document per line.
    """
    raw = _json(spark, path, STATE_JSON, multi_line)
    return raw.withColumns({
        name: parse_instant(name) for name in ("last_sync_time", "start_time", "end_time")
    })


def report_scan(
    spark: SparkSession, path: str, validation_id: str | None = None, multi_line: bool = True
) -> DataFrame:
    """One or all validation reports below ``path``."""
    reports = _json(spark, path, REPORT_JSON, multi_line)
    return reports.filter(F.col("validation_id") == validation_id) if validation_id else reports
