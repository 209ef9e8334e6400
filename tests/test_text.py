import random

import pytest
from pyspark.sql import functions as F

from lading.functions.keys import (
    basename_target, copy_source, etag_normalize, instant, parse_instant, relative_key,
    size_class, storage_class_pick, target_key, task_share,
)
from lading.functions.text import format_duration, format_size, progress_ratio, run_duration


def _one(spark, column):
    return spark.range(1).select(column).first()[0]


def _python_size(size):
    for unit in ("B", "KB", "MB", "GB", "TB"):
        if size < 1024:
            return f"{size:.2f} {unit}"
        size /= 1024
    return f"{size:.2f} PB"


@pytest.mark.parametrize("size, text", [
    (0, "0.00 B"), (500, "500.00 B"), (1023, "1023.00 B"), (1024, "1.00 KB"), (1536, "1.50 KB"),
    (10240, "10.00 KB"), (1048576, "1.00 MB"), (5242880, "5.00 MB"), (10485760, "10.00 MB"),
    (1073741824, "1.00 GB"), (5368709120, "5.00 GB"), (1099511627776, "1.00 TB"),
    (1099511627776 * 1024, "1.00 PB"), (1152, "1.12 KB"),
])
def test_format_size(spark, size, text):
    assert _one(spark, format_size(F.lit(size))) == text


def test_format_size_agrees_on_many_sizes(spark):
    rng = random.Random(3)
    sizes = [rng.randrange(2 ** rng.randint(1, 60)) for _ in range(4000)]
    sizes += [1024 ** k + d for k in range(1, 6) for d in (-1, 0, 1)]
    sizes += [n * 128 for n in range(2000)]
    rows = spark.createDataFrame([(s,) for s in sizes], "size long").select(
        "size", format_size("size").alias("text")).collect()
    assert [r for r in rows if r.text != _python_size(r.size)] == []


@pytest.mark.parametrize("seconds, text", [
    (0, "0.0s"), (30, "30.0s"), (59.9, "59.9s"), (60, "1.0m"), (120, "2.0m"), (180, "3.0m"),
    (3600, "1.0h"), (7200, "2.0h"), (86400, "24.0h"), (0.25, "0.2s"), (0.35, "0.3s"),
])
def test_format_duration(spark, seconds, text):
    assert _one(spark, format_duration(F.lit(float(seconds)))) == text


def test_keys(spark):
    key = F.lit("src/a/b.txt")
    assert _one(spark, relative_key(key, "src/")) == "a/b.txt"
    assert _one(spark, relative_key(key)) == "src/a/b.txt"
    assert _one(spark, target_key(key, "src/", "dst/")) == "dst/a/b.txt"
    assert _one(spark, target_key(key, "", "dst/")) == "dst/src/a/b.txt"
    assert _one(spark, basename_target(key, "t/")) == "t/b.txt"
    assert _one(spark, basename_target(key)) == "src/a/b.txt"


def test_listing_fields(spark):
    null = F.lit(None).cast("string")
    assert _one(spark, etag_normalize(F.lit('"abc"'))) == "abc"
    assert _one(spark, etag_normalize(null)) == ""
    assert _one(spark, storage_class_pick(null)) == "STANDARD"
    assert _one(spark, storage_class_pick(F.lit("GLACIER"), "")) == "GLACIER"
    assert _one(spark, storage_class_pick(F.lit("GLACIER"), "COLD")) == "COLD"
    assert _one(spark, copy_source(F.lit("b"), F.lit("k"), null)) == "b/k"
    assert _one(spark, copy_source(F.lit("b"), F.lit("k"), F.lit("v1"))) == "b/k?versionId=v1"
    assert _one(spark, size_class(F.lit(200 * 1024 ** 2))) == "large"
    assert _one(spark, size_class(F.lit(100 * 1024 ** 2))) == "small"
    assert _one(spark, task_share(F.lit(200 * 1024 ** 2), 10)) == 2
    assert _one(spark, task_share(F.lit(200 * 1024 ** 2), 40)) == 10
    assert _one(spark, task_share(F.lit(1024), 10)) == 10


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_instants_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        cases = {
            "2024-03-10T02:30:00Z": "2024-03-10 02:30:00",
            "2024-03-10T02:30:00": "2024-03-10 02:30:00",
            "2024-03-10 02:30:00.25+02:00": "2024-03-10 00:30:00.25",
            "2024-03-10": "2024-03-10 00:00:00",
            "1969-12-31T23:59:59Z": "1969-12-31 23:59:59",
            "no time": None,
        }
        for text, expected in cases.items():
            assert _one(spark, parse_instant(F.lit(text)).cast("string")) == expected
        span = run_duration(instant("2024-03-10 00:00:00"), instant("2024-03-11 00:00:00.5"))
        assert _one(spark, span) == 86400.5
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_durations_and_ratios(spark):
    none = F.lit(None).cast("timestamp_ntz")
    assert _one(spark, run_duration(instant("2024-01-01 00:00:00"), none)) is None
    back = run_duration(instant("2024-01-01 00:00:10"), instant("2024-01-01 00:00:09.75"))
    assert _one(spark, back) == -0.25
    assert _one(spark, progress_ratio(F.lit(0), F.lit(0))) == 0.0
    assert _one(spark, progress_ratio(F.lit(1), F.lit(4))) == 25.0
