"""Column expressions on object keys and listing fields."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, functions as F

from ..constants import DEFAULT_STORAGE_CLASS, LARGE_OBJECT_BYTES

_TO_THE_END = 2147483647


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def instant(text: str | None) -> Column:
    """UTC wall-clock literal of an ISO text; stays a plain constant so scans can push it down.

    An offset is resolved here; a text without one is UTC; an unreadable one is a ValueError.
    """
    if text is None:
        return F.lit(None).cast("timestamp_ntz")
    at = datetime.fromisoformat(text)
    if at.tzinfo is not None:
        at = at.astimezone(timezone.utc).replace(tzinfo=None)
    return F.lit(at.isoformat(" ")).cast("timestamp_ntz")


def relative_key(key: Column | str, prefix: str = "") -> Column:
    """Key without the first ``len(prefix)`` characters."""
    return F.substring(_col(key), len(prefix) + 1, _TO_THE_END) if prefix else _col(key)


def target_key(key: Column | str, source_prefix: str = "", target_prefix: str = "") -> Column:
    rel = relative_key(key, source_prefix)
    return F.concat(F.lit(target_prefix), rel) if target_prefix else rel


def basename_target(key: Column | str, target_prefix: str = "") -> Column:
    """Prefix plus last path segment; the key itself where no prefix is given."""
    if not target_prefix:
        return _col(key)
    return F.concat(F.lit(target_prefix), F.substring_index(_col(key), "/", -1))


def etag_normalize(etag: Column | str) -> Column:
    return F.trim(F.coalesce(_col(etag), F.lit("")), F.lit('"'))


def storage_class_pick(storage_class: Column | str, override: str | None = None) -> Column:
    """A non-empty override wins, then the source's class, then the default."""
    if override:
        return F.lit(override)
    return F.coalesce(_col(storage_class), F.lit(DEFAULT_STORAGE_CLASS))


def copy_source(bucket: Column | str, key: Column | str, version_id: Column | str) -> Column:
    version = _col(version_id)
    suffix = F.when(version != "", F.concat(F.lit("?versionId="), version)).otherwise("")
    return F.concat(_col(bucket), F.lit("/"), _col(key), suffix)


def from_micros(micros: Column | str) -> Column:
    """UTC wall-clock time of microseconds since 1970."""
    return F.timestamp_add("MICROSECOND", _col(micros), instant("1970-01-01 00:00:00"))


def parse_instant(text: Column | str) -> Column:
    """ISO text to UTC wall-clock time; a text without an offset is taken as UTC.

    Unreadable text becomes null. The session time zone has no influence: every text is given
    an offset, and the instant is rebuilt from its microseconds.
    """
    raw = _col(text)
    time = F.substring(raw, 12, 64)  # what follows the date and its separator
    has_offset = time.contains("+") | time.contains("-") | time.endswith("Z")
    utc = (
        F.when(F.length(raw) <= 10, F.concat(raw, F.lit("T00:00:00Z")))
        .when(has_offset, raw)
        .otherwise(F.concat(raw, F.lit("Z")))
    )
    return from_micros(F.unix_micros(utc.try_cast("timestamp")))


def size_class(size: Column | str, threshold: int = LARGE_OBJECT_BYTES) -> Column:
    return F.when(F.coalesce(_col(size), F.lit(0)) > threshold, F.lit("large")).otherwise("small")


def task_share(size: Column | str, workers: int = 10, threshold: int = LARGE_OBJECT_BYTES) -> Column:
    """How many copies may run side by side for an object of this size."""
    return F.when(
        F.coalesce(_col(size), F.lit(0)) > threshold, F.lit(max(2, workers // 4))
    ).otherwise(workers)


def etag_parts(etag: Column) -> Column:
    """The number of parts a composite ETag names (its digest of digests, ``-``, their number); null for
    others."""
    return F.regexp_extract(etag, "^[0-9a-f]{32}-([0-9]{1,9})$", 1).try_cast("long")
