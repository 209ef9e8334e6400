"""Comparison and update of object heads."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from ..constants import COMPARE_FIELDS, FIELD_COLUMNS, USER_METADATA_FIELD
from ..functions.maps import (
    map_equal, map_literal, map_or_empty, metadata_merge, metadata_replace,
)
from ..sources.inventory import single


def _map_text(value: Column) -> Column:
    """A map as sorted ``name=value`` text, for display."""
    return F.array_join(
        F.transform(
            F.array_sort(F.map_entries(map_or_empty(value))),
            lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit(""))),
        ),
        ";",
    )


def metadata_differences(
    fields: Iterable[str], source: str = "s", target: str = "t"
) -> Column:
    """``array<struct<field, source, target, match>>`` over two head structs.

    Scalar fields are always listed, the user metadata only where it differs. A field no head
    has compares as equal.
    """
    entries: list[Column] = []
    none = F.lit(None).cast("string")
    for name in fields:
        if name == USER_METADATA_FIELD:
            left, right = F.col(f"{source}.metadata"), F.col(f"{target}.metadata")
            same = map_equal(left, right)
            shown = (_map_text(left), _map_text(right))
        elif name in FIELD_COLUMNS:
            left, right = (F.col(f"{side}.{FIELD_COLUMNS[name]}") for side in (source, target))
            same = left.eqNullSafe(right)
            shown = (left.cast("string"), right.cast("string"))
        else:
            same, shown = F.lit(True), (none, none)
        entry = F.struct(
            F.lit(name).alias("field"), shown[0].alias("source"), shown[1].alias("target"),
            same.alias("match"),
        )
        entries.append(F.when(~same, entry) if name == USER_METADATA_FIELD else entry)
    if not entries:
        return F.expr(
            "cast(array() as array<struct<field:string,source:string,target:string,match:boolean>>)"
        )
    return F.array_compact(F.array(*entries))


def all_match(differences: Column | str) -> Column:
    differences = F.col(differences) if isinstance(differences, str) else differences
    return F.forall(differences, lambda d: d["match"])


def metadata_compare(
    source_heads: DataFrame, target_heads: DataFrame,
    fields: Iterable[str] | None = None, how: str = "inner", repeated_keys: bool = True,
) -> DataFrame:
    """``key, match, differences`` for the keys of two head tables (newest heads)."""
    fields = COMPARE_FIELDS if fields is None else list(fields)
    wanted = {FIELD_COLUMNS.get(f, "metadata") for f in fields} | {"last_modified"}
    columns = [c for c in (*FIELD_COLUMNS.values(), "metadata") if c in wanted]

    def side(heads: DataFrame, name: str) -> DataFrame:
        current = single(heads.select("key", *columns), repeated_keys)
        return current.select("key", F.struct(*columns).alias(name))

    left, right = side(source_heads, "s"), side(target_heads, "t")
    return left.join(right, "key", how).select(
        "key", metadata_differences(fields).alias("differences")
    ).select("key", all_match("differences").alias("match"), "differences")


def _current_metadata(heads: DataFrame, repeated_keys: bool) -> DataFrame:
    return single(heads.select("key", "last_modified", "metadata"), repeated_keys).drop(
        "last_modified")


def metadata_batch_update(
    heads: DataFrame, keys: DataFrame, metadata: dict[str, str], operation: str = "REPLACE",
    repeated_keys: bool = True,
) -> DataFrame:
    """Applies new metadata to listed keys; a key without an object is a failure row.

    ``operation`` COPY lays the new entries over the old ones, REPLACE puts them in their
    place (nothing changes where they are empty).
    """
    if operation not in ("COPY", "REPLACE"):
        raise ValueError(f"unknown operation {operation!r}")
    new = map_literal(metadata)
    change = metadata_merge if operation == "COPY" else metadata_replace
    found = _current_metadata(heads, repeated_keys).withColumn("found", F.lit(True))
    success = F.coalesce(F.col("found"), F.lit(False))
    return keys.select("key").join(found, "key", "left").select(
        "key",
        success.alias("success"),
        F.when(~success, F.lit("Not Found")).alias("error"),
        F.when(success, change("metadata", new)).alias("metadata"),
    )


def metadata_copy(
    heads: DataFrame, mapping: DataFrame, preserve: bool = True,
    metadata: dict[str, str] | None = None, repeated_keys: bool = True,
) -> DataFrame:
    """Metadata of the target for each (source_key, target_key) of ``mapping``.

    ``preserve`` takes the source's; otherwise the given map is used, unless it is empty.
    """
    source = _current_metadata(heads, repeated_keys).withColumnRenamed("key", "source_key")
    kept = map_or_empty("metadata") if preserve else metadata_replace(
        "metadata", map_literal(metadata)
    )
    return mapping.select("source_key", "target_key").join(source, "source_key", "inner").select(
        "source_key", "target_key", kept.alias("metadata")
    )
