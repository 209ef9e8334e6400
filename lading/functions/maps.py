"""Expressions on user-metadata maps and header maps."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..constants import HEADER_FIELDS, USER_HEADER_PREFIX
from .keys import _col


def empty_map() -> Column:
    return F.expr("cast(map() as map<string,string>)")


def map_literal(values: dict[str, str] | None) -> Column:
    if not values:
        return empty_map()
    return F.create_map(*[F.lit(part) for pair in values.items() for part in pair])


def map_or_empty(column: Column | str) -> Column:
    return F.coalesce(_col(column), empty_map())


def map_equal(left: Column | str, right: Column | str) -> Column:
    """Equality of two maps; a missing map counts as an empty one."""

    def entries(side: Column | str) -> Column:
        return F.array_sort(F.map_entries(map_or_empty(side)))

    return entries(left).eqNullSafe(entries(right))


def metadata_merge(current: Column | str, new: Column | str) -> Column:
    """Current entries overlaid with the new ones."""
    return F.map_zip_with(
        map_or_empty(current), map_or_empty(new), lambda k, old, fresh: F.coalesce(fresh, old)
    )


def metadata_replace(current: Column | str, new: Column | str) -> Column:
    """The new map; an empty one changes nothing."""
    fresh = map_or_empty(new)
    return F.when(F.size(fresh) > 0, fresh).otherwise(map_or_empty(current))


def metadata_normalize(headers: Column | str) -> Column:
    """Header names to field names, without regard to case.

    The user-metadata prefix is cut off and the rest keeps its case; other names stay. Where
    two headers end up under one name, the later entry wins.
    """
    known = map_literal(HEADER_FIELDS)
    prefix_len = len(USER_HEADER_PREFIX)

    def renamed(entry: Column) -> Column:
        name = entry["key"]
        lowered = F.lower(name)
        return F.struct(
            F.when(
                lowered.startswith(USER_HEADER_PREFIX), F.substring(name, prefix_len + 1, 2147483647)
            ).otherwise(F.coalesce(F.element_at(known, lowered), name)).alias("key"),
            entry["value"].alias("value"),
        )

    entries = F.transform(F.map_entries(map_or_empty(headers)), renamed)
    last_of_name = F.filter(
        entries,
        lambda entry, at: ~F.exists(
            F.slice(entries, at + 2, F.size(entries)), lambda later: later["key"] == entry["key"]
        ),
    )
    return F.map_from_entries(last_of_name)
