"""Formatting of sizes, durations and ratios."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from ..constants import SIZE_UNITS
from .keys import _col


def _pattern(value: Column, pattern: str) -> Column:
    """Half-even rounding of the exact double; ``format_string`` would round half-up."""
    return F.call_function("format_number", value, F.lit(pattern))


def format_size(size: Column | str) -> Column:
    """Bytes to text with two decimals and a 1024-based unit."""
    value = _col(size).cast("double")
    steps = [(1024.0 ** i, unit) for i, unit in enumerate(SIZE_UNITS)]
    *lower, (top, top_unit) = steps

    def rendered(scale: float, unit: str) -> Column:
        return F.concat(_pattern(value / scale, "0.00"), F.lit(" " + unit))

    chain = reduce(
        lambda acc, step: acc.when(value < step[0] * 1024.0, rendered(*step)),
        lower, F.when(value.isNull(), F.lit(None).cast("string")),
    )
    return chain.otherwise(rendered(top, top_unit))


def format_duration(seconds: Column | str) -> Column:
    value = _col(seconds).cast("double")

    def rendered(scale: float, unit: str) -> Column:
        return F.concat(_pattern(value / scale, "0.0"), F.lit(unit))

    return (
        F.when(value < 60, rendered(1.0, "s"))
        .when(value < 3600, rendered(60.0, "m"))
        .otherwise(rendered(3600.0, "h"))
    )


def run_duration(start: Column | str, end: Column | str) -> Column:
    """Seconds from start to end as a double; null where either is missing.

    The difference of two wall-clock times is an interval, so no time zone takes part.
    """
    gap = _col(end) - _col(start)
    whole = (
        F.extract(F.lit("DAY"), gap).cast("long") * 86400
        + F.extract(F.lit("HOUR"), gap).cast("long") * 3600
        + F.extract(F.lit("MINUTE"), gap).cast("long") * 60
    )
    return (whole.cast("decimal(18,6)") + F.extract(F.lit("SECOND"), gap)).cast("double")


def progress_ratio(processed: Column | str, total: Column | str) -> Column:
    done, whole = _col(processed), _col(total)
    return F.when(whole > 0, done.cast("double") / whole.cast("double") * 100.0).otherwise(0.0)


def thousands(count: Column | str) -> Column:
    return F.format_number(_col(count), 0)


def labelled(label: str, value: Column, width: int = 8) -> Column:
    """``  label     value`` with the label padded to ``width``."""
    return F.concat(F.lit(f"  {label:<{width}} "), value)
