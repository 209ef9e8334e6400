"""Running totals over a total order, without one task that sees every row."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stored

OBJECT_OVERHEAD_BYTES = 4096


def running_totals(
    rows: DataFrame, order_by: list[str], totals: dict[str, Column], slices: int | None = None
) -> DataFrame:
    """Adds, per entry of ``totals``, the sum of its expression up to and including each row.

    The rows are written once, with what is to be summed, so that they are evaluated once. Then they
    are range-partitioned by the order columns (which should include a unique key, so that equal
    times can be split), each slice is sorted and summed up where it lies, a batch at a time, and
    the slices are written. Only the sums of the slices before are still missing: one small row per
    slice, added where the rows are read. Nulls count as 0.
    """
    spark = rows.sparkSession
    slices = slices or int(spark.conf.get("spark.sql.shuffle.partitions"))
    measures = {name: F.coalesce(expr, F.lit(0)) for name, expr in totals.items()}
    measured = stored(rows.withColumns(measures), "measured")
    whole = {name: measured.schema[name].dataType.simpleString() not in ("float", "double") for name in totals}
    wide = measured.select(*[
        F.col(c).cast("long" if whole[c] else "double").alias(c) if c in whole else F.col(c)
        for c in measured.columns])

    names = list(totals)

    def run(batches):
        number = TaskContext.get().partitionId()
        before, waiting = dict.fromkeys(names, 0), None

        def marked(columns: dict, end: bool) -> pa.RecordBatch:
            rows = len(next(iter(columns.values())))
            return pa.RecordBatch.from_arrays([
                *columns.values(), pa.array([number] * rows, pa.int32()),
                pa.array([False] * (rows - 1) + [end])], [*columns, "_slice", "_end"])

        for batch in batches:
            if not batch.num_rows:
                continue
            if waiting is not None:
                yield marked(waiting, False)
            waiting = dict(zip(batch.schema.names, batch.columns))
            for name in names:
                waiting[name] = summed = pc.cumulative_sum(waiting[name], before[name])
                before[name] = summed[-1].as_py()
        if waiting is not None:
            yield marked(waiting, True)

    schema = wide.withColumns({"_slice": F.lit(0), "_end": F.lit(True)}).schema
    summed = stored(
        wide.repartitionByRange(slices, *order_by).sortWithinPartitions(*order_by).mapInArrow(run, schema),
        "slices")
    # The last row of a slice has its sums; there is at most one such row per slice.
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = summed.filter("_end").select("_slice", *[
        F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_o_{n}") for n in totals])
    joined = summed.join(F.broadcast(offsets), "_slice")
    return joined.select(*[
        (F.col(c) + F.col(f"_o_{c}")).alias(c) if c in totals else F.col(c) for c in wide.columns])


def byte_slices(
    plan: DataFrame, bytes_per_task: int, size: str = "size", key: str = "key"
) -> DataFrame:
    """Adds ``task``: consecutive keys share one until it has ``bytes_per_task`` bytes.

    Work is balanced by bytes, not rows: a task holds at most that many bytes plus its last
    object. Each object also counts a fixed overhead, so that empty ones spread as well.
    """
    cost = F.coalesce(F.col(size), F.lit(0)) + F.lit(OBJECT_OVERHEAD_BYTES)
    filled = running_totals(plan, [key], {"_filled": cost})
    start = F.col("_filled") - cost
    return filled.withColumn("task", F.floor(start / F.lit(bytes_per_task)).cast("long")).drop(
        "_filled"
    )
