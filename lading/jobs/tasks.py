"""What the jobs share: rows of a task worked on side by side, and shapes of results."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import SparkSession

from .store import CALLS_AT_ONCE

RESULT_ARROW = pa.schema([
    ("key", pa.string()), ("target_key", pa.string()), ("success", pa.bool_()),
    ("skipped", pa.bool_()), ("error", pa.string()), ("reason", pa.string()),
    ("size", pa.int64()),
])
_ROWS_AT_ONCE = 256


def overlapped(
    function: Callable[[dict], dict | None], rows: Iterable[dict], calls: int = CALLS_AT_ONCE
) -> Iterator[dict]:
    """``function`` of every row, in their order, with up to ``calls`` at once.

    No more rows than that are taken ahead. Rows whose result is None are left out.
    """
    if calls <= 1:
        yield from (r for r in map(function, rows) if r is not None)
        return
    with ThreadPoolExecutor(calls) as pool:
        waiting: deque = deque()
        for row in rows:
            waiting.append(pool.submit(function, row))
            if len(waiting) >= calls:
                result = waiting.popleft().result()
                if result is not None:
                    yield result
        while waiting:
            result = waiting.popleft().result()
            if result is not None:
                yield result


def per_row(
    function: Callable[[dict], dict | None], schema: pa.Schema, calls: int = CALLS_AT_ONCE,
    through: Callable[[Iterator[dict]], Iterator[dict]] = iter,
):
    """Arrow batches in, one result per row out, all of which pass ``through`` something."""
    def run(batches):
        rows = (r for batch in batches for start in range(0, batch.num_rows, _ROWS_AT_ONCE)
                for r in batch.slice(start, _ROWS_AT_ONCE).to_pylist())
        done: list[dict] = []
        for result in through(overlapped(function, rows, calls)):
            done.append(result)
            if len(done) >= _ROWS_AT_ONCE:
                yield pa.RecordBatch.from_pylist(done, schema)
                done = []
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)

    return run


def result_of(row: dict, **values) -> dict:
    base = {
        "key": row["key"], "target_key": row.get("target_key"), "success": True,
        "skipped": False, "error": None, "reason": None, "size": row.get("size") or 0,
    }
    return {**base, **values}


def default_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
